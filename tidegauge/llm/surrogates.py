"""Personal data and secrets replaced by keyed surrogates.

Entities are found by patterns. Every distinct entity gets a surrogate drawn from a
keyed hash of its type and canonical form: digits become digits and letters letters of
the same case, hex tokens stay hex, a secret keeps the prefix that names its provider, a card its
issuer digit and its check, an account number its country and its check, an address four
octets or its groups, a mail address its top-level domain, a name its title, its script and
an ending of the title's gender. Equal entities get equal surrogates in all
documents. A name's parts get surrogates of their own, so that a person keeps them behind
another title or without given name; mentions without title of a name that has one in the
same document are replaced as well, unless a mention is a month, a weekday or another ordinary
word on its own. A run of digits is a card only if it passes the card check. Surrogates that meet, or meet a real entity, are drawn again, so that
distinct entities stay distinct.

Defined results: null and empty texts stay as they are; repeated rows get equal texts;
without entities a text is unchanged; texts are searched whole; other columns are kept,
``n_replaced`` and ``kinds`` are replaced; an empty table gives no rows. Everything here is
built from Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace, named

#: Titles, which stand in any case before a name; the first ones are of women, the last of either gender.
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Señora", "Госпожа"]
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин"]
EITHER = ["Dr", "Prof"]
_TITLES = "(?iu:" + "|".join([*FEMALE, *MALE, *EITHER]) + ")"
#: Titles that lower-case names are looked for behind; others begin ordinary phrases.
_PLAIN_TITLES = "(?:mr|mrs|ms|dr|prof)"
#: Entity patterns, tried in this order at each place of a text.
PATTERNS = {
    "secret": r"""(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)["']?\s*[:=]\s*["']?[A-Za-z0-9_\-/+]{12,}|(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{40})\b""",
    "email": r"[A-Za-z0-9_%+\-]+(?:\.[A-Za-z0-9_%+\-]+)*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])|(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "card": r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|0[0-9]{2,4}[ /-][0-9]{5,8}(?:[ -][0-9]{1,4})?)(?![0-9])",
    "name": _TITLES + r"\.? \p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?|" + _PLAIN_TITLES + r"\.? \p{Ll}{2,}",
}
#: Words that are no mention of a person on their own, whatever names the document has.
ORDINARY = [
    "Will", "May", "April", "June", "August", "Mark", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
    "Mai", "Juni", "Juli", "Mars", "Avril", "Juin", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Май", "Марта",
]
#: Prefixes by which a secret's provider is known.
PROVIDERS = "^(?:AKIA|gh[pousr]_|sk-)"
#: Syllables that names are made of, and their endings, by script and gender.
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "ka", "le", "mi", "no", "ra", "se", "ti", "vo", "wa", "ze", "lu", "ni"],
    "cyrillic": ["ба", "де", "фи", "го", "ка", "ле", "ми", "но", "ра", "се", "ти", "во", "ва", "зе", "лу", "ни"],
}
ENDINGS = {("latin", True): "na", ("latin", False): "rd", ("cyrillic", True): "ова", ("cyrillic", False): "ов"}
#: Draws before a surrogate that still meets another one is told apart by a number.
DRAWS = 6

#: An entity begins where no letter or digit stands before, and with one of few characters.
BEGIN = r"(?<![\p{L}0-9])(?=[A-Za-z0-9_%+(\-ГСгс])"
ANY = BEGIN + "(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: What a text with an entity has, apart from digits and @; cheap to look for. Keywords stand in any case.
KEYWORDS = ["token", "secret", "passw", "api_key", "api-key", "apikey", "access_key", "access-key", "accesskey"]
WORDS = ["AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-"]
_TITLED = r"(?:^|[^\p{L}0-9])" + _TITLES + r"\.? \p{L}"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_TITLE = r"^(\p{L}+\.? )"
#: Syllables of a name's part; with sixteen of them there are 16 million parts.
N_SYLLABLES = 6


def may_have_entities(text: Column) -> Column:
    """False only for texts without entities: a filter much cheaper than the patterns."""
    may = text.rlike("[0-9@]") | text.rlike(_TITLED)
    for word in WORDS:
        may = may | text.contains(word)
    for word in KEYWORDS:
        may = may | F.lower(text).contains(word)
    return may


def kind_of(entity: Column) -> Column:
    """The type of a found entity: the first pattern that matches all of it, or a name without title.

    Null for a run of digits that fails the card check, and for an ordinary word.
    """
    kind = F.when(~entity.isin(ORDINARY), F.lit("name"))
    for name, pattern in reversed(PATTERNS.items()):
        found = F.lit(name)
        if name == "card":
            digits = F.regexp_replace(entity, "[^0-9]", "")
            found = F.when(F.pmod(_luhn(digits), F.lit(10)) == 0, found)
        kind = F.when(entity.rlike(f"^(?:{pattern})$"), found).otherwise(kind)
    return kind


def canonical(kind: Column, entity: Column) -> Column:
    """What makes two spellings one entity: case of mail addresses, separators of numbers."""
    digits = F.regexp_replace(entity, "[^0-9+]", "")
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind == "secret", F.regexp_extract(entity, r"[A-Za-z0-9_\-/+]{12,}$", 0))
        .otherwise(entity)
    )


def _stream(seed: Column, blocks: Column) -> Column:
    """Numbers from 0 to 65535, 32 a block, that a keyed hash gives for ``seed``."""
    digest = F.array_join(F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.sha2(F.concat(seed, F.lit("/"), i.cast("string")), 512)), "")
    return F.transform(
        F.sequence(F.lit(0), blocks * 32 - 1), lambda i: F.conv(F.substring(digest, i * 4 + 1, F.lit(4)), 16, 10).cast("int")
    )


def _same_shape(text: Column, numbers: Column) -> Column:
    """Every letter and digit replaced by one of its kind."""

    def one(c: Column, n: Column) -> Column:
        def of(alphabet: str) -> Column:
            return F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))

        return (
            F.when(c.rlike("[0-9]"), of(_DIGITS)).when(c.rlike("[a-z]"), of(_LOWER)).when(c.rlike("[A-Z]"), of(_UPPER)).otherwise(c)
        )

    return F.array_join(F.zip_with(F.split(text, ""), F.slice(numbers, 1, F.char_length(text)), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check rule over a number whose last digit counts once."""
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 1
        return total + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _in_format(digits: Column, entity: Column) -> Column:
    """``digits`` put in place of the digits of ``entity``."""
    marks = F.split(entity, "")
    return F.array_join(
        F.transform(
            marks,
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(digits, F.size(F.filter(F.slice(marks, 1, i + 1), lambda x: x.rlike("[0-9]"))), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def _card(value: Column, numbers: Column) -> Column:
    """Digits of a number of equal length, issuer digit and rightness of the check digit."""
    body = F.concat(F.substring(value, F.lit(1), F.lit(1)), F.substring(_same_shape(value, numbers), F.lit(2), F.char_length(value) - 2))
    check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    wrong = F.pmod(_luhn(value), F.lit(10))
    return F.concat(body, F.pmod(check + wrong, F.lit(10)).cast("string"))


def _mod97(value: Column) -> Column:
    """The number that digits and letters (A is 10) spell, modulo 97."""

    def add(total: Column, c: Column) -> Column:
        letter = F.pmod(total * 100 + F.ascii(c) - 55, F.lit(97))
        return F.when(c.rlike("[0-9]"), F.pmod(total * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(letter)

    return F.aggregate(F.split(value, ""), F.lit(0), add)


def _iban(value: Column, numbers: Column) -> Column:
    """An account number of equal country and form whose check leaves what the real one's leaves."""
    country, body = F.substring(value, F.lit(1), F.lit(2)), F.substring(value, F.lit(5), F.char_length(value))
    own = _mod97(F.concat(body, F.substring(value, F.lit(1), F.lit(4))))
    drawn_body = _same_shape(body, numbers)
    check = F.pmod(own - _mod97(F.concat(drawn_body, country, F.lit("00"))), F.lit(97))
    # check digits are 02 to 98
    check = F.when(check < 2, check + 97).otherwise(check)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), drawn_body)


def _hex_shape(text: Column, numbers: Column) -> Column:
    """Every hex digit replaced by one; letters stay of their case."""
    upper = text.rlike("[A-F]")

    def one(c: Column, n: Column) -> Column:
        digit = F.substring(F.lit("0123456789abcdef"), F.pmod(n, F.lit(16)) + 1, F.lit(1))
        return F.when(c.rlike("[0-9A-Fa-f]"), F.when(upper, F.upper(digit)).otherwise(digit)).otherwise(c)

    return F.array_join(F.zip_with(F.split(text, ""), F.slice(numbers, 1, F.char_length(text)), one), "")


def _phone(value: Column, numbers: Column) -> Column:
    """Digits behind the country code drawn anew; a leading zero stays one, others become 2 to 9."""
    code = F.regexp_extract(value, r"^\+[0-9]", 0)
    rest = F.substring(value, F.char_length(code) + 1, F.char_length(value))
    first = F.substring(rest, F.lit(1), F.lit(1))
    drawn = F.when(first == "0", first).otherwise((F.pmod(F.element_at(numbers, -1), F.lit(8)) + 2).cast("string"))
    return F.concat(F.regexp_replace(code, r"\+", ""), drawn, F.substring(_same_shape(rest, numbers), F.lit(2), F.char_length(rest)))


def _title(entity: Column) -> Column:
    """The title of a name with its full stop and space, empty if it has none."""
    return F.when(entity.rlike(f"^(?:{PATTERNS['name']})$"), F.regexp_extract(entity, _TITLE, 1)).otherwise("")


def _of(title: Column, titles: list[str]) -> Column:
    """Whether a title is one of some, in any case and with or without full stop."""
    return F.lower(F.regexp_replace(title, "[. ]", "")).isin([t.lower() for t in titles])


def _parts(entity: Column) -> Column:
    """The given and family name of a name."""
    return F.split(F.substring(entity, F.char_length(_title(entity)) + 1, F.char_length(entity)), " ")


def values(kind: Column, entity: Column, titled: Column) -> Column:
    """What an entity has surrogates for: its canonical form, or a name's parts behind F or M.

    A part is of the gender of the first name in ``titled`` that has it; a title decides itself.
    """

    def part(p: Column) -> Column:
        title = _title(entity)
        telling = F.filter(titled, lambda t: F.array_contains(_parts(t), p) & ~_of(_title(t), EITHER))
        own = (title != "") & ~_of(title, EITHER)
        female = _of(F.when(own, title).otherwise(_title(F.get(telling, F.lit(0)))), FEMALE)
        return F.concat(F.when(female, "F ").otherwise("M "), p)

    return F.when(kind == "name", F.transform(_parts(entity), part)).otherwise(F.array(canonical(kind, entity)))


def pattern_of(titled: Column) -> Column:
    """The pattern of a text's entities: ``ANY``, and the parts of its names with title wherever they stand."""
    parts = F.array_distinct(F.flatten(F.transform(titled, _parts)))
    word = F.concat(F.lit("(?:"), F.array_join(parts, "|"), F.lit(")"))
    later = F.concat(F.lit(ANY + r"|(?<![\p{L}0-9])"), word, F.lit("(?: "), word, F.lit(r")?(?![\p{L}0-9])"))
    return F.when(F.size(parts) > 0, later).otherwise(F.lit(ANY))


def _name(value: Column, numbers: Column) -> Column:
    """A name's part behind its gender."""
    female = value.startswith("F ")
    cyrillic = value.rlike(r"\p{IsCyrillic}")

    def made(script: str) -> Column:
        syllable = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        stem = F.transform(
            F.sequence(F.lit(1), F.lit(N_SYLLABLES)),
            lambda j: F.element_at(syllable, F.pmod(F.element_at(numbers, j), F.lit(16)) + 1),
        )
        ending = F.when(female, F.lit(ENDINGS[script, True])).otherwise(F.lit(ENDINGS[script, False]))
        return F.concat(F.initcap(F.array_join(stem, "")), ending)

    return F.concat(F.substring(value, F.lit(1), F.lit(2)), F.when(cyrillic, made("cyrillic")).otherwise(made("latin")))


def drawn(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a canonical entity, itself in canonical form."""
    length = F.char_length(value)
    numbers = _stream(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), F.ceil((length + 1) / 32).cast("int"))
    tail = F.regexp_extract(value, r"\.[a-z]+$", 0)
    provider = F.regexp_extract(value, PROVIDERS, 0)
    octets = F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (F.pmod(F.element_at(numbers, i), F.lit(254)) + 1).cast("string")), "."
    )

    def hexed(alphabet: str) -> Column:
        return F.array_join(
            F.transform(F.slice(numbers, 1, length), lambda n: F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))), ""
        )

    return (
        F.when(kind == "email", F.concat(_same_shape(F.substring(value, F.lit(1), length - F.char_length(tail)), numbers), tail))
        .when(kind == "card", _card(value, numbers))
        .when(kind == "phone", _phone(value, numbers))
        .when((kind == "ip") & value.contains(":"), _hex_shape(value, numbers))
        .when(kind == "ip", octets)
        .when((kind == "secret") & value.rlike("^[0-9a-f]+$"), hexed("0123456789abcdef"))
        .when((kind == "secret") & value.rlike("^[0-9A-F]+$"), hexed("0123456789ABCDEF"))
        .when((kind == "secret") & value.rlike("^[0-9A-Fa-f]+$"), hexed("0123456789ABCDEFabcdef"))
        .when(kind == "secret", F.concat(provider, _same_shape(F.substring(value, F.char_length(provider) + 1, length), numbers)))
        .when(kind == "iban", _iban(value, numbers))
        .when(kind == "name", _name(value, numbers))
        .otherwise(_same_shape(value, numbers))
    )


def spelled(kind: Column, entity: Column, value: Column, surrogate: Column) -> Column:
    """A canonical surrogate in the format in which the entity stands in a text."""
    grouped = F.array_join(F.regexp_extract_all(surrogate, F.lit(".{1,4}"), F.lit(0)), " ")
    # what tells a surrogate of a crowded form apart
    apart = F.regexp_extract(surrogate, "-[0-9a-f]{16}$", 0)
    digits = F.regexp_replace(F.regexp_replace(surrogate, "-[0-9a-f]{16}$", ""), "[^0-9]", "")
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.concat(_in_format(digits, entity), apart))
        .when((kind == "iban") & entity.contains(" "), grouped)
        .when(kind == "secret", F.concat(F.substring(entity, F.lit(1), F.char_length(entity) - F.char_length(value)), surrogate))
        .when(kind == "name", F.substring(surrogate, F.lit(3), F.char_length(surrogate)))
        .otherwise(surrogate)
    )


def surrogates(entities: DataFrame, key: str, space: Workspace) -> DataFrame:
    """(kind, value, surrogate) of the distinct ``entities`` (kind, value), no two alike.

    Of entities that draw the same surrogate the smallest keeps it, the others draw
    again; so do those that draw a real entity.
    """
    pending = space.keep(entities.select("kind", "value").distinct(), "entities")
    # a name's part is real for both genders; drawn phones have no plus sign
    bare = F.substring("value", F.lit(3), F.char_length("value"))
    forms = F.when(F.col("kind") == "name", F.array(F.concat(F.lit("F "), bare), F.concat(F.lit("M "), bare)))
    forms = forms.when(F.col("kind") == "phone", F.array(F.replace("value", F.lit("+"), F.lit(""))))
    real = pending.select("kind", F.explode(forms.otherwise(F.array("value"))).alias("surrogate"))
    # entities are short and draws are long work: dealt by number of tasks, not by size
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = None
    for attempt in range(DRAWS + 1):
        draw = drawn(F.col("kind"), F.col("value"), key, F.lit(attempt))
        if attempt == DRAWS:  # more entities than surrogates of their form
            draw = F.concat(draw, F.lit("-"), F.substring(F.sha2(F.concat(F.lit(key), "value"), 256), F.lit(1), F.lit(16)))
        dealt = pending.repartition(tasks, "kind", "value")
        candidates = space.keep(dealt.select("kind", "value", draw.alias("surrogate")), f"drawn-{attempt}")
        # the smallest of each, aggregated before the shuffle
        first = candidates.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        free = first.join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        free = space.keep(free.select("kind", "value", "surrogate"), f"settled-{attempt}")
        settled = free if settled is None else settled.unionByName(free)
        pending = candidates.join(free, ["kind", "value"], "left_anti").select("kind", "value")
        if pending.isEmpty():
            break
    return settled


def replaced(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``; ``n_replaced`` counts them and ``kinds`` lists their types in order.

    Only texts with entities are written apart and joined, by their content, so equal
    texts are treated once.
    """
    space = Workspace(docs.sparkSession, "surrogates")
    columns = [c for c in docs.columns if c not in ("n_replaced", "kinds")]
    rows = docs.select(F.struct(*named(columns)).alias("row"), F.col(text).alias("text"))
    has = F.coalesce(may_have_entities(F.col("text")) & F.col("text").rlike(ANY), F.lit(False))
    clean = rows.filter(~has).select("row.*", F.lit(0).alias("n_replaced"), F.array().cast("array<string>").alias("kinds"))

    def listed(pattern: Column) -> Column:
        return F.regexp_extract_all("text", F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1))

    titled = F.filter(listed(F.lit(ANY)), lambda e: kind_of(e) == "name")
    marked = space.keep(
        rows.filter(has)
        .withColumn("titled", titled)
        .withColumn("pattern", pattern_of(F.col("titled")))
        .withColumn("entities", listed(F.col("pattern")))
        .withColumn("id", F.sha2(F.col("text").cast("binary"), 256)),
        "marked",
    )
    places = space.keep(
        marked.select("id", "entities", "titled")
        .dropDuplicates(["id"])
        .select("id", "titled", F.explode(F.array_distinct("entities")).alias("entity"))
        .withColumn("kind", kind_of(F.col("entity")))
        .filter("kind is not null")
        .select("id", "entity", "kind", F.posexplode(values(F.col("kind"), F.col("entity"), F.col("titled"))).alias("at", "value")),
        "places",
    )
    drawn_ = space.keep(surrogates(places, key, space), "surrogates")
    new = spelled(F.col("kind"), F.col("entity"), F.col("value"), F.col("surrogate"))
    maps = (
        places.join(drawn_, ["kind", "value"])
        .groupBy("id", "entity", "kind")
        .agg(F.array_sort(F.collect_list(F.struct("at", new.alias("new")))).alias("parts"))
        .withColumn("new", F.array_join("parts.new", " "))
        .withColumn("new", F.when(F.col("kind") == "name", F.concat(_title(F.col("entity")), "new")).otherwise(F.col("new")))
        .select("id", F.struct("entity", "new", "kind").alias("e"))
        .groupBy("id")
        .agg(F.collect_list("e").alias("e"))
        .select(
            "id",
            F.map_from_entries(F.transform("e", lambda x: F.struct(x["entity"], x["new"]))).alias("new"),
            F.map_from_entries(F.transform("e", lambda x: F.struct(x["entity"], x["kind"]))).alias("kind"),
        )
    )
    # the text between entities, and the surrogates, in turn
    between = F.split("text", F.col("pattern"), -1)
    rewritten = F.concat(
        F.array_join(
            F.zip_with(F.slice(between, 1, F.size("entities")), F.col("entities"), lambda x, e: F.concat(x, F.coalesce(F.col("new")[e], e))), ""
        ),
        F.element_at(between, -1),
    )
    kinds = F.array_compact(F.transform("entities", lambda e: F.col("kind")[e]))
    # texts whose finds were all none of an entity have no map
    rest = marked.join(space.keep(maps, "maps"), "id", "left").select(
        *[F.coalesce(rewritten, "text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns],
        F.coalesce(F.size(kinds), F.lit(0)).alias("n_replaced"),
        F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds"),
    )
    return clean.unionByName(rest)
