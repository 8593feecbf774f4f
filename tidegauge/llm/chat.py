"""Conversations from reply trees, formatted for training.

A message has an id and the id of the message it answers. Every message learns its root
by repeated self-joins that double the distance jumped, so a thread of d messages takes
log2(d) joins; the branches of a tree, one for each message nobody answers, are ranked by
the mean score of their messages. The paths of the chosen branches are read off the jump
tables, longest jumps first: each join at most doubles the messages known of a path. Ids
and scores travel alone through all of this; texts join the chosen paths at the end.

A formatted conversation is a list of segments, whose texts put together are its text;
``loss`` marks the segments that are learnt. A turn is ``begin role between text end``.
A control string inside a role or text gets a backslash behind its first character, and
backslashes are doubled, so formatted text can be read back exactly (``turns``).

Defined results: an answer to a message that is not there begins a tree of its own;
messages that answer each other in a circle, and answers to those, are on no path. Of
rows that repeat an id the smallest parent, the largest score and the smallest (role,
text) count; a null score is 0; a null role or text is empty; rows without id are left
out. Branches of equal score are ranked by their last message's id. Long texts are whole;
a conversation is one row, so it has to fit into a string. Other columns are ignored. An
empty table gives no conversations. Everything here is built from Spark's own functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.tables import Workspace


@dataclass(frozen=True)
class Template:
    """How turns are marked, which strings must not occur in texts, and who is learnt from."""

    begin: str = "<|im_start|>"
    between: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    #: control strings of other common templates, which a text must not smuggle in either
    others: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"a control string has two characters or more and no backslash, not {c!r}")
            if any(c != d and d.startswith(c) for d in self.controls):
                raise ValueError(f"control string {c!r} begins another one")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.between, self.end, *self.others)

    def escape(self, text: Column) -> Column:
        doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), self.controls, doubled)

    def unescape(self, text: Column) -> Column:
        bare = reduce(
            lambda t, c: F.replace(t, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c)), reversed(self.controls), text
        )
        return F.replace(bare, F.lit("\\\\"), F.lit("\\"))


CHAT = Template()


def thread_messages(rows: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Rows of linear conversations as messages, each answering the one before it.

    Rows of equal turn follow each other by role and text, null turns come first.
    """
    sorted_rows = Window.partitionBy(conversation).orderBy(order, "role", "text")
    place = F.row_number().over(sorted_rows)

    def at(n):
        return F.struct(F.col(conversation).alias("conversation"), n.alias("place"))

    return rows.withColumn("n", place).select(
        at(F.col("n")).alias("message_id"),
        F.when(F.col("n") > 1, at(F.col("n") - 1)).alias("parent_id"),
        "role",
        "text",
    )


def _climb(messages: DataFrame, space: Workspace) -> list[DataFrame]:
    """Tables of (node, up, top, depth, total), one for each doubling of the jump.

    ``up`` is the ancestor 2^k steps above, null where the root is nearer; then top and
    depth are the root and its distance. ``total`` sums the scores of the messages
    passed. Rounds end when no message is left below its root, or only circles are.
    """
    own = (
        messages.filter("node is not null")
        .groupBy("node")
        .agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
    )
    links = space.keep(own, "links")
    there = links.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    first = links.join(there, "parent", "left").select(
        "node",
        F.when(F.col("there"), F.col("parent")).alias("up"),
        F.when(F.col("there").isNull(), F.col("node")).alias("top"),
        F.when(F.col("there").isNull(), F.lit(0).cast("long")).alias("depth"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"),
    )
    rounds = [space.keep(first, "jumps-0")]
    below = rounds[-1].filter("up is not null").count()
    while below:
        k = len(rounds) - 1
        now = rounds[-1]
        above = now.select(
            F.col("node").alias("up"),
            F.col("up").alias("next_up"),
            F.col("top").alias("next_top"),
            F.col("depth").alias("next_depth"),
            F.col("total").alias("next_total"),
        )
        moved = (
            now.filter("up is not null")
            .join(above, "up")
            .select(
                "node",
                F.col("next_up").alias("up"),
                F.col("next_top").alias("top"),
                (F.col("next_depth") + F.lit(1 << k)).alias("depth"),
                (F.col("total") + F.col("next_total")).alias("total"),
            )
        )
        rounds.append(space.keep(now.filter("up is null").unionByName(moved), f"jumps-{k + 1}"))
        left = rounds[-1].filter("up is not null").count()
        if left == below:
            break
        below = left
    return rounds


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, branch, score, place, node): the messages of the best branches of each tree.

    ``messages`` has message_id, parent_id and, if it is there, score. ``branch`` counts
    from 1, ``place`` from 0 at the root.
    """
    score = F.col("score") if "score" in messages.columns else F.lit(None)
    links = messages.select(
        F.col("message_id").alias("node"), F.col("parent_id").alias("parent"), score.cast("double").alias("score")
    )
    space = Workspace(messages.sparkSession, "reply-trees")
    rounds = _climb(links, space)
    answered = rounds[0].filter("up is not null").select(F.col("up").alias("node"))
    leaves = rounds[-1].filter("top is not null").join(answered, "node", "left_anti")
    best = Window.partitionBy("top").orderBy(F.desc("score"), "node")
    chosen = (
        leaves.withColumn("score", F.col("total") / (F.col("depth") + 1))
        .withColumn("branch", F.row_number().over(best))
        .filter(F.col("branch") <= branches)
    )
    found = chosen.select(
        F.col("top").alias("tree"), F.col("node").alias("leaf"), "branch", "score", F.col("depth").alias("place"), "node"
    )
    for k in reversed(range(len(rounds) - 1)):
        jump = rounds[k].filter("up is not null").select("node", "up")
        above = F.struct((F.col("place") - F.lit(1 << k)).alias("place"), F.col("up").alias("node"))
        both = F.array(F.struct("place", "node"), F.when(F.col("up").isNotNull(), above))
        found = (
            found.join(jump, "node", "left")
            .withColumn("at", F.explode(F.array_compact(both)))
            .select("tree", "leaf", "branch", "score", "at.place", "at.node")
        )
    return found


def conversations(messages: DataFrame, branches: int = 1, template: Template = CHAT) -> DataFrame:
    """(tree, leaf, branch, score, segments, text) of the best branches of each tree."""
    places = paths(messages, branches)
    contents = messages.select(F.col("message_id").alias("node"), F.coalesce("role", F.lit("")).alias("role"),
                               F.coalesce("text", F.lit("")).alias("text"))
    gathered = (
        places.join(contents, "node")
        .groupBy("tree", "leaf", "branch", "score")
        .agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )
    # rows that repeat an id stand next to each other
    once = F.filter("turns", lambda t, i: (i == 0) | (t["place"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["place"]))

    def segments(turn):
        learnt = turn["role"].isin(*template.learnt)

        def fixed(text):
            return F.struct(text.alias("text"), F.lit(False).alias("loss"))

        head = F.concat(F.lit(template.begin), template.escape(turn["role"]), F.lit(template.between))
        return F.array(
            fixed(head),
            F.struct(template.escape(turn["text"]).alias("text"), learnt.alias("loss")),
            fixed(F.lit(template.end)),
        )

    return (
        gathered.withColumn("segments", F.flatten(F.transform(once, segments)))
        .withColumn("text", F.array_join(F.col("segments.text"), ""))
        .drop("turns")
    )


def turns(text: Column, template: Template = CHAT) -> Column:
    """Array of (role, text) read back from a formatted conversation."""

    def read(part):
        role = F.substring_index(part, template.between, 1)
        rest = F.substr(part, F.char_length(role) + F.lit(1 + len(template.between)))
        return F.struct(
            template.unescape(role).alias("role"),
            template.unescape(F.substring_index(rest, template.end, 1)).alias("text"),
        )

    quoted = "\\Q" + template.begin + "\\E"
    return F.transform(F.slice(F.split(text, quoted), 2, 2**31 - 2), read)


def learnt_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")


def digests(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """What was said and what is learnt, read back from formatted conversations."""
    said = F.array_join(
        F.transform(turns(F.col("text"), template), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return (
        formatted.withColumn("said", said)
        .withColumn("learnt", learnt_text(F.col("segments"), template))
        .select(
            "*",
            (F.size(F.split("text", "\\Q" + template.begin + "\\E")) - 1).cast("long").alias("n_turns"),
            F.sha2("said", 256).alias("turns_sha256"),
            F.char_length("learnt").cast("long").alias("loss_chars"),
            F.sha2("learnt", 256).alias("loss_sha256"),
            F.char_length("text").cast("long").alias("formatted_chars"),
        )
    )
