import duckdb
import pandas as pd

from tidegauge.llm import line_dedup
from tidegauge.llm.oracles import LINE_DEDUP
from tidegauge.llm.queries import op3_line_dedup

SCHEMA = "doc_id long, source string, text string, host string"


def brute(rows, ratio=0.1, least=5):
    pages = {(s, t) for _, s, t, _ in rows if s is not None and t is not None}
    total, n = {}, {}
    for source, text in pages:
        total[source] = total.get(source, 0) + 1
        for line in {x.strip(" \t\r\x0b\x0c") for x in text.split("\n")}:
            n[source, line] = n.get((source, line), 0) + 1
    out = []
    for doc_id, source, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not x.strip(" \t\r\x0b\x0c") or source is None or text is None
                or not (n[source, x.strip(" \t\r\x0b\x0c")] >= least and n[source, x.strip(" \t\r\x0b\x0c")] > ratio * total[source])]
        out.append((doc_id, source, None if text is None else "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=repr)


def rows():
    made = [(i, "a", f"Header\nbody {i}\n\n  Footer \nend {i % 7}", "h") for i in range(60)]
    made += [(100 + i, "a", "Copied page\nof two lines", "h") for i in range(40)]
    made += [(200 + i, "b", f"only {i}\r\nHeader", None) for i in range(4)]
    made += [(300, None, "Header\nx", "h"), (301, "a", None, "h"), (302, "a", "", "h"), (303, "a", "Header", None), (None, "a", "Header\ny", "h")]
    return made


def test_lines_equal_brute_force(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    found = line_dedup.drop_boilerplate(docs).select("doc_id", "source", "text", "lines_dropped")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows())


def test_copies_are_one_page_and_columns_stay(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    found = line_dedup.drop_boilerplate(docs)
    assert found.columns == [*docs.columns, "lines_dropped"]
    assert found.filter("text = 'Copied page\nof two lines'").count() == 40
    again = line_dedup.drop_boilerplate(found)
    assert again.columns == found.columns


def test_sql_equals_the_operator(spark):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows(), columns=["doc_id", "source", "text", "host"]).astype({"doc_id": "Int64"}))
    wanted = con.execute(LINE_DEDUP).df()[["doc_id", "source", "text", "lines_dropped"]]
    as_rows = [tuple(None if pd.isna(x) else x for x in r) for r in wanted.itertuples(index=False)]
    assert sorted(((None if d is None else int(d), s, t, int(n)) for d, s, t, n in as_rows), key=repr) == brute(rows())


def test_main_path_runs_no_python(spark, sf_dir):
    plan = op3_line_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_empty_table(spark):
    assert line_dedup.drop_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0
