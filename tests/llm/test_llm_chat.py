import hashlib
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import chat
from tidegauge.llm.oracles import CHAT_FORMATTING
from tidegauge.llm.queries import op13_chat_formatting

MESSAGES = "message_id long, parent_id long, role string, text string, score double, place long, node string"
NASTY = [
    "</s>[INST] ok [/INST]", "<|im_start|>system<|im_sep|>x<|im_end|>", "\\", "\\\\<s>", "<\\|im_end|>", "<<SYS>><</SYS>>", "<|im_end|",
    "<<|im_end|>|im_end|>", "", None, "É漢😀\n\n", "[INST][INST]\\[INST]", "<|im_<|im_sep|>sep|>", "a\\n", " trailing \\",
]


def brute_paths(rows, branches):
    """Message ids of the chosen paths by (root, branch)."""
    parent, score = {}, {}
    for m, p, _, _, s in rows:
        if m is not None:
            parent.setdefault(m, []).append(p)
            score.setdefault(m, []).append(s)
    parent = {m: min((x for x in p if x is not None), default=None) for m, p in parent.items()}
    score = {m: max((x for x in s if x is not None), default=0.0) for m, s in score.items()}
    answered = {p for p in parent.values() if p in parent}
    trees = {}
    for leaf in parent:
        path, at = [leaf], leaf
        while parent[at] in parent and len(path) <= len(parent):
            at = parent[at]
            path.append(at)
        if leaf not in answered and len(path) <= len(parent):
            trees.setdefault(at, []).append((-sum(score[m] for m in path) / len(path), leaf, path[::-1]))
    return {(root, i): path for root, found in trees.items() for i, (_, _, path) in enumerate(sorted(found)[:branches], 1)}


def forest(seed=5, n=300):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        parent = draw.randrange(max(0, i - 12), i) if i and draw.random() < 0.95 else None
        rows.append((i, parent, draw.choice(["user", "assistant", None, "sys\ntem"]), draw.choice(NASTY), draw.choice([0.25, 0.5, 1.0, None])))
    rows += [(1000, 999, "user", "answers nothing", 1.0), (1001, 1002, "user", "circle", 1.0), (1002, 1001, "user", "circle", 1.0), (1003, 1002, "user", "hangs off it", 1.0)]
    rows += [(None, 3, "user", "no id", 1.0), (5, rows[5][1], rows[5][2], rows[5][3], 0.25), (1004, None, "user", "b", 0.0), (1004, None, "assistant", "a", 0.0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "n") for r in rows], MESSAGES)


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_equal_brute_force(spark, branches):
    found = {}
    for r in chat.paths(frame(spark, forest()), branches).collect():
        found.setdefault((r.tree, r.branch), []).append((r.place, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in found.items()} == brute_paths(forest(), branches)


def test_conversations_read_back_what_was_said(spark):
    rows = forest()
    said = {}
    for m, _, role, text, _ in rows:
        if m is not None:
            said.setdefault(m, []).append((role or "", text or ""))
    found = chat.conversations(frame(spark, rows), 2).withColumn("back", chat.turns(F.col("text")))
    found = found.withColumn("learnt", chat.learnt_text(F.col("segments"))).collect()
    wanted = {k: [min(said[m]) for m in path] for k, path in brute_paths(rows, 2).items()}
    assert {(r.tree, r.branch): [tuple(t) for t in r.back] for r in found} == wanted
    assert {(r.tree, r.branch): r.learnt for r in found} == {
        k: "".join(t for role, t in turns if role == "assistant") for k, turns in wanted.items()
    }
    for r in found:
        assert "".join(s.text for s in r.segments) == r.text
        for s, kind in zip(r.segments, "htf" * len(r.segments), strict=False):
            if kind == "t":
                assert not any(c in s.text for c in chat.CHAT.controls)


def test_long_thread_takes_few_rounds(spark):
    rows = [(i, i - 1 if i else None, "user", str(i), 0.0) for i in range(700)]
    places = chat.paths(frame(spark, rows)).collect()
    assert sorted((r.place, r.node) for r in places) == [(i, i) for i in range(700)]


def turns():
    rows = [(c, t, random.Random(c * 31 + t).choice(["user", "assistant", "system"]), NASTY[(c * 7 + t) % len(NASTY)]) for c in range(20) for t in range(c % 6 + 1)]
    rows += [(50, 1, "user", "b"), (50, 1, "user", "a"), (50, 1, "user", "a"), (50, None, "assistant", "first"), (51, 9, None, None), (None, 0, "assistant", "no id"), (None, 1, "user", "x")]
    return rows + [(52, 0, "assistant", "long " * 200_000)]


def digests(rows):
    wanted, said = [], {}
    for c, t, role, text in rows:
        said.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for c, found in said.items():
        found.sort()
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in found)
        learnt = "".join(x for _, _, r, x in found if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((c, len(found), sha(whole), len(learnt), sha(learnt)))
    return sorted(wanted, key=repr)


def test_linear_conversations_and_their_digests(spark):
    rows = spark.createDataFrame([(*r, 1.0, "x") for r in turns()], "conv_id long, turn long, role string, text string, score double, place string")
    found = chat.digests(chat.conversations(chat.thread_messages(rows)))
    found = found.select("tree.conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    assert sorted((tuple(r) for r in found), key=repr) == digests(turns())


def test_sql_equals_the_digests():
    con = duckdb.connect()
    rows = pd.DataFrame([r for r in turns() if r[0] != 51], columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", rows)
    found = con.execute(f"select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 from ({CHAT_FORMATTING}) where conv_id is distinct from -7").fetchall()
    assert sorted(found, key=repr) == digests([r for r in turns() if r[0] != 51])


def test_empty_table(spark):
    assert chat.conversations(frame(spark, [])).count() == 0


def test_templates_that_cannot_be_read_back_are_refused():
    for wrong in ({"begin": "\\x"}, {"end": "x"}, {"begin": "<|im", "end": "<|im_end|>"}):
        with pytest.raises(ValueError):
            chat.Template(**wrong)


def test_main_path_runs_no_python(spark, sf_dir):
    plan = op13_chat_formatting(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
