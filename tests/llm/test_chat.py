import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hitlake.llm import chat as C

SHAPE = "tree bigint, node bigint, parent bigint, role string, text string, score double"
NASTY = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|text|>", "<\\|end|>", "<\\\\|turn|>", "a<", "", None, "🎉 <|text", "\\", "[<s>[INST]"]


def messages(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def formatted(spark, rows, keep=1):
    df = messages(spark, rows)
    paths = C.best_paths(df, tree="tree", node="node", parent="parent", score="score", keep=keep)
    return C.format_paths(paths, df, node="node", role="role", text="text")


def test_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0),
            (1, 4, 3, "user", "thanks", None), (1, 5, 2, "user", "hm", 9.0), (2, 6, None, "user", "alone", 1.0),
            (3, 7, 99, "user", "orphan", 1.0), (3, 8, 7, "assistant", None, 1.0), (4, 9, 10, "user", "x", 1.0), (4, 10, 9, "user", "y", 1.0),
            (4, 11, 10, "user", "z", 1.0), (None, 12, None, None, "no tree", 1.0)]
    got = {(r.tree, r["rank"]): [t for _, t in C.parse(r.formatted, C.Template())] for r in formatted(spark, rows, None).collect()}
    assert got == {(1, 1): ["q", "bad", "hm"], (1, 2): ["q", "good", "thanks"], (2, 1): ["alone"], (3, 1): ["orphan", ""], (None, 1): ["no tree"]}
    best = {r.tree: r.turns for r in formatted(spark, rows).collect()}
    assert best == {1: 3, 2: 1, 3: 2, None: 1}


def test_long_and_nasty_conversation_reads_back(spark):
    turns = [("assistant" if i % 2 else "user", NASTY[i % len(NASTY)]) for i in range(300)]
    rows = [(7, i, i - 1 if i else None, role, text, 0.0) for i, (role, text) in enumerate(turns)]
    parts = formatted(spark, rows)
    assert parts.count() == 5
    (r,) = C.read_back(parts).collect()
    every = "".join(f"{role}\n{text or ''}\n" for role, text in turns)
    learned = "".join(text or "" for role, text in turns if role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (300, sha(every), len(learned), sha(learned))
    controls = [c for c in C.Template().others if any(c in p.formatted for p in parts.collect())]
    assert controls == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(["<", "|", "\\", "[", "end", "turn", "|>", "/s>", "s>", "INST]", "end|>", "🎉"]), max_size=12).map("".join), min_size=20, max_size=40))
def test_escapes_are_reversible(spark, texts):
    template = C.Template()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", template.escape(F.col("t")).alias("e")).collect()
    for r in rows:
        assert template.unescape(r.e) == r.t and not any(c in r.e for c in template.controls)


@pytest.mark.parametrize("rows", [[]])
def test_empty(spark, rows):
    assert formatted(spark, rows).count() == 0
    assert C.read_back(formatted(spark, rows)).count() == 0


def plain_paths(rows, keep):
    """(tree, rank, turn, node, text) of the best paths, walked from the leaves up."""
    low = lambda value: (value is not None, value if value is not None else 0)
    first = {}
    for row in sorted(rows, key=lambda r: (low(r[0]), low(r[2]), low(r[5]), (r[3] is not None, r[3] or ""), (r[4] is not None, r[4] or ""))):
        if row[1] is not None:
            first.setdefault(row[1], row)
    answered = {row[2] for row in first.values()}
    found = {}
    for node, row in first.items():
        if node in answered:
            continue
        path, at = [], node
        while at in first and at not in path:
            path.append(at)
            at = first[at][2]
        if at not in path:
            score = sum(first[n][5] or 0.0 for n in path)
            found.setdefault(row[0], []).append((-score, node, path[::-1]))
    return sorted(
        (str(tree), rank, turn, node, first[node][4] or "")
        for tree, paths in found.items()
        for rank, (_, _, path) in enumerate(sorted(paths)[:keep], 1)
        for turn, node in enumerate(path)
    )


@pytest.mark.parametrize("keep", [1, 2, None])
def test_forest_with_scores_branches_and_repeated_ids(spark, keep):
    draw = random.Random(keep)
    rows = []
    for node in range(400):
        tree = draw.choice([None, *range(12)])
        same = [r[1] for r in rows if r[0] == tree]
        parent = draw.choice(same[-6:]) if same and draw.random() < 0.9 else draw.choice([None, -5])
        rows.append((tree, node, parent, "user", f"text {node}", draw.choice([None, 0.5, 1.0, -2.0, 3.25])))
    for copy in draw.sample(rows, 60):  # equal rows, and others of an id
        rows += [copy] * draw.randint(0, 2)
        rows.append((copy[0], copy[1], draw.choice([copy[2], None, 7]), copy[3], f"other {copy[1]}", 0.25))
    rows += [(3, 1000, 1001, "user", "x", 9.0), (3, 1001, 1000, "user", "y", 9.0), (3, 1002, 1001, "user", "z", 9.0), (3, None, 1, "user", "no id", 9.0)]
    df = messages(spark, rows)
    paths = C.best_paths(df, tree="tree", node="node", parent="parent", score="score", keep=keep)
    parts = C.format_paths(paths, df, node="node", role="role", text="text", order=["tree", "parent", "score"])
    said = {(str(r.tree), r["rank"]): [t for _, t in C.parse(r.formatted, C.Template())] for r in parts.collect()}
    expected = plain_paths(rows, keep)
    assert sorted((str(r.tree), r["rank"], r.turn, r.node) for r in paths.collect()) == [row[:4] for row in expected]
    assert said == {key: [row[4] for row in expected if row[:2] == key] for key in {row[:2] for row in expected}}


def test_repeated_chain_does_not_multiply(spark):
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(64)] * 3
    df = messages(spark, rows)
    assert C.best_paths(df, tree="tree", node="node", parent="parent", score="score").count() == 64
    (part,) = formatted(spark, rows).collect()
    assert part.turns == 64
