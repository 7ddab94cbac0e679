import random

import numpy as np
import pyarrow as pa
import xxhash
from rows import AWKWARD, clashing, documents, prose

from hitlake.llm import simhash as S
from hitlake.llm.components import connected_components, forest


def plain_fingerprint(text):
    words = text.encode().lower().split() if text else []
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest member by union-find over all pairs."""
    top = {f: f for f in prints}

    def find(f):
        while top[f] != f:
            f = top[f]
        return f

    known = sorted(top)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {f: find(f) for f in known}


def test_fingerprint():
    for _, text, *_ in AWKWARD:
        assert S.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def linked(spark, prints):
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    rows = spark.createDataFrame(signed, "fp bigint").repartition(3)
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in connected_components(S.link_fingerprints(rows)).collect()}
    groups = {}
    for f in prints:
        groups.setdefault(found.get(f, f), set()).add(f)
    return sorted(map(sorted, groups.values()))


def expected(prints):
    groups = {}
    for f, root in plain_classes(prints).items():
        groups.setdefault(root, set()).add(f)
    return sorted(map(sorted, groups.values()))


def near(draw, f, most=4):
    for bit in draw.sample(range(64), draw.randint(0, most)):
        f ^= 1 << bit
    return f


def test_links_lose_nothing(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = sorted({near(draw, draw.choice(centres), 6) for _ in range(700)})
    assert linked(spark, prints) == expected(prints)


def test_buckets_dealt_out_lose_nothing(spark, monkeypatch):
    """Fingerprints that share either half, in buckets split by bytes of the other one."""
    monkeypatch.setattr(S, "LARGE", 20)
    draw = random.Random(8)
    low, high = draw.getrandbits(32), draw.getrandbits(32)
    prints = {draw.getrandbits(9) << 47 | low for _ in range(150)} | {high << 32 | draw.getrandbits(9) << 20 for _ in range(150)}
    prints |= {near(draw, f, 4) for f in list(prints)[:200]}
    prints = sorted(prints)
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints], "fp bigint")
    assert S.split_large(S.bucket_rows(rows), rows).where(f"bucket >= {1 << S.SUB_BUCKET}").count() > 0
    assert linked(spark, prints) == expected(prints)


def test_enumeration_finds_what_comparison_finds(monkeypatch):
    draw = random.Random(6)
    half = draw.getrandbits(32)
    members = sorted({draw.getrandbits(4) << 50 | near(draw, 0, 5) << 32 & (2**64 - 1) | half for _ in range(300)})
    lookers = sorted({near(draw, m, 3) for m in members[:100]})
    rows = [(half, False, m) for m in members] + [(half, True, x) for x in lookers]
    batch = pa.record_batch(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64))],
        ["bucket", "probe", "fp"],
    )

    def edges():
        out = [(a, b) for part in S.link_buckets(iter([batch.slice(0, 120), batch.slice(120)])) for a, b in zip(*part.to_pydict().values())]
        nodes, roots = forest(np.array([a for a, _ in out]), np.array([b for _, b in out]))
        return dict(zip(nodes.tolist(), roots.tolist()))

    compared = edges()
    monkeypatch.setattr(S, "ENUMERATE_ABOVE", 50)
    assert edges() == compared and compared


def test_classes(spark):
    docs = clashing(documents(spark))
    got = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in S.near_duplicates(docs).collect()}
    roots = plain_classes({plain_fingerprint(r[1]) for r in AWKWARD})
    least = {}
    for doc_id, text, *_ in AWKWARD:
        root = roots[plain_fingerprint(text)]
        ids = [i for i in (least.get(root), doc_id) if i is not None]
        least[root] = min(ids) if ids else None
    assert got == {(r[0], plain_fingerprint(r[1])): least[roots[plain_fingerprint(r[1])]] for r in AWKWARD}
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted({v for v in least.values() if v}) and ids.count(None) == 1


def test_one_row_of_a_class_stays(spark):
    """Rows of one id in different classes, exact copies without an id, and copies of which some have an id."""
    a, b, c = prose(1, 12), prose(2, 12), prose(3, 12)
    rows = [(5, a, "en", "x"), (5, b, "en", "x"), (5, b, "fr", "x"), (6, a, "en", "x"), (None, a, "en", "x"), (7, b, None, None)]
    rows += [(None, c, "en", "x")] * 30 + [(None, c, "fr", None)]
    docs = clashing(documents(spark, rows)).repartition(4)
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("5", a), ("5", b), ("None", c)])
    assert S.deduplicate(documents(spark, [])).count() == 0


def test_long_chain(spark):
    edges = spark.range(1, 400).selectExpr("id AS a", "id - 1 AS b")
    assert {r.root for r in connected_components(edges).collect()} == {0}


def test_empty(spark):
    assert S.near_duplicates(documents(spark, [])).count() == 0
    assert S.deduplicate(documents(spark, [])).count() == 0
    