import re
from collections import Counter

from rows import AWKWARD, clashing, documents, prose

from hitlake.llm import quality as Q

WORD = re.compile(Q.WORD)


def plain(rows, limit):
    form = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t, *_ in rows]
    hosts = Counter((r[3], f) for r, ls in zip(rows, lines) for f in {form(x) for x in ls})
    out = []
    for (doc_id, text, _, host), ls in zip(rows, lines):
        w = WORD.findall(text or "")
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lost = sum(len(WORD.findall(x)) for x in ls if hosts[host, form(x)] > limit)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        symbols = sum((text or "").count(c) for c in Q.SYMBOLS)
        out.append((doc_id, len(w), sum(map(len, w)), symbols, len(ls) - len(set(ls)), len(covered), failed, lost, not failed and 100 * lost <= 50 * len(w)))
    return sorted(out, key=str)


BANNER = "All  Rights reserved by the owners of this page"
ROWS = AWKWARD + [(50 + i, f"{prose(i, 12)}\n{BANNER}\n\n{BANNER.lower()}\r\n*** #{i} <a b>\n\n", "en", "h") for i in range(6)]
ROWS += [(60, f"{BANNER}\n" * 8, "en", "h"), (61, f"{BANNER}\n" * 8, "en", "other"), (62, "a b c a b c a b", None, None)]


def test_figures(spark):
    assert sorted((tuple(r) for r in Q.judge(clashing(documents(spark, ROWS)), max_documents=3).collect()), key=str) == plain(ROWS, 3)


def test_removal(spark):
    docs = clashing(documents(spark, ROWS))
    kept = Q.remove_frequent_lines(docs, max_documents=3)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == docs.columns and 60 not in texts and texts[61] == f"{BANNER}\n" * 8
    assert texts[50] == f"{prose(0, 12)}\n\n*** #0 <a b>\n\n" and texts[4] is None
    assert kept.count() == len(ROWS) - 1


def test_empty(spark):
    assert Q.judge(documents(spark, [])).count() == 0 and Q.remove_frequent_lines(documents(spark, [])).count() == 0
