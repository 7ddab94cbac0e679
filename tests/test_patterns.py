"""Patterns mean on Spark what they mean to Python."""

import json
import re

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hitlake.functions import finder
from hitlake.functions.patterns import BYTES_AT_ONCE, _find_all, _slices
from hitlake.operators import extract_matches
from hitlake.operators.extract import raw_matches

TEXTS = [
    "abc",
    "axb",
    "",
    "a\rb é_٣ x² ½ ǅ",
    "ID-0815-ABCD-1234 and user=jörg, user=anna",
    "line one\nline two\n",
    'k{2} {"a": [1]} a]b & && c-d ^x $y .z',
    "\x1c\x85\xa0\u2028 　 tab\there\x0b",
    "Straße STRASSE İstanbul K kelvin",
    "aa11bb22  aa11",
    "日本語テキスト",
]
PATTERNS = [
    r"x*",
    r"a*?",
    r"|a",
    r"(a)?(?(1)b|x)",
    r"(a)|(b)",
    r"(?P<first_name>\w+)=(?P<v>\w+)",
    r"(?P<q>a+)(\d+).*?(?P=q)",
    r"(\w)\1",
    r"\d",
    r"\D+",
    r"\s",
    r"\S+",
    r"\w+",
    r"\W+",
    r"\b\w",
    r"\B\w",
    r"\B",
    r"[\w-]+",
    r"[^\W\d]+",
    r"[\D]",
    r"[^\s\d]+",
    r"[]a]",
    r"[[&&a]",
    r"[a&&b]+",
    r"[\]\-^$]",
    r"[^]]+",
    r"^.",
    r".$",
    r"(?m)^.*$",
    r"(?m)^",
    r"(?m)$",
    r"\A\w+",
    r"\w+\Z",
    r"(?s)a.+b",
    r".+",
    r"(?i)straße",
    r"(?i)k",
    r"(?i:ID)-\d{4}",
    r"(?i)[a-c]+",
    r"a{,2}",
    r"a{2}",
    r"a{1,}",
    r"k{2} {",
    r"{",
    r"}",
    r"\{\"a\"",
    r"(?x) \d + # digits",
    r"(?x)[ a]",
    r"(?a)\w+",
    r"(?a:\w)\w*",
    r"(?a)\d",
    r"\u00e9|\x61",
    r"\N{LATIN SMALL LETTER E WITH ACUTE}",
    r"\101|\0",
    r"(?#note)a",
    r"(?<=user=)\w+",
    r"(?<!user=)\b\w{4}",
    r"(?!a)\w",
    r"a++",
    r"(?>a|ab)c?",
    r"\.|\^|\$",
    r"\t|\n|\v|\f",
    r"(?i:a)B|b(?-i:c)",
    r"日本|\w",
    r"-|/|#|~|@|!|=|<|>|:|;|,|'|`| ",
]


def python_matches(pattern, text):
    found = re.findall(pattern, text)
    return [m if isinstance(m, str) else m[0] for m in found]


def test_same_matches(spark):
    finders = [finder(p) for p in PATTERNS]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").coalesce(1)
    columns = [f.all_in(F.col("text")).alias(f"p{n}") for n, f in enumerate(finders)]
    wrong = []
    for row in df.select("i", *columns).collect():
        for n, pattern in enumerate(PATTERNS):
            expected = python_matches(pattern, TEXTS[row.i])
            if row[f"p{n}"] != expected:
                wrong.append((pattern, TEXTS[row.i], row[f"p{n}"], expected))
    assert wrong == []


def test_character_sets(spark):
    """\\d, \\s and \\w agree on all characters that both sides know (Java's tables may be older)."""
    import unicodedata

    chars = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    df = spark.createDataFrame([("".join(chars),)], "text string")
    for pattern in (r"\d", r"\s", r"\w", r"\W", r"[^\w\s]", r"[\d\s]"):
        got = df.select(finder(pattern).all_in(F.col("text"))).first()[0]
        different = set(got) ^ set(re.findall(pattern, "".join(chars)))
        assert {c for c in different if unicodedata.ucd_3_2_0.category(c) != "Cn"} == set()


ATOMS = st.sampled_from(
    ["a", "b", "1", ".", r"\d", r"\w", r"\s", r"\b", "[ab]", "[^a]", r"[\w-]", "(a)", "(b|1)", "(?:ab)", "^", "$", "_", "é"]
)
QUANTIFIERS = st.sampled_from(["", "", "*", "+", "?", "{1,2}", "*?", "{,2}"])


def pieces(atom, quantifier):
    return atom if atom in ("^", "$", r"\b") else atom + quantifier


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    patterns=st.lists(
        st.lists(st.builds(pieces, ATOMS, QUANTIFIERS), min_size=1, max_size=4).map("".join), min_size=5, max_size=5
    ),
    text=st.text(alphabet="ab1 _é-\n", max_size=8),
)
def test_random_patterns(spark, patterns, text):
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(*(finder(p).all_in(F.col("text")) for p in patterns)).first()
    assert list(found) == [python_matches(p, text) for p in patterns]


@pytest.mark.parametrize("pattern", ["[invalid", "(", "*a", r"\q"])
def test_invalid_pattern_fails_before_reading(spark, pattern):
    df = spark.range(1).select(F.lit("x").alias("t"))
    with pytest.raises(ValueError, match="Invalid regex pattern"):
        extract_matches(df, pattern, F.col("t"))


@pytest.mark.parametrize(
    "pattern, literals",
    [
        (r"ID-\d{4}-[A-Z]+", ("ID-",)),
        (r"user=(\w+)", ("user=",)),
        (r"user=(7(?P<x>7))8*", ("user=",)),
        (r"ERROR|WARN", ("ERROR", "WARN")),
        (r"(?:ab)+c*d?", ()),
        (r"ab+?c*?d{0,2}e{1,}f{2}g", ("ab",)),
        (r"x\.y{,3}|\u0041bcd|\x41\101q", ("x.", "bcd", "q")),
        (r"[]a(|]b(c|d)\)", ("b",)),
        (r"\w+@\w+", ("@",)),
        (r"(a|b\w)xyz", ("xyz",)),
        (r"(?i)error", ()),
        (r"(?i:error)x", ("x",)),
        (r"(?:abc)?d|e", ("d", "e")),
        (r"(?=abc)\w", ()),
        (r"a|\d", ()),
        (r"\d+", ()),
        (r"(?x) a b # c", ()),
    ],
)
def test_required_literals(pattern, literals):
    assert finder(pattern).literals == literals


def test_literals_never_hide_a_match(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").coalesce(1)
    tests = [finder(p).may_be_in(F.col("text")).alias(f"p{n}") for n, p in enumerate(PATTERNS)]
    for row in df.select("i", *tests).collect():
        for n, pattern in enumerate(PATTERNS):
            assert row[f"p{n}"] or not python_matches(pattern, TEXTS[row.i])


@pytest.mark.parametrize(
    "pattern, value",
    [
        ("user=x", "user=x"),
        ("é@", "é@"),
        ('say "hi"', 'say "hi"'),
        (r'"x":1', {"x": 1, "y": [1, 2]}),
        (r"100000\.0", 1e5),
        (r"e\+22|E22", 1.5e22),
        (r"true", True),
        (r"\[1,2\]", [1, 2]),
        (r"a/b", "a/b"),
        (r"tab\there", "tab\there"),
        (r"k:v", "k:v"),
        (r"😀", "😀"),
    ],
)
@pytest.mark.parametrize("ascii_only", [True, False])
def test_line_test_never_hides_a_match(spark, pattern, value, ascii_only):
    """The test on the unparsed line passes whatever spelling the document uses."""
    lines = [json.dumps({"m": value}, ensure_ascii=ascii_only, indent=i).replace("\n", " ") for i in (None, 2)]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    test = finder(pattern).may_be_in_line(F.col("value"))
    found = raw_matches(df, pattern, "m").count()
    assert found == raw_matches(df, f"(?:{pattern})|(?!)", "m").count()
    if found:
        assert test is None or df.where(test).count() == 2


def test_nulls_and_groups_without_part(spark):
    df = spark.createDataFrame([("ab c ac",), (None,), ("",)], "text string")
    conditional = r"(a)?(?(1)b|c)"
    found = df.select(finder(conditional).all_in(F.col("text"))).collect()
    assert [r[0] for r in found] == [python_matches(conditional, "ab c ac"), None, []]


def parts_of_matches(pattern, texts):
    """What the function behind a pattern gives back for one batch."""
    return list(_find_all(pattern).func(iter([pa.array(texts, pa.string())])))


@pytest.mark.parametrize("pattern", [r"(?:zz)??(?:yy)?", r"(?:zz|yy)?"])
def test_matches_at_every_character_are_made_in_parts(spark, pattern):
    texts = [None, "", *["é" * n + "zz" for n in range(2_000)], "", "z" * 2 * BYTES_AT_ONCE, None, "zé"]
    parts = parts_of_matches(pattern, texts)
    assert pa.concat_arrays(parts).to_pylist() == [None if text is None else re.findall(pattern, text) for text in texts]
    assert len(parts) == 1
    slices = list(_slices(pa.array(texts, pa.string())))
    assert sum(map(len, slices)) == len(texts) and all(len(s) == 1 or sum(len((t or "").encode()) for t in s.to_pylist()) <= BYTES_AT_ONCE for s in slices)
    assert sum(map(len, parts_of_matches(pattern, []))) == 0
