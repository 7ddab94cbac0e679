"""Regular expressions in Python's dialect, run by Python's own engine in Arrow batches.

Before that a substring test on the JVM passes over texts, and unparsed lines, that can't hold a
match: literal text at the top level of a pattern stands in every match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

#: What a pattern is made of, as far as literal text is concerned: escapes of one character, classes, repeats.
TOKEN = re.compile(
    r"""\\(?:x..|u.{4}|U.{8}|N\{[^}]*\}|[0-9]{1,3}|[A-Za-z])  # not literal: what it stands for depends
    | \\(?P<escaped>.)
    | \[\^?\]?(?:\\.|[^\]\\])*\]
    | (?P<repeat>[*?+]|\{(?=\d|,\d)\d*(?:,\d*)?\})[?+]?
    | (?P<open>\() | (?P<close>\)) | (?P<or>\|) | [.^$]
    | (?P<plain>.)""",
    re.VERBOSE | re.DOTALL,
)


class Finder(NamedTuple):
    """How to find a pattern in a text column."""

    pattern: str
    literals: tuple[str, ...]  # every text with a match holds one of them; () if none is known

    def all_in(self, source: Column) -> Column:
        """All matches as an array: the first group of each, or the whole match without groups.

        A group that took no part gives an empty string.
        """
        return _find_all(self.pattern)(source)

    def may_be_in(self, source: Column) -> Column:
        """A cheaper test before :meth:`all_in`."""
        return _contains_any(source, self.literals) if self.literals else source.isNotNull()

    def may_be_in_line(self, line: Column) -> Column | None:
        """The substring test on a raw JSON line, before it is parsed; None if there is none.

        A value's text stands in the line as it is, except for escapes (a backslash passes the
        line), respelled numbers, and blanks between tokens. So only runs without JSON's own
        marks count, and only if they hold something a number does not.
        """
        runs = []
        for literal in self.literals:
            safe = [run for run in re.split(r'[][{}:,"\\]', literal) if re.search(r"[^-+.0-9eE]", run)]
            if not safe:
                return None
            runs.append(max(safe, key=len))
        return _contains_any(line, (*runs, "\\")) if runs else None


def _contains_any(text: Column, literals: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(literal) for literal in literals])


def finder(pattern: str) -> Finder:
    """Prepare a pattern; raises ValueError if it is invalid."""
    try:
        compiled = re.compile(pattern)
    except re.error as error:
        raise ValueError(f"Invalid regex pattern: {error}") from error
    return Finder(pattern, () if compiled.flags & (re.I | re.X) else required_literals(pattern))


def required_literals(pattern: str) -> tuple[str, ...]:
    """Of each alternative the longest literal text outside groups; () unless all have some."""
    branches: list[list[str]] = [[""]]
    depth = 0
    for token in TOKEN.finditer(pattern):
        runs, kind = branches[-1], token.lastgroup
        if kind in ("open", "close"):
            depth += 1 if kind == "open" else -1
            runs.append("")
        elif depth:
            continue
        elif kind == "or":
            branches.append([""])
        elif kind == "repeat":
            if re.match(r"[*?]|\{0*,", token["repeat"]) or re.fullmatch(r"\{0+\}", token["repeat"]):
                runs[-1] = runs[-1][:-1]  # what may be missing
            runs.append("")
        elif kind in ("plain", "escaped"):
            runs[-1] += token[kind]
        else:
            runs.append("")
    longest = [max(runs, key=len) for runs in branches]
    return tuple(longest) if all(longest) else ()


#: Bytes of texts whose matches are Python objects at one time, more only for a single text: a pattern can match at every character.
BYTES_AT_ONCE = 1 << 18


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of at most ``BYTES_AT_ONCE``, or of one text."""
    start = held = 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if at > start and held + (size or 0) > BYTES_AT_ONCE:
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += size or 0
    yield texts.slice(start)


def _find_all(pattern: str):
    """An Arrow UDF from texts to arrays of matches.

    Matches can take many times the memory of their texts, so few are Python objects at one time.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = re.compile(pattern)
        several = compiled.groups > 1
        for batch in batches:
            parts = []
            for texts in _slices(batch):
                found = []
                for text in texts.to_pylist():
                    matches = None if text is None else compiled.findall(text)
                    found.append([groups[0] for groups in matches] if several and matches else matches)
                parts.append(pa.array(found, pa.list_(pa.string())))
            yield pa.concat_arrays(parts)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, returnType="array<string>").asNondeterministic()
