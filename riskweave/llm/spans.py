"""Positions of regular-expression matches, as DataFrame expressions.

``regexp_extract_all`` gives the matches and ``split`` the text between them; both
walk a text alike, so running lengths give the places in code points. Patterns
must not match the empty string. A pattern should be linear in the text (a
possessive run behind a look-behind) and must not repeat a group without bound,
as the regex engine would recurse on very long matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.llm.common import let

SPAN = "struct<start:int,end:int,value:string>"
NO_SPANS = f"array<{SPAN}>"
CHUNK = 256


def none() -> Column:
    return F.array().cast(NO_SPANS)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an int array, in chunks, so that long arrays stay cheap."""

    def by_chunk(v):
        chunks = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(v) - 1, F.lit(CHUNK)).cast("int")),
                             lambda c: _sum(F.slice(v, c * CHUNK + 1, CHUNK)))

        def with_chunks(sums):
            before = F.transform(sums, lambda _, c: _sum(F.slice(sums, F.lit(1), c)))
            return let(before, lambda b: F.transform(v, lambda _, i: F.get(b, _chunk(i)) + _sum(
                F.slice(v, _chunk(i) * CHUNK + 1, i % CHUNK + 1))))

        return let(chunks, with_chunks)

    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(values, by_chunk))


def _chunk(i: Column) -> Column:
    return F.floor(i / CHUNK).cast("int")


def find(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches."""

    def place(found):
        gaps = F.split(text, pattern, -1)
        steps = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.length(m) + F.length(g))
        return F.zip_with(found, running_sums(steps), lambda m, end: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda found: F.when(F.size(found) == 0, none()).otherwise(place(found)))


def listing(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans, comma-joined, kind by kind."""
    def entries(kind, spans):
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    parts = [entries(kind, spans) for kind, spans in kinds.items()]
    return F.array_join(F.concat(*parts), ",")


def outside(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of ``taken``."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each of the sorted, disjoint spans (start, end, tag) replaced by its tag."""
    def pieces(s):
        return F.concat(F.array_join(F.transform(s, lambda x, i: F.concat(
            F.substr(text, F.when(i == 0, F.lit(1)).otherwise(F.get(s, i - 1)["end"] + 1),
                     x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(s, i - 1)["end"])), x["tag"])), ""),
            F.substr(text, F.get(s, F.size(s) - 1)["end"] + 1, F.length(text)))

    return let(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(pieces(s)))
