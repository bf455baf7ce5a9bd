"""Expression helpers for operators that stay in DataFrame functions."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK, _LEVELS = 64, 2
BLOCK = 2048


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``: a lambda variable is not computed again."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge: Callable[[Column, Column], Column], levels: int = _LEVELS) -> Column:
    """Inclusive running ``merge`` (a sum, a maximum) of an array of whole numbers of at least 0.

    Chunks of 64 are merged first and their running values taken in the same way, two levels deep, so
    the cost is about 32 steps a value, and (n / 4096)^2 / 2 in all for the last level.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), merge)
    start = lambda j: j * _CHUNK + 1

    def each(a: Column) -> Column:
        n = F.size(a)
        if not levels:
            return F.transform(a, lambda _, i: total(F.slice(a, F.lit(1), i + 1)))
        chunks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK).cast("int")),
                             lambda j: total(F.slice(a, start(j), F.lit(_CHUNK))))

        def at(before: Column, i: Column, j: Column) -> Column:
            return merge(F.coalesce(F.get(before, j - 1), F.lit(0).cast("long")), total(F.slice(a, start(j), i - start(j) + 2)))

        return let(running(chunks, merge, levels - 1), lambda before: F.transform(
            a, lambda _, i: let(F.floor(i / _CHUNK).cast("int"), lambda j: at(before, i, j))))

    return let(values, lambda a: F.when(F.size(a) > 0, each(a)).otherwise(F.array().cast("array<long>")))


def running_sums(lengths: Column) -> Column:
    """Inclusive running sums of an array of whole numbers."""
    return running(lengths, lambda s, x: s + x)


def blocks(text: Column) -> Column:
    """``text`` cut every ``BLOCK`` code points, for :func:`between`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def between(cut: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text cut by :func:`blocks`.

    ``substring`` of a whole text counts from its beginning; here at most two blocks are counted through.
    """
    def part(a: Column, b: Column) -> Column:
        i, j = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
        block = lambda k: F.coalesce(F.get(cut, k), F.lit(""))
        return (F.when(a >= b, F.lit(""))
                 .when(i == j, F.substring(block(i), F.pmod(a, F.lit(BLOCK)) + 1, b - a))
                 .otherwise(F.concat(F.substring(block(i), F.pmod(a, F.lit(BLOCK)) + 1, F.lit(BLOCK)),
                                     F.array_join(F.slice(cut, i + 2, F.greatest(j - i - 1, F.lit(0))), ""),
                                     F.substring(block(j), F.lit(1), F.pmod(b, F.lit(BLOCK))))))

    return let(start.cast("int"), lambda a: let(end.cast("int"), lambda b: part(a, b)))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as ``array<struct<start, end, found>>``.

    Offsets are code points, ``end`` exclusive. The pattern must not match the empty string.
    """
    def spans(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found,
                             lambda p, m: (F.char_length(p) + F.char_length(m)).cast("long"))
        return F.zip_with(found, running_sums(lengths), lambda m, end: F.struct(
            (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("found")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
