"""Spans of regular expressions in texts, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .shared import let

SPAN = "start:int,end:int,found:string"


def spans(text: Column, pattern: str, around: int = 0) -> Column:
    """The leftmost non-overlapping matches as structs (start, end, found), in code points, end exclusive.

    With ``around`` also (left, right): that many characters on either side, or fewer, as far as the neighbouring match.

    A text is its pieces between matches and the matches in turn, so sums of lengths are places. The pattern must not
    match the empty string.
    """

    kind = f"array<struct<{SPAN}{',left:string,right:string' if around else ''}>>"

    def placed(matches: Column) -> Column:
        def with_pieces(pieces: Column) -> Column:
            steps = F.transform(matches, lambda one, i: F.length(F.get(pieces, i)) + F.length(one))

            def one(found: Column, i: Column, before: Column) -> Column:
                start = F.get(before, i) + F.length(F.get(pieces, i))
                beside = []
                if around:
                    # Only the pieces and matches next to it are looked at, not the text from its start.
                    left = F.concat(F.when(i == 0, "").otherwise(F.get(matches, i - 1)), F.get(pieces, i))
                    right = F.concat(F.get(pieces, i + 1), F.coalesce(F.get(matches, i + 1), F.lit("")))
                    beside = [F.right(left, F.lit(around)).alias("left"), F.left(right, F.lit(around)).alias("right")]
                return F.struct(start.alias("start"), (start + F.length(found)).alias("end"), found.alias("found"), *beside)

            return let(running(steps, 0, lambda a, b: a + b), lambda before: F.transform(matches, lambda f, i: one(f, i, before)))

        return F.when(F.size(matches) == 0, F.array().cast(kind)).otherwise(let(F.split(text, pattern, -1), with_pieces))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


#: Values that are run over in one go; an array that grows step by step is copied at each step.
RUN = 256


def running(values: Column, zero: int, join) -> Column:
    """For each value of an integer array what ``join`` makes of all values before it, from ``zero`` on.

    ``join`` must be associative. Long arrays go in runs of ``RUN`` values: first the whole runs, then inside each, so
    the cost is about linear.
    """
    empty = F.array().cast("array<int>")

    def over(part: Column, start: Column) -> Column:
        begin = F.struct(start.cast("int").alias("at"), empty.alias("out"))
        step = lambda held, x: F.struct(join(held["at"], x).alias("at"), F.concat(held["out"], F.array(held["at"])).alias("out"))
        return F.aggregate(part, begin, step, lambda held: held["out"])

    def whole(values: Column) -> Column:
        cut = lambda i: F.slice(values, i * RUN + 1, RUN)
        runs = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
        wholes = F.transform(runs, lambda i: F.aggregate(cut(i), F.lit(zero), join))
        inside = let(wholes, lambda each: F.flatten(F.transform(over(each, F.lit(zero)), lambda start, i: over(cut(i), start))))
        return F.when(F.size(values) == 0, empty).when(F.size(values) <= RUN, over(values, F.lit(zero))).otherwise(inside)

    return let(values, whole)


def labelled(kinds: list[tuple[str, Column]], order: int = 0) -> Column:
    """All spans of several kinds as structs (start, rank, kind, end), by start and then by kind as listed."""
    return F.array_sort(F.concat(*[_ranked(found, kind, order + i) for i, (kind, found) in enumerate(kinds)]))


def _ranked(found: Column, kind: str, rank: int) -> Column:
    return F.transform(
        found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


def written(rows: Column) -> Column:
    """``kind:start:end`` of labelled spans, comma-joined."""
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digits(column: Column) -> Column:
    return F.regexp_replace(column, "[^0-9]+", "")
