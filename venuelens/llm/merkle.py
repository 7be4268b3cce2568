"""Merkle manifest of a table by a nested-struct rollup.

Each row is a leaf. The leaves of a group stand in order; runs of three consecutive nodes are hashed to their parent
until one node, the group's root, remains. The groups' roots, in order of the groups, give the root of the table.

Ranks come from a range partition and counted offsets, so no group passes through one task. The rank's digits to the
base of three are columns. Rows are dealt once by blocks of 729 ranks; inside a block one digit column after the
other is grouped away, and each step nests its children as structs below the hash of their parent, without another
shuffle. A block holds a bounded tree whatever the size of its group. The blocks' hashes are the next round's nodes.
Proofs go down the same way: the path above a block is put beside its nested tree by a union and a grouping, and
``transform`` and ``explode`` open one level after the other, adding each child's siblings. Nothing is joined.

Defined results: a null group is a group of its own and the first one; a null order value stands first; rows of equal
order value stand by leaf hash, and rows that are equal in both are told apart by their place in the input, so
repeated rows are leaves of their own. Null fields give ``-``, empty ones ``0:``. An empty table gives no rows.
Columns that are not named are not looked at, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

FAN = 3
#: Levels of one block; a block holds FAN ** LEVELS nodes at most.
LEVELS = 6

PATH = "array<struct<left:string,right:string>>"


def digest(*parts: str | Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, a colon and the value."""
    told = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(told).cast("string"), F.lit(":"), told), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda held, run: digest(run["left"], held, run["right"]))


def path_digest(path: Column) -> Column:
    """One hash over all siblings of a path, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "").cast("binary"), 256)


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``pos``, the place from 0 among the rows of a ``key``, and ``n``, their number."""
    ranged = rows.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id())
    dealt = stage(ranged, name)
    counts = dealt.groupBy("key", "part").agg(F.count("*").alias("here"))
    # One row a part at most, so a hot key has as many rows here as there are parts.
    places = F.struct("part", "here")
    counts = counts.groupBy("key").agg(F.array_sort(F.collect_list(places)).alias("parts"), F.sum("here").alias("n"))
    before = F.aggregate(
        "parts", F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<part:int,at:bigint>>)").alias("out")),
        lambda held, p: F.struct(
            (held["at"] + p["here"]).alias("at"),
            F.concat(held["out"], F.array(F.struct(p["part"].alias("part"), held["at"].alias("at")))).alias("out"),
        ),
        lambda held: held["out"],
    )
    starts = counts.select("key", "n", F.inline(before))
    within = F.row_number().over(Window.partitionBy("key", "part").orderBy(*order))
    return dealt.withColumn("pos", within - 1).join(starts, ["key", "part"]).withColumn("pos", F.col("pos") + F.col("at")).drop("part", "at")


def _depth(n: Column) -> Column:
    """Levels of a block's tree that are hashed: none for a single node."""
    return reduce(lambda held, level: F.when(n <= FAN**level, level).otherwise(held), range(LEVELS - 1, -1, -1), F.lit(LEVELS))


def _blocks(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """Nested trees of blocks: one row (key, n, block, h, kids) for FAN ** LEVELS nodes of a key."""
    digits = [f"d{level}" for level in range(LEVELS)]
    rows = nodes.select(
        "key", "n", F.expr(f"pos div {FAN**LEVELS}").alias("block"),
        *[F.expr(f"pos div {FAN**level} % {FAN}").cast("byte").alias(d) for level, d in enumerate(digits)],
        "h", F.struct(*carry).alias("kids"),
    ).repartition("key", "block")
    for level, digit in enumerate(digits):
        kids = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("d"), "h", "kids")))
        rows = rows.groupBy("key", "n", "block", *digits[level + 1 :]).agg(kids.alias("kids"))
        hashes = F.array_join(F.transform("kids", lambda kid: kid["h"]), "")
        h = F.when(F.lit(level) < _depth(F.col("n")), F.sha2(hashes.cast("binary"), 256)).otherwise(F.col("kids")[0]["h"])
        rows = rows.withColumn("h", h)
    return rows.select("key", "n", "block", "h", "kids")


def _opened(trees: DataFrame, carry: list[str]) -> DataFrame:
    """The nodes of nested trees with their paths; ``trees`` has the path of the block in ``path``."""
    rows = trees.withColumn("up", F.expr(f"cast(array() as {PATH})"))
    for level in range(LEVELS - 1, -1, -1):
        hashed = F.lit(level) < _depth(F.col("n"))

        def one(kid: Column, i: Column) -> Column:
            left = F.array_join(F.transform(F.slice("kids", F.lit(1), i), lambda k: k["h"]), "")
            right = F.array_join(F.transform(F.slice("kids", i + 2, FAN), lambda k: k["h"]), "")
            run = F.array(F.struct(left.alias("left"), right.alias("right")))
            up = F.when(hashed, F.concat(run, F.col("up"))).otherwise(F.col("up"))
            return F.struct(up.alias("up"), kid["h"].alias("h"), kid["kids"].alias("kids"), kid["d"].alias("d"))

        same = [c for c in rows.columns if c not in ("up", "h", "kids", "block")]
        opened = rows.select(*same, "block", F.explode(F.transform("kids", one)).alias("kid"))
        place = (F.col("block") * FAN + F.col("kid.d")).alias("block")
        rows = opened.select(*same, place, F.col("kid.h").alias("h"), F.col("kid.kids").alias("kids"), F.col("kid.up").alias("up"))
    told = F.concat("up", "path").alias("path")
    kept = [c for c in rows.columns if c not in ("n", "path", "up", "kids", "block", "h")]
    return rows.select(*kept, F.col("block").alias("pos"), "h", *[F.col("kids")[c].alias(c) for c in carry], told)


def _rounds(nodes: DataFrame, carry: list[str], name: str) -> list[DataFrame]:
    """The staged block trees of every round, from the leaves to one node a key."""
    rounds = []
    while True:
        rounds.append(stage(_blocks(nodes, carry), name))
        most = rounds[-1].agg(F.max("n")).first()[0]
        if most is None or most <= FAN**LEVELS:
            return rounds
        size = FAN**LEVELS
        nodes = rounds[-1].select("key", F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block").alias("pos"), "h")
        nodes, carry = nodes.withColumn("here", F.col("pos")), ["here"]


def _down(rounds: list[DataFrame], tops: DataFrame, carry: list[str]) -> DataFrame:
    """All leaves with their whole paths; ``tops`` has (key, path, subroot, root) of the single node of each key."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for trees, kept in zip(rounds[::-1], [["here"]] * (len(rounds) - 1) + [carry]):
        up = above.select("key", "block", F.struct("path", "subroot", "root").alias("top"), *_empty(trees, ["n", "h", "kids"]))
        below = trees.select("key", "block", F.lit(None).cast(up.schema["top"].dataType).alias("top"), "n", "h", "kids")
        met = up.unionByName(below).groupBy("key", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("top", "n", "h", "kids")]
        )
        opened = _opened(met.select("key", "block", "top.*", "n", "h", "kids"), kept)
        above = opened if kept is carry else opened.withColumn("block", F.col("pos"))
    return above


def _empty(like: DataFrame, names: list[str]) -> list[Column]:
    return [F.lit(None).cast(like.schema[name].dataType).alias(name) for name in names]


def proofs(
    df: DataFrame, fields: list[str], order: str = "doc_id", group: str = "source", carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``df``: the order and group columns, ``leaf``, ``path``, ``subroot``, ``root`` and ``carry``.

    A leaf is the hash of ``fields``. ``path`` has for each level the hashes left and right of the way to the root.
    ``carry`` are further columns by name, worked out where the leaf is.
    """
    carry = carry or {}
    clash = {"leaf", "path", "subroot", "root", order, group} & set(carry)
    if clash:
        raise ValueError(f"these columns have a meaning of their own: {sorted(clash)}")
    ours = [f"carry{i}" for i in range(len(carry))]
    # A letter before the name tells the empty group from the null one, which comes first.
    key = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit(""))
    rows = df.select(
        key.alias("key"), F.col(group).alias("grp"), F.col(order).alias("ord"), leaf(*[F.col(f) for f in fields]).alias("h"),
        F.monotonically_increasing_id().alias("row"), *[c.alias(name) for c, name in zip(carry.values(), ours)],
    )
    held = ["ord", "grp", *ours]
    rounds = _rounds(_ranked(stage(rows, "merkle-leaves"), ["ord", "h", "row"], "merkle-ranked"), held, "merkle-blocks")
    subroots = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), "h")
    upper = _rounds(_ranked(subroots, ["name"], "merkle-groups"), ["name"], "merkle-tops")
    root = upper[-1].select(
        F.lit("").alias("key"), F.expr(f"cast(array() as {PATH})").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root")
    )
    tops = _down(upper, root, ["name"]).select(F.col("name").alias("key"), "path", F.col("h").alias("subroot"), "root")
    out = _down(rounds, stage(tops, "merkle-paths"), held)
    return out.select(
        F.col("ord").alias(order), F.col("grp").alias(group), F.col("h").alias("leaf"), "path", "subroot", "root",
        *[F.col(mine).alias(name) for mine, name in zip(ours, carry)],
    )


def manifest_check(docs: DataFrame, tampered: Column, fields: list[str], order: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """Proofs of all rows, and what a copy with ``tampered`` in place of the text would lead to.

    ``folded_root`` comes from the copy's leaf and the original siblings; ``verified`` tells if it is the root.
    """
    other = leaf(*[tampered if f == text else F.col(f) for f in fields])
    rows = proofs(docs, fields, order, group, {"copy": other})
    rows = rows.withColumn("folded_root", fold(F.col("copy"), F.col("path"))).withColumn("proof_sha256", path_digest(F.col("path")))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
