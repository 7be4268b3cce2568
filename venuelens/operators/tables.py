"""Changes to tables by key: upserts, inserts, patches, deletes, search.

All functions return the new content and leave the writing to
``sources.tables.publish``. Joins carry no hint: Spark broadcasts the change
side when its known size is under the session's limit, so a small batch costs
no shuffle of the base table, and shuffles with skew handling otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_of

PRESENT = "_present"


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last in the given order; rows equal in it are settled by a hash of their content.

    The rank filter is applied on each task before the shuffle, so a key with a
    third of all rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in order and c != key]
    ordering = [F.col(c).desc_nulls_last() for c in order]
    if rest:
        ordering.append(F.xxhash64(*rest).desc())
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*ordering))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def replace_upsert(base: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """R2: the last batch row of a key takes the place of the base row; all other base rows stay."""
    latest = latest_by_key(batch, key, order).select(*base.columns)
    return base.join(latest.select(key), key, "left_anti").unionByName(latest)


def ordered_upsert(base: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Like ``replace_upsert``, but the order rules over table and batch: a late row older than the stored one is left out.

    So the result is the same however rows fall into batches. Only stored rows that the batch touches are ranked; the
    others pass without a shuffle while the batch is small.
    """
    if not order:
        raise ValueError("name the columns that tell which row is the later one")
    keys = batch.select(key)
    touched = base.join(keys, key, "left_semi")
    latest = latest_by_key(touched.unionByName(batch.select(*base.columns)), key, order)
    return base.join(keys, key, "left_anti").unionByName(latest)


def _merged_patch(batch: DataFrame, columns: Sequence[str], key: str, order: Sequence[str]) -> DataFrame:
    """One row per key; each column holds a struct with the last value that was present, or NULL if none was."""
    position = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    has_list = PRESENT in batch.columns

    def last(c: str) -> Column:
        there = F.array_contains(F.col(PRESENT), c) if has_list else F.lit(True)
        return F.max_by(F.when(there, F.struct(F.col(c).alias("v"))), F.when(there, position))

    known = [c for c in columns if c in batch.columns]
    return batch.groupBy(key).agg(*[last(c).alias(c) for c in known])


def _patched(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    changed = [c for c in patch.columns if c != key]
    renamed = patch.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in changed])
    joined = base.join(renamed, key, "left")

    def column(c: str) -> Column:
        if c not in changed:
            return F.col(c)
        new = F.col(f"_new_{c}")
        return F.when(new.isNotNull(), new["v"].cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    return joined.select([column(c) for c in base.columns])


def merge_upsert(base: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Only fields present in a document overwrite; several documents of a key apply in order.

    ``batch`` may carry ``_present ARRAY<STRING>``, the names of the fields a
    document has; a listed field that is NULL overwrites with NULL. Without it
    every column of ``batch`` counts as present.
    """
    patch = _merged_patch(batch, [c for c in base.columns if c != key], key, order)
    # Only the base keys that the batch touches matter for finding the new ones.
    touched = base.select(key).join(patch.select(key), key, "left_semi")
    added = patch.join(touched, key, "left_anti")
    inserts = added.select(
        *[
            F.col(c) if c == key
            else (F.col(c)["v"] if c in patch.columns else F.lit(None)).cast(base.schema[c].dataType).alias(c)
            for c in base.columns
        ]
    )
    return _patched(base, patch, key).unionByName(inserts)


def insert_rows(base: DataFrame, new: DataFrame, key: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Append; a key that exists already, in the table or twice in the input, is an error.

    Columns that ``new`` lacks get their default, or NULL where there is none.
    """
    absent = {c: F.lit((defaults or {}).get(c)).cast(base.schema[c].dataType) for c in base.columns if c not in new.columns}
    new = new.withColumns(absent).select(*base.columns)
    repeated = new.groupBy(key).count().filter("count > 1").select(key)
    existing = new.select(key).join(base.select(key), key, "left_semi")
    clash = repeated.unionByName(existing).limit(1).collect()
    if clash:
        raise ValueError(f"duplicate {key}: {clash[0][0]!r}")
    return base.unionByName(new)


def blank_as_absent(patch: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Mark blank texts and numbers that are not above 0 as not present (form fields left alone)."""

    def filled(c: str, kind: str) -> Column:
        return (F.col(c) != "") if kind == "string" else (F.col(c) > 0)

    names = [F.when(filled(c, t), F.lit(c)) for c, t in patch.dtypes if c in fields]
    return patch.withColumn(PRESENT, F.array_compact(F.array(*names)))


def patch_rows(base: DataFrame, patch: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Overwrite the filled fields of existing rows; keys not in the table change nothing."""
    fields = [c for c in base.columns if c != key]
    return _patched(base, _merged_patch(blank_as_absent(patch, fields), fields, key, order), key)


def affected_rows(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Keys of ``base`` that a patch or delete would touch; none means "not found"."""
    return base.select(key).join(patch.select(key), key, "left_semi")


def delete_rows(
    parents: DataFrame, children: DataFrame, keys: DataFrame, key: str = "id", foreign_key: str = "restaurant_id"
) -> tuple[DataFrame, DataFrame]:
    """Both tables without the given keys."""
    gone = keys.select(F.col(key))
    return (
        parents.join(gone, key, "left_anti"),
        children.join(gone.withColumnRenamed(key, foreign_key), foreign_key, "left_anti").select(*children.columns),
    )


def check_parents(
    children: DataFrame, parents: DataFrame, foreign_key: str = "restaurant_id", key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(children with a parent, children without)."""
    known = parents.select(F.col(key).alias(foreign_key))
    return (
        children.join(known, foreign_key, "left_semi").select(*children.columns),
        children.join(known, foreign_key, "left_anti").select(*children.columns),
    )


def search(
    df: DataFrame,
    term: str = "",
    columns: Sequence[str] = ("id", "name", "district", "district_parsed"),
    key: str = "id",
    page: int = 1,
    size: int = 20,
    after: str | None = None,
) -> DataFrame:
    """One page of the rows that hold the term in any of the columns, ordered by key.

    Case and accents do not count. The term is taken as it is, without wildcards.
    For far pages pass ``after``, the last key of the page before: the filter then
    reaches the scan, whereas an offset has to rank all rows ahead of the page.
    """
    if size < 1 or page < 1:
        raise ValueError("a page has one row at least, and pages start at 1")
    found = df
    if term:
        needle = F.collate(F.lit(term), "UNICODE_CI_AI")
        found = found.filter(any_of(F.contains(F.collate(F.col(c), "UNICODE_CI_AI"), needle) for c in columns))
    if after is not None:
        return found.filter(F.col(key) > after).orderBy(key).limit(size)
    return found.orderBy(key).offset((page - 1) * size).limit(size)


def sample_head(df: DataFrame, n: int = 20) -> DataFrame:
    """The first n records, for a quick look."""
    return df.limit(n)
