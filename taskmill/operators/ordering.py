"""Positions and round-robin order without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.runtime import cut, shuffle_partitions

#: Up to so many first rows are taken by a top-k instead of ranking all rows.
TOP = 100_000


def _checked(limit: int | None) -> None:
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all rows")


def _ranks(keys: DataFrame, group: str | None, order: list[str], name: str) -> DataFrame:
    """The rows of ``keys`` with their position; rows are range-partitioned and sorted, so one
    group may span many partitions, and a partition's place in the group comes from the
    counts of those before it (one row a partition and group)."""
    by = ([group] if group else []) + order
    parts = keys.repartitionByRange(shuffle_partitions(keys.sparkSession), *by).sortWithinPartitions(*by)
    parts = cut(parts.withColumn("__mid", F.monotonically_increasing_id()))
    part, at = F.shiftright("__mid", 33), F.col("__mid").bitwiseAND((1 << 33) - 1)
    g = F.col(group) if group else F.lit(None).cast("string")
    parts = parts.withColumn("__part", part).withColumn("__at", at).withColumn("__group", g).drop("__mid")
    counts = parts.groupBy("__group", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__group").orderBy("__part")) - F.col("__n")
    counts = counts.select(F.col("__group").alias("__g"), F.col("__part").alias("__p"), "__first", before.alias("__before"))
    out = parts.join(counts, (F.col("__group").eqNullSafe(F.col("__g"))) & (F.col("__part") == F.col("__p")))
    return out.select(*keys.columns, (F.col("__before") + F.col("__at") - F.col("__first")).alias(name))


def ranked(df: DataFrame, group: str | None, order: list[str], name: str = "rank", limit: int | None = None) -> DataFrame:
    """Adds the 0-based position within ``group`` by ``order`` (a unique key); with ``limit``
    only the rows whose position is below it.

    Only the keys are sorted and written; the other columns are joined to their
    positions. A limit up to TOP is a top-k: map-side, with at most ``limit`` rows a
    group in a task.
    """
    _checked(limit)
    if limit is not None and limit <= TOP:
        window = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy(*order)
        first = df if group else df.orderBy(*order).limit(limit)
        return first.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit).withColumn(name, F.col(name).cast("bigint") - 1)
    keys = list(dict.fromkeys(([group] if group else []) + order))
    at = _ranks(df.select(*keys), group, order, name)
    if limit is not None:
        at = at.filter(F.col(name) < limit)
    if set(df.columns) == set(keys):
        return at
    at = at.select(*[F.col(c).alias(f"__{c}") for c in order], name)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order]
    return df.join(at, same).drop(*[f"__{c}" for c in order])


def interleaved(df: DataFrame, group: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Adds ``row_in_group`` and ``position``: row 0 of each group in order of the
    groups' names, then row 1, exhausted groups skipped; ``limit`` null means all.

    That is the order by (row_in_group, group): the keys are ranked twice, the second time
    with the first rank in front. Rows of a null group are a group of their own,
    first in order.
    """
    _checked(limit)
    keys = list(dict.fromkeys([group, *order]))
    rows = ranked(df.select(*keys), group, order, "row_in_group", limit)
    at = ranked(rows, None, ["row_in_group", *keys], "position", limit)
    if set(df.columns) == set(keys):
        return at
    at = at.select(*[F.col(c).alias(f"__{c}") for c in order], "row_in_group", "position")
    return df.join(at, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order]).drop(*[f"__{c}" for c in order])


def sliced(df: DataFrame, order: list[str], start: int, limit: int) -> DataFrame:
    """Rows [start, start + limit) in order, with their ``position``."""
    if start < 0 or limit < 0:
        raise ValueError("start and limit must not be negative")
    return ranked(df, None, order, "position", max(1, start + limit)).filter((F.col("position") >= start) & (F.col("position") < start + limit))
