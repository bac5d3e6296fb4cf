"""Copies hidden by formatting: range partition, sort, scan adjacent runs."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.llm.words import words
from taskmill.runtime import cut, shuffle_partitions, stored

#: Records of one range on average.
RECORDS_A_PARTITION = 1_000_000

# Key names the task schema accepts, first present one counts.
QUESTION_KEYS = ("question_text", "question")
ANSWER_KEYS = ("reference_answer", "answer", "gold_answer")


def canonical_line(raw: str | None) -> str | None:
    """The words of question and answer of one JSON line, or null if it is no record.

    Blank, broken and non-object lines are no records, nor are lines whose
    question and answer hold no words at all. Values that are not strings
    count as their JSON text; null and absent values have no words.
    """
    if raw is None or not raw.strip():
        return None
    try:
        obj = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    if not isinstance(obj, dict):
        return None
    parts = []
    for keys in (QUESTION_KEYS, ANSWER_KEYS):
        value = next((obj[k] for k in keys if k in obj), None)
        if value is not None and not isinstance(value, str):
            value = json.dumps(value, ensure_ascii=False)
        parts.append(" ".join(words(value)))
    return "\x1f".join(parts) if any(parts) else None


def canonical_records(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(rec_id bigint, canon string) of every line that is a record."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            canon = [canonical_line(x) for x in b.column(1).to_pylist()]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(canon, pa.string())], ["rec_id", "canon"])
            yield out.filter(pa.compute.is_valid(out.column(1)))

    src = df.select(F.col(id_col).cast("bigint").alias("rec_id"), F.col(json_col).cast("string").alias("canon"))
    return src.filter(F.col("rec_id").isNotNull()).mapInArrow(run, "rec_id bigint, canon string")


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks one sorted partition and compares each full key with the one before it.

    The keys of the first and the last row are passed on for the borders.
    """
    prev: str | None = None
    keep, run_no = None, -1
    names = ["rec_id", "part", "keep_id", "run_no", "edge"]
    held: list | None = None

    def batch(ids: pa.Array, part: pa.Array, keeps: list, runs: list, edges: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, part, pa.array(keeps, pa.int64()), pa.array(runs, pa.int64()), pa.array(edges, pa.string())], names)

    for b in batches:
        if not b.num_rows:
            continue
        keeps, runs, edges = [], [], [None] * b.num_rows
        if held is None:
            edges[0] = b.column(1)[0].as_py()
        else:
            yield batch(*held)
        for i, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != prev:
                prev, keep, run_no = k, i, run_no + 1
            keeps.append(keep)
            runs.append(run_no)
        held = [b.column(0), b.column(2), keeps, runs, edges]
    if held is not None:
        held[4][-1] = prev
        yield batch(*held)


def copy_runs(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(rec_id, keep_id): every record with the smallest id of its copies.

    Canonical records are written once, then range-partitioned by (key, id), so even
    one key that holds a third of all rows spreads over many partitions; each
    partition is sorted (Spark's sorter spills to disk) and its adjacent rows are
    compared by their full keys. A run that began in an earlier partition is
    stitched by comparing the full keys at the borders; only one small row a
    partition, without keys, reaches the driver. Repeated (id, line) rows keep one
    output row each. Empty input: no rows.
    """
    canon = stored(canonical_records(df, id_col, json_col))
    parts = max(shuffle_partitions(df.sparkSession), canon.count() // RECORDS_A_PARTITION + 1)
    ordered = canon.repartitionByRange(parts, "canon", "rec_id").sortWithinPartitions("canon", "rec_id")
    scanned = cut(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_scan, "rec_id bigint, part int, keep_id bigint, run_no bigint, edge string"))
    ends = scanned.filter("edge IS NOT NULL").groupBy("part").agg(F.min_by("edge", "run_no").alias("first"), F.max_by("edge", "run_no").alias("last"))
    sums = scanned.groupBy("part").agg(F.max_by("keep_id", "run_no").alias("last_keep"), F.max("run_no").alias("runs"))
    before = Window.orderBy("part")  # one row a partition
    ends = ends.withColumn("same", F.coalesce(F.col("first") == F.lag("last").over(before), F.lit(False))).select("part", "same")
    carried: dict[int, int] = {}
    keep = None
    for e in sums.join(ends, "part").orderBy("part").collect():
        if e["same"]:
            carried[e["part"]] = keep
            if e["runs"] == 0:
                continue
        keep = e["last_keep"]
    out = scanned.select("rec_id", "keep_id", "part", "run_no")
    if carried:
        fix = df.sparkSession.createDataFrame(list(carried.items()), "part int, carried bigint")
        out = out.join(F.broadcast(fix), "part", "left")  # at most one row a partition
        out = out.withColumn("keep_id", F.when(F.col("run_no") == 0, F.coalesce("carried", "keep_id")).otherwise(F.col("keep_id")))
    return out.select("rec_id", "keep_id")


def copies_found(df: DataFrame, id_col: str = "line_id", json_col: str = "raw_json") -> DataFrame:
    """(keep_id, copy_id): one row for each record that is not the first of its group."""
    return copy_runs(df, id_col, json_col).filter("rec_id <> keep_id").select("keep_id", F.col("rec_id").alias("copy_id")).distinct()


def collapsed(df: DataFrame, id_col: str = "line_id", json_col: str = "raw_json") -> DataFrame:
    """(keep_id, copies): one representative per group with its exact number of records."""
    return copy_runs(df, id_col, json_col).groupBy("keep_id").agg(F.count("*").alias("copies"))
