"""Preparing a dataset: union of sources in order, limit, reuse, counts, and the command."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taskmill.functions.answers import sampled_answer
from taskmill.functions.text import clean, strip, tidy_list
from taskmill.operators import adapters
from taskmill.operators.ordering import sliced
from taskmill.operators.subjects import cached_index, checked_index
from taskmill.runtime import clear_stored, exists, has_data, stored
from taskmill.sources.config import DatasetConfig, Source, load_config, resolve_path, split_names
from taskmill.sources.lines import checked, not_empty, pool_from_lines, read_numbered, tasks_from_lines
from taskmill.sources.schema import TASK_COLUMNS
from taskmill.sources.sinks import write_tasks


def _checked_limit(limit: int | None) -> None:
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all rows")


def merged(sources: Sequence[DataFrame], order: list[str], limit: int | None = None) -> DataFrame:
    """All rows of the sources in order, cut to ``limit`` (null: all; less than 1 is an error).

    Adds ``source_pos``. A limit takes each source's first rows before the rows
    of all are put together, so no more than ``limit`` rows a source are sorted.
    """
    _checked_limit(limit)
    tagged = [s.withColumn("source_pos", F.lit(i)) for i, s in enumerate(sources)]
    if limit is not None:
        tagged = [t.orderBy(*order).limit(limit) for t in tagged]
    out = reduce(lambda a, b: a.unionByName(b), tagged)
    return out if limit is None else out.orderBy("source_pos", *order).limit(limit)


def merged_lazily(builders: Sequence[Callable[[], DataFrame]], order: list[str], limit: int) -> DataFrame:
    """Like :func:`merged`, but sources after the one that reaches the limit are not built,
    and each one built is computed once: its first rows are stored."""
    _checked_limit(limit)
    built, have = [], 0
    for build in builders:
        first = stored(build().orderBy(*order).limit(limit - have))
        built.append(first)
        have += first.count()
        if have >= limit:
            break
    return merged(built, order, limit)


def source_counts(tasks: DataFrame, source: str) -> DataFrame:
    return tasks.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("rows")).orderBy("source")


PLACE = ["part", "position"]


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """(part, position, task columns) of JSON lines in their order; reading a bad row fails."""
    tasks = checked(tasks_from_lines(read_numbered(spark, path)))
    return tasks.select(F.lit(0).alias("part"), F.col("row_pos").alias("position"), *TASK_COLUMNS)


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Tasks already written below ``path``, else built, once, and written there in order.
    As rows are validated by reading, built ones are returned as they are."""
    if not force and has_data(spark, path):
        return read_tasks(spark, path)
    tasks = stored(build())
    write_tasks(tasks, path, order=PLACE)
    return tasks


def split_path(spark: SparkSession, root: str, source: Source, split: str) -> str:
    """The parquet or JSON-lines folder of one split of a local copy of a dataset.

    The copy of ``repo_id`` lies below the dataset's folder; the configuration and
    the revision are folders in it where they are named. Other names of a split are
    tried in turn; none of them is an error.
    """
    base = resolve_path(root, source.repo_id or "")
    parts = [p for p in (source.revision, source.config_name) if p]
    tried = []
    for name in split_names(split):
        for end in (".parquet", ".jsonl", ""):
            path = os.path.join(base, *parts, name + end)
            if exists(spark, path):
                return path
            tried.append(path)
    raise FileNotFoundError(f"no rows for split {split}; tried {', '.join(tried)}")


def read_split(spark: SparkSession, root: str, source: Source, split: str, schema: str) -> DataFrame:
    """Rows of one split in file order, with ``row``; columns that the files lack are null."""
    path = split_path(spark, root, source, split)
    if path.endswith(".jsonl"):
        lines = read_numbered(spark, path)
        got = lines.filter(clean(F.col("line")) != "").select("row_pos", F.from_json("line", schema).alias("_r"))
        return got.select(F.col("row_pos").alias("row"), "_r.*")
    rows = spark.read.parquet(path)
    wanted = spark.createDataFrame([], schema).schema
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]
    meta = F.col("_metadata")
    # File name and row number order the rows; the number is unique in all files.
    rows = rows.select(*cols, meta["file_name"].alias("_file"), meta["row_index"].alias("_index"))
    files = rows.groupBy("_file").agg((F.max("_index") + 1).alias("_n"))
    files = files.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))  # one row a file
    return rows.join(F.broadcast(files), "_file").select((F.col("_before") + F.col("_index")).alias("row"), *[f.name for f in wanted])


MMLU_ROW = "config string, subject string, question string, choices array<string>, answer string"
TRIVIA_ROW = "question_id string, question string, answer struct<value:string,aliases:array<string>,normalized_aliases:array<string>>"


def build_source(spark: SparkSession, root: str, source: Source, limit: int | None = None) -> DataFrame:
    """(part, position, task columns) of one source by its adapter."""
    dataset = source.repo_id or source.name
    if source.adapter == "question_pool_mcq":
        rows = checked(pool_from_lines(read_numbered(spark, resolve_path(root, source.path or "")))).drop("line")
        return adapters.build(source.adapter, rows, source.name, ["row_pos"], limit)
    if source.adapter == "trivia_qa_rc":
        parts = [read_split(spark, root, source, s, TRIVIA_ROW).withColumn("split", F.lit(s)) for s in adapters.TRIVIA_SPLITS]
        return adapters.build(source.adapter, parts[0].unionByName(parts[1]), source.name, dataset, None, ["row"], limit)
    if source.adapter in ("mmlu_cais", "mmlu_auxiliary_train"):
        aux, dev, validation = (read_split(spark, root, source, s, MMLU_ROW).withColumn("split", F.lit(s)) for s in adapters.CAIS_SPLITS)
        labelled = adapters.subject_rows(dev.unionByName(validation))
        index = cached_index(spark, os.path.join(root, "cache", f"{source.name}_subject_index.parquet"), lambda: checked_index(stored(adapters.config_index(labelled, "config", "split")), labelled))
        if source.adapter == "mmlu_auxiliary_train":
            return adapters.build(source.adapter, aux.drop("split"), index, source.name, dataset, "auxiliary_train", ["row"], limit)
        return adapters.build(source.adapter, aux.unionByName(labelled), source.name, dataset, None, ["row"], limit, index=index)
    raise ValueError(f"unsupported adapter {source.adapter!r} of source {source.name!r}")


def _source_file(config: DatasetConfig, source: Source, target: str) -> str:
    """Where a source's own tasks are kept; never the merged output itself."""
    path = os.path.join(config.root, source.output_file)
    return f"{path}.source" if path.rstrip("/") == target.rstrip("/") else path


def prepared(
    spark: SparkSession, config: DatasetConfig, build: Callable[[Source], DataFrame] | None = None, output: str | None = None, limit: int | None = None,
    force: bool = False, lazy: bool = False,
) -> tuple[int, dict[str, int]]:
    """Builds or reuses every enabled source, writes the merged tasks in order of source
    and row, returns the rows written and the rows by source.

    A limit cuts the merged rows; a source that is built is limited as well, one that is
    reused is not. With ``lazy`` a reused source is limited, too, and sources after the
    one that reaches the limit are neither built nor counted. The merged output and
    the sources' files are kept apart, so that a limited run never replaces a
    reusable source file of another name.
    """
    _checked_limit(limit)
    target = output or os.path.join(config.root, config.output_file)
    make = build or (lambda s: build_source(spark, config.root, s, limit))
    parts, counts, have = [], {}, 0
    for s in (s for s in config.sources if s.enabled):
        tasks = reuse_or_build(spark, _source_file(config, s, target), lambda s=s: make(s), force)
        if lazy and limit is not None:
            tasks = tasks.orderBy(*PLACE).limit(limit)
        counts[s.name] = tasks.count()
        if s.merge:
            parts.append(tasks)
            have += counts[s.name]
            if lazy and limit is not None and have >= limit:
                break
    if not parts:
        raise ValueError(f"no tasks were prepared for {config.name}")
    out = not_empty(merged(parts, PLACE, limit), config.name)
    return write_tasks(out, target, order=["source_pos", *PLACE]), counts


def prepare(*args, **kwargs) -> dict[str, int]:
    """:func:`prepared`, of which only the rows by source are returned."""
    return prepared(*args, **kwargs)[1]


def ensure_tasks(spark: SparkSession, path: str, config_path: str | None = None, limit: int | None = None, build: Callable[[Source], DataFrame] | None = None) -> DataFrame:
    """The tasks at ``path``, prepared first if they are missing or empty.

    Only the default name ``tasks.jsonl`` is prepared; its folder is the dataset's, and
    the configuration is ``config/datasets/<folder>.toml`` unless it is given. No
    task at all is an error, and so is a missing file or configuration.
    """
    if not has_data(spark, path):
        root, name = os.path.split(path.rstrip("/"))
        if name != "tasks.jsonl":
            raise FileNotFoundError(f"no tasks at {path}")
        chosen = config_path or os.path.join("config", "datasets", f"{os.path.basename(root)}.toml")
        if not os.path.exists(chosen):
            raise FileNotFoundError(f"no tasks at {path} and no configuration at {chosen}")
        prepare(spark, load_config(chosen, root), build, path, limit, lazy=True)
    tasks = read_tasks(spark, path)
    return not_empty(tasks if limit is None else tasks.orderBy(*PLACE).limit(limit), path)


def samples(rows: DataFrame, order: list[str], start: int, limit: int, prefix: str = "mmlu") -> DataFrame:
    """Rows [start, start + limit) in order, with a zero-padded ``sample_id``."""
    return sliced(rows, order, start, limit).withColumn("sample_id", F.format_string(f"{prefix}_%06d", "position"))


def sample_records(rows: DataFrame, order: list[str], start: int, limit: int, subset: str, kind: Column | None = None) -> DataFrame:
    """(sample_id, subject, question, choices, answer) of a slice of (question, choices,
    answer) rows: texts stripped, the answer as a label where it names a choice, and
    ``subset`` as the subject of rows without a ``subject`` column. ``kind`` is the JSON
    kind of the answer, by default a string."""
    out = samples(rows, order, start, limit)
    choices = tidy_list(F.col("choices"))
    subject = strip(F.coalesce("subject", F.lit("None"))) if "subject" in rows.columns else F.lit(subset)
    answer = sampled_answer(F.col("answer"), choices, kind if kind is not None else F.lit("string"))
    return out.select("sample_id", subject.alias("subject"), clean(F.col("question")).alias("question"), choices.alias("choices"), answer.alias("answer"))


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    """The command: ``python -m taskmill.operators.prepare --dataset-name NAME`` or
    ``--dataset-config-path FILE``, with ``--output-path``, ``--limit`` and ``--force``."""
    p = argparse.ArgumentParser(prog="taskmill-prepare", description="Write the tasks of a dataset as JSON lines.")
    p.add_argument("--dataset-name")
    p.add_argument("--dataset-config-path")
    p.add_argument("--dataset-root", help="folder of the dataset; by default data/NAME")
    p.add_argument("--output-path")
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_true", help="build sources again that are already written")
    a = p.parse_args(arguments)
    if not (a.dataset_name or a.dataset_config_path):
        p.error("--dataset-name or --dataset-config-path is needed")
    path = a.dataset_config_path or os.path.join("config", "datasets", f"{a.dataset_name}.toml")
    name = a.dataset_name or os.path.splitext(os.path.basename(path))[0]
    config = load_config(path, a.dataset_root or os.path.join("data", name))
    session = spark or SparkSession.builder.appName("taskmill-prepare").getOrCreate()
    target = a.output_path or os.path.join(config.root, config.output_file)
    rows, counts = prepared(session, config, None, target, a.limit, a.force)
    print(f"rows_written={rows}")
    print(f"output_path={target}")
    for source, rows in sorted(counts.items()):
        print(f"source={source} rows={rows}")
    clear_stored(session)
    return counts


if __name__ == "__main__":
    main()
