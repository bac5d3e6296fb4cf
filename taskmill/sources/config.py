"""Dataset configuration: TOML files and the table form, read on the driver."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskmill.runtime import exists

# Other names of a split, tried in order.
SPLIT_NAMES = {"auxiliary_train": ["auxiliary_train", "train"], "validation": ["validation", "val"]}
NO_SUBJECT_CONFIGS = ["all", "auxiliary_train"]


@dataclass(frozen=True)
class Source:
    name: str
    provider: str
    adapter: str
    output_file: str
    enabled: bool = True
    merge: bool = True
    repo_id: str | None = None
    config_name: str | None = None
    revision: str | None = None
    path: str | None = None


@dataclass(frozen=True)
class DatasetConfig:
    name: str
    root: str
    output_file: str
    sources: tuple[Source, ...]


def _string(table: dict, key: str, where: str, needed: bool = False) -> str | None:
    value = table.get(key)
    if value is not None and not isinstance(value, str):
        raise ValueError(f"{where}: {key} must be a string")
    value = (value or "").strip() or None
    if needed and value is None:
        raise ValueError(f"{where}: {key} is missing")
    return value


def _flag(table: dict, key: str, where: str) -> bool:
    value = table.get(key, True)
    if not isinstance(value, bool):
        raise ValueError(f"{where}: {key} must be true or false")
    return value


def _source(table: object, where: str) -> Source:
    if not isinstance(table, dict):
        raise ValueError(f"{where} must be a table")
    provider = _string(table, "provider", where, True)
    name = _string(table, "name", where, True)
    needs = {"huggingface": "repo_id", "local_jsonl": "path"}.get(provider)
    inner = table.get(provider, {}) if needs else {}
    if needs and not isinstance(inner, dict) or needs and not inner:
        raise ValueError(f"{where}: provider {provider} needs its own table")
    if needs:
        _string(inner, needs, f"{where}.{provider}", True)
    optional = {k: _string(inner, k, where) for k in ("repo_id", "config_name", "revision", "path")}
    return Source(
        name, provider, _string(table, "adapter", where, True), _string(table, "output_file", where) or f"{name}_tasks.jsonl",
        _flag(table, "enabled", where), _flag(table, "merge_into_world", where), **optional,
    )


def load_config(path: str, root: str | None = None) -> DatasetConfig:
    """A dataset from a TOML file with one or more ``[[sources]]``."""
    with open(path, "rb") as f:
        table = tomllib.load(f)
    name = _string(table, "name", path) or os.path.splitext(os.path.basename(path))[0]
    listed = table.get("sources")
    if not isinstance(listed, list) or not listed:
        raise ValueError(f"{path}: at least one [[sources]] table is needed")
    sources = tuple(_source(s, f"{path}:sources[{i}]") for i, s in enumerate(listed))
    return DatasetConfig(name, root or os.path.join("data", name), _string(table, "merge_output_file", path) or "tasks.jsonl", sources)


def load_folder(root: str) -> DatasetConfig:
    return load_config(os.path.join(root, "dataset.toml"), root)


def resolve_path(root: str, path: str) -> str:
    """An absolute path or URI as it is, one below the root if that exists, else as given."""
    spark = SparkSession.getActiveSession()
    there = os.path.exists if spark is None else lambda p: exists(spark, p)
    if os.path.isabs(path) or "://" in path:
        return path
    below = os.path.join(root, path)
    return below if there(below) else path


def split_names(split: str) -> list[str]:
    return SPLIT_NAMES.get(split, [split])


def pick_split(rows: DataFrame, split_col: str, split: str) -> DataFrame:
    """Rows of the first of the split's names that has any; none at all is an error."""
    for name in split_names(split):
        found = rows.filter(F.col(split_col) == name)
        if not found.isEmpty():
            return found
    raise ValueError(f"no rows for split {split}")


def subject_configs(rows: DataFrame, config: str) -> DataFrame:
    """Configuration names other than the collective ones, sorted."""
    return rows.select(F.col(config).alias("config")).filter(F.col("config").isNotNull() & ~F.col("config").isin(NO_SUBJECT_CONFIGS)).distinct().orderBy("config")


def enabled_sources(table: DataFrame) -> DataFrame:
    """(source_pos, source_name, provider, adapter, location, output_file, merge) of a
    table of sources, defaults filled in; null flags count as true."""
    on = F.coalesce("enabled", F.lit(True))
    place = F.when(F.col("provider") == "local_jsonl", F.col("local_path")).otherwise(F.col("repo_id"))
    return table.filter(on).select(
        "source_pos", "source_name", "provider", "adapter", place.alias("location"),
        F.concat("source_name", F.lit("_tasks.jsonl")).alias("output_file"), F.coalesce("merge_into_world", F.lit(True)).alias("merge_into_world"),
    )
