"""Writers: JSON lines, parquet, small JSON files."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from taskmill.sources.schema import TASK_COLUMNS


def task_lines(tasks: DataFrame) -> DataFrame:
    """(line): one JSON object a task, keys in the writer's order, metadata as an object."""
    plain = F.to_json(F.struct(*[c for c in TASK_COLUMNS if c != "metadata"]), {"ignoreNullFields": "false"})
    head = F.regexp_replace(plain, r"\}\z", "")
    return tasks.select(F.concat(head, F.lit(',"metadata":'), F.coalesce("metadata", F.lit("{}")), F.lit("}")).alias("line"))


def write_tasks(tasks: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = ()) -> int:
    """Writes JSON lines below ``path`` and returns the number of rows, which are counted as
    they are written. With ``order`` the rows lie in that order in the files by name."""
    seen = Observation()
    counted = (tasks.orderBy(*order) if order else tasks).observe(seen, F.count(F.lit(1)).alias("rows"))
    task_lines(counted).write.mode(mode).text(path)
    return seen.get["rows"]


def append_new(samples: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Samples whose key is not among the existing ones yet; null keys count as new."""
    return samples.join(existing.select(key).distinct(), key, "left_anti")


def write_json(value: object, path: str) -> None:
    """Sorted keys, indent 2, written to a temporary file first and then renamed."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=folder, prefix=f".{os.path.basename(path)}.", suffix=".tmp")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(value, f, sort_keys=True, indent=2, ensure_ascii=False)
        os.replace(tmp, path)
    finally:
        if os.path.exists(tmp):
            os.unlink(tmp)


def write_jsonl(rows: list[dict], path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)
