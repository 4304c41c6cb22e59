"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dragoman.functions.plan import through_table
from dragoman.session import BATCH_BYTES, bound_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by Spark's reader; limits the bytes of Arrow batches on the session."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (compared without regard to case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns for a key, kept by a Python worker from task to task.

    Workers outlive a job and serve one operator after another, so a worker keeps the result for one key only:
    another key lets the last one go first.
    """
    if key not in _KEPT:
        let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Frees what the worker keeps."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()  # what is kept may refer to itself
        pa.default_memory_pool().release_unused()


__all__ = ["BATCH_BYTES", "bound_batches", "col", "fresh", "kept", "let_go", "table", "through_table"]
