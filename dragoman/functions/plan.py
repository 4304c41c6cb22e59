"""Plan shaping: evaluate once, cut lineage through a written table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.session import shared_folder


def bind_once(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add computed columns that are evaluated exactly once per row.

    A plain projection is merged into the operators around it: a later filter on the result
    is pushed below the projection and evaluates the expression again. Parsing JSON or
    running a regex cascade twice costs, and repeated inlining can outgrow what codegen
    compiles. A one-element explode is a generator, which the optimizer leaves in place.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns and c not in drop]
    packed = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    once = df.select(*kept, F.explode(packed).alias("_once"))
    return once.select(*kept, *[F.col(f"_once.{name}").alias(name) for name in columns])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by ``key`` to all cores, in a number of partitions that AQE leaves alone.

    For few bytes that become many rows, or much work: AQE goes by the bytes and would put them into one task.
    """
    spark = df.sparkSession
    n = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, F.xxhash64(f"`{key}`"))  # by the bare key it would be left out after a distinct


def through_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results used more than once: they are computed once, and a lost executor rereads
    files instead of replaying the lineage.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
