"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weatherloom.sources.sink import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a plain write, columns whose type the empty frame leaves open keep their declared type.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
