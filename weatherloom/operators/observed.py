"""Checks measured on the rows while a table is being written, so that gates need no second read.

The metrics sit on top of the written plan, in the stage whose tasks write the files. Spark counts
such a task once, however often it was tried or run again, so the values are those of the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from weatherloom.operators.aggregate import row_count
from weatherloom.operators.gates import Check, gate_rows


class ObservedChecks:
    """Column checks of one table: attach to what is written, write it, then ask for the report."""

    def __init__(self, checks: Sequence[Check], table: str):
        self.checks, self.table = list(checks), table
        self._names = [f"__check{i}" for i in range(len(self.checks))]
        self._seen, self._schema = Observation(), None

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the metrics on top. Nothing but the write may follow, and the write must run once."""
        if self._schema is not None:
            raise ValueError(f"{self.table}: measured already")
        metrics = [row_count().alias("__rows"), *[c.actual.alias(n) for c, n in zip(self.checks, self._names)]]
        self._schema = df.agg(*metrics).schema
        return df.observe(self._seen, *metrics)

    @property
    def rows(self) -> int:
        """Number of rows written; waits for the write."""
        return self._seen.get["__rows"]

    def report(self, spark: SparkSession) -> DataFrame:
        """Gate rows, from the values alone."""
        if self._schema is None:
            raise ValueError(f"{self.table}: nothing was written")
        seen = self._seen.get
        one = spark.createDataFrame([tuple(seen[f.name] for f in self._schema.fields)], self._schema)
        return gate_rows(one, self.table, self.checks, self._names)
