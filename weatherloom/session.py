"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Static settings are left to the cluster; these are the ones results or plans depend on.
SETTINGS = {
    # hourly grids and text timestamps are UTC; a DST zone would merge or drop hours
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # run-time coalescing, skew splitting and broadcast decisions on measured sizes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where a later aggregate could have reused its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled bytes that one task takes, and size of the pieces a large partition value is split into on
    # write. Sorts and hash tables of narrow, compressed rows need some forty times these bytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # File bytes that one task scans: what it totals before a shuffle grows with them, some twenty-fold.
    "spark.sql.files.maxPartitionBytes": "16m",
}
# Shuffle partitions are only ever joined to that size, never cut, so there must be enough of them.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_INITIAL = 200


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(INITIAL_PARTITIONS, str(max(LEAST_INITIAL, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def build_session(app: str = "weatherloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
