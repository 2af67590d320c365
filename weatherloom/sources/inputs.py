"""Which input files changed since the last build, and which slices of a table they touch.

A manifest table holds a row for each input file: path, size, modification time, schema, and the slices
(seasons, say) its rows belong to. A fresh listing is anti-joined with it both ways; only files that
are new or differ are opened. A slice is stale if a changed file holds it now or held it before. The
manifest is entered in a numbered log after the build, so a build that fails is due again, and of
two builds that started from one manifest the second learns of the first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weatherloom.sources.publish import commit_version, current_entry, published_path
from weatherloom.sources.sink import materialize

#: Footers that are read at a time.
OPEN_FILES = 16
_FILE = "path string, size long, modified timestamp"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, size, modified) of the files at any depth below ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=pattern).load(folder)
    meta = F.col("_metadata")
    return files.select(
        meta["file_path"].alias("path"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("modified")
    )


def file_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, StructType]:
    """Schema of each file, several footers at a time."""
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return dict(zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths), strict=True))


def read_by_schema(spark: SparkSession, schemas: dict[str, StructType]) -> list[tuple[StructType, DataFrame]]:
    """A frame for each schema, over its files: branches of a plan are as many as there are schemas."""
    groups: dict[str, list[str]] = {}
    for path in sorted(schemas):
        groups.setdefault(schemas[path].json(), []).append(path)
    out = []
    for text, paths in groups.items():
        schema = StructType.fromJson(json.loads(text))
        out.append((schema, spark.read.schema(schema).parquet(*paths)))
    return out


@dataclass
class Changes:
    """What a build has to do: ``slices`` to make anew (None stands for null), and ``files``, the
    manifest as it is once that is done."""

    target: str
    base: int
    column: str
    slices: list
    files: DataFrame
    changed: bool = False

    def __bool__(self) -> bool:
        """Whether any file changed; one without rows has no slices."""
        return self.changed

    def holds(self, value: Column) -> Column:
        """Whether a row's slice is to be made anew."""
        return is_one_of(value, self.slices)

    def read(self, spark: SparkSession) -> list[tuple[StructType, DataFrame]]:
        """The files that hold a stale slice, a frame for each schema. Other slices are in them too."""
        stale = self.files.where(F.exists("slices", lambda s: is_one_of(s[self.column], self.slices)))
        rows = stale.select("path", "schema").collect()
        return read_by_schema(spark, {r.path: StructType.fromJson(json.loads(r.schema)) for r in rows})

    def commit(self, spark: SparkSession) -> None:
        """Enter the manifest; raises PublishConflict if another build did so since this one began."""
        name = f"files/{uuid.uuid4().hex}"
        self.files.write.mode("errorifexists").parquet(f"{self.target.rstrip('/')}/{name}")
        commit_version(spark, self.target, name, name, self.files.count(), self.base)


def is_one_of(value: Column, slices: Sequence) -> Column:
    found = value.isin(*[s for s in slices if s is not None])
    return F.coalesce(found, F.lit(False)) | (value.isNull() if None in slices else F.lit(False))


def pending(spark: SparkSession, folder: str, target: str, column: str, kind: str = "int", pattern: str = "*.parquet") -> Changes:
    """Compare ``folder`` with the manifest at ``target``. Without a manifest every file is new.

    Files count as unchanged if path, size and modification time are. Files without ``column``, and rows
    whose value does not read as ``kind``, belong to the null slice.
    """
    entry = current_entry(spark, target)
    kept = f"{_FILE}, schema string, slices array<struct<`{column}`:{kind}>>"
    before = spark.read.schema(kept).parquet(published_path(spark, target)) if entry else spark.createDataFrame([], kept)
    listed = materialize(list_files(spark, folder, pattern), "listing")
    same = ["path", "size", "modified"]
    fresh = listed.join(before.select(same), same, "left_anti")
    gone = before.join(listed, same, "left_anti")
    schemas = file_schemas(spark, [r.path for r in fresh.select("path").collect()])
    opened = spark.createDataFrame([], f"path string, schema string, slices array<struct<`{column}`:{kind}>>")
    for schema, rows in read_by_schema(spark, schemas):
        value = F.col(column).try_cast(kind) if column in schema.names else F.lit(None).cast(kind)
        slices = rows.select(F.col("_metadata.file_path").alias("path"), value.alias(column)).distinct()
        # a set of structs keeps the null slice
        opened = opened.union(slices.groupBy("path").agg(F.collect_set(F.struct(column)).alias("slices")).select(
            "path", F.lit(schema.json()).alias("schema"), "slices"
        ))
    none = F.array().cast(f"array<struct<`{column}`:{kind}>>")
    names = spark.createDataFrame([(p, s.json()) for p, s in schemas.items()], "path string, known string")
    new = fresh.join(opened, "path", "left").join(names, "path", "left").select(
        *same, F.coalesce("schema", "known").alias("schema"), F.coalesce("slices", none).alias("slices")
    )
    new = materialize(new, "opened")
    files = materialize(before.join(gone.select("path"), "path", "left_anti").unionByName(new), "manifest")
    stale = gone.select("slices").union(new.select("slices")).select(F.explode("slices").alias("s")).distinct()
    changed = bool(schemas) or not gone.isEmpty()
    return Changes(target, entry.number if entry else 0, column, [r.s[column] for r in stale.collect()], files, changed)
