"""Publish a table behind gates: stage a new version, check it, then enter it in the table's log.

The log is a folder of numbered entries; the greatest number is the current version. An entry is
complete from the moment it exists and is created only if its number is free, so of publishers that
compete for a number one wins and the others learn of it. Readers follow the log: they see the old
version or the new one and never a half-written mix, and nothing a reader may hold is replaced.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.contracts import Contract
from weatherloom.operators.columns import conform
from weatherloom.operators.gates import (
    Check,
    GateError,
    any_null_check,
    column_checks,
    duplicate_check,
    enforce,
    not_null_check,
    range_check,
    run_gates,
    schema_rows,
)
from weatherloom.operators.observed import ObservedChecks
from weatherloom.operators.aggregate import row_count
from weatherloom.sources.sink import _hadoop_path, path_exists, write_partitioned

# not a leading underscore: Spark readers skip such names
LOG = "LOG"


class PublishConflict(GateError):
    """Somebody else published in between; what they published stays current."""


@dataclass(frozen=True)
class Entry:
    """One line of a table's history: the folder, below the table, that holds a version."""

    number: int
    version: str
    folder: str
    rows: int
    published_at: str


def _log_entry(target: str, number: int) -> str:
    return f"{target.rstrip('/')}/{LOG}/{number:012d}"


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content in one step; False if ``path`` exists already.

    Local files are linked into place and other file systems with an atomic rename rename into place,
    both of which refuse an existing name. Object stores create the object on the condition that none
    is there; their connector must support that, as it must for any log of this kind.
    """
    final, fs = _hadoop_path(spark, path)
    scheme = fs.getUri().getScheme()
    if not scheme.startswith(("file", "hdfs", "viewfs")):
        return _create(spark, fs, final, text)
    draft, _ = _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    _create(spark, fs, draft, text)
    try:
        if scheme == "file":
            local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, draft)]
            spark._jvm.java.nio.file.Files.createLink(*local)
            return True
        return bool(fs.rename(draft, final)) and not fs.exists(draft)
    except Exception as exc:
        if "FileAlreadyExists" in str(exc):
            return False
        raise
    finally:
        fs.delete(draft, False)


def _create(spark: SparkSession, fs, path, text: str) -> bool:
    try:
        stream = fs.create(path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True
    except Exception as exc:
        if "FileAlreadyExists" in str(exc) or "PreconditionFailed" in str(exc) or "412" in str(exc):
            return False
        raise


def history(spark: SparkSession, target: str) -> list[Entry]:
    """The entries of the log, oldest first. One line a publish; :func:`drop_old_versions` shortens it."""
    folder = f"{target.rstrip('/')}/{LOG}"
    if not path_exists(spark, folder):
        return []
    root, fs = _hadoop_path(spark, folder)
    names = [f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(root) if s.getPath().getName().isdigit()]
    lines = spark.read.text(names).collect() if names else []
    return sorted((Entry(**json.loads(r.value)) for r in lines), key=lambda e: e.number)


def current_entry(spark: SparkSession, target: str) -> Entry | None:
    """The entry of the greatest number; reads that one alone."""
    folder = f"{target.rstrip('/')}/{LOG}"
    if not path_exists(spark, folder):
        return None
    root, fs = _hadoop_path(spark, folder)
    numbers = [int(n) for s in fs.listStatus(root) if (n := s.getPath().getName()).isdigit()]
    if not numbers:
        return None
    return Entry(**json.loads(spark.read.text(_log_entry(target, max(numbers))).first().value))


def current_version(spark: SparkSession, target: str) -> str | None:
    entry = current_entry(spark, target)
    return entry.version if entry else None


def published_path(spark: SparkSession, target: str) -> str:
    """Folder of the current version."""
    entry = current_entry(spark, target)
    if entry is None:
        raise FileNotFoundError(f"nothing published at {target}")
    return f"{target.rstrip('/')}/{entry.folder}"


def read_published(spark: SparkSession, target: str, contract: Contract) -> DataFrame:
    return _read_version(spark, published_path(spark, target), contract)


def _read_version(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    # partition values come back with inferred types; conform restores contract types and order
    return conform(spark.read.parquet(path), contract.schema)


def as_written(df: DataFrame, contract: Contract) -> DataFrame:
    """A table as its files have it, for :func:`schema_check`.

    Partition values are in the paths: files give them neither type nor place, so they get the
    contract's. All other columns keep the names, types and order they were written with.
    """
    parts = {c: contract.schema[c].dataType for c in contract.partitions if c in df.columns}
    rest = [c for c in df.columns if c not in parts]
    order: list[str] = []
    for name in contract.columns:
        order += [name] if name in parts else rest[:1]
        rest = rest if name in parts else rest[1:]
    return df.select(*[F.col(c).try_cast(parts[c]).alias(c) if c in parts else F.col(c) for c in order + rest])


def commit_version(
    spark: SparkSession, target: str, version: str, folder: str, rows: int, base: int, retry: bool = False
) -> Entry:
    """Enter a staged version behind entry ``base`` (0: nothing published).

    If another publisher took that number, the data at hand may be older than what is current now:
    raises :class:`PublishConflict`. With ``retry``, for versions that do not depend on the one before,
    the next free number is taken instead.
    """
    number = base + 1
    while True:
        at = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        entry = Entry(number, version, folder, rows, at)
        if create_if_absent(spark, _log_entry(target, number), json.dumps(asdict(entry)) + "\n"):
            return entry
        now = current_entry(spark, target)
        if not retry:
            raise PublishConflict(
                f"{target}: version {version} was made on top of entry {base}, but entry {now.number}, version {now.version}, "
                f"was published at {now.published_at}; it stays current"
            )
        number = max(number, now.number) + 1


def drop_old_versions(spark: SparkSession, target: str) -> int:
    """Delete the versions the log lists before the current one, and their entries; returns how many.
    For when no reader is left on an older version. What other publishers are staging is not touched."""
    *old, _ = history(spark, target) or [None]
    for entry in old:
        for name in (f"{target.rstrip('/')}/{entry.folder}", _log_entry(target, entry.number)):
            path, fs = _hadoop_path(spark, name)
            fs.delete(path, True)
    return len(old)


def row_count_check(expected: int) -> Check:
    return Check("row_count", row_count(), expected, lambda a: a == F.lit(expected))


def contract_checks(contract: Contract, expected_rows: int | None = None) -> list[Check]:
    """The checks a contract implies that are plain aggregates of the rows."""
    checks = [not_null_check(c) for c in contract.not_null]
    checks += [range_check(c, 0.0, 1.0) for c in contract.ratios]
    if contract.partitions:
        checks.append(any_null_check("null_partition_keys", contract.partitions))
    if expected_rows is not None:
        checks.append(row_count_check(expected_rows))
    return checks


def schema_gate(files: DataFrame, contract: Contract) -> DataFrame:
    """Names, order and types as the files have them, before the table is conformed."""
    return schema_rows(as_written(files, contract), contract.name, contract.schema)


def contract_gates(
    df: DataFrame, contract: Contract, expected_rows: int | None = None, files: DataFrame | None = None
) -> DataFrame:
    """Every check a contract implies, as gate rows. ``files`` is the table as read, before it was
    conformed: conforming would hide a missing or mistyped column from the schema check."""
    checks = contract_checks(contract, expected_rows)
    gates = [schema_gate(df if files is None else files, contract)]
    gates.append(duplicate_check(df, contract.name, contract.grain, surplus=True))
    if checks:
        gates.append(column_checks(df, contract.name, checks))
    return run_gates(gates)


def publish_swap(
    df: DataFrame,
    target: str,
    contract: Contract,
    version: str,
    expected_rows: int | None = None,
    extra_gates: Sequence[DataFrame] = (),
    retry: bool = False,
) -> DataFrame:
    """Stage, gate, enter in the log. Raises and leaves the current version current on any failure.

    Row counts, nulls and ranges are measured on the rows while they are written; only the check for
    repeated keys reads the staged files again. Every publish stages into a folder of its own, so a
    failed one can be repeated under its id, and two of the same id do not meet. If another version
    was published since this call began, raises :class:`PublishConflict`; ``retry`` publishes on top of
    it instead. Returns the gate report, a row per check.
    """
    spark = df.sparkSession
    base = current_entry(spark, target)
    if base and base.version == version:
        raise GateError(f"{contract.name}: version {version} is current and stays as it is")
    folder = f"version={version}/{uuid.uuid4().hex}"
    staged_path = f"{target.rstrip('/')}/{folder}"
    missing = [c for c in contract.columns if c not in df.columns]
    measured = ObservedChecks([] if missing else contract_checks(contract, expected_rows), contract.name)
    if contract.partitions and not set(contract.partitions) & set(missing):
        write_partitioned(df, staged_path, contract.partitions, mode="errorifexists", clustered=True, measured=measured)
    else:
        measured.attach(df).write.mode("errorifexists").parquet(staged_path)
    files = spark.read.parquet(staged_path)
    enforce(schema_gate(files, contract), f"{contract.name} {version} not published")
    staged = conform(files, contract.schema)
    rereads = [duplicate_check(staged, contract.name, contract.grain, surplus=True), *extra_gates]
    gates = run_gates([schema_gate(files, contract), measured.report(spark), *rereads])
    report = spark.createDataFrame(gates.collect(), gates.schema)  # evaluated once
    enforce(report, f"{contract.name} {version} not published")
    entry = commit_version(spark, target, version, folder, measured.rows, base.number if base else 0, retry)
    if (now := current_entry(spark, target)).number < entry.number:
        raise GateError(f"{contract.name}: the log ends at {now.number} after entry {entry.number}")
    return report


def publish_metadata(
    tables: dict[str, DataFrame], root: str, contracts: dict[str, Contract], run_id: str, rows: dict[str, int]
) -> dict[str, DataFrame]:
    """Publish the audit tables of one run: other runs in an appended table are left out first."""
    reports = {}
    for label, df in tables.items():
        one_run = conform(df.filter(F.col("serving_run_id") == run_id), contracts[label].schema)
        reports[label] = publish_swap(
            one_run, f"{root.rstrip('/')}/{contracts[label].name}", contracts[label], run_id, rows[label]
        )
    return reports
