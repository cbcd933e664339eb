"""Lineage: content hashes per partition, data-set hashes, manifests as JSON."""

from __future__ import annotations

import hashlib
import json
import platform
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.candles import partition_summary
from ..sources.files import read_text, write_text
from .registry import FeatureRegistry

MANIFEST_VERSION = "1.0"

#: Relative difference that recursive and windowed sums may show on another runtime.
FLOAT_TOLERANCE = 1e-10


def row_hash(df: DataFrame, columns: list[str] | None = None):
    """SHA-256 of a row's values as text; NULL differs from the empty text."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns or df.columns]), 256)


def partition_hashes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """year, month, rows, hash: of the day hashes in order, each of the day's row hashes in order.

    File names and row groups don't count, so equal content has equal hashes; no month is one task's list of rows.
    """
    rows = df.select(F.year("timestamp_utc").alias("year"), F.month("timestamp_utc").alias("month"), F.to_date("timestamp_utc").alias("day"), F.hour("timestamp_utc").alias("hour"), row_hash(df, columns).alias("h"))
    joined = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), ""), 256)
    hours = rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"), joined("h").alias("h"))
    days = hours.groupBy("year", "month", "day").agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hour", "h"))), lambda x: x["h"]), ""), 256).alias("h"))
    return days.groupBy("year", "month").agg(F.sum("n").alias("rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "h"))), lambda x: x["h"]), ""), 256).alias("hash"))


def dataset_hash(hashes: DataFrame) -> str:
    """SHA-256 of the partitions' hashes in the order of months."""
    listed = [r["hash"] for r in hashes.orderBy("year", "month").select("hash").toLocalIterator()]
    return hashlib.sha256("".join(listed).encode()).hexdigest()


def candle_manifest(candles: DataFrame, *, source: str, report: dict[str, Any] | None = None, config_hash: str = "", path: str | None = None) -> dict[str, Any]:
    """What the candles are, month by month; the status follows from the validation report.  With `path` also the files of their table."""
    hashes = partition_hashes(candles)
    months = [r.asDict() for r in partition_summary(candles).join(hashes.select("year", "month", "hash"), ["year", "month"]).orderBy("year", "month").collect()]
    return {
        "manifest_version": MANIFEST_VERSION,
        "created_utc": datetime.now(timezone.utc).isoformat(),
        "source": source,
        "config_sha256": config_hash,
        "rows": sum(m["rows"] for m in months),
        "partitions": [{k: v.isoformat() if isinstance(v, datetime) else v for k, v in m.items()} for m in months],
        "dataset_sha256": hashlib.sha256("".join(m["hash"] for m in months).encode()).hexdigest(),
        "files": [] if path is None else _files(candles.sparkSession, path),
        "validation": report or {},
        "status": "PASS" if report is None or report.get("is_valid") else "FAIL",
    }


def file_report(spark: SparkSession, path: str, *, time: str = "timestamp_utc") -> DataFrame:
    """file, bytes, sha256, rows, first_time, last_time of every Parquet file of a table, wherever it lies.

    A file is hashed whole in the task that reads it, so files must be under 2 GB; of the rows only the times are read.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    hashed = found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    rows = spark.read.schema(f"{time} timestamp").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path).select(F.col("_metadata.file_path").alias("file"), time)
    return hashed.join(rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")), "file", "left").na.fill(0, ["rows"])


def _files(spark: SparkSession, path: str) -> list[dict[str, Any]]:
    """The report as rows of JSON, in the order of names below `path`."""
    return [{k: v.isoformat() if isinstance(v, datetime) else v for k, v in r.asDict().items()} for r in file_report(spark, path).orderBy("file").collect()]


def feature_manifest(features: DataFrame, registry: FeatureRegistry, *, candle_manifest_sha256: str = "", path: str | None = None) -> dict[str, Any]:
    """Catalogue, coverage, hashes of a feature table, from two aggregations; with `path` also the files that it lies in."""
    hashes = partition_hashes(features)
    counts = features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("is_warmup").cast("long")).alias("warmup_rows"),
        F.sum(F.col("has_data_gap").cast("long")).alias("gap_rows"),
        F.sum(F.col("is_valid").cast("long")).alias("valid_rows"),
        F.sum((F.col("domain_nan_feature_count") > 0).cast("long")).alias("domain_rows"),
        F.min("timestamp_utc").alias("first_time"),
        F.max("timestamp_utc").alias("last_time"),
    ).first()
    months = [r.asDict() for r in hashes.orderBy("year", "month").collect()]
    return {
        "manifest_version": MANIFEST_VERSION,
        "created_utc": datetime.now(timezone.utc).isoformat(),
        "features": len(registry),
        "columns": [f.name for f in registry.schema()],
        "families": registry.counts_by_family(),
        "max_history": registry.max_history,
        "coverage": {k: v.isoformat() if isinstance(v, datetime) else v for k, v in counts.asDict().items()},
        "partitions": months,
        "dataset_sha256": hashlib.sha256("".join(m["hash"] for m in months).encode()).hexdigest(),
        "candle_manifest_sha256": candle_manifest_sha256,
        "determinism": {"hash": "content", "independent_of": ["files", "row groups", "order of rows"], "float_tolerance": FLOAT_TOLERANCE, "python": platform.python_version(), "spark": features.sparkSession.version},
        "storage": {"format": "parquet", "compression": "zstd", "partitions": ["venue", "instrument", "feature_set", "year", "month"], "files": [] if path is None else _files(features.sparkSession, path)},
    }


def save(spark, manifest: dict[str, Any], path: str) -> str:
    """Write the manifest and return the SHA-256 of its text."""
    text = json.dumps(manifest, indent=2, sort_keys=True, default=str)
    write_text(spark, path, text)
    return hashlib.sha256(text.encode()).hexdigest()


def load(spark, path: str) -> dict[str, Any]:
    return json.loads(read_text(spark, path))


def copy_checked(spark, source: str, target: str) -> str:
    """Copy a text artifact and compare hashes; a mismatch raises RuntimeError."""
    text = read_text(spark, source)
    write_text(spark, target, text)
    digest = hashlib.sha256(text.encode()).hexdigest()
    if hashlib.sha256(read_text(spark, target).encode()).hexdigest() != digest:
        raise RuntimeError(f"{target} differs from {source}")
    return digest
