"""Whole runs from a source to tables, manifests and reports under one root."""

from __future__ import annotations

import json
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..logs import get
from ..operators import validate
from ..paths import Layout
from ..schema import CANDLE_COLUMNS
from ..sources import klines
from ..sources.candles import inspect_candles, merge_candles, read_candles
from ..sources.http import Archive
from ..sources.provider import DataProvider
from . import calendar, ingest, manifest, report


def _table(layout: Layout) -> str:
    return layout.inside("data/processed", "candles")


def _minutes(rows: DataFrame, market: ingest.Market) -> DataFrame:
    return rows.where((F.col("instrument") == market.instrument.upper()) & (F.col("venue") == market.venue.lower()) & (F.col("market_type") == market.market_type.lower()))


def pilot(spark: SparkSession, provider: DataProvider, market: ingest.Market, layout: Layout, *, limit: int = 120) -> dict[str, Any]:
    """The last `limit` klines of a provider: landed, read, validated, merged into the table, with a manifest; tells what came of it."""
    layout.prepare(spark)
    told: dict[str, Any] = {"reachable": provider.ping()}
    folder = layout.series("data/raw", market.venue, market.market_type, market.instrument, market.timeframe)
    landed = ingest.land(spark, provider, market, None, None, limit, f"{folder}/pilot_{int(time.time() * 1000)}.json")
    rows = klines.candles_from_json(spark, landed["path"], **market.names()).withColumn("seq", F.unix_micros("timestamp_utc"))
    checked = validate.summary(validate.annotate(rows)).first()
    if checked is None:
        return told | {"landed": landed, "rows": 0, "is_valid": True}
    merge_candles(rows.drop("seq"), _table(layout))
    about = manifest.candle_manifest(rows.drop("seq"), source=provider.name, report={"is_valid": bool(checked["is_valid"]), "issues": checked["total_issues"]})
    path = layout.inside("artifacts/manifests", f"pilot_{market.instrument.lower()}_{market.timeframe}.json")
    digest = manifest.save(spark, about | {"raw": landed}, path)
    back = inspect_candles(_minutes(read_candles(spark, _table(layout)), market).where(F.col("timeframe") == market.timeframe)).first()
    return told | {"landed": landed, "rows": checked["total_records"], "is_valid": bool(checked["is_valid"]), "table_rows": back["rows"], "manifest": path, "manifest_sha256": digest}


def backfill_phase(spark: SparkSession, provider: DataProvider, market: ingest.Market, start: str, end: str, layout: Layout, *, limit: int = 1000) -> list[dict[str, Any]]:
    """Backfill, validate, expand to all timeframes, manifest and quality report of [start, end); run again, it goes on where it ended."""
    began = time.time()
    layout.prepare(spark)
    folder = layout.series("data/raw", market.venue, market.market_type, market.instrument, market.timeframe)
    rows = ingest.backfill(spark, provider, market, start, end, landing=folder, limit=limit)
    state = ingest.Checkpoint(spark, folder, ingest.checkpoint_id(market, start, end)).done
    return _finish(spark, rows, market, start, end, layout, source=provider.name, landed=list(state.values()), acquired=time.time() - began)


def archive_phase(spark: SparkSession, archive: Archive, market: ingest.Market, first: str, last: str, layout: Layout) -> list[dict[str, Any]]:
    """The same from archives of the days [first, last]: land, verify, expand, manifest, report."""
    began = time.time()
    layout.prepare(spark)
    folder = layout.inside("data/raw", market.venue.lower(), market.market_type.lower())
    plan = calendar.plan_months(spark, first, last).orderBy("year", "month").collect()
    landed = archive.land_plan(spark, folder, market.instrument, market.timeframe, plan)
    rows = klines.candles_from_zip(spark, [t["path"] for t in landed], checksums=True, **market.names())
    bounds = str(plan[0]["start"]), str(plan[-1]["end"])
    return _finish(spark, rows, market, *bounds, layout, source="archive", landed=landed, acquired=time.time() - began)


def _finish(spark: SparkSession, rows: DataFrame, market: ingest.Market, start: str, end: str, layout: Layout, *, source: str, landed: list[dict[str, Any]], acquired: float) -> list[dict[str, Any]]:
    began, table = time.time(), _table(layout)
    identity = json.dumps([market.names(), sorted(t["sha256"] for t in landed)])
    ingest.expand(spark, rows, table=table, gap_registry=layout.inside("data/metadata", "gaps"), start=start, end=end, source=source, identity=identity)
    held = _minutes(read_candles(spark, table), market).where((F.col("timestamp_utc") >= F.lit(start).cast("timestamp")) & (F.col("timestamp_utc") < F.lit(end).cast("timestamp")))
    minutes = held.where("timeframe = '1m'").withColumn("seq", F.unix_seconds("timestamp_utc"))
    name = ingest.checkpoint_id(market, start, end)
    told = report.quality_summary(validate.annotate(minutes), held, start, end, landed=landed, acquisition_seconds=round(acquired, 2), processing_seconds=round(time.time() - began, 2))
    found = report.save_quality(spark, told, layout.inside("artifacts/reports", f"quality_{name}.json"))
    manifest.save(spark, manifest.candle_manifest(held.where("timeframe = '1m'").select(*CANDLE_COLUMNS), source=source, report={"is_valid": all(r["status"] == "PASS" for r in found)}) | {"raw": landed}, layout.inside("artifacts/manifests", f"candles_{name}.json"))
    get().info("%s of [%s, %s): %s", market.instrument, start, end, [r["status"] for r in found])
    return found


def audit(spark: SparkSession, table: str) -> DataFrame:
    """Per month of every series: rows, distinct times, duplicates, and whether the manifests tell the same rows."""
    held = read_candles(spark, table).withColumns({"year": F.year("timestamp_utc"), "month": F.month("timestamp_utc")})
    keys = [*validate.SERIES, "year", "month"]
    # one row per time first, so that no month is one task's set of times
    times = held.groupBy(*keys, "timestamp_utc").agg(F.count(F.lit(1)).alias("n"))
    found = times.groupBy(*keys).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_times")).withColumn("duplicates", F.col("rows") - F.col("distinct_times"))
    told = ingest.manifests(spark, table).select(*keys, F.col("rows").alias("told_rows"))
    return found.join(told, keys, "full").withColumn("agrees", F.col("rows").eqNullSafe(F.col("told_rows")) & (F.coalesce("duplicates", F.lit(0)) == 0))


__all__ = ["archive_phase", "audit", "backfill_phase", "pilot"]
