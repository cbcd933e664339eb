"""Ingestion: resumable backfill of chunks, and expansion of months to candles of all timeframes."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ConfigError, TidemarkError
from ..operators import clean, gaps, validate
from ..operators.resample import resample_all
from ..schema import CANDLE_COLUMNS, CANDLE_SCHEMA, SERIES
from ..sources import klines
from ..sources.candles import content_hash, partitions, read_candles, write_candles
from ..sources.files import delete, exists, make, names, read_text, replace, write_bytes, write_text
from ..sources.http import Archive
from ..sources.provider import DataProvider, with_retry
from . import calendar


class Interrupted(TidemarkError, RuntimeError):
    """The run was stopped; what is done stays done."""


@dataclass(frozen=True)
class Market:
    venue: str
    instrument: str
    market_type: str = "spot"
    timeframe: str = "1m"

    def names(self) -> dict[str, str]:
        return {"venue": self.venue, "instrument": self.instrument, "market_type": self.market_type, "timeframe": self.timeframe}


def checkpoint_id(market: Market, start: str, end: str) -> str:
    safe = lambda x: "".join(c for c in x if c.isalnum())
    return "_".join(safe(x) for x in (market.venue, market.instrument.lower(), market.timeframe, start, end))


class Checkpoint:
    """How far a backfill is, as a JSON file of any store that is replaced whole; a corrupt one raises ConfigError."""

    def __init__(self, spark: SparkSession, folder: str, name: str, **about: Any):
        self._spark, self.path = spark, f"{folder.rstrip('/')}/_checkpoints/{name}.json"
        self.state: dict[str, Any] = {"id": name, **about, "status": "in_progress", "last_error": None, "done": {}}
        if exists(spark, self.path):
            self.state |= _state(spark, self.path)

    @property
    def done(self) -> dict[str, dict[str, Any]]:
        return self.state["done"]

    def _save(self) -> None:
        write_text(self._spark, self.path, json.dumps(self.state, indent=1, sort_keys=True))

    def mark(self, chunk: int, told: dict[str, Any]) -> None:
        self.done[str(chunk)] = told
        self.state["completed_until_ms"] = max(t["end_ms"] for t in self.done.values())
        self._save()

    def end(self, status: str, error: str | None = None) -> None:
        """completed, interrupted or failed."""
        self.state |= {"status": status, "last_error": error}
        self._save()

    def has(self, chunk: int) -> bool:
        """Done, and its file still there."""
        told = self.done.get(str(chunk))
        return told is not None and exists(self._spark, told["path"])


def _state(spark: SparkSession, path: str) -> dict[str, Any]:
    try:
        found = json.loads(read_text(spark, path))
        if isinstance(found.get("done"), dict):
            return found
    except (ValueError, AttributeError):
        pass
    raise ConfigError(f"{path} is no checkpoint")


def find_checkpoints(spark: SparkSession, folder: str, *, status: str | None = None) -> list[dict[str, Any]]:
    """The states of all backfills that landed in `folder`, by id."""
    at = f"{folder.rstrip('/')}/_checkpoints"
    states = [_state(spark, f"{at}/{n}") for n in names(spark, at) if n.endswith(".json") and not n.startswith(".")]
    return [s for s in states if status is None or s["status"] == status]


def land(spark: SparkSession, provider: DataProvider, market: Market, start_ms: int | None, end_ms: int | None, limit: int, target: str) -> dict[str, Any]:
    """One page of a provider as a file of any store; tells its path, rows, bytes, SHA-256 and what the provider told."""
    page = provider.fetch(market.instrument, market.timeframe, start_ms, end_ms, limit)
    write_bytes(spark, target, page.raw)
    return {"path": target, "source": provider.name, **page.about()}


def backfill(spark: SparkSession, provider: DataProvider, market: Market, start: str, end: str, *, landing: str, limit: int = 1000, attempts: int = 5, resume: bool = True, stop: Callable[[int], bool] | None = None, wait: Callable[[float], None] | None = None) -> DataFrame:
    """Fetch [start, end) in chunks to `landing`, resuming what a run before did, and give cleaned candles with `seq`.

    Exact duplicates go, conflicting candles stay for the validator.  `stop(done)` interrupts between chunks.  A chunk that
    can't be fetched leaves the state failed, with the error; the next run goes on from there.
    """
    name = checkpoint_id(market, start, end)
    make(spark, f"{landing.rstrip('/')}/_checkpoints")
    plan = calendar.plan_chunks(spark, start, end, market.timeframe, limit=limit).orderBy("chunk").collect()
    if not resume:
        delete(spark, f"{landing.rstrip('/')}/_checkpoints/{name}.json")
    state = Checkpoint(spark, landing, name, **market.names(), start=start, end=end)
    if state.state.setdefault("limit", limit) != limit:
        raise ConfigError(f"{name} was begun with chunks of {state.state['limit']} candles, not {limit}")
    state.state["planned"] = len(plan)
    options = {} if wait is None else {"sleep": wait}
    try:
        for done, row in enumerate(plan):
            if stop is not None and stop(done):
                raise Interrupted(f"stopped before chunk {row['chunk']}")
            if state.has(row["chunk"]):
                continue
            lo, hi = row["start_ms"], row["end_ms"]
            target = f"{landing.rstrip('/')}/{market.instrument.lower()}_{market.timeframe}_{lo}_{hi}.json"
            told = with_retry(lambda: land(spark, provider, market, lo, hi, limit, target), attempts=attempts, **options)  # noqa: B023
            state.mark(row["chunk"], {"start_ms": lo, "end_ms": hi, **told})
    except Interrupted as e:
        state.end("interrupted", str(e))
        raise
    except Exception as e:
        state.end("failed", f"{type(e).__name__}: {e}")
        raise
    state.end("completed")
    candles = klines.candles_from_json(spark, [state.done[str(r["chunk"])]["path"] for r in plan], **market.names())
    ordered = candles.withColumn("seq", F.unix_micros("timestamp_utc"))
    return clean.drop_exact_duplicates(ordered, seq="seq")


def from_archive(spark: SparkSession, archive: Archive, market: Market, first: str, last: str, *, landing: str) -> DataFrame:
    """Candles with `seq` of the days [first, last]: monthly archives of whole months, daily ones of others, landed and verified."""
    plan = calendar.plan_months(spark, first, last).orderBy("year", "month").collect()
    landed = archive.land_plan(spark, landing, market.instrument, market.timeframe, plan)
    return klines.candles_from_zip(spark, [t["path"] for t in landed], checksums=True, **market.names())


#: A row of the partition manifests of a table: what was expanded, from what, and what was written.
MANIFEST = ", ".join(f"{c} string" for c in SERIES) + ", year int, month int, raw_rows long, raw_hash string, rows long, hash string, first_time timestamp, last_time timestamp, gaps long, issues long, status string"


def manifests(spark: SparkSession, table: str) -> DataFrame:
    """Partition manifests that `expand` has left with a table; none if there aren't any."""
    path = f"{table.rstrip('/')}/_manifests"
    return spark.read.schema(MANIFEST).parquet(path) if exists(spark, path) else spark.createDataFrame([], MANIFEST)


def expand(spark: SparkSession, raw: DataFrame, *, table: str, gap_registry: str | None = None, start: str | None = None, end: str | None = None, force: bool = False, source: str = "archive", identity: str | None = None) -> DataFrame:
    """One job over all months of all series: bounds, last writer per time, validation, gaps, one-minute candles and five higher timeframes.

    `raw` are candles with `seq`, read once.  A month of a series is skipped if its manifest tells the same raw rows
    (number and content) and the table still has the rows that it tells.  Other months are merged with the minutes that
    the table has (these win, a conflict raises), or replaced if `force`d, and then all timeframes of the month are
    written anew, so a run that failed can be run again.  Manifests come last.  Gives the validation summary per series.

    `identity` tells what the raw rows are, such as a hash of their files: where a run of the same one has ended and its
    months are whole, nothing is read.
    """
    aside, month = f"{table.rstrip('/')}.expand-{uuid.uuid4().hex}", [*SERIES, "year", "month"]
    run = None if identity is None else f"{table.rstrip('/')}/_runs/{hashlib.sha256(json.dumps([identity, start, end]).encode()).hexdigest()}"
    if run is not None and not force and exists(spark, f"{run}/_SUCCESS"):
        whole = manifests(spark, table).join(partitions(spark, table), [*month, "rows"], "left_semi")
        if spark.read.parquet(run).join(whole, month, "left_anti").isEmpty():
            return spark.createDataFrame([], validate.summary(validate.annotate(spark.createDataFrame([], CANDLE_SCHEMA).withColumn("seq", F.lit(0)))).schema)
    with_month = lambda df: df.withColumns({"year": F.year("timestamp_utc"), "month": F.month("timestamp_utc")})
    try:
        with_month(clean.keep_last(clean.within(raw, start, end), seq="seq")).select(*CANDLE_COLUMNS, "year", "month").write.parquet(f"{aside}/raw")
        rows = spark.read.parquet(f"{aside}/raw")
        told = rows.groupBy(*month).agg(F.count(F.lit(1)).alias("raw_rows"), content_hash(CANDLE_COLUMNS).alias("raw_hash"))
        told.write.parquet(f"{aside}/all")
        told = spark.read.parquet(f"{aside}/all")
        ended = lambda: run is None or spark.read.parquet(f"{aside}/all").select(*month).coalesce(1).write.mode("overwrite").parquet(run)
        old = manifests(spark, table)
        if not force:
            held = old.where("timeframe = '1m'").join(partitions(spark, table), [*month, "rows"], "left_semi")
            told = told.join(held.select(*month, "raw_rows", "raw_hash"), [*month, "raw_rows", "raw_hash"], "left_anti")
        told.write.parquet(f"{aside}/told")
        told = spark.read.parquet(f"{aside}/told")
        rows = rows.join(F.broadcast(told.select(*month)), month, "left_semi").select(*CANDLE_COLUMNS)  # one row per month of a series
        if not force and exists(spark, table):
            before = with_month(read_candles(spark, table)).join(F.broadcast(told.select(*month)), month, "left_semi").select(*CANDLE_COLUMNS)
            rows = clean.merge_overlap(before, rows)
        rows.write.parquet(f"{aside}/minutes")
        minutes = spark.read.schema(CANDLE_SCHEMA).parquet(f"{aside}/minutes")
        annotated = validate.annotate(minutes.withColumn("seq", F.unix_seconds("timestamp_utc")))
        summary = spark.createDataFrame(validate.summary(annotated).collect(), validate.summary(annotated).schema)  # one row per series
        if minutes.isEmpty():
            ended()
            return summary
        found = gaps.register(validate.gaps(annotated), source=source)
        if gap_registry is not None:
            gaps.save(gaps.upsert(gaps.load(spark, gap_registry), found), gap_registry)
        everything = minutes.unionByName(resample_all(minutes))
        write_candles(everything, table)
        # What the table now has of these months, read back from it.
        fresh = with_month(read_candles(spark, table)).join(F.broadcast(told.select(*[c for c in month if c != "timeframe"]).distinct()), [c for c in month if c != "timeframe"], "left_semi")
        fresh = fresh.groupBy(*month).agg(F.count(F.lit(1)).alias("rows"), content_hash(CANDLE_COLUMNS).alias("hash"), F.min("timestamp_utc").alias("first_time"), F.max("timestamp_utc").alias("last_time"))
        issues = with_month(annotated).groupBy(*month).agg(F.sum(F.size(F.filter("issues", lambda i: i != "DATA_GAP_DETECTED"))).cast("long").alias("issues"), F.sum(F.array_contains("issues", "DATA_GAP_DETECTED").cast("long")).alias("gaps"))
        fresh = fresh.join(told, month, "left").join(issues, month, "left").na.fill(0, ["issues", "gaps"]).withColumn("status", F.when(F.col("issues") > 0, "WARNING").otherwise("PASS"))
        kept = old.join(fresh.select(*month), month, "left_anti")
        replace(kept.select(*[c.split()[0] for c in MANIFEST.split(", ")]).unionByName(fresh.select(*[c.split()[0] for c in MANIFEST.split(", ")])).coalesce(1), f"{table.rstrip('/')}/_manifests")
        root_manifest(spark, table)
        ended()
        return summary
    finally:
        delete(spark, aside)


def root_manifest(spark: SparkSession, table: str) -> dict[str, Any]:
    """Totals and one hash over the partition manifests, by timeframe, saved beside them; PASS only if every partition passed."""
    by = manifests(spark, table).groupBy("timeframe").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"), F.sum("gaps").alias("gaps"), F.sum("issues").alias("issues"), F.min("first_time").cast("string").alias("first_time"), F.max("last_time").cast("string").alias("last_time"),
        content_hash([*SERIES, "year", "month", "rows", "hash"]).alias("hash"),
    )
    told = {r["timeframe"]: {k: v for k, v in r.asDict().items() if k != "timeframe"} for r in by.collect()}
    out = {"rows": sum(t["rows"] for t in told.values()), "timeframes": told, "status": "PASS" if told and not any(t["issues"] for t in told.values()) else "WARNING"}
    write_text(spark, f"{table.rstrip('/')}/_root_manifest.json", json.dumps(out, indent=2, sort_keys=True))
    return out


__all__ = ["Checkpoint", "Interrupted", "Market", "backfill", "checkpoint_id", "expand", "find_checkpoints", "from_archive", "land", "manifests", "root_manifest"]
