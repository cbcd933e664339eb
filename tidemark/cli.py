"""Command line: `python -m tidemark.cli <command>`; commands read and write candle tables with Spark."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from . import health
from .operators import gaps, validate
from .operators.resample import resample_all
from .paths import Layout
from .plans import ingest, manifest, phases
from .plans.engine import FeatureEngine, FeatureInput
from .plans.registry import default_registry
from .schema import RESAMPLED
from .session import session
from .sources import klines
from .sources.candles import inspect_timeframes, merge_candles, read_candles, read_features, write_candles, write_features
from .sources.http import Archive, HttpProvider, trade_probe, websocket_connect
from .sources.provider import DataProvider, LandedProvider
from .streaming.live import latency_metrics


def _market(p: argparse.ArgumentParser) -> None:
    p.add_argument("--venue", required=True)
    p.add_argument("-s", "--symbol", "--instrument", dest="instrument", required=True)
    p.add_argument("--market-type", default="spot")


def _source(p: argparse.ArgumentParser) -> None:
    g = p.add_mutually_exclusive_group(required=True)
    g.add_argument("--source", help="JSON file of klines")
    g.add_argument("--url", help="address of a service of klines")


def _provider(args: argparse.Namespace) -> DataProvider:
    return HttpProvider(args.url) if args.url else LandedProvider(args.source)


def _listed(values: list[str]) -> list[str]:
    """Values given apart or joined by commas."""
    return [x for v in values for x in v.split(",") if x]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)
    h = sub.add_parser("health", help="what the engine relies on, checked")
    h.add_argument("--root", help="also check the areas of this root")
    h.add_argument("--repository", help="also check this git repository")
    h.add_argument("--config", nargs="*", default=[])
    a = sub.add_parser("acquire", help="raw klines to a candle table, with a manifest")
    a.add_argument("files", nargs="+")
    a.add_argument("--table", required=True)
    a.add_argument("--manifest")
    _market(a)
    a.add_argument("-t", "--timeframe", default="1m")
    e = sub.add_parser("expand", help="archives to one-minute candles and five higher timeframes")
    e.add_argument("files", nargs="+")
    e.add_argument("--table", required=True)
    e.add_argument("--gaps")
    e.add_argument("--start")
    e.add_argument("--end")
    e.add_argument("--force", action="store_true")
    _market(e)
    b = sub.add_parser("backfill", help="klines of a landed source, chunk by chunk and resumable, to a candle table")
    _source(b)
    b.add_argument("--landing", required=True)
    b.add_argument("--table", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--limit", type=int, default=1000)
    _market(b)
    t = sub.add_parser("pilot", help="the last klines of a source, landed, validated, written, with a manifest")
    _source(t)
    _market(t)
    t.add_argument("--root", required=True)
    t.add_argument("-t", "--timeframe", default="1m")
    t.add_argument("-l", "--limit", type=int, default=120)
    n = sub.add_parser("phase", help="a source's whole range to tables of all timeframes, manifests and a quality report")
    k = n.add_mutually_exclusive_group(required=True)
    k.add_argument("--source", help="JSON file of klines")
    k.add_argument("--url", help="address of a service of klines")
    k.add_argument("--archive", help="address of an archive of zipped klines; start and end are then days, both taken")
    _market(n)
    n.add_argument("--root", required=True)
    n.add_argument("--start", required=True)
    n.add_argument("--end", required=True)
    n.add_argument("--limit", type=int, default=1000)
    x = sub.add_parser("audit", help="rows, duplicates and manifests of a table's months")
    x.add_argument("--table", required=True)
    c = sub.add_parser("checkpoints", help="backfills that landed in a folder")
    c.add_argument("--landing", required=True)
    c.add_argument("--status")
    y = sub.add_parser("ws-test", help="latency of a live stream of trades (needs the package websockets)")
    y.add_argument("--url", required=True, help="address of the service of klines, for its clock")
    y.add_argument("--stream-url", required=True)
    y.add_argument("-s", "--symbol", required=True)
    y.add_argument("-d", "--duration", type=float, default=5.0)
    w = sub.add_parser("probe", help="latency of received messages (a JSON table of event_ms and ingest_ms)")
    w.add_argument("--messages", required=True)
    w.add_argument("--skew-ms", type=int, default=0)
    r = sub.add_parser("resample")
    r.add_argument("--table", required=True)
    r.add_argument("-s", "--symbol", help="this instrument only")
    r.add_argument("-t", "--timeframes", nargs="+", default=list(RESAMPLED))
    i = sub.add_parser("inspect")
    i.add_argument("--table", required=True)
    v = sub.add_parser("validate")
    v.add_argument("--table", required=True)
    g = sub.add_parser("gaps")
    g.add_argument("--registry", required=True)
    f = sub.add_parser("features")
    f.add_argument("--table", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--manifest")
    return p


def _read(spark, files: list[str], names: dict[str, str]):
    kind = {f.rsplit(".", 1)[-1] for f in files}
    if kind == {"json"}:
        return klines.candles_from_json(spark, files, **names).withColumn("seq", F.unix_micros("timestamp_utc"))
    return klines.candles_from_zip(spark, files, **names) if kind == {"zip"} else klines.candles_from_csv(spark, files, **names)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or session("tidemark", args.master)
    show = lambda df: print(df.toPandas().to_string(index=False))  # noqa: E731  small results
    if args.command == "health":
        found = health.check(spark, layout=Layout(args.root) if args.root else None, configs=args.config, root=args.repository)
        print(json.dumps({k: {"ok": ok, "detail": detail} for k, (ok, detail) in found.items()}))
        return int(not all(ok for ok, _ in found.values()))
    if args.command == "acquire":
        rows = _read(spark, args.files, {"venue": args.venue, "instrument": args.instrument, "market_type": args.market_type, "timeframe": args.timeframe})
        told = validate.summary(validate.annotate(rows)).first()
        merge_candles(rows.drop("seq"), args.table)
        if args.manifest:
            manifest.save(spark, manifest.candle_manifest(rows.drop("seq"), source="acquire", report={"is_valid": bool(told["is_valid"]), "issues": told["total_issues"]}), args.manifest)
        return int(not told["is_valid"])
    if args.command == "expand":
        rows = _read(spark, args.files, {"venue": args.venue, "instrument": args.instrument, "market_type": args.market_type, "timeframe": "1m"})
        show(ingest.expand(spark, rows, table=args.table, gap_registry=args.gaps, start=args.start, end=args.end, force=args.force))
    elif args.command == "backfill":
        market = ingest.Market(args.venue, args.instrument, args.market_type)
        rows = ingest.backfill(spark, _provider(args), market, args.start, args.end, landing=args.landing, limit=args.limit)
        told = validate.summary(validate.annotate(rows)).first()
        merge_candles(rows.drop("seq"), args.table)
        print(json.dumps({"candles": told["total_records"], "gaps": told["gaps"], "is_valid": told["is_valid"]}))
        return int(not told["is_valid"])
    elif args.command == "pilot":
        told = phases.pilot(spark, _provider(args), ingest.Market(args.venue, args.instrument, args.market_type, args.timeframe), Layout(args.root), limit=args.limit)
        print(json.dumps(told, default=str))
        return int(not told["is_valid"])
    elif args.command == "phase":
        market, layout = ingest.Market(args.venue, args.instrument, args.market_type), Layout(args.root)
        told = phases.archive_phase(spark, Archive(args.archive), market, args.start, args.end, layout) if args.archive else phases.backfill_phase(spark, _provider(args), market, args.start, args.end, layout, limit=args.limit)
        print(json.dumps(told, default=str))
        return int(not told or any(r["status"] != "PASS" for r in told))
    elif args.command == "audit":
        found = phases.audit(spark, args.table)
        show(found.orderBy(*found.columns[:6]))
        return int(not found.where("not agrees").isEmpty())
    elif args.command == "checkpoints":
        print(json.dumps([{k: v for k, v in s.items() if k != "done"} for s in ingest.find_checkpoints(spark, args.landing, status=args.status)]))
    elif args.command == "ws-test":
        try:
            connect = websocket_connect(args.stream_url)
        except ImportError:
            print("ws-test needs the package websockets", file=sys.stderr)
            return 2
        print(json.dumps(trade_probe(connect, HttpProvider(args.url), args.symbol, seconds=args.duration)))
    elif args.command == "probe":
        show(latency_metrics(spark.read.schema("event_ms long, ingest_ms long").json(args.messages), skew_ms=args.skew_ms))
    elif args.command == "gaps":
        show(gaps.by_category(gaps.load(spark, args.registry)))
    else:
        candles = read_candles(spark, args.table)
        minutes = candles.where(F.col("timeframe") == "1m")
        if args.command == "resample":
            chosen = minutes.where(F.col("instrument") == args.symbol.upper()) if args.symbol else minutes
            write_candles(resample_all(chosen, _listed(args.timeframes)), args.table)
        elif args.command == "inspect":
            show(inspect_timeframes(candles))
        elif args.command == "validate":
            show(validate.summary(validate.annotate(candles.withColumn("seq", F.unix_seconds("timestamp_utc")))))
        else:
            pick = lambda tf: candles.where(F.col("timeframe") == tf)
            write_features(FeatureEngine().compute(FeatureInput(pick("5m"), minutes, pick("15m"), pick("1h"))), args.out)
            if args.manifest:
                manifest.save(spark, manifest.feature_manifest(read_features(spark, args.out), default_registry(), path=args.out), args.manifest)
    return 0


if __name__ == "__main__":
    sys.exit(main())
