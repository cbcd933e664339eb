import hashlib
import io
import json
import zipfile
from datetime import timedelta

import pytest
from helpers import START, candle, closes, series, walk
from pyspark.sql import functions as F

from tidemark.operators import clean, gaps, validate
from tidemark.operators.resample import resample, resample_all
from tidemark.plans import calendar, ingest, manifest, report
from tidemark.sources import candles as tables
from tidemark.sources import config, klines
from tidemark.sources.provider import LandedProvider, with_retry


def numbered(spark, rows):
    from tidemark.schema import CANDLE_SCHEMA
    from pyspark.sql import types as T

    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], T.StructType([*CANDLE_SCHEMA.fields, T.StructField("seq", T.LongType())]))


def minutes(n, skip=(), start=START):
    return [candle(start + timedelta(seconds=60 * i), tf="1m") for i in range(n) if i not in skip]


def test_resample_math(spark):
    o, h, l, c, v = [100, 102, 101, 104, 103], [103, 104, 105, 106, 104], [99, 100, 94, 101, 100], [102, 101, 104, 103, 105], [10, 15, 20, 5, 25]
    rows = [candle(START + timedelta(seconds=60 * i), o[i], h[i], l[i], c[i], v[i], n=8 + i, tf="1m") for i in range(5)]
    bar = resample(series(spark, rows), "5m").collect()
    assert len(bar) == 1
    assert (bar[0]["open"], bar[0]["high"], bar[0]["low"], bar[0]["close"], bar[0]["volume"], bar[0]["trade_count"], bar[0]["is_complete"]) == (100, 106, 94, 105, 75, 50, True)


@pytest.mark.parametrize("skip", [(), (7,)])
def test_completeness_of_a_day(spark, skip):
    got = resample_all(series(spark, minutes(1440, skip))).groupBy("timeframe").agg(F.count("*").alias("n"), F.sum(F.col("is_complete").cast("int")).alias("c")).collect()
    assert {r["timeframe"]: (r["n"], r["n"] - r["c"]) for r in got} == {tf: (n, len(skip)) for tf, n in (("5m", 288), ("15m", 96), ("1h", 24), ("4h", 6), ("1d", 1))}


def test_duplicate_minute_does_not_hide_a_missing_one(spark):
    rows = minutes(5, (3,)) + minutes(1)
    assert [r["is_complete"] for r in resample(series(spark, rows), "5m").collect()] == [False]
    assert [r["is_complete"] for r in resample(series(spark, rows), "5m", distinct=False).collect()] == [True]


def test_long_bars_are_those_of_the_minutes(spark):
    """A day is put together from hours: the same as from minutes, also with a duplicate and a hole."""
    rows = [candle(START + timedelta(seconds=60 * i), 100 + i % 13, 120 + i % 7, 80 - i % 5, 100 + i % 11, 1 + i % 3, tf="1m", complete=i != 1500) for i in range(2880) if i != 700]
    df = series(spark, rows + rows[:1])
    day = {r["timestamp_utc"].day: r for r in resample(df, "1d").collect()}
    for d in (1, 2):
        own = [r for r in rows + rows[:1] if r[0].day == d]
        got = day[d]
        assert (got["open"], got["high"], got["low"], got["close"], got["volume"], got["trade_count"]) == (own[0][5], max(r[6] for r in own), min(r[7] for r in own), max(own)[8], sum(r[9] for r in own), sum(r[11] for r in own))
        assert got["is_complete"] is False


def test_resample_rejects_and_passes_empty(spark):
    with pytest.raises(ValueError):
        resample(series(spark, []), "7m")
    assert resample(series(spark, []), "5m").count() == 0


def test_validator(spark):
    base = candle(START, tf="1m")
    other = candle(START, 100, c=101, tf="1m")
    s = validate.summary(validate.annotate(numbered(spark, [base, base, other]))).first()
    assert (s["exact_duplicates"], s["conflicting_duplicates"], s["is_valid"], s["invalid_records"]) == (1, 1, False, 2)
    rows = minutes(1) + minutes(6)[5:]
    a = validate.annotate(numbered(spark, rows))
    s = validate.summary(a).first()
    assert (s["gaps"], s["missing_candles"], s["is_valid"]) == (1, 4, True)
    g = validate.gaps(a).first()
    assert g["missing_candles"] == 4
    back = validate.annotate(numbered(spark, minutes(2)[::-1]))
    assert "TIMESTAMP_OUT_OF_ORDER" in [r["issue_type"] for r in validate.issues(back).collect()]
    bad = [candle(START, 10, h=5, l=8, c=7, v=-1, n=-1, tb=3, tf="1m")]
    found = {r["issue_type"] for r in validate.issues(validate.annotate(numbered(spark, bad))).collect()}
    assert found == {"OHLC_HIGH_LESS_THAN_LOW", "OHLC_OPEN_OUT_OF_RANGE", "OHLC_CLOSE_OUT_OF_RANGE", "NEGATIVE_VOLUME", "TAKER_VOLUME_EXCEEDS_TOTAL", "NEGATIVE_TRADE_COUNT"}
    jump = [candle(START, 100, tf="1m"), candle(START + timedelta(seconds=60), 150, tf="1m")]
    assert [r["issue_type"] for r in validate.issues(validate.annotate(numbered(spark, jump), strict=True)).collect()] == ["EXTREME_RETURN"]
    assert validate.summary(validate.annotate(numbered(spark, []))).count() == 0


def test_three_policies(spark):
    base, other = candle(START, tf="1m"), candle(START, 100, c=101, tf="1m")
    rows = numbered(spark, [base, base, other])
    assert sorted(r["seq"] for r in clean.drop_exact_duplicates(rows, seq="seq").collect()) == [0, 2]
    assert [r["seq"] for r in clean.keep_last(rows, seq="seq").collect()] == [2]
    with pytest.raises(clean.OverlapConflict):
        clean.merge_overlap(series(spark, [base]), series(spark, [other]))
    assert clean.merge_overlap(series(spark, [base]), series(spark, minutes(3))).count() == 3
    with pytest.raises(ValueError):
        clean.within(rows, "2024-01-02", "2024-01-01")


def test_gap_registry_round_trip(spark, tmp_path):
    a = validate.annotate(numbered(spark, minutes(10, (3, 4))))
    found = gaps.register(validate.gaps(a), source="test", detected_at="2024-02-01 00:00:00")
    path = str(tmp_path / "gaps")
    assert gaps.load(spark, path).count() == 0
    gaps.save(gaps.upsert(gaps.load(spark, path), found), path)
    gaps.save(gaps.upsert(gaps.load(spark, path), found), path)
    back = gaps.load(spark, path).collect()
    assert len(back) == 1 and back[0]["missing_candles_count"] == 2 and back[0]["gap_id"] == "gap_x_1m_202401010003_202401010004"
    done = gaps.resolve(gaps.load(spark, path), back[0]["gap_id"], "filled")
    assert gaps.unresolved(done).count() == 0 and gaps.by_category(done).count() == 4
    with pytest.raises(ValueError):
        gaps.register(validate.gaps(a), source="x", category="NO_SUCH")


def test_plans(spark):
    chunks = calendar.plan_chunks(spark, "2024-01-01", "2024-01-02 12:00:00", "1m").orderBy("chunk").collect()
    assert len(chunks) == 3 and all(b["start_ms"] == a["end_ms"] + 1 for a, b in zip(chunks, chunks[1:]))
    assert chunks[-1]["end_ms"] == 1704196800000 - 1
    with pytest.raises(ValueError):
        calendar.plan_chunks(spark, "2024-01-02", "2024-01-01", "1m")
    months = calendar.plan_months(spark, "2023-09-18", "2026-09-17").orderBy("year", "month").collect()
    assert len(months) == 37 and [m["kind"] for m in months] == ["daily"] + ["monthly"] * 35 + ["daily"]


KLINE = [1704067200000, "100.5", "101", "99", "100", "12.5", 1704067259999, "1250.0", 42, "6", "600", "0"]
NAMES = {"venue": "SIM", "instrument": "abc", "market_type": "Spot", "timeframe": "1M"}


def test_json_payloads(spark, tmp_path):
    names = NAMES | {"timeframe": "1m"}
    row = klines.candles_from_payload(spark, json.dumps([KLINE]), **names).first()
    assert (row["venue"], row["instrument"], row["market_type"], row["open"], row["trade_count"]) == ("sim", "ABC", "spot", 100.5, 42)
    assert row["timestamp_utc"].timestamp() == 1704067200
    with pytest.raises(ValueError):
        klines.candles_from_payload(spark, "{}", **names)
    with pytest.raises(TypeError):
        klines.candles_from_payload(spark, 5, **names)
    with pytest.raises(ValueError):
        klines.candles_from_payload(spark, [KLINE[:9]], **names)
    (tmp_path / "a.json").write_text(json.dumps([KLINE, [KLINE[0] + 60000, *KLINE[1:]]]))
    assert klines.candles_from_json(spark, str(tmp_path / "a.json"), **names).count() == 2
    (tmp_path / "b.json").write_text("{}")
    with pytest.raises(Exception, match="no array"):
        klines.candles_from_json(spark, str(tmp_path / "b.json"), **names).collect()


def test_csv_zip_and_units(spark, tmp_path):
    names = NAMES | {"timeframe": "1m"}
    line = lambda t: ",".join(str(x) for x in [t, *KLINE[1:]])
    text = "\n".join(["open_time,open", "", "1,2,3", *[line(t) for t in (1704067200, 1704067260000, 1704067320000000, 1704067380000000000)]])
    (tmp_path / "k.csv").write_text(text)
    got = klines.candles_from_csv(spark, str(tmp_path / "k.csv"), **names).orderBy("timestamp_utc").collect()
    assert [r["timestamp_utc"].timestamp() for r in got] == [1704067200 + 60 * i for i in range(4)]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("k.csv", text)
    (tmp_path / "k.zip").write_bytes(raw.getvalue())
    (tmp_path / "k.zip.CHECKSUM").write_text(hashlib.sha256(raw.getvalue()).hexdigest() + "  k.zip\n")
    assert klines.candles_from_zip(spark, str(tmp_path / "k.zip"), checksums=True, **names).count() == 4
    (tmp_path / "k.zip.CHECKSUM").write_text("0" * 64 + "  k.zip\n")
    with pytest.raises(ValueError):
        klines.candles_from_zip(spark, str(tmp_path / "k.zip"), checksums=True, **names)


def test_partitioned_tables_and_manifests(spark, tmp_path):
    path, rows = str(tmp_path / "candles"), closes([100.0] * 300, step=14400, tf="4h")
    df = series(spark, rows)
    tables.write_candles(df, path)
    tables.write_candles(df, path)
    back = tables.read_candles(spark, path)
    assert back.columns == df.columns and back.count() == 300 and back.exceptAll(df).count() == 0
    months = tables.partition_summary(back).orderBy("year", "month").collect()
    assert [r["rows"] for r in months] == [186, 114]
    assert tables.partitions(spark, path).count() == 2 and tables.partitions(spark, path + "x").count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_candles(spark, path + "x")
    with pytest.raises(ValueError):
        tables.write_candles(df.limit(0), path)
    told = manifest.candle_manifest(back, source="test", report={"is_valid": True})
    assert told["rows"] == 300 and told["status"] == "PASS" and told["dataset_sha256"] == manifest.dataset_hash(manifest.partition_hashes(df.repartition(7)))
    digest = manifest.save(spark, told, str(tmp_path / "m.json"))
    assert manifest.load(spark, str(tmp_path / "m.json"))["rows"] == 300
    assert manifest.copy_checked(spark, str(tmp_path / "m.json"), str(tmp_path / "n.json")) == digest
    assert "| 4h | 300 |" in report.markdown(back)


def test_a_table_holds_many_series(spark, tmp_path):
    path = str(tmp_path / "candles")
    for name in ("AAA", "007", "A/B c"):
        tables.write_candles(series(spark, [candle(START + timedelta(minutes=i), tf="1m", instrument=name) for i in range(30)]), path)
    back = tables.read_candles(spark, path)
    assert {r["instrument"]: r["count"] for r in back.groupBy("instrument").count().collect()} == {"AAA": 30, "007": 30, "A/B c": 30}
    assert tables.partitions(spark, path).count() == 3


def test_part_of_a_month_is_merged(spark, tmp_path):
    path, rows = str(tmp_path / "candles"), [candle(START + timedelta(minutes=i), o=100 + i, tf="1m") for i in range(60)]
    tables.merge_candles(series(spark, rows[:30]), path)
    tables.merge_candles(series(spark, rows[20:]), path)
    assert sorted(tuple(r) for r in tables.read_candles(spark, path).select("open").collect()) == [(100.0 + i,) for i in range(60)]
    with pytest.raises(clean.OverlapConflict):
        tables.merge_candles(series(spark, [candle(START, o=7, tf="1m")]), path)
    assert tables.read_candles(spark, path).count() == 60 and [p.name for p in tmp_path.iterdir()] == ["candles"]


def test_expansion_of_two_instruments_and_a_grown_month(spark, tmp_path):
    path = str(tmp_path / "t")
    raw = lambda name, n, skip=(): numbered(spark, [candle(START + timedelta(minutes=i), o=100 + i % 7, tf="1m", instrument=name) for i in range(n) if i not in skip])
    count = lambda: {(r["instrument"], r["timeframe"]): r["count"] for r in tables.read_candles(spark, path).groupBy("instrument", "timeframe").count().collect()}
    assert ingest.expand(spark, raw("AAA", 30), table=path).count() == 1
    assert ingest.expand(spark, raw("BBB", 60, (7, 8)), table=path, gap_registry=str(tmp_path / "gaps")).count() == 1
    assert count()["AAA", "1m"] == 30 and count()["BBB", "1m"] == 58 and count()["BBB", "1h"] == 1
    assert ingest.expand(spark, raw("AAA", 30), table=path).count() == 0  # done: same raw rows, rows still there
    assert ingest.expand(spark, raw("AAA", 600), table=path).count() == 1
    assert count()["AAA", "1m"] == 600 and count()["AAA", "5m"] == 120 and count()["BBB", "1m"] == 58
    told = {(r["instrument"], r["timeframe"]): r for r in ingest.manifests(spark, path).collect()}
    assert {k: r["rows"] for k, r in told.items()} == count() and told["BBB", "1m"]["gaps"] == 1 and told["AAA", "1m"]["raw_rows"] == 600
    root = json.loads((tmp_path / "t" / "_root_manifest.json").read_text())
    assert root["rows"] == sum(count().values()) and root["status"] == "PASS" and root["timeframes"]["1m"]["rows"] == 658
    tables.write_candles(raw("AAA", 10).drop("seq"), path)
    assert ingest.expand(spark, raw("AAA", 600), table=path).count() == 1 and count()["AAA", "1m"] == 600  # rows had gone: done again
    assert ingest.expand(spark, raw("AAA", 20), table=path, force=True).count() == 1 and count()["AAA", "1m"] == 20
    known = raw("CCC", 40)
    assert ingest.expand(spark, known, table=path, identity="x").count() == 1
    unread = known.where(F.raise_error(F.lit("read")).isNull())  # a run of the same identity doesn't read
    assert ingest.expand(spark, unread, table=path, identity="x").count() == 0 and count()["CCC", "1m"] == 40
    tables.write_candles(raw("CCC", 10).drop("seq"), path)
    assert ingest.expand(spark, known, table=path, identity="x").count() == 1 and count()["CCC", "1m"] == 40
    assert sorted(p.name for p in tmp_path.iterdir()) == ["gaps", "t"]


def test_month_boundary_is_utc(spark):
    """A bar at 23:30 on the last day of a month stays in it, whatever the machine's zone."""
    rows = [candle(START.replace(month=1, day=31, hour=23, minute=30)), candle(START.replace(month=2, day=1))]
    assert sorted((r["month"], r["rows"]) for r in tables.partition_summary(series(spark, rows)).collect()) == [(1, 1), (2, 1)]


def test_backfill_resumes(spark, tmp_path):
    lines = [[1704067200000 + 60000 * i, *KLINE[1:]] for i in range(2500)]
    (tmp_path / "all.json").write_text(json.dumps(lines))
    provider, market = LandedProvider(str(tmp_path / "all.json")), ingest.Market("sim", "ABC")
    run = lambda **k: ingest.backfill(spark, provider, market, "2024-01-01 00:00:00", "2024-01-02 17:40:00", landing=str(tmp_path / "landing"), **k)
    with pytest.raises(ingest.Interrupted):
        run(stop=lambda done: done == 2)
    calls = []
    fetch = provider.fetch
    provider.fetch = lambda *a: calls.append(a[2]) or fetch(*a)
    got = run()
    assert calls == [1704067200000 + 2000 * 60000] and got.count() == 2500
    s = ingest.expand(spark, got, table=str(tmp_path / "table"), gap_registry=str(tmp_path / "gaps"))
    assert s.first()["is_valid"] and tables.inspect_timeframes(tables.read_candles(spark, str(tmp_path / "table"))).count() == 6
    assert ingest.expand(spark, got, table=str(tmp_path / "table")).count() == 0


def test_retry_waits_double_and_gives_up():
    waits, tries = [], []

    def fails():
        tries.append(1)
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        with_retry(fails, attempts=4, sleep=waits.append)
    assert waits == [1, 2, 4] and len(tries) == 4


def test_config():
    env = {"PORT": "8080", "FLAG": "true"}
    assert config.substitute({"a": "${PORT}", "b": ["${FLAG}", "${NONE:-x}"]}, env) == {"a": 8080, "b": [True, "x"]}
    with pytest.raises(config.ConfigError):
        config.substitute("${NONE}", env)
    assert config.mask({"api_key": "k", "n": {"password": 1, "ok": 2}, "access_key": 1, "Authorization": 2}) == {"api_key": "***", "n": {"password": "***", "ok": 2}, "access_key": "***", "Authorization": "***"}
    assert config.fingerprint({"a": 1, "token": "x"}) == config.fingerprint({"token": "y", "a": 1})


def test_walks_are_valid(spark):
    assert validate.summary(validate.annotate(numbered(spark, walk(50)))).first()["is_valid"]


def test_kline_data_source(spark, tmp_path):
    from tidemark.sources import datasource

    datasource.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.json").write_text(json.dumps([[1704067200000 + 60000 * (10 * n + i), *KLINE[1:]] for i in range(10)]))
    options = {"path": str(folder), "venue": "SIM", "instrument": "abc", "timeframe": "1m"}
    batch = spark.read.format("klines").options(**options).load()
    assert batch.count() == 30 and batch.columns == list(tables.CANDLE_COLUMNS) and batch.first()["instrument"] == "ABC"
    q = spark.readStream.format("klines").options(**options, filesPerTrigger=2).load().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(batch).count() == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30
