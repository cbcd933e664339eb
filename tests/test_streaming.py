from datetime import timedelta

from helpers import START, closes, ema, series
from pyspark.sql import functions as F

from tidemark.operators.resample import candles_from_ticks
from tidemark.schema import CANDLE_SCHEMA
from tidemark.streaming import live


def test_live_candles_are_the_closed_batch_candles(spark, tmp_path):
    rows = [("X", START + timedelta(seconds=17 * i), 100.0 + i % 7, 1 + i % 3, i % 2 == 0) for i in range(900)]
    ticks = spark.createDataFrame(rows, live.TICK_SCHEMA)
    ticks.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "ticks"))
    stream = live.live_candles(live.tick_stream(spark, str(tmp_path / "ticks")), "5m", venue="sim")
    q = live.write_candle_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("timestamp_utc", "open", "close", "volume", "trade_count")
    batch = candles_from_ticks(ticks, "5m", venue="sim").select(*got.columns)
    assert batch.count() - got.count() == 1 and got.exceptAll(batch).count() == 0


def test_live_ema_equals_a_loop(spark, tmp_path):
    values = [100.0 + (i * 7) % 11 for i in range(60)]
    rows = closes(values)
    series(spark, rows[:25]).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(CANDLE_SCHEMA).parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = live.live_ema(source, 12).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        series(spark, rows[25:]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = [r["ema"] for r in spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp_utc").collect()]
    want = ema(values, 12)
    assert [x is None for x in got] == [x is None for x in want] and max(abs(a - b) for a, b in zip(got, want) if a is not None) < 1e-12


def test_latency_takes_off_the_skew(spark):
    rows = spark.createDataFrame([(1000, 1050), (2000, 2010)], "event_ms long, ingest_ms long")
    r = live.latency_metrics(rows, skew_ms=20).first()
    assert (r["messages"], r["min_ms"], r["max_ms"], r["avg_ms"]) == (2, 0, 30, 15.0)
    assert live.latency_metrics(rows.where(F.lit(False))).first()["messages"] == 0
