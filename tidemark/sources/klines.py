"""Raw klines: JSON payloads and CSV archives to candles.

A kline is a positional array of eleven fields or more: open time, open, high, low, close, volume, close time, quote
volume, trades, taker buy base, taker buy quote.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CANDLE_COLUMNS, CANDLE_SCHEMA

FIELDS = 11


def epoch_to_timestamp(x: Column) -> Column:
    """An instant from seconds, milliseconds, microseconds or nanoseconds, told apart by size."""
    n = x.cast("long")
    return F.when(n > 10**17, F.timestamp_micros(F.floor(n / 1000).cast("long"))).when(n > 10**14, F.timestamp_micros(n)).when(n > 10**11, F.timestamp_millis(n)).otherwise(F.timestamp_seconds(n))


def _candles(rows: DataFrame, field, *, venue: str, instrument: str, market_type: str, timeframe: str) -> DataFrame:
    at = {"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "quote_volume": 7, "trade_count": 8, "taker_buy_base_volume": 9, "taker_buy_quote_volume": 10}
    names = {"venue": F.lit(venue.lower()), "instrument": F.lit(instrument.upper()), "market_type": F.lit(market_type.lower()), "timeframe": F.lit(timeframe.lower()), "is_complete": F.lit(True)}
    columns = {"timestamp_utc": epoch_to_timestamp(field(0))} | {c: field(i).cast(CANDLE_SCHEMA[c].dataType) for c, i in at.items()} | names
    return rows.select(*[columns[c].alias(c) for c in CANDLE_COLUMNS], *[c for c in ("seq",) if c in rows.columns])


def candles_from_json(spark: SparkSession, path: str | Sequence[str], **names: str) -> DataFrame:
    """Candles of landed JSON payloads, one array of klines per file; a kline of fewer than eleven fields raises."""
    raw = spark.read.text(path if isinstance(path, str) else list(path), wholetext=True)
    parsed = raw.select(F.from_json("value", "array<array<string>>").alias("a"), F.col("value"))
    parsed = parsed.select(F.explode(F.when(F.col("a").isNull(), F.raise_error(F.lit("the payload is no array of klines"))).otherwise(F.col("a"))).alias("k"))
    checked = F.when(F.size("k") < FIELDS, F.raise_error(F.concat(F.lit("a kline has too few fields: "), F.size("k").cast("string")))).otherwise(F.col("k"))
    return _candles(parsed.select(checked.alias("k")), lambda i: F.element_at("k", i + 1), **names)


def candles_from_payload(spark: SparkSession, payload: bytes | str | list, **names: str) -> DataFrame:
    """Candles of one payload at hand: bytes, text or a list of klines."""
    if isinstance(payload, (bytes, str)):
        payload = json.loads(payload)
    elif not isinstance(payload, list):
        raise TypeError(f"a payload is bytes, text or a list, not {type(payload).__name__}")
    if not isinstance(payload, list):
        raise ValueError("the payload is no array of klines")
    if any(len(k) < FIELDS for k in payload):
        raise ValueError("a kline has too few fields")
    rows = spark.createDataFrame([([None if x is None else str(x) for x in k],) for k in payload], "k array<string>")
    return _candles(rows, lambda i: F.element_at("k", i + 1), **names)


def candles_from_csv(spark: SparkSession, path: str | Sequence[str], **names: str) -> DataFrame:
    """Candles of CSV archives; blank lines, headers and lines of fewer than eleven fields are skipped.

    `seq` numbers lines by file and place, as the order in which later lines replace earlier ones.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(F.trim("value").alias("line"), F.monotonically_increasing_id().alias("seq"))
    return _csv(lines, **names)


def _csv(lines: DataFrame, **names: str) -> DataFrame:
    kept = lines.where((F.col("line") != "") & ~F.col("line").startswith("open_time")).select(F.split("line", ",").alias("k"), "seq").where(F.size("k") >= FIELDS)
    return _candles(kept, lambda i: F.trim(F.element_at("k", i + 1)), **names)


def candles_from_zip(spark: SparkSession, path: str | Sequence[str], *, checksums: bool = False, **names: str) -> DataFrame:
    """Candles of zipped CSV archives, each file's first member that ends in .csv; an archive without one raises.

    With `checksums`, each archive's SHA-256 must equal the first word of the file of its name plus `.CHECKSUM`.
    """
    if checksums:
        verify_checksums(spark, path)
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).where(F.col("path").endswith(".zip"))

    def unzip(batches):
        import io
        import zipfile

        import pandas as pd

        for frame in batches:
            for name, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = next((m for m in sorted(z.namelist()) if m.endswith(".csv")), None)
                    if member is None:
                        raise ValueError(f"{name} has no CSV file")
                    with z.open(member) as f:
                        for lines in iter(lambda: f.readlines(1 << 22), []):
                            yield pd.DataFrame({"line": [x.decode().strip() for x in lines]})

    lines = files.select("path", "content").mapInPandas(unzip, "line string").withColumn("seq", F.monotonically_increasing_id())
    return _csv(lines, **names)


def checksum_mismatches(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Archives whose SHA-256 isn't the one told beside them, or that have none beside them."""
    paths = [path] if isinstance(path, str) else list(path)
    files = spark.read.format("binaryFile").load(paths).where(F.col("path").endswith(".zip")).select("path", F.sha2("content", 256).alias("actual"))
    told = spark.read.format("binaryFile").load([f"{p}.CHECKSUM" if p.endswith(".zip") else p for p in paths]).where(F.col("path").endswith(".CHECKSUM"))
    told = told.select(F.regexp_replace("path", r"\.CHECKSUM$", "").alias("path"), F.split(F.trim(F.col("content").cast("string")), r"\s+")[0].alias("expected"))
    return files.join(told, "path", "left").where(~F.col("actual").eqNullSafe(F.lower("expected")))


def verify_checksums(spark: SparkSession, path: str | Sequence[str]) -> None:
    if (bad := checksum_mismatches(spark, path).first()) is not None:
        raise ValueError(f"{bad['path']} has checksum {bad['actual']}, not {bad['expected']}")
