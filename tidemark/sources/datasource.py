"""`spark.read.format("klines")` and `readStream`: candles of landed JSON kline files as a Python data source.

One partition per file, so files are read where there is room for them; the stream takes files in name order, so many per
trigger, and its offset is the name of the last file taken.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from ..schema import CANDLE_SCHEMA
from .klines import FIELDS


class KlineFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _files(folder: str) -> list[str]:
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.endswith(".json"))


def _rows(path: str, options: dict[str, str]) -> Iterator[tuple]:
    with open(path, encoding="utf-8") as f:
        payload = json.load(f)
    if not isinstance(payload, list):
        raise ValueError(f"{path} is no array of klines")
    names = options["venue"].lower(), options["instrument"].upper(), options.get("markettype", "spot").lower(), options.get("timeframe", "1m")
    for k in payload:
        if len(k) < FIELDS:
            raise ValueError(f"{path} has a kline of {len(k)} fields")
        at = datetime.fromtimestamp(int(k[0]) / 1000, timezone.utc)
        yield (at, *names, *(float(k[i]) for i in (1, 2, 3, 4, 5, 7)), int(k[8]), float(k[9]), float(k[10]), True)


class KlineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> Sequence[InputPartition]:
        return [KlineFile(p) for p in _files(self.options["path"])]

    def read(self, partition: KlineFile) -> Iterator[tuple]:
        return _rows(partition.path, self.options)


class KlineStream(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"file": ""}

    def _after(self, file: str) -> list[str]:
        return [p for p in _files(self.options["path"]) if p > file]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        taken = self._after(start["file"])[: int(self.options.get("filespertrigger", "100"))]
        rows = [r for p in taken for r in _rows(p, self.options)]
        return iter(rows), {"file": taken[-1]} if taken else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return (r for p in self._after(start["file"]) if p <= end["file"] for r in _rows(p, self.options))


class KlineSource(DataSource):
    """Options: path, venue, instrument, marketType, timeframe, filesPerTrigger."""

    @classmethod
    def name(cls) -> str:
        return "klines"

    def schema(self) -> StructType:
        return CANDLE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return KlineReader(self.options)

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return KlineStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KlineSource)
