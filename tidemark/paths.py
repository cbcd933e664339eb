"""Where things lie under one root, which is a folder or the address of any store that Spark knows."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .errors import PathError
from .sources import files

#: Areas of a root.  Fixed values: existing data lie in folders of these names.
AREAS = ("configs", "data/raw", "data/interim", "data/processed", "data/features", "data/metadata", "artifacts/manifests", "artifacts/reports", "logs/development", "logs/research", "logs/paper")


@dataclass(frozen=True)
class Layout:
    root: str

    def inside(self, *parts: str) -> str:
        """A path under the root; one that leaves it raises PathError."""
        rest = posixpath.normpath(posixpath.join(*parts)) if parts else "."
        if rest.startswith(("/", "..")) or any("://" in p for p in parts):
            raise PathError(f"{posixpath.join(*parts)} isn't under {self.root}")
        return self.root.rstrip("/") + ("" if rest == "." else f"/{rest}")

    def area(self, name: str) -> str:
        if name not in AREAS:
            raise PathError(f"no area {name!r}")
        return self.inside(name)

    def series(self, area: str, venue: str, market_type: str, instrument: str, timeframe: str) -> str:
        """The folder of one series in an area."""
        names = [venue.lower(), market_type.lower(), instrument.upper(), timeframe.lower()]
        if any("/" in n or n in ("", ".", "..") for n in names):
            raise PathError(f"a series can't be named {names}")
        return self.inside(area, *names)

    def prepare(self, spark: SparkSession) -> list[str]:
        """Make all areas that aren't there, and tell them."""
        found = [self.area(a) for a in AREAS]
        for path in found:
            files.make(spark, path)
        return found

    def missing(self, spark: SparkSession) -> list[str]:
        return [a for a in AREAS if not files.exists(spark, self.area(a))]
