"""Sources that answer over HTTP: pages of klines, zipped archives, and the probe of a stream of trades.

What goes over the network is passed in as a function, so all of it is tested without one.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import SparkSession

from ..errors import SourceError
from . import files
from .provider import DataProvider, Page, with_retry

AGENT = "tidemark"

#: The public interface's paths, and its header that tells the weight used within a minute.
PING, TIME, KLINES, WEIGHT = "/api/v3/ping", "/api/v3/time", "/api/v3/klines", "x-mbx-used-weight-1m"


@dataclass(frozen=True)
class Response:
    status: int
    body: bytes
    headers: dict[str, str] = field(default_factory=dict)


#: (url, headers, seconds) to a response of any status; without an answer it raises.
Transport = Callable[[str, dict[str, str], float], Response]


def urllib_transport(url: str, headers: dict[str, str], timeout: float) -> Response:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return Response(r.status, r.read(), {k.lower(): v for k, v in r.headers.items()})
    except urllib.error.HTTPError as e:
        return Response(e.code, e.read(), {k.lower(): v for k, v in (e.headers or {}).items()})


class HttpProvider(DataProvider):
    """Pages of klines from a service with the paths above at `base`."""

    name = "http"

    def __init__(self, base: str, *, transport: Transport = urllib_transport, timeout: float = 10.0, clock: Callable[[], float] = time.time):
        self.base, self._transport, self._timeout, self._clock = base.rstrip("/"), transport, timeout, clock

    def _get(self, path: str, **params: Any) -> tuple[Response, float]:
        given = urllib.parse.urlencode({k: v for k, v in params.items() if v is not None})
        url, start = f"{self.base}{path}" + (f"?{given}" if given else ""), self._clock()
        try:
            answer = self._transport(url, {"User-Agent": AGENT, "Accept": "application/json"}, self._timeout)
        except Exception as e:
            raise SourceError(f"{url} didn't answer: {e}") from e
        if answer.status != 200:
            raise SourceError(f"{url} answered {answer.status}: {answer.body[:500].decode(errors='replace')}")
        return answer, self._clock() - start

    def ping(self) -> bool:
        try:
            return self._get(PING)[0].body.strip() == b"{}"
        except SourceError:
            return False

    def server_time_ms(self) -> int:
        return int(json.loads(self._get(TIME)[0].body)["serverTime"])

    def fetch(self, symbol: str, interval: str, start_ms: int | None, end_ms: int | None, limit: int) -> Page:
        answer, took = self._get(KLINES, symbol=symbol.upper(), interval=interval, limit=limit, startTime=start_ms, endTime=end_ms)
        headers = {k.lower(): v for k, v in answer.headers.items()}
        return Page.of(answer.body, status=answer.status, seconds=round(took, 4), used_weight=headers.get(WEIGHT), endpoint=f"{self.base}{KLINES}")


class Archive:
    """Zipped CSV klines of whole months and of days, with checksums beside them.

    They lie at `base`/(monthly|daily)/klines/SYMBOL/TIMEFRAME/SYMBOL-TIMEFRAME-DATE.zip, and land in a folder of any store
    as SYMBOL/TIMEFRAME/YEAR-MONTH/NAME.zip; what has landed isn't fetched again.
    """

    def __init__(self, base: str, *, transport: Transport = urllib_transport, timeout: float = 30.0, attempts: int = 4, sleep: Callable[[float], None] = time.sleep):
        self.base, self._transport, self._timeout, self._attempts, self._sleep = base.rstrip("/"), transport, timeout, attempts, sleep

    def url(self, symbol: str, timeframe: str, year: int, month: int, day: int | None = None) -> str:
        at = f"{year:04d}-{month:02d}" + ("" if day is None else f"-{day:02d}")
        return f"{self.base}/{'monthly' if day is None else 'daily'}/klines/{symbol.upper()}/{timeframe}/{symbol.upper()}-{timeframe}-{at}.zip"

    def _get(self, url: str) -> bytes:
        def once() -> bytes:
            answer = self._transport(url, {"User-Agent": AGENT, "Accept": "*/*"}, self._timeout)
            if answer.status == 404:
                raise FileNotFoundError(url)
            if answer.status != 200:
                raise SourceError(f"{url} answered {answer.status}")
            return answer.body

        return with_retry(once, attempts=self._attempts, sleep=self._sleep)

    def land(self, spark: SparkSession, folder: str, symbol: str, timeframe: str, year: int, month: int, day: int | None = None) -> dict[str, Any]:
        """One archive and its checksum in `folder`; tells path, sha256, bytes and kind.  A wrong checksum raises ValueError and nothing lands."""
        url = self.url(symbol, timeframe, year, month, day)
        target = f"{folder.rstrip('/')}/{symbol.upper()}/{timeframe}/{year:04d}-{month:02d}/{url.rsplit('/', 1)[1]}"
        kind = "monthly" if day is None else "daily"
        if files.exists(spark, target):
            raw = files.read_bytes(spark, target)
            return {"path": target, "sha256": hashlib.sha256(raw).hexdigest(), "bytes": len(raw), "kind": kind, "fetched": False}
        words = self._get(f"{url}.CHECKSUM").decode().split()
        raw = self._get(url)
        actual = hashlib.sha256(raw).hexdigest()
        if not words or words[0].lower() != actual:
            raise ValueError(f"{url} has checksum {actual}, not {words[0] if words else 'any'}")
        files.write_text(spark, f"{target}.CHECKSUM", f"{actual}  {target.rsplit('/', 1)[1]}\n")
        files.write_bytes(spark, target, raw)  # the archive last: where it is, its checksum is
        return {"path": target, "sha256": actual, "bytes": len(raw), "kind": kind, "fetched": True}

    def land_plan(self, spark: SparkSession, folder: str, symbol: str, timeframe: str, plan: Iterable[Any], *, threads: int = 8) -> list[dict[str, Any]]:
        """All archives of rows of `calendar.plan_months`: a month whole, or each day of one that is partly covered."""
        wanted: list[tuple] = []
        for row in plan:
            if row["kind"] == "monthly":
                wanted.append((row["year"], row["month"], None))
            else:
                days = (row["end"] - row["start"]).days
                wanted += [(d.year, d.month, d.day) for d in (row["start"] + timedelta(days=i) for i in range(days))]
        with ThreadPoolExecutor(threads) as pool:
            return list(pool.map(lambda w: self.land(spark, folder, symbol, timeframe, *w), wanted))


def trade_probe(connect: Callable[[str], Any], provider: DataProvider, symbol: str, *, seconds: float = 5.0, clock: Callable[[], float] = time.time, keep: int = 10) -> dict[str, Any]:
    """Listen to a stream of trades for some seconds and tell how late messages come, less the clocks' skew.

    `connect(stream)` is a context manager of an object with `recv(timeout)`, which raises TimeoutError when none came.
    Latency counts from the trade's time (T), else from the event's (E); messages with neither only count.
    """
    stream, before = f"{symbol.lower()}@trade", clock()
    server = provider.server_time_ms()
    skew = (before + clock()) * 500.0 - server
    start, count, late, first, sample = clock(), 0, [], None, None
    total = 0.0
    with connect(stream) as socket:
        connected, end = clock() - start, clock() + seconds
        while (left := end - clock()) > 0:
            try:
                raw = socket.recv(max(0.1, left))
            except TimeoutError:
                break
            at, message = clock() * 1000.0, json.loads(raw)
            count += 1
            first, sample = (at, message) if first is None else (first, sample)
            sent = float(message.get("T", message.get("E", 0)))
            if sent > 0:
                late.append(at - skew - sent)
                total += late[-1]
    return {
        "stream": stream,
        "connect_seconds": round(connected, 4),
        "clock_skew_ms": round(skew, 2),
        "messages": count,
        "first_message_utc": None if first is None else datetime.fromtimestamp(first / 1000, timezone.utc).isoformat(),
        "latencies_ms": [round(x, 2) for x in late[:keep]],
        "average_latency_ms": round(total / len(late), 2) if late else None,
        "sample": sample,
        "clean_shutdown": True,
    }


def websocket_connect(base: str) -> Callable[[str], Any]:
    """`connect` over the optional package websockets; without it ImportError."""
    from websockets.sync.client import connect

    return lambda stream: connect(f"{base.rstrip('/')}/{stream}")


__all__ = ["Archive", "HttpProvider", "Response", "trade_probe", "urllib_transport", "websocket_connect"]
