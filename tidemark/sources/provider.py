"""Where klines come from: the interface of a source, and one that serves landed files."""

from __future__ import annotations

import abc
import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Page:
    """A raw answer, kept as it came: a JSON array of klines in time order."""

    raw: bytes
    rows: int
    first_ms: int | None
    last_ms: int | None
    told: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, raw: bytes, **told: Any) -> Page:
        """The page of an answer; one that is no array raises ValueError."""
        klines = json.loads(raw)
        if not isinstance(klines, list):
            raise ValueError(f"an answer is no array of klines: {raw[:200]!r}")
        first, last = (int(klines[0][0]), int(klines[-1][0])) if klines else (None, None)
        return cls(raw, len(klines), first, last, told)

    def about(self) -> dict[str, Any]:
        return {"rows": self.rows, "first_ms": self.first_ms, "last_ms": self.last_ms, "sha256": hashlib.sha256(self.raw).hexdigest(), "bytes": len(self.raw), **self.told}


class DataProvider(abc.ABC):
    """A source of raw klines."""

    name: str = "abstract"

    @abc.abstractmethod
    def ping(self) -> bool: ...

    @abc.abstractmethod
    def server_time_ms(self) -> int: ...

    @abc.abstractmethod
    def fetch(self, symbol: str, interval: str, start_ms: int | None, end_ms: int | None, limit: int) -> Page:
        """The klines that open in [start_ms, end_ms], at most `limit`; without bounds the last ones."""


class LandedProvider(DataProvider):
    """Serves klines that lie in a JSON file, as the real source would: for tests and replays."""

    name = "landed"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self._klines = sorted(json.load(f), key=lambda k: int(k[0]))

    def ping(self) -> bool:
        return True

    def server_time_ms(self) -> int:
        return int(self._klines[-1][0]) if self._klines else 0

    def fetch(self, symbol: str, interval: str, start_ms: int | None, end_ms: int | None, limit: int) -> Page:
        if limit < 1:
            raise ValueError("a page needs a kline")
        found = [k for k in self._klines if (start_ms is None or start_ms <= int(k[0])) and (end_ms is None or int(k[0]) <= end_ms)]
        return Page.of(json.dumps(found[-limit:] if start_ms is None else found[:limit]).encode())


def with_retry(call: Callable[[], Any], *, attempts: int = 5, first_wait: float = 1.0, fatal: tuple[type[BaseException], ...] = (FileNotFoundError, FileExistsError), sleep: Callable[[float], None] = time.sleep) -> Any:
    """The call's result; waits double from try to try, fatal errors pass at once, and the last error passes."""
    for k in range(attempts):
        try:
            return call()
        except fatal:
            raise
        except Exception:
            if k == attempts - 1:
                raise
            sleep(first_wait * 2**k)
    raise ValueError("there must be an attempt")
