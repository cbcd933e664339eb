"""Logs of the driver: to the console, and to a file that is rolled over by size."""

from __future__ import annotations

import logging
import os
from logging.handlers import RotatingFileHandler

from .errors import LoggingError

_FORMAT = logging.Formatter("%(asctime)s | %(levelname)-8s | %(name)s:%(lineno)d | %(message)s", "%Y-%m-%d %H:%M:%S")


def setup(name: str = "tidemark", *, level: str = "INFO", folder: str | None = None, console: bool = True, max_bytes: int = 10 << 20, backups: int = 5) -> logging.Logger:
    """The logger of that name with exactly the sinks asked for; those of a call before are closed.  An unknown level is INFO."""
    log = logging.getLogger(name)
    close(log)
    log.setLevel(logging.getLevelNamesMapping().get(level.upper(), logging.INFO))
    log.propagate = False
    sinks: list[logging.Handler] = [logging.StreamHandler()] if console else []
    if folder is not None:
        try:
            os.makedirs(folder, exist_ok=True)
            sinks.append(RotatingFileHandler(os.path.join(folder, "tidemark.log"), maxBytes=max_bytes, backupCount=backups, encoding="utf-8"))
        except OSError as e:
            raise LoggingError(f"can't log to {folder}: {e}") from e
    for sink in sinks or [logging.NullHandler()]:
        sink.setFormatter(_FORMAT)
        log.addHandler(sink)
    return log


def get(name: str = "tidemark") -> logging.Logger:
    """The logger of that name; one without sinks gets the console."""
    log = logging.getLogger(name)
    return log if log.handlers else setup(name)


def close(log: logging.Logger) -> None:
    for sink in list(log.handlers):
        sink.close()
        log.removeHandler(sink)
