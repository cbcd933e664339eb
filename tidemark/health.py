"""What the engine relies on, checked without changing anything that lasts."""

from __future__ import annotations

import importlib
import logging
import os
import subprocess
import sys
import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from . import logs
from .paths import Layout
from .sources import files

PYTHON = (3, 10)
PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy")


def _python() -> tuple[bool, str]:
    return sys.version_info[:2] >= PYTHON, f"{sys.version.split()[0]}, {'.'.join(map(str, PYTHON))} or later is needed"


def _environment() -> tuple[bool, str]:
    return True, f"{sys.prefix}, {'a' if sys.prefix != sys.base_prefix else 'not a'} virtual environment"


def _packages() -> tuple[bool, str]:
    found, missing = [], []
    for name in PACKAGES:
        try:
            found.append(f"{name} {getattr(importlib.import_module(name), '__version__', '')}".strip())
        except ImportError:
            missing.append(name)
    return not missing, f"missing: {', '.join(missing)}" if missing else ", ".join(found)


def _configs(paths: Sequence[str]) -> tuple[bool, str]:
    from .sources import config

    told = []
    for path in paths:
        try:
            told.append(f"{path} {config.fingerprint(config.load(path).values)[:8]}")
        except Exception as e:  # whatever is wrong with it, it is told
            return False, f"{path}: {e}"
    return True, ", ".join(told) or "none given"


def _logging() -> tuple[bool, str]:
    with tempfile.TemporaryDirectory() as folder:
        log = logs.setup("tidemark.health", folder=folder, console=False)
        log.info("checked")
        logs.close(log)
        size = os.path.getsize(os.path.join(folder, "tidemark.log"))
    return size > 0 and not logging.getLogger("tidemark.health").handlers, f"{size} bytes written"


def _git(root: str) -> tuple[bool, str]:
    def ask(*words: str) -> subprocess.CompletedProcess:
        return subprocess.run(["git", *words], cwd=root, capture_output=True, text=True, check=False)

    try:
        if ask("rev-parse", "--show-toplevel").returncode:
            return False, "no repository"
        head, branch, changed = ask("rev-parse", "--short", "HEAD"), ask("branch", "--show-current"), ask("status", "--porcelain")
    except OSError as e:
        return False, str(e)
    return True, f"branch {branch.stdout.strip() or '(none)'}, head {head.stdout.strip() or '(none)'}, {'changed' if changed.stdout.strip() else 'clean'}"


def _spark(spark: SparkSession) -> tuple[bool, str]:
    wanted = {"spark.sql.session.timeZone": "utc", "spark.sql.adaptive.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    wrong = [f"{k} is {spark.conf.get(k, None)}" for k, v in wanted.items() if str(spark.conf.get(k, "")).lower() != v]
    return not wrong and spark.range(3).count() == 3, ", ".join(wrong) or f"{spark.version}, settings as needed"


def _folders(spark: SparkSession, layout: Layout | None) -> tuple[bool, str]:
    if layout is None:
        path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        files.make(spark, path)
        return files.writable(spark, path), path
    if missing := layout.missing(spark):
        return False, f"missing: {', '.join(missing)}"
    closed = [a for a in ("data/raw", "artifacts/reports", "logs/development") if not files.writable(spark, layout.area(a))]
    return not closed, f"not writable: {', '.join(closed)}" if closed else layout.root


def check(spark: SparkSession, *, layout: Layout | None = None, configs: Sequence[str] = (), root: str | None = None) -> dict[str, tuple[bool, str]]:
    """Name of each check, whether it passed, and what it saw; a check that raises has failed.  Git is checked where `root` is given."""
    checks: dict[str, Callable[[], tuple[bool, str]]] = {
        "python": _python,
        "environment": _environment,
        "folders": lambda: _folders(spark, layout),
        "packages": _packages,
        "configurations": lambda: _configs(configs),
        "logging": _logging,
        "spark": lambda: _spark(spark),
    }
    if root is not None:
        checks["git"] = lambda: _git(root)
    out = {}
    for name, run in checks.items():
        try:
            out[name] = run()
        except Exception as e:  # a check must not end the others
            out[name] = (False, f"{type(e).__name__}: {e}")
    return out
