"""Candles for tests, and plain loops to hold the engine against."""

from datetime import datetime, timedelta, timezone

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def candle(at, o=100.0, h=None, l=None, c=None, v=10.0, qv=None, n=5, tb=4.0, tq=None, complete=True, tf="5m", instrument="X"):
    c = o if c is None else c
    h = max(o, c) if h is None else h
    l = min(o, c) if l is None else l
    return (at, "sim", instrument, "spot", tf, float(o), float(h), float(l), float(c), float(v), float(v * c if qv is None else qv), int(n), float(tb), float(tb * c if tq is None else tq), complete)


def series(spark, rows):
    from tidemark.schema import CANDLE_SCHEMA

    return spark.createDataFrame(rows, CANDLE_SCHEMA)


def closes(values, step=300, tf="5m", start=START, **kw):
    return [candle(start + timedelta(seconds=step * i), o=v, c=v, tf=tf, **kw) for i, v in enumerate(values)]


def walk(n, step=300, tf="5m", start=START, instrument="X", seed=3):
    import random

    r, out, price = random.Random(seed), [], 100.0
    for i in range(n):
        o, price = price, max(1.0, price * (1 + r.gauss(0, 0.004)))
        v = r.randint(1, 50)
        out.append(candle(start + timedelta(seconds=step * i), o, max(o, price) * (1 + r.random() / 500), min(o, price) * (1 - r.random() / 500), price, v, n=r.randint(1, 9), tb=r.randint(0, v), tf=tf, instrument=instrument))
    return out


def ema(values, n, start=0):
    out, s = [], None
    for i, x in enumerate(values):
        if i == start + n - 1:
            s = sum(values[start : start + n]) / n
        elif i >= start + n:
            s = 2 / (n + 1) * x + (n - 1) / (n + 1) * s
        out.append(s)
    return out


def wilder(values, n):
    """values[0] is undefined."""
    out, s = [], None
    for i, x in enumerate(values):
        if i == n:
            s = sum(values[1 : n + 1]) / n
        elif i > n:
            s = ((n - 1) * s + x) / n
        out.append(s)
    return out
