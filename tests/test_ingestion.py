"""Sources over HTTP, archives, checkpoints, paths, logs and reports, without a network."""

import hashlib
import io
import json
import logging
import zipfile
from contextlib import contextmanager
from datetime import timedelta
from urllib.parse import parse_qs, urlsplit

import pytest
from helpers import START, candle, series
from pyspark.sql import functions as F

from tidemark import errors, health, logs
from tidemark.operators import validate
from tidemark.paths import AREAS, Layout
from tidemark.plans import ingest, manifest, phases, report
from tidemark.schema import CANDLE_COLUMNS
from tidemark.sources import config, files
from tidemark.sources import candles as tables
from tidemark.sources.http import Archive, HttpProvider, Response, trade_probe

T0 = 1704067200000  # 2024-01-01
MARKET = ingest.Market("sim", "ABC")


def line(i):
    return [T0 + 60000 * i, "100", "101", "99", str(100 + i % 2), "5", 0, "500", 3, "1", "100", "0"]


def service(calls, klines=300):
    """A service of klines as a transport."""

    def answer(url, headers, timeout):
        parts = urlsplit(url)
        calls.append((parts.path, headers["User-Agent"]))
        if parts.path.endswith("/ping"):
            return Response(200, b"{}")
        if parts.path.endswith("/time"):
            return Response(200, json.dumps({"serverTime": T0}).encode())
        q = {k: v[0] for k, v in parse_qs(parts.query).items()}
        found = [line(i) for i in range(klines) if int(q.get("startTime", 0)) <= T0 + 60000 * i <= int(q.get("endTime", 10**15))]
        found = found[: int(q["limit"])] if "startTime" in q else found[-int(q["limit"]) :]
        return Response(200, json.dumps(found).encode(), {"X-MBX-USED-WEIGHT-1M": "7"})

    return answer


def test_http_provider():
    calls = []
    p = HttpProvider("https://klines.example/", transport=service(calls))
    assert p.ping() and p.server_time_ms() == T0
    page = p.fetch("abc", "1m", T0 + 60000, T0 + 180000, 10)
    assert (page.rows, page.first_ms, page.last_ms) == (3, T0 + 60000, T0 + 180000)
    told = page.about()
    assert told["used_weight"] == "7" and told["status"] == 200 and told["sha256"] == hashlib.sha256(page.raw).hexdigest()
    assert p.fetch("abc", "1m", T0 + 10**12, None, 10).first_ms is None and {a for _, a in calls} == {"tidemark"}


def test_http_errors():
    bad = HttpProvider("https://x.example", transport=lambda *a: Response(418, b"teapot"))
    assert not bad.ping()
    with pytest.raises(errors.SourceError, match="418: teapot"):
        bad.server_time_ms()

    def lost(*a):
        raise OSError("no route")

    with pytest.raises(errors.SourceError, match="no route"):
        HttpProvider("https://x.example", transport=lost).fetch("A", "1m", None, None, 1)
    with pytest.raises(ValueError, match="no array"):
        HttpProvider("https://x.example", transport=lambda *a: Response(200, b'{"code": 1}')).fetch("A", "1m", None, None, 1)


def test_backfill_over_http_fails_and_goes_on(spark, tmp_path):
    calls, broken = [], [True]
    good = service(calls)

    def transport(url, headers, timeout):
        if broken[0] and f"startTime={T0 + 6000000}" in url:
            return Response(500, b"later")
        return good(url, headers, timeout)

    run = lambda **k: ingest.backfill(spark, HttpProvider("https://x.example", transport=transport), MARKET, "2024-01-01 00:00:00", "2024-01-01 05:00:00", landing=str(tmp_path / "l"), limit=100, attempts=2, wait=lambda s: None, **k)
    with pytest.raises(errors.SourceError):
        run()
    (state,) = ingest.find_checkpoints(spark, str(tmp_path / "l"), status="failed")
    assert "500: later" in state["last_error"] and list(state["done"]) == ["0"] and state["planned"] == 3
    broken[0] = False
    before = len(calls)
    assert run().count() == 300 and len(calls) == before + 2
    (state,) = ingest.find_checkpoints(spark, str(tmp_path / "l"))
    assert state["status"] == "completed" and state["last_error"] is None and state["completed_until_ms"] == T0 + 300 * 60000 - 1 and state["done"]["1"]["used_weight"] == "7"
    files.delete(spark, state["done"]["1"]["path"])  # a landed file is lost: only it comes again
    before = len(calls)
    assert run().count() == 300 and len(calls) == before + 1
    before = len(calls)
    assert run(resume=False).count() == 300 and len(calls) == before + 3
    with pytest.raises(errors.ConfigError, match="chunks of 100"):
        ingest.backfill(spark, HttpProvider("https://x.example", transport=good), MARKET, "2024-01-01 00:00:00", "2024-01-01 05:00:00", landing=str(tmp_path / "l"), limit=50)


def test_corrupt_checkpoints_raise(spark, tmp_path):
    for text in ("{", "[]", '{"done": 1}'):
        files.write_text(spark, str(tmp_path / "_checkpoints/x.json"), text)
        with pytest.raises(errors.ConfigError):
            ingest.Checkpoint(spark, str(tmp_path), "x")
    assert ingest.find_checkpoints(spark, str(tmp_path / "none")) == []


def archives(minutes, wrong=()):
    """An archive of three months as a transport: `minutes(year, month, day)` gives the klines of a file, None if it isn't there."""

    def answer(url, headers, timeout):
        name = urlsplit(url).path.rsplit("/", 1)[1].replace(".CHECKSUM", "")
        found = minutes(name)
        if found is None:
            return Response(404, b"")
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            z.writestr(zipfile.ZipInfo(name.replace(".zip", ".csv")), "open_time,open\n" + "\n".join(",".join(map(str, k)) for k in found))
        digest = "0" * 64 if name in wrong else hashlib.sha256(raw.getvalue()).hexdigest()
        return Response(200, f"{digest}  {name}\n".encode() if url.endswith(".CHECKSUM") else raw.getvalue())

    return answer


def test_archive_layout_and_checksums(spark, tmp_path):
    a = Archive("https://a.example/data/", transport=archives(lambda n: [line(0)] if "-01" in n else None, wrong=("ABC-1m-2024-01-02.zip",)), sleep=lambda s: None)
    assert a.url("abc", "1m", 2024, 1) == "https://a.example/data/monthly/klines/ABC/1m/ABC-1m-2024-01.zip"
    assert a.url("abc", "1m", 2024, 1, 9) == "https://a.example/data/daily/klines/ABC/1m/ABC-1m-2024-01-09.zip"
    told = a.land(spark, str(tmp_path), "abc", "1m", 2024, 1)
    assert told["fetched"] and told["kind"] == "monthly" and told["path"].endswith("ABC/1m/2024-01/ABC-1m-2024-01.zip")
    again = a.land(spark, str(tmp_path), "abc", "1m", 2024, 1)
    assert not again["fetched"] and again["sha256"] == told["sha256"] and again["bytes"] == told["bytes"]
    with pytest.raises(FileNotFoundError):
        a.land(spark, str(tmp_path), "abc", "1m", 2024, 2)
    with pytest.raises(ValueError, match="checksum"):
        a.land(spark, str(tmp_path), "abc", "1m", 2024, 1, 2)
    assert not files.exists(spark, str(tmp_path / "ABC/1m/2024-01/ABC-1m-2024-01-02.zip"))


def test_transient_errors_of_an_archive_are_tried_again(spark, tmp_path):
    waits, left, good = [], [2], archives(lambda n: [line(0)])

    def shaky(*a):
        left[0] -= 1
        return Response(503, b"") if left[0] >= 0 else good(*a)

    assert Archive("https://a.example", transport=shaky, sleep=waits.append).land(spark, str(tmp_path), "abc", "1m", 2024, 1)["fetched"] and waits == [1, 2]


def test_archive_phase(spark, tmp_path):
    """Two days of December and all of January; a gap; run again, nothing is fetched and nothing changes."""
    day = lambda d: [line(1440 * d + i) for i in range(1440) if not (d == 3 and 100 <= i < 110)]

    def minutes(name):
        parts = name.replace(".zip", "").split("-")[2:]
        if parts == ["2024", "01"]:
            return [k for d in range(31) for k in day(d)]
        return day(int(parts[2]) - 32) if parts[:2] == ["2023", "12"] else None

    calls, inner = [], archives(minutes)
    a = Archive("https://a.example", transport=lambda *x: calls.append(x[0]) or inner(*x))
    layout = Layout(str(tmp_path / "root"))
    (row,) = phases.archive_phase(spark, a, MARKET, "2023-12-30", "2024-01-31", layout)
    assert len(calls) == 6 and row["raw_files"] == 3 and row["expected"] == 33 * 1440 and row["actual"] == 33 * 1440 - 10
    assert row["gaps"] == 1 and row["missing_candles"] == 10 and row["status"] == "PASS" and row["incomplete_rows"] == 0
    assert {t["timeframe"]: (t["rows"], t["incomplete_rows"]) for t in row["timeframes"]}["1d"] == (33, 1)
    (again,) = phases.archive_phase(spark, a, MARKET, "2023-12-30", "2024-01-31", layout)
    assert len(calls) == 6 and again["actual"] == row["actual"]
    audited = phases.audit(spark, layout.inside("data/processed", "candles"))
    assert audited.count() == 12 and audited.where("not agrees").isEmpty()
    assert ingest.from_archive(spark, a, MARKET, "2023-12-30", "2024-01-31", landing=layout.inside("data/raw", "sim", "spot")).count() == row["actual"]


def test_pilot_of_a_silent_provider(spark, tmp_path):
    got = phases.pilot(spark, HttpProvider("https://x.example", transport=lambda *a: Response(200, b"[]")), MARKET, Layout(str(tmp_path)))
    assert got["rows"] == 0 and not got["reachable"] and got["landed"]["rows"] == 0


def test_trade_probe():
    now = [1000.0]

    class Socket:
        left = [{"T": 1000_900.0}, {"E": 1001_100.0}, {"x": 1}]

        def recv(self, timeout):
            if not self.left:
                now[0] += timeout
                raise TimeoutError
            now[0] += 1.0
            return json.dumps(self.left.pop(0))

    class Clock:
        def server_time_ms(self):
            return 999_800

    @contextmanager
    def connect(stream):
        assert stream == "abc@trade"
        yield Socket()

    got = trade_probe(connect, Clock(), "ABC", seconds=5, clock=lambda: now[0])
    assert got["messages"] == 3 and got["clock_skew_ms"] == 200 and got["latencies_ms"] == [-100.0, 700.0] and got["average_latency_ms"] == 300.0
    assert got["sample"] == {"T": 1000900.0} and got["first_message_utc"].startswith("1970-01-01T00:16:41") and got["clean_shutdown"]


def test_layout(spark, tmp_path):
    layout = Layout(str(tmp_path / "r"))
    assert set(layout.missing(spark)) == set(AREAS)
    layout.prepare(spark)
    assert layout.missing(spark) == [] and files.writable(spark, layout.area("data/raw"))
    assert layout.series("data/raw", "SIM", "spot", "abc", "1m") == f"{tmp_path}/r/data/raw/sim/spot/ABC/1m" and layout.inside() == f"{tmp_path}/r"
    for parts in (("..", "x"), ("/etc",), ("a", "../../b"), ("s3://b",)):
        with pytest.raises(errors.PathError):
            layout.inside(*parts)
    with pytest.raises(errors.PathError):
        layout.area("data/none")
    with pytest.raises(errors.PathError):
        layout.series("data/raw", "sim", "spot", "a/b", "1m")


def test_logs(tmp_path):
    log = logs.setup("tidemark.test", level="warning", folder=str(tmp_path), console=False, max_bytes=200, backups=2)
    for i in range(20):
        log.warning("message %d", i)
        log.info("not this")
    assert len(log.handlers) == 1 and logs.setup("tidemark.test", level="odd", console=False).level == logging.INFO
    text = (tmp_path / "tidemark.log").read_text()
    assert "WARNING  | tidemark.test:" in text and "not this" not in text and sorted(p.name for p in tmp_path.iterdir()) == ["tidemark.log", "tidemark.log.1", "tidemark.log.2"]
    (tmp_path / "file").write_text("")
    with pytest.raises(errors.LoggingError):
        logs.setup("tidemark.test", folder=str(tmp_path / "file" / "x"), console=False)
    logs.close(logging.getLogger("tidemark.test"))


def test_health_tells_what_is_wrong(spark, tmp_path):
    (tmp_path / "good.yaml").write_text("a: 1\n")
    (tmp_path / "bad.yaml").write_text("a: ${NO_SUCH_NAME}\n")
    got = health.check(spark, configs=[str(tmp_path / "good.yaml")], root=str(tmp_path))
    assert got["configurations"][0] and not got["git"][0]
    got = health.check(spark, layout=Layout(str(tmp_path / "x")), configs=[str(tmp_path / "bad.yaml")])
    assert not got["configurations"][0] and "NO_SUCH_NAME" in got["configurations"][1] and not got["folders"][0]
    Layout(str(tmp_path / "x")).prepare(spark)
    assert health.check(spark, layout=Layout(str(tmp_path / "x")))["folders"][0]


def test_errors_are_what_callers_expect():
    assert issubclass(config.ConfigError, ValueError) and issubclass(ingest.Interrupted, errors.TidemarkError) and issubclass(errors.SourceError, RuntimeError)


def test_quality_summary_counts_classes(spark, tmp_path):
    minute = lambda i, **k: candle(START + timedelta(minutes=i), tf="1m", **k)
    rows = [minute(0), minute(1, v=5, tb=9), minute(2, o=-1, h=1, l=-2, c=0.5), minute(3, o=100, h=90, l=99, c=100), minute(6, complete=False), minute(6, complete=False), minute(7, instrument="Y")]
    df = series(spark, rows).withColumn("seq", F.monotonically_increasing_id())
    out = report.quality_summary(validate.annotate(df), df.select(*CANDLE_COLUMNS), "2024-01-01 00:00:00", "2024-01-01 00:10:00", landed=[{"bytes": 3}, {"bytes": 4}], processing_seconds=1.5)
    got = {r["instrument"]: r for r in report.save_quality(spark, out, str(tmp_path / "q.json"))}
    x = got["X"]
    assert x["rows"] == 6 and x["actual"] == 5 and x["expected"] == 10 and x["coverage_percent"] == 50.0 and x["status"] == "FAIL"
    assert x["volume_anomalies"] == 1 and x["non_positive_prices"] == 1 and x["ohlc_violations"] >= 1 and x["incomplete_rows"] == 2 and x["missing_candles"] == 2 and x["raw_bytes"] == 7 and x["raw_files"] == 2
    assert got["Y"]["status"] == "PASS" and got["Y"]["processing_seconds"] == 1.5 and len(json.loads((tmp_path / "q.json").read_text())) == 2 and "# sim X spot 1m: FAIL" in (tmp_path / "q.md").read_text()


def test_coverage_expects_candles_of_the_timeframe(spark):
    rows = [candle(START + timedelta(seconds=step * i), tf=tf) for tf, step, n in (("1m", 60, 30), ("5m", 300, 9), ("1h", 3600, 1)) for i in range(n)]
    df = validate.annotate(series(spark, [*rows, rows[0]]).withColumn("seq", F.monotonically_increasing_id()))
    told = lambda end, **k: {r["timeframe"]: (r["expected"], r["actual"], r["coverage_percent"]) for r in report.coverage(df, "2024-01-01 00:00:00", end, **k).collect()}
    assert told("2024-01-01 01:00:00") == {"1m": (60, 30, 50.0), "5m": (12, 9, 75.0), "1h": (1, 1, 100.0)}
    assert told("2024-01-01 00:30:00")["1h"] == (0, 1, 0.0)
    assert told("2024-01-01 01:00:00", step=60)["5m"] == (60, 9, 15.0)


def test_file_report(spark, tmp_path):
    rows = series(spark, [candle(START + timedelta(days=20 * i), instrument=n) for i in range(4) for n in "AB"])
    path = str(tmp_path / "t")
    tables.write_candles(rows, path)
    got = manifest.file_report(spark, path).collect()
    assert len(got) == 6 and sum(r["rows"] for r in got) == 8
    for r in got:
        raw = open(urlsplit(r["file"]).path, "rb").read()
        assert r["sha256"] == hashlib.sha256(raw).hexdigest() and r["bytes"] == len(raw)
    told = manifest.candle_manifest(rows, source="test", path=path)
    assert [f["file"] for f in told["files"]] == sorted(r["file"] for r in got) and told["status"] == "PASS"
