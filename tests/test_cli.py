import json

from pyspark.sql import functions as F

from tidemark import cli


def test_health(spark, tmp_path, capsys):
    assert cli.main(["health"], spark) == 0
    told = json.loads(capsys.readouterr().out)
    assert len(told) == 7 and all(t["ok"] for t in told.values())
    assert cli.main(["health", "--root", str(tmp_path / "none")], spark) == 1
    assert "missing: configs" in json.loads(capsys.readouterr().out)["folders"]["detail"]


def test_expand_inspect_and_features(spark, tmp_path, capsys):
    line = lambda i: f"{1704067200000 + 60000 * i},100,101,99,{100 + i % 3},{1 + i % 5},0,500,3,0.5,50,0"
    (tmp_path / "k.csv").write_text("\n".join(line(i) for i in range(3000) if i != 77))
    table, out = str(tmp_path / "t"), str(tmp_path / "f")
    names = ["--venue", "SIM", "--instrument", "abc"]
    assert cli.main(["expand", str(tmp_path / "k.csv"), "--table", table, "--gaps", str(tmp_path / "g"), *names], spark) == 0
    assert cli.main(["inspect", "--table", table], spark) == 0 and cli.main(["validate", "--table", table], spark) == 0
    assert cli.main(["gaps", "--registry", str(tmp_path / "g")], spark) == 0
    assert cli.main(["features", "--table", table, "--out", out, "--manifest", str(tmp_path / "m.json")], spark) == 0
    told = json.loads((tmp_path / "m.json").read_text())
    assert told["storage"]["files"][0]["rows"] == 600 and len(told["storage"]["files"][0]["sha256"]) == 64 and told["coverage"]["rows"] == 600
    got = spark.read.parquet(out)
    assert got.count() == 600 and got.where("is_warmup").count() == 311 and got.where(F.col("feature_set") == "v2.0.0").count() == 600
    assert "PROVIDER_GAP" in capsys.readouterr().out


def test_backfill_and_probe(spark, tmp_path, capsys):
    klines = [[1704067200000 + 60000 * i, "100", "101", "99", "100", "5", 0, "500", 3, "1", "100", "0"] for i in range(130)]
    (tmp_path / "all.json").write_text(json.dumps(klines))
    names = ["--venue", "SIM", "--instrument", "abc", "--landing", str(tmp_path / "l"), "--table", str(tmp_path / "t"), "--limit", "50"]
    assert cli.main(["backfill", "--source", str(tmp_path / "all.json"), "--start", "2024-01-01 00:00:00", "--end", "2024-01-01 02:10:00", *names], spark) == 0
    assert json.loads(capsys.readouterr().out)["candles"] == 130
    (tmp_path / "m.json").write_text('{"event_ms": 10, "ingest_ms": 35}\n{"event_ms": 20, "ingest_ms": 25}\n')
    assert cli.main(["probe", "--messages", str(tmp_path / "m.json")], spark) == 0
    assert "15.0" in capsys.readouterr().out


def test_pilot_phase_audit_and_checkpoints(spark, tmp_path, capsys):
    klines = [[1704067200000 + 60000 * i, "100", "101", "99", "100", "5", 0, "500", 3, "1", "100", "0"] for i in range(130)]
    (tmp_path / "all.json").write_text(json.dumps(klines))
    source = ["--source", str(tmp_path / "all.json"), "--venue", "SIM", "-s", "abc", "--root", str(tmp_path / "r")]
    assert cli.main(["pilot", *source, "-l", "20"], spark) == 0
    told = json.loads(capsys.readouterr().out)
    assert told["rows"] == told["table_rows"] == 20 and told["landed"]["first_ms"] == 1704067200000 + 60000 * 110
    for _ in range(2):  # again: nothing to do
        assert cli.main(["phase", *source, "--start", "2024-01-01 00:00:00", "--end", "2024-01-01 02:10:00", "--limit", "50"], spark) == 0
        (row,) = json.loads(capsys.readouterr().out)
        assert row["expected"] == row["actual"] == 130 and row["raw_files"] == 3 and {t["timeframe"]: t["rows"] for t in row["timeframes"]}["5m"] == 26
    assert "| 5m | 26 | 26 |" in next((tmp_path / "r/artifacts/reports").glob("quality_*.md")).read_text()
    assert cli.main(["audit", "--table", str(tmp_path / "r/data/processed/candles")], spark) == 0
    capsys.readouterr()
    assert cli.main(["checkpoints", "--landing", str(tmp_path / "r/data/raw/sim/spot/ABC/1m"), "--status", "completed"], spark) == 0
    assert [c["planned"] for c in json.loads(capsys.readouterr().out)] == [3]
    assert cli.main(["resample", "--table", str(tmp_path / "r/data/processed/candles"), "-t", "5m,15m", "-s", "abc"], spark) == 0
