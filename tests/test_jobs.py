"""The command line, end to end: messages to tables, model, predictions and SQL."""

import json

from tickloom.config import TickConfig
from tickloom.jobs import main
from tickloom.session import shared_folder, stage, temporary_stages
from tickloom.sources.tables import Tables

EPOCH = 1714564800


def test_end_to_end(spark, tmp_path, capsys):
    topic, base, model = tmp_path / "topic", str(tmp_path / "lake"), str(tmp_path / "model")
    topic.mkdir()
    ticks = [
        dict(symbol=s, price=10.0 + i % 2, open=10.0, high=12.0, low=9.0, volume=5, timestamp=EPOCH + 10 * i)
        for s in ("A", "B")
        for i in range(60)
    ]
    ticks.append(dict(ticks[0], symbol="Z", timestamp=EPOCH + 10**7))
    lines = [json.dumps({"value": json.dumps(t), "timestamp": "2024-05-01T12:00:00"}) for t in ticks]
    (topic / "ticks.json").write_text("\n".join(lines))

    assert main(["train", "--base", base, "--model", model]) == 1
    source = ["--source-format", "json", "--option", f"path={topic}"]
    assert main(["pipeline", "--base", base, *source, "--once"]) == 0
    assert main(["train", "--base", base, "--model", model, "--trees", "5"]) == 0
    assert "accuracy=" in capsys.readouterr().out
    assert main(["score", "--base", base, "--model", model, "--model-id", "m", "--once"]) == 0
    assert main(["sql", "--base", base, "SELECT symbol, signal FROM predictions ORDER BY symbol"]) == 0
    out = capsys.readouterr().out
    assert "'symbol': 'A'" in out and "2 rows in" in out
    assert main(["sql", "--base", base]) == 0
    assert "mean_price" in capsys.readouterr().out
    assert main(["sql", "--base", base, "SELECT x FROM nowhere"]) == 1
    assert main(["sql", "--base", base, "SELECT id FROM range(5000)"]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert lines[:5000] == [f"{{'id': {i}}}" for i in range(5000)] and lines[5000].startswith("5000 rows")
    assert main(["sql", "--base", base, "SELECT id FROM range(5000)", "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000
    assert Tables(spark, TickConfig(base_path=base)).read("gold").count() == 120


def test_temporary_stages_are_deleted(spark, tmp_path):
    from pathlib import Path

    def staged():
        return {p.name for p in Path(shared_folder(spark)).glob("scratch-*")}

    kept = stage(spark.range(3), "scratch")
    before = staged()
    with temporary_stages(spark):
        assert stage(spark.range(3), "scratch").count() == 3
        assert len(staged()) == len(before) + 1
    assert staged() == before
    assert kept.count() == 3
