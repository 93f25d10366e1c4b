"""The jobs run as commands, one after the other."""

import json

import pytest

from shelfwise import Lakehouse, jobs
from shelfwise.jobs import main
from shelfwise.streaming import land_raw, landed_lines
from tests.fixtures import SAMPLE_EVENTS


def test_jobs_from_files_to_report(spark, tmp_path, write_lines, capsys):
    write_lines(tmp_path / "raw" / "2026" / "a.jsonl", [json.dumps(e) for e in SAMPLE_EVENTS])
    paths = {name: str(tmp_path / name) for name in ("raw", "bronze", "checkpoint", "out")}
    load = ["load", "--raw", paths["raw"], "--bronze", paths["bronze"], "--checkpoint", paths["checkpoint"]]
    main(load)
    assert "Lines read: 28, loaded: 28, rejected: 0" in capsys.readouterr().out
    main(load)
    assert "No new file" in capsys.readouterr().out
    main(["refresh", "--bronze", paths["bronze"], "--out", paths["out"], "--publish"])
    main(["predict", "--tables", paths["out"], "--keep-keys"])
    report = capsys.readouterr().out
    assert "13 rows scored" in report and "pred_stockout_prob" in report
    assert spark.table("gold.features_daily").count() == 13
    assert spark.table("gold.stockout_predictions_keyed").count() == 13
    assert Lakehouse(spark, paths["out"]).stockout_predictions.count() == 13


def test_messages_to_published_tables_with_defaults(spark, tmp_path, monkeypatch):
    """Land, load, refresh and predict; a stream of files stands in for the topic."""
    messages = [json.dumps(e).encode() for e in SAMPLE_EVENTS] + [b"broken", b'{"event_date":"x"}']
    source = str(tmp_path / "topic")
    spark.createDataFrame([(m,) for m in messages], "value binary").write.parquet(source)
    asked = {}

    def topic(session, servers, name, **options):
        asked.update(options)
        return session.readStream.schema("value binary").parquet(source)

    def drained(*args, **options):
        return land_raw(*args, trigger={"availableNow": True}, **options)

    monkeypatch.setattr(jobs, "read_topic", topic)
    monkeypatch.setattr(jobs, "land_raw", drained)
    raw, bronze, out = (str(tmp_path / name) for name in ("raw", "bronze", "out"))
    main(["land", "--servers", "host:1", "--raw", raw, "--checkpoint", str(tmp_path / "c1")])
    main(["load", "--raw", raw, "--bronze", bronze, "--checkpoint", str(tmp_path / "c2")])
    main(["refresh", "--bronze", bronze, "--out", out, "--publish"])
    main(["predict", "--tables", out])
    assert asked == {"max_events_per_batch": 10_000_000, "max_events_per_task": 500_000}
    sales = spark.table("gold.fact_sales_daily").where("store_id = 'south' AND product_id = 'rice'")
    assert [(str(r.date), int(r.total_qty_sold), r.sales_event_count) for r in sales.collect()] == [("2026-03-04", 8, 3)]
    assert spark.table("gold.stockout_predictions").count() == 13
    assert spark.table("gold.stockout_predictions").where("stockout_risk_label = 1").count() == 2


def test_update_and_load_by_stream(spark, tmp_path, write_lines, capsys):
    paths = {name: str(tmp_path / name) for name in ("raw", "bronze", "loaded", "out", "updated")}
    load = ["load", "--stream", "--raw", paths["raw"], "--bronze", paths["bronze"], "--checkpoint", paths["loaded"]]
    days = ["update", "--bronze", paths["bronze"], "--out", paths["out"], "--checkpoint", paths["updated"], "--publish"]
    for part, lines in enumerate(([json.dumps(e) for e in SAMPLE_EVENTS[:20]], ["broken", *(json.dumps(e) for e in SAMPLE_EVENTS[20:])])):
        write_lines(tmp_path / "raw" / f"{part}.jsonl", lines)
        main(load)
        main(days)
    said = capsys.readouterr().out
    assert "Lines read: 20, loaded: 20, rejected: 0" in said and "Lines read: 9, loaded: 8, rejected: 1" in said
    assert spark.table("gold.features_daily").count() == 13
    main(["predict", "--tables", paths["out"]])
    assert "13 rows scored" in capsys.readouterr().out


def test_a_signal_ends_the_landing_after_a_batch(spark, tmp_path, monkeypatch):
    import os
    import signal
    import threading

    source = str(tmp_path / "topic")
    spark.createDataFrame([(json.dumps(e).encode(),) for e in SAMPLE_EVENTS], "value binary").write.parquet(source)
    monkeypatch.setattr(jobs, "read_topic", lambda session, *_, **__: session.readStream.schema("value binary").parquet(source))
    raw = tmp_path / "raw"

    def end():
        while not list(raw.glob("state=landed/*/*/*/part-*")):
            pass
        os.kill(os.getpid(), signal.SIGTERM)

    threading.Thread(target=end, daemon=True).start()
    main(["land", "--servers", "host:1", "--raw", str(raw), "--checkpoint", str(tmp_path / "c")])
    assert not spark.streams.active
    assert landed_lines(spark, str(raw)).count() == 28
    assert signal.getsignal(signal.SIGTERM) == signal.SIG_DFL


def test_missing_path_is_refused(spark):
    with pytest.raises(SystemExit):
        main(["land", "--servers", "host:1", "--checkpoint", "c"])
