"""The file load with names in a table, reports of streams, restarts and stops."""

import importlib
import json
import os
import threading
import time

import pytest
from pyspark.errors import StreamingQueryException

from shelfwise import update
from shelfwise.sources import read_bronze, read_rejects
from shelfwise.sources.tables import overwrite_partitions
from shelfwise.streaming import land_raw, landed_lines, load_bronze, load_files, reported, run_stream
from tests.conftest import rows
from tests.fixtures import EDGE_LINES, SAMPLE_EVENTS

SAMPLE_LINES = [json.dumps(event) for event in SAMPLE_EVENTS]
file_load = importlib.import_module("shelfwise.streaming.file_load")


@pytest.fixture
def load(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("raw", "bronze", "log")]
    return lambda **options: load_files(spark, *paths, **options)


def lines_of(spark, tmp_path):
    """What is loaded and what is rejected, as text."""
    bronze = read_bronze(spark, str(tmp_path / "bronze")).selectExpr("to_json(event) AS e")
    return sorted(r.e for r in bronze.collect()), sorted(r.line for r in read_rejects(spark, str(tmp_path / "bronze")).collect())


def test_each_file_loads_once_whatever_its_age(spark, tmp_path, write_lines, load):
    write_lines(tmp_path / "raw" / "2026" / "02" / "a.jsonl", SAMPLE_LINES[:5])
    write_lines(tmp_path / "raw" / "2026" / "02" / "notes.txt", ["{}"])
    assert load().loaded == 5
    assert load().files == 0
    late = tmp_path / "raw" / "2025" / "late [1] {a,b}*?%20é.jsonl"
    write_lines(late, [*SAMPLE_LINES[5:8], "", "broken"])
    os.utime(late, (1, 1))
    report = load()
    assert (report.files, report.lines, report.loaded, report.rejected) == (1, 4, 3, 1)
    assert [len(x) for x in lines_of(spark, tmp_path)] == [8, 1]


def test_same_rows_as_the_stream(spark, tmp_path, write_lines, load):
    write_lines(tmp_path / "raw" / "a.jsonl", EDGE_LINES)
    write_lines(tmp_path / "raw" / "b.jsonl", SAMPLE_LINES)
    load()
    load_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "other"), str(tmp_path / "c")).awaitTermination()
    events = lambda name: sorted(r.e for r in read_bronze(spark, str(tmp_path / name)).selectExpr("to_json(event) AS e").collect())
    assert events("bronze") == events("other")
    with pytest.raises(ValueError, match="stream"):
        load_files(spark, str(tmp_path / "raw"), str(tmp_path / "other"), str(tmp_path / "log2"))


def test_what_the_driver_holds_stays_bounded(spark, tmp_path, write_lines, load, monkeypatch):
    """Many loads of few files: each reads the names of its own files only."""
    held = []
    scan = file_load.scan_files
    monkeypatch.setattr(file_load, "scan_files", lambda session, paths: held.append(len(paths)) or scan(session, paths))
    for n in range(11):
        write_lines(tmp_path / "raw" / f"{n}.jsonl", [SAMPLE_LINES[n]])
    assert load(max_files=3).files == 11
    assert held == [3, 3, 3, 2]
    write_lines(tmp_path / "raw" / "more.jsonl", [SAMPLE_LINES[11]])
    load(max_files=3)
    assert held[4:] == [1]
    assert lines_of(spark, tmp_path)[0] == sorted(spark.createDataFrame([(x,) for x in SAMPLE_LINES[:12]], "v string").selectExpr("to_json(parse_json(v)) AS e").toPandas()["e"])


@pytest.mark.parametrize("lost", ["plan", "write", "mark"])
def test_a_load_that_was_cut_off_is_taken_up(spark, tmp_path, write_lines, load, monkeypatch, lost):
    """Before or after any of its three writes; files that came meanwhile wait for the next load."""
    write_lines(tmp_path / "raw" / "a.jsonl", [*SAMPLE_LINES[:3], "broken"])
    load()
    write_lines(tmp_path / "raw" / "b.jsonl", [*SAMPLE_LINES[3:7], "broken too"])
    ends = {"plan": "planned", "write": "bronze", "mark": "done"}[lost]

    def failing(df, path, partition_by):
        if path.endswith(ends):
            raise OSError("lost")
        overwrite_partitions(df, path, partition_by)

    monkeypatch.setattr(file_load, "overwrite_partitions", failing)
    with pytest.raises(OSError):
        load()
    monkeypatch.setattr(file_load, "overwrite_partitions", overwrite_partitions)
    stayed = {p: p.stat().st_mtime_ns for p in (tmp_path / "bronze").rglob("*.parquet")}
    write_lines(tmp_path / "raw" / "c.jsonl", SAMPLE_LINES[7:9])
    load()
    loaded, rejected = lines_of(spark, tmp_path)
    assert len(loaded) == len(set(loaded)) == 9 and rejected == ["broken", "broken too"]
    # What was written stays as it is, so that a stream over the table sees no row twice.
    assert {p: p.stat().st_mtime_ns for p in stayed} == stayed


def test_an_update_follows_the_file_load(spark, tmp_path, write_lines, load):
    paths = [str(tmp_path / name) for name in ("bronze", "tables", "updated")]
    write_lines(tmp_path / "raw" / "a.jsonl", SAMPLE_LINES[:20])
    load()
    update(spark, *paths)
    write_lines(tmp_path / "raw" / "b.jsonl", SAMPLE_LINES[20:])
    load()
    tables = update(spark, *paths)
    assert tables.sales_events.count() + tables.inventory_events.count() == 28
    assert rows(tables.fact_sales_daily.selectExpr("sum(total_qty_sold)")) == [(64,)]


def messages(spark, path, texts):
    spark.createDataFrame([(t.encode(),) for t in texts], "value binary").coalesce(1).write.mode("append").parquet(str(path))


def landing(spark, tmp_path, **options):
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "topic"))
    return lambda: land_raw(stream, str(tmp_path / "landed"), str(tmp_path / "c"), **options)


@pytest.fixture
def told(spark):
    lines = []
    listener = reported(spark, lambda line: lines.append(json.loads(line)))
    yield lines
    spark.streams.removeListener(listener)


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "it took too long"
        time.sleep(0.05)


def test_batches_and_bad_lines_are_reported(spark, tmp_path, write_lines, told):
    messages(spark, tmp_path / "topic", [*SAMPLE_LINES[:4], "broken", '{"event_date":"someday"}'])
    run_stream(landing(spark, tmp_path, trigger={"availableNow": True}), threading.Event())
    write_lines(tmp_path / "raw" / "a.jsonl", [*SAMPLE_LINES[:2], "broken", ""])
    load_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "c2")).awaitTermination()
    wait_for(lambda: sum(x["stream"] == "ended" for x in told) == 2)
    batches = [x for x in told if x["stream"] == "batch" and x["rows"]]
    assert [b["landing"] for b in batches if "landing" in b] == [{"landed": 4, "quarantined": 1, "undated": 1}]
    assert [b["load"] for b in batches if "load" in b] == [{"lines": 3, "loaded": 2, "rejected": 1}]


def test_a_failing_source_is_reported_and_tried_again(spark, tmp_path, told):
    """The second file cannot be read until it is put right; the stream goes on from its checkpoint."""
    messages(spark, tmp_path / "topic", SAMPLE_LINES[:3])
    bad = tmp_path / "topic" / "part-x.parquet"
    bad.write_bytes(b"PAR1 no file PAR1")
    start = landing(spark, tmp_path, trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException):
        run_stream(start, threading.Event(), retries=2, pause=0.0)
    wait_for(lambda: sum(x["stream"] == "failed" for x in told) >= 2)
    assert all("part-x.parquet" in x["error"] for x in told if x["stream"] == "failed")
    assert landed_lines(spark, str(tmp_path / "landed")).count() in (0, 3)

    messages(spark, tmp_path / "good", SAMPLE_LINES[3:5])
    (good,) = (tmp_path / "good").glob("*.parquet")
    began = []

    def mended():
        if began:
            bad.write_bytes(good.read_bytes())
        began.append(1)
        return start()

    run_stream(mended, threading.Event(), retries=2, pause=0.0)
    assert len(began) == 2
    assert sorted(r.value for r in landed_lines(spark, str(tmp_path / "landed")).collect()) == sorted(SAMPLE_LINES[:5])


def test_a_stop_comes_after_a_whole_batch(spark, tmp_path, told):
    """Stopped within a batch, of which each has one file; going on, nothing is lost or repeated."""
    for n in range(8):
        messages(spark, tmp_path / "topic", [f'{{"file":{n},"line":{i}}}' for i in range(50)])
    stop = threading.Event()
    queries = []

    def start():
        queries.append(landing(spark, tmp_path)())
        return queries[-1]

    thread = threading.Thread(target=run_stream, args=(start, stop))
    thread.start()
    wait_for(lambda: queries and queries[0].status["isTriggerActive"] and queries[0].status["isDataAvailable"])
    stop.set()
    thread.join(60)
    assert not thread.is_alive() and not queries[0].isActive
    landed = [json.loads(r.value)["file"] for r in landed_lines(spark, str(tmp_path / "landed")).collect()]
    assert landed and all(landed.count(n) == 50 for n in set(landed))
    run_stream(landing(spark, tmp_path, trigger={"availableNow": True}), threading.Event())
    everything = [r.value for r in landed_lines(spark, str(tmp_path / "landed")).collect()]
    assert len(everything) == len(set(everything)) == 400
    wait_for(lambda: sum(x["stream"] == "ended" for x in told) == 2)
    assert not [x for x in told if x["stream"] == "failed"]


def test_an_idle_stream_stops_at_once(spark, tmp_path):
    messages(spark, tmp_path / "topic", SAMPLE_LINES[:2])
    stop = threading.Event()
    thread = threading.Thread(target=run_stream, args=(landing(spark, tmp_path), stop))
    thread.start()
    wait_for(lambda: (tmp_path / "landed").exists() and landed_lines(spark, str(tmp_path / "landed")).count() == 2)
    stop.set()
    thread.join(20)
    assert not thread.is_alive()
