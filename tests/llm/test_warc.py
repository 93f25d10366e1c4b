import gzip
import hashlib
import json
from pathlib import Path

import pytest

from shelfwise.llm.warc import MANIFEST, members, parse, read_warc, sorted_records, write_warc
from tests.llm.helpers import bag, with_clashes

BIG, OTHER = "<p>ä</p>" * 200, "<b>x</b>" * 300
PAGES = [
    (1, "http://a.example/1", BIG),
    (2, "http://a.example/ü?q=1 2\r\nX: y", "small"),
    (3, None, BIG),
    (4, "http://a.example/4", "small"),
    (5, "http://a.example/5", None),
    (6, "http://a.example/6", ""),
    (7, "http://a.example/7", OTHER),
    (9, "http://a.example/9", BIG),
    (9, "http://a.example/9", BIG),
    (None, "http://a.example/n", OTHER),
    (None, None, "<i>" + OTHER),
    (None, None, "<i>" + OTHER),
]
SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    out, responses = [], set()
    largest = {}
    for key, _, html in rows:
        data = (html or "").encode()
        if key is not None and len(data) >= 1000:
            largest[data] = max(key, largest.get(data, key))
    for key, _, html in rows:
        data = (html or "").encode()
        to = largest.get(data)
        revisit = to is not None and (key != to or (key, data) in responses)
        responses.add((key, data))
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def found(spark, path):
    return bag(read_warc(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@pytest.mark.parametrize(("shard", "roll"), [(32 << 20, 8 << 20), (2000, 600), (1, 1)])
def test_equals_brute_force(spark, tmp_path, shard, roll):
    path = f"file://{tmp_path}/warc"
    write_warc(with_clashes(pages(spark).repartition(3), "shard", "digest"), path, shard_bytes=shard, roll_bytes=roll)
    assert found(spark, path) == brute(PAGES)
    payloads = [(r["page_id"], bytes(r["payload"])) for r in read_warc(spark, path).collect() if r["record_type"] == "response"]
    wanted = [(r[0], (r[2] or "").encode()) for r in PAGES]
    assert set(payloads) <= set(wanted)


def test_same_pages_give_the_same_bytes(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", f"<p>{i % 7}</p>" * (i % 300)) for i in range(400)]
    for name, parts in (("a", 2), ("b", 7)):
        write_warc(pages(spark, rows).repartition(parts), str(tmp_path / name), shard_bytes=20_000, roll_bytes=3000)
    first, second = (json.loads((tmp_path / n / MANIFEST).read_text()) for n in "ab")
    assert first == second
    assert len(first["files"]) > 10
    for file in first["files"]:
        data = (tmp_path / "a" / file["name"]).read_bytes()
        assert data == (tmp_path / "b" / file["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == file["sha256"] and len(data) == file["bytes"]
        with open(tmp_path / "a" / file["name"], "rb") as source:
            records = [parse(m) for m in members(source)]
        assert len(records) == file["records"]
        assert [r["page_id"] for r in records] == sorted(r["page_id"] for r in records)
    ids = [r["page_id"] for r in read_warc(spark, str(tmp_path / "a")).collect()]
    assert sorted(ids) == list(range(400))


def test_pages_of_one_id_go_to_many_shards(spark, tmp_path):
    hot = [(key, f"http://a.example/{i % 9}", f"<p>{i % 60}</p>" * 150) for key in (None, 50) for i in range(200)]
    rows = hot + [(i, f"http://a.example/{i}", f"<i>{i}</i>" * 90) for i in range(200)]
    shards = sorted_records(pages(spark, rows).repartition(4), 20_000, 1000).where("NOT tells").groupBy("shard", "page_id").count().collect()
    for key in (None, 50):
        mine = [r["count"] for r in shards if r["page_id"] == key]
        assert sum(mine) >= 200 and max(mine) < 60
    write_warc(pages(spark, rows).repartition(4), str(tmp_path / "warc"), shard_bytes=20_000, roll_bytes=3000)
    assert found(spark, str(tmp_path / "warc")) == brute(rows)


def test_a_third_of_the_pages_equal_in_id_and_payload(spark, tmp_path):
    text = "<p>same</p>" * 100
    hot = [(key, "http://a.example/hot", text) for key in (None, 70) for _ in range(150)]
    hot += [(70, f"http://a.example/{i}", text) for i in range(150)] + [(70, None, text)] * 60 + [(8, "http://a.example/s", "short")] * 200
    rows = hot + [(100 + i, f"http://a.example/{i}", f"<i>{i}</i>" * (40 + i % 90)) for i in range(300)] + [(60, None, text)] * 3
    for name, parts in (("a", 3), ("b", 5)):
        write_warc(pages(spark, rows).repartition(parts), str(tmp_path / name), shard_bytes=30_000, roll_bytes=8000)
        assert found(spark, str(tmp_path / name)) == brute(rows)
    first, second = (json.loads((tmp_path / n / MANIFEST).read_text()) for n in "ab")
    assert first == second
    by_shard, ids = {}, []
    for file in first["files"]:
        by_shard[file["name"][:6]] = by_shard.get(file["name"][:6], 0) + file["records"]
        with open(tmp_path / "a" / file["name"], "rb") as source:
            ids += [line for m in members(source) for line in m.split(b"\r\n") if line.startswith(b"WARC-Record-ID")]
    # A shard has room for 18 of the hot rows with the large payload, and 59 with the small one.
    assert max(by_shard.values()) < 70 and len(by_shard) > 25
    assert len(ids) == len(set(ids)) == len(rows)


def test_only_committed_files_are_read(spark, tmp_path):
    path = tmp_path / "warc"
    write_warc(pages(spark), str(path))
    (path / "000099-00000.warc.gz").write_bytes(b"left by a lost attempt")
    assert found(spark, str(path)) == brute(PAGES)
    assert not list((path / "_temporary").glob("*.warc.gz"))


def test_damage_is_found(tmp_path):
    from shelfwise.llm.warc import record

    good = record(1, "http://a.example", b"abc", None, False, 0)
    assert parse(good)["payload"] == b"abc"
    with pytest.raises(ValueError):
        parse(good.replace(b"abc", b"abd"))
    cut = tmp_path / "cut.gz"
    cut.write_bytes(gzip.compress(good)[:-9])
    with cut.open("rb") as source, pytest.raises(ValueError):
        list(members(source))


def test_empty_table(spark, tmp_path):
    write_warc(pages(spark, []), str(tmp_path / "none"))
    assert json.loads(Path(tmp_path / "none" / MANIFEST).read_text()) == {"files": []}
    assert read_warc(spark, str(tmp_path / "none")).count() == 0
