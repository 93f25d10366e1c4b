"""WARC archives as a Spark data source: deterministic shards, written and read by tasks.

Rows are put into shards by ranges of the page id, then of a hash of the payload, and sorted
in them. The ranges part the bytes of a sample chosen by hash, so the same pages give the same shards and the same bytes.
Rows of one id and payload that are too many for a shard have shards of their own: rows that are equal
altogether travel as one with a count, and both rows and counts are dealt over these shards. A task
writes its shard as gzip members, one a record, and starts a new file once the compressed
size passes the limit. Files are written under temporary names that no other attempt has;
the driver renames the files of the attempts that Spark committed, and writes the manifest
last. Readers see only what the manifest names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from shelfwise.llm.common import settled

# Equal payloads of this many bytes or more are kept once.
REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
ROLL_BYTES = 8 << 20
# Page ids and payloads looked at for the ranges of the shards; every page is written.
RANGE_SAMPLE = 50_000

# Fixed values of the archive format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest.json"
DATE = "1970-01-01T00:00:00Z"

_PAGE, _LENGTH, _REFERS = "X-Page-ID", "X-Payload-Length", "X-Refers-To-Page-ID"
_LEAST = -(1 << 63)


@dataclass
class _Files(WriterCommitMessage):
    files: list[dict]


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, nth: int | str) -> str:
    """The same for the same page, payload and turn among its repeats."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{nth}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, nth: int | str) -> bytes:
    """One archive record; a revisit has the headers of its response, and no payload."""
    digest = _sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, nth)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest, 0) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
        (_PAGE, page_id),
        (_LENGTH, len(payload)),
        (_REFERS, refers_to if revisit else None),
    ]
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers if value is not None)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    # A gzip member without time or name: equal records give equal bytes.
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Rolling:
    """The files of one task attempt."""

    def __init__(self, path: str, roll: int):
        self.fs, self.root = _open(path)
        self.roll, self.attempt = roll, uuid.uuid4().hex
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.files: list[dict] = []
        self.out = None
        self.shard = self.nth = -1

    def add(self, shard: int, member: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.nth = shard, -1
        if self.out is None:
            self.nth += 1
            name = f"{shard:06d}-{self.nth:05d}.warc.gz"
            self.files.append({"name": name, "temporary": f"_temporary/{self.attempt}-{name}", "records": 0, "bytes": 0})
            self.out = self.fs.open_output_stream(f"{self.root}/{self.files[-1]['temporary']}", compression=None)
            self.digest = hashlib.sha256()
        self.out.write(member)
        self.digest.update(member)
        self.files[-1]["records"] += 1
        self.files[-1]["bytes"] += len(member)
        if self.files[-1]["bytes"] >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.files[-1]["sha256"] = self.digest.hexdigest()


#: The columns of ``sorted_records``.
_SORTED = ("shard", "page_id", "part", "tells", "digest", "refers_to", "url", "html", "lead", "start", "copies")


class WarcWriter(DataSourceArrowWriter):
    """Takes the rows of ``sorted_records``: those that tell a page's response come before the page.

    A row with ``lead`` stands for ``copies`` equal pages, numbered from ``start``, and holds its response itself;
    the first of them is the first of its page where ``lead`` is true.
    """

    def __init__(self, path: str, roll: int):
        self.path, self.roll = path, roll

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files = _Rolling(self.path, self.roll)
        at, responses, seen = object(), {}, {}
        for batch in iterator:
            columns = [batch.column(n).to_pylist() for n in _SORTED]
            for shard, page_id, part, tells, digest, refers_to, url, html, lead, start, copies in zip(*columns, strict=True):
                if lead is not None:
                    payload = (html or "").encode()
                    for k in range(start, start + copies):
                        nth = 0 if lead and k == 0 else f"{'-' if url is None else '+' + url}#{k}"
                        revisit = refers_to is not None and (refers_to != page_id or nth != 0)
                        files.add(shard, _member(record(page_id, url, payload, refers_to, revisit, nth)))
                    continue
                if (page_id, part) != at:
                    at, responses, seen = (page_id, part), {}, {}
                if tells:
                    responses[digest] = refers_to
                    continue
                payload = (html or "").encode()
                own = hashlib.sha256(payload).digest()
                nth = seen[own] = seen.get(own, -1) + 1
                response = responses.get(own)
                revisit = response is not None and (response != page_id or nth > 0)
                files.add(shard, _member(record(page_id, url, payload, response, revisit, nth)))
        files.close()
        return _Files(files.files)

    def commit(self, messages: list[_Files | None]) -> None:
        system, root = _open(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["name"])
        for file in files:
            system.move(f"{root}/{file.pop('temporary')}", f"{root}/{file['name']}")
        system.create_dir(root, recursive=True)
        early = f"{root}/_temporary-{MANIFEST}"
        with system.open_output_stream(early) as out:
            out.write(json.dumps({"files": files}, indent=1).encode())
        system.move(early, f"{root}/{MANIFEST}")

    def abort(self, messages: list[_Files | None]) -> None:
        """Nothing is named by a manifest, so nothing can be read; temporary files stay for the folder's owner."""


@dataclass
class _File(InputPartition):
    name: str
    records: int
    bytes: int


def members(source: BinaryIO, block: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    unpacker, held = zlib.decompressobj(31), []
    while data := source.read(block):
        while data:
            held.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(held)
                unpacker, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> dict:
    """Type, page, payload size and digest of a record; digests and lengths are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != VERSION or rest[len(block) :] != b"\r\n\r\n" or _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    digest, size, revisit = headers["WARC-Payload-Digest"], int(headers[_LENGTH]), headers["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    if not revisit and (len(payload) != size or _sha1(payload) != digest):
        raise ValueError(f"payload and digest differ in {headers['WARC-Record-ID']}")
    return {
        "page_id": int(headers[_PAGE]) if _PAGE in headers else None,
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "refers_to": int(headers[_REFERS]) if _REFERS in headers else None,
        "payload_bytes": size,
        "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
        "payload": payload,
    }


_READ = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "payload": pa.binary(),
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self) -> list[_File]:
        system, root = _open(self.path)
        with system.open_input_stream(f"{root}/{MANIFEST}") as source:
            found = [_File(f["name"], f["records"], f["bytes"]) for f in json.loads(source.read())["files"]]
        return found or [_File("", 0, 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, root = _open(self.path)
        rows, held, count = [], 0, 0
        with system.open_input_stream(f"{root}/{partition.name}", compression=None) as source:
            for member in members(source):
                row = parse(member)
                rows.append(row)
                held += len(row["payload"] or b"") if "payload" in self.names else 100
                count += 1
                if held >= 4 << 20:
                    yield self._batch(rows)
                    rows, held = [], 0
        if count != partition.records:
            raise ValueError(f"{partition.name} has {count} records; the manifest says {partition.records}")
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], type=_READ[n]) for n in self.names], names=self.names
        )


class WarcSource(DataSource):
    """``spark.read.format("warc")``, after ``register``; ``payload=false`` leaves the payloads out."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _names(self) -> list[str]:
        return [n for n in _READ if n != "payload" or self.options.get("payload", "true") == "true"]

    def schema(self) -> str:
        kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
        return ", ".join(f"{n} {kinds[_READ[n]]}" for n in self._names())

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self._names())

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("roll_bytes", ROLL_BYTES)))


def _ranges(keys: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """First page id and payload hash of the shards after the first, so that keys that a hash picks have as many bytes in each."""
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = max(1, -(-total // shard_bytes))
    every = max(1, rows // RANGE_SAMPLE)
    own = F.coalesce("page_id", F.lit(_LEAST)).alias("page_id")
    picked = keys.select(own, "part", "bytes").where(F.pmod(F.xxhash64("page_id", "part"), F.lit(every)) == 0)
    found = sorted((r["page_id"], r["part"], r["bytes"]) for r in picked.collect())
    before = np.cumsum([0, *(size for *_, size in found)])
    # A shard begins with the first key that has its share of the bytes before it.
    first = np.searchsorted(before[:-1], [before[-1] * k // shards for k in range(1, shards)]).tolist()
    return sorted({found[i][:2] for i in first if i < len(found)})


def _digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256))


def _same_key(left: str, right: str) -> Column:
    return F.col(f"{left}.page_id").eqNullSafe(F.col(f"{right}.page_id")) & (F.col(f"{left}.part") == F.col(f"{right}.part"))


def _dealt(pages: DataFrame, hot: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """The rows of hot ids and payloads, equal ones as one, in shards numbered from ``shards``."""
    warm = (
        pages.alias("p")
        .join(hot.alias("h"), _same_key("p", "h"))
        .groupBy("p.page_id", "p.part", "url", "html", "per", "chunks", "before")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("digest", _digest())
    )
    # Of all rows of a page and payload, one is the first.
    leads = (
        warm.groupBy("page_id", "part", "digest")
        .agg(F.min(F.struct(F.xxhash64("url").alias("h"), "url")).alias("first"))
        .join(groups, "digest", "left")
        .withColumnRenamed("digest", "of")
    )
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("w.n") - 1, F.col("per"))).alias("start")
    chunk = F.pmod(F.xxhash64("url") + F.floor(F.col("start") / F.col("per")), F.col("chunks"))
    return (
        warm.alias("w")
        .join(leads.alias("l"), _same_key("w", "l") & (F.col("w.digest") == F.col("l.of")))
        .select("w.*", "refers_to", F.col("url").eqNullSafe(F.col("first.url")).alias("lead"), pieces)
        .withColumns(
            {
                "shard": (F.lit(shards) + F.col("before") + chunk).cast("int"),
                "tells": F.lit(False),
                "copies": F.least(F.col("per"), F.col("n") - F.col("start")),
            }
        )
        .select(*_SORTED)
    )


def sorted_records(pages: DataFrame, shard_bytes: int, revisit_bytes: int) -> DataFrame:
    """The pages in shards, sorted by id and a hash of the payload; before pages whose payload has copies a row tells the response.

    Only ids and digests are grouped. The pages themselves are shuffled once, but for those of
    one id and payload with more bytes than a shard: equal ones of these are merged first, and a row stands for ``copies``.
    """
    pages = pages.withColumn("part", F.xxhash64(F.coalesce("html", F.lit(""))))
    size = F.octet_length("html")
    keys = settled(
        pages.groupBy("page_id", "part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(size, F.lit(0)) + 500).alias("bytes"))
    )
    is_hot = (F.col("n") > 1) & (F.col("bytes") > shard_bytes)
    cuts = _ranges(keys.where(~is_hot), shard_bytes)
    first = np.array([page_id for page_id, _ in cuts], dtype=np.int64)

    @F.pandas_udf("int")
    def shard(ids: pd.Series, parts: pd.Series) -> pd.Series:
        ids = ids.to_numpy(dtype=np.int64)
        out = np.searchsorted(first, ids, side="left").astype(np.int32)
        for i in np.flatnonzero(np.searchsorted(first, ids, side="right") > out).tolist():
            out[i] = bisect_right(cuts, (int(ids[i]), int(parts.iloc[i])))
        return pd.Series(out)

    # At most one for each shard's bytes.
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(shard_bytes * F.col("n") / F.col("bytes")))
    hot = keys.where(is_hot).withColumn("per", per).withColumn("chunks", F.ceil(F.col("n") / F.col("per")))
    before = F.sum("chunks").over(Window.orderBy("page_id", "part")) - F.col("chunks")
    hot = settled(hot.select("page_id", "part", "per", "chunks", before.alias("before")))
    more = hot.agg(F.coalesce(F.sum("chunks"), F.lit(0))).first()[0]
    cold = pages.alias("p").join(hot.alias("h"), _same_key("p", "h"), "left_anti") if more else pages

    large = pages.where(size >= revisit_bytes).select("page_id", "part", _digest().alias("digest"))
    groups = (
        large.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    none = {"lead": F.lit(None).cast("boolean"), "start": F.lit(0).cast("bigint"), "copies": F.lit(1).cast("bigint")}
    tells = cold.where(size >= revisit_bytes).select("page_id", "part", _digest().alias("digest")).join(groups, "digest").select(
        "page_id", "part", F.lit(True).alias("tells"), "digest", "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html")
    )
    rows = cold.select(
        "page_id", "part", F.lit(False).alias("tells"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("refers_to"), "url", "html"
    )
    every = (
        tells.unionByName(rows).withColumn("shard", shard(F.coalesce("page_id", F.lit(_LEAST)), "part")).withColumns(none).select(*_SORTED)
    )
    if more:
        every = every.unionByName(_dealt(pages, hot, groups, len(cuts) + 1))
    return every.repartitionById(len(cuts) + 1 + more, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "part", F.col("tells").desc(), F.xxhash64("url", "html"), "start"
    )


def write_warc(
    pages: DataFrame,
    path: str,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write the rows ``page_id, url, html`` as archives below a new path; other columns are not looked at.

    A null html is an empty payload, a null url gives no target. Of records with equal
    payloads of at least ``revisit_bytes`` the one with the largest page id is the
    response and the others refer to it; of repeated rows of that page one is the
    response. A page without an id counts as smaller than any other; payloads that only
    such pages have are responses all. No page gives a manifest without files.
    """
    pages.sparkSession.dataSource.register(WarcSource)
    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    records = sorted_records(narrow, shard_bytes, revisit_bytes)
    records.write.format("warc").option("roll_bytes", roll_bytes).mode("append").save(path)


def read_warc(spark, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest names, one row each, digests checked."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
