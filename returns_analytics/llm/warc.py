"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page id, every task rolls its files by compressed size and writes them
under temporary names, and a manifest of the files is stored by Spark's own commit, which accepts one
attempt of each task. Only then are the accepted files renamed, in a second job that may run any
number of times. A lost executor or a repeated task leaves unnamed files at most.

Headers and digests are made anew from the payload. Of equal payloads the one with the largest page
id is a response, the others are revisits that refer to it.

Defined results: null html is an empty payload; a null url is an empty target; repeated page ids are
written once each, and of equal payloads under one id the first is the response; an empty table gives
no file and an empty manifest; extra columns are ignored. Rows without a page id raise.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returns_analytics.llm.storage import Scratch, delete

#: Compressed bytes after which a file is closed.
ROLL_BYTES = 64 << 20
#: Fixed date of all records, so that equal input gives equal files.
DATE = "2020-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
     ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
)
MANIFEST = "shard int, part int, temporary string, name string, records long, bytes long, sha256 string"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "block_ok boolean"
)
_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("block_ok", pa.bool_())]
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, digest (hex) and response_id of every page whose payload occurs twice or more.

    No payload is shuffled for it. Counting is combined before its shuffle, and the join that follows
    is one AQE splits if a payload holds a large part of all rows.
    """
    ids = pages.select(
        "page_id",
        F.sha1(F.coalesce("html", F.lit(""))).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("size"),
    ).filter(F.col("size") >= least_bytes)
    repeated = (
        ids.groupBy("digest", "size")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    return ids.join(repeated, ["digest", "size"]).select("page_id", "digest", "response_id").distinct()


def shard_bounds(pages: DataFrame, shards: int, per_shard: int = 100) -> list[int]:
    """Page ids that cut the table into shards of about equal size.

    The ids looked at are chosen by their hash, about ``per_shard`` for each shard, so that the bounds
    depend on nothing but the ids and the number of shards.
    """
    total = pages.count()
    share = min(1 << 30, max(1, (per_shard * shards << 30) // max(total, 1)))
    ids = sorted(
        row[0]
        for row in pages.select("page_id")
        .filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < share)
        .filter("page_id is not null")
        .collect()
    )
    return sorted({ids[len(ids) * k // shards] for k in range(1, shards)}) if ids else []


def _record(page_id: int, url: str, payload: bytes, response_id: int, revisit: bool) -> bytes:
    digest = payload_digest(payload)
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        f"WARC-Record-ID: <urn:page:{page_id}>".encode(),
        f"WARC-Date: {DATE}".encode(),
        b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"WARC-Payload-Bytes: {len(payload)}".encode(),
        b"Content-Type: application/http; msgtype=response",
    ]
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    if revisit:
        head += [
            b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{response_id}>".encode(),
        ]
    head += [f"WARC-Block-Digest: sha1:{payload_digest(block)}".encode(), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        attempt = task.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        done, sink, seen, refers, last = [], None, set(), {}, None

        def close() -> None:
            nonlocal sink
            sink.close()
            done[-1] |= {"records": records, "bytes": size, "sha256": total.hexdigest()}
            sink = None

        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "html", "response_id", "shard")]
            for at in range(batch.num_rows):
                page_id, url, html, response_id, shard = (c[at].as_py() for c in columns)
                if page_id is None:
                    raise ValueError("a page without a page_id cannot be written")
                if page_id != last:
                    seen, refers, last = set(), {}, page_id
                if response_id is not None:  # a reference: sorted before the pages of its id
                    refers[url] = response_id
                    continue
                if sink is not None and done[-1]["shard"] != shard:
                    close()
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                target = refers.get(digest, page_id)
                revisit = target != page_id or digest in seen
                seen.add(digest)
                if sink is None:
                    part = sum(d["shard"] == shard for d in done)
                    name = f"pages-{shard:05d}-{part:05d}.warc.gz"
                    temporary = f"_temporary/{name}.{attempt}"
                    store.create_dir(f"{root}/_temporary", recursive=True)
                    sink = store.open_output_stream(f"{root}/{temporary}", compression=None)
                    done.append({"shard": shard, "part": part, "temporary": temporary, "name": name})
                    records, size, total = 0, 0, hashlib.sha256()
                # one gzip member per record: any record can be read by itself
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(_record(page_id, url or "", payload, target, revisit)) + packer.flush()
                sink.write(member)
                total.update(member)
                records, size = records + 1, size + len(member)
                if size >= roll_bytes:
                    close()
        if sink is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, _MANIFEST)

    return write


def _commit(folder: str):
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for temporary, name in zip(batch["temporary"].to_pylist(), batch["name"].to_pylist(), strict=True):
                if store.get_file_info(f"{root}/{temporary}").type == fs.FileType.File:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type != fs.FileType.File:
                    raise FileNotFoundError(f"{folder}/{name}")
            yield batch.select(["name"])

    return rename


def write_archives(
    pages: DataFrame, folder: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES, least_bytes: int = 0
) -> DataFrame:
    """Writes the archives to a new folder every executor reaches; returns the stored manifest. Eager.

    Equal pages and an equal number of shards give equal files. References travel as rows of their own,
    sorted before the page they belong to, so that payloads are shuffled once.
    """
    spark = pages.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(shard_bounds(pages, shards), np.int64)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "right").astype(np.int32))

    rows = pages.select("page_id", "url", "html", F.lit(None).cast("long").alias("response_id"))
    refers = references(pages, least_bytes).select(
        "page_id", F.col("digest").alias("url"), F.lit(None).cast("string").alias("html"), "response_id"
    )
    ordered = (
        rows.unionByName(refers)
        .withColumn("shard", shard_of("page_id"))
        .repartitionById(shards, "shard")
        .sortWithinPartitions("page_id", F.col("response_id").isNull(), "url", "html")
    )
    manifest_path = f"{folder}/manifest"
    ordered.mapInArrow(_writer(folder, roll_bytes), MANIFEST).write.parquet(manifest_path)
    manifest = spark.read.schema(MANIFEST).parquet(manifest_path)
    # the accepted attempts get their names; the job only returns how many
    manifest.repartition(shards, "name").mapInArrow(_commit(folder), "name string").agg(F.count("name")).first()
    delete(spark, f"{folder}/_temporary")
    return manifest


def _members(stream, size: int = 1 << 18) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one at a time."""
    packed = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not packed:
                packed = stream.read(size)
                if not packed:
                    if parts:
                        raise EOFError("an archive ends within a record")
                    return
            parts.append(unpack.decompress(packed))
            packed = unpack.unused_data
        yield b"".join(parts)


def _parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) if b": " in line else (line[:-1], b"") for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    kind = fields[b"WARC-Type"].decode()
    digest, size = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), int(fields[b"WARC-Payload-Bytes"])
    ok = b"sha1:" + payload_digest(block).encode() == fields[b"WARC-Block-Digest"] and rest[len(block) :] == b"\r\n\r\n"
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        ok = ok and payload_digest(payload) == digest and len(payload) == size
        digest, size = payload_digest(payload), len(payload)
    number = lambda name: int(fields[name].decode()[len("<urn:page:") : -1])
    return {
        "page_id": number(b"WARC-Record-ID"), "url": fields[b"WARC-Target-URI"].decode(), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind,
        "refers_to": number(b"WARC-Refers-To") if kind == "revisit" else None, "block_ok": ok,
    }


def _reader(folder: str, rows: int = 2000):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["name"].to_pylist():
                found = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in _members(stream):
                        found.append(_parse(record))
                        if len(found) >= rows:
                            yield pa.RecordBatch.from_pylist(found, _READ)
                            found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, _READ)

    return read


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives the manifest names; digests are taken from the blocks."""
    names = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(tasks, "name").mapInArrow(_reader(folder), READ)


def digest(pages: DataFrame, shards: int | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archives of all pages and reads them back; one row per page."""
    folder = Scratch(pages.sparkSession, "warc").folder
    write_archives(pages, folder, shards, roll_bytes)
    return read_archives(pages.sparkSession, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok"
    )
