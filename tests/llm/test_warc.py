import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from returns_analytics.llm import warc

PAGES = [(i, f"http://x/{i}", f"<p>{i % 7}é</p>" * (1 + i % 5), 1) for i in range(60)] + [
    (100, None, None, 1), (101, "u", "", 1), (102, "a\r\nb", "\r\n\r\nWARC/1.1\r\n\r\n", 1),
    (103, "h", "x" * 300_000, 1), (103, "h", "x" * 300_000, 1), (104, "h", "y", 1), (104, "g", "z", 1)]


def frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string, shard int").repartition(5)


def expected(rows):
    largest = {}
    for page, _, html, _ in rows:
        largest[html or ""] = max(page, largest.get(html or "", page))
    out, seen = [], set()
    for page, _, html, _ in sorted(rows, key=lambda r: r[0]):
        html = html or ""
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        revisit = largest[html] != page or (page, html) in seen
        seen.add((page, html))
        out.append((page, len(html.encode()), digest, "revisit" if revisit else "response", largest[html] if revisit else None, True))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.digest(frame(spark), shards=3, roll_bytes=600).collect()
    assert sorted(map(tuple, got), key=str) == expected(PAGES)


def test_equal_files_whatever_the_partitioning(spark, tmp_path):
    files = []
    for run, pages in enumerate((frame(spark), frame(spark).repartition(2).orderBy("html"))):
        folder = f"file://{tmp_path}/{run}"
        manifest = warc.write_archives(pages, folder, shards=3, roll_bytes=600)
        found = {p.name: p.read_bytes() for p in Path(f"{tmp_path}/{run}").glob("*.warc.gz")}
        assert {r.name: (r.bytes, r.sha256) for r in manifest.collect()} == {
            n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in found.items()}
        assert not Path(f"{tmp_path}/{run}/_temporary").exists()
        files.append(found)
    assert files[0] == files[1] and len(files[0]) > 5
    text = b"".join(gzip.decompress(b) for _, b in sorted(files[0].items()))
    assert text.count(b"WARC/1.1\r\nWARC-Type") == len(PAGES)


def test_a_commit_can_be_repeated(spark, tmp_path):
    folder = f"file://{tmp_path}/again"
    manifest = warc.write_archives(frame(spark), folder, shards=2)
    rename = warc._commit(folder)
    assert sum(b.num_rows for b in rename(iter(manifest.toArrow().to_batches()))) == manifest.count()
    for path in Path(f"{tmp_path}/again").glob("*.warc.gz"):
        path.unlink()
    with pytest.raises(FileNotFoundError):
        list(rename(iter(manifest.toArrow().to_batches())))


def test_least_bytes_and_empty_table(spark, tmp_path):
    rows = [(1, "a", "x", 1), (2, "b", "x", 1), (3, "c", "long" * 9, 1), (4, "d", "long" * 9, 1)]
    folder = f"file://{tmp_path}/least"
    warc.write_archives(frame(spark, rows), folder, shards=2, least_bytes=10)
    assert {r.page_id: r.record_type for r in warc.read_archives(spark, folder).collect()} == {
        1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.digest(frame(spark, [])).count() == 0


def test_missing_page_id_raises(spark):
    with pytest.raises(Exception, match="without a page_id"):
        warc.digest(frame(spark, [(None, "a", "x", 1)]))
