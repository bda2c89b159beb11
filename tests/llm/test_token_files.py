import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from returns_analytics.llm import token_files  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Don't STOP ÀÉ éx", "a\x1cb\x00c <|endoftext|>foo ΑΣ İx ﬁ ½ ² 12３ ", "'s''t 'RE x'LL \x85\xa0 z", "  ", " \n \n", " a", "x \n y", "\n",
         "naïve — “quotes” 東京 🙂🙂 ßẞ", "­ soft", "A" * 300, "tab\tnext  two   three  em　 wide ", "a\x1c b \x1f", None, "",
         "don't we'll I'm 42 x² ½-3", "end ", "<|endoftext|>", "a <|endoftext|> b<|endo"]


def ids_of(text, whole=[]):  # noqa: B006
    if not whole:
        whole.append(Tokenizer.from_file(PATH))
    return whole[0].encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers():
    own, rng = token_files.ByteTokenizer(PATH), random.Random(4)
    assert own.by_parts and token_files.width_of(own.vocabulary) == 16
    letters = "ab cZ 9.\n'é\t<|ë½\x85\xa0　—s,àĀ\u2028\u1680ꠀ\x1f\x7f東"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in texts[:500]:
        assert own.encode(text).tolist() == ids_of(text), repr(text)
    at = 0
    for ids, counts in own.encode_rows(pa.array([*texts, None], pa.string())):
        for row, end in zip(range(at, at + len(counts)), np.cumsum(counts)):
            assert ids[end - counts[row - at] : end].tolist() == ids_of(texts[row] if row < len(texts) else ""), row
        at += len(counts)
    assert at == len(texts) + 1


def test_files_of_another_kind_go_through_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, whole = token_files.ByteTokenizer(path), Tokenizer.from_file(path)
    assert not own.by_parts
    for text in TEXTS:
        assert own.encode(text or "").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_lookups_keep_frequent_keys():
    calls = []
    kept = token_files._Kept(lambda k: calls.append(k) or k, 3)
    for k in ["a", "b", "a", "c", "d", "a", "e", "a", "f", "g", "a"]:
        assert kept[k] == k
    assert calls == ["a", "b", "c", "d", "e", "f", "g"] and len(kept) <= 3


@pytest.mark.parametrize("bits", range(1, 33))
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = token_files.pack_bits(ids, bits)
        assert len(data) == (n * bits + 7) // 8
        assert (token_files.unpack_bits(data, n, bits) == ids).all()
    with pytest.raises(ValueError, match="bits"):
        token_files.pack_bits(np.array([1 << bits], np.uint64), bits)


def test_one_file_at_random():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 30_000, n) for n in (0, 1, 5, 16, 100, 3, 64, 0)]
    sink = io.BytesIO()
    sink.close = lambda: None
    file = token_files._File(sink, 15, 16)
    for k, ids in enumerate(docs):
        file.add(None if k == 2 else -k, ids)
    data = sink.getvalue() if file.close() is None else sink.getvalue()

    class Source(io.BytesIO):
        size = lambda self: len(data)

    read, flat = token_files.PackedFile(Source(data)), np.concatenate(docs)
    assert read.n_ids == len(flat) and read.known.tolist() == [1, 1, 0, 1, 1, 1, 1, 1]
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(flat) + 3, 2))
        assert read.ids(a, b).tolist() == flat[a:b].tolist()
    assert [read.document(k).tolist() for k in range(len(docs))] == [d.tolist() for d in docs]
    assert np.concatenate([ids for _, ids in read.runs(32)]).tolist() == flat.tolist()
    broken = bytearray(data)
    broken[20] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_files.PackedFile(Source(bytes(broken))).ids(0, 100)


@pytest.mark.parametrize("options", [{}, {"shards": 1}, {"shards": 7, "block": 8, "roll_bytes": 100, "roll_documents": 9}])
def test_files_hold_all_documents_in_order(spark, tmp_path, options):
    rng = random.Random(3)
    rows = [(i * 3 - 50, " ".join(rng.choice(["ab", "cde", "xyzzy", "éa"]) for _ in range(rng.choice([0, 3, 40, 400]))), "x", 1) for i in range(150)]
    rows += [(500 + i, text, "x", 1) for i, text in enumerate(TEXTS)] + [rows[5], rows[5], (None, "ab", "x", 1), (9, "long word " * 20_000, "x", 1)]
    rows += [(42, f"hot {k % 30}", "y", 2) for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, n int").repartition(6)
    folder = f"file://{tmp_path}/out"
    files = token_files.write(frame, folder, PATH, **options)
    encoded = [(d, [*ids_of(t), 2]) for d, t, *_ in rows]
    assert files.agg({"ids": "sum"}).first()[0] == sum(len(i) for _, i in encoded)
    got = sorted(token_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert [r.doc_id for r in got] == [d for d, _ in sorted(encoded, key=order)]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(d), i) for d, i in encoded)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = sorted((str(r.doc_id), r.start, len(r.ids), crc(r.ids)) for r in got)
    assert sorted((str(r.doc_id), *r[1:]) for r in token_files.read_digests(spark, folder).collect()) == want
    if "roll_documents" in options:
        assert files.agg({"documents": "max"}).first()[0] <= 9
        assert files.filter("shard = 3").count() > 1


def test_long_documents_are_read_in_runs(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(3000))
    frame = spark.createDataFrame([(1, text), (2, "x"), (3, text)], "doc_id long, text string")
    monkeypatch.setattr(token_files, "_RUN", 64)
    ids = [*ids_of(text), 2]
    rows = token_files.digest(frame, PATH, block=16, shards=1).orderBy("doc_id").collect()
    crc = zlib.crc32(np.array(ids, "<u4").tobytes())
    assert [(r.start, r.n_tokens) for r in rows] == [(0, len(ids)), (len(ids), 2), (len(ids) + 2, len(ids))]
    assert rows[0].ids_crc32 == rows[2].ids_crc32 == crc


def test_a_frequent_id_is_dealt_over_shards(spark):
    frame = spark.createDataFrame([(5, f"text {k}") for k in range(200)] + [(k, "a") for k in range(10)], "doc_id long, text string")
    bounds = token_files.shard_bounds(frame, 8)
    assert (bounds == 5).sum() >= 6
    files = token_files.write(frame, f"{token_files.Scratch(spark, 'test').folder}", PATH, shards=8)
    assert files.agg({"documents": "max"}).first()[0] < 80


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.digest(empty, PATH).count() == 0


def test_query_equals_brute_force(spark):
    from returns_analytics.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, at = [], 0
    for doc_id, text in sorted(map(tuple, docs)):
        ids = [*ids_of(text), 2]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, queries.op12_token_id_output(spark, "/root/testdata/sf0.001").collect())) == want
