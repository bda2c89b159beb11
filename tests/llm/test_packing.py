import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from returns_analytics.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Don't STOP ÀÉ éx", "a\x1cb\x00c <|endoftext|>foo ΑΣ İx ﬁ ½ ² 12３", "'s''t 'RE x'LL \x85\xa0 z", "  ",
         "naïve — “quotes” 東京 🙂🙂 ßẞ", "­ soft", "A" * 300, None, ""]


def test_ids_are_the_tokenizers():
    whole, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    for text in TEXTS:
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text or ""), "<u4").tolist() == want, text


def test_pieces_fill_sequences_without_gaps(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["ab", "cde", "xyzzy", "éa"]) for _ in range(rng.choice([0, 3, 9, 15, 40, 90]))), "x") for i in range(200)]
    rows += [(500 + i, text, "x") for i, text in enumerate(TEXTS)] + [rows[5], rows[5], (None, "ab", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(6)
    got = packing.pack(frame, PATH, size=32).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for i, text, _ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i, k // 32, k, len(ids[k : k + 32]), zlib.crc32(np.array(ids[k : k + 32], "<u4").tobytes())) for k in range(0, len(ids), 32)]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 32
    assert len(sequences) <= 1.02 * sum(r.length for r in got) / 32 + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_combinations_are_the_fullest(seed):
    rng = random.Random(seed)
    left = {n: rng.randint(1, 4) for n in rng.sample(range(1, 40), 8)}
    reach = {0}
    for n, count in left.items():
        for _ in range(count):
            reach |= {s + n for s in reach}
    for room in (0, 1, 17, 50, 99):
        chosen = packing._fullest(room, sorted(left, reverse=True), left)
        assert sum(chosen) == max(s for s in reach if s <= room)
        assert all(chosen.count(n) <= left[n] for n in chosen)


def test_one_length_for_many_pieces():
    plan = packing.minimum_bin_slack({3: 1_000_000, 10: 1}, 10)
    assert plan.sequences == 1 + 333_334 and len(plan.length) <= 4
    assert packing.minimum_bin_slack({}).sequences == 0
