import random

import numpy as np
from helpers_llm import words

from returns_analytics.llm import decontaminate

DOCS = "doc_id long, text string, _lower string, item_id int"


def split(text):
    lines = [x for x in (text or "").split("\n") if x.strip()]
    question, answer = words("\n".join(lines[:-1])), words(lines[-1] if lines else "")
    return (question, answer) if len(question) >= 5 else (question + answer, [])


def brute(docs, items, overlap=0.8):
    parts = {i: split(t) for i, t in items}
    parts = {i: p for i, p in parts.items() if len(p[0]) >= 5}
    step = max(len(q) + len(a) for q, a in parts.values())
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    out = set()
    for d, text in docs:
        w = words(text or "")
        for at in range(0, max(len(w) - step, 1), step) if w else ():
            passage = w[at : at + 2 * step]
            for i, (q, a) in parts.items():
                s = shingles(q)
                if len(s & shingles(passage)) >= overlap * len(s) and len(set(a) & set(passage)) >= overlap * len(set(a)):
                    out.add((d, i))
    return out


def tables(seed):
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(20)]
    text = lambda n: [rng.choice(common) if rng.random() < 0.6 else f"r{rng.randint(0, 300)}" for _ in range(n)]
    items = [(k, " ".join(text(rng.randint(5, 25))) + ("?\n" + " ".join(text(rng.randint(1, 4))) if k % 2 else ".")) for k in range(40)]
    items += [(90, None), (91, ""), (92, "too short"), (93, items[3][1]), (None, items[4][1])]
    docs = [(0, None), (1, ""), (2, "tiny")]
    for d in range(3, 90):
        body = text(rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            item = (rng.choice(items)[1] or "").upper().split()
            for _ in range(rng.randint(0, 3)):
                if item:
                    item[rng.randint(0, len(item) - 1)] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = item
        docs.append((d, " ".join(body)))
    return docs + [docs[10]], items


def test_equals_brute_force(spark):
    for seed, shard in ((1, 1 << 20), (2, 300)):
        docs, items = tables(seed)
        want = brute(docs, [(i, t) for i, t in items if i is not None] + [(None, items[4][1])])
        frame = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(4)
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = decontaminate.find(frame, bench, shard_bytes=shard).collect()
        # shards have passages of their own length; with one shard all pairs are the same
        found = {(r.doc_id, r.item_id) for r in got}
        if shard > 300:
            assert found == want and len(want) > 20
            assert len(got) == len(found) + sum(d == docs[10][0] for d, _ in want)
        else:
            exact = {(d, i) for d, t in docs for i, x in items if len(split(x)[0]) >= 5 and " ".join(words(x)) in " ".join(words(t or ""))}
            assert exact <= found
        kept = decontaminate.keep_clean(frame, bench, shard_bytes=shard)
        assert kept.columns == frame.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in {d for d, _ in found})


def test_no_pruned_item_reaches_its_threshold():
    docs, items = tables(5)
    read = [item for item in (decontaminate.read_item(i or 0, t) for i, t in items) if item]
    df = {}
    for item in read:
        for t in item.terms.tolist():
            df[t] = df.get(t, 0) + 1
    index = decontaminate.Index(read, df, len(read), float(np.mean([i.words for i in read])), 0.8)
    terms = [np.searchsorted(index.terms, x) for x in (np.intersect1d(decontaminate._words(t or ""), index.terms) for _, t in docs)]
    passage = np.repeat(np.arange(len(docs)), [len(t) for t in terms])
    found = index.candidates(passage, np.concatenate(terms), len(docs))
    got = {(int(p), int(i)): s for p, i, s in zip(*found)}
    for p, mine in enumerate(terms):
        for i, item in enumerate(read):
            score = sum(
                index.post_weight[k] for t in mine for k in range(index.post_start[t], index.post_start[t + 1]) if index.post_item[k] == i
            )
            assert ((p, i) in got) == (score >= index.threshold[i])
            if (p, i) in got:
                assert abs(got[p, i] - score) < 1e-9


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find(docs, bench).count() == 0 and decontaminate.keep_clean(docs, bench).count() == 0
    full = spark.createDataFrame([(1, "a b c d e f g", "x", 1)], DOCS)
    assert decontaminate.find(full, none).count() == 0 and decontaminate.keep_clean(full, none).count() == 1
    assert decontaminate.find(full, bench).columns[:2] == ["doc_id", "item_id"]
