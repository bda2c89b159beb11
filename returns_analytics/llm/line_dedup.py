"""Line dedup: later copies of repeated runs of lines are deleted.

The documents are sequences of line ids. Distributed prefix doubling sorts their suffixes: the rank of a
suffix by its first 2^(k+1) lines is the rank of the pair of its ranks by 2^k lines, here and 2^k lines
on. Pairs are counted, those that occur once are dropped (nothing longer can repeat there), the others
are range-sorted and numbered, so that ranks keep the order of the suffixes. The suffixes that share their
first m lines are an interval of that order with longest common prefix m at least, and they share the
ranks of the two overlapping powers of two that cover m lines.

A run counts if it holds ``min_words`` words or more. Whatever such a run repeats is covered by windows
just long enough for that many words, one beginning at each line and one ending at each line; so the
doubling stops at the longest such window, and deleting every window that lies in an interval with an
earlier member deletes the later copies of all maximal repeated runs and nothing else. Earlier means: in the
order of doc_id, then of the text's hash, then of the line.

Defined results: lines are cut at line feeds and compared as they are; lines without words are never
compared and go if the lines around them go; null and empty texts stay; rows that agree in doc_id and text
have the same outcome; a null doc_id sorts first; copies may overlap, the first one stays; an empty
table gives an empty table; extra columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.llm.storage import Scratch, free_name

#: Words a repeated run holds at least.
MIN_WORDS = 50
_NO_ID = -(1 << 63)
_AT = ["doc", "text_hash"]


def _key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("text_hash")]


def _lines(documents: DataFrame) -> DataFrame:
    """doc, text_hash, at, a, b, words: one row per line that holds words; (a, b) stands for the line."""
    texts = documents.select("doc_id", "text").filter("text is not null")
    lines = texts.select(*_key(), F.posexplode(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S"))).alias("at", "line"))
    return lines.select(
        *_AT, "at", F.xxhash64("line").alias("a"), F.hash("line").cast("long").alias("b"),
        F.regexp_count("line", F.lit(r"\S+")).alias("words"),
    )


def _ranks(pairs: DataFrame, scratch: Scratch, tasks: int) -> DataFrame:
    """a, b, rank of the pairs that occur twice or more; ranks ascend with (a, b)."""
    repeated = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # ids that ascend over range-sorted partitions; stored, as they are given anew each time otherwise
    return scratch.store(
        repeated.repartitionByRange(tasks, "a", "b").sortWithinPartitions("a", "b")
        .withColumn("rank", F.monotonically_increasing_id())
    )


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """doc, text_hash, start, m: for each line the shortest runs of ``min_words`` from it and up to it."""
    run = Window.partitionBy(*_AT, "run")
    summed = (
        lines.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy(*_AT).orderBy("at")))
        .withColumn("upto", F.sum("words").over(run.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    ahead = run.orderBy("before").rangeBetween(0, min_words - 1)
    back = run.orderBy("upto").rangeBetween(1 - min_words, 0)
    measured = summed.select(
        *_AT, "at", "before", "upto",
        F.count(F.lit(1)).over(ahead).alias("ahead"), F.max("upto").over(ahead).alias("last"),
        F.count(F.lit(1)).over(back).alias("back"), F.min("before").over(back).alias("first"),
    )
    both = F.array(
        F.when(F.col("last") - F.col("before") >= min_words, F.struct(F.col("at").alias("start"), F.col("ahead").alias("m"))),
        F.when(
            F.col("upto") - F.col("first") >= min_words,
            F.struct((F.col("at") - F.col("back") + 1).cast("int").alias("start"), F.col("back").alias("m")),
        ),
    )
    return measured.select(*_AT, F.explode(F.array_compact(both)).alias("w")).select(*_AT, "w.start", "w.m").distinct()


def repeated_runs(documents: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, text_hash, runs: the first and last line (of those with words) of the runs to delete."""
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = scratch.store(_lines(documents))
    rank = _ranks(lines, scratch, tasks)
    # what is left: lines that occur again, each position once
    named = scratch.store(lines.join(rank, ["a", "b"]).select(*_AT, "at", "words", "rank").distinct())
    scratch.drop(lines)
    windows = scratch.store(_windows(named, min_words).withColumn("k", F.floor(F.log2("m")).cast("int")))
    deepest = windows.agg(F.max("k")).first()[0] or 0
    level = named.select(*_AT, "at", "rank")
    levels = [level.withColumn("k", F.lit(0))]
    for k in range(deepest):
        on = level.select(*_AT, (F.col("at") - (1 << k)).cast("int").alias("at"), F.col("rank").alias("b"))
        pairs = scratch.store(level.withColumnRenamed("rank", "a").join(on, [*_AT, "at"]))
        level = scratch.store(pairs.join(_ranks(pairs, scratch, tasks), ["a", "b"]).select(*_AT, "at", "rank"))
        scratch.drop(pairs)
        levels.append(level.withColumn("k", F.lit(k + 1)))
    ranks = levels[0]
    for more in levels[1:]:
        ranks = ranks.unionByName(more)
    end = F.col("start") + F.col("m") - F.expr("shiftleft(1, k)")
    classed = scratch.store(
        windows.withColumn("at", F.col("start").cast("int")).join(ranks.withColumnRenamed("rank", "x"), [*_AT, "k", "at"])
        .withColumn("at", end.cast("int"))
        .join(ranks.withColumnRenamed("rank", "y"), [*_AT, "k", "at"])
        .select(*_AT, "start", "m", "x", "y")
    )
    place = F.struct(*_AT, "start")
    earliest = classed.groupBy("m", "x", "y").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = classed.join(earliest, ["m", "x", "y"]).filter(place > F.col("kept"))
    # windows that touch are one run
    order = Window.partitionBy(*_AT).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        later.select(*_AT, "start", (F.col("start") + F.col("m") - 1).alias("end"))
        .withColumn("new", F.coalesce(F.col("start") > reached + 1, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .groupBy(*_AT, "run")
        .agg(F.min("start").cast("int").alias("start"), F.max("end").cast("int").alias("end"))
    )
    return runs.groupBy(*_AT).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def cut(text: str, runs: list[dict]) -> tuple[str, int, int]:
    """The text without its runs, and the lines before and after; runs count lines that hold words."""
    lines = text.split("\n")
    drop = {n for run in runs for n in range(run["start"], run["end"] + 1)}
    kept, number, pending, gone = [], 0, [], False
    for line in lines:
        if not line.strip(" \t\n\x0b\f\r"):
            pending.append(line)  # goes if both lines around it go
            continue
        goes = number in drop
        if not (gone and goes):
            kept += pending
        pending, gone = [], goes
        if not goes:
            kept.append(line)
        number += 1
    kept += pending
    return "\n".join(kept), len(lines), len(kept)


def _with_runs(documents: DataFrame, columns: list[str], min_words: int) -> DataFrame:
    """Columns of the documents and, last, the runs to delete."""
    runs = repeated_runs(documents, Scratch(documents.sparkSession, "lines"), min_words)
    doc, text_hash = _key()
    condition = (doc == runs["doc"]) & (text_hash == runs["text_hash"])
    joined = documents.join(runs, condition, "left")
    return joined.select(*[documents[c] for c in columns], runs["runs"].alias(free_name("runs", columns)))


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS, drop_empty: bool = True) -> DataFrame:
    """The documents without later copies; all columns. Documents that lose all their lines go, if asked."""
    at = documents.columns.index("text")
    joined = _with_runs(documents, documents.columns, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(batch.num_columns - 1)
            batch = batch.select(list(range(batch.num_columns - 1)))
            changed = [i for i, valid in enumerate(runs.is_valid().to_pylist()) if valid]
            if changed:
                texts, keep = batch.column(at).to_pylist(), [True] * batch.num_rows
                for i in changed:
                    texts[i], _, _ = cut(texts[i], runs[i].as_py())
                    keep[i] = not drop_empty or bool(texts[i].strip())
                columns = batch.columns
                columns[at] = pa.array(texts, columns[at].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))
            yield batch

    return joined.mapInArrow(run, documents.schema)


def digest(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs and the kept text's SHA-256 of every document row."""
    import hashlib

    joined = _with_runs(documents, ["doc_id", "text"], min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts, runs = batch["text"], batch["runs"]
            for i in range(batch.num_rows):
                text, found = texts[i].as_py(), runs[i].as_py() or []
                if text is None:
                    out.append((0, 0, 0, hashlib.sha256(b"").hexdigest()))
                    continue
                kept, before, after = cut(text, found) if found else (text, text.count("\n") + 1, text.count("\n") + 1)
                out.append((before, before - after, len(found), hashlib.sha256(kept.encode()).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_removed long, n_runs long, kept_sha256 string")
