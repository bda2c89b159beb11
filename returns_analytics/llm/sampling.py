"""Hash-chosen samples and folds: the same rows on every run, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 30


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded(rows: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows (all of them if there are no more), chosen by the hash of a key."""
    total = rows.count()
    if total <= n:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(_SPACE)) < n * _SPACE // total)


def bounded_per_class(rows: DataFrame, label: str, keys: list[str], n: int, least: int) -> DataFrame:
    """About n rows in the classes' own shares, but ``least`` of every class (all of a smaller one), with their ``weight``.

    Rows are chosen by the hash of their keys. The weight gives a row the share its class has in the table. One count
    per class comes to the driver.
    """
    counts = {row[label]: row["n"] for row in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total <= n:
        return rows.withColumn("weight", F.lit(1.0))
    share = {name: max(n * found / total, min(found, least)) / found for name, found in counts.items()}
    rate = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col(label)]
    drawn = F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(_SPACE)) < rate * _SPACE
    return rows.filter(drawn).withColumn("weight", F.lit(n / total) / rate)
