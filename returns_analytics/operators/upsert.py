"""Keyed upserts as joins: the new full state of a table, never an in-place change.

Rows of the source replace the listed columns of the target row with the same key; other columns
keep what they hold. Source rows without a target row are inserted. Both sides must be unique by
key (operators.quality.require_unique), as with any row-level merge.

Only the periods a run touches need to be read and rewritten: pass the target filtered to them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returns_analytics.errors import GateFailed

_MATCH = "_in_source"
_STORED = "_in_target"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert_defaults: Mapping[str, Column] | None = None,
    drop_unmatched: bool = False,
) -> DataFrame:
    """Target after the merge, with the target's columns and types.

    ``update`` lists source columns that win on a match, NULLs included. Columns in
    ``insert_defaults`` are set when a row is inserted and preserved when it is updated.
    ``drop_unmatched`` also removes target rows that the source does not name (stale ones).
    """
    defaults = dict(insert_defaults or {})
    stored = target.withColumn(_STORED, F.lit(True)).alias("t")
    fresh = source.select(*keys, *update).withColumn(_MATCH, F.lit(True)).alias("s")
    on = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]
    merged = stored.join(fresh, on, "right" if drop_unmatched else "full_outer")
    from_source = F.col(f"s.{_MATCH}").isNotNull()
    from_target = F.col(f"t.{_STORED}").isNotNull()

    columns = []
    for field in target.schema.fields:
        name = field.name
        if name in keys:
            value = F.when(from_target, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        elif name in update:
            value = F.when(from_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(from_target, F.col(f"t.{name}")).otherwise(defaults.get(name, F.lit(None)))
        columns.append(value.cast(field.dataType).alias(name))
    return merged.select(*columns)


def update_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Set a group of columns on the target rows the source names; other rows stay as they are."""
    fresh = source.select(*keys, *update).withColumn(_MATCH, F.lit(True)).alias("s")
    stored = target.alias("t")
    on = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]
    columns = []
    for field in target.schema.fields:
        value = F.col(f"t.{field.name}")
        if field.name in update:
            value = F.when(F.col(f"s.{_MATCH}").isNotNull(), F.col(f"s.{field.name}")).otherwise(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return stored.join(fresh, on, "left").select(*columns)


def rows_without_target(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a column-group update that hit no row."""
    return source.select(*keys).join(target.select(*keys), list(keys), "left_anti")


def require_targets(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Stop if an update would hit no row. Runs a one-row action."""
    missing = rows_without_target(target, source, keys).first()
    if missing is not None:
        raise GateFailed(f"no stored row to update for {missing.asDict()}")


def stale_keys(stored: DataFrame, produced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that the run no longer produces."""
    return stored.select(*keys).join(produced.select(*keys), list(keys), "left_anti")


def with_audit(source: DataFrame, run_at: Column, columns: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Stamp the audit columns a merge sets on every row it touches."""
    return source.withColumns({name: run_at.cast(T.TimestampType()) for name in columns})
