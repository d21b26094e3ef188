"""Keyed merges: frames in, merged frame out, for batches and for ``foreachBatch`` alike.

Every merge is two parts: the target left-joined to the updates, and the updates the target lacks.
Neither part needs a full outer join, so when the updates are small enough for Spark's own size
check they are broadcast and the target is never shuffled. Applying a merge twice changes nothing.

Updates must hold one row per key; use ``latest.keep_last`` on feeds that repeat keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "_hit"

# (matched, stored value, new value) -> merged value
Rule = Callable[[Column, Column, Column], Column]


def overwrite(hit: Column, stored: Column, new: Column) -> Column:
    """The update wins, NULL included."""
    return F.when(hit, new).otherwise(stored)


def protect(hit: Column, stored: Column, new: Column) -> Column:
    """The update wins unless it is NULL."""
    return F.coalesce(new, stored)


def fill(hit: Column, stored: Column, new: Column) -> Column:
    """Only a NULL is written."""
    return F.coalesce(stored, new)


def _matched(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, Rule]
) -> DataFrame:
    renamed = updates.select(
        *keys, F.lit(True).alias(_HIT), *(F.col(c).alias(f"_new_{c}") for c in rules)
    )
    joined = target.join(renamed, list(keys), "left")
    hit = F.coalesce(F.col(_HIT), F.lit(False))
    return joined.select(
        *(
            rules[c](hit, F.col(c), F.col(f"_new_{c}")).cast(target.schema[c].dataType).alias(c)
            if c in rules
            else F.col(c)
            for c in target.columns
        )
    )


def new_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates whose key the target lacks.

    The target side reads key columns only, cut down to keys that occur in the updates first.
    """
    wanted = updates.select(*keys)
    present = target.select(*keys).join(wanted, list(keys), "left_semi")
    return updates.join(present, list(keys), "left_anti")


def _appended(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` in the shape of the target; columns they lack are NULL."""
    return rows.select(
        *(
            (F.col(c) if c in rows.columns else F.lit(None)).cast(field.dataType).alias(c)
            for c, field in zip(target.columns, target.schema.fields)
        )
    )


def insert_if_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows stay as they are."""
    return target.unionByName(_appended(target, new_rows(target, updates, keys), keys))


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    rule: Rule = overwrite,
) -> DataFrame:
    """Update the named columns (all the updates carry, by default) and add new keys."""
    named = columns if columns is not None else [c for c in updates.columns if c not in keys]
    rules = {c: rule for c in named if c in target.columns}
    fresh = _appended(target, new_rows(target, updates, keys), keys)
    return _matched(target, updates, keys, rules).unionByName(fresh)


def update_from(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    rule: Rule = overwrite,
) -> DataFrame:
    """Update matching rows; keys the target lacks are ignored."""
    return _matched(target, updates, keys, {c: rule for c in columns})


def patch_group(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite all named columns of a row if the update knows any of them."""
    known = updates.where(F.coalesce(*(F.col(c).cast("string") for c in columns)).isNotNull())
    return update_from(target, known, keys, columns)


def replace_by(target: DataFrame, fresh: DataFrame, by: Sequence[str]) -> DataFrame:
    """Drop every target row of a group that occurs in ``fresh`` and add the fresh rows."""
    groups = fresh.select(*by).distinct()
    kept = target.join(groups, list(by), "left_anti")
    return kept.unionByName(_appended(target, fresh, by))


def delete_keys(target: DataFrame, keys_frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_frame.select(*keys), list(keys), "left_anti")


def with_parent(updates: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only updates whose key exists in the parent table, so that no orphan is written."""
    return updates.join(parent.select(*keys), list(keys), "left_semi")


def merge_sources(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key; each column from the first feed, in order, that knows it."""
    names: list[str] = []
    for feed in feeds:
        names += [c for c in feed.columns if c not in names and c not in keys]
    stacked = None
    for priority, feed in enumerate(feeds):
        ranked = feed.withColumn("_priority", F.lit(priority))
        if stacked is None:
            stacked = ranked
        else:
            stacked = stacked.unionByName(ranked, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(
        *(
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_priority"))).alias(c)
            for c in names
        )
    )
