"""Current state: latest row per key and key-based upsert.

``latest_per_key`` is a hash aggregate (``max_by`` over an ordering
struct), not a window: the partial aggregate keeps one row per key per map
task before the shuffle, so a key holding a third of all rows costs no more
shuffle than any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# an ordering term: (column name or Column, direction) with direction one of
# desc_nulls_last, desc_nulls_first
Order = list[tuple[object, str]]


def _c(x) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def ordering_struct(order: Order) -> Column:
    """A struct whose natural (ascending) order is the requested order, so
    ``max_by(payload, struct)`` picks the first row of that order.

    Struct comparison puts NULL lowest; NULLS FIRST on a descending term
    is obtained by a leading is-NULL flag."""
    parts = []
    for i, (term, direction) in enumerate(order):
        c = _c(term)
        if direction == "desc_nulls_last":
            parts.append(c.alias(f"o{i}"))
        elif direction == "desc_nulls_first":
            parts.append(c.isNull().alias(f"n{i}"))
            parts.append(c.alias(f"o{i}"))
        else:
            raise ValueError(f"unsupported direction {direction}")
    return F.struct(*parts)


def latest_per_key(df: DataFrame, keys: list[str], order: Order,
                   drop_null_keys: bool = True, dealt: bool = False) -> DataFrame:
    """One row per key: the first by ``order``.  Rows with a NULL key are
    dropped (the merges require a key).

    ``dealt``: a key's rows already lie in one task, so there is nothing to
    reduce before a shuffle; wide rows are then sorted once and the first of
    each key kept, where the aggregate would copy a row per comparison."""
    if drop_null_keys:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        df = df.filter(cond)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    if dealt:
        first = Window.partitionBy(*keys).orderBy(ordering_struct(order).desc())
        return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").select(*df.columns)
    best = F.max_by(F.struct(*payload), ordering_struct(order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload]) \
             .select(*df.columns)


def merge_latest(target: DataFrame, batch: DataFrame, keys: list[str], order: Order,
                 guard: bool = False, reduced: bool = False) -> DataFrame:
    """MERGE on key.  The batch is first reduced to its latest row per key
    (unless it is ``reduced``); matched keys take the batch row, unmatched
    batch rows are inserted.  A column that only one side has is kept and
    NULL in the other's rows.

    ``guard=False`` is the warehouse behaviour: a late batch with older data
    overwrites newer rows.  ``guard=True`` keeps whichever row is later by
    ``order``."""
    src = batch if reduced else latest_per_key(batch, keys, order)
    if guard:
        return latest_per_key(target.unionByName(src, allowMissingColumns=True), keys, order)
    return target.join(src.select(*keys), keys, "left_anti").unionByName(src, allowMissingColumns=True)


def merge_rows(target: DataFrame, batch: DataFrame, keys: list[str] | None, order: Order) -> DataFrame:
    """Keyed tables upsert, key-less tables append."""
    if not keys:
        return target.unionByName(batch, allowMissingColumns=True)
    return merge_latest(target, batch, keys, order)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate row sets by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys (or whole rows) seen more than once, with their count.
    Nested values are compared as JSON text."""
    cols = keys or df.columns
    exprs = []
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        if dt.startswith(("struct", "array", "map", "variant")):
            exprs.append(F.to_json(F.col(c)).alias(c))
        else:
            exprs.append(F.col(c))
    return (df.select(*exprs).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def drop_duplicate_keys(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Keep one row per key by ``order`` (the reference drops every copy
    of a duplicated single-column key, losing data; we keep the latest)."""
    return latest_per_key(df, keys, order, drop_null_keys=False)


def column_set_diff(left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """(only in left, only in right)."""
    return sorted(set(left) - set(right)), sorted(set(right) - set(left))
