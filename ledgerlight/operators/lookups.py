"""Lookup-style joins: unique lookups, TOP 1, list filters, scaffold.

No broadcast is forced and no job runs while a plan is built: Spark's byte
threshold and AQE's runtime sizes choose between broadcast and shuffle joins.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def holds_null(values: DataFrame, col: str) -> Column:
    """Whether a one-column list holds a null, as a scalar subquery of the plan."""
    return values.agg(F.coalesce(F.max(F.col(col).isNull()), F.lit(False)).alias("n")).scalar()


def keep_in(df: DataFrame, col: str, values, how: str = "in") -> DataFrame:
    """IN / NOT IN a list.

    ``values`` is a Python list (bounded literal -> ``isin`` / InSet) or a
    one-column DataFrame (semi/anti join).  NOT IN drops null keys, as SQL does.
    """
    c = F.col(col)
    if isinstance(values, DataFrame):
        key = values.columns[0]
        side = values.select(F.col(key).alias("__k")).distinct()
        if how == "in":
            return df.join(side, c == F.col("__k"), "left_semi")
        # NOT IN over a table: a null in the list makes every comparison
        # unknown, so nothing qualifies.
        return (df.filter(c.isNotNull() & ~holds_null(values, key))
                .join(side, c == F.col("__k"), "left_anti"))
    vals = list(values)
    if how == "in":
        return df.filter(c.isin(vals))
    if any(v is None for v in vals):
        return df.limit(0)
    return df.filter(~c.isin(vals))


def unique_lookup(left: DataFrame, left_key: str | Column, dim: DataFrame, dim_key: str,
                  value_cols: Iterable[str], error: str, small: bool = False) -> DataFrame:
    """Left join to a dimension that must be unique on its key.

    Duplicate keys are detected lazily inside the plan: a left row that hits a
    duplicated key raises ``error`` at run time (scalar-subquery semantics),
    without collecting anything to the driver.  Adds ``__matched``.  ``small``:
    the caller stored ``dim`` and found it small, so ``left`` needs no shuffle.
    """
    value_cols = list(value_cols)
    reduced = (dim.filter(F.col(dim_key).isNotNull())
               .groupBy(F.col(dim_key).alias("__lk"))
               .agg(F.count(F.lit(1)).alias("__n"),
                    *[F.min(v).alias(f"__v_{v}") for v in value_cols]))
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    joined = left.join(F.broadcast(reduced) if small else reduced, lk == F.col("__lk"), "left")
    guard = F.when(F.col("__n") > 1, F.raise_error(F.lit(error)))
    out = joined
    for v in value_cols:
        out = out.withColumn(v, F.coalesce(guard.cast(joined.schema[f"__v_{v}"].dataType), F.col(f"__v_{v}")))
    out = out.withColumn("__matched", F.col("__lk").isNotNull())
    return out.drop("__lk", "__n", *[f"__v_{v}" for v in value_cols])


def top1(dim: DataFrame, keys: Sequence[str], value_cols: Sequence[str], prefix: str = "") -> DataFrame:
    """One deterministic row per key (smallest value tuple, nulls first).

    The source's TOP 1 has no ORDER BY; we fix the order so reruns agree.  One
    partial + final aggregate; the result is unique on ``keys``.
    """
    tup = F.struct(*[F.col(v) for v in value_cols])
    agg = dim.groupBy(*keys).agg(F.min(tup).alias("__t"))
    return agg.select(*keys, *[F.col(f"__t.{v}").alias(prefix + v) for v in value_cols])


def scaffold(stores: DataFrame, store_col: str, groups: DataFrame, group_col: str) -> DataFrame:
    """Every store x every group; a store keeps a null group when there are none.

    The output is the product of two dimensions by definition, stated as an
    outer join without a key.
    """
    return stores.select(store_col).join(groups.select(group_col).distinct(), F.lit(True), "left")
