"""Interval joins, the order/detail joins and dimension joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.moments import age_in_years

_CELL, _KEY, _SALT = "_cell", "_key", "_salt"


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower: timedelta,
    upper: timedelta,
    cells_per_span: int = 4,
    salts: int = 1,
) -> DataFrame:
    """Inner join on key with ``right_time`` in ``[left_time + lower, left_time + upper]``.

    Both bounds are inclusive.  Time is cut into cells a few spans wide, and the
    cell is part of the equi-join key: a key with many rows on both sides is
    compared cell by cell, not all against all, and spreads over many tasks.
    A left row is copied to the (at most two) cells its interval touches, a right
    row is in exactly one, so each pair is found once.  Works on streams whose
    time columns carry watermarks.

    ``salts`` spreads a key that is hot on the right side over that many tasks, at
    the price of as many copies of the left side.  In batch AQE does this by itself.
    """
    span = _micros(upper - lower)
    if span < 0:
        raise ValueError("upper bound is below lower bound")
    width = max(span * cells_per_span, 1_000_000)

    def cell(time: Column) -> Column:
        return F.floor(F.unix_micros(time) / width)

    lo = F.lit(lower)
    hi = F.lit(upper)
    lt, rt = F.col(left_time), F.col(right_time)
    first, last = cell(lt + lo), cell(lt + hi)
    cells = F.when(first == last, F.array(first)).otherwise(F.array(first, last))
    left = left.select("*", F.explode(cells).alias(_CELL))
    right = right.select("*", F.col(right_key).alias(_KEY), cell(rt).alias(_CELL + "_r"))
    left = left.select("*", F.col(left_key).alias(_KEY + "_l"))
    left, right, same_salt = salted(left, right, salts)
    matched = left.join(
        right,
        (F.col(_KEY + "_l") == F.col(_KEY))
        & (F.col(_CELL) == F.col(_CELL + "_r"))
        & same_salt
        & (rt >= lt + lo)
        & (rt <= lt + hi),
        "inner",
    )
    return matched.drop(_CELL, _CELL + "_r", _KEY, _KEY + "_l", _SALT, _SALT + "_r")


def salted(left: DataFrame, right: DataFrame, salts: int) -> tuple[DataFrame, DataFrame, Column]:
    """Deal the right rows out to ``salts`` copies of the left; the join condition to add."""
    if salts == 1:
        return left, right, F.lit(True)
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(_SALT))
    dealt = F.pmod(F.xxhash64(*right.columns), F.lit(salts)).cast("int")
    return left, right.withColumn(_SALT + "_r", dealt), F.col(_SALT) == F.col(_SALT + "_r")


def full_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer equi-join that survives a hot key on the right side.

    Spark cannot split a skewed partition of a full outer join.  So: right side
    left-joined to left (splittable), plus the left rows whose key is absent from
    the right side's distinct keys.
    """
    matched = right.join(left, F.col(right_key) == F.col(left_key), "left")
    keys = right.select(F.col(right_key).alias(_KEY)).distinct()
    alone = left.join(keys, F.col(left_key) == F.col(_KEY), "left_anti")
    columns = left.columns + right.columns
    return matched.select(columns).unionByName(alone, allowMissingColumns=True).select(columns)


def join_branch(left_key: str, right_key: str) -> Column:
    """Which side(s) of a full outer join a row has: matched, left_only, right_only."""
    return (
        F.when(F.col(right_key).isNull(), "left_only")
        .when(F.col(left_key).isNull(), "right_only")
        .otherwise("matched")
    )


def sale_details(
    orders: DataFrame,
    details: DataFrame,
    order_time: str | None = None,
    detail_time: str | None = None,
    wait: timedelta | None = None,
    salts: int = 1,
) -> DataFrame:
    """Orders with their details, however far apart they arrive; each pair once.

    On streams name the two watermarked time columns and the longest ``wait``
    between them, which bounds the state, and salt against a hot order.
    """
    times = [F.col(order_time).alias("_ordered")] if order_time else []
    orders = orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"), *times,
    )
    times = [F.col(detail_time).alias("_detailed")] if detail_time else []
    details = details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("_order"), "sku_id", "sku_name",
        F.col("order_price").try_cast("decimal(16,2)").alias("sku_price"), *times,
    )
    same = F.col("_order") == F.col("order_id")
    if wait is not None:
        same = same & within(F.col("_detailed"), F.col("_ordered"), wait)
    orders, details, same_salt = salted(orders, details, salts)
    joined = details.join(orders, same & same_salt, "inner")
    return joined.drop("_order", "_ordered", "_detailed", _SALT, _SALT + "_r")


def within(time: Column, other: Column, wait: timedelta) -> Column:
    """``time`` is at most ``wait`` away from ``other``."""
    span = F.lit(wait)
    return (time >= other - span) & (time <= other + span)


def with_sale_user(sales: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """Left join of the user; an unknown user leaves gender and level null, age 0."""
    users = users.select(
        F.col("id").alias("_user"),
        F.col("gender").alias("user_gender"),
        F.coalesce(age_in_years("birthday", as_of), F.lit(0)).alias("user_age"),
        F.col("user_level").alias("user_level"),
    )
    joined = sales.join(users, F.col("user_id") == F.col("_user"), "left").drop("_user")
    return joined.withColumn("user_age", F.coalesce("user_age", F.lit(0)))


@dataclass(frozen=True)
class DimSpec:
    """How a fact row finds its dimension row and what it takes from it.

    ``table`` names the dimension, ``fact_key`` the fact's column (possibly one an
    earlier spec produced), ``take`` maps output names to dimension columns or
    expressions.  A missing row drops the fact under ``inner``.
    """

    table: str
    fact_key: str
    take: Mapping[str, str | Column] = field(default_factory=dict)
    dim_key: str = "ID"
    how: str = "inner"


def enrich(
    fact: DataFrame, dims: Mapping[str, DataFrame], specs: Sequence[DimSpec], flatten: bool = False
) -> DataFrame:
    """Apply dimension joins in order.

    No broadcast is forced: a dimension is broadcast when its size is below the
    thresholds, and otherwise joined by shuffle, where AQE splits the hot keys of the
    fact side.  ``flatten`` first joins a dimension that is keyed by a column of
    another one to that one (spu, trademark and category to sku): with dimensions
    too large to broadcast the fact is then shuffled once instead of once per hop.
    """
    roots: list[tuple[DimSpec, DataFrame]] = []
    for spec in specs:
        dim = dims[spec.table].select(
            F.col(spec.dim_key).alias(_dim_key(spec)),
            *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in spec.take.items()],
        )
        of = [i for i, (root, d) in enumerate(roots) if spec.fact_key in d.columns and spec.how == root.how]
        if flatten and of:
            root, wider = roots[of[0]]
            roots[of[0]] = root, _lookup(wider, spec, dim)
        else:
            roots.append((spec, dim))
    for spec, dim in roots:
        fact = _lookup(fact, spec, dim)
    return fact


def _dim_key(spec: DimSpec) -> str:
    return f"_{spec.table}_key"


def _lookup(rows: DataFrame, spec: DimSpec, dim: DataFrame) -> DataFrame:
    key, wanted = _dim_key(spec), F.col(spec.fact_key)
    # Dimension rows are text; a number is looked up by its text, so that an odd key
    # in the dimension matches nothing instead of failing the cast.
    if isinstance(dim.schema[key].dataType, T.StringType):
        wanted = wanted.cast("string")
    return rows.join(dim, wanted == F.col(key), spec.how).drop(key)


def order_dims(as_of: str | Column, how: str = "inner") -> list[DimSpec]:
    """The wide order's six dimensions; spu, trademark and category follow the sku."""
    return [
        DimSpec("user", "user_id", {"user_age": age_in_years("BIRTHDAY", as_of), "user_gender": "GENDER"}, how=how),
        DimSpec(
            "province", "province_id",
            {
                "province_name": "NAME", "province_area_code": "AREA_CODE",
                "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2",
            },
            how=how,
        ),
        DimSpec("sku", "sku_id", {"spu_id": "SPU_ID", "tm_id": "TM_ID", "category3_id": "CATEGORY3_ID"}, how=how),
        *product_hops(how),
    ]


def product_hops(how: str = "inner") -> list[DimSpec]:
    return [
        DimSpec("spu", "spu_id", {"spu_name": "SPU_NAME"}, how=how),
        DimSpec("trademark", "tm_id", {"tm_name": "TM_NAME"}, how=how),
        DimSpec("category3", "category3_id", {"category3_name": "NAME"}, how=how),
    ]


def product_dims(how: str = "inner") -> list[DimSpec]:
    """Product statistics' dimensions: the sku with price and name, then its hops."""
    sku = {
        "sku_name": "SKU_NAME", "sku_price": F.col("PRICE").try_cast("decimal(16,2)"),
        "spu_id": "SPU_ID", "tm_id": "TM_ID", "category3_id": "CATEGORY3_ID",
    }
    return [DimSpec("sku", "sku_id", sku, how=how), *product_hops(how)]
