"""Joins. Key null rules follow the input: raw tables match null to null
(``null_safe``); aggregated tables have no null keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.aggregates import aggregate


def _renamed(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias(alias), *[F.col(f"`{c}`") for c in df.columns if c != key])


def attach_metric(spine: DataFrame, metric: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Add a metric frame to a spine. Spine rows without a match stay null,
    and a metric key that occurs twice repeats its spine row. ``how='outer'``
    also keeps metric rows the spine lacks."""
    if how == "left":
        return spine.join(metric, key, "left")
    return outer_join_nullsafe(spine, metric, key)


def attach_rows(table: DataFrame, rows: DataFrame, table_key: str, rows_key: str) -> DataFrame:
    """Left join of a table with rows of which each repeats all table rows of
    its key; null keys match nothing. Keys are few and the output many times
    the input, so tasks take equal shares of the rows, whatever their key, and
    a table under the broadcast threshold comes to them. ``table`` is read
    twice: give it written. A left join led by it would make all rows of one
    key in one task.
    """
    right = _renamed(rows, rows_key, "_rkey").where(F.col("_rkey").isNotNull())
    same = F.col(table_key) == F.col("_rkey")
    shares = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matched = table.join(right.repartition(shares), same, "inner").drop("_rkey")
    alone = table.join(right.select("_rkey").distinct(), same, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


# A key with so many rows on one side is split from the others, the heaviest MOST_HOT of them.
HOT_ROWS, MOST_HOT = 500_000, 200


@dataclass(frozen=True)
class Side:
    """Rows of one key class. ``held``: the hot keys that occur in them, or None
    for the rows of all other keys."""

    df: DataFrame
    held: frozenset | None = None


def _is_one_of(key: str, values: frozenset) -> Column:
    listed = [v for v in values if v is not None]
    hit = F.coalesce(F.col(f"`{key}`").isin(*listed), F.lit(False)) if listed else F.lit(False)
    return hit | F.col(f"`{key}`").isNull() if None in values else hit


def by_key_class(frames: list[DataFrame], key: str, combine: Callable[[list[Side]], Side], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``combine`` of the frames' light rows and of their hot rows, united.

    A key is hot if ``hot_rows`` rows of one frame have it; null counts as any
    other. One aggregation over all frames finds the hot keys and which frames
    have them, and at most MOST_HOT, the heaviest, are fetched. The split
    changes the plan, not the rows, so a hot key beyond those is only slower.
    """
    tagged = [f.select(F.col(f"`{key}`").alias("k"), F.lit(i).alias("i")) for i, f in enumerate(frames)]
    sizes = [F.count_if(F.col("i") == i).alias(f"n{i}") for i in range(len(frames))]
    counts = reduce(DataFrame.union, tagged).groupBy("k").agg(*sizes)
    most = F.greatest(*[f"n{i}" for i in range(len(frames))]) if len(frames) > 1 else F.col("n0")
    hot = counts.where(most >= hot_rows).orderBy(most.desc(), "k").limit(MOST_HOT).collect()
    if not hot:
        return combine([Side(f) for f in frames]).df
    keys = frozenset(r["k"] for r in hot)
    light = combine([Side(f.where(~_is_one_of(key, keys))) for f in frames])
    held = [frozenset(r["k"] for r in hot if r[f"n{i}"]) for i in range(len(frames))]
    heavy = combine([Side(f.where(_is_one_of(key, keys)), h) for f, h in zip(frames, held)])
    return light.df.unionByName(heavy.df)


def outer(left: Side, right: Side, key: str) -> Side:
    """Full outer join of two sides, null keys matching each other.

    A full outer join cannot split a hot key between tasks; an inner join can.
    Hot keys that both sides hold go through one. Which keys only one side
    holds is known, so its rows are a filter, not an anti join.
    """
    r = _renamed(right.df, key, "_rkey")
    same = F.col(key).eqNullSafe(F.col("_rkey"))
    if left.held is None or right.held is None:
        joined = left.df.join(r, same, "full_outer")
        return Side(joined.withColumn(key, F.coalesce(F.col(key), F.col("_rkey"))).drop("_rkey"))
    parts = []
    if left.held & right.held:
        parts.append(left.df.join(r, same, "inner").drop("_rkey"))
    if left.held - right.held:
        parts.append(left.df.where(_is_one_of(key, left.held - right.held)))
    if right.held - left.held:
        parts.append(right.df.where(_is_one_of(key, right.held - left.held)))
    if not parts:
        return Side(left.df.join(r, same, "inner").drop("_rkey"), frozenset())
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for s in (left, right) for f in s.df.schema if f.name not in parts[0].columns]
    first = parts[0].select("*", *missing)
    return Side(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts[1:], first), left.held | right.held)


def outer_join_nullsafe(left: DataFrame, right: DataFrame, key: str, *, skewed: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer join in which null keys match each other. With ``skewed``,
    for raw sides, hot keys are counted first and joined apart from the rest
    (see :func:`by_key_class`); sides that are grouped by key have none."""
    if not skewed:
        return outer(Side(left), Side(right), key).df
    return by_key_class([left, right], key, lambda sides: outer(*sides, key), hot_rows)


def enrich(fact: DataFrame, dim: DataFrame, left_key: str, right_key: str, *, null_safe: bool = True) -> DataFrame:
    """Left join on keys of different names; both key columns stay unless
    they share a name. Dimension columns the fact already has are not taken.

    A hot key is on the left side, whose rows adaptive execution can split.
    """
    taken = [c for c in dim.columns if c != right_key and c not in fact.columns]
    d = dim.select(F.col(right_key).alias("_rkey"), *taken)
    on = F.col(left_key).eqNullSafe(F.col("_rkey")) if null_safe else F.col(left_key) == F.col("_rkey")
    out = fact.join(d, on, "left")
    if right_key == left_key or right_key in fact.columns:
        return out.drop("_rkey")
    return out.withColumnRenamed("_rkey", right_key)


def enrich_lookup(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """All lookup rows with their facts; a row without facts stays, with nulls.

    A left join led by the lookup could neither broadcast it nor split a hot
    fact key, so matches come from an inner join, which can do both, and the
    rest from an anti join against the distinct fact keys.
    """
    f = _renamed(fact, fact_key, "_fkey")
    f = f.select("_fkey", *[c for c in f.columns if c != "_fkey" and c not in dim.columns])
    matched = dim.join(f, F.col(dim_key).eqNullSafe(F.col("_fkey")), "inner").drop("_fkey")
    keys = fact.select(F.col(fact_key).alias(dim_key)).distinct()
    return matched.unionByName(anti_join(dim, keys, dim_key), allowMissingColumns=True)


def anti_join(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks. A null key counts as any other."""
    keys = b.select(F.col(on).alias("_bkey"))
    return a.join(keys, F.col(on).eqNullSafe(F.col("_bkey")), "left_anti")


def unmatched_keys(fact: DataFrame, spine: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the fact that the spine lacks."""
    return anti_join(fact.select(key).distinct(), spine, key)


def audit_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def attach_location(positions: DataFrame, locations: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of two files on their shared id, reduced to ``columns``.
    A name in both files means the one in ``positions``."""
    return enrich(positions, locations, key, key).select(*columns)


def bridge_first(fact: DataFrame, bridge: DataFrame, name: str, city: str, order: list[str]) -> DataFrame:
    """Add each name's first non-null city, without repeating fact rows."""
    firsts = aggregate(bridge, [name], {city: (city, "first")}, order=order)
    return fact.join(firsts, name, "left")
