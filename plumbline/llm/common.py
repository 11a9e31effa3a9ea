"""Helpers the operators share: written tables, components, row numbers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import scratch_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage and survives lost executors, and what reads it twice does
    not compute it twice.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: str | Column = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


# White space beside a blank or at an end.
_NO_CUT = re.compile(r"\s | \s|\A\s|\s\Z")


def stretches(text: str) -> list[str]:
    """The text cut in front of every blank between two characters that are not
    white space; all but the first stretch without that blank."""
    parts = text.split(" ")
    if not text or not _NO_CUT.search(text):
        return parts
    out, held = [], parts[0]
    for part in parts[1:]:
        if held and part and not held[-1].isspace() and not part[0].isspace():
            out.append(held)
            held = part
        else:
            held = f"{held} {part}"
    return [*out, held]


def power_of_two(least: float, low: int, high: int = 1 << 20) -> int:
    """Smallest power of two that is at least ``least``, within bounds."""
    n = low
    while n < least and n < high:
        n *= 2
    return n


def connected_components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (src, dst), component being
    the smallest id reachable.

    Alternates the large-star and small-star steps, which take a number of
    rounds near the logarithm of the longest path. Minimum per vertex is a
    partial aggregate and the join back is one row per vertex on one side, so
    a hub is combined in the map tasks and split by adaptive execution. Each
    round is a written table. Nothing is gathered in one place.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = e.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        out = e.join(least, "src")
        if large:
            out = out.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        else:
            out = out.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(
                least.select("src", F.col("low").alias("dst"))
            )
        return out.where("src > dst").distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = saved(down.where("src > dst").distinct(), name)
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        now = saved(star(star(now, True), False), name)
        new = state(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return now.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
        now.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    )


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_KEPT: dict[str, Callable[[], None]] = {}


def per_worker(make: Callable) -> Callable:
    """Keep what ``make`` returns (for the last two sets of arguments) in a
    Python worker, until that works for another operator (:func:`taken_by`)."""
    kept = lru_cache(maxsize=2)(make)
    _KEPT[make.__module__] = kept.cache_clear
    return kept


def taken_by(operator: str) -> None:
    """Drop what a reused Python worker keeps for operators (modules) but this one."""
    for name, clear in _KEPT.items():
        if name != operator:
            clear()
    give_back()


def give_back() -> None:
    """Return what this process has freed to the system; Arrow's pool and the
    allocator hold on to it otherwise."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


TEXTS = 500

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def per_text(
    docs: DataFrame, keep: list[str], fields: dict[str, str], start: Callable[[], Callable[[list[str]], list]], text: str = "text"
) -> DataFrame:
    """The columns ``keep`` and new ``fields`` (name: type) worked out from
    each whole text.

    ``start()`` runs once per task and returns a function from a list of texts
    (null as empty) to one list of values per field. Kept columns pass through
    untouched, whatever their types and nulls.
    """
    last = text not in keep
    own = docs.select(*keep, *([F.col(text)] if last else []))
    at = len(keep) if last else keep.index(text)
    types = [ARROW[t] for t in fields.values()]
    added = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields.items()))
    schema = T.StructType([*own.schema.fields[: len(keep)], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken_by(start.__module__)
        values_of = start()
        for whole in batches:
            # Some hundred texts at a time are Python strings.
            for batch in (whole.slice(i, TEXTS) for i in range(0, whole.num_rows, TEXTS)):
                texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
                new = [pa.array(v, type=t) for v, t in zip(values_of(texts), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], names=schema.names)
            give_back()

    return own.mapInArrow(run, schema)
