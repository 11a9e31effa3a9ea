"""Small lookup tables as constants of the plan.

A spelling map or an exclusion list is looked up once per row and column by
every job. While it has at most MOST_ENTRIES entries (checked by fetching one
more) it becomes an expression: entries lie in buckets by hash, so a look-up
reads a handful of them whatever the size, several columns take one
projection, and there is neither a join nor a scan. A larger one is joined.
Both ways give the same rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ENTRIES = 4000
PER_BUCKET = 4


@dataclass(frozen=True)
class Lookup:
    """Distinct text keys with a value each: ``frame`` (key, value), and
    ``buckets`` if they are few."""

    frame: DataFrame
    buckets: tuple[dict[str, str | None], ...] | None

    @property
    def constant(self) -> bool:
        return self.buckets is not None

    def value(self, c: Column) -> Column:
        """Value of a key, null for one that is not listed."""
        if not any(self.buckets):
            return F.lit(None).cast("string")
        # one text literal, which the optimizer folds to an array of maps
        table = F.from_json(F.lit(json.dumps(self.buckets)), "array<map<string,string>>")
        at = F.pmod(F.xxhash64(c), F.lit(len(self.buckets))).cast("int")
        return F.try_element_at(F.get(table, at), c)

    def replace(self, c: Column) -> Column:
        """The value of a listed key, else the key itself."""
        return F.coalesce(self.value(c), c)

    def has(self, c: Column) -> Column:
        """Whether a key is listed; for lists, whose values are not null."""
        return self.value(c).isNotNull()


def lookup_of(table: DataFrame, most: int = MOST_ENTRIES) -> Lookup:
    """Lookup of a frame of (key, value), or of a list in its first column.
    Null keys match nothing; the keys of a map must be unique."""
    key = F.col(f"`{table.columns[0]}`").cast("string").alias("key")
    if len(table.columns) > 1:
        pairs = table.select(key, F.col(f"`{table.columns[1]}`").cast("string").alias("value")).where(F.col("key").isNotNull())
    else:
        pairs = table.select(key, F.lit("").alias("value")).where(F.col("key").isNotNull()).distinct()
    held = pairs.withColumn("hash", F.xxhash64("key")).limit(most + 1).collect()
    if len(held) > most:
        return Lookup(pairs, None)
    buckets: list[dict[str, str | None]] = [{} for _ in range(max(len(held) // PER_BUCKET, 1))]
    for row in held:
        buckets[row["hash"] % len(buckets)][row["key"]] = row["value"]
    return Lookup(pairs, tuple(buckets))
