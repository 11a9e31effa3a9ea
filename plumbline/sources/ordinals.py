"""Row positions: headers, footers, slices and corrections by ordinal.

A scan has no row order, so every function takes the columns that give it
(``order``). Nulls come first, and rows with equal order values are on one side
of a cut together. Trims look up the order value at the cut and filter on it;
the rows themselves are neither sorted nor shuffled. How the value is looked up
depends on the depth of the cut (a bounded top-n, or beyond TOP_N numbered rows);
what it is does not.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import scratch_dir

ORDINAL = "_ord"
# Deepest cut that is looked up with a top-n. Spark trims each task's rows
# before the shuffle up to this depth.
TOP_N = 1000
MERGE_GROUPS = 256
# A table of block sizes up to this many rows (a few megabytes) is broadcast.
MOST_BLOCKS = 20_000


def _key(order: list[str]) -> Column:
    # a struct is never null, and compares with nulls first
    return F.struct(*order)


def with_ordinal(df: DataFrame, order: list[str] | None = None, *, total: str | None = None) -> DataFrame:
    """Attach ``_ord``, the row number from 0, and with ``total`` a column of
    that name with the number of all rows.

    Without ``order``, ``df`` must come straight from files and is numbered in
    path and line order. Rows of Parquet files know their place in the file,
    so only the row counts in the footers are read. Of other files rows are
    counted per file block, so blocks stay apart in tasks of their own. With ``order``, the rows are range
    partitioned by the whole key, so that even a leading value most rows share
    is split, and written to the scratch folder with their place; the written
    table fixes the ranges, which another run of the same plan might cut
    elsewhere. Both ways only the sizes of the blocks are gathered, in a table
    of one row per block; while it is small it is broadcast, so that no row is
    shuffled to look its block up.
    """
    if order is None:
        indexed = _row_indexed(df)
        if indexed is not None:
            return _numbered(*indexed, df.columns, total)
        path, start = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
        rows = df.select("*", F.struct(path, start).alias("_block"), F.monotonically_increasing_id().alias("_row"))
    else:
        path = scratch_dir(df.sparkSession, "ordered")
        ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
        placed = ranged.select("*", F.spark_partition_id().alias("_block"), F.monotonically_increasing_id().alias("_row"))
        placed.write.parquet(path)
        rows = df.sparkSession.read.schema(placed.schema).parquet(path)
    # a block is read by one task in its order, so its numbers are consecutive
    sizes = rows.groupBy("_block").agg(F.count("*").alias("_n"), F.min("_row").alias("_row0"))
    return _numbered(rows, sizes, df.columns, total)


def _row_indexed(df: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Rows of whole Parquet files with their place in the file, and the sizes
    of the files; None for other formats and for rows that were filtered.

    The sizes need no column, so the scan takes row counts from the footers
    and decodes nothing. A file whose count falls short of its last index has
    lost rows to a filter, and its indexes are no ordinals.
    """
    at = F.col("_metadata.row_index")
    try:
        rows = df.select("*", F.struct(F.col("_metadata.file_path").alias("path")).alias("_block"), at.alias("_row"))
    except AnalysisException:
        return None
    sizes = rows.groupBy("_block").agg(F.count("*").alias("_n"), F.max("_row").alias("_last"))
    sizes = _kept(sizes.withColumn("_row0", F.lit(0).cast("bigint")), "files")
    if not sizes.where("_n <> _last + 1").isEmpty():
        return None
    return rows, sizes.drop("_last")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(rows: DataFrame, sizes: DataFrame, columns: list[str], total: str | None) -> DataFrame:
    """``rows`` numbered through from the sizes (``_n``) and first numbers (``_row0``) of their blocks."""
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = _kept(sizes.select(
        "_block", "_row0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"), F.sum("_n").over(everything).alias("_all")
    ), "blocks")
    if starts.count() <= MOST_BLOCKS:
        starts = F.broadcast(starts)
    number = F.col("_start") + F.col("_row") - F.col("_row0")
    out = [F.col("_all").cast("bigint").alias(total)] if total else []
    return rows.join(starts, "_block").select(*columns, number.cast("bigint").alias(ORDINAL), *out)


def _nearest(df: DataFrame, order: list[str], n: int, last: bool = False) -> DataFrame:
    """The ``n`` first order values (``_k``), or the last ones.

    Top-n per task, then per group of tasks, then over the groups, so that no
    task takes in ``n`` rows from every other one.
    """
    direction = F.col("_k").desc() if last else F.col("_k").asc()
    keys = df.select(_key(order).alias("_k"), (F.spark_partition_id() % MERGE_GROUPS).alias("_g"))
    rank = F.row_number().over(Window.partitionBy("_g").orderBy(direction))
    return keys.withColumn("_n", rank).filter(F.col("_n") <= n).select("_k").orderBy(direction).limit(n)


def _bound(df: DataFrame, order: list[str], n: int, last: bool = False) -> Column:
    """Order value of the n-th row from the start, or from the end."""
    if n <= TOP_N:
        held = _nearest(df, order, n, last)
    else:
        rows = with_ordinal(df, order)
        place = F.col(ORDINAL)
        inside = place >= rows.agg(F.count("*")).scalar() - n if last else place < n
        held = rows.filter(inside).select(_key(order).alias("_k"))
    return held.agg((F.min if last else F.max)("_k")).scalar()


def slice_rows(df: DataFrame, start: int, stop: int | None, order: list[str]) -> DataFrame:
    """Rows ``start`` to ``stop - 1``; ``stop=None`` runs to the end."""
    out = df
    if start > 0:
        out = out.filter(_key(order) > _bound(df, order, start))
    if stop is not None:
        out = out.filter(_key(order) <= _bound(df, order, stop)) if stop > start else out.limit(0)
    return out


def slice_labels(df: DataFrame, first: int, last: int | None, order: list[str]) -> DataFrame:
    """As :func:`slice_rows` with both ends included."""
    return slice_rows(df, first, None if last is None else last + 1, order)


def skip_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return slice_rows(df, n, None, order)


def skip_footer(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Leave out the last ``n`` rows."""
    if n <= 0:
        return df
    return df.filter(_key(order) < _bound(df, order, n, last=True))


def rows_at(df: DataFrame, ordinals: list[int], order: list[str]) -> Column:
    """Array of the order values at the given ordinals; only these are gathered."""
    depth = max(ordinals) + 1
    if depth <= TOP_N:
        held = _nearest(df, order, depth).withColumn(ORDINAL, F.row_number().over(Window.orderBy("_k")) - 1)
    else:
        held = with_ordinal(df, order).select(_key(order).alias("_k"), ORDINAL)
    return held.filter(F.col(ORDINAL).isin(*ordinals)).agg(F.collect_list("_k")).scalar()


def drop_ordinals(df: DataFrame, ordinals: list[int], order: list[str]) -> DataFrame:
    """Leave out the rows at the given ordinals, which are few and near the start."""
    if not ordinals:
        return df
    hit = F.array_contains(rows_at(df, ordinals, order), _key(order))
    return df.filter(~F.coalesce(hit, F.lit(False)))


def correct_at(df: DataFrame, ordinal: int, column: str, value: object, order: list[str]) -> DataFrame:
    """Set one cell by row ordinal."""
    at = _key(order) == F.get(rows_at(df, [ordinal], order), F.lit(0))
    return df.withColumn(column, F.when(at, F.lit(value)).otherwise(F.col(column)))


def apply_corrections(df: DataFrame, key: str, fixes: dict[object, dict[str, object]]) -> DataFrame:
    """Set cells by key: ``{key value: {column: new value}}``."""
    columns = {c for fix in fixes.values() for c in fix}
    new = {}
    for column in columns:
        out = F.col(column)
        for k, fix in fixes.items():
            if column in fix:
                out = F.when(F.col(key) == F.lit(k), F.lit(fix[column])).otherwise(out)
        new[column] = out
    return df.withColumns(new)


def promote_header(df: DataFrame, order: list[str], *, at: int = 0) -> DataFrame:
    """Take the names from row ``at`` (one row is fetched) and leave out the
    rows up to it. Order columns keep their names."""
    names = slice_rows(df, at, at + 1, order).first()
    renames = {c: str(names[c]) for c in df.columns if c not in order and names[c] is not None}
    return skip_rows(df, at + 1, order).withColumnsRenamed(renames)


def keep_columns_from(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns[start:stop]])
