"""Mix sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` rows. A source with ``a`` of
``W`` shares must run at the rate a/W: its block j may not start before slot
floor(j*W/a) and must be done by slot ceil((j+1)*W/a). Earliest deadline first
among the released blocks meets every such window when the shares fill W, so
at any slot each source is less than one block from its target. Windows repeat
every W slots, so one period of W slots is scheduled (a fold over the slots,
bounded by the shares and not by the data) and every block finds its slot by
arithmetic. No row is scheduled one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import power_of_two, saved

ROWS_PER_BUCKET = 20_000
NEW = ("mix_block", "mix_row", "mix_release", "mix_deadline", "mix_slot")
MOST_SOURCES = 10_000


def source_key() -> Column:
    """A null source is one of its own, apart from the empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))


_FOLD = """
aggregate(
  sequence(0L, {W}L - 1L),
  named_struct(
    'next', transform(shares, s -> named_struct('key', s.key, 'share', s.share, 'j', 0L)),
    'out', cast(array() as array<struct<deadline:bigint,key:string,j:bigint,slot:bigint>>)),
  (a, t) -> transform(
    array(array_min(transform(
      filter(a.next, s -> s.j < s.share and (s.j * {W}L) div s.share <= t),
      s -> named_struct('deadline', ((s.j + 1L) * {W}L + s.share - 1L) div s.share, 'key', s.key, 'j', s.j)))),
    p -> named_struct(
      'next', transform(a.next, s -> named_struct('key', s.key, 'share', s.share, 'j', s.j + if(s.key = p.key, 1L, 0L))),
      'out', concat(a.out, array(named_struct('deadline', p.deadline, 'key', p.key, 'j', p.j, 'slot', t)))))[0],
  a -> a.out)
"""


def tempered_shares(docs: DataFrame, total: int = 1000) -> DataFrame:
    """(source, share): shares in proportion to the square root of the number
    of rows, so that large sources weigh less than their size. At least 1."""
    roots = docs.groupBy("source").agg(F.sqrt(F.count("*")).alias("root"))
    whole = roots.agg(F.sum(F.floor(F.col("root") * 1000))).first()[0] or 1
    share = F.floor(F.floor(F.col("root") * 1000) * total / F.lit(whole))
    return roots.select("source", F.greatest(share, F.lit(1)).cast("bigint").alias("share"))


def period(shares: DataFrame) -> tuple[DataFrame, int]:
    """One period of the schedule, (key, j, slot, share), and its length W.

    W is the sum of the shares. More than ``MOST_SOURCES`` sources is an
    error: group them first. Shares must be positive.
    """
    rows = shares.select(source_key().alias("key"), F.col("share").cast("bigint").alias("share")).groupBy("key").agg(
        F.sum("share").alias("share")
    )
    n, length, least = rows.agg(F.count("*"), F.sum("share"), F.min("share")).first()
    if n > MOST_SOURCES:
        raise ValueError(f"{n} sources; at most {MOST_SOURCES}")
    if n and least < 1:
        raise ValueError("shares must be positive")
    length = length or 0
    if not length:
        return rows.select("key", F.lit(0).cast("bigint").alias("j"), F.lit(0).cast("bigint").alias("slot"), "share"), 1
    one = rows.agg(F.array_sort(F.collect_list(F.struct("key", "share"))).alias("shares"))
    slots = one.select(F.explode(F.expr(_FOLD.format(W=length))).alias("p")).select("p.key", "p.j", "p.slot")
    return saved(slots.join(rows, "key"), "mix-period"), length


def schedule(docs: DataFrame, shares: DataFrame, block_rows: int = 64) -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_row`` (place in its block), ``mix_release``,
    ``mix_deadline`` and ``mix_slot``; the mix is the order (mix_slot, mix_row).

    docs needs ``doc_id`` and ``source``; other columns are kept, but for
    ones that have the name of a new column, which it replaces. Rows of a
    source are dealt in the order of md5(doc_id), then doc_id; repeated rows
    are dealt like others, null ids last, null sources form a source. Each row
    comes exactly once. When a source has no more blocks its slots stay empty
    and the others keep theirs, so the order is still by their weights.
    Sources without a share are an error: weights must be stated for all. No
    rows give no rows.

    Rows are numbered within (source, slice of the md5 range), with as many
    slices as rows ask for, and offsets come from counts per slice; so a
    source that holds a third of all rows is spread over all tasks.
    """
    slots, length = period(shares)
    n = docs.count()
    slices = power_of_two(n / ROWS_PER_BUCKET, 256)
    digest = F.md5(F.col("doc_id").cast("string"))
    slice_of = F.coalesce(F.shiftright(F.conv(F.substring("mix_md5", 1, 8), 16, 10).cast("bigint") * slices, 32), F.lit(slices))
    # Packed, so that no column of docs can clash with a column used here.
    old = [c for c in docs.columns if c not in NEW]
    dealt = docs.select(F.struct(*old).alias("row"), "doc_id", source_key().alias("key"), digest.alias("mix_md5")).withColumn("mix_slice", slice_of)
    counts = dealt.groupBy("key", "mix_slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "mix_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("key", "mix_slice").orderBy(F.col("mix_md5").asc_nulls_last(), "doc_id")
    numbered = dealt.withColumn("mix_row", F.row_number().over(within) - 1).join(offsets, ["key", "mix_slice"])
    placed = numbered.withColumn("place", F.col("offset") + F.col("mix_row")).withColumn(
        "mix_block", F.expr(f"place div {block_rows}L")
    )
    # The period has one row per share: bounded by the weights, never by the rows.
    steps = F.broadcast(slots)
    stated = slots.select("key", "share").distinct()
    placed = placed.join(F.broadcast(stated), "key", "left")
    share = F.coalesce("share", F.raise_error(F.concat(F.lit("no share for source "), F.col("key"))).cast("bigint"))
    placed = placed.withColumn("share", share).withColumn("j", F.col("mix_block") % F.col("share"))
    out = placed.join(steps.drop("share"), ["key", "j"])
    return out.select(
        "row.*",
        "mix_block",
        (F.col("place") % block_rows).alias("mix_row"),
        F.expr(f"(mix_block * {length}L) div share").alias("mix_release"),
        F.expr(f"((mix_block + 1L) * {length}L + share - 1L) div share").alias("mix_deadline"),
        F.expr(f"(mix_block div share) * {length}L + slot").alias("mix_slot"),
    )


def mixed(docs: DataFrame, shares: DataFrame | None = None, block_rows: int = 64) -> DataFrame:
    """The rows of ``docs``, same columns, in the order of the mix.

    Written files follow each other in that order.
    """
    shares = tempered_shares(docs) if shares is None else shares
    named = docs.select(F.struct("*").alias("row"), "doc_id", "source")
    return schedule(named, shares, block_rows).orderBy("mix_slot", "mix_row").select("row.*")
