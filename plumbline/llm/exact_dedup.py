"""Exact dedup against immutable snapshots screened by binary-fuse filters.

A store holds one snapshot per ingested batch: the digests that were new in
it, bucketed by digest, and a static binary-fuse filter (three hashes, eight
bits) per bucket. A new batch groups its own copies first. Its distinct
digests are screened by the filters of every snapshot; the few that any filter
lets through join the exact digests, and a match counts when the normalised
bytes of both texts are equal. Digests that are known nowhere form the next
snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import power_of_two, saved, whole_text
from plumbline.session import scratch_dir

KEYS_PER_BUCKET = 50_000
SPACE = r"[\x20\x09-\x0D]+"

FILTER = "bucket bigint, seed bigint, segment bigint, count bigint, prints binary"
MASK = (1 << 64) - 1


def normalised(text: str = "text") -> Column:
    """The text (null as empty) with each run of ASCII white space as one blank."""
    return F.regexp_replace(whole_text(text), SPACE, " ")


# ---- binary-fuse filter -------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed & MASK)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _places(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in neighbouring segments, and the print, of each key."""
    h = _mix(keys, seed)
    first = ((h >> np.uint64(32)) * np.uint64(count * segment) >> np.uint64(32)).astype(np.int64)
    mask = segment - 1
    second = (first + segment) ^ ((h >> np.uint64(18)).astype(np.int64) & mask)
    third = (first + 2 * segment) ^ (h.astype(np.int64) & mask)
    prints = (h ^ (h >> np.uint64(32))).astype(np.uint8)
    return np.stack([first, second, third]), prints


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, prints) of distinct 64-bit keys.

    Slots touched by one key are peeled, all at once per round, and the
    prints are set in reverse; a seed that leaves a core is replaced. Keys
    that are not distinct cannot be peeled, so they are made so.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    count = max(1, -(-int(n * factor) // segment) - 2)
    for attempt in range(200):
        seed = 0x9E3779B97F4A7C15 * (attempt + 1) & MASK >> 1
        places, prints = _places(keys, seed, segment, count)
        size = (count + 2) * segment
        degree = np.bincount(places.ravel(), minlength=size)
        joined = np.zeros(size, dtype=np.int64)  # xor of the keys at a slot
        ids = np.arange(n)
        for row in places:
            np.bitwise_xor.at(joined, row, ids)
        order, left = [], n
        alone = np.flatnonzero(degree == 1)
        while len(alone):
            owner, at = np.unique(joined[alone], return_index=True)
            slot = alone[at]
            order.append((owner, slot))
            left -= len(owner)
            for row in places:
                np.subtract.at(degree, row[owner], 1)
                np.bitwise_xor.at(joined, row[owner], owner)
            touched = np.unique(places[:, owner])
            alone = touched[degree[touched] == 1]
        if not left:
            table = np.zeros(size, dtype=np.uint8)
            for owner, slot in reversed(order):
                table[slot] = 0
                three = places[:, owner]
                table[slot] = prints[owner] ^ table[three[0]] ^ table[three[1]] ^ table[three[2]]
            return seed, segment, count, table.tobytes()
        if attempt % 10 == 9:  # a small set may need more room
            count += 1
    raise RuntimeError("no filter found")


def in_filter(keys: np.ndarray, seed: int, segment: int, count: int, prints: bytes) -> np.ndarray:
    """Whether each key may be in the set; always true for its members."""
    table = np.frombuffer(prints, dtype=np.uint8)
    places, own = _places(keys.astype(np.uint64), seed, segment, count)
    return (table[places[0]] ^ table[places[1]] ^ table[places[2]]) == own


# ---- store --------------------------------------------------------------


class Store:
    """Snapshots under one shared folder, each written once. ``buckets`` is
    fixed for the life of the store: take it from the rows it is to hold."""

    def __init__(self, spark, folder: str, expected_rows: int):
        self.spark, self.folder = spark, folder
        self.buckets = power_of_two(expected_rows / KEYS_PER_BUCKET, 16)
        self.names: list[str] = []

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(17)), F.lit(self.buckets))

    def snapshot(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}/digests")

    def known(self) -> DataFrame | None:
        """(digest, keep_id) of all snapshots; a digest is in one of them."""
        out = None
        for name in self.names:
            out = self.snapshot(name) if out is None else out.unionByName(self.snapshot(name))
        return out

    def ingest(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """Take in a batch (doc_id, digest) with its texts (doc_id, digest,
        norm: all that snapshots or the batch may ask for). Returns (digest,
        copies) of the batch, digests known already included. The first
        snapshot that holds a digest keeps it.
        """
        own = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("copies"))
        own = saved(own.withColumn("key", F.xxhash64("digest")), "dedup-batch")
        fresh = own
        if self.names:
            known = self.same_text(self.screen(own), texts)
            fresh = own.join(known, "digest", "left_anti")
        name = f"snapshot-{len(self.names):04d}-{uuid.uuid4().hex[:8]}"
        fresh = fresh.select("digest", "keep_id", "key").withColumn("bucket", self.bucket())
        fresh.write.parquet(f"{self.folder}/{name}/digests")
        self.snapshot(name).select("bucket", "key").groupBy("bucket").applyInPandas(_filter_of, FILTER).write.parquet(
            f"{self.folder}/{name}/filter"
        )
        self.names.append(name)
        return own.select("digest", "copies")

    def screen(self, own: DataFrame) -> DataFrame:
        """The digests that some snapshot's filter lets through."""
        asked = own.select("digest", "keep_id", "key").withColumn("bucket", self.bucket())
        filters = None
        for name in self.names:
            one = self.spark.read.schema(FILTER).parquet(f"{self.folder}/{name}/filter")
            filters = one if filters is None else filters.unionByName(one)
        through = asked.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screened, "digest binary, keep_id bigint")
        return through

    def same_text(self, positive: DataFrame, texts: DataFrame) -> DataFrame:
        """(digest) of the positives whose bytes equal those of the text a snapshot keeps."""
        known = self.known().select("digest", F.col("keep_id").alias("known_id"))
        pairs = saved(positive.join(known, "digest"), "dedup-positive")
        wanted = pairs.select("digest", F.col("keep_id").alias("doc_id")).unionByName(pairs.select("digest", F.col("known_id").alias("doc_id")))
        wanted = wanted.select(F.col("digest").alias("wanted"), F.col("doc_id").alias("wanted_id")).distinct()
        same = (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))
        found = texts.join(wanted.hint("shuffle_hash"), same, "left_semi")
        # One text per side and digest, of two ids (a null one included);
        # equal bytes leave one distinct value.
        ids = F.struct("doc_id")
        sides = found.groupBy("digest").agg(
            F.min("norm").alias("low"), F.max("norm").alias("high"), (F.min(ids) != F.max(ids)).alias("both")
        )
        return sides.where("low = high AND both").select("digest")


def _filter_of(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([(int(group["bucket"].iloc[0]), *build_filter(group["key"].to_numpy()))], columns=[c.split()[0] for c in FILTER.split(", ")])


def _screened(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    hit = np.zeros(len(asked), dtype=bool)
    keys = asked["key"].to_numpy()
    for f in filters.itertuples() if len(asked) else ():
        hit |= in_filter(keys, int(f.seed), int(f.segment), int(f.count), f.prints)
    return asked.loc[hit, ["digest", "keep_id"]]


# ---- operator -----------------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of the normalised text in UTF-8."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(normalised(), 256)).alias("digest"))


def classes(docs: DataFrame, batches: int = 3) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size,
    kept, text_sha256.

    Rows are taken in as ``batches`` runs of ascending doc_id, so the first
    keeper of a text has its smallest id; null ids come last, and keep a text
    only when no other row has it.
    Null and empty texts are equal to each other. Of repeated rows (same id
    and text) one is kept. No rows give no rows. Texts move only for the byte
    check of digests met in two batches; everything else moves digests. A text
    that a third of all rows share is counted in the map tasks, and the join
    of its rows to their group has one row per digest on the other side.
    """
    spark = docs.sparkSession
    rows = saved(digests(docs), "dedup-digests")
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    step = max(1, -(-(high - low + 1) // batches))
    rows = rows.withColumn("batch", F.coalesce(F.expr(f"(doc_id - {low}L) div {step}L"), F.lit(batches - 1)))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised().alias("norm")).withColumn(
        "digest", F.unhex(F.sha2("norm", 256))
    )
    store = Store(spark, scratch_dir(spark, "dedup-store"), n)
    counts = None
    for k in range(batches):
        own = store.ingest(rows.where(F.col("batch") == k).select("doc_id", "digest"), texts)
        counts = own if counts is None else counts.unionByName(own)
    sizes = counts.groupBy("digest").agg(F.sum("copies").alias("group_size"))
    groups = store.known().select("digest", "keep_id").join(sizes, "digest")
    out = rows.join(groups, "digest")
    # Repeated rows of the keeper: (digest, doc_id) is spread even when a digest is hot.
    first = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy(F.lit(1))) == 1
    return out.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept(docs: DataFrame, batches: int = 3) -> DataFrame:
    """The rows of docs that stay, with their columns.

    The rows dropped are fewer than those kept, but either may be large, so
    both sides are shuffled on doc_id; the small side is hashed, and no text
    is sorted. Repeated rows of a keeper are told apart only where they exist.
    """
    keep = saved(classes(docs, batches).where("kept").select(F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_digest")), "dedup-kept")
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.unhex(F.sha2(normalised(), 256)).alias("digest"))
    same = own["id"].eqNullSafe(keep["kept_id"]) & (own["digest"] == keep["kept_digest"])
    out = own.join(keep.hint("shuffle_hash"), same, "left_semi")
    repeated = digests(docs).groupBy("doc_id", "digest").count().where("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates(["id", "digest"])
    return out.select("row.*")
