"""Near-duplicates by ProbMinHash, banding and verification.

A text is the set of its shingles of five words (lower case, split at ASCII
white space), each of weight 1 however often it comes, since links are of
sets: a weight by count would band another similarity than is verified.
ProbMinHash gives every shingle a Poisson process of arrivals at the rate of
its weight; each arrival falls on one of the registers, and a register keeps
the shingle that arrives first. A shingle stops when its next arrival comes after the largest
register, so most stop after one or two. Two registers agree with the
probability Jaccard similarity of the texts. Registers are banded, texts that
agree in a band are candidates, and candidates are verified by the exact
Jaccard similarity of their shingle sets.

Texts with equal shingles are one node from the start. In a band's bucket not
all pairs are compared: every member is compared with the least one, its
leader, and those unlike it get a new leader, for a few rounds. Members of
buckets that then still hold two components are joined exactly, by prefixes of
their rarest shingles. So no component is missed that comparing all pairs of
all buckets would give, and no pairs within a large group are spelled out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import connected_components, per_text, saved

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5
MEMO = 300_000
AT_ONCE = 65_536  # shingles whose arrivals are drawn together
PER_TASK = 500  # members compared with one leader in a group
ROUNDS = 3  # rounds of leaders before what is left is joined by prefixes

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= MEMO:
            self.clear()
        self[word] = value
        return value


def shingles(text: str, hashes: dict, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and how often each comes. A text of
    fewer words is one shingle; one without words has none."""
    split = text.lower().encode("utf-8", "surrogatepass").split()
    if not split:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    one = np.fromiter(map(hashes.__getitem__, split), dtype=np.uint64, count=len(split))
    width = min(words, len(one))
    out = np.full(len(one) - width + 1, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        out = _mix(out * _C1 + one[k : len(one) - width + 1 + k])
    return np.unique(out, return_counts=True)


def prob_minhash(keys: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """Shingle that arrives first at each register."""
    order = np.argsort(keys, kind="stable")
    return prob_minhashes(keys[order], weights[order], np.array([len(keys)]), registers)[0]


def prob_minhashes(keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, registers: int) -> np.ndarray:
    """A row per set: the shingle that arrives first at each register. The sets
    lie one after another in ``keys``, ascending in each; ``sizes`` counts them."""
    first = np.full(len(sizes) * registers, np.inf)
    winner = np.zeros(len(sizes) * registers, dtype=np.uint64)
    keys, rate = keys.astype(np.uint64), weights.astype(np.float64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    time = np.zeros(len(keys))
    step = 0
    while len(keys):
        step += 1
        draw = _mix(keys + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log1p(-((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / rate
        on_time = time < first.reshape(-1, registers).max(axis=1)[owner]
        keys, rate, time, owner = keys[on_time], rate[on_time], time[on_time], owner[on_time]
        at = owner * registers + (_mix(draw[on_time] + _C3) % np.uint64(registers)).astype(np.int64)
        before = first[at]
        np.minimum.at(first, at, time)
        # The earliest of the arrivals at a register; of ties the least key, which is written last.
        lead = np.flatnonzero((time < before) & (time == first[at]))[::-1]
        winner[at[lead]] = keys[lead]
    return winner.reshape(-1, registers)


def bands_of(winner: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per band; of a row of registers per set, a row each."""
    cut = winner.reshape(*winner.shape[:-1], bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:-1])
    for k in range(rows):
        out = _mix(out * _C1 + cut[..., k])
    return out.view(np.int64)


def set_bands(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    """Bands of each set of shingles (ascending), None for an empty one. Some
    sets at a time go through the registers together."""
    out: list[np.ndarray | None] = [None] * len(sets)
    filled = [i for i, keys in enumerate(sets) if len(keys)]
    sizes = np.array([len(sets[i]) for i in filled], dtype=np.int64)
    group = np.cumsum(sizes) // AT_ONCE
    for cut in np.split(np.arange(len(filled)), np.flatnonzero(np.diff(group)) + 1):
        if len(cut):
            keys = np.concatenate([sets[filled[i]] for i in cut])
            bands = bands_of(prob_minhashes(keys, np.ones(len(keys)), sizes[cut], BANDS * ROWS))
            for i, row in zip(cut, bands):
                out[filled[i]] = row
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, print, bands): ``print`` is equal for equal shingle sets, null for none."""
    def start():
        hashes = _WordHashes()

        def values(texts: list[str]) -> list:
            sets = [shingles(text, hashes)[0] for text in texts]
            prints = [hashlib.blake2b(keys.tobytes(), digest_size=16).digest() if len(keys) else None for keys in sets]
            return [[len(keys) for keys in sets], prints, set_bands(sets)]

        return values

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return per_text(named, ["doc_id"], {"n_shingles": "bigint", "print": "binary", "bands": "array<bigint>"}, start)


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs (a, b), with ``sets`` (node, keys).

    Pairs are grouped by ``a`` in parts of ``PER_TASK`` or so, each with one
    copy of a's set, so a node with very many partners is split, and no
    group holds more than a part.
    """
    partners = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    parts = F.ceil(F.col("partners") / PER_TASK).cast("int")
    split = pairs.join(partners, "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"))
    right = split.join(sets.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "keys")
    left = partners.join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(None).cast("bigint").alias("b"), "keys"
    )
    rows = left.unionByName(right).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, own = None, None
        for batch in batches:
            out = []
            for a, b, keys in zip(batch["a"], batch["b"], batch["keys"]):
                if b is None or b != b:
                    head, own = a, np.frombuffer(keys, dtype=np.uint64)
                else:
                    assert head == a
                    out.append((a, int(b), _jaccard(own, np.frombuffer(keys, dtype=np.uint64))))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    return rows.mapInPandas(run, "a bigint, b bigint, similarity double")


def key_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, keys): the shingle sets of the documents in ``nodes`` (node), as bytes."""
    def start():
        hashes = _WordHashes()
        return lambda texts: [[shingles(t, hashes)[0].tobytes() for t in texts]]

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text")
    picked = texts.join(nodes.hint("shuffle_hash"), "node", "left_semi")
    return per_text(picked, ["node"], {"keys": "binary"}, start).dropDuplicates(["node"])


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, class_id, kept, n_shingles.

    ``class_id`` is the smallest doc_id that chains of links reach; a link is
    a Jaccard similarity of at least ``threshold``. ``kept`` marks the row
    that stays. Null, empty and blank texts have no shingles and stand alone;
    so do rows with a null doc_id, which are kept with a null class. doc_id
    must otherwise be unique; repeated rows of equal text share a class and
    are all marked alike.
    """
    sketch = saved(sketches(docs), "near-sketch")
    known = sketch.where("print IS NOT NULL AND doc_id IS NOT NULL")
    # Equal shingle sets: one node each, whatever the number of copies.
    copies = known.groupBy("print").agg(F.min("doc_id").alias("node"))
    nodes = known.join(copies.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    members = nodes.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("node"))
    # A bucket of one has no partners.
    shared = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    open_members = saved(members.join(shared.select("bucket"), "bucket", "left_semi"), "near-open")
    sets = saved(key_sets(docs, open_members.select("node").distinct()), "near-sets")
    links, rest = None, open_members
    for _ in range(ROUNDS):
        leaders = rest.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
        led = rest.join(leaders.select("bucket", "leader"), "bucket").where("node > leader")
        measured = saved(similarities(led.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), sets), "near-stars")
        links = _both(links, _linked(measured, threshold))
        # What is not like its leader gets a new one.
        unlike = measured.where(F.col("similarity") < threshold).select(F.col("a").alias("leader"), F.col("b").alias("node"))
        rest = saved(led.join(unlike, ["leader", "node"]).select("bucket", "node"), "near-rest")
        if rest.isEmpty():
            break
    links = saved(links, "near-links")
    component = saved(connected_components(links), "near-components")
    # Members of buckets that still hold two components.
    tagged = open_members.join(component.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = tagged.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    apart = saved(tagged.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "component").distinct(), "near-apart")
    if not apart.isEmpty():
        more = saved(_linked(similarities(prefix_pairs(apart, sets, threshold), sets), threshold), "near-links")
        if not more.isEmpty():
            component = connected_components(links.unionByName(more))
    own = sketch.withColumn("print", F.when(F.col("doc_id").isNotNull(), F.col("print"))).join(copies, "print", "left")
    out = own.join(component.select(F.col("id").alias("node"), "component"), "node", "left")
    class_id = F.coalesce("component", "node", "doc_id")
    return out.select(
        "doc_id", class_id.alias("class_id"), F.col("doc_id").eqNullSafe(class_id).alias("kept"), "n_shingles"
    )


def prefix_pairs(apart: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes in different components that may reach the
    threshold: all that do are among them.

    Shingles are ordered by the number of nodes that have them, rare ones
    first. Two sets that reach the threshold share a shingle in the first
    n - threshold * n + 1 of each, and from the first one they share on, both
    must have enough left. Shingles of one node only need no partner, but keep
    their places. Copies with edits of their own begin with those, so that
    near misses of a large group do not meet at all.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            own = [np.frombuffer(keys, dtype=np.int64) for keys in batch["keys"]]
            n = np.array([len(keys) for keys in own])
            yield pd.DataFrame({
                "node": np.repeat(batch["node"].to_numpy(), n), "component": np.repeat(batch["component"].to_numpy(), n),
                "n": np.repeat(n, n), "shingle": np.concatenate(own),
            })

    rows = saved(
        apart.join(sets, "node").mapInPandas(run, "node bigint, component bigint, n bigint, shingle bigint"), "near-shingles"
    )
    common = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = rows.join(common, "shingle").withColumns({
        "place": F.row_number().over(Window.partitionBy("node").orderBy("df", "shingle")),
        "shared": F.count("*").over(Window.partitionBy("node")),
    })
    ranked = ranked.withColumn("place", F.col("n") - F.col("shared") + F.col("place"))
    prefix = saved(
        ranked.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select("shingle", "node", "component", "n", "place"),
        "near-prefix",
    )
    a, b = prefix.alias("a"), prefix.alias("b")
    left = F.least(F.expr("a.n - a.place"), F.expr("b.n - b.place")) + 1
    both = F.expr("a.n + b.n")
    may = (
        (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
        & (left * (1 + threshold) >= both * threshold - 1e-9)
        & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - 1e-9)
    )
    return a.join(b, may).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def _linked(measured: DataFrame, threshold: float) -> DataFrame:
    return measured.where(F.col("similarity") >= threshold).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _both(one: DataFrame | None, other: DataFrame) -> DataFrame:
    return other if one is None else one.unionByName(other)


def kept(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that stay, with their columns: one of each class."""
    keep = saved(classes(docs, threshold).where("kept").select(F.col("doc_id").alias("kept_id")).distinct(), "near-kept")
    return docs.join(keep.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(keep["kept_id"]), "left_semi")
