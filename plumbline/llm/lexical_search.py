"""Ranked lexical search by NRA (no random access).

Every term of the items has a list of postings in each shard of documents,
sorted by impact. For an item the lists of its terms are read from the top
down, all to the same level of weighted impact, round by round. What was read
of a document is the lower end of its score; the upper end adds, for each list
it was not met in, the next posting of that list. A document whose upper end
is below the k-th best lower end is dropped. Reading goes on until none is
left open: every document still in the race, ties with the k-th included, has
equal ends, which are its final score. The k best of the shards are then
ranked together.

A score of a document is the sum over the item's terms, each once, of
weight * impact, with (N documents with a term, L terms of all, n terms of one,
df documents with the term, tf occurrences, whole-number division):

    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    impact = 1000000000 tf / (1000 tf + 8 (10 + 90 n N / L))
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import per_text, saved

# Terms of the items that one pass over the documents serves; more items take more passes.
BLOCK_TERMS = 200_000
# Documents of a shard at most; small tables have SHARDS shards.
SHARD_DOCS, SHARDS = 16_384, 8
STEP = 4  # each round reads down to this part of the level before

# Terms are runs of ASCII letters and digits, A-Z as a-z, and of all characters beyond ASCII.
_TERM = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TERM).split()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): the distinct terms of each item; rows of one id are
    one item. Null ids and items without terms are left out."""
    named = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))

    def start():
        return lambda texts: [[sorted({t.decode() for t in terms_of(x)}) for x in texts]]

    found = per_text(named, ["item_id"], {"terms": "array<string>"}, start)
    return found.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def postings(docs: DataFrame, vocabulary: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, spread, terms, tfs) per document with a term: the number of
    its terms, a number to deal it to a shard by, and its terms of the
    vocabulary as positions with their occurrences."""
    place = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(vocabulary)})

    def start():
        known, counter = place.value, count()

        def values(texts: list[str]) -> list:
            n, spread, terms, tfs = [], [], [], []
            for x in texts:
                words = terms_of(x)
                held = Counter(words)
                both = sorted((known[t], held[t]) for t in held.keys() & known.keys())
                n.append(len(words))
                spread.append(next(counter) * 2654435761 % (1 << 31))
                terms.append([t for t, _ in both])
                tfs.append([f for _, f in both])
            return [n, spread, terms, tfs]

        return values

    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    fields = {"n": "bigint", "spread": "bigint", "terms": "array<int>", "tfs": "array<bigint>"}
    return per_text(named, ["doc_id"], fields, start).where("n > 0")


def nra(docs: np.ndarray, impacts: np.ndarray, lists: list[tuple[int, int, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers below ``n_docs``) that are or tie with the k best of
    one item, and their scores.

    A list is (start, stop, weight): its postings are docs[start:stop], no
    document twice, with impacts[start:stop] descending.
    """
    lower = np.zeros(n_docs, dtype=np.int64)
    alive = None  # before anything is dropped: all documents
    at = [start for start, _, _ in lists]
    level = max(int(impacts[start]) * weight for start, _, weight in lists)
    while True:
        level = level // STEP
        following = []
        for i, (start, stop, weight) in enumerate(lists):
            least = -(-level // weight)
            end = stop - int(np.searchsorted(impacts[at[i] : stop][::-1], least)) if at[i] < stop else stop
            new, value = docs[at[i] : end], impacts[at[i] : end]
            if alive is not None:
                keep = alive[new]
                new, value = new[keep], value[keep]
            lower[new] += value * weight
            at[i] = end
            following.append(int(impacts[end]) * weight if end < stop else 0)
        unseen = sum(following)
        # Lists a document was met in add nothing more to it.
        upper = lower + unseen
        for (start, _, _), end, bound in zip(lists, at, following):
            if bound:
                upper[docs[start:end]] -= bound
        kth = int(np.partition(lower, n_docs - k)[n_docs - k]) if n_docs > k else 0
        inside = (upper >= max(kth, 1)) if alive is None else alive & (upper >= max(kth, 1))
        if unseen < kth or not unseen:
            alive = inside  # no document that was not met can come in
        if not unseen or (alive is not None and not (upper[inside] != lower[inside]).any()):
            found = np.flatnonzero(inside)
            return found, lower[found]


def _shard(table: pa.Table, items: list[tuple[int, list[tuple[int, int]]]], n_all: int, l_all: int, k: int):
    """The k best documents of one shard for each item."""
    ids = table["doc_id"].to_pylist()
    sizes = np.array([len(t) for t in table["terms"].to_pylist()], dtype=np.int64)
    term = table["terms"].combine_chunks().flatten().to_numpy().astype(np.int64)
    tf = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
    m = np.array([10 + 90 * n * n_all // l_all for n in table["n"].to_pylist()], dtype=np.int64)
    doc = np.repeat(np.arange(len(ids)), sizes)
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
    order = np.lexsort((-impact, term))
    term, doc, impact = term[order], doc[order], impact[order]
    for item, wanted in items:
        start = np.searchsorted(term, [t for t, _ in wanted])
        stop = np.searchsorted(term, [t for t, _ in wanted], side="right")
        lists = [(int(a), int(b), w) for a, b, (_, w) in zip(start, stop, wanted) if b > a]
        if lists:
            found, score = nra(doc, impact, lists, len(ids), k)
            best = sorted((-int(s), ids[d] is None, ids[d] or 0, d) for d, s in zip(found, score))[:k]
            for s, _, _, d in best:
                yield item, ids[d], -s


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a
    score above 0, ties by ascending doc_id.

    Counts and lists cover all documents and whole texts. A null text has no
    terms; a document with a null id counts and is listed after its ties; rows
    that repeat an id are documents of their own; rows that repeat an item id
    are one item; a null item id is left out. Empty tables give no rows. Other
    columns are ignored.

    The terms of the items are spread over blocks of about ``block_terms``,
    each of which takes a pass over the documents; only one block's terms,
    counts and weights are in the driver and the tasks at a time.
    """
    wanted = saved(item_terms(items, item_id, text), "item-terms")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(-(-total // block_terms), 1)
    parts = []
    for block in range(blocks):
        mine = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        held = sorted((r["item_id"], r["terms"]) for r in mine.collect())  # about block_terms terms
        parts.append(_block(docs, held, k, doc_id, text))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block(docs: DataFrame, held: list[tuple[int, list[str]]], k: int, doc_id: str, text: str) -> DataFrame:
    vocabulary = sorted({t for _, terms in held for t in terms})
    table = saved(postings(docs, vocabulary, doc_id, text), "postings")
    n_all, l_all = table.agg(F.count("*"), F.sum("n")).first()
    counts = table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    weight = {t: math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1))) for t, df in counts.collect()}  # one row per term of the block
    place = {t: i for i, t in enumerate(vocabulary)}
    items = [(item, [(place[t], weight[place[t]]) for t in sorted(terms) if weight.get(place[t], 0) > 0]) for item, terms in held]
    shared = docs.sparkSession.sparkContext.broadcast(([i for i in items if i[1]], n_all, l_all, k))
    shards = max(-(-n_all // SHARD_DOCS), SHARDS)
    out = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def best(group: pa.Table) -> pa.Table:
        rows = list(zip(*_shard(group, *shared.value))) or [[], [], []]
        return pa.table([pa.array(c, type=pa.int64()) for c in rows], schema=out)

    dealt = table.where(F.size("terms") > 0).withColumn("shard", (F.col("spread") % shards).cast("int"))
    found = dealt.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(best, "item_id bigint, doc_id bigint, score bigint")
    return _ranked(found, k)
