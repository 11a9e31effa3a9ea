"""Approximate nearest neighbours: vantage-point trees per shard, pruned by the
triangle inequality relaxed by a factor.

Vectors are spread over shards by hash. In each shard the unit vectors form a
tree: a vantage point, the half of the points nearest to it inside, the others
outside, with the range of distances of each half. A query first goes down to
its own leaf, which bounds the distance of its k-th neighbour, then through the
tree. With d the distance to the vantage point, a half with distances from lo
to hi holds nothing nearer than max(d - hi, lo - d); it is left out when
``factor`` times this is beyond the k-th neighbour found so far. A factor of
one loses nothing; a larger one visits fewer leaves.

Queries meet the shards in blocks: a task holds one shard and one block, both
of bounded size, so the work is the product of queries and shards, but no pair
of rows is ever a row of a table. Equal vectors are one point of the tree with
their k + 1 smallest ids, so that copies, however many, neither fill a shard
nor a list of neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import saved

LEAF = 128
# Points of a shard and queries of a block at most; small tables have SHARDS shards.
SHARD, BLOCK, SHARDS = 65_536, 65_536, 24
# Distances of unit vectors are exact to this.
SLACK = 1e-7
NOBODY = np.iinfo(np.int64).max


class Tree:
    """Vantage-point tree over the rows of ``x`` (unit vectors)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.order = np.arange(len(x))
        self.leaf = leaf
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(x))

    def _build(self, start: int, stop: int) -> int:
        """Node of the points order[start:stop]: (start, stop, None) of a leaf, else
        (vantage vector, inner node, its range, outer node, its range)."""
        at = len(self.nodes)
        self.nodes.append((start, stop, None))
        if stop - start <= self.leaf:
            return at
        part = self.order[start:stop]
        points = self.x[part]
        # A point far from the middle divides better than a central one.
        vantage = points[np.argmin(points @ points.mean(axis=0))]
        d = distances(vantage[None, :], points)[0]
        by_distance = np.argsort(d, kind="stable")
        self.order[start:stop], d = part[by_distance], d[by_distance]
        half = len(d) // 2
        inner = self._build(start, start + half)
        outer = self._build(start + half, stop)
        self.nodes[at] = (vantage, inner, (d[0], d[half - 1]), outer, (d[half], d[-1]))
        return at

    def leaf_of(self, q: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Each query's own leaf: (node, positions of queries)."""
        found, todo = [], [(self.root, np.arange(len(q)))]
        while todo:
            at, who = todo.pop()
            node = self.nodes[at]
            if len(who) and node[2] is None:
                found.append((at, who))
            elif len(who):
                vantage, inner, (_, hi), outer, (lo, _) = node
                near = distances(q[who], vantage[None, :])[:, 0] * 2 <= hi + lo
                todo += [(inner, who[near]), (outer, who[~near])]
        return found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Search:
    """The k best points of each query: score descending, then smallest id."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float):
        self.p, self.q, self.ids, self.query_ids, self.k, self.factor = points, queries, ids, query_ids, k, factor
        self.p2, self.q2 = dot(points, points), dot(queries, queries)
        self.pu, self.qu = points / np.sqrt(self.p2)[:, None], queries / np.sqrt(self.q2)[:, None]
        self.score = np.full((len(queries), k), -np.inf)
        self.best = np.full((len(queries), k), -1)
        self.first = np.full((len(queries), k), NOBODY)  # smallest id but the query's own
        self.tree = Tree(self.pu)
        self.read = 0  # points compared

    def run(self) -> None:
        seen = {}
        for at, who in self.tree.leaf_of(self.qu):
            self._leaf(at, who)
            seen[at] = who
        todo = [(self.tree.root, np.arange(len(self.q)))]
        while todo:
            at, who = todo.pop()
            node = self.tree.nodes[at]
            if node[2] is None:
                self._leaf(at, np.setdiff1d(who, seen.get(at, ()), assume_unique=True))
                continue
            vantage, inner, (in_lo, in_hi), outer, (out_lo, out_hi) = node
            d = distances(self.qu[who], vantage[None, :])[:, 0]
            reach = np.sqrt(np.maximum(2 - 2 * self.score[who, -1], 0))  # infinite while the list is short
            for child, lo, hi in ((outer, out_lo, out_hi), (inner, in_lo, in_hi)):
                bound = np.maximum(np.maximum(d - hi, lo - d), 0) * self.factor
                inside = who[bound <= reach + SLACK]
                if len(inside):
                    todo.append((child, inside))

    def _leaf(self, at: int, who: np.ndarray) -> None:
        start, stop, _ = self.tree.nodes[at]
        part = self.tree.order[start:stop]
        for i in range(0, len(who), 4096):
            self._compare(part, who[i : i + 4096])

    def _compare(self, part: np.ndarray, who: np.ndarray) -> None:
        self.read += len(part) * len(who)
        about = self.qu[who] @ self.pu[part].T
        row, col = np.nonzero(about >= self.score[who, -1][:, None] - 1e-9)
        if not len(row):
            return
        qs, ps = who[row], part[col]
        own = self.ids[ps, 0] == self.query_ids[qs]
        first = np.where(own, self.ids[ps, 1], self.ids[ps, 0])
        there = first != NOBODY
        row, qs, ps, first = row[there], qs[there], ps[there], first[there]
        if not len(row):
            return
        score = cosine(self.q[qs], self.p[ps], self.q2[qs], self.p2[ps])
        k = self.k
        held = np.unique(row)
        rows = np.concatenate([np.repeat(held, k), row])
        old = who[held]
        score = np.concatenate([self.score[old].ravel(), score])
        first = np.concatenate([self.first[old].ravel(), first])
        point = np.concatenate([self.best[old].ravel(), ps])
        order = np.lexsort((first, -score, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = rank < k
        at = (who[rows[top]], rank[top])
        self.score[at], self.first[at], self.best[at] = score[order][top], first[order][top], point[order][top]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products summed component by component, so that no block changes a sum."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def cosine(a: np.ndarray, b: np.ndarray, a2: np.ndarray, b2: np.ndarray) -> np.ndarray:
    return np.clip(dot(a, b) / np.sqrt(a2 * b2), -1.0, 1.0)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(rows, -1)


def usable(vector: str) -> Column:
    """Neither null nor zero, no component null or not finite."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, *, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``vectors`` to each of
    ``queries`` by cosine, nearest first, ties to the smaller id.

    Both hold an id (whole number) and a vector; other columns are ignored. A
    row with the query's id is never its neighbour. Rows with a null id or an
    unusable vector (see :func:`usable`) take no part; rows of one id count
    once, with the least of their vectors; vectors of other lengths are not
    compared. A query with fewer than k candidates gets those. Empty tables
    give no rows.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v"))
        return rows.where(F.col("id").isNotNull() & usable("v")).groupBy("id").agg(F.min("v").alias("v"))

    # The first ids of each vector: of a hot one, each task passes on k + 1 rows.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = clean(vectors).withColumn("n", rank).where(F.col("n") <= k + 1)
    points = saved(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    asked = saved(clean(queries), "queries")
    shards = max(-(-points.count() // SHARD), SHARDS)
    blocks = max(-(-asked.count() // BLOCK), 1)

    def dealt(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none = F.lit(None)
    both = points.select(
        F.size("v").alias("dims"), dealt("v", shards).alias("shard"), every(blocks).alias("block"), none.cast("bigint").alias("query"), "ids", "v"
    ).unionByName(asked.select(
        F.size("v").alias("dims"), every(shards).alias("shard"), dealt("id", blocks).alias("block"), F.col("id").alias("query"), none.cast("array<bigint>").alias("ids"), "v"
    ))
    schema = "query_id bigint, score double, ids array<bigint>"
    out = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def search(group: pa.Table) -> pa.Table:
        is_query = group["query"].is_valid()
        ours, theirs = group.filter(is_query), group.filter(pa.compute.invert(is_query))
        if not (ours.num_rows and theirs.num_rows):
            return out.empty_table()
        lists = theirs["ids"].to_pylist()
        ids = np.full((len(lists), k + 1), NOBODY)
        for at, some in enumerate(lists):
            ids[at, : len(some)] = some
        query_ids = ours["query"].to_numpy()
        s = Search(_matrix(theirs["v"], len(ids)), ids, _matrix(ours["v"], len(query_ids)), query_ids, k, factor)
        s.run()
        row, col = np.nonzero(s.best >= 0)
        best = s.best[row, col]
        return pa.table(
            [pa.array(query_ids[row]), pa.array(s.score[row, col]), pa.array([lists[b] for b in best], type=pa.list_(pa.int64()))], schema=out
        )

    # A number of partitions of its own: small groups would else be joined into one task.
    found = both.repartition(2 * shards * blocks, "dims", "shard", "block").groupBy("dims", "shard", "block").applyInArrow(search, schema)
    rows = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours' scores that are reached: per query and
    rank, so that a tie in place of another counts."""
    pairs = exact.select("query_id", "rank", F.col("score").alias("best")).join(found.select("query_id", "rank", "score"), ["query_id", "rank"], "left")
    return pairs.agg(F.avg((F.coalesce("score", F.lit(-2.0)) >= F.col("best") - 1e-12).cast("int"))).first()[0]
