"""Embedding near-duplicates by NN-descent.

A neighbour graph per label starts from cells of random hyperplanes, in as many
tables as a pair at the threshold needs to share a cell of one, and is refined:
neighbours of a common vector are compared with each other, and each vector
keeps its nearest, until hardly a list changes. Lists hold neighbours within
``REACH`` times the angle of the threshold; farther ones lead nowhere. Every
pair at or above the threshold that is met on the way is a link, whether it
stays in a list or not. A list that is saturated (full of links) takes no more;
its vector is then given a list twice as long beside it, of neighbours outside
its component, until no list is full of links. Whole components are compared
in blocks, so link counts are exact within a component. An audit compares a
fixed number of vectors with all rows of their label and asks for a recall;
below it, the search goes on with new cells and longer lists, and is audited
with other vectors. When the last attempt is below it too, the job fails.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import connected_components, saved

THRESHOLD = 0.98
NEIGHBOURS, CELL, PLANES = 10, 48, 30
MISSED = 0.004  # chance that every table parts two vectors at the threshold
REACH = 3  # lists reach as far as so many times the threshold's angle
SETTLED = 0.002  # share of list entries that still change at the end
AUDITED, RECALL, ATTEMPTS = 256, 0.97, 3
BLOCK = 256

UNIT = "grp string, node bigint, unit binary"
CODE = "grp string, node bigint, tab int, code bigint, bits int"
FOUND = "u bigint, v bigint, sim double, link boolean"
NO_ENTRY = -3.0


def in_groups(df: DataFrame, keys: list[str], each: Callable[[pd.DataFrame], tuple], schema: str) -> DataFrame:
    """``each`` (rows of a group to a tuple of columns) over groups by key.

    Groups are bounded by the caller. Many small ones share an Arrow batch,
    so they cost no call of their own.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def joined(parts: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame({n: np.concatenate([np.asarray(p[i]) for p in parts]) for i, n in enumerate(names)})

        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            change = np.zeros(len(rows), dtype=bool)
            change[0] = True
            for k in keys:
                v = rows[k].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(change)
            parts = [each(rows.iloc[s:e]) for s, e in zip(starts[:-1], starts[1:])]
            held = rows.iloc[starts[-1] :]
            if parts:
                yield joined(parts)
        if held is not None:
            yield joined([each(held)])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), dtype=np.float64).reshape(len(units), -1)


def _reach(threshold: float) -> float:
    """Smallest cosine of a list entry."""
    return math.cos(min(math.pi, REACH * math.acos(min(1.0, max(-1.0, threshold)))))


def units(vectors: DataFrame) -> DataFrame:
    """(grp, node, unit) of vectors (vec_id, embedding, label) that can be
    compared: label and id not null, every component finite, not all zero.

    ``grp`` is label and length: vectors of different length never compare.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for label, node, values in zip(batch["label"], batch["node"], batch["embedding"]):
                x = np.array([np.nan if v is None else v for v in values], dtype=np.float64)
                top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if not top:
                    continue
                x = x / top  # no overflow in the square
                rows.append((f"{label}/{len(x)}", node, (x / np.sqrt((x * x).sum())).tobytes()))
            yield pd.DataFrame(rows, columns=["grp", "node", "unit"])

    named = vectors.where("label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("label").cast("string").alias("label"), F.col("vec_id").cast("bigint").alias("node"), "embedding"
    )
    return named.mapInPandas(run, UNIT)


def cells(nodes: DataFrame, threshold: float, seed: tuple[int, ...]) -> DataFrame:
    """(node, grp, tab, depth, cell, deal): where each vector is compared first.

    A cell is a label and as many hyperplanes as leave about ``CELL`` vectors
    on average, and more of them in a place that is fuller. Cells that stay too
    full (a dense group) are dealt at random into several. The number of tables
    grows with the number of hyperplanes, so that two vectors at the threshold
    are parted by all of them with a chance of ``MISSED`` only.
    """
    together = 1 - max(math.acos(min(1.0, max(-1.0, threshold))) / math.pi, 1e-3)
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(0), F.least(F.lit(PLANES), F.ceil(F.log2(F.col("n") / CELL)))).cast("int")
    tables = F.when(F.col("bits") == 0, 1).otherwise(F.ceil(math.log(MISSED) / F.log(1 - F.pow(F.lit(together), F.col("bits"))))).cast("int")
    sized = nodes.join(sizes.select("grp", bits.alias("bits")).withColumn("tables", tables), "grp").select("grp", "node", "unit", "bits", "tables")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, rows in batch.groupby(batch["unit"].str.len()):
                x, most = _matrix(rows["unit"]), rows["tables"].to_numpy()
                for t in range(most.max()):
                    if (size, t) not in planes:
                        planes[size, t] = np.random.default_rng([*seed, size, t]).standard_normal((size // 8, PLANES))
                    code = (x @ planes[size, t] > 0) @ (1 << np.arange(PLANES))
                    out = rows[["grp", "node", "bits"]].assign(tab=t, code=code)[most > t]
                    yield out[["grp", "node", "tab", "code", "bits"]]

    codes = saved(sized.mapInPandas(run, CODE), "knn-codes")
    place = lambda depth: F.expr(f"shiftright(code, {PLANES} - {depth})")
    wide = codes.withColumn("wide", place("bits"))
    fill = wide.groupBy("grp", "tab", "wide").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > 2 * CELL, F.ceil(F.log2(F.col("n") / CELL))).otherwise(0).cast("int")
    placed = wide.join(fill.select("grp", "tab", "wide", more.alias("more")), ["grp", "tab", "wide"])
    placed = placed.withColumn("depth", F.least(F.lit(PLANES), F.col("bits") + F.col("more"))).withColumn("cell", place("depth"))
    key = ["grp", "tab", "depth", "cell"]
    deals = placed.groupBy(*key).agg(F.ceil(F.count("*") / (2 * CELL)).alias("deals"))
    deal = F.pmod(F.xxhash64("node", "tab", *map(F.lit, seed)), "deals").alias("deal")
    return placed.join(deals, key).select("node", *key, deal)


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest v of each u as ``listed``, and of the rest the links.

    pairs has (u, v, sim, fresh, link), pairs once; ``NO_ENTRY`` marks a link
    that is no candidate for a list.
    """
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    ranked = pairs.withColumn("listed", (rank <= k) & (F.col("sim") > NO_ENTRY))
    return ranked.where("listed OR link")


def _star(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together what ``linked`` does: every vector with the
    first of its component, so at most one per vector in place of all pairs."""
    if not linked.any():
        return ids[:0], ids[:0]
    linked = linked | linked.T
    place = np.arange(len(ids))
    while True:
        low = np.minimum(place, np.where(linked, place[None, :], len(ids)).min(axis=1))
        low = low[low]
        if (low == place).all():
            break
        place = low
    at = np.flatnonzero(place != np.arange(len(ids)))
    return ids[at], ids[place[at]]


def _found(ids: np.ndarray, a: np.ndarray, b: np.ndarray, sim: np.ndarray, linked: np.ndarray) -> tuple:
    """Columns of ``FOUND``: candidates (a, b) and the star of the links."""
    src, dst = _star(ids, linked)
    return (
        np.r_[ids[a], src], np.r_[ids[b], dst], np.r_[sim[a, b], np.full(len(src), NO_ENTRY)],
        np.r_[np.zeros(len(a), dtype=bool), np.ones(len(src), dtype=bool)],
    )


def first_lists(nodes: DataFrame, k: int, threshold: float, seed: tuple[int, ...] = (0, 0)) -> DataFrame:
    """(u, v, sim, fresh, link, listed): the nearest within cells."""
    reach = _reach(threshold)
    placed = cells(nodes, threshold, seed).join(nodes.select("node", "unit", "own", "search"), "node")

    def each(rows: pd.DataFrame) -> tuple:
        x, ids, own, search = _matrix(rows["unit"]), rows["node"].to_numpy(), rows["own"].to_numpy(), rows["search"].to_numpy(dtype=bool)
        sim = x @ x.T
        other = own[:, None] != own[None, :]
        m = min(k, len(ids) - 1)
        if m < 1:
            return _found(ids, ids[:0], ids[:0], sim, other)
        shown = np.where(other, sim, NO_ENTRY)
        near = np.argpartition(-shown, m - 1, axis=1)[:, :m]
        a, b = np.repeat(np.arange(len(ids)), m), near.ravel()
        good = search[a] & other[a, b] & (sim[a, b] >= reach)
        return _found(ids, a[good], b[good], sim, other & (sim >= threshold))

    pairs = in_groups(placed, ["grp", "tab", "depth", "cell", "deal"], each, FOUND)
    pairs = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.lit(True).alias("fresh"), F.max("link").alias("link"))
    return _nearest(pairs, k)


def _members(lists: DataFrame, k: int) -> DataFrame:
    """(centre, member, fresh): the list of a centre and, of the vectors that
    list it, at most k by hash."""
    own = lists.select(F.col("u").alias("centre"), F.col("v").alias("member"), "fresh")
    back = lists.select(F.col("v").alias("centre"), F.col("u").alias("member"), "fresh")
    rank = F.row_number().over(Window.partitionBy("centre").orderBy(F.xxhash64("member", "centre"), "member"))
    return own.unionByName(back.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"))


def refined(lists: DataFrame, nodes: DataFrame, k: int, threshold: float, near: DataFrame | None = None) -> DataFrame:
    """One step: neighbours of a common vector are compared.

    Of the vectors that list a centre, as many as a list is long stand for
    the rest, chosen by hash; so a centre has at most 2k members, also one
    that very many list, and as many more from the settled lists ``near``.
    Centres without a fresh member have nothing to compare and are left out
    before vectors are sent. Pairs are compared when one of both is fresh, and
    leave the task only if they enter the list of one side, or in the star of
    the links met. A list full of links takes no more.
    """
    around = _members(lists, k)
    if near is not None:
        around = around.unionByName(_members(near.withColumn("fresh", F.lit(False)), k))
    around = around.repartition("centre").groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    around = around.withColumn("live", F.max("fresh").over(Window.partitionBy("centre"))).where("live").drop("live")
    floor = F.when(F.count("*") < k, _reach(threshold)).when(F.min("sim") >= threshold, 2.0).otherwise(F.min("sim"))
    last = lists.groupBy(F.col("u").alias("member")).agg(floor.alias("last"))
    sides = nodes.select(F.col("node").alias("member"), "unit", "own", "search")
    rows = around.join(last, "member", "left").withColumn("last", F.coalesce("last", F.lit(_reach(threshold)))).join(sides, "member")

    def each(g: pd.DataFrame) -> tuple:
        fresh, ids = g["fresh"].to_numpy(dtype=bool), g["member"].to_numpy()
        if not fresh.any() or len(g) < 2:
            return _found(ids, ids[:0], ids[:0], np.zeros((1, 1)), np.zeros((1, 1), dtype=bool))
        x, own, floor, search = _matrix(g["unit"]), g["own"].to_numpy(), g["last"].to_numpy(), g["search"].to_numpy(dtype=bool)
        sim = x @ x.T
        worth = (fresh[:, None] | fresh[None, :]) & (own[:, None] != own[None, :])
        a, b = np.nonzero(worth & search[:, None] & (sim > floor[:, None]))
        return _found(ids, a, b, sim, worth & (sim >= threshold))

    found = in_groups(rows, ["centre"], each, FOUND)
    merged = lists.select("u", "v", "sim", F.lit(False).alias("link"), F.lit(1).alias("known")).unionByName(found.withColumn("known", F.lit(0)))
    merged = merged.groupBy("u", "v").agg(F.max("sim").alias("sim"), (F.max("known") == 0).alias("fresh"), F.max("link").alias("link"))
    return _nearest(merged, k)


def components(nodes: DataFrame, k: int, threshold: float, attempt: int = 0, held: DataFrame | None = None) -> DataFrame:
    """(id, component) of the vectors with links, by NN-descent with lists of k.

    A list that is full of neighbours above the threshold hides further ones.
    The vectors of such lists get another list, twice as long, for their
    nearest outside the component they are in, until no list is full of links.
    Each further turn joins components, so there is an end: the number of
    components falls, and no turn follows one that joined none. ``held`` are
    components known before; they are carried forward, with the links met since.
    """
    now = nodes.withColumn("own", F.col("node")).withColumn("search", F.lit(True))
    near, turn = None, 0
    edges = None if held is None else held.select(F.col("id").alias("src"), F.col("component").alias("dst"))
    while True:
        step = saved(first_lists(now, k, threshold, (attempt, turn)), "knn-lists")
        while True:
            met = step.where("link").select(F.col("u").alias("src"), F.col("v").alias("dst"))
            edges = met if edges is None else edges.unionByName(met)
            lists = step.where("listed").select("u", "v", "sim", "fresh")
            size, fresh = lists.agg(F.count("*"), F.count_if("fresh")).first()
            if fresh <= SETTLED * size:
                break
            step = saved(refined(lists, now, k, threshold, near), "knn-lists")
        component = saved(connected_components(edges), "knn-components")
        full = lists.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("last")).where((F.col("n") >= k) & (F.col("last") >= threshold))
        full = saved(full.select(F.col("u").alias("node"), F.lit(True).alias("search")), "knn-full")
        if full.isEmpty():
            return component
        edges = component.select(F.col("id").alias("src"), F.col("component").alias("dst"))
        now = nodes.join(component.withColumnRenamed("id", "node"), "node", "left").join(full, "node", "left")
        now = saved(now.select(
            "grp", "node", "unit", F.coalesce("component", "node").alias("own"), F.coalesce("search", F.lit(False)).alias("search")
        ), "knn-searching")
        near = lists if near is None else near
        turn, k = turn + 1, 2 * k


def audit(nodes: DataFrame, component: DataFrame, threshold: float, attempt: int = 0) -> tuple[float, DataFrame]:
    """Share of the true links of ``AUDITED`` vectors whose ends are in one
    component, and those links (src, dst).

    The vectors are a fixed number, lowest by a hash of the attempt, and are
    sent to every task; each row of the corpus is compared with those of its
    label. ``component`` must not rest on links of an audit.
    """
    picked = nodes.orderBy(F.xxhash64("node", F.lit(5 + attempt)), "node").limit(AUDITED).toPandas()
    by_group = {g: (rows["node"].to_numpy(), _matrix(rows["unit"])) for g, rows in picked.groupby("grp")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for grp, rows in batch.groupby("grp"):
                if grp in by_group:
                    ids, x = by_group[grp]
                    a, b = np.nonzero(x @ _matrix(rows["unit"]).T >= threshold)
                    out.append(pd.DataFrame({"src": ids[a], "dst": rows["node"].to_numpy()[b]}))
            if out:
                yield pd.concat(out).query("src != dst")

    true = saved(nodes.select("grp", "node", "unit").mapInPandas(run, "src bigint, dst bigint"), "knn-audit")
    side = lambda c: component.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    both = true.join(side("src"), "src", "left").join(side("dst"), "dst", "left")
    n, found = both.agg(F.count("*"), F.count(F.when(F.col("of_src") == F.col("of_dst"), 1))).first()
    return (found / n if n else 1.0), true


def link_counts(nodes: DataFrame, component: DataFrame, threshold: float) -> DataFrame:
    """(node, links): links within each component, copies counted.

    Components are dealt into blocks of about ``BLOCK`` vectors and pairs of
    blocks are compared; only counts leave a task.
    """
    placed = nodes.join(component.withColumnRenamed("id", "node"), "node").select("node", "unit", "weight", "component")
    size = placed.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = placed.join(size, "component").withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = placed.select("component", "node", "unit", "weight", "own", other)
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def each(g: pd.DataFrame) -> tuple:
        x, ids = _matrix(g["unit"]), g["node"].to_numpy()
        weight, own = g["weight"].to_numpy(), g["own"].to_numpy()
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        low, high = g["low"].iloc[0], g["high"].iloc[0]
        if low != high:  # within a block the pair of it with itself counts
            linked &= own[:, None] != own[None, :]
        return ids, linked @ weight

    return in_groups(placed, ["component", "low", "high"], each, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def classes(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links,
    component_id, kept, recall (of the audit, the same in every row).

    Vectors with a null label, a null, zero or not finite embedding link with
    nothing and are their own component; so do rows with a null vec_id, kept
    with a null component. vec_id must otherwise be unique. Equal vectors of a
    label are one node that counts for all its copies. No rows give no rows.
    A recall below ``RECALL`` in the last attempt is an error.
    """
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    rows = saved(units(vectors), "knn-units")
    same = rows.groupBy("grp", "unit").agg(F.min("node").alias("first"), F.count("*").cast("bigint").alias("weight"))
    known = saved(rows.join(same, ["grp", "unit"]), "knn-nodes")
    nodes = known.where("node = first").dropDuplicates(["node"])
    component, audited = None, None
    for attempt in range(ATTEMPTS):
        component = components(nodes, NEIGHBOURS << attempt, threshold, attempt, component)
        recall, true = audit(nodes, component, threshold, attempt)
        audited = true if audited is None else audited.unionByName(true)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.3f} after {ATTEMPTS} attempts, {RECALL} is asked for")
    if recall < 1 or attempt:  # what audits have found besides
        held = component.select(F.col("id").alias("src"), F.col("component").alias("dst"))
        component = saved(connected_components(held.unionByName(audited)), "knn-components")
    counts = link_counts(nodes, component, threshold)
    node = known.select(F.col("node").alias("vec_id"), "first", "weight")
    node = node.join(counts.withColumnRenamed("node", "first"), "first", "left")
    node = node.join(component.withColumnRenamed("id", "first"), "first", "left")
    # Copies of a node are linked with each other too.
    n_links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    out = every.join(node.select("vec_id", n_links.alias("n_links"), F.coalesce("component", "first").alias("component_id")), "vec_id", "left")
    component_id = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(component_id).alias("kept"), F.lit(float(recall)).alias("recall"),
    )
