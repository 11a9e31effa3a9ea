"""Cross-tokenizer alignment by an associative monoid of fragments.

Two tokenizers cut the same bytes: A by the tokenizers library (byte-level
BPE), B by sentencepiece (pieces, bytes as fallback). A place where tokens of
both end closes a group; the two tokens that end there are linked.

A fragment is what a range of bytes holds: the open prefix (tokens before the
first common end, whose group may have begun earlier), the closed groups, and
the open suffix. Joining two neighbours makes the suffix of the left and the
prefix of the right one group; this is associative, so the ranges of a very
long document are tokenised in different tasks and reduced as a tree, and a
short document is one fragment.

A range is tokenised with the stretches that cross its borders, from the last
cut before to the first cut after it. A cut is a blank between two characters
that are not white space: no token of A or B reaches across the front of it
(:class:`Aligner` makes sure of B's vocabulary). So every cut is a common end,
and the groups of a text are those of its stretches in a row: stretches are
tokenised and grouped once per task, and their groups are kept.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plumbline.llm.common import give_back, per_worker, saved, stretches, taken_by

RANGE = 1 << 16  # bytes of a range
FAN = 16  # fragments that are joined at a time
MEMO = 100_000
TEXTS = 64
# New stretches that are tokenised at a time: the libraries' own results take
# far more memory than the ids that are kept of them.
LEARNT = 4096
# So many of them are one text to the libraries, which costs less than one each.
TOGETHER = 64
# Id pairs are one number: A's id times this, plus B's.
PAIR = 1 << 24
# A table of pairs up to this many rows (some 50 MB) is broadcast.
MOST_PAIRS = 1_000_000

Tokens = tuple[np.ndarray, np.ndarray]  # ids, and the places where they end
Stretch = tuple[str, bytes, int, int]  # groups as text, linked pairs as 64-bit integers, numbers of A's and of B's tokens


def byte_of() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable characters
    stand for themselves, the others for 256 and up in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens of both vocabularies, and the groups of a stretch of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are text
        table = byte_of()
        size = max(self.a.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(table[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.size_a, self.size_b = (np.array([len(t) for t in of], dtype=np.int64) for of in (self.bytes_a, self.bytes_b))
        self.spelling = [f"{i}{c}" for i in range(size) for c in ",|"] + [f"{i}{c}" for i in range(len(pieces)) for c in ",;"]
        # With a piece such as a blank after a letter, stretches would not be apart.
        self.apart = not any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces)
        self.known: dict[str, Stretch | None] = {}
        self.older: dict[str, Stretch | None] = {}
        self.large: list[str] = []

    def cuts(self, text: str) -> list[str]:
        """The text in stretches, each but the first without the blank before it."""
        return stretches(text) if self.apart else [text]

    def learn(self, wanted: set[str]) -> None:
        """Tokenise those not known yet, at one go. Long ones are kept until the
        next call, others at least until MEMO others were met."""
        for s in self.large:
            self.known.pop(s, None)
        if len(self.known) > MEMO:
            self.older, self.known = self.known, {}
        new = wanted.difference(self.known)
        met = [s for s in new if s in self.older]
        self.known.update((s, self.older[s]) for s in met)
        fresh = list(new.difference(met))
        self.large = [s for s in fresh if len(s) > 64]
        for i in range(0, len(fresh), LEARNT):
            self._tokenise(fresh[i : i + LEARNT])

    def _tokenise(self, some: list[str]) -> None:
        """Groups of each stretch; None where the tokens' bytes are not its own.
        Of many, runs go to the libraries as one text, with a blank between two:
        no token reaches across it. White space at an end could, beside that."""
        if self.apart and len(some) > TOGETHER:
            plain = [s for s in some if s and s.strip() == s]
            some = [*(s for s in some if not s or s.strip() != s), *self._in_runs(plain, TOGETHER)]
        self.known.update(dict.fromkeys(self._in_runs(some, 1)))

    def _in_runs(self, some: list[str], size: int) -> list[str]:
        """Take in stretches, so many as one text; returns those of the runs
        that are not given back, or not cut at their ends."""
        runs = [some[i : i + size] for i in range(0, len(some), size)]
        texts = [" ".join(run) for run in runs]
        data = [f" {t}".encode() for t in texts]
        of_a = [e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
        of_b = self.b.encode(texts, num_threads=1)
        fits = [
            all(b"".join(map(token.__getitem__, ids)) == d for token, ids in ((self.bytes_a, i), (self.bytes_b, j)))
            for d, i, j in zip(data, of_a, of_b)
        ]
        left = [s for run, ok in zip(runs, fits) if not ok for s in run]
        some, of_a, of_b = ([x for of, ok in zip(each, fits) if ok for x in of] for each in (runs, of_a, of_b))
        a, b = (np.array(of, dtype=np.int64) for of in (of_a, of_b))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut_a, cut_b = common_ends((a, ends_a), (b, ends_b))
        ends = np.cumsum([len(s.encode()) + 1 for s in some])
        if not np.isin(ends, ends_a[cut_a]).all():
            return left + some
        words, raw = self._words(a, cut_a, b, cut_b), paired(a[cut_a], b[cut_b]).tobytes()
        until_a, until_b = (np.concatenate([[0], np.searchsorted(e, ends) + 1]) for e in (ends_a, ends_b))
        at = (until_a + until_b).tolist()
        closed = (8 * np.concatenate([[0], np.cumsum(cut_a)])[until_a]).tolist()
        of = zip(some, at, at[1:], closed, closed[1:], np.diff(until_a).tolist(), np.diff(until_b).tolist())
        self.known.update((s, ("".join(words[i:j])[:-1], raw[k:m], n_a, n_b)) for s, i, j, k, m, n_a, n_b in of)
        return left

    def found(self, cut: list[str]) -> list[Stretch] | None:
        """Known stretches in a row; nothing if one of the tokenizers does not
        give their bytes."""
        found = [self.known[s] for s in cut]
        return None if None in found else found

    def tokens(self, cut: list[str]) -> tuple[Tokens, Tokens] | None:
        """Ids and ends of A and B for known stretches in a row, read from
        their groups; nothing if :meth:`found` has none."""
        found = self.found(cut)
        if found is None:
            return None
        groups = [g.split("|") for f in found for g in f[0].split(";")]
        both = zip((np.array(",".join(g[i] for g in groups).split(","), dtype=np.int64) for i in (0, 1)), (self.size_a, self.size_b))
        a, b = ((ids, np.cumsum(size[ids])) for ids, size in both)
        return a, b

    def spelled(self, a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray) -> str:
        """Closed groups as text: ids of A up to a cut, those of B up to its cut, and so on."""
        return "".join(self._words(a, cut_a, b, cut_b))[:-1]

    def _words(self, a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """The ids in the order of :meth:`spelled`, each with the sign after it."""
        until_a, until_b = (np.concatenate([[0], np.flatnonzero(c) + 1]) for c in (cut_a, cut_b))
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + until_b[np.cumsum(cut_a) - cut_a]] = 2 * a + cut_a
        order[np.arange(len(b)) + until_a[np.cumsum(cut_b) - cut_b + 1]] = 2 * (len(self.size_a) + b) + cut_b
        return list(map(self.spelling.__getitem__, order.tolist()))


def listed(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def common_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A and which of B end where one of the other ends."""
    return np.isin(a[1], b[1], assume_unique=True), np.isin(b[1], a[1], assume_unique=True)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) * PAIR + b


# What is known of a document or of a range of it. ``cut`` says whether a
# common end lies in the range; without one, all tokens are in the prefix.
FRAGMENT = {
    "fits": pa.bool_(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "cut": pa.bool_(),
    "pre_a": pa.string(), "pre_b": pa.string(), "groups": pa.string(), "suf_a": pa.string(), "suf_b": pa.string(),
}
NOTHING = {"fits": True, "n_a": 0, "n_b": 0, "n_groups": 0, "cut": False, "pre_a": "", "pre_b": "", "groups": "", "suf_a": "", "suf_b": ""}
FRAGMENT_DDL = "fits boolean, n_a bigint, n_b bigint, n_groups bigint, cut boolean, pre_a string, pre_b string, groups string, suf_a string, suf_b string"


def _chain(separator: str, *parts: str) -> str:
    return separator.join(p for p in parts if p)


def joined(left: dict, right: dict) -> dict:
    """The fragment of two neighbouring ranges; NOTHING is neutral."""
    out = {k: left[k] + right[k] for k in ("n_a", "n_b")}
    out |= {"fits": left["fits"] and right["fits"], "cut": left["cut"] or right["cut"], "n_groups": left["n_groups"] + right["n_groups"]}
    if not right["cut"]:
        end = ("suf_a", "suf_b") if left["cut"] else ("pre_a", "pre_b")
        more = {k: _chain(",", left[k], right[f"pre_{k[-1]}"]) for k in end}
        return {**left, **out, **more}
    if not left["cut"]:
        more = {k: _chain(",", left[k], right[k]) for k in ("pre_a", "pre_b")}
        return {**right, **out, **more}
    between = f"{_chain(',', left['suf_a'], right['pre_a'])}|{_chain(',', left['suf_b'], right['pre_b'])}"
    out |= {"n_groups": out["n_groups"] + 1, "groups": _chain(";", left["groups"], between, right["groups"])}
    return {**out, "pre_a": left["pre_a"], "pre_b": left["pre_b"], "suf_a": right["suf_a"], "suf_b": right["suf_b"]}


def finished(whole: dict) -> dict:
    """The fragment of a whole document, its prefix closed as the first group:
    the end of the text is a common end."""
    if not whole["cut"]:
        return whole
    first = f"{whole['pre_a']}|{whole['pre_b']}"
    return {**whole, "groups": _chain(";", first, whole["groups"]), "n_groups": whole["n_groups"] + 1, "pre_a": "", "pre_b": ""}


def fragment(aligner: Aligner, text: str, base: int, start: int, stop: int) -> tuple[dict, np.ndarray]:
    """Fragment and linked pairs of the bytes start to stop of a document, from
    the stretches ``text`` that cover them. ``base`` is where the blank before
    ``text`` stands. A token belongs to the range that holds its last byte."""
    cut = aligner.cuts(text)
    aligner.learn(set(cut))
    both = aligner.tokens(cut)
    if both is None:
        return {**NOTHING, "fits": False}, np.zeros(0, dtype=np.int64)
    (a, ends_a), (b, ends_b) = (_within(t, start - base, stop - base) for t in both)
    cut_a, cut_b = common_ends((a, ends_a), (b, ends_b))
    out = {**NOTHING, "n_a": len(a), "n_b": len(b), "cut": bool(cut_a.any())}
    if not out["cut"]:
        return {**out, "pre_a": listed(a), "pre_b": listed(b)}, paired(a[cut_a], b[cut_b])
    # From the first common end to the last the groups are closed.
    (i, k), (j, m) = ((at[0] + 1, at[-1] + 1) for at in (np.flatnonzero(cut_a), np.flatnonzero(cut_b)))
    out |= {"pre_a": listed(a[:i]), "pre_b": listed(b[:j]), "suf_a": listed(a[k:]), "suf_b": listed(b[m:])}
    out |= {"groups": aligner.spelled(a[i:k], cut_a[i:k], b[j:m], cut_b[j:m]), "n_groups": int(cut_a.sum()) - 1}
    return out, paired(a[cut_a], b[cut_b])


def _within(tokens: Tokens, start: int, stop: int) -> Tokens:
    ids, ends = tokens
    lo, hi = np.searchsorted(ends, [start, stop], side="right")
    return ids[lo:hi], ends[lo:hi]


def ranges(text: str, size: int, aligner: Aligner) -> Iterator[tuple[str, int, int, int]]:
    """(stretches, base, start, stop) of the byte ranges of blank + text. A
    border inside a stretch longer than a quarter of the range is left out, so
    that no long stretch is tokenised time and again."""
    cut = aligner.cuts(text)
    ends = np.cumsum([len(s.encode()) + 1 for s in cut])
    starts = np.concatenate([[0], ends[:-1]])
    total, start = int(ends[-1]), 0
    while start < total:
        stop = min(start + size, total)
        last = int(np.searchsorted(ends, stop))  # the stretch that holds the border
        if ends[last] - starts[last] > size // 4:
            stop = int(ends[last])
        first = int(np.searchsorted(ends, start, side="right"))
        yield " ".join(cut[first : last + 1]), int(starts[first]), start, stop
        start = stop


@per_worker
def aligner_of(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(pairs, return_counts=True)


PART_DDL = f"doc bigint, doc_id bigint, seq int, parts int, stretches string, base bigint, start bigint, stop bigint, {FRAGMENT_DDL}, pairs array<bigint>, times array<bigint>"
PART = pa.schema(
    [("doc", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("parts", pa.int32()), ("stretches", pa.string()), ("base", pa.int64()),
     ("start", pa.int64()), ("stop", pa.int64()), *FRAGMENT.items(), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def _parts(docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    """A row per short document, aligned, and a row per range of a long one, to
    be aligned. ``doc`` numbers the documents, whatever their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken_by(aligner_of.__module__)
        aligner = aligner_of(path_a, path_b)
        number = TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in (whole.slice(i, TEXTS) for i in range(0, whole.num_rows, TEXTS)):
                rows = []
                texts = ["" if t is None else t for t in batch["text"].to_pylist()]
                short = [aligner.cuts(t) if t and len(t.encode()) < size else None for t in texts]
                aligner.learn({s for cut in short if cut for s in cut})
                for doc_id, text, whole_cut in zip(batch["doc_id"].to_pylist(), texts, short):
                    number += 1
                    row = {"doc": number, "doc_id": doc_id, "seq": 0, "parts": 1, **NOTHING, "pairs": [], "times": []}
                    if whole_cut:
                        row |= _aligned_text(aligner, whole_cut)
                    elif text:
                        several = list(ranges(text, size, aligner))
                        for seq, (cut, base, start, stop) in enumerate(several):
                            rows.append({**row, "seq": seq, "parts": len(several), "stretches": cut, "base": base, "start": start, "stop": stop})
                        continue
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=PART)
            give_back()

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return named.mapInArrow(run, PART_DDL)


def _aligned_text(aligner: Aligner, cut: list[str]) -> dict:
    """Row of a document that is one range: its end is a common end."""
    found = aligner.found(cut)
    if found is None:
        return {"fits": False}
    groups, raw, n_a, n_b = zip(*found)
    linked = np.frombuffer(b"".join(raw), dtype=np.int64)
    pairs, times = _counted(linked)
    return {"n_a": sum(n_a), "n_b": sum(n_b), "cut": True, "groups": ";".join(groups), "n_groups": len(linked), "pairs": pairs, "times": times}


def _reduced(fragments: DataFrame, rounds: int) -> DataFrame:
    """One row per long document: its fragments joined FAN at a time."""
    names = list(NOTHING)

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        out = NOTHING
        for row in group.sort_values("seq")[names].to_dict("records"):
            out = joined(out, row)
        first = group.iloc[0]
        return pd.DataFrame([{"doc": first["doc"], "seq": first["seq"] // FAN, **out}])

    schema = f"doc bigint, seq int, {FRAGMENT_DDL}"
    now = fragments.select("doc", "seq", *names)
    for _ in range(rounds):
        now = saved(now.groupBy("doc", F.floor(F.col("seq") / FAN).alias("of")).applyInPandas(fold, schema), "fragments")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{**r, **finished({n: r[n] for n in names})} for r in batch.to_dict("records")]
            yield pd.DataFrame(rows, columns=batch.columns)

    return now.mapInPandas(close, schema)


def align(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, groups_sha256, n_links, n_best,
    count_sum) per row of docs (doc_id, text); other columns are ignored.

    ``groups`` spells the groups, ``a1,a2|b1;a3|b2`` with A's and B's ids; the
    digest of none is empty. Who takes only the digest does not move them. A
    link is a pair of tokens that end together; the count of its ids is the
    number of links of the whole corpus with them. ``n_best`` counts the links
    whose count is the highest of all with their B id, ``count_sum`` adds the
    counts up. A null or empty text, and one that either tokenizer does not
    give back, has no tokens: zeros and no groups. Rows that repeat an id, and
    those with a null one, are documents of their own.
    """
    first = saved(_parts(docs, path_a, path_b, size), "aligned")
    done, long = first.where("stretches IS NULL"), first.where("stretches IS NOT NULL")
    most = long.agg(F.max("parts")).first()[0]
    names = ["doc", "doc_id", *NOTHING]
    if most:
        pieces = saved(_fragments(long, path_a, path_b), "pieces")
        rounds = 1
        while FAN**rounds < most:
            rounds += 1
        whole = saved(_reduced(pieces, rounds), "whole")
        every = done.select(*names).unionByName(whole.join(long.where("seq = 0").select("doc", "doc_id"), "doc").select(*names))
        broken = whole.where("NOT fits").select("doc")
        links = done.where("fits").select("doc", "pairs", "times").unionByName(
            pieces.join(broken, "doc", "left_anti").select("doc", "pairs", "times"))
    else:
        every, links = done.select(*names), done.where("fits").select("doc", "pairs", "times")
    each = links.select("doc", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("doc", "l.pairs", "l.times")
    return _with_counts(every, each)


def _fragments(long: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Fragment and pairs of each range, the ranges spread over all tasks."""
    out = pa.schema([PART.field(n) for n in ("doc", "seq", *NOTHING, "pairs", "times")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        for batch in batches:
            for r in batch.to_pylist():
                part, pairs = fragment(aligner, r["stretches"], r["base"], r["start"], r["stop"])
                ids, times = _counted(pairs)
                row = {"doc": r["doc"], "seq": r["seq"], **part, "pairs": ids, "times": times}
                yield pa.RecordBatch.from_pylist([row], schema=out)

    schema = f"doc bigint, seq int, {FRAGMENT_DDL}, pairs array<bigint>, times array<bigint>"
    return long.repartition("doc", "seq").mapInArrow(run, schema)


def _with_counts(every: DataFrame, each: DataFrame) -> DataFrame:
    """Add the links' counts over the corpus to the documents."""
    counts = saved(each.groupBy("pairs").agg(F.sum("times").alias("count")), "pair-counts")
    of_b = F.col("pairs") % PAIR
    best = counts.groupBy(of_b.alias("b")).agg(F.max("count").alias("most"))
    known = saved(counts.join(best, of_b == F.col("b")).select("pairs", "count", (F.col("count") == F.col("most")).alias("best")), "pair-ranks")
    if known.count() <= MOST_PAIRS:
        known = F.broadcast(known)
    sums = each.join(known, "pairs").groupBy("doc").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    kept = [F.when(F.col("fits"), F.col(n)).otherwise(0).alias(n) for n in ("n_a", "n_b", "n_groups")]
    groups = F.when(F.col("fits"), F.col("groups")).otherwise("")
    digest = F.when(groups != "", F.sha2(groups, 256)).otherwise("")
    every = every.select("doc", "doc_id", *kept, groups.alias("groups"), digest.alias("groups_sha256"))
    added = [F.coalesce(n, F.lit(0)).alias(n) for n in ("n_links", "n_best", "count_sum")]
    return every.join(sums, "doc", "left").select("doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256", *added)
