"""Toxicity by a subsequence string-kernel support vector machine.

The kernel of two words sums, over all sequences of three letters, the product
of how often and how tightly each word holds them: a sequence spread over s
places counts DECAY**s, up to SPAN places. Letters may stand between those of
an insult, and marks that are not letters are only gaps, so gapped and
inserted-character spellings stay near. A sentence is a bag of words and is as
toxic as its worst word; the machine is trained on sentences of labelled
documents (multiple-instance training: in toxic documents the sentence that
scores worst is the witness and is chosen anew each round).

Words are mapped by Nyström features of landmark words, and the machine is
linear in them. Its decision function is then a sum over letter sequences, so
it folds into one table of weights: scoring a word is a sum of table entries,
the same value as going through the landmarks.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import per_text, whole_text

SPAN, DECAY = 6, 0.6
LETTERS = 64
SHORT = 3 * DECAY**6  # added to a word's squared norm: words of few letters say little
WINDOW, STRIDE = 30, 24  # longer words are read in windows that share more than SPAN places
MEMO = 250_000

# Labelled rows per class that the machine is fitted on, by hash of doc_id.
SAMPLE_PER_CLASS = 2000
LANDMARKS, NEGATIVES, ROUNDS = 256, 16_000, 3

SENTENCE = re.compile(r"[.!?]+\s|\n+")
# Letters spelled apart, at least four in a row: by blanks, by marks and digits, by any of them.
APART = (
    re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){3,}"),
    re.compile(r"[^\W\d_](?:(?:[^\w\s]|[\d_])+[^\W\d_]){3,}"),
    re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\W\d_]+[^\W\d_](?![^\W\d_])){3,}"),
)
# Runs of marks and digits between letters: a gap counts as one place, however wide.
GAP = re.compile(r"(?<=[^\W\d_])(?:[^\w\s]|[\d_]){2,}(?=[^\W\d_])")


@lru_cache(maxsize=None)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all triples within SPAN in a word of a length, and their weights."""
    ijk = [(i, j, k) for i in range(length) for j in range(i + 1, length) for k in range(j + 1, min(length, i + SPAN))]
    ijk = np.array(ijk, dtype=np.int64).reshape(-1, 3)
    return ijk.T, (DECAY ** (ijk[:, 2] - ijk[:, 0] + 1)).astype(np.float32)


class _Codes(dict):
    """Code of a character: 1-26 for a-z, 27-62 for other letters, 0 else."""

    def __missing__(self, c: int) -> int:
        ch = chr(c)
        code = c - 96 if "a" <= ch <= "z" else 27 + c % 36 if ch.isalpha() else 0
        self[c] = code
        return code


_CODES = _Codes()


def _coded(words: list[str]) -> np.ndarray:
    """Codes of words of one length, with 63 at both ends."""
    n = len(words[0])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), n)
    kinds, inverse = np.unique(points, return_inverse=True)
    codes = np.array([_CODES[int(k)] for k in kinds], dtype=np.int64)[inverse].reshape(points.shape)
    edge = np.full((len(words), 1), 63)
    return np.hstack([edge, codes, edge])


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ids and normalised weights of words of one length; weight 0 where a place is no letter."""
    (i, j, k), weight = _triples(codes.shape[1])
    a, b, c = codes[:, i], codes[:, j], codes[:, k]
    weight = np.where((a > 0) & (b > 0) & (c > 0), weight, 0).astype(np.float32)
    size = np.sqrt((weight**2).sum(axis=1, keepdims=True) + SHORT)
    return (a * LETTERS + b) * LETTERS + c, weight / size


def _by_length(words: list[str], limit: int = 1024) -> Iterator[list[int]]:
    """Positions of words in groups of one length."""
    groups: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        groups.setdefault(len(word), []).append(at)
    for group in groups.values():
        for start in range(0, len(group), limit):
            yield group[start : start + limit]


def score_words(words: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision value of each word; of a long one, the largest of its windows."""
    pieces, owner = [], []
    for at, word in enumerate(words):
        if len(word) <= WINDOW:
            pieces.append(word)
            owner.append(at)
        else:
            for start in range(0, len(word) - WINDOW + STRIDE, STRIDE):
                pieces.append(word[start : start + WINDOW])
                owner.append(at)
    value = np.zeros(len(pieces), dtype=np.float32)
    for group in _by_length(pieces):
        if not pieces[group[0]]:
            continue
        ids, weight = _features(_coded([pieces[g] for g in group]))
        value[group] = (weights[ids] * weight).sum(axis=1)
    out = np.full(len(words), -np.inf, dtype=np.float32)
    np.maximum.at(out, np.array(owner, dtype=np.int64), value)
    return out + np.float32(bias)


def words_of(text: str) -> set[str]:
    """Distinct words between white space, lower case, also with wide gaps as
    narrow ones, and letters spelled apart as one word."""
    low = text.lower()
    words = set(low.split())
    squeezed, wide = GAP.subn(".", low)
    if wide:
        words.update(squeezed.split())
    for apart in APART:
        for run in apart.findall(low):
            words.add("".join(filter(str.isalpha, run)))
    return words


def sentences_of(text: str) -> list[str]:
    return [s for s in SENTENCE.split(text) if s and not s.isspace()]


@dataclass(frozen=True)
class Machine:
    """weights and bias give a word's decision value; slope and offset turn the
    largest of a document into a probability. Without labelled rows of both
    classes it scores every text 0."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    fitted: bool = True

    def probability(self, value: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(value))
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.offset, -50, 50)))


NOTHING = Machine(np.zeros(LETTERS**3, dtype=np.float32), 0.0, 0.0, 0.0, False)


def _kernel(words: list[str], landmarks: dict) -> np.ndarray:
    """Kernel of words with the landmarks."""
    row_of, table = landmarks["row_of"], landmarks["table"]
    out = np.zeros((len(words), table.shape[1]), dtype=np.float32)
    for group in _by_length(words, 512):
        ids, weight = _features(_coded([words[g] for g in group]))
        rows = row_of[ids]
        for t in range(ids.shape[1]):
            out[group] += weight[:, t : t + 1] * table[rows[:, t]]
    return out


def _landmark_table(landmarks: list[str]) -> dict:
    entries: dict[int, dict[int, float]] = {}
    for at, word in enumerate(landmarks):
        ids, weight = _features(_coded([word]))
        for i, w in zip(ids[0].tolist(), weight[0].tolist()):
            if w:
                row = entries.setdefault(i, {})
                row[at] = row.get(at, 0.0) + w
    row_of = np.zeros(LETTERS**3, dtype=np.int64)
    table = np.zeros((len(entries) + 1, len(landmarks)), dtype=np.float32)
    for r, (i, row) in enumerate(sorted(entries.items()), 1):
        row_of[i] = r
        for at, w in row.items():
            table[r, at] = w
    return {"row_of": row_of, "table": table, "ids": np.array([0, *sorted(entries)])}


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine of squared hinge loss, by Newton steps on the primal. Rows
    become doubles a block at a time."""
    size = z.shape[1] + 1
    w = np.zeros(size)
    keep = np.full(size, ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        square, right = np.diag(keep), np.zeros(size)
        for at in range(0, len(z), 2048):
            block, target = np.ones((len(z[at : at + 2048]), size)), y[at : at + 2048]
            block[:, :-1] = z[at : at + 2048]
            inside = target * (block @ w) < 1
            block, target = block[inside], target[inside]
            part = block * cost[at : at + 2048][inside, None]
            square += part.T @ block
            right += part.T @ target
        new = np.linalg.solve(square, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability."""
    a, b = 1.0, 0.0
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.full(len(y), 1.0 / len(y))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * value + b, -50, 50)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * value).sum() + 1e-4 * a, g.sum()])
        hess = np.array([[(h * value * value).sum() + 1e-4, (h * value).sum()], [(h * value).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 1e-3), b


def _distinct(bags: list[tuple[int, list[list[str]]]]) -> list[tuple[int, list[list[str]]]]:
    """Bags without near copies, whose words would pass for striking: of those
    that agree in label and in the least of two hashes of their words, one."""
    first = {}
    for label, sentences in bags:
        words = [w.encode("utf-8", "surrogatepass") for s in sentences for w in s]
        least = tuple(min((zlib.crc32(w, salt) for w in words), default=0) for salt in (1, 2))
        first.setdefault((label, least), (label, sentences))
    return list(first.values())


def runs(word: str) -> set[str]:
    """Runs of four letters, ends marked."""
    marked = f"^{word}$"
    return {marked[i : i + 4] for i in range(max(1, len(marked) - 3))}


def spelled_apart(word: str) -> list[str]:
    """A word as it may be disguised: marks between its letters, a mark for a
    letter or beside one, a letter put in."""
    inner = range(1, len(word))
    out = [".".join(word)]
    out += [word[:i] + "*" + word[i:] for i in inner] + [word[:i] + "x" + word[i:] for i in inner]
    return out + [word[:i] + "*" + word[i + 1 :] for i in range(1, len(word) - 1)]


def fit(bags: list[tuple[int, list[list[str]]]]) -> Machine:
    """Machine of (label, words of each sentence) per document."""
    y = np.array([label for label, _ in bags])
    if not len(y) or y.min() == y.max():
        return NOTHING
    # Words longer than a window are scored by their windows, but not learned from.
    bags = [(label, [[w for w in s if len(w) <= WINDOW] for s in sentences]) for label, sentences in bags]
    held = np.arange(len(bags)) % 4 == 3  # for the probability only
    if not 0 < y[held].sum() < held.sum() or len(bags) < 40:
        held[:] = False
    train = _distinct([b for b, h in zip(bags, held) if not h])
    seen = [{}, {}]
    for label, sentences in train:
        for word in {w for s in sentences for w in s}:
            seen[label][word] = seen[label].get(word, 0) + 1
    n = [sum(label == c for label, _ in train) for c in (0, 1)]
    if not all(n):
        return NOTHING

    # Letter runs are shared by words of one stem, so they tell more from few documents.
    # Of clean documents only the runs that toxic ones have are counted.
    run_seen = [{}, {}]
    for label in (1, 0):
        for one, sentences in train:
            if one == label:
                for run in set().union(*(runs(w) for w in {w for s in sentences for w in s})):
                    if label or run in run_seen[1]:
                        run_seen[label][run] = run_seen[label].get(run, 0) + 1

    def lean(counts: list[dict], key: str) -> float:
        up, down = counts[1].get(key, 0), counts[0].get(key, 0)
        return np.log((up + 0.5) / (n[1] + 1)) - np.log((down + 0.5) / (n[0] + 1)) + 0.05 * min(up, 20)

    run_lean = {r: lean(run_seen, r) for r in run_seen[1]}

    def skew(word: str) -> float:
        return lean(seen, word) + max((run_lean.get(r, -9.0) for r in runs(word)), default=-9.0)

    clean = sorted(seen[0], key=lambda w: (-seen[0][w], w))
    striking = sorted((w for w in seen[1] if seen[1][w] >= 2 or n[1] < 8), key=lambda w: (-skew(w), w))[: LANDMARKS * 5 // 8]
    step = max(1, len(clean) // NEGATIVES)
    negatives = set(clean[: NEGATIVES // 3]) | set(clean[::step][:NEGATIVES])
    landmarks = list(dict.fromkeys(striking + clean[: LANDMARKS - len(striking)]))
    spec = _landmark_table(landmarks)
    k = _kernel(landmarks, spec).astype(np.float64)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    good = values > 1e-4 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])

    known: dict[str, int] = {}
    mapped = np.zeros((0, int(good.sum())), dtype=np.float32)

    def nystroem(words: list[str]) -> np.ndarray:
        nonlocal mapped
        new = [w for w in dict.fromkeys(words) if w not in known]
        known.update((w, len(mapped) + i) for i, w in enumerate(new))
        if new:
            mapped = np.vstack([mapped, _kernel(new, spec) @ whiten.astype(np.float32)])
        return mapped[[known[w] for w in words]]

    toxic = [sentences for label, sentences in train if label]
    vocabulary = list(dict.fromkeys([*seen[1], *seen[0]]))
    at_of = {w: i for i, w in enumerate(vocabulary)}
    value_of = array("d", (skew(w) for w in seen[1]))  # of toxic words, which come first
    known_clean = np.fromiter((w in seen[0] for w in vocabulary), dtype=bool, count=len(vocabulary))
    for _ in range(ROUNDS):
        # Witnesses: the worst sentence of each toxic document, its worst word.
        witnesses: dict[str, float] = {}
        for sentences in toxic:
            worst = max((w for s in sentences for w in s), key=lambda w: (value_of[at_of[w]], w), default=None)
            if worst is not None:
                witnesses[worst] = witnesses.get(worst, 0) + 1
        for w in striking:  # words as striking as a witness
            if seen[0].get(w, 0) == 0 and seen[1][w] >= max(3, 0.015 * n[1]):
                witnesses[w] = witnesses.get(w, 0) + seen[1][w]
        plain = [w for w in witnesses if w not in seen[0]] or list(witnesses)
        disguised = {d: witnesses[w] / 16 for w in plain if witnesses[w] >= max(2, 0.005 * n[1]) and len(w) > 3 for d in spelled_apart(w)}
        disguised = {d: v for d, v in disguised.items() if d not in seen[0] and d not in witnesses}
        positive = plain + list(disguised)
        negative = sorted(negatives - set(positive))
        z = nystroem(positive + negative)
        target = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        share = np.sqrt([witnesses.get(w) or disguised[w] for w in positive])
        cost = np.concatenate([share * (len(negative) / max(1.0, share.sum())) * 0.5, np.ones(len(negative))])
        w, bias = _svm(z, target, cost)
        per_landmark = (whiten @ w).astype(np.float32)
        weights = np.zeros(LETTERS**3, dtype=np.float32)
        weights[spec["ids"]] = spec["table"] @ per_landmark
        weights[0] = 0
        machine = (weights, bias)
        scored = score_words(vocabulary, *machine).astype(np.float64)
        negatives |= set(heapq.nsmallest(NEGATIVES // 10, seen[0], key=lambda x: (-scored[at_of[x]], x)))
        value_of = array("d", (scored - 4.0 * known_clean).tobytes())
    scale = [b for b, h in zip(bags, held) if h] if held.any() else bags
    worst = np.array([max(score_words(words, *machine).tolist(), default=machine[1]) for words in (sorted({w for s in of for w in s}) for _, of in scale)])
    slope, offset = _platt(worst, np.array([label for label, _ in scale]))
    return Machine(*machine, slope, offset)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Fit on at most ``per_class`` labelled documents of each class.

    Labels are read only of rows whose crc32(doc_id as text) mod 5 is not 0.
    The sample, ids first by hash and then their texts, is the only thing that
    reaches the driver, split into words of sentences; its size is fixed and
    does not grow with the corpus. Null labels and ids are left out; an id
    labelled twice counts as toxic if one label says so.
    """
    open_rows = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    known = labels.where(F.col("toxic").isNotNull() & open_rows).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = None
    for label in (0, 1):
        one = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    ids = [(r[0], r[1]) for r in picked.collect()]  # at most 2 * per_class ids
    if not ids:
        return NOTHING
    few = F.broadcast(docs.sparkSession.createDataFrame(ids, "doc_id bigint, toxic int"))  # bounded as above
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).join(few, "doc_id")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "toxic": batch["toxic"],
                "sentences": [[" ".join(sorted(words_of(s))) for s in sentences_of(t)] for t in batch["text"]],
            })

    rows = sample.mapInPandas(split, "doc_id bigint, toxic int, sentences array<string>")
    # Sorted, which spreads both classes over the held part. One object per distinct word.
    known: dict[str, str] = {}
    bags = sorted(
        ((r["toxic"], r["doc_id"], [[known.setdefault(w, w) for w in s.split(" ")] for s in r["sentences"]]) for r in rows.toLocalIterator()),
        key=lambda b: b[:2],
    )
    return fit([(toxic, sentences) for toxic, _, sentences in bags])


def scores(docs: DataFrame, machine: Machine, name: str = "toxic_score") -> DataFrame:
    """docs (text, other columns kept) with ``toxic_score``, or another name, from 0 to 1.

    Whole texts are read; null and empty texts score 0 words and so the least
    score. Values of words are kept per Python worker; the memory is bounded
    and does not change a score.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)  # one table of fixed size

    def start():
        m, memo = model.value, {}

        def values(texts: list[str]) -> list:
            bags = [words_of(t) for t in texts]
            worst = np.full(len(bags), -np.inf)
            start = 0
            while start < len(bags):
                # A few texts at a time, so that new words are scored together.
                end, fresh = start, set()
                while end < len(bags) and len(fresh) < 50_000:
                    fresh |= bags[end].difference(memo)
                    end += 1
                if len(memo) + len(fresh) > MEMO:
                    memo.clear()
                    fresh = set().union(*bags[start:end])
                fresh = list(fresh)
                memo.update(zip(fresh, score_words(fresh, m.weights, m.bias).tolist()))
                for at in range(start, end):
                    worst[at] = max(map(memo.__getitem__, bags[at]), default=m.bias - 1.0)
                start = end
            return [m.probability(worst)]

        return values

    return per_text(docs, docs.columns, {name: "double"}, start)
