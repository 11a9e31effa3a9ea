"""Byte-level BPE by backtracking over longest matches, and decoding.

The vocabulary is a rank file (base64 token, rank per line). Bytes are mapped
to Latin-1 so that an Aho-Corasick automaton finds the tokens at every place.
Encoding takes the longest token at each place and steps back to a shorter
one, or to the token before, when two neighbours are not compatible: they are
when merging their bytes by rank leaves the border between them. Tokens all
of whose neighbours are compatible are the exact merges. Compatibility is
memoised, and a place that failed is not entered twice, so the time is linear
in the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame

from plumbline.llm.common import per_text, per_worker, stretches

# Entries that one Python worker keeps; a full memo is emptied.
MEMO = 150_000
# Stretches in each of a worker's two generations, some 250 bytes each: fewer
# are met again after they went.
STRETCHES = 300_000


class Encoder:
    """Exact BPE of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.parts = self._parts()
        self.automaton = ahocorasick.Automaton()
        for rank, token in self.tokens.items():
            if len(token) == 1 or rank in self.parts:
                self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.key = max(self.tokens) + 1
        self.lengths = [len(self.tokens.get(rank, b"")) for rank in range(self.key)]
        self.pairs: dict[int, bool] = {}
        self.shorter_of: dict[int, int | None] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _parts(self) -> dict[int, tuple[int, int]]:
        """The two tokens whose merge makes each token. Tokens that no merge
        makes have none; they are used only for a whole piece."""
        parts = {}
        for token, rank in self.ranks.items():
            if len(token) > 1:
                left = merged(token, self.ranks, rank)
                if len(left) == 2:
                    parts[rank] = (self.ranks[left[0]], self.ranks[left[1]])
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves the border between them.

        Undoes merges along the border, the latest first, and asks each time
        whether the two tokens now at the border would have been merged
        before the merge just undone.
        """
        key = left * self.key + right
        known = self.pairs.get(key)
        if known is not None:
            return known
        result, limit = True, 1 << 60
        while True:
            joint = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joint is not None and joint < limit:
                result = False
                break
            # Of the two, the one merged later is undone; a byte cannot be.
            undo_left = left in self.parts and (left > right or right not in self.parts)
            if undo_left:
                limit = left
                left = self.parts[left][1]
            elif right in self.parts:
                # At equal ranks the merge on the left comes first.
                limit = right + 1
                right = self.parts[right][0]
            else:
                break
        if len(self.pairs) >= 4 * MEMO:
            self.pairs.clear()
        self.pairs[key] = result
        return result

    def shorter(self, rank: int) -> int | None:
        """The longest token that is a proper prefix of a token."""
        if rank not in self.shorter_of:
            token = self.tokens[rank]
            cuts = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter_of[rank] = next((r for r in cuts if r is not None and (r in self.parts or len(self.tokens[r]) == 1)), None)
        return self.shorter_of[rank]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, pairs, key_of = len(piece), self.lengths, self.pairs, self.key
        # Matches come by their end, so the last with a start is the longest.
        at = [0] * size
        for end, (more, rank) in self.automaton.iter(piece.decode("latin-1")):
            at[end - more] = rank
        open_place = [True] * (size + 1)
        out: list[int] = []
        place, rank = 0, at[0]
        while True:
            end = place + lengths[rank]
            if open_place[end]:
                if out:
                    fits = pairs.get(out[-1] * key_of + rank)
                    if fits is None:
                        fits = self.compatible(out[-1], rank)
                if not out or fits:
                    out.append(rank)
                    if end == size:
                        return out
                    place, rank = end, at[end]
                    continue
            less = self.shorter(rank)
            while less is None:
                # Nothing fits here: close the place and shorten the token before.
                open_place[place] = False
                rank = out.pop()
                place -= lengths[rank]
                less = self.shorter(rank)
            rank = less

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self.pattern.findall(text):
            ids += self.piece(piece)
        return ids

    def piece(self, piece: str) -> tuple[int, ...]:
        got = self.pieces.get(piece)
        if got is None:
            got = tuple(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
            if len(piece) <= 64:
                if len(self.pieces) >= MEMO:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def merged(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Bytes of a token after all merges of a rank below ``below``."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        joint = [ranks.get(parts[i] + parts[i + 1], below) for i in range(len(parts) - 1)]
        low = min(joint)
        if low >= below:
            break
        i = joint.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Words:
    """What is kept of a stretch of text between single blanks: its ids, and of
    them their number, their decimal list and the bytes they decode to. The
    pattern never matches across such a blank, so each is encoded alone.

    Two generations of up to STRETCHES: one met again moves on.
    """

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def spelled(self, text: str) -> list[tuple[int, str, bytes]]:
        """(number, decimal list, bytes) of each stretch of a text that has ids."""
        first, *rest = stretches(text)
        wanted = [first, *(" " + s for s in rest)]
        found = list(map(self.known.get, wanted))
        for i in [i for i, got in enumerate(found) if got is None]:
            found[i] = self._one(wanted[i])
        return found

    def _one(self, stretch: str) -> tuple[int, str, bytes]:
        got = self.known.get(stretch)
        if got is None:
            got = self.older.get(stretch)
            if got is None:
                ids = self.encoder.encode(stretch)
                got = (len(ids), ",".join(map(str, ids)), self.encoder.decode(ids))
            if len(stretch) <= 64:
                if len(self.known) >= STRETCHES:
                    self.older, self.known = self.known, {}
                self.known[stretch] = got
        return got


@per_worker
def encoder(path: str, pattern: str) -> tuple[Encoder, Words]:
    """One per Python worker and vocabulary."""
    own = Encoder(path, pattern)
    return own, Words(own)


def text_ids(text: str, own: Encoder, words: Words) -> list[int]:
    return [int(i) for _, listed, _ in words.spelled(text) if listed for i in listed.split(",")]


def encode_documents(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of docs (doc_id,
    text); the columns ``keep`` come along after doc_id.

    Null texts count as empty: no ids, the digests of nothing. Texts are read
    whole; a batch of Arrow rows at a time is in memory. The ids of every
    stretch are decoded again through the token table; the bytes of a text are
    those of its stretches in a row, and are digested.
    """
    def start():
        own, words = encoder(path, pattern)

        def values(texts: list[str]) -> list:
            sizes, listed, data = [], [], []
            for text in texts:
                parts = [p for p in words.spelled(text) if p[0]]
                counts, spelled, raw = zip(*parts) if parts else ((), (), ())
                sizes.append(sum(counts))
                listed.append(hashlib.sha256(",".join(spelled).encode()).hexdigest())
                data.append(hashlib.sha256(b"".join(raw)).hexdigest())
            return [sizes, listed, data]

        return values

    return per_text(docs, ["doc_id", *keep], {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, start)


def token_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) per row: the ids themselves."""
    def start():
        own, words = encoder(path, pattern)
        return lambda texts: [[text_ids(t, own, words) for t in texts]]

    return per_text(docs, ["doc_id"], {"ids": "array<int>"}, start)


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data): the bytes of (doc_id, ids)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, _ = encoder(path, pattern)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].values, "data": [own.decode(x) for x in batch["ids"]]})

    return ids.mapInPandas(run, "doc_id bigint, data binary")
