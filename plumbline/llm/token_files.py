"""Token ids in binary blocks: frequency ranks in byte-aligned variable-length
coding with separate control bytes.

Ids are replaced by their rank of frequency over the whole corpus, so common
ids take one byte. Each id has a two-bit length in the control bytes (four ids
to a byte) and one to four little-endian bytes in the data. Decoding looks the
lengths of four ids up by their control byte.

A folder holds ``ranks`` (rank, id) and ``blocks``, Parquet written and
committed by Spark: file, block, docs (number of documents), ids (number of
ids), doc_ids (int64), lengths (uint32 coded like the ids), control, data.
Files and blocks ascend with doc_id.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from plumbline.llm.common import ARROW, per_text, per_worker, saved

MEMO = 400_000
BLOCK_IDS = 1 << 18

# Lengths of four ids by control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned integers below 2**32."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    codes[: len(values)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    values = np.zeros((n, 4), dtype=np.uint8)
    values[np.arange(4) < size[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return values.reshape(-1).view("<u4")


class Words(dict):
    """Ids (little-endian bytes) of a stretch of text between white space. The
    tokenizer drops white space and never joins tokens across it, so each
    stretch is encoded alone by the library, and known ones at once.

    In a stretch of Latin letters and marks the library's normaliser only
    changes case, and its splitting pattern gives pieces that its model
    encodes one by one; those too are kept.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.type = id_type(self.tokenizer)
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in (*range(0x21, 0x7F), *range(0xA1, 0x180))}
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        pieces = self.pieces
        if (stretch.isascii() and stretch.isprintable()) or LATIN.fullmatch(stretch):
            low = stretch.lower()
            if low.isalpha():
                ids = pieces.get(low) or self.piece(low)
            elif low[-1] in ".,;:!?" and low[:-1].isalpha():
                ids = (pieces.get(low[:-1]) or self.piece(low[:-1])) + (pieces.get(low[-1]) or self.piece(low[-1]))
            else:
                ids = b"".join([pieces.get(p) or self.piece(p) for p in self.split(low)])
        else:
            ids = self.encode(stretch)
        if len(stretch) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[stretch] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        ids = self.packed([t.id for t in self.model.tokenize(piece.translate(self.bytes_of))])
        if len(piece) <= 64:
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def packed(self, ids: list[int]) -> bytes:
        return array(self.type, ids).tobytes()

    def encode(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def id_type(tokenizer: Tokenizer) -> str:
    """Two bytes for an id while the vocabulary allows, else four."""
    return "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I"


@per_worker
def words_of(path: str) -> Words:
    """One per Python worker and vocabulary."""
    return Words(path)


# Lower case is letter by letter here, and no normal form changes it.
LATIN = re.compile("[\x21-\x7E\xA1-\u012F\u0131-\u017F]{1,200}")

# White space to str.split, but not to the tokenizer; and how its special tokens begin.
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def text_ids(text: str, words: Words) -> bytes:
    if any(odd in text for odd in ODD):
        return words.encode(text)
    return b"".join(map(words.__getitem__, text.split()))


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids): ids of each whole text and the end id, as bytes (``id_type``). Null texts count as empty."""
    def start():
        words = words_of(path)
        end = words.packed([end_id])
        return lambda texts: [[text_ids(t, words) + end for t in texts]]

    return per_text(docs, ["doc_id"], {"ids": "binary"}, start)


def rank_table(ids: DataFrame, kind: str) -> DataFrame:
    """(rank, id) by falling number of uses over all documents; one row per id in use, so bounded by the vocabulary."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for data in batch["ids"]:
                count = np.bincount(np.frombuffer(data, dtype=kind))
                if len(count) > len(total):
                    count[: len(total)] += total
                    total = count
                else:
                    total[: len(count)] += count
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "uses": total[used]})

    uses = ids.select("ids").mapInPandas(run, "id bigint, uses bigint").groupBy("id").agg(F.sum("uses").alias("uses"))
    rank = F.row_number().over(Window.orderBy(F.desc("uses"), "id")) - 1
    return uses.select(rank.cast("bigint").alias("rank"), "id")


BLOCKS = "file int, block int, docs int, ids bigint, doc_ids binary, lengths_control binary, lengths binary, control binary, data binary"


def write(ids: DataFrame, kind: str, folder: str) -> None:
    """Write (doc_id, ids) to ``folder``; ``kind`` is the type of the ids.
    ``ids`` is read twice: pass a written table.

    Documents are range partitioned by doc_id; one file per partition, blocks
    of about ``BLOCK_IDS`` ids, a document whole in one block. Null ids come
    first, repeated ids follow each other.
    """
    rank_table(ids, kind).coalesce(1).write.parquet(f"{folder}/ranks")
    _, of_id = _ranks(ids.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kept, n = 0, [], 0

        def flush():
            names = np.array([-1 if i is None else i for i, _ in kept], dtype="<i8")
            null = np.packbits(np.array([i is None for i, _ in kept])).tobytes()
            flat = np.frombuffer(b"".join(d for _, d in kept), dtype=kind)
            lengths = pack(np.array([len(d) // width for _, d in kept], dtype=np.uint32))
            row = (0, block, len(kept), len(flat), names.tobytes() + null, *lengths, *pack(of_id[flat]))
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, types)], names=columns)

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kept.append(row)
                n += len(row[1]) // width
                if n >= BLOCK_IDS:
                    yield flush()
                    block, kept, n = block + 1, [], 0
        if kept:
            yield flush()

    columns = [c.split()[0] for c in BLOCKS.split(", ")]
    width = np.dtype(kind).itemsize
    types = [ARROW[c.split()[1]] for c in BLOCKS.split(", ")]
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    placed.mapInArrow(run, BLOCKS).withColumn("file", F.spark_partition_id()).write.parquet(f"{folder}/blocks")


def _ranks(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Id by rank, and rank by id. One row per id in use: bounded by the vocabulary."""
    table = spark.read.parquet(f"{folder}/ranks").toPandas()
    by_rank = np.zeros(len(table), dtype=np.uint32)
    by_rank[table["rank"]] = table["id"]
    by_id = np.zeros(int(table["id"].max()) + 1 if len(table) else 0, dtype=np.uint32)
    by_id[table["id"]] = table["rank"]
    return by_rank, by_id


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    Starts add up the id counts of files, then of blocks within a file; only
    those counts are windowed, one row per file and per block.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    by_rank, _ = _ranks(spark, folder)
    counts = blocks.select("file", "block", "ids")
    files = counts.groupBy("file").agg(F.sum("ids").alias("ids"))
    past = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(past), F.lit(0)).alias("file_start"))
    within = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("block_start"))
    starts = starts.join(files, "file").select("file", "block", (F.col("file_start") + F.col("block_start")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                names = np.frombuffer(b["doc_ids"][: 8 * b["docs"]], dtype="<i8")
                null = np.unpackbits(np.frombuffer(b["doc_ids"][8 * b["docs"] :], dtype=np.uint8), count=b["docs"]).astype(bool)
                sizes = unpack(b["lengths_control"], b["lengths"], b["docs"]).astype(np.int64)
                flat = by_rank[unpack(b["control"], b["data"], b["ids"])].astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(flat[4 * (e - s) : 4 * e]) for s, e in zip(sizes, ends)]
                columns = [pa.array(names, mask=null), *map(pa.array, (b["start"] + ends - sizes, sizes, np.array(crc, dtype=np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.join(starts, ["file", "block"]).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Encode, write to ``folder`` and read back."""
    write(saved(encoded(docs, path, end_id), "token-ids"), id_type(Tokenizer.from_file(path)), folder)
    return read_back(docs.sparkSession, folder)
