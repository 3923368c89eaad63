"""Token-ID files: Parquet list columns in document order, with row groups, pages and encodings that allow selective reads.

Layout of a folder:

* ``data``: one file per range of documents, rows by ascending ``doc_id``: ``shard``, ``doc_id``, ``local_start``,
  ``n_tokens``, ``ids``. Token ids are dictionary encoded; the ascending integers are delta encoded. Pages hold a
  bounded number of rows and carry a page index, so a reader that filters on ``doc_id`` or asks for lengths only skips
  the ids of everything else.
* ``index``: one row per shard: its first and last document, its documents and tokens, and ``base``, the ids in all
  shards before it. A document's place in the whole sequence is ``base + local_start``.

Null and empty texts are one end id. Repeated ``doc_id`` are written next to each other, ordered by text; rows
without ``doc_id`` come first. Other columns are ignored.

The ids are those of the tokenizer's own ``encode(text, add_special_tokens=False)``: where a text holds ``<|endoftext|>``, that is the
one id of the added token. A pipeline that has to keep texts from making it escapes them before.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelsift.llm.common import eights, ranges_for, same_strings, slices, text_buffers, word_hashes
from reelsift.session import shared_root

END_ID = 2
DATA_SCHEMA = "shard int, doc_id long, local_start long, n_tokens long, ids array<int>"
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
}
#: Distinct pieces of text whose ids a Python worker keeps, and the bytes that they may take; longer pieces are not kept.
MEMO_ENTRIES, MEMO_BYTES, MEMO_PIECE = 1_500_000, 64 << 20, 64
_SLICE = 1 << 20
#: Pieces that are given to the tokenizer at once: what it returns for a piece takes far more room than the piece.
_BLOCK = 4096


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all rows begin: at each row, and at each blank that follows a visible character.

    A byte of a character that may be white space counts as white space, which makes fewer pieces and no others.
    """
    begins = np.zeros(len(data) + 1, bool)
    if len(data) > 3:
        after = data[:-1] > 32
        after[1:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
        three = (data[:-3] >= 0xE1) & (data[:-3] <= 0xE3) & ((data[1:-2] == 0x80) | (data[1:-2] == 0x81) | (data[1:-2] == 0x9A))
        after[2:] &= ~three
        begins[1:-1] = (data[1:] == 32) & after
    begins[offsets[:-1]] = True
    return np.flatnonzero(begins[:-1])


def _spans(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` places from each of ``at`` on, one span after another."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class PieceEncoder:
    """Encodes texts piece by piece; the ids of a piece are looked up once per slice, and kept for the next ones.

    A piece ends before a blank that follows a visible character. The vocabulary's splitting pattern never joins
    characters across such a place and looks no further ahead than the white space that follows, so the ids of the
    pieces, one after another, are the ids of the text. Pieces are found by a hash and then compared byte by byte.
    """

    def __init__(self, path: str, entries: int = MEMO_ENTRIES, size: int = MEMO_BYTES):
        # A task has one core; it is not to share out its batches over all of the machine's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.entries, self.bytes = entries, size
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<i4")
        self._forget()

    def _forget(self) -> None:
        # Hashes in order and the number of the piece that each is of; the pieces' bytes and ids, one after another. These
        # have room for all that is ever kept, so they are filled in place; room that is not filled takes no memory.
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.text, self.text_at = np.empty(self.bytes, np.uint8), np.empty(self.entries + 1, np.int32)
        self.ids, self.ids_at = np.empty(self.bytes // self.kind.itemsize, self.kind), np.empty(self.entries + 1, np.int32)
        self.text_at[0] = self.ids_at[0] = 0

    def _size(self) -> int:
        n = len(self.keys)
        places = sum(x.itemsize for x in (self.keys, self.number, self.text_at, self.ids_at))
        return n * places + int(self.text_at[n]) + int(self.ids_at[n]) * self.kind.itemsize

    def _learn(self, keys: np.ndarray, texts: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Keep pieces whose hashes are new; ``ids`` has theirs, one piece after another."""
        lengths = np.array([len(t) for t in texts], np.int64)
        keep = lengths <= MEMO_PIECE
        flat = ids[np.repeat(keep, sizes)]
        texts, keys, sizes, lengths = [t for t, k in zip(texts, keep.tolist(), strict=True) if k], keys[keep], sizes[keep], lengths[keep]
        places = sum(x.itemsize for x in (self.keys, self.number, self.text_at, self.ids_at))
        taken = np.cumsum(lengths + sizes * self.kind.itemsize + places)
        if len(keys) and (len(self.keys) + len(keys) > self.entries or self._size() + int(taken[-1]) > self.bytes):
            self._forget()
            fit = min(self.entries, int(np.searchsorted(taken, self.bytes, side="right")))
            keys, texts, sizes, lengths = keys[:fit], texts[:fit], sizes[:fit], lengths[:fit]
            flat = flat[: int(sizes.sum())]
        order, n, m = np.argsort(keys), len(self.keys), len(keys)
        numbers = n + np.arange(m, dtype=np.int32)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.number = np.insert(self.keys, at, keys[order]), np.insert(self.number, at, numbers[order])
        self.text_at[n + 1 : n + m + 1] = self.text_at[n] + np.cumsum(lengths)
        self.ids_at[n + 1 : n + m + 1] = self.ids_at[n] + np.cumsum(sizes)
        self.text[self.text_at[n] : self.text_at[n + m]] = np.frombuffer(b"".join(texts), np.uint8)
        self.ids[self.ids_at[n] : self.ids_at[n + m]] = flat

    def _known(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each hash is kept, whether it is this piece's, and the number of the piece that has it."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        met = self.keys[at] == keys
        number = self.number[at].astype(np.int64)
        there = self.text_at[number]
        own = met & (self.text_at[number + 1] - there == length)
        left = np.flatnonzero(own)
        for k in range(MEMO_PIECE):  # byte by byte; pieces are short
            left = left[length[left] > k]
            if not len(left):
                break
            own[left] &= data[start[left] + k] == self.text[there[left] + k]
        return met, own, number

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<i4")]
        for k in range(0, len(pieces), _BLOCK):
            done = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces[k : k + _BLOCK]], add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in done], np.int64))
            ids.append(np.fromiter(chain.from_iterable(done), "<i4", int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, each row's followed by ``end_id``, and how many each row has."""
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data)) if len(start) else start
        bytes_and_eights, length = (data, eights(data)), end - start
        keys, first, piece = np.unique(word_hashes(data, start, end, bytes_and_eights[1]), return_index=True, return_inverse=True)
        # A piece that has another one's hash is a piece of its own; that never happens but for strings made to do so.
        other = np.flatnonzero((length != length[first][piece]) | ~same_strings(bytes_and_eights, start, bytes_and_eights, start[first][piece], np.minimum(length, length[first][piece])))
        piece[other] = len(first) + np.arange(len(other))
        first = np.concatenate((first, other))
        met, known, number = self._known(keys, data, start[first[: len(keys)]], length[first[: len(keys)]])
        lone = np.ones(len(other), bool)
        met, known, number = np.concatenate((met, lone)), np.concatenate((known, ~lone)), np.concatenate((number, np.zeros(len(other), np.int64)))
        whole, new = data.tobytes(), np.flatnonzero(~known)
        texts = [whole[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
        sizes, fresh_ids = self._encoded(texts)
        kept_at = self.ids_at[number[known]].astype(np.int64)
        kept = self.ids_at[number[known] + 1] - kept_at
        flat = np.concatenate((self.ids[_spans(kept_at, kept)].astype("<i4"), fresh_ids))
        place, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        place[known], size[known] = np.cumsum(kept) - kept, kept
        place[new], size[new] = len(flat) - len(fresh_ids) + np.cumsum(sizes) - sizes, sizes
        learnt = np.flatnonzero(~met[new])
        if len(learnt):
            mask = ~met[new]
            self._learn(keys[new[learnt]], [texts[k] for k in learnt.tolist()], sizes[learnt], fresh_ids[np.repeat(mask, sizes)])
        at, n = place[piece], size[piece]
        ids = flat[_spans(at, n)]
        ends = np.append(0, np.cumsum(n))[np.searchsorted(start, offsets[1:])]
        return np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_to_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write the ids of all ``docs`` (``doc_id``, ``text``) under ``folder``; ``tokenizer`` is the vocabulary's path."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at = _encoder(tokenizer), 0
        for part in slices(batches, "text", _SLICE):
            coded, lengths = encoder.encode(*text_buffers(part.column("text")), end_id)
            ends = np.cumsum(lengths)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(coded))
            yield pa.RecordBatch.from_arrays(
                [part.column("shard"), part.column("doc_id"), pa.array(at + ends - lengths), pa.array(lengths), ids],
                ["shard", "doc_id", "local_start", "n_tokens", "ids"],
            )
            at += int(ends[-1])

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(partitions or ranges_for(rows, "text"), "doc_id").sortWithinPartitions("doc_id", "text")
    numbered = ranged.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    numbered.mapInArrow(encode, DATA_SCHEMA).write.options(**LAYOUT).parquet(f"{folder}/data")
    shards = (
        spark.read.schema(DATA_SCHEMA).parquet(f"{folder}/data").groupBy("shard")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    )
    # One row per file: the only rows that meet in one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """The documents of a folder; only the columns asked for are read from the files."""
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{folder}/data")
    if "start" in columns:
        index = spark.read.parquet(f"{folder}/index").select("shard", "base")
        data = data.join(index, "shard").withColumn("start", F.col("base") + F.col("local_start"))
    return data.select(*columns)


def with_crc(tokens: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``ids``: the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.asarray(lists.flatten(), "<u4")
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], [*names, "ids_crc32"])

    names = [c for c in tokens.columns if c != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != "ids")
    return tokens.select(*names, "ids").mapInArrow(digest, f"{schema}, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and return ``doc_id, start, n_tokens, ids`` read from them."""
    folder = f"{shared_root(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    encode_to_files(docs, folder, tokenizer, end_id)
    return read_tokens(docs.sparkSession, folder)
