"""Packing along a Hilbert curve: neighbouring documents share sequences.

Each document's token ids are counted in hashed bins; the vector of square roots, which
has length 1 after division by the root of the id count, is projected to ``AXES``
random directions.  The Hilbert key of that point orders the documents: a range shuffle
by (key, doc_id) gives every task a stretch of the curve, and the task lays its documents
end to end and cuts at the sequence length.  What is left at the end of a stretch is cut
into powers of two, which need no padding.  So many equal documents (equal keys) still
spread over tasks by doc_id, and a task holds one batch of documents at a time.

Null text is an empty document (the end id alone); a null doc_id is kept and sorts first
among equal keys; repeated rows are packed each; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import gathered, materialise, plain, shuffle_parts, text_slices, total_bytes
from candlewick.llm.word_ids import word_ids

TOKENIZER = "word_bpe_49k.json"
END_ID, LENGTH = 1, 2048
BINS, AXES, BITS, SEED = 64, 3, 16, 20
#: sequence_id = stretch number * STRETCH + sequence within the stretch.
STRETCH = 1 << 40

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")


def directions(bins: int = BINS, axes: int = AXES, seed: int = SEED) -> np.ndarray:
    """Random unit directions, orthogonal to the all-ones vector (which carries no contrast)."""
    g = np.random.default_rng(seed).standard_normal((bins, axes))
    g -= g.mean(axis=0)
    return g / np.linalg.norm(g, axis=0)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, axes), each below 2**bits.

    Gray-code walk from the highest bit down: undo the rotation and reflection of each
    level on the lower bits, then read the bits off level by level.
    """
    x = [points[:, k].astype(np.int64).copy() for k in range(points.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for k in range(len(x)):
            flip = (x[k] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
        level >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    gray = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        gray = np.where((x[-1] & level) != 0, gray ^ (level - 1), gray)
        level >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for k in range(len(x)):
            key = (key << 1) | (((x[k] ^ gray) >> b) & 1)
    return key


def document_keys(ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Hilbert keys of the documents of a slice."""
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(offs))
    bins = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    counts = np.bincount(doc * BINS + bins.astype(np.int64), minlength=n * BINS).reshape(n, BINS)
    vectors = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    places = (vectors @ directions() + 1.0) * (1 << (BITS - 1))
    return hilbert_key(np.clip(places.astype(np.int64), 0, (1 << BITS) - 1))


class Packer:
    """Lays the documents of one stretch end to end."""

    def __init__(self, stretch: int, length: int):
        self.base, self.length = stretch * STRETCH, length
        self.sequence, self.fill = 0, 0
        self.held: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list]:
        """Rows of finished sequences; pieces of an open one are held (at most ``length`` ids)."""
        at, n = 0, len(ids)
        while at < n:
            take = min(n - at, self.length - self.fill)
            self.held.append((doc_id, at, ids[at:at + take], n, self.fill))
            at += take
            self.fill += take
            if self.fill == self.length:
                yield [self._row(*h) for h in self.held]
                self.sequence, self.fill, self.held = self.sequence + 1, 0, []

    def _row(self, doc_id, start, ids, n, offset):
        return doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), n, self.base + self.sequence, offset

    def close(self) -> Iterator[list]:
        """The open rest, in sequences of powers of two (largest first)."""
        left, rest = self.fill, self.held
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            rows, fill, later = [], 0, []
            for doc_id, start, ids, n, _ in rest:
                take = min(len(ids), room - fill)
                if take:
                    rows.append(self._row(doc_id, start, ids[:take], n, fill))
                if take < len(ids):
                    later.append((doc_id, start + take, ids[take:], n, 0))
                fill += take
            yield rows
            self.sequence, rest = self.sequence + 1, later
        self.fill, self.held = 0, []


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, end_id: int | None = END_ID,
         partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (PIECE) of all documents in sequences of at most ``length`` ids.

    The encoded documents are written once with their keys, then shuffled once by range.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, codec = word_ids(tokenizer), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for rows, text in text_slices(batch):
                ids, offs = encoder.encode(text)
                packed = []
                for k in range(rows.num_rows):
                    own = ids[offs[k]:offs[k + 1]]
                    own = own if end_id is None else np.append(own, np.uint32(end_id))
                    packed.append(codec.compress(own.astype("<u4", copy=False).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(document_keys(ids, offs), pa.int64()), rows.column(0), pa.array(packed, pa.binary())],
                    names=["key", "doc_id", "ids"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, codec, rows = None, zstandard.ZstdDecompressor(), []

        def flush():
            cols = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              names=[f.split()[0] for f in PIECE.split(", ")])

        for batch in batches:
            if batch.num_rows and packer is None:
                packer = Packer(batch.column(3)[0].as_py(), length)
            for doc_id, packed in zip(batch.column(1).to_pylist(), batch.column(2)):
                for got in packer.add(doc_id, np.frombuffer(codec.decompress(packed.as_py()), "<u4")):
                    rows += got
                if len(rows) >= 10_000:
                    yield flush()
                    rows = []
        for got in packer.close() if packer else ():
            rows += got
        if rows:
            yield flush()

    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    encoded = materialise(src.mapInArrow(encode, "key long, doc_id long, ids binary"), "encoded")
    order = [F.col("key"), F.col("doc_id"), F.xxhash64("ids")]
    ranged = encoded.repartitionByRange(partitions or shuffle_parts(spark), *order).sortWithinPartitions(*order)
    # The partition names the stretch: a task may lay several.
    return gathered(ranged.withColumn("stretch", F.spark_partition_id()).mapInArrow(lay, PIECE), size=total_bytes(encoded, "ids"))
