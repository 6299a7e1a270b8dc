"""Helpers shared by the text operators: scratch tables, bounded text slices, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import scratch_path

#: Text handled at once inside a task; bounds a Python worker's memory at any table size.
SLICE_BYTES = 6 << 20

#: How many bytes of input a shuffle partition should hold (text operators).
PARTITION_BYTES = 32 << 20

#: Rows and bytes from which on a small table gets another task (and file), see ``gathered``.
TASK_ROWS, TASK_BYTES = 1 << 18, 4 << 20

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int = 0, size: int = 0) -> DataFrame:
    """``df`` in no more tasks than work on that many rows or bytes needs, but twice the cores at least.

    Each task writes a file, so a small table cut in many shuffle partitions is slow to write and
    to read; on a local disk Spark even starts two processes for each file.  The partitions
    themselves stay: a task goes through its own one after the other.
    """
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-int(rows) // TASK_ROWS), -(-int(size) // TASK_BYTES)))


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(f"`{column}`")))).first()[0] or 0


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the scratch table behind a ``materialise``d frame that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut a batch into row ranges of about ``limit`` bytes of text (a longer text stands alone).

    Yields (rows, text): text is a large_string array with nulls read as empty.
    """
    if not batch.num_rows:
        return
    text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = text.slice(at, to - at)
        yield batch.slice(at, to - at), (part.fill_null("") if part.null_count else part)
        at = to


def translated(text: pa.Array, table: bytes) -> pa.Array:
    """Map every byte of a large_string array (table must keep UTF-8 valid)."""
    _, offsets, data = text.buffers()
    offs = np.frombuffer(offsets, np.int64, len(text) + 1, text.offset * 8)
    raw = memoryview(data)[offs[0]:offs[-1]] if data is not None else b""
    out = bytes(raw).translate(table)
    return pa.LargeStringArray.from_buffers(len(text), pa.py_buffer((offs - offs[0]).tobytes()), pa.py_buffer(out))


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between runs of ASCII white space: (all words of the slice, per-text offsets)."""
    lists = pc.ascii_split_whitespace(text)
    flat, offs = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offs = offs - offs[0]
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    if len(size) and not size.all():
        keep = size > 0
        offs = np.concatenate([[0], np.cumsum(keep)])[offs]
        flat = flat.filter(pa.array(keep))
    return flat, offs


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dictionary codes of the words of a slice and the distinct words."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary


def expand(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ranges [s, s + n) for each pair."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def crc_mod(doc_id: str, n: int):
    """crc32(doc_id as text) mod n, as a column (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n)


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under fixed internal names (other columns can't clash)."""
    return df.select([F.col(f"`{c}`").alias(a) for a, c in columns.items()])
