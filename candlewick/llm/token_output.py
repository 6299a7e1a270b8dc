"""Token-id files: independent zstandard frames, a seek table at the end, a checksum for each frame.

A file holds the documents of one range of doc_id in ascending order, one frame for each
document (more where a document is over ``FRAME_IDS`` ids).  A frame's content is the ids
as little-endian unsigned 32-bit integers.  After the frames come two skippable frames: an
index (doc_id, ids, frames of each document) and the seek table of the public seekable
zstandard format (compressed size, size, low 32 bits of XXH64 of each frame; then the
number of frames, a descriptor byte and the magic number).  A reader fetches the tail of
the file and then only the byte ranges of the documents asked for.

A task writes its file under a name of its own and reports it in the manifest rows; the
manifest is a table, so a file left by a lost task is in no manifest and is never read.

Inputs: null text is an empty document (the end id alone); a null doc_id sorts first and
is kept; rows that repeat a doc_id each get a document, in the order of their text's hash;
an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm._common import materialise, plain, shuffle_parts, text_slices
from candlewick.llm.word_ids import word_ids
from candlewick.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Ids in a frame at most; a longer document has several frames.
FRAME_IDS = 1 << 22

# Fixed values of the zstandard formats.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
INDEX_MAGIC = 0x58444954

MANIFEST = "file string, first_doc long, n_docs long, n_ids long, n_bytes long"
ENTRY = "doc_id long, start long, n_tokens long, ids_crc32 long"


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Any store that Arrow reaches by URI (file, hdfs, s3, gs)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class FrameWriter:
    """Writes one token file."""

    def __init__(self, sink, level: int = 3):
        self.sink, self.level = sink, level
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.n_bytes = 0
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        ids = np.ascontiguousarray(ids, "<u4")
        before = len(self.frames)
        for at in range(0, max(len(ids), 1), FRAME_IDS):
            raw = ids[at:at + FRAME_IDS].tobytes()
            packed = self.codec.compress(raw)
            self.sink.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.n_bytes += len(packed)
        self.docs.append((doc_id is None, doc_id or 0, len(ids), len(self.frames) - before))

    def close(self) -> None:
        docs = b"".join(struct.pack("<?qqI", *d) for d in self.docs) + struct.pack("<II", len(self.docs), INDEX_MAGIC)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_MAGIC)
        tail = struct.pack("<II", SKIPPABLE, len(docs)) + docs + struct.pack("<II", SEEK_FRAME, len(table)) + table
        self.sink.write(tail)
        self.n_bytes += len(tail)


class FrameReader:
    """Reads a token file: the tail first, then only the frames asked for."""

    def __init__(self, source, size: int):
        self.source = source
        foot = self._at(size - 9, 9)
        n, flags, magic = struct.unpack("<IBI", foot)
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError("not a token file")
        body = 12 * n
        at = size - 9 - body
        table = np.frombuffer(self._at(at, body), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.raw, self.sums = table.T
        self.offsets = np.concatenate([[0], np.cumsum(self.packed)])
        n_docs, magic = struct.unpack("<II", self._at(at - 16, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index")
        width = struct.calcsize("<?qqI")
        raw = self._at(at - 16 - width * n_docs, width * n_docs)
        index = np.frombuffer(raw, np.dtype([("null", "?"), ("doc", "<i8"), ("n", "<i8"), ("frames", "<u4")]))
        self.null, self.doc, self.n_ids = index["null"], index["doc"], index["n"]
        self.first = np.concatenate([[0], np.cumsum(index["frames"], dtype=np.int64)])
        self.codec = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.doc)

    def ids(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document: one ranged read."""
        a, b = self.first[k], self.first[k + 1]
        raw = self._at(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        out = []
        for f in range(a, b):
            lo = int(self.offsets[f] - self.offsets[a])
            part = self.codec.decompress(raw[lo:lo + int(self.packed[f])], max_output_size=int(self.raw[f]) or 1)
            if len(part) != self.raw[f] or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f}: checksum or size differs")
            out.append(part)
        return np.frombuffer(b"".join(out), "<u4")


def write_tokens(docs: DataFrame, out_dir: str | None = None, tokenizer: str = TOKENIZER, end_id: int | None = END_ID,
                 partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write the files; returns the manifest (MANIFEST), itself a table beside them.

    One shuffle: the texts by range of doc_id.  first_doc is the number of documents
    before the file's first one, in file order.
    """
    spark = docs.sparkSession
    out_dir = out_dir or scratch_path(spark, "llm", "token_files")
    fs, root = filesystem(out_dir)
    fs.create_dir(root, recursive=True)
    src = plain(docs, doc_id=id_col, text=text_col)
    src = src.withColumns({"doc_id": F.col("doc_id").cast("long"), "h": F.xxhash64("text")})
    src = src.repartitionByRange(partitions or shuffle_parts(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(out_dir)
        encoder, writer, n_ids, number = word_ids(tokenizer), None, 0, 0
        name = f"{uuid.uuid4().hex}.tokens.zst"
        sink = None
        for batch in batches:
            for rows, text in text_slices(batch):
                if writer is None:
                    from pyspark import TaskContext
                    number = TaskContext.get().partitionId()
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                    writer = FrameWriter(sink)
                ids, offs = encoder.encode(text)
                for k, d in enumerate(rows.column(0).to_pylist()):
                    own = ids[offs[k]:offs[k + 1]]
                    writer.add(d, own if end_id is None else np.append(own, np.uint32(end_id)))
                n_ids += len(ids) + (rows.num_rows if end_id is not None else 0)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"number": [number], "file": [name], "n_docs": [len(writer.docs)],
                                              "n_ids": [n_ids], "n_bytes": [writer.n_bytes]})

    rows = src.select("doc_id", "text").mapInArrow(
        write, "number long, file string, n_docs long, n_ids long, n_bytes long")
    return materialise(rows, "token_manifest").withColumn("root", F.lit(out_dir))


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds each file's first_id: ids in the files before it.

    The driver sums one number a file, not a document; files hold a whole shuffle partition each.
    """
    files = sorted(manifest.select("number", "file", "n_docs", "n_ids", "root").collect())
    rows, at = [], 0
    for r in files:
        rows.append((r.number, r.file, r.n_docs, r.root, at))
        at += r.n_ids
    spark = manifest.sparkSession
    schema = "number long, file string, n_docs long, root string, first_id long"
    return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)), "number")


def read_index(manifest: DataFrame) -> DataFrame:
    """Every document of the files (ENTRY), decompressed and checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, root = filesystem(row["root"])
                path = f"{root}/{row['file']}"
                with fs.open_input_file(path) as source:
                    reader = FrameReader(source, source.size())
                    if len(reader) != row["n_docs"]:
                        raise ValueError(f"{path}: {len(reader)} documents, not {row['n_docs']}")
                    starts = row["first_id"] + np.concatenate([[0], np.cumsum(reader.n_ids)])
                    for a in range(0, len(reader), 10_000):
                        b = min(len(reader), a + 10_000)
                        got = [reader.ids(k) for k in range(a, b)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.doc[a:b], pa.int64(), mask=reader.null[a:b]),
                             pa.array(starts[a:b], pa.int64()),
                             pa.array([len(x) for x in got], pa.int64()),
                             pa.array([zlib.crc32(x) for x in got], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return with_starts(manifest).mapInArrow(read, ENTRY)


def read_documents(spark: SparkSession, out_dir: str, file: str, wanted: list[int]) -> dict[int, np.ndarray]:
    """Ids of the wanted doc_ids of one file; reads the tail and those documents' frames only."""
    fs, root = filesystem(out_dir)
    with fs.open_input_file(f"{root}/{file}") as source:
        reader = FrameReader(source, source.size())
        at = {int(d): k for k, d in enumerate(reader.doc) if not reader.null[k]}
        return {d: reader.ids(at[d]) for d in wanted if d in at}


def token_output(docs: DataFrame, **options) -> DataFrame:
    """Write the token files of ``docs`` and return what reading them back gives (ENTRY)."""
    return read_index(write_tokens(docs, **options))
