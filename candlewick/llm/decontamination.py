"""Benchmark decontamination with suffix arrays over the training text.

Each task cuts its documents into shards and builds a suffix array of every shard, in
words.  All suffixes of all benchmark items are binary-searched in it, all at once: the
neighbours of the place where a suffix would stand give its longest verbatim match, and
the suffixes that begin with its first ``window`` words give every location.  Only
stretches of words that occur in the benchmark at all, long enough for the shortest
window, enter a suffix array: no other suffix can match.

The corpus is read once and not shuffled; a document lies whole in one shard.  The
benchmark is written as blocks of bounded size in the shared folder; a task goes through
the blocks one after the other, so any benchmark size fits (one block in the usual case).

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  A window is
``window`` consecutive words of an item, or the whole item if it has fewer.  Null and
empty texts have no words; items without words are left out; items with a null id hit like
all others, but are not listed or counted as items; items that share an id or a text count
as they stand (an id is listed once a document); repeated rows and null doc_ids each get a
row; empty tables give no hits, or no rows; other columns are ignored.

Equal windows of many items are one window here: a shard's occurrences are pairs of a place
and a distinct window (at most ``window`` for a word), and documents with the same windows
share the list of their items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import expand, plain, split_words, text_slices, translated
from candlewick.llm.token_output import filesystem
from candlewick.session import scratch_path

WINDOW = 10
#: Bytes of benchmark text in a block; bounds what a task holds of the benchmark.
BLOCK_BYTES = 16 << 20
#: Bytes of training text in a shard (one suffix array).
SHARD_BYTES = 12 << 20
#: Words compared in one step of the binary search, over all suffixes of a chunk.
SEARCH_CELLS = 1 << 22

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
              for c in range(256))


def item_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return split_words(translated(text, _WORD))


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``t`` in the order of their suffixes, compared over ``depth`` words at least.

    Prefix doubling: ranks by the first k words give ranks by 2k words.
    """
    rank, k = np.unique(t, return_inverse=True)[1].astype(np.int64), 1
    n = len(t)
    while True:
        top = int(rank.max()) + 1 if n else 0
        if k >= depth or top == n:
            return np.argsort(rank, kind="stable")
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (top + 1) + after
        order = np.argsort(key, kind="stable")
        step = np.zeros(n, np.int64)
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        k *= 2


def _against(t: np.ndarray, at: np.ndarray, patterns: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words in common, sign of suffix minus pattern over the pattern's words)."""
    width = patterns.shape[1]
    own = t[at[:, None] + np.arange(width)]
    differ = own != patterns
    differ |= np.arange(width) >= size[:, None]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    j = np.minimum(common, width - 1)
    rows = np.arange(len(at))
    sign = np.where(common >= size, 0, np.sign(own[rows, j].astype(np.int64) - patterns[rows, j]))
    return common, sign


def search(t: np.ndarray, order: np.ndarray, patterns: np.ndarray, size: np.ndarray, upper: bool) -> np.ndarray:
    """First place whose suffix is not below the pattern (or, with ``upper``, is above it)."""
    lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(order), np.int64)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        _, sign = _against(t, order[np.minimum(mid, len(order) - 1)], patterns, size)
        go = (lo < hi) & ((sign < 0) | ((sign == 0) & upper))
        lo, hi = np.where(go, mid + 1, lo), np.where((lo < hi) & ~go, mid, hi)
    return lo


class Block:
    """The suffixes of a block of benchmark items, in word codes (0: no benchmark word)."""

    def __init__(self, items: pa.Table, window: int):
        words, offs = item_words(items["text"].combine_chunks().cast(pa.large_string()).fill_null(""))
        self.names = items["item_id"].to_pylist()
        self.vocabulary = pc.unique(words) if len(words) else pa.array([], pa.large_string())
        codes = pc.index_in(words, value_set=self.vocabulary).to_numpy(zero_copy_only=False) + 1
        n = np.diff(offs)
        own = np.minimum(n, window)
        starts = n - own + 1
        starts[n == 0] = 0
        self.item = np.repeat(np.arange(len(n)), starts)
        self.at = expand(offs[:-1], starts)  # the suffixes that a window starts
        self.size = own[self.item]
        self.rest = offs[1:][self.item] - self.at
        self.longest = int(n.max()) if len(n) else 0
        self.shortest = int(self.size.min()) if len(self.size) else 0
        self.words = np.concatenate([codes, np.zeros(self.longest + 1, codes.dtype)]).astype(np.int32)
        # The suffixes in order of content, each item closed by a -1; equal windows stand together there.
        closed = np.insert(codes.astype(np.int64), offs[1:], -1) if len(n) else codes.astype(np.int64)
        self.closed = np.concatenate([closed, np.full(self.longest + window + 1, -1)])
        place = self.at + self.item
        suffix = np.full(len(closed), -1)
        suffix[place] = np.arange(len(place))
        sorted_ = suffix[suffix_array(closed, self.longest + 1)] if len(closed) else suffix
        order = sorted_[sorted_ >= 0]
        self.place = place[order]
        new = np.ones(len(order), bool)
        for a in range(1, len(order), 1 << 16):
            b = min(a + (1 << 16), len(order))
            text = self.closed[self.place[a - 1:b, None] + np.arange(window)]
            size = self.size[order[a - 1:b]]
            differ = (text[1:] != text[:-1]) & (np.arange(window) < size[1:, None])
            new[a:b] = differ.any(axis=1) | (size[1:] != size[:-1])
        #: First suffix of each distinct window, and the items of each: item[starts[w]:starts[w + 1]].
        starts = np.flatnonzero(new)
        self.window = order[starts]
        self.starts, self.items = np.append(starts, len(order)), self.item[order]

    def item_names(self, w: int) -> set[str]:
        """Ids (not null) of the items that hold a window."""
        return {self.names[k] for k in np.unique(self.items[self.starts[w]:self.starts[w + 1]])} - {None}

    def patterns(self, k: np.ndarray, size: np.ndarray) -> np.ndarray:
        width = np.arange(int(size.max()))
        return np.where(width < size[:, None], self.words[self.at[k][:, None] + width], 0)


def locate(block: Block, words: pa.Array, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches of a block's suffixes in a shard.

    (window, word of the shard) of every location of each distinct window, the length of
    the longest verbatim match that starts at each location, and for each suffix the length
    of its longest match in the shard and where that starts.
    """
    none = np.zeros(0, np.int64)
    best, best_at = np.zeros(len(block.at), np.int64), np.full(len(block.at), -1)
    if not len(block.at) or not len(words):
        return none, none, none, best, best_at
    code = pc.index_in(words, value_set=block.vocabulary)
    code = (pc.fill_null(code, -1).to_numpy(zero_copy_only=False) + 1).astype(np.int32)
    known = code > 0
    # Stretches of benchmark words inside one document.
    start = known.copy()
    start[1:] &= ~known[:-1]
    heads = offs[:-1][np.diff(offs) > 0]
    start[heads] = known[heads]
    begin = np.flatnonzero(start)
    stop = ~known
    ends = np.flatnonzero(np.append(stop, True))
    length = np.minimum(ends[np.searchsorted(ends, begin)], offs[np.searchsorted(offs, begin, side="right")]) - begin
    begin, length = begin[length >= block.shortest], length[length >= block.shortest]
    if not len(begin):
        return none, none, none, best, best_at
    # Each stretch is followed by a 0, which no pattern holds.
    place = expand(begin, length + 1)
    t = code[np.minimum(place, len(code) - 1)]
    t[np.cumsum(length + 1) - 1] = 0
    order = suffix_array(t, block.longest)
    padded = np.concatenate([t, np.zeros(block.longest + 1, t.dtype)])
    chunk = max(1, SEARCH_CELLS // max(1, block.longest))
    for a in range(0, len(block.at), chunk):
        k = np.arange(a, min(a + chunk, len(block.at)))
        whole = block.patterns(k, block.rest[k])
        p = search(padded, order, whole, block.rest[k], upper=False)
        for near in (p - 1, p):
            ok = (near >= 0) & (near < len(order))
            at = order[np.clip(near, 0, len(order) - 1)]
            common = np.where(ok, _against(padded, at, whole, block.rest[k])[0], 0)
            better = common > best[k]
            best[k[better]], best_at[k[better]] = common[better], place[at[better]]
    found, found_at = [], []
    hit = np.flatnonzero(best[block.window] >= block.size[block.window])
    for a in range(0, len(hit), chunk):
        w = hit[a:a + chunk]
        size = block.size[block.window[w]]
        prefix = block.patterns(block.window[w], size)
        lo = search(padded, order, prefix, size, upper=False)
        hi = search(padded, order, prefix, size, upper=True)
        found.append(np.repeat(w, hi - lo))
        found_at.append(order[expand(lo, hi - lo)])
    if not found:
        return none, none, none, best, best_at
    # Each location against the block's suffixes in order: a neighbour has the longest match.
    found, at = np.concatenate(found), np.concatenate(found_at)
    places, back = np.unique(at, return_inverse=True)
    longest = np.zeros(len(places), np.int64)
    for a in range(0, len(places), chunk):
        own = padded[places[a:a + chunk, None] + np.arange(block.longest)].astype(np.int64)
        size = np.full(len(own), block.longest)
        p = search(block.closed, block.place, own, size, upper=False)
        for near in (p - 1, p):
            ok = (near >= 0) & (near < len(block.place))
            common = _against(block.closed, block.place[np.clip(near, 0, len(block.place) - 1)], own, size)[0]
            longest[a:a + chunk] = np.maximum(longest[a:a + chunk], np.where(ok, common, 0))
    return found, place[at], longest[back], best, best_at


def write_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> list[str]:
    """Benchmark items, as files of about BLOCK_BYTES in the shared folder."""
    spark = benchmark.sparkSession
    src = plain(benchmark, item_id=item_col, text=text_col).withColumn("item_id", F.col("item_id").cast("string"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    path = scratch_path(spark, "llm", "benchmark")
    src.repartition(max(1, -(-int(size) // BLOCK_BYTES))).write.parquet(path)
    return sorted(spark.read.schema(src.schema).parquet(path).inputFiles())


_blocks: dict[tuple[str, int], Block] = {}


def _block(path: str, window: int, keep: bool) -> Block:
    """A block; the only one of a benchmark is kept by the worker."""
    got = _blocks.get((path, window))
    if got is None:
        fs, root = filesystem(path)
        got = Block(pq.read_table(root, filesystem=fs, columns=["item_id", "text"]), window)
        if keep:
            _blocks.clear()
            _blocks[path, window] = got
    return got


REPORT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "longest int, spans array<struct<first:int,last:int>>")


def _reports(files: list[str], window: int, batches: Iterator[pa.RecordBatch], text_col: str):
    """(rows, columns of REPORT after doc_id) for each shard."""
    for batch in batches:
        for rows, text in text_slices(batch, text_col, limit=SHARD_BYTES):
            words, offs = item_words(text)
            n, total = np.diff(offs), len(words)
            delta = np.zeros(total + 1, np.int64)
            held: dict[int, list[tuple[int, int]]] = {}
            names: dict[tuple[int, int], set[str]] = {}
            longest = np.zeros(len(n), np.int32)
            for b, path in enumerate(files):
                block = _block(path, window, len(files) == 1)
                found, word, length, _, _ = locate(block, words, offs)
                np.add.at(delta, word, 1)
                np.add.at(delta, word + block.size[block.window[found]], -1)
                doc = np.searchsorted(offs, word, side="right") - 1
                np.maximum.at(longest, doc, length.astype(np.int32))
                count = len(block.window)
                for pair in np.unique(doc * count + found).tolist() if len(doc) else ():
                    held.setdefault(pair // count, []).append((b, pair % count))
                for w in np.unique(found).tolist():
                    names[b, w] = block.item_names(w)
            hit = np.cumsum(delta[:-1]) > 0
            n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[offs])
            # Ranges of hit words, cut at document ends.
            first = hit.copy()
            first[1:] &= ~hit[:-1]
            heads = offs[:-1][n > 0]
            first[heads] = hit[heads]
            begin = np.flatnonzero(first)
            quiet = np.flatnonzero(np.append(~hit, True))
            end = np.minimum(quiet[np.searchsorted(quiet, begin)], offs[np.searchsorted(offs, begin, side="right")])
            own = np.searchsorted(offs, begin, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array((begin - offs[own]).astype(np.int32)), pa.array((end - 1 - offs[own]).astype(np.int32))],
                names=["first", "last"])
            per = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(n)))]).astype(np.int32)
            listed: dict[tuple, tuple[int, str]] = {(): (0, hashlib.sha256(b"").hexdigest())}
            items = []
            for d in range(len(n)):
                windows = tuple(held.get(d, ()))
                if windows not in listed:
                    ids = sorted(set().union(*(names[w] for w in windows)))
                    listed[windows] = len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()
                items.append(listed[windows])
            yield rows, [pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([x[0] for x in items], pa.int64()),
                         pa.array([x[1] for x in items], pa.string()), pa.array(n_hit > 0), pa.array(longest),
                         pa.ListArray.from_arrays(pa.array(per), spans)]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """REPORT for every document: hit words, items, hit ranges of words, and ``longest``.

    ``longest`` is the longest verbatim match, in words, of the document with an item (0 without a window's match).
    """
    files = write_blocks(benchmark, item_col, item_text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, columns in _reports(files, window, batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names=[
                "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "spans"])

    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return src.mapInArrow(run, REPORT)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no window hits (all columns as they were).  One pass, no shuffle."""
    files = write_blocks(benchmark)
    src = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, columns in _reports(files, window, batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(pc.invert(columns[4]))], names=["row"])

    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}").select(
        [F.col("row").getField(c).alias(c) for c in docs.columns])
