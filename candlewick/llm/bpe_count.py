"""Token counts by byte-pair merging with a heap and a linked list; no token ids are made.

A pre-token starts as one symbol for each byte.  Adjacent pairs with a merge rank wait in
a heap; the lowest rank (leftmost first) is popped, its two symbols become one and the
new neighbours are pushed.  Symbols are linked to their neighbours, so a merge costs
O(log n).  The count is the number of initial symbols minus the number of merges.

Works on byte-level BPE files of the tokenizers library whose pre-tokenizer drops white
space (``word_ids.Splitter`` checks the form).  Words that need Unicode composition,
or hold an added token, are normalised and split by the library's own normalizer and
pre-tokenizer before the merges.

Null and empty texts have 0 tokens and 0 bytes; repeated rows each get a row; a null
doc_id is kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm._common import coded, plain, text_slices
from candlewick.llm.word_ids import MEMO_WORDS, Splitter, byte_chars, resolve

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048


def count_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges."""
    n = len(symbols)
    if n < 2:
        return n
    sym: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((sym[i], sym[i + 1]))
        if rank is not None:
            heap.append((rank, i, sym[i], sym[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        k = after[i]
        if sym[i] != left or k >= n or sym[k] != right:
            continue  # one of the two has been merged since
        sym[i], sym[k] = left + right, None
        merges += 1
        j = after[i] = after[k]
        if j < n:
            before[j] = i
            rank = ranks.get((sym[i], sym[j]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, sym[i], sym[j]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((sym[h], sym[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, sym[h], sym[i]))
    return n - merges


class Counter:
    """Token counts of words for one vocabulary file, remembered up to a bound."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        path = resolve(path)
        self.split = Splitter(path)
        spec = self.split.spec
        model = spec["model"]
        if not self.split.by_word or model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a byte-level BPE whose pre-tokenizer drops white space")
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): k for k, (a, b) in enumerate(merges)}
        self.chars, self.limit = byte_chars(), memo_words
        self.added = regex.compile("|".join(map(regex.escape, self.split.added)) or r"(?!)")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        self.normal, self.pre = tok.normalizer, tok.pre_tokenizer
        self.words: dict[str, int] = {}

    def _piece(self, symbols: str) -> int:
        """Tokens of one pre-token, given as byte stand-ins."""
        s = list(symbols)
        if s:
            s[-1] += self.suffix
        return count_symbols(s, self.ranks)

    def count(self, piece: str) -> int:
        if self.split.is_plain(piece):
            chars = self.chars
            return self._piece("".join([chars[b] for b in piece.encode()]))
        total = len(self.added.findall(piece))
        for part in self.added.split(piece):
            for symbols, _ in self.pre.pre_tokenize_str(self.normal.normalize_str(part)) if part else ():
                total += self._piece(symbols)
        return total

    def counts(self, text: pa.Array) -> np.ndarray:
        """Tokens of every text of a slice."""
        pieces, offs = self.split.pieces(text)
        codes, distinct = coded(pieces)
        if len(self.words) + len(distinct) > self.limit:
            self.words = {}
        memo = self.words
        sizes = np.empty(len(distinct), np.int64)
        for k, w in enumerate(distinct.to_pylist()):
            n = memo.get(w)
            if n is None:
                n = memo[w] = self.count(w)
            sizes[k] = n
        total = np.concatenate([[0], np.cumsum(sizes[codes] if len(codes) else codes)])
        return np.diff(total[offs])


_made: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _made:
        _made[path] = Counter(path)
    return _made[path]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit); one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            for rows, text in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pc.binary_length(text), pa.array(own.counts(text), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])

    src = plain(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    out = src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
