"""Token ids of whole texts by the tokenizers library, remembered word by word.

A tokenizer whose pre-tokenizer removes white space never lets a token cross it, so a
text's ids are the ids of its white-space-separated words one after the other.  Words are
split into pre-tokens by byte class where that is exact, each distinct pre-token is
encoded once by the library, and a slice of texts is then a gather over a table of ids.
Any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa

from candlewick.llm._common import coded, expand

#: Pre-tokens remembered at once; the memory is cleared when it is full (results don't change).
MEMO_WORDS = 800_000


def byte_chars() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies (fixed mapping)."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return [chr(b) if b in set(keep) else chr(256 + rest.index(b)) for b in range(256)]


def resolve(path: str) -> str:
    """A vocabulary file: a bare name is looked up among the public tokenizers."""
    if "/" in path:
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


#: The split pattern that ``Splitter.pieces`` applies by byte classes (fixed value of the known file form).
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Byte classes: 0 white space, 1 letter, 2 digit, 3 other, 4 needs the library.
_KIND = np.full(256, 4, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[c for c in range(0x21, 0x7F) if _KIND[c] == 4 and c not in b"'"]] = 3


class Splitter:
    """What the tokenizer file says about splitting words, where it is of the known form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = spec = json.load(f)
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        norm = (spec.get("normalizer") or {}).get("normalizers") or []
        tokens = spec.get("added_tokens", [])
        self.added = [t["content"] for t in tokens]
        # Matches are kept, the rest is removed; no alternative of the pattern takes white space.
        self.by_word = (
            [p.get("type") for p in pre] == ["Split", "ByteLevel"] and pre[0]["pattern"].get("Regex") == PATTERN
            and pre[0]["behavior"] == "Removed" and pre[0]["invert"]
            and not pre[1].get("add_prefix_space") and not pre[1].get("use_regex")
            and [n["type"] for n in norm] == ["NFC", "Replace", "Lowercase"]
            and not any(set(t) & set(" \t\n\r\x0b\x0c") for t in self.added)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in tokens))
        self.kind = _KIND.copy()
        for t in self.added:
            self.kind[t.encode()[0]] = 4
        ascii_part = "".join([re.escape(chr(c)) for c in range(128) if self.kind[c] in (1, 2, 3)])
        self.plain = re.compile(f"[{ascii_part}\xc0-\xd6\xd8-\xf6\xf8-\xff]+")

    def pieces(self, text: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pre-tokens of a slice, lower-cased, and per-text offsets.

        ASCII and the Latin-1 letters (two bytes, the first 0xC3) are split by byte class:
        their lower case is simple and they need no composition.  A word with any other
        character, an apostrophe or the start of an added token stays whole and unchanged.
        """
        _, offsets, data = text.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(text) + 1, text.offset * 8)
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and bounds[-1] > bounds[0] else \
            np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        n = len(raw)
        if not n:
            return pa.array([], pa.large_string()), np.zeros(len(bounds), np.int64)
        kind, out = self.kind[raw], raw.copy()
        out[(raw >= 0x41) & (raw <= 0x5A)] += 32
        lead = np.flatnonzero(raw == 0xC3)
        if len(lead):
            second = raw[lead + 1]
            lead, second = lead[(second != 0x97) & (second != 0xB7)], second[(second != 0x97) & (second != 0xB7)]
            kind[lead] = kind[lead + 1] = 1
            out[lead[second <= 0x9E] + 1] += 32
        begin = np.empty(n, bool)
        begin[0] = True
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        heads = bounds[:-1][np.diff(bounds) > 0]
        begin[heads] = True
        odd = np.flatnonzero(kind == 4)
        if len(odd):
            space = kind == 0
            edge = np.empty(n, bool)
            edge[0] = True
            edge[1:] = space[1:] != space[:-1]
            edge[heads] = True
            starts = np.flatnonzero(edge)
            words = np.unique(np.searchsorted(starts, odd, side="right") - 1)
            first, last = starts[words], np.append(starts, n)[words + 1]
            inside = expand(first, last - first)
            begin[inside] = False
            begin[first] = True
            out[inside] = raw[inside]
        at = np.flatnonzero(begin)
        keep = kind[at] != 0
        whole = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, n).astype(np.int64)), pa.py_buffer(out))
        counts = np.concatenate([[0], np.cumsum(keep)])
        return whole.filter(pa.array(keep)), counts[np.searchsorted(at, bounds)]

    def is_plain(self, piece: str) -> bool:
        """Whether a piece came from the byte classes (and not whole from a word)."""
        return self.plain.fullmatch(piece) is not None


class WordIds:
    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer
        path = resolve(path)
        self.split, self.limit = Splitter(path), memo_words
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chars = byte_chars()
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])

    def _piece(self, piece: str) -> list[int]:
        if not self.split.is_plain(piece):
            return self.tok.encode(piece, add_special_tokens=False).ids
        chars = self.chars
        return [t.id for t in self.tok.model.tokenize("".join([chars[b] for b in piece.encode()]))]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, per-text offsets) of a slice."""
        if not self.split.by_word:
            got = [e.ids for e in self.tok.encode_batch(text.to_pylist(), add_special_tokens=False)]
            offs = np.concatenate([[0], np.cumsum([len(x) for x in got], dtype=np.int64)])
            return np.array([i for x in got for i in x], np.uint32), offs
        pieces, offs = self.split.pieces(text)
        if not len(pieces):
            return np.zeros(0, np.uint32), offs
        codes, distinct = coded(pieces)
        if len(self.memo) + len(distinct) > self.limit:
            self._clear()
        memo, flat, ends = self.memo, self.flat, self.ends
        slots = np.empty(len(distinct), np.int64)
        for k, w in enumerate(distinct.to_pylist()):
            slot = memo.get(w)
            if slot is None:
                flat.extend(self._piece(w))
                ends.append(len(flat))
                slot = memo[w] = len(ends) - 2
            slots[k] = slot
        table, bounds = np.array(flat, np.uint32), np.array(ends, np.int64)
        first, size = bounds[:-1][slots], np.diff(bounds)[slots]
        lens = size[codes]
        return table[expand(first[codes], lens)], np.concatenate([[0], np.cumsum(lens)])[offs]


_made: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One encoder for each worker process and file."""
    if path not in _made:
        _made[path] = WordIds(path)
    return _made[path]
