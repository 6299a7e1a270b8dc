"""Conversation structure repair: the cheapest edits that make the turns alternate.

A conversation is right if its role initials read ``(s?(ua)+)?``: an optional system turn,
then pairs of user and assistant.  Edits of a turn: Keep (0), Rerole to user or assistant
(2), Delete (3; a must for blank and duplicate turns); anywhere Insert an empty user or
assistant turn (2).  A truncated turn that is not deleted adds 1.

Method (Wagner-Fischer against the grammar string): the turns are aligned to each feasible
length of the alternating string.  The strings of all lengths share their ends, so one
table of suffixes holds every length: cell (i, r) is the least cost of turning the turns
from i on into the last r symbols.  A first alignment without search gives the incumbent
cost; Ukkonen's band keeps only the cells that can lie on an alignment no dearer than that.
For each length of least cost the edits are traced back by the least letter that stays
optimal, and the audits of the lengths are compared (ASCII-least wins).

A long conversation is aligned in blocks of ``BLOCK`` turns: within a block to all lengths
between each pair of states of the grammar (``S`` nothing said, ``P`` only the system turn,
``U`` user next, ``A`` assistant next), then the blocks are chained from the end by cost and audit.  So time
and memory grow with the turns, not with their square.

Where rows go: damaged turns are dealt by conversation and sorted, each conversation is
read as a stream; of a turn 1 byte and 16 bytes of digest are kept, and its text only up
to ``HOLD_BYTES`` a conversation.  A conversation beyond that gets its edits first, and its
texts in a second pass that streams them past the audit.  One conversation stays in one
task: its audit and hash are single values over all its turns in order.  Duplicate turns
are found by 128-bit digests.

Defined results: a null role or text reads as one space (so does a null ``conv_id`` or
``turn`` in the damage key); null ``conv_id``s are one conversation; turns that tie on
``turn`` are ordered by role, then text (repeated rows stand together); an unknown or empty
role has no place in the grammar by itself and must be reroled or deleted; texts of any
length are read whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlewick.llm._common import materialise, plain

#: ASCII white space, as in the word patterns of the other operators.
BLANKS = " \t\n\x0b\x0c\r"
#: Turns aligned in one table.
BLOCK = 256
#: Text of one conversation that is held while its turns are read.
HOLD_BYTES = 8 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_MUST, _CUT = 4, 8            # flags beside the role code
_OTHER, _S, _U, _A = 0, 1, 2, 3
_ROLES = {"s": _S, "u": _U, "a": _A}
_INF = 1 << 60


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: conv_id, turn, role, text, copy, dropped.

    crc32 of ``conv_id:turn`` mod 20: 0 drops a row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it a user turn.  Dropped rows come out marked.
    """
    rows = plain(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(said.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault <= 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (fault == 0).alias("dropped"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the shape of ``damage``."""
    rows = plain(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("dropped"))


# -- alignment --------------------------------------------------------------

def _incumbent(turns: bytes, first: int, last: int) -> int:
    """Cost of a plain alignment: mended turn by turn, a wrong end mended by one insertion."""
    want, cost = first, 0
    for c in turns:
        if c & _MUST:
            cost += DELETE
            continue
        cost += TRUNCATED if c & _CUT else 0
        cost += KEEP if c & 3 == want else REROLE
        want = _A if want == _U else _U
    return cost + (INSERT if want != last else 0)


class _Table:
    """Least costs of turning turns i.. into the last r symbols of ...uaua that end before ``last``.

    Only cells within the band of ``limit`` are there; ``system`` adds the table of
    alignments that still have the system turn to keep.
    """

    def __init__(self, turns: bytes, last: int, limit: int, system: bool):
        self.turns, self.last, n = turns, last, len(turns)
        #: Symbol with r symbols left (r odd, r even).
        self.odd, self.even = (_A, _U) if last == _U else (_U, _A)
        live, must = [0] * (n + 1), [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            gone = bool(turns[i] & _MUST)
            live[i], must[i] = live[i + 1] + (not gone), must[i + 1] + gone
        slack = limit - DELETE * must[0]
        more, fewer = slack // INSERT, slack // DELETE
        self.low = [max(0, live[i] - fewer - 1) for i in range(n + 1)]
        self.rows: list[list[int]] = [[]] * (n + 1)
        self.system: list[list[int]] | None = [[]] * (n + 1) if system else None
        self.rows[n] = [INSERT * r for r in range(self.low[n], live[n] + more + 1)]
        if system:
            self.system[n] = [_INF] * len(self.rows[n])
        for i in range(n - 1, -1, -1):
            c, low, below, at = turns[i], self.low[i], self.rows[i + 1], self.low[i + 1]
            role, stay = c & 3, TRUNCATED if c & _CUT else 0
            row, before, size = [], _INF, len(below)
            for r in range(low, live[i] + more + 1):
                k = r - at
                best = before + INSERT
                if 0 <= k < size and below[k] + DELETE < best:
                    best = below[k] + DELETE
                if not c & _MUST and 0 < k <= size:
                    cost = below[k - 1] + stay + (KEEP if role == (self.odd if r & 1 else self.even) else REROLE)
                    if cost < best:
                        best = cost
                row.append(best)
                before = best
            self.rows[i] = row
            if system:
                after, keeps = self.system[i + 1], role == _S and not c & _MUST
                self.system[i] = [min(after[r - at] + DELETE if 0 <= r - at < size else _INF,
                                      below[r - at] + stay if keeps and r > 0 and 0 <= r - at < size else _INF)
                                  for r in range(low, low + len(row))]

    def cell(self, i: int, r: int) -> int:
        k = r - self.low[i]
        return self.rows[i][k] if 0 <= k < len(self.rows[i]) else _INF

    def held(self, i: int, r: int) -> int:
        k = r - self.low[i]
        return self.system[i][k] if 0 <= k < len(self.system[i]) else _INF

    def trace(self, r: int, system: bool) -> str:
        """The ASCII-least audit of an optimal alignment to r symbols (after the system turn)."""
        out, i, n = [], 0, len(self.turns)
        while system:
            if self.held(i, r) == self.held(i + 1, r) + DELETE:
                out.append("D")
            else:
                out.append("K")
                system = False
            i += 1
        while i < n or r > 0:
            here = self.cell(i, r)
            if i < n and here == self.cell(i + 1, r) + DELETE:
                out.append("D")
                i += 1
                continue
            if r > 0 and here == self.cell(i, r - 1) + INSERT:
                out.append("I")
            else:
                out.append("K" if self.turns[i] & 3 == (self.odd if r & 1 else self.even) else "R")
                i += 1
            r -= 1
        return "".join(out)

    def best(self, parity: int, least: int, system: bool = False) -> tuple[int, str]:
        """(cost, audit) over all lengths r >= least of a parity, of alignments with or without the system turn."""
        row = self.system[0] if system else self.rows[0]
        lengths = [r for r in range(self.low[0], self.low[0] + len(row)) if r >= least and r & 1 == parity]
        cost = min((row[r - self.low[0]] for r in lengths), default=_INF)
        if cost >= _INF:
            return _INF, ""
        return cost, min(self.trace(r, system) for r in lengths if row[r - self.low[0]] == cost)


def _block(turns: bytes, start: str, end: str) -> tuple[int, str]:
    """Least cost and audit that take a block from state ``start`` to state ``end``; infinite if there is no way."""
    n = len(turns)
    if end == start and end in "SP":
        return DELETE * n, "D" * n
    if end == "P":
        found = [(DELETE * (n - 1) + (TRUNCATED if c & _CUT else 0), "D" * i + "K" + "D" * (n - 1 - i))
                 for i, c in enumerate(turns) if c & 3 == _S and not c & _MUST] if start == "S" else []
        return min(found, default=(_INF, ""))
    if end == "S":
        return _INF, ""
    first, last = _A if start == "A" else _U, _A if end == "A" else _U
    parity = int(first != last)
    # From S and P something must be said, which the incumbent does unless every turn must go.
    least = 2 if start in "SP" and last == _U else parity
    limit = _incumbent(turns, first, last)
    if least == 2 and all(c & _MUST for c in turns):
        limit += 2 * INSERT
    table = _Table(turns, last, limit, start == "S")
    found = table.best(parity, least)
    return min(found, table.best(parity, least, system=True)) if start == "S" else found


class _Link:
    """An audit as a chain of blocks' audits that share their ends."""

    __slots__ = ("cost", "audit", "next")

    def __init__(self, cost: int, audit: str, after: "_Link | None"):
        self.cost, self.audit, self.next = cost, audit, after

    def text(self) -> str:
        out, link = [], self
        while link is not None:
            out.append(link.audit)
            link = link.next
        return "".join(out)

    def below(self, other: "_Link") -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        a, b, x, y = self, other, self.audit, other.audit
        while True:
            k = min(len(x), len(y))
            if x[:k] != y[:k]:
                return x[:k] < y[:k]
            x, y = x[k:], y[k:]
            while not x and a.next is not None:
                if not y and a.next is b.next:
                    return False
                a = a.next
                x = a.audit
            while not y and b.next is not None:
                b = b.next
                y = b.audit
            if not x or not y:
                return len(x) < len(y)


def align(turns: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Least cost of making the turns right, and the ASCII-least audit of that cost.

    A turn is one byte: its role (1 system, 2 user, 3 assistant, 0 other), 4 if it must
    go, 8 if it is truncated.
    """
    if len(turns) <= block:
        if not turns:
            return 0, ""
        return min(_block(turns, "S", "U"), _block(turns, "S", "S"))
    blocks = [turns[i:i + block] for i in range(0, len(turns), block)]
    after: dict[str, _Link | None] = {"S": _Link(0, "", None), "U": _Link(0, "", None)}
    for k in range(len(blocks) - 1, -1, -1):
        here: dict[str, _Link | None] = {}
        for start in ("S",) if k == 0 else ("S", "P", "U", "A"):
            best = None
            for end, link in after.items():
                cost, audit = _block(blocks[k], start, end)
                if cost < _INF:
                    way = _Link(cost + link.cost, audit, link)
                    if best is None or way.below(best):
                        best = way
            if best is not None:
                here[start] = best
        after = here
    return after["S"].cost, after["S"].text()


def repaired(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each edit in order; for deleted turns their own role and text."""
    symbols = len(audit) - audit.count("D")
    want = "user"
    if symbols % 2:
        want = "system"          # an odd length starts with a kept system turn
    for edit in audit:
        role, text = next(turns) if edit != "I" else (want, "")
        if edit == "D":
            yield edit, role, text
            continue
        yield edit, role if edit == "K" else want, text
        want = "assistant" if want == "user" else "user"


# -- tasks ------------------------------------------------------------------

class _Conversation:
    """What is kept of a conversation while its rows stream by."""

    def __init__(self, key):
        self.key, self.codes, self.digests = key, bytearray(), []
        self.first = self.last = None
        self.turns = self.illegal = self.n = 0
        self.initial = ""
        self.texts: list[tuple[str, str]] | None = []
        self.size = 0

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.turns += 1
                self.last = turn
        initial = role[:1]
        if self.n and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.n += 1
        end = text.rstrip(BLANKS)[-1:]
        code = _ROLES.get(initial, _OTHER) | (_MUST if not end else 0) | (_CUT if end not in (".", "!", "?") else 0)
        self.codes.append(code)
        raw = role.encode()
        self.digests.append(hashlib.blake2b(len(raw).to_bytes(8, "little") + raw + text.encode(), digest_size=16).digest())
        if self.texts is not None:
            self.size += len(role) + len(text) + 64
            self.texts.append((role, text))
            if self.size > HOLD_BYTES:
                self.texts = None

    def faults(self) -> tuple[int, int, int]:
        """Blank, duplicate and truncated turns (the first fault of each); duplicates are marked to go."""
        codes = np.frombuffer(self.codes, np.uint8).copy()
        blank = codes & _MUST > 0
        later = np.ones(len(codes), bool)
        if len(codes):
            _, first = np.unique(np.array(self.digests, "V16"), return_index=True)
            later[first] = False
        twice = later & ~blank
        codes[twice] |= _MUST
        cut = (codes & _CUT > 0) & (codes & _MUST == 0)
        codes[~cut] &= 0xFF ^ _CUT
        self.codes = bytearray(codes.tobytes())
        return int(blank.sum()), int(twice.sum()), int(cut.sum())


def _summary_schema(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", key)] + [T.StructField(c, T.LongType()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _turn_schema(key: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", key), T.StructField("step", T.LongType())] + [
        T.StructField(c, T.StringType()) for c in ("edit", "role", "text")])


def _digest(audit: str, turns: Iterator[tuple[str, str]]) -> str:
    sha, first = hashlib.sha256(), True
    for edit, role, text in repaired(audit, turns):
        if edit != "D":
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
    return sha.hexdigest()


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def _audits(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: _Conversation | None = None

        def close(c: _Conversation) -> None:
            blank, twice, cut = c.faults()
            cost, audit = align(bytes(c.codes))
            gaps = int(c.last - c.first + 1 - c.turns) if c.first is not None else 0
            sha = None if c.texts is None else _digest(audit, iter(c.texts))
            done.append((c.key, gaps, blank, twice, cut, c.illegal, cost, audit, sha))

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*done), schema)], schema=schema)
            done.clear()
            return batch

        held = 0
        for key, turn, role, text, dropped in _rows(batches, "conv_id", "turn", "role", "text", "dropped"):
            if now is None or key != now.key:
                if now is not None:
                    close(now)
                    held += len(done[-1][7]) + 200
                    if held > 1 << 20:
                        yield out()
                        held = 0
                now = _Conversation(key)
            if not dropped:
                now.add(turn, role, text)
        if now is not None:
            close(now)
            yield out()
    return run


def _past_audit(schema: pa.Schema, digest: bool):
    """Streams the turns of conversations past their audits (an audit's row comes before its turns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, "conv_id", "audit", "role", "text")
        ahead = next(rows, None)
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return made

        while ahead is not None:
            key, audit = ahead[0], ahead[1]
            ahead = next(rows, None)

            def turns():
                nonlocal ahead
                while ahead is not None and ahead[1] is None:
                    here, ahead = ahead, next(rows, None)
                    yield here[2], here[3]

            if digest:
                out.append((key, _digest(audit, turns())))
                yield batch()
                continue
            for step, (edit, role, text) in enumerate(repaired(audit, turns())):
                out.append((key, step, edit, role, text))
                size += len(text) + 64
                if size > 1 << 20:
                    yield batch()
                    size = 0
        if out:
            yield batch()
    return run


_ORDER = ("turn", "role", "text", "copy")


def _streamed(audits: DataFrame, rows: DataFrame, digest: bool) -> DataFrame:
    """Second pass: audits and turns of the same conversations side by side, sorted."""
    heads = audits.select("conv_id", "audit", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in _ORDER],
                          F.lit(0).alias("kind"))
    body = rows.where("not dropped").select("conv_id", F.lit(None).cast("string").alias("audit"), *_ORDER,
                                            F.lit(1).alias("kind"))
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    key = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), T.StructField("sha", T.StringType())]) if digest else _turn_schema(key)
    return both.select("conv_id", "audit", "role", "text").mapInArrow(_past_audit(to_arrow_schema(schema), digest), schema)


def audit_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``damage``d or ``undamaged`` rows: its faults, cost, audit and the repaired text's hash."""
    schema = _summary_schema(rows.schema["conv_id"].dataType)
    dealt = rows.select("conv_id", "turn", "role", "text", "copy", "dropped").repartition("conv_id").sortWithinPartitions(
        "conv_id", *_ORDER)
    audits = materialise(dealt.mapInArrow(_audits(to_arrow_schema(schema)), schema), "audits")
    long = audits.where("repaired_sha256 is null")
    if long.isEmpty():
        return audits
    # Texts over HOLD_BYTES: the turns of those conversations alone, streamed past their audits.
    wanted = rows.join(long.select(F.col("conv_id").alias("_long")), F.col("conv_id").eqNullSafe(F.col("_long")), "left_semi")
    late = _streamed(long, wanted, digest=True).withColumnRenamed("conv_id", "_late")
    joined = audits.join(late, F.col("conv_id").eqNullSafe(F.col("_late")), "left")
    return joined.select(*[c for c in audits.columns if c != "repaired_sha256"],
                         F.coalesce("repaired_sha256", "sha").alias("repaired_sha256"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """The edited turns in order: conv_id, step, edit (K, R, I; D for turns that go), role, text."""
    rows = undamaged(conversations)
    return _streamed(audit_conversations(rows).select("conv_id", "audit"), rows, digest=False)


def damaged_audits(conversations: DataFrame) -> DataFrame:
    """``audit_conversations`` of the rows with planted faults."""
    return audit_conversations(damage(conversations))
