"""Document fingerprints, embedding whitening and conversation repair against brute force."""

import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import conversation_repair as repair
from candlewick.llm import embedding_whitening as whitening
from candlewick.llm import fingerprints as fp
from candlewick.llm import queries
from tests.conftest import SMOKE_DIR

# -- fingerprints -----------------------------------------------------------


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def xx(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def rank(i: int, j: int) -> int:
    return signed(xx(struct.pack("<i", j), xx(struct.pack("<i", i))))


def brute_fingerprint(text: str) -> str:
    w = words_of(text)
    hashes = []
    if len(w) >= 5:
        for i in range(len(w) - 4):
            h = 42
            for s in w[i:i + 5]:
                h = xx(s.encode(), h)
            hashes.append(h >> 1)
    else:
        hashes.append(xx(struct.pack("<i", len(w)), xx("\n".join(w).encode())) >> 1)
    bins: dict[int, int] = {}
    for h in hashes:
        bins[h >> 55] = min(bins.get(h >> 55, h), h)
    filled = dict(bins)
    for i in range(256):
        if i not in bins:
            bins[i] = filled[min(filled, key=lambda j: rank(i, j))]
    return "".join(f"{bins[i] & 15:x}" for i in range(256))


SCHEMA = "doc_id long, text string, _tie long, _b int, _n long, next_text string, fingerprint string, lang string"


def _documents():
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["日本", "Étude", "x|y"]
    rows = [(0, ""), (1, None), (2, " \n\t\x0b"), (3, "one"), (4, "a b c d"), (5, "a b c d e"), (6, "\x1c é \x85 ü z q")]
    for k in range(7, 60):
        rows.append((k, " ".join(pick.choice(vocabulary) for _ in range(pick.choice([1, 6, 30, 120, 400, 900])))))
    rows += [(70, rows[20][1]), (71, rows[20][1]), (8, "another text of one id"), (None, "null id"), (None, None),
             (80, "long " * 60_000)]
    rows += [(90, "copy of a row " * 9)] * 12
    return rows


@pytest.fixture(scope="module")
def doc_rows():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, doc_rows):
    queries.ready(spark)
    return spark.createDataFrame([(i, t, 1, 2, 3, "n", "f", "en") for i, t in doc_rows], SCHEMA).repartition(5).checkpoint()


def in_order(rows):
    tie = [((i is not None, i or 0), signed(xx((t or "").encode())), t or "", i) for i, t in rows]
    return [(i, t) for _, _, t, i in sorted(tie, key=lambda r: r[:2])]


def check_pairs(rows, got):
    order = in_order(rows)
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        want.append((i, t, t[:len(t) - half] + following[:half], following))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited) for r in got) == sorted(
        (i is not None, i or 0, len(t), e) for i, t, e, _ in want)
    prints = {}
    by = {(r.doc_id, r.n_chars, r.edited): r for r in got}
    for i, t, e, following in want:
        r = by[i, len(t), e]
        for text in (t, e, following):
            if text not in prints:
                prints[text] = brute_fingerprint(text)
        assert r.f == prints[t] and r.ef == prints[e]
        for value, other in ((r.near_edited, prints[e]), (r.near_next, prints[following])):
            same = sum(a == b for a, b in zip(prints[t], other)) / 256
            assert value == pytest.approx(max(0.0, (same - 1 / 16) / (15 / 16)), abs=1e-12)


def shown(pairs):
    return pairs.select("*", fp.hex_text(F.col("fingerprint")).alias("f"), fp.hex_text(F.col("edited_fingerprint")).alias("ef"))


def test_fingerprints_equal_brute_force(docs, doc_rows):
    check_pairs(doc_rows, shown(fp.edited_pairs(docs)).collect())


def test_rows_with_many_copies_go_through_as_one(docs, doc_rows, monkeypatch):
    monkeypatch.setattr(fp, "HEAVY", 3)
    spark = docs.sparkSession
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        check_pairs(doc_rows, shown(fp.edited_pairs(docs)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_document_and_none(docs):
    assert fp.edited_pairs(docs.where("false")).collect() == []
    one = fp.edited_pairs(docs.where("doc_id = 5")).collect()
    assert [(r.doc_id, r.n_chars, r.edited, r.near_next) for r in one] == [(5, 9, "a b ca b ", 1.0)]
    assert len(fp.edited_pairs(docs.where("doc_id is null")).collect()) == 2


def test_fingerprint_likeness_estimates_jaccard(spark):
    pairs = fp.edited_pairs(spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()}
    off = []
    for r in pairs:
        a, b = shingle_set(text[r.doc_id]), shingle_set(r.edited)
        off.append(r.near_edited - len(a & b) / len(a | b))
    assert np.abs(off).mean() < 0.04 and abs(np.mean(off)) < 0.01


def test_fingerprint_plan_has_no_python(docs):
    plan = fp.edited_pairs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


# -- whitening --------------------------------------------------------------

def test_bit_sliced_products_are_exact():
    rng = np.random.default_rng(1)
    for lo, hi, n, d in ((-40, 40, 1000, 8), (-(1 << 62), 1 << 62, 130, 3), (5, 6, 64, 3), (0, 1, 1, 1), (-3, 100_000, 4097, 5)):
        z = rng.integers(lo, hi, (n, d), dtype=np.int64)
        assert (whitening._unpack(whitening._pack(z), d) == z).all()
        sums, cross = whitening.bit_sliced(z)
        exact = z.astype(object)
        c = exact.T @ exact
        assert sums == list(exact.sum(0)) and all(cross[j] == list(c[j, j:]) for j in range(d))


VECTORS = "vec_id long, embedding array<float>, label int, key string, d int, n long"


def _vectors():
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(6, 6))
    rows = [(k, [float(v) for v in rng.normal(size=6) @ mix], k % 3, "k", 1, 2) for k in range(200)]
    rows += [(300 + k, rows[5][1], 0, "k", 1, 2) for k in range(50)]        # a hot vector
    rows += [(5, rows[6][1], 0, "k", 1, 2), (None, rows[7][1], None, "k", 1, 2)]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    return rows + [(400 + k, v, 0, "k", 1, 2) for k, v in enumerate(bad)]


def check_whitening(rows, got, keep=16):
    kept = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(0)
    cov = ((n * (fit.T @ fit) - np.outer(sums, sums)) / (n * n)).astype(float)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(keep, 6)
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    for c in range(1, k + 1):
        w = sorted(float(sum((n * a - s) * u for a, s, u in zip(row, sums, vectors[:, c - 1]))) / n / math.sqrt(values[c - 1])
                   for row in x)
        mine = sorted(r.whitened for r in by[c])
        assert np.allclose(mine, w, atol=1e-9) or np.allclose(sorted(-v for v in mine), w, atol=1e-9)
        assert by[c][0].explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
        assert sorted(r.deviation for r in by[c]) == sorted(int(sum((n * a - s) ** 2 for a, s in zip(row, sums))) for row in x)
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-9 for r in got)


def test_whitening_equals_brute_force(spark):
    queries.ready(spark)
    rows = _vectors()
    vectors = spark.createDataFrame(rows, VECTORS).repartition(4)
    check_whitening(rows, whitening.whiten(vectors).collect())
    assert {r.component for r in whitening.whiten(vectors, components=2).collect()} == {1, 2}
    # One sign for all rows: equal vectors have equal coordinates.
    same = {(r.component, r.whitened) for r in whitening.whiten(vectors).where("vec_id >= 300 and vec_id < 350").collect()}
    assert len(same) == 6


def test_whitening_without_variance(spark):
    vectors = spark.createDataFrame(_vectors(), VECTORS)
    assert whitening.whiten(vectors.where("false")).collect() == []
    assert whitening.whiten(vectors.where("vec_id >= 300 and vec_id < 350")).collect() == []
    assert whitening.whiten(vectors.where("vec_id >= 400")).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(k, [float(v)] * 1 + [float(k)]) for k, v in enumerate([1e9, -1e9, 1e15, 3.0, 1e17])] + [(9, [1e18, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3, 4}      # 64 * 1e18 is no long
    assert all(r.deviation is None for r in got if r.vec_id == 4)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows[:5]]
    s = [sum(c) for c in zip(*x)]
    exact = {k: sum((5 * a - t) ** 2 for a, t in zip(v, s)) for k, v in enumerate(x)}
    for r in got:
        assert r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None)


# -- conversations ----------------------------------------------------------

NEXT = {"S": {"s": "P", "u": "A"}, "P": {"u": "A"}, "U": {"u": "A"}, "A": {"a": "U"}}


def best_edits(turns):
    """All ways through the grammar's states, kept by state: (cost, audit, repaired turns); least cost, then least audit."""
    here = {"S": (0, "", ())}
    for role, text, must, cut in turns:
        here = widen(here)
        after = {}

        def offer(state, way):
            if state not in after or way[:2] < after[state][:2]:
                after[state] = way

        for state, (cost, audit, out) in here.items():
            offer(state, (cost + 3, audit + "D", out))
            if must:
                continue
            for symbol, then in NEXT[state].items():
                stay = cost + (1 if cut else 0)
                if symbol == role[:1]:
                    offer(then, (stay, audit + "K", out + ((role, text),)))
                elif symbol != "s":
                    offer(then, (stay + 2, audit + "R", out + (({"u": "user", "a": "assistant"}[symbol], text),)))
        here = after
    here = widen(here)
    return min((here[s] for s in "SU" if s in here), key=lambda w: w[:2])


def widen(here):
    """With up to three insertions."""
    here = dict(here)
    for _ in range(3):
        for state, (cost, audit, out) in list(here.items()):
            for symbol, then in NEXT[state].items():
                if symbol != "s":
                    way = (cost + 2, audit + "I", out + (({"u": "user", "a": "assistant"}[symbol], ""),))
                    if then not in here or way[:2] < here[then][:2]:
                        here[then] = way
    return here


def brute_audits(rows):
    """The contract's rows, worked out one by one."""
    kept, ids = {}, set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept.setdefault(conv, []).extend([(turn is not None, turn or 0, role.encode(), text.encode(), role, text)] * (2 if fault == 3 else 1))
    out = {}
    for conv in ids:
        turns = sorted(kept.get(conv, []))
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        blank = twice = cut = 0
        seen, steps = set(), []
        for *_, role, text in turns:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "twice" if (role, text) in seen else "cut" if last[0] not in ".!?" else ""
            blank, twice, cut = blank + (fault == "blank"), twice + (fault == "twice"), cut + (fault == "cut")
            seen.add((role, text))
            steps.append((role, text, fault in ("blank", "twice"), fault == "cut"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:]))
        cost, audit, made = best_edits(steps)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, blank, twice, cut, illegal, cost, audit, sha)
    return out


TALK = "conv_id long, turn long, role string, text string, audit string, copy int, kind int, dropped boolean"


def _talks():
    pick = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Ja. \t", "x", "日本。", "\x85", "One more."]
    rows = []
    for conv in range(400):
        for turn in range(pick.choice([0, 1, 2, 3, 4, 6, 9])):
            role = ("user", "assistant")[turn % 2] if pick.random() < 0.8 else pick.choice(["system", "umpire", "", None, "User"])
            text = f"{pick.choice(texts)}" if pick.random() < 0.4 else f"turn {conv} {turn}."
            rows.append((conv, turn if pick.random() < 0.95 else None, role, text if pick.random() < 0.97 else None))
    rows += [(7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, "assistant", "same"), (None, None, None, None),
             (None, 3, "user", "Hi."), (None, 4, "assistant", "Hi you."), (500, 10, "system", "Only rules.")]
    rows += [(600, k, ("user", "assistant")[k % 2], f"{'long text ' * (k % 5)}{k}.") for k in range(1500)]
    rows += [(700, k, pick.choice(["user", "assistant", "system"]), f"say {k}{pick.choice(['.', ''])}") for k in range(700)]
    rows += [(k, 0, "user", "Dropped.") for k in range(800, 1200) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    return rows


def _read(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def test_repair_equals_brute_force(spark, monkeypatch):
    queries.ready(spark)
    rows = _talks()
    talks = spark.createDataFrame([(*r, "a", 1, 2, True) for r in rows], TALK).repartition(6).checkpoint()
    want = brute_audits(rows)
    got = _read(repair.damaged_audits(talks))
    assert got == want
    assert any(v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for k, v in want.items() if k and k >= 800)
    assert list(repair.damaged_audits(talks.where("false")).collect()) == []


def test_long_conversations_are_streamed_past_their_audits(spark, monkeypatch):
    rows = _talks()
    talks = spark.createDataFrame([(*r, "a", 1, 2, True) for r in rows], TALK).repartition(6).checkpoint()
    # The limit travels with the tasks' function only as a module value: the second pass is called for all.
    damaged = repair.damage(talks)
    audits = repair.audit_conversations(damaged)
    late = repair._streamed(audits, damaged, digest=True)
    assert {r.conv_id: r.sha for r in late.collect()} == {r.conv_id: r.repaired_sha256 for r in audits.collect()}


def test_repaired_turns_are_right(spark):
    rows = [r for r in _talks() if r[0] is not None]
    talks = spark.createDataFrame([(*r, "a", 1, 2, True) for r in rows], TALK)
    made = {}
    for r in repair.repair_conversations(talks).orderBy("conv_id", "step").collect():
        made.setdefault(r.conv_id, []).append(r)
    assert set(made) == {r[0] for r in rows}
    for turns in made.values():
        assert [t.step for t in turns] == list(range(len(turns)))
        roles = "".join(t.role[:1] for t in turns if t.edit != "D")
        assert re.fullmatch(r"(s?(ua)+)?", roles)


def test_blocks_align_as_the_whole():
    pick = random.Random(2)
    for _ in range(300):
        turns = bytes(pick.choice([0, 1, 2, 2, 2, 3, 3, 3]) | pick.choice([0, 0, 0, 4, 8]) for _ in range(pick.randint(0, 30)))
        turns = bytes(c & ~8 if c & 4 else c for c in turns)
        whole = repair.align(turns, 256)
        assert all(repair.align(turns, k) == whole for k in (1, 2, 5, 13))
        way = best_edits([({0: "x", 1: "s", 2: "u", 3: "a"}[c & 3], "t", bool(c & 4), bool(c & 8)) for c in turns])
        assert whole == way[:2]
