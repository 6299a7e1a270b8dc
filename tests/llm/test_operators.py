"""The training-data operators against brute force on small inputs with awkward rows."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from candlewick.llm import _common
from candlewick.llm import components as components_module
from candlewick.llm import (bpe_count, decontamination, embedding_dedup, labelled, language_id, packing, quality,
                            simhash_dedup, substring_dedup, token_output, toxicity)
from candlewick.llm.components import components
from candlewick.llm.queries import ready
from candlewick.session import session_conf
from tests.conftest import SMOKE_DIR

VOCABULARY = "zero one two three four five six seven eight nine ten Étude déjà naïve can't <b> 42 x|y".split()
# Columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, fp long, tie int, spans string, row int"


def _texts() -> list[tuple[int | None, str | None]]:
    pick = random.Random(5)
    passage = " ".join(pick.choice(VOCABULARY) for _ in range(60))
    rows: list[tuple[int | None, str | None]] = [(0, ""), (1, None), (2, " \n\t"), (3, "one"), (4, "One two\x0bthree"),
                                                 (5, "<|endoftext|> \x1c日本 İΣ́"), (6, "word " * 5000)]
    for k in range(7, 40):
        own = " ".join(pick.choice(VOCABULARY) for _ in range(pick.randint(0, 80)))
        rows.append((k, f"{own} {passage if k % 3 == 0 else ''}  {own if k % 7 == 0 else ''}"))
    rows += [(100, rows[9][1]), (101, rows[9][1]), (102, (rows[10][1] or "") + " tail"), (7, rows[7][1]), (None, "null id one two")]
    return rows


ROWS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    ready(spark)
    data = [(i, t, "en", "s", 0, 1, 2, 3, "z", 4) for i, t in ROWS]
    return spark.createDataFrame(data, SCHEMA).repartition(5).checkpoint()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, docs, empty, tokens):
    manifest = token_output.write_tokens(docs, partitions=3)
    got = token_output.read_index(manifest).collect()
    assert len(got) == len(ROWS)
    want = sorted((i is not None, i or 0, len(tokens(t)) + 1, crc(tokens(t) + [1])) for i, t in ROWS)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    # Only the documents asked for are decompressed.
    file = max(manifest.collect(), key=lambda r: r.number)
    some = token_output.read_documents(spark, file.root, file.file, [101, 102, 9999])
    assert set(some) == {101, 102} and some[101].tolist() == tokens(ROWS[9][1]) + [1]
    assert token_output.token_output(empty).collect() == []


def test_token_file_detects_damage(tmp_path):
    path = tmp_path / "f"
    with open(path, "wb") as sink:
        w = token_output.FrameWriter(sink)
        w.add(3, np.arange(1000, dtype=np.uint32))
        w.add(None, np.zeros(0, np.uint32))
        w.close()
    raw = bytearray(path.read_bytes())
    with open(path, "rb") as f:
        r = token_output.FrameReader(f, len(raw))
        assert r.ids(0).tolist() == list(range(1000)) and r.ids(1).tolist() == [] and r.null.tolist() == [False, True]
    raw[20] ^= 1
    path.write_bytes(raw)
    with open(path, "rb") as f, pytest.raises(Exception):
        token_output.FrameReader(f, len(raw)).ids(0)


def test_token_counts(docs, empty, tokens):
    got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in bpe_count.token_counts(docs).collect())
    want = sorted((len((t or "").encode()), len(tokens(t)), len(tokens(t)) > 2048) for _, t in ROWS)
    assert got == want
    assert bpe_count.token_counts(empty).collect() == []


def test_word_memory_equals_the_library():
    from candlewick.llm.word_ids import WordIds
    own, count = WordIds("word_bpe_49k.json", memo_words=50), bpe_count.Counter("word_bpe_49k.json", memo_words=50)
    parts = ["a", "B", "é", "É", "ß", "×", "÷", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "'s", "'", "<|endoftext|>", "<",
             "<|ENDOFTEXT|>", "1", "²", "½", "ª", "Ÿ", "İ", "Σ", "é", "́", "日本", "😀", ".", "!!", "\x00", "'LL", "‍"]
    pick = random.Random(2)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(3000)]
    array = pa.array(texts, pa.large_string())
    (ids, offs), n = own.encode(array), count.counts(array)
    for k, t in enumerate(texts):
        want = own.tok.encode(t, add_special_tokens=False).ids
        assert ids[offs[k]:offs[k + 1]].tolist() == want and n[k] == len(want), repr(t)


def test_hilbert_key_visits_neighbours():
    grid = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_id_once(docs, empty, tokens):
    pieces = packing.pack(docs, length=64, partitions=3).collect()
    by_sequence, by_text = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_text.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64 and at & (at - 1) == 0  # full, or a power of two: no padding
    for i, t in ROWS:
        ids = tokens(t) + [1]
        own = [p for p in by_text[i, len(ids)]]
        covered = {(p.start, p.length) for p in own}
        assert all(p.ids_crc32 == crc(ids[p.start:p.start + p.length]) for p in own)
        assert sum(n for _, n in covered) >= len(ids)
    assert sum(p.length for p in pieces) == sum(len(tokens(t)) + 1 for _, t in ROWS)
    assert packing.pack(empty).collect() == []


def _fingerprint(t: str | None) -> int:
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
    parts = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def _classes(n: int, linked) -> list[int]:
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            m = min(least[i], least[j])
            changed |= least[i] != m or least[j] != m
            least[i] = least[j] = m
    return least


def test_simhash_classes(docs, empty):
    fps = [_fingerprint(t) for _, t in ROWS]
    linked = [(i, j) for i in range(len(ROWS)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    cls = _classes(len(ROWS), linked)
    least = {c: min((ROWS[k][0] for k in range(len(ROWS)) if cls[k] == c and ROWS[k][0] is not None), default=None) for c in cls}
    want = sorted((str(ROWS[k][0]), f"{fps[k]:016x}", str(least[cls[k]])) for k in range(len(ROWS)))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash_dedup.simhash_classes(docs).collect())
    assert got == want
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} - {None} == {i for i in least.values() if i is not None}
    assert simhash_dedup.simhash_classes(empty).collect() == []


def test_simhash_keeps_one_row_of_each_group(spark, docs):
    pick = random.Random(4)
    a, b, c, d, e, f = (" ".join(pick.choice(VOCABULARY) for _ in range(50)) for _ in range(6))
    rows = [(5, a), (7, a), (5, b), (2, b), (9, c), (9, c), (9, c), (None, d), (None, d), (None, e), (11, e), (None, f), (7, "")]
    frame = spark.createDataFrame([(t, i, k) for k, (i, t) in enumerate(rows)], "text string, doc_id long, fp long").repartition(4)
    got = simhash_dedup.keep_one(frame)
    assert got.columns == frame.columns
    got = got.collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(
        (str(i), t) for i, t in [(5, a), (2, b), (9, c), (None, d), (11, e), (None, f), (7, "")])
    assert all(rows[r.fp] == (r.doc_id, r.text) for r in got)


def _peak(f) -> tuple[list, int]:
    """What ``f`` gives, and the most memory that numpy and Python took for it."""
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_simhash_of_a_long_text_is_counted_in_blocks():
    pick = random.Random(11)
    text = " ".join(pick.choice(VOCABULARY) for _ in range(300_000))
    got, peak = _peak(lambda: simhash_dedup.fingerprints(pa.array(["", text, "one"], pa.large_string())).tolist())
    assert got == [_fingerprint(t) for t in ("", text, "one")]
    assert peak < 40 << 20


def test_simhash_takes_a_batch_in_small_slices():
    pick = random.Random(12)
    texts = [" ".join(pick.choice(VOCABULARY) for _ in range(pick.randint(0, 6000))) for _ in range(200)]
    texts[7], texts[8] = None, ""
    batch = pa.RecordBatch.from_arrays([pa.array(range(200), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    run = simhash_dedup._marker(["doc_id"], 4)
    got, peak = _peak(lambda: [r for b in run(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))])
    assert got == [(k, int(np.uint64(_fingerprint(t)).view(np.int64))) for k, t in enumerate(texts)]
    assert peak < 40 << 20


@pytest.mark.parametrize("limit", [4, 8192])
def test_simhash_links_find_all_near_fingerprints(spark, limit):
    pick = random.Random(9)
    base = [pick.getrandbits(64) for _ in range(20)]
    fps = list({b ^ sum(1 << k for k in pick.sample(range(64), pick.randint(0, 6))) for b in base for _ in range(12)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, limit)
    got = {r.vertex: r.component for r in components(links).collect()}
    cls = _classes(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    for i in range(len(fps)):
        for j in range(i):
            same = got.get(signed[i], signed[i]) == got.get(signed[j], signed[j])
            assert same == (cls[i] == cls[j])


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(201, 240)] + [(5, 5), (None, 3), (300, 301)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 200 for k in range(200, 240)}, 300: 300, 301: 300}


@pytest.fixture
def many_parts(spark):
    """64 shuffle partitions that are not joined, as in a session set up for much larger tables."""
    own = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with session_conf(spark, own):
        yield 2 * spark.sparkContext.defaultParallelism


def test_small_scratch_tables_are_written_by_few_tasks(spark, many_parts, monkeypatch):
    files = {}

    def written(df, name, materialise=_common.materialise):
        out = materialise(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    for module in (components_module, labelled, packing, simhash_dedup, substring_dedup):
        monkeypatch.setattr(module, "materialise", written)
    pick = random.Random(8)
    base = [" ".join(pick.choice(VOCABULARY) + str(pick.randint(0, 99)) for _ in range(60)) for _ in range(150)]
    rows = [(k, t) for k, t in enumerate(base)] + [(200 + k, f"{t} tail") for k, t in enumerate(base)]
    rows += [(500, None), (None, "a null id"), (7, base[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).checkpoint()
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")

    labelled.training_rows(docs, labels, "toxic", 1, 3)
    kept = simhash_dedup.keep_one(docs).collect()
    whole = {p.doc_id for p in simhash_dedup.simhash_classes(docs).collect() if p.component_id == p.doc_id}
    assert {r.doc_id for r in kept} == whole and len(kept) == len(whole)
    left = substring_dedup.drop_repeats(docs)
    assert left.rdd.getNumPartitions() <= many_parts
    assert {r.text for r in left.where("doc_id between 200 and 349").collect()} == {"tail"}
    pieces = packing.pack(docs, length=64)
    assert pieces.rdd.getNumPartitions() <= many_parts
    pieces = pieces.collect()
    # More stretches than tasks: their sequences stay apart.
    assert len({p.sequence_id // packing.STRETCH for p in pieces}) > many_parts
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert filled.setdefault(p.sequence_id, 0) == p.offset
        filled[p.sequence_id] += p.length
    assert max(filled.values()) <= 64
    assert {"training_rows", "links", "simhash_links", "members", "least", "classes", "seed_marks"} <= set(files)
    assert max(n for own in files.values() for n in own) <= many_parts, files


@pytest.mark.parametrize("hot", [1, 2, 3, substring_dedup.HOT])
def test_repeated_windows_are_removed_exactly(docs, empty, hot):
    rows = [(i, t) for i, t in ROWS if i is not None and (i, t) != (7, ROWS[7][1])] + [(7, ROWS[7][1])]
    seen, want = set(), {}
    for i, t in [(None, ROWS[-1][1])] + sorted(rows, key=lambda r: r[0]):
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want[i] = (len(words), len(gone), hashlib.sha256(left).hexdigest())
    got = substring_dedup.remove_repeats(docs, digest=True, hot=hot).collect()
    assert len(got) == len(ROWS)
    for r in got:  # the repeated row of doc 7 gets the same result as its twin
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id], r.doc_id
    cut = substring_dedup.drop_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    untouched = {i for i, w in want.items() if not w[1]}
    assert {(r.doc_id, r.text) for r in cut.collect() if r.doc_id in untouched} == {(i, t) for i, t in ROWS if i in untouched}
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_decontamination(spark, docs, empty, monkeypatch):
    items = [(1, "zero one"), (2, ""), (3, None), (None, "one two three"), (4, "Zero, ONE two!"),
             (5, re.sub("[a-z]+", lambda m: m[0].upper(), " ".join((ROWS[9][1] or "").split()[:14]))), (6, "absent words only here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).update([str(i)] if i is not None else [])
    want = []
    for i, t in ROWS:
        w, hit, found = split(t), set(), set()
        for window, names in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k:k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found |= names
        want.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert any(x[5] for x in want) and not all(x[5] for x in want)
    for block_bytes in (16 << 20, 20):  # one block, and several
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
        got = decontamination.contamination(docs, bench).collect()
        assert sorted((str(r.doc_id), *tuple(r)[1:6]) for r in got) == sorted(want)
    kept = decontamination.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not x[5] for x in want)
    assert decontamination.contamination(empty, bench).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(docs, bench.where("false")).collect())


def test_decontamination_longest_and_shared_windows(spark):
    pick = random.Random(4)
    passage = [f"p{k}" for k in range(15)]
    items = [(k, " ".join([*passage[:12], *(f"own{k}x{j}" for j in range(4))])) for k in range(40)] + [(None, " ".join(passage))]
    texts = [" ".join(["a", *passage, f"b{k}"]) for k in range(30)] + [" ".join(passage[:11]), " ".join(passage[1:9]),
             " ".join(["x", *passage[:12], "own7x0", "own7x1", "other"])]
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    report = {r.doc_id: r for r in decontamination.contamination(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(2),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [report[k].longest for k in range(33)] == [15] * 30 + [11, 0, 14]
    assert [report[k].n_items for k in range(33)] == [40] * 31 + [0, 40]
    # Occurrences of distinct windows grow with the words, not with documents times items.
    block = decontamination.Block(pa.table({"item_id": [str(i) for i, _ in items], "text": [t for _, t in items]}), 10)
    words, offs = decontamination.item_words(pa.array(texts, pa.large_string()))
    found, word, *_ = decontamination.locate(block, words, offs)
    assert len(found) == len(set(zip(found.tolist(), word.tolist()))) <= len(words)


@pytest.mark.parametrize("hot", [1, 2, substring_dedup.HOT])
def test_repeats_in_texts_that_share_an_id(spark, hot, monkeypatch):
    """Texts of one id with a common seed, before and after another document's; many copies; many null ids."""
    monkeypatch.setattr(substring_dedup, "RUN_LIMIT", 3)
    pick = random.Random(8)
    new = iter(range(10 ** 6))
    word = lambda: f"w{next(new)}"
    shared = [word() for _ in range(25)]
    head = [word() for _ in range(12)]
    rows = []
    for own in (5, 9):
        for _ in range(4):
            rows.append((own, " ".join([*head, *shared, *(word() for _ in range(6))])))
    for other in (1, 7, 11):
        rows.append((other, " ".join([*(word() for _ in range(other)), *shared[:22], *(word() for _ in range(9))])))
    long = " ".join(word() for _ in range(40))
    rows += [(20, long)] * 30 + [(19, long)]
    rows += [(None, " ".join([*shared[3:], *(word() for _ in range(pick.randint(0, 5)))])) for _ in range(12)]
    seen, want = {}, {}
    place = lambda r: (r[0] is not None, r[0] or 0)
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            at = (*place((i, t)), k)
            seen[key] = min(seen.get(key, at), at)
    for i, t in set(rows):
        w = t.split()
        gone = set()
        for k in range(len(w) - 19):
            if seen[tuple(w[k:k + 20])] < (*place((i, t)), k):
                gone.update(range(k, k + 20))
        want[i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()] = t
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), digest=True, hot=hot)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()]
    assert len(got) == len(rows) and set(got) == set(want)


def test_ranges_of_repeated_rows_are_listed_once(spark):
    long = " ".join(f"v{k}" for k in range(40))
    docs = spark.createDataFrame([(1, long)] + [(5, long)] * 200, "doc_id long, text string").repartition(7)
    src = docs.withColumn("doc_id", docs["doc_id"])
    spans = substring_dedup._with_spans(src, substring_dedup.repeated_windows(docs), "left").collect()
    assert {len(r.spans or []) for r in spans if r.doc_id == 5} == {len(next(r.spans for r in spans if r.doc_id == 5))}
    assert sum(len(r.spans or []) for r in spans) <= 200 * 2 * 21


def test_keep_one_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 1, 2, 3), (2, "a b c d e", 4, 5, 6), (2, "a b c d e", 4, 5, 6)],
                                 "doc_id long, text string, _doc int, _tie int, __doc int")
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


@pytest.mark.parametrize("limit", [8, 2048])
def test_embedding_classes(spark, limit, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BUCKET_LIMIT", limit)
    g = np.random.default_rng(3)
    base = g.standard_normal((6, 16))
    rows = [(k, 1, (base[k % 6] + 0.09 * g.standard_normal(16)).tolist()) for k in range(60)]
    rows += [(60, 2, rows[0][2]), (61, 1, rows[0][2]), (62, 1, [0.0] * 16), (63, 1, None), (64, None, rows[0][2]),
             (65, 1, [float("nan")] + [1.0] * 15), (66, 1, [None] + [1.0] * 15), (67, 1, [1.0, 2.0]), (68, 1, [])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS key", "2 AS rep")
    ok = {i: np.array(v) / np.linalg.norm(v) for i, lab, v in rows
          if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, lab, _ in rows}
    near = [(a, b) for a in ok for b in ok if a > b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.98]
    least = _classes(len(rows), near)
    count = {i: sum(i in p for p in near) for i, _, _ in rows}
    got = sorted(tuple(r) for r in embedding_dedup.vector_classes(frame).collect())
    assert got == [(i, count[i], least[i], least[i] == i) for i, _, _ in rows]
    assert len(near) > 20
    assert embedding_dedup.vector_classes(frame.where("false")).collect() == []


def test_tables_for_the_threshold():
    assert embedding_dedup.miss_chance(0.98) <= embedding_dedup.MISS


@pytest.fixture(scope="module")
def small(spark):
    directory = SMOKE_DIR.replace("sf0.001", "sf0.01")
    return [ready(spark).read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "labels")]


def test_language_of_held_out_documents(spark, small, empty):
    documents, _ = small
    got = language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98 and all(0 <= r.score <= 1 for r in got)
    odd = documents.limit(30).unionByName(spark.createDataFrame(
        [(1005, None, "en", "s", 0), (1010, "12 !", None, "s", 0), (None, "the of and", "en", "s", 0)], documents.schema))
    by_id = {r.doc_id: r for r in language_id.identify(odd).collect()}
    assert by_id[1005].lang_pred == by_id[1010].lang_pred == "und" and by_id[None].held_out
    assert language_id.identify(empty).collect() == []


def test_rank_order_counts():
    counts = {}
    for g, n, c in zip(*language_id.gram_counts(["Ab b", "", "é"], np.arange(3), 3)):
        counts.setdefault(int(g), []).append(int(c))
    # a, b(2); ^a ab b$(2) ^b; ^ab ab$ ^b$
    assert sorted(counts[0]) == [1, 1, 1, 1, 1, 1, 1, 2, 2] and sorted(counts[2]) == [1, 1, 1, 1] and 1 not in counts


def test_quality_and_toxicity_of_held_out_documents(spark, small, empty):
    documents, labels = small
    got = quality.score(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.quality == r.predicted for r in got]) > 0.95
    got = toxicity.severity(documents, labels).withColumnRenamed("toxic", "found").join(labels, "doc_id").where("held_out").collect()
    assert np.mean([bool(r.toxic) == r.found for r in got]) > 0.93
    assert all(0 <= r.severity <= 3 for r in got)
    kept = toxicity.remove_toxic(documents, labels)
    assert kept.columns == documents.columns and 0 < documents.count() - kept.count() < 200
    odd = documents.limit(300).unionByName(spark.createDataFrame([(None, None, None, None, None), (5000, "", "en", "s", 0)], documents.schema))
    more = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5000, None, None), (0, 0, 0), (0, 1, 1)], labels.schema))
    assert quality.score(odd, more).count() == toxicity.severity(odd, more).count() == 302
    assert quality.score(empty, labels).collect() == [] and toxicity.severity(empty, labels).collect() == []
    none = labels.where("false")
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert not any(r.toxic for r in toxicity.severity(odd, none).collect())


def test_toxicity_learns_from_few_labels(spark, docs):
    pick = random.Random(8)
    own = ["".join(pick.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows = []
    for k in range(240):
        words = [pick.choice(own) for _ in range(40)]
        if k % 6 == 0:
            words[pick.randrange(40)] = ("vilething", "slurword")[k // 6 % 2]
        rows.append((k, " ".join(words), int(k % 6 == 0)))
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    # Under 64 labels of training rows: a term that separates the classes has under 8 standard errors.
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 80], "doc_id long, toxic int")
    truth = {i: bool(y) for i, _, y in rows}
    got = [r for r in toxicity.severity(documents, labels).collect() if r.doc_id >= 80 or r.held_out]
    assert len(got) > 160
    assert np.mean([r.toxic for r in got if truth[r.doc_id]]) > 0.9
    assert np.mean([r.toxic for r in got if not truth[r.doc_id]]) < 0.03
    assert documents.count() - toxicity.remove_toxic(documents, labels).count() >= 36


def test_training_rows_are_bounded_and_fill_the_bound(spark, docs):
    rows = [(1, f"text {k}") for k in range(60)] + [(k, f"own {k}") for k in range(2, 30)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Most labels have no document.
    labels = spark.createDataFrame([(k, k % 2) for k in [*range(1, 30), *range(1000, 1400)]], "doc_id long, toxic int")
    for limit, want in ((10, 10), (100, 29)):
        got = labelled.training_rows(documents, labels, "toxic", -1, 3, limit).collect()
        assert len(got) == len({r.doc_id for r in got}) == want
        assert all((r.doc_id, r.text) in rows and r.y == r.doc_id % 2 for r in got)


def test_dual_coordinate_descent_separates():
    g = np.random.default_rng(0)
    y = np.where(g.random(200) < 0.5, 1.0, -1.0)
    rows = [(np.array([0, 1]), np.array([label * (1 + g.random()), g.standard_normal()])) for label in y]
    w = quality.dual_coordinate_descent(rows, y, 2, np.ones(200))
    assert all(np.sign(w[f] @ v + w[-1]) == label for (f, v), label in zip(rows, y))


def test_ordinal_thresholds_are_ordered():
    g = np.random.default_rng(1)
    x = g.random((400, 3)) < 0.4
    grade = np.clip(x[:, 0].astype(int) * 2 + x[:, 1], 0, 3)
    doc, feature = np.nonzero(x)
    w, t = toxicity.fit_ordinal(doc, feature, grade, 3)
    assert (np.diff(t) > 0).all() and w[0] > w[1] > w[2]


def test_pipeline_stages(spark):
    import corpus_pipeline
    directory = SMOKE_DIR
    documents = ready(spark).read.parquet(f"{directory}/documents.parquet")
    stage = documents
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, stage, directory)
        assert after.columns == documents.columns, name
        after = after.checkpoint()
        assert 0 < after.count() <= stage.count()
        stage = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, stage, directory).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in stage.collect()}
    assert {p.doc_id for p in corpus_pipeline.run(spark, directory).collect()} == {p.doc_id for p in pieces}
