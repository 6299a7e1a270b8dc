"""The corpus pipeline stage by stage on odd rows, each stage against a brute-force rule on its own input."""

import random
import re

import pytest
import xxhash

import corpus_pipeline
from candlewick.llm.queries import ready
from tests.conftest import SMOKE_DIR

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row int, left string, _doc int, tie int, fp long"


def odd_rows():
    pick = random.Random(21)
    vocabulary = [f"word{k}" for k in range(400)]
    text = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    passage, leak = text(60), text(14)
    rows = [(0, ""), (1, None), (2, " \n"), (3, "one"), (None, "a null id"), (None, None)]
    rows += [(k, text(pick.randint(30, 90))) for k in range(10, 40)]
    rows += [(k, f"{text(12)} {passage} {text(9)}") for k in range(50, 56)]
    rows += [(60, f"{text(8)} {leak} {text(20)}"), (61, rows[7][1]), (61, "another text of one id"), (10, rows[6][1])]
    rows += [(70, rows[9][1])] * 3 + [(80, text(30_000))]
    return rows, leak


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    ready(spark)
    rows, leak = odd_rows()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    data = [(i, t, "en", "s", len(t or ""), 1, "l", 2, 3, 4) for i, t in rows]
    spark.createDataFrame(data, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    # Labels that the rows of this table do not have: nothing is toxic by them.
    spark.createDataFrame([(9_000, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak), (None, "never there at all in any of these texts here")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def fingerprint(t):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
    parts = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def one_of_each(rows):
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def without_repeats(rows):
    seen, out = {}, []
    place = lambda i: (i is not None, i or 0)
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            seen[key] = min(seen.get(key, (*place(i), k)), (*place(i), k))
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = {p for k in range(len(w) - 19) if seen[tuple(w[k:k + 20])] < (*place(i), k) for p in range(k, k + 20)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    return out


def test_stages_on_odd_rows(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "substring", "decontaminate", "pack"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, tables)
        if name == "pack":
            pieces = after.collect()
            ends = {(p.doc_id, p.doc_tokens) for p in pieces}
            assert len({p.doc_id for p in pieces}) == len({i for i, _ in before}) and ends
            break
        assert after.columns == columns
        rows = [(r.doc_id, r.text) for r in after.collect()]
        if name == "toxicity":
            assert sorted(rows, key=repr) == sorted(before, key=repr)
        elif name == "simhash":
            group = one_of_each(before)
            assert len(rows) == len(set(group))
            assert set(rows) <= set(before)
            assert len({group[before.index(r)] for r in rows}) == len(rows)
        elif name == "substring":
            assert sorted(rows, key=repr) == sorted(without_repeats(before), key=repr)
            sizes = {(r.doc_id, r.text): r.n_chars for r in after.collect()}
            assert all(n == len(t or "") for (_, t), n in sizes.items())
        else:
            assert set(before) - set(rows) == {r for r in before if r[0] == 60} and len(rows) == len(before) - 1
        kept[name] = len(rows)
        path = f"{tables}/after_{name}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    assert kept["simhash"] < kept["toxicity"] and kept["substring"] == kept["simhash"]


def test_stages_on_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).collect() == []


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMOKE_DIR}/labels.parquet").collect()}
    left = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, SMOKE_DIR).collect()}
    clean = [i for i, t in labels.items() if t == 0]
    toxic = [i for i, t in labels.items() if t == 1]
    assert sum(i in left for i in clean) >= 0.98 * len(clean)
    assert sum(i not in left for i in toxic) >= 0.5 * len(toxic)
