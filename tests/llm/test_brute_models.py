"""Language profiles and quality indicators against plain Python, and clashing column names."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import language_id, quality, toxicity
from candlewick.llm.queries import ready

CLASH = "doc_id long, text string, lang string, source string, n_chars long, gram long, n long, rank int, y int, key long, score double"


def grams_of(text):
    """1-, 2- and 3-grams inside words, a border counting as a character."""
    out = Counter()
    letters = "".join(c if c.isalpha() else "\n" for c in text.lower())
    for word in letters.split("\n"):
        if not word:
            continue
        closed = f"\0{word}\0"
        for k in range(len(word)):
            out[word[k]] += 1
        for k in range(len(closed) - 1):
            out[closed[k:k + 2]] += 1
        for k in range(len(closed) - 2):
            out[closed[k:k + 3]] += 1
    return out


def ranked(counts, top):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), [ord(c) for c in x[0]]))][:top]


def texts():
    pick = random.Random(13)
    words = {"aa": ["the", "of", "and", "that", "with"], "bb": ["der", "und", "für", "nicht", "ein"], "cc": ["де", "что", "как", "это"]}
    rows = []
    for k in range(120):
        lang = pick.choice(list(words))
        mix = words[lang] + ([pick.choice(words["aa"])] if k % 4 == 0 else [])
        rows.append((k, " ".join(pick.choice(mix) for _ in range(pick.randint(1, 40))) + pick.choice(["", " 12!", "\n"]), lang if k % 9 else None))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "123 !?", "aa"), (203, "İΣ ß ǅ", "cc"), (None, "the of", "aa"), (5, "der und", "bb"),
             (204, " ".join(pick.choice(words["bb"]) for _ in range(60_000)), "bb")]
    return rows


@pytest.mark.parametrize("top", [20, 400])
def test_language_profiles_equal_brute_force(spark, top):
    ready(spark)
    rows = texts()
    docs = spark.createDataFrame([(*r, "s", 1, 2, 3, 4, 5, 6, 0.5) for r in rows], CLASH).repartition(4)
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 0
    counts = {}
    for i, t, lang in rows:
        if not held(i) and lang is not None and t is not None:
            counts.setdefault(lang, Counter()).update(grams_of(t))
    profile = {k: {g: r for r, g in enumerate(ranked(c, top))} for k, c in counts.items()}
    want = []
    for i, t, _ in rows:
        own = ranked(grams_of(t or ""), top)
        if not own:
            want.append((str(i), held(i), "und", 0.0))
            continue
        distance = {k: sum(abs(p[g] - r) if g in p else top for r, g in enumerate(own)) for k, p in profile.items()}
        best = min(distance, key=lambda k: (distance[k], k))
        want.append((str(i), held(i), best, round(1 - distance[best] / (len(own) * top), 9)))
    got = [(str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs, top=top).collect()]
    assert sorted(got) == sorted(want)


def shape(word):
    """The case and script class of a word's letters, runs cut short."""
    kinds = []
    for c in word:
        if "a" <= c <= "z":
            kinds.append("a")
        elif "A" <= c <= "Z":
            kinds.append("A")
        elif "0" <= c <= "9":
            kinds.append("0")
        elif c >= "\x80":
            kinds.append("A" if c == c.upper() != c.lower() else "a")
        else:
            kinds.append(c)
    out = []
    for c in kinds:
        run = 0
        for p in reversed(out):
            if p != c:
                break
            run += 1
        if run < (1 if c in "aA0" else 2):
            out.append(c)
    return "".join(out)


def test_quality_indicators_equal_brute_force():
    pick = random.Random(3)
    parts = ["word", "Word", "WORD", "x1", "2024", "é", "Éa", "!!!", "--", "a.b", "...", "don't"]
    docs = [" ".join(pick.choice(parts) for _ in range(pick.randint(0, 30))) for _ in range(60)] + ["", "one", "word word word"]
    doc, gram = quality.indicators(pa.array(docs, pa.large_string()))
    mine = {}
    for d, g in zip(doc.tolist(), gram.tolist()):
        mine.setdefault(d, set()).add(g)
    want, name = {}, {}
    for d, t in enumerate(docs):
        w = t.split()
        s = [(shape(x), k > 0 and w[k - 1] == x) for k, x in enumerate(w)]
        want[d] = {tuple(s[k:k + n]) for n in (1, 2, 3) for k in range(len(s) - n + 1)}
    # The same sets up to a one-to-one naming of n-grams.
    by_gram, by_shape = {}, {}
    for d in range(len(docs)):
        assert len(mine.get(d, set())) == len(want[d])
        for g in mine.get(d, set()):
            by_gram.setdefault(g, set()).add(d)
        for g in want[d]:
            by_shape.setdefault(g, set()).add(d)
    assert sorted(map(sorted, by_gram.values())) == sorted(map(sorted, by_shape.values())) and not name


def test_quality_scores_follow_the_model(spark):
    """Scores recomputed from the fitted weights; weights fall with the class shares they are scaled by."""
    ready(spark)
    pick = random.Random(5)
    rows = [(k, " ".join(pick.choice(["good", "Fine", "ok."] if k % 2 else ["BAD", "!!!", "x99"]) for _ in range(12)), k % 2) for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, y int").select("doc_id", "y", "text")
    model = quality.fit(train)
    array = pa.array([t for _, t, _ in rows], pa.large_string())
    doc, gram = quality.indicators(array)
    weight = dict(zip(model.grams.tolist(), model.weights.tolist()))
    margin = np.full(len(rows), model.intercept)
    for d, g in zip(doc.tolist(), gram.tolist()):
        margin[d] += weight.get(g, 0.0)
    scores = model.scores(array)
    assert np.allclose(scores, [1 / (1 + math.exp(-model.slope * m)) for m in margin])
    assert all((s >= 0.5) == bool(y) for s, (_, _, y) in zip(scores, rows))


def test_classifiers_with_clashing_columns(spark):
    ready(spark)
    rows = [(k, f"word{k % 3} text {'vile' if k % 5 == 0 else 'kind'}", "en", "s", 1, 2, 3, 4, 5, 6, 0.5) for k in range(80)]
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, 1, 1, 1, 1, 1, 1.0)], CLASH)
    labels = spark.createDataFrame([(k, int(k % 5 != 0), int(k % 5 == 0), 9) for k in range(60)], "doc_id long, quality int, toxic int, y int")
    assert quality.score(docs, labels).count() == toxicity.severity(docs, labels).count() == 81
    assert toxicity.remove_toxic(docs, labels).columns == docs.columns
