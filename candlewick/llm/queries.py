"""The registered forms of the operators: opN_<name> over the whole tables, and the pipeline.

Each query calls its operator and selects the contract's columns.  ``ORACLE`` holds the
DuckDB SQL of those that SQL can express; the others are tested against brute force in
tests/llm.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import candlewick
from candlewick.llm import (bpe_count, conversation_repair, decontamination, embedding_dedup, embedding_whitening,
                            fingerprints, language_id, packing, quality, simhash_dedup, substring_dedup, token_output,
                            toxicity)
from candlewick.session import configure

_ROOT = Path(candlewick.__file__).resolve().parent


def ready(spark: SparkSession) -> SparkSession:
    """Session settings, and the package for the executors' Python where their path lacks it."""
    configure(spark)
    sc = spark.sparkContext
    if str(_ROOT.parent) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and not getattr(sc, "_candlewick", False):
        path = Path(tempfile.mkdtemp(prefix="candlewick-code-")) / "candlewick.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(_ROOT.rglob("*.py")):
                z.write(f, f.relative_to(_ROOT.parent))
        sc.addPyFile(str(path))
        sc._candlewick = True
    return spark


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_output(spark, sf_dir):
    return token_output.token_output(_read(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return decontamination.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_embedding_dedup(spark, sf_dir):
    return embedding_dedup.vector_classes(_read(spark, sf_dir, "embeddings"))


def op4_token_counts(spark, sf_dir):
    return bpe_count.token_counts(_read(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    return language_id.identify(_read(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return packing.pack(_read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), digest=True).withColumnRenamed(
        "kept", "kept_sha256")


def op8_simhash_dedup(spark, sf_dir):
    return simhash_dedup.simhash_classes(_read(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return toxicity.severity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_quality(spark, sf_dir):
    return quality.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark, sf_dir):
    return embedding_whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.damaged_audits(_read(spark, sf_dir, "conversations"))


def op13_fingerprints(spark, sf_dir):
    pairs = fingerprints.edited_pairs(_read(spark, sf_dir, "documents"))
    return pairs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        fingerprints.hex_text(F.col("fingerprint")).alias("fingerprint"),
                        fingerprints.hex_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                        "near_edited", "near_next")


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(ready(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_output, op2_decontamination, op3_embedding_dedup, op4_token_counts, op5_language_id, op6_packing,
    op7_substring_dedup, op8_simhash_dedup, op9_toxicity, op10_quality, op11_embedding_whitening,
    op12_conversation_repair, op13_fingerprints, pipeline)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
       FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
       FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM m, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL
       AND (SELECT count(x) = len(v.e) AND bool_and(isfinite(x)) AND bool_or(x <> 0) FROM unnest(v.e) AS t(x))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id)::BIGINT AS n_links,
       least(v.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = v.vec_id), v.vec_id))::BIGINT AS component_id,
       v.vec_id = least(v.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = v.vec_id), v.vec_id)) AS kept
FROM v
"""

_OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM d, unnest(range(1, len(w) - 18)) AS r(i)),
later AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(range(i, i + 20)) AS r(p)),
kept AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS t
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) w
         ANTI JOIN gone USING (doc_id, p) GROUP BY w.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

ORACLE: dict[str, str] = {"op2_decontamination": _OP2, "op3_embedding_dedup": _OP3, "op7_substring_dedup": _OP7}
