"""Document fingerprints: one-permutation MinHash with optimal densification and low-order bits.

Native: every step is a DataFrame expression or a Spark aggregate, join or window.

* A document's shingles are its runs of ``SHINGLE`` words (fewer words: the whole run; none:
  a constant).  Each is hashed once (XXH64); its top bits choose one of ``BINS`` bins, the
  rest is its value, and a bin keeps its least value.  Sorting the hashes together with one
  sentinel for each bin gives the bins in order; a sentinel that stands first marks an
  empty bin.
* An empty bin i takes the value of the first filled bin in a pseudo-random order of all
  bins that belongs to i (uniform over the filled bins, independent for each i, the same
  in every document: optimal densification).  The first probes of those orders are a table;
  bins that are still empty after them look for the least rank of all filled bins.
* The ``LOW_BITS`` low bits of each bin are packed, 16 bins to a long.  Two different values
  agree in these bits with probability 2^-LOW_BITS, so the share p of equal bins estimates
  the Jaccard likeness as (p - 2^-b) / (1 - 2^-b), cut to 0..1.

The following document.  Texts are dealt by blocks of the order (doc_id, hash of text), cut
at keys of the table itself (chosen by least hash among distinct keys; their number is
bounded by the number of blocks).  The first rows of a block also go to the end of the
block before it (the first block's to the last), so each text is moved once and a window
inside the block finds the following row.  A key with very many rows (the same id and text)
goes through as one row with its count: all but the last copy are followed by a copy.

Defined results: a null text reads as empty; words are runs of anything but ASCII white
space, unchanged, so texts without words are alike; null ids come first; rows of one id
follow each other by the hash of their text; repeated rows follow each other and each gets
a row; a table of one document is followed by itself; an empty table gives an empty table;
other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm._common import PARTITION_BYTES, materialise, plain, shuffle_parts

SHINGLE = 5
#: Bins of a fingerprint (a power of two), and bits kept of each.
BINS, LOW_BITS = 256, 4
#: Probes of the table of orders, and filled bins below which it is not used.
PROBES, FEW_FILLED = 32, 24
#: Keys looked at for each block's end, and in all.
KEYS_A_BLOCK, MOST_KEYS = 16, 1_000_000
#: Rows from which on a key may go through as one row.
HEAVY = 1024

_BIN_BITS = BINS.bit_length() - 1
_VALUE_BITS = 63 - _BIN_BITS
_TOP = (1 << _VALUE_BITS) - 1
_PER_LONG = 64 // LOW_BITS


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, as longs that are not negative."""
    def run(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[F.get(words, i + j) for j in range(k)]), 1)

    few = F.array(F.shiftrightunsigned(F.xxhash64(F.array_join(words, "\n"), F.size(words)), 1))
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), run)).otherwise(few)


def _rank(i: Column, j: Column) -> Column:
    """Place of bin j in the order of bin i, as a pseudo-random number."""
    return F.xxhash64(i, j)


def _probe_table(spark) -> str:
    """SQL for the first probes of every bin's order, bin by bin: worked out by the same rule as ``_rank``."""
    pairs = spark.range(BINS).select(F.col("id").cast("int").alias("i")).select(
        F.slice(F.transform(F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.struct(
            _rank(F.col("i"), j).alias("r"), j.alias("j")))), lambda s: s["j"]), 1, PROBES).alias("p"), "i")
    rows = pairs.orderBy("i").collect()          # BINS rows of constants
    return "cast(split('" + ",".join(str(j) for r in rows for j in r.p) + "', ',') as array<int>)"


def _bins(hashes: Column) -> Column:
    """Least value of each bin in bin order, under the bin's bits; a sentinel (all low bits set) for an empty one."""
    sentinels = F.expr("cast(split('" + ",".join(str(i << _VALUE_BITS | _TOP) for i in range(BINS)) + "', ',') as array<bigint>)")
    return _let(F.sort_array(F.concat(hashes, sentinels)), lambda a: F.filter(a, lambda v, i: (i == 0) | (
        F.shiftright(v, _VALUE_BITS) != F.shiftright(F.get(a, i - 1), _VALUE_BITS))))


def _empty(v: Column) -> Column:
    return v.bitwiseAND(F.lit(_TOP)) == F.lit(_TOP)


def _densified(bins: Column, probes: Column) -> Column:
    """Empty bins filled from the first filled bin of their order."""
    def rounds(filled: Column) -> Column:
        # As many probes as leave a few bins at most; none where few bins are filled.
        some = F.ceil(F.lit(-4.0) / F.log(F.lit(1.0) - filled / F.lit(float(BINS)))).cast("int")
        return F.when((filled < FEW_FILLED) | (filled == BINS), 0).otherwise(F.least(F.lit(PROBES), some))

    def probe(b: Column) -> Column:
        count = _let(F.size(F.filter(b, lambda v: ~_empty(v))), rounds)
        steps = F.slice(F.sequence(F.lit(0), F.lit(PROBES - 1)), F.lit(1), count)
        return F.aggregate(steps, b, lambda now, t: F.transform(now, lambda v, i: F.when(
            _empty(v), F.get(b, F.get(probes, i * PROBES + t))).otherwise(v)))

    def rest(b: Column, now: Column) -> Column:
        def search(filled: Column) -> Column:
            return F.transform(now, lambda v, i: F.when(~_empty(v), v).otherwise(F.array_min(F.transform(
                filled, lambda w: F.struct(_rank(i, F.shiftright(w, _VALUE_BITS).cast("int")).alias("r"), w.alias("w"))))["w"]))
        return F.when(F.exists(now, _empty), _let(F.filter(b, lambda v: ~_empty(v)), search)).otherwise(now)

    return _let(bins, lambda b: _let(probe(b), lambda now: rest(b, now)))


def _packed(bins: Column) -> Column:
    """The low bits of all bins, packed into longs."""
    low = F.lit((1 << LOW_BITS) - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), lambda k: F.aggregate(
        F.slice(bins, k * _PER_LONG + 1, F.lit(_PER_LONG)), F.lit(0).cast("long"),
        lambda acc, v: F.shiftleft(acc, LOW_BITS).bitwiseOR(v.bitwiseAND(low))))


def fingerprint(text: Column, probes: Column, shingle: int = SHINGLE) -> Column:
    """The packed fingerprint of a text that is not null, as an array of longs.

    ``probes`` is the table of ``probe_table``.
    """
    return _let(_words(text), lambda w: _let(_shingles(w, shingle), lambda h: _let(_densified(_bins(h), probes), _packed)))


def probe_table(spark) -> Column:
    """The constant table that ``fingerprint`` needs."""
    return F.expr(_probe_table(spark))


def hex_text(packed: Column) -> Column:
    """A packed fingerprint as lower-case hex digits."""
    return F.array_join(F.transform(packed, lambda v: F.lower(F.lpad(F.hex(v), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness estimated from two packed fingerprints, corrected for chance agreement of the low bits."""
    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for s in (1, 2):
            d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    assert LOW_BITS == 4
    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda acc, n: acc + n)
    chance = 2.0 ** -LOW_BITS
    p = (F.lit(BINS) - apart) / F.lit(float(BINS))
    return F.greatest(F.lit(0.0), (p - F.lit(chance)) / F.lit(1.0 - chance))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, fingerprint) of each document."""
    probes = probe_table(docs.sparkSession)
    rows = plain(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("fingerprint", fingerprint(F.col("text"), probes))


# -- following documents ----------------------------------------------------

def _place(key: Column, ends: list[tuple], kind: str) -> Column:
    """How many of the sorted ``ends`` are at or below a key: found among every so-manyth end, then among those between."""
    if not ends:
        return F.lit(0)
    step = max(1, int(len(ends) ** 0.5))

    def array(values: list[tuple]) -> Column:
        return F.from_json(F.lit(json.dumps([{"k": k, "t": t} for k, t in values])), f"array<{kind}>")

    def below(a: Column) -> Column:
        return F.size(F.filter(a, lambda e: e <= key))

    return _let(below(array(ends[::step])), lambda c: F.when(c == 0, 0).otherwise(
        (c - 1) * step + below(F.slice(array(ends), (c - 1) * step + 1, F.lit(step)))))


def with_next(rows: DataFrame, order: str, text: str, columns: dict[str, str]) -> DataFrame:
    """Adds the following row's columns (``columns``: name -> new name) in the order (``order``, hash of ``text``).

    The last row is followed by the first.  One shuffle of the rows, by block; no task gets
    more than a block, however many rows share an id.
    """
    spark, own = rows.sparkSession, rows.columns
    rows = rows.withColumn("_tie", F.xxhash64(text))
    kind = f"struct<k:{rows.schema[order].dataType.simpleString()},t:bigint>"
    key = F.struct(F.col(order).alias("k"), F.col("_tie").alias("t"))
    keys = materialise(rows.groupBy(order, "_tie").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text).cast("long")).alias("bytes")), "order_keys")
    whole = keys.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min(key).alias("least")).head()
    if not whole.n:
        return rows.select(*own, *[F.col(c).alias(a) for c, a in columns.items()])
    parts = max(shuffle_parts(spark), -(-int(whole.bytes) // PARTITION_BYTES))
    # Where blocks end: keys of least hash, every so-manyth in order.  They balance the work and decide nothing else.
    some = keys.orderBy(F.xxhash64("_tie", order), order).limit(min(parts * KEYS_A_BLOCK, MOST_KEYS)).select(order, "_tie")
    found = sorted(((r[0], r[1]) for r in some.collect()), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    cuts = {len(found) * k // parts for k in range(1, parts)}
    ends = [found[c] for c in sorted(cuts) if found[c] != tuple(whole.least)]
    last = len(ends)
    # A key with more rows than some blocks together goes through as one row.  At most parts / 4 keys.
    heavy = keys.where(F.col("n") > F.lit(max(HEAVY, 4 * whole.n // parts))).select(
        F.col(order).alias("_k"), F.col("_tie").alias("_t"), "n")
    single = rows.withColumn("_n", F.lit(1).cast("long"))
    if not heavy.isEmpty():
        same = F.col(order).eqNullSafe(F.col("_k")) & (F.col("_tie") == F.col("_t"))
        many = rows.join(F.broadcast(heavy), same).groupBy(order, "_tie").agg(
            *[F.first(c).alias(c) for c in own if c != order], F.first("n").alias("_n"))
        single = single.join(F.broadcast(heavy), same, "left_anti").unionByName(many)
    placed = single.withColumn("_block", _place(key, ends, kind))
    starts = [tuple(whole.least), *ends]
    begins = F.get(F.from_json(F.lit(json.dumps([{"k": k, "t": t} for k, t in starts])), f"array<{kind}>"), F.col("_block"))
    leads = begins["k"].eqNullSafe(F.col(order)) & (begins["t"] == F.col("_tie"))
    before = F.when(F.col("_block") == 0, F.lit(last)).otherwise(F.col("_block") - 1)
    here = F.struct(F.col("_block").alias("b"), F.lit(False).alias("halo"))
    dealt = placed.withColumn("_to", F.explode(F.when(leads, F.array(here, F.struct(
        before.alias("b"), F.lit(True).alias("halo")))).otherwise(F.array(here))))
    dealt = dealt.select(*own, "_tie", "_n", F.col("_to.b").alias("_b"), F.col("_to.halo").alias("_halo"))
    w = Window.partitionBy("_b").orderBy("_halo", order, "_tie")
    after = dealt.repartitionById(parts, "_b").withColumns(
        {a: F.lead(c).over(w) for c, a in columns.items()}).where(~F.col("_halo"))
    # All but the last of a key's rows are followed by one like themselves.
    each = after.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return each.select(*own, *[F.when(F.col("_copy") < F.col("_n"), F.col(c)).otherwise(F.col(a)).alias(a)
                               for c, a in columns.items()])


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document against a copy whose last half is replaced by the start of the next document.

    doc_id, n_chars, edited (the text), fingerprint, edited_fingerprint (packed),
    near_edited, near_next.
    """
    probes = probe_table(docs.sparkSession)
    pairs = with_next(fingerprints(docs), "doc_id", "text", {"text": "next_text", "fingerprint": "next_fingerprint"})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    both = edited.withColumn("edited_fingerprint", fingerprint(F.col("edited"), probes))
    return both.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
