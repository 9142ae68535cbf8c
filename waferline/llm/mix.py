"""Mixing sources to target weights by a low-discrepancy schedule (operator 1), with
DataFrame expressions only.

1. ``source_targets``: sources by code point (null last) weigh 5, 2, 1, repeating. They share
   ``share`` times all words by weight, but none takes more than ``cap`` times its own words;
   the excess is shared again by weight (solved in closed form: with sources ordered by
   cap / weight, one level holds for all that stay below their cap).
2. Each source's documents are shuffled by a hash and laid end to end; the line of words is
   cut into blocks of ``block_words``. Past its end it starts again (a second epoch).
3. Schedule: slot i has the van der Corput point of i (its bits reversed), and the source in
   whose share of the cumulated weights that point falls. Slots are ranked per source: the
   source's r-th slot takes its r-th block. Slots past a source's need are left out; the few
   that the sequence leaves a source short of come last, so every source takes its target to
   the word.
4. Blocks join the parts of documents that lie in them: ``pieces``.

All running sums go in two levels (sums per bucket, then within the bucket), so a source
with a third of all rows is spread over its buckets. Texts are read once, for their sizes.

Defined cases: null or word-less texts have size 0 and are taken 0 words; a null source is a
source; repeated rows are documents of their own; null doc_ids are allowed; extra columns are
ignored; an empty table gives an empty result; where no text has a word, targets are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import fresh, n_words, stored

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
BLOCK_WORDS = 2048
#: Buckets of the shuffle's hash per source, of the points' line, and slots in a rank bucket.
HASH_BUCKETS, POINT_BUCKETS, SLOTS_PER_BUCKET = 1024, 1024, 4096
_BITS = 48


def hash48(*cols: Column) -> Column:
    """48 bits of the md5 of the columns (null: 'null'), alike in every engine."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, src (number by code point, null last), source_size, target (double), take
    (long) of rows source, size. One row per source passes the ordered windows."""
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    t = (sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
         .withColumn("src", F.row_number().over(by_name) - 1)
         .withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("src") % len(weights)).cast("double"))
         .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
         .withColumn("ratio", F.col("limit") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward))
         .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
         .withColumn("target", F.least("limit", F.coalesce(F.col("weight") * F.col("level"), F.col("limit")))))
    return t.select("source", "src", "source_size", "target",
                    F.least(F.round("target").cast("long"), F.col("source_size") * cap).alias("take"))


def van_der_corput(i: Column) -> Column:
    """The bits of ``i`` (below 2**48) reversed behind the point, in [0, 1)."""
    return F.conv(F.reverse(F.lpad(F.bin(i), _BITS, "0")), 2, 10).cast("long") / F.lit(float(1 << _BITS))


def schedule(sources: DataFrame, n_slots: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, src, block, first_word, end_word (of the source's repeated line of words)."""
    every = Window.partitionBy()
    earlier = every.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    shares = (sources.filter("take > 0")
              .withColumn("need", F.ceil(F.col("take") / block_words))
              .withColumn("before", F.coalesce(F.sum("take").over(earlier), F.lit(0)))
              .withColumn("all", F.sum("take").over(every))
              .select("src", "take", "need", (F.col("before") / F.col("all")).alias("lo"),
                      ((F.col("before") + F.col("take")) / F.col("all")).alias("hi")))
    bucket = lambda x: F.floor(x * POINT_BUCKETS).cast("int")
    cut = shares.select("src", "lo", "hi", F.explode(F.sequence(
        bucket(F.col("lo")), F.least(bucket(F.col("hi")), F.lit(POINT_BUCKETS - 1)))).alias("bucket"))
    points = (sources.sparkSession.range(n_slots).select(F.col("id").alias("slot"), van_der_corput(F.col("id")).alias("u"))
              .withColumn("bucket", bucket(F.col("u"))))
    slots = points.join(cut, "bucket").filter("lo <= u and u < hi").select(
        "slot", "src", F.floor(F.col("slot") / SLOTS_PER_BUCKET).alias("part"))
    counts = slots.groupBy("src", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select("src", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    ranked = slots.join(parts, ["src", "part"]).select("slot", "src", (F.col("ahead") + F.row_number().over(
        Window.partitionBy("src", "part").orderBy("slot")) - 1).alias("block"))
    got = shares.join(counts.groupBy("src").agg(F.sum("n").alias("got")), "src", "left")
    short = got.select("src", "need", F.coalesce("got", F.lit(0)).alias("got")).filter("got < need").select(
        "src", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("block"))
    short = short.select((F.row_number().over(every.orderBy("block", "src")) - 1 + n_slots).alias("slot"), "src", "block")
    return (ranked.unionByName(short).join(shares.select("src", "take", "need"), "src")
            .filter(F.col("block") < F.col("need"))
            .select("slot", "src", "block", (F.col("block") * block_words).alias("first_word"),
                    F.least((F.col("block") + 1) * block_words, F.col("take")).alias("end_word")))


@dataclass(frozen=True)
class Mix:
    """``documents``: a row per document with its place in its source's line (src, line_at,
    key columns bucket and nth); ``slots``: the schedule; ``pieces``: slot, src, bucket, nth,
    from_word, n_words (of the document), null slot where a document is never taken."""

    sources: DataFrame
    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
        block_words: int = BLOCK_WORDS, seed: str = "mix", fingerprint: Column | None = None) -> Mix:
    """Schedule a mix of ``docs`` (doc_id, text, source). ``fingerprint`` tells rows of one
    doc_id apart, where the caller must find them again."""
    thin = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"), hash48(F.lit(seed), F.col("doc_id")).alias("h"),
        (F.lit(0) if fingerprint is None else fingerprint).cast("long").alias("fingerprint")), "mix-sizes")
    sources = stored(source_targets(thin, weights, share, cap).coalesce(1), "mix-sources")
    need = sources.agg(F.sum(F.ceil(F.col("take") / block_words))).first()[0] or 0
    slots = schedule(sources, int(need), block_words)

    rows = (thin.join(sources.select(F.col("source").alias("s"), "src", "source_size", "take"),
                      F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
            .withColumn("bucket", F.shiftright("h", _BITS - HASH_BUCKETS.bit_length() + 1).cast("int")))
    ahead = (rows.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
             .select("src", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(
                 Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")))
    inside = Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size", "fingerprint")
    documents = (rows.join(ahead, ["src", "bucket"])
                 .withColumn("nth", F.row_number().over(inside))
                 .withColumn("line_at", F.col("ahead") + F.coalesce(F.sum("size").over(
                     inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .drop("ahead", "h"))
    # The blocks that a document's words lie in, in each epoch that the target reaches.
    epochs = F.filter(F.sequence(F.lit(0), F.lit(cap - 1)),
                      lambda e: (F.col("size") > 0) & (F.col("line_at") + e * F.col("source_size") < F.col("take")))
    at = F.col("line_at") + F.col("epoch") * F.col("source_size")
    block = lambda x: F.floor(x / block_words).cast("long")
    parts = (documents.withColumn("epoch", F.explode_outer(epochs)).withColumn("at", at)
             .withColumn("block", F.explode_outer(F.sequence(block(F.col("at")), block(F.col("at") + F.col("size") - 1)))))
    # What the mix never takes has no block, and would share one key per source: no join for it.
    joined = parts.filter("block is not null").join(slots, ["src", "block"], "left").unionByName(
        parts.filter("block is null").select("*", *[F.lit(None).cast(slots.schema[c].dataType).alias(c) for c in slots.columns if c not in ("src", "block")]))
    lo, hi = F.greatest("at", "first_word"), F.least(F.col("at") + F.col("size"), F.col("end_word"))
    pieces = joined.select("slot", "src", "bucket", "nth", "doc_id", "size", "fingerprint", "epoch",
                           (lo - F.col("at")).alias("from_word"),
                           F.when(F.col("slot").isNotNull(), F.greatest(hi - lo, F.lit(0))).otherwise(0).cast("long").alias("n_words"))
    return Mix(sources, documents, slots, pieces)


def taken(m: Mix) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, first_slot, and
    fingerprint."""
    per = m.pieces.groupBy("src", "bucket", "nth", "doc_id", "size", "fingerprint").agg(
        F.sum("n_words").alias("taken"), F.min(F.when(F.col("n_words") > 0, F.col("slot"))).alias("first_slot"))
    return per.join(m.sources.select("src", "source_size", "target"), "src").select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot", "fingerprint")


def digest(m: Mix) -> DataFrame:
    return taken(m).drop("fingerprint", "first_slot")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, whole, as often as it reaches into them; all
    columns kept. Rows alike in all columns are taken together."""
    # The hash skips nulls, so which columns are null goes into it, too.
    cols = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64(*cols, *[c.isNull() for c in cols])
    at, of, mine, copies, copy = fresh(docs, "mix_id", "mix_mark", "mix_row", "mix_times", "mix_copy")
    times = (taken(mix(docs, fingerprint=mark, **options)).filter("taken > 0")
             .groupBy(F.col("doc_id").alias(at), F.col("fingerprint").alias(of))
             .agg(F.sum(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias(copies)))
    one = docs.withColumn(mine, mark).dropDuplicates(["doc_id", mine])
    return (one.join(times, F.col("doc_id").cast("long").eqNullSafe(F.col(at)) & (F.col(mine) == F.col(of)))
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*cols))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
            ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS h FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS source_size,
            [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS w,
            row_number() OVER (ORDER BY encode(source) NULLS LAST) AS src FROM d GROUP BY source),
     -- rounds: who is above his limit stays at it, the rest share what is left
     f AS (SELECT 0 AS round, src, source_size, w, false AS capped, 1.5 * sum(source_size) OVER () AS rest, sum(w) OVER () AS ws FROM s
           UNION ALL
           SELECT round + 1, src, source_size, w, capped2,
                  1.5 * sum(source_size) OVER () - sum(if(capped2, 2 * source_size, 0)) OVER (),
                  sum(if(capped2, 0, w)) OVER ()
           FROM (SELECT *, capped OR w * rest / ws > 2 * source_size AS capped2 FROM f)
           WHERE round < (SELECT count(*) FROM s)),
     t AS (SELECT src, source_size, if(capped, 2.0 * source_size, least(2.0 * source_size, w * rest / ws))::DOUBLE AS target FROM f
           WHERE round = (SELECT max(round) FROM f)),
     l AS (SELECT r, doc_id, size, source_size, target, least(floor(target + 0.5)::BIGINT, 2 * source_size) AS take,
                  coalesce(sum(size) OVER (PARTITION BY src ORDER BY h, doc_id, size, r
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
           FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN t USING (src, source_size))
SELECT doc_id, size, source_size, target,
       (greatest(0, least(a + size, take) - a) + greatest(0, least(a + size, take - source_size) - a))::BIGINT AS taken
FROM l
"""
