"""Quality rules: hashed n-gram log-likelihood ratio against trusted text.

Words and word pairs fall into hash buckets. Two multinomials over the buckets
are counted: one over the trusted documents, one over the whole raw corpus. A
document's score is the mean, over its n-grams, of log p_trusted - log p_raw,
and every document is kept or not by a fixed threshold on it.

All of it is DataFrame expressions. The corpus counts are partial sums per
task over a number of buckets that is a parameter, so the model (one long per
bucket) has a size that no input changes; scoring reads it as a scalar
subquery and is map-only. Log ratios are rounded to whole millionths, so a sum
of them does not depend on its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import SPACES, read
from cardsentry.sources.storage import materialize

BUCKETS = 16384
# Mean log ratio, in millionths, from which a document is kept.
THRESHOLD = -60_000
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+", -1), "")


def words_from(words: Column, place: int) -> Column:
    """The words from a place (counted from 1) on."""
    return F.slice(words, F.lit(place), F.greatest(F.size(words) - (place - 1), F.lit(0)))


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.crc32(gram.cast("binary")) % F.lit(buckets)


def pair_of(first: Column, second: Column) -> Column:
    return F.concat(first, F.lit(" "), second)


def buckets_of(words: Column, buckets: int) -> Column:
    """Hash buckets of every word and of every pair of neighbours."""
    single = F.transform(words, lambda w: bucket_of(w, buckets))
    pairs = F.transform(words_from(words, 2), lambda w, i: bucket_of(pair_of(F.get(words, i), w), buckets))
    return F.concat(single, pairs)


def fit_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, column ``ratio``: the log ratio of every bucket in millionths.

    ``docs`` (doc_id, text) is the raw corpus, ``trusted`` (doc_id) names its
    trusted documents; an id that several rows carry counts once. Counts
    start at one. With no trusted document both distributions are compared
    with a uniform one; an empty corpus gives ratios of 0.
    """
    flags = trusted.where("doc_id is not null").select("doc_id").distinct().withColumn("is_trusted", F.lit(1))
    grams = (
        docs.select("doc_id", "text")
        .join(flags.hint("merge"), "doc_id", "left")  # the labels grow with the corpus
        .select(F.col("is_trusted"), words_of(F.col("text")).alias("words"))
        # a row a word, hashed by compiled code; the last one has no neighbour
        .select("is_trusted", F.inline(F.arrays_zip(F.col("words").alias("a"), words_from(F.col("words"), 2).alias("b"))))
        .select("is_trusted", F.explode(F.array(
            bucket_of(F.col("a"), buckets), bucket_of(pair_of(F.col("a"), F.col("b")), buckets))).alias("bucket"))
        .where("bucket is not null")
    )
    counts = materialize(
        grams.groupBy("bucket").agg(F.count("is_trusted").alias("t"), F.count("*").alias("r")), "ngram-counts"
    )
    total = counts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("r"), F.lit(0)).alias("r")).first()
    t = (F.coalesce(F.col("t"), F.lit(0)) + 1).cast("double") / F.lit(float(total["t"] + buckets))
    r = (F.coalesce(F.col("r"), F.lit(0)) + 1).cast("double") / F.lit(float(total["r"] + buckets))
    ratio = F.round(F.log(t / r) * F.lit(1e6)).cast("bigint")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(F.broadcast(counts), "bucket", "left")
    # the number of buckets bounds this one row
    row = every.agg(F.sort_array(F.collect_list(F.struct("bucket", ratio.alias("ratio")))).alias("pairs"))
    return materialize(row.select(F.col("pairs.ratio").alias("ratio")), "ngram-ratios")


def base_features(docs: DataFrame) -> DataFrame:
    """The counts of the rules, and ``words`` for later steps."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: F.length(F.ltrim(line, F.lit(SPACES))) > 0
    lines = F.filter(F.split(text, "\n", -1), has_word)
    out = docs.select("doc_id", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
    hashed = F.transform(
        words_from(F.col("words"), 3), lambda w, i: F.xxhash64(F.get("words", i), F.get("words", i + 1), w)
    )
    out = out.withColumn("windows", hashed)
    # place of every window in the order of hashes, where a text repeats one
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.when(
        repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    out = out.withColumn("ordered", ordered)
    at = lambda j: F.get("ordered", j)["h"]  # null beside either end
    twice = F.filter("ordered", lambda x, j: (at(j - 1) == x["h"]) | (at(j + 1) == x["h"]))
    out = out.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # each window covers three words, less what the next one covers again
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("p")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["p"])).alias("n"), p.alias("p")),
        lambda s: s["n"],
    )
    size = lambda c: F.size(c).cast("bigint")
    return out.select(
        "doc_id",
        "words",
        size(F.col("words")).alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        (size(F.col("lines")) - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def quality_verdicts(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: int = THRESHOLD
) -> DataFrame:
    """Score and judge every document.

    ``docs`` needs doc_id and text, other columns are ignored; ``trusted`` is
    a table of doc_id. A null text counts as empty: it has no words, fails the
    base rule and scores 0. Repeated rows get a row each, an empty table gives
    an empty table, and a mean exactly at the threshold is kept.
    """
    docs = docs.select("doc_id", "text")
    model = fit_ratios(docs, trusted, buckets)
    rows = base_features(docs)
    rows = rows.withColumn("grams", buckets_of(F.col("words"), buckets))
    # every row gets a copy of the model while it is scored; millionths of a logarithm fit an int
    rows = rows.withColumn("ratio", model.select(F.col("ratio").cast("array<int>")).scalar())
    total = F.aggregate("grams", F.lit(0).cast("bigint"), lambda s, b: s + F.get("ratio", b.cast("int")))
    rows = rows.withColumn("sum", total)
    n_grams = F.size("grams")
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("sum") >= F.lit(threshold).cast("bigint") * n_grams)).alias("kept"),
        F.when(n_grams > 0, (F.col("sum") / n_grams).cast("double")).otherwise(F.lit(0.0)).alias("mean_ratio"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over all documents; documents labelled as good are the trusted ones."""
    trusted = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_verdicts(read(spark, sf_dir, "documents"), trusted).drop("mean_ratio")


OP9_SQL = r"""
WITH tab AS (  -- the table of the public CRC-32 polynomial
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram FROM d
), grams AS (
  SELECT gram, count(*) AS n FROM g GROUP BY gram
), hashed AS (
  SELECT gram, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(range(1, strlen(gram) + 1), lambda i: ('0x' || substr(hex(gram), CAST(2 * i - 1 AS INT), 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) + 1 AS INT)])), 4294967295) % 16384 AS bucket
  FROM grams, tab
), good AS (
  SELECT DISTINCT doc_id FROM labels WHERE quality = 1
), counts AS (
  SELECT bucket, sum(CASE WHEN good.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS t, count(*) AS r
  FROM g JOIN hashed USING (gram) LEFT JOIN good USING (doc_id) GROUP BY bucket
), ratios AS (
  SELECT bucket, CAST(round(ln(((t + 1)::DOUBLE / ((SELECT sum(t) FROM counts) + 16384)::DOUBLE)
                             / ((r + 1)::DOUBLE / ((SELECT sum(r) FROM counts) + 16384)::DOUBLE)) * 1e6) AS BIGINT) AS ratio
  FROM counts
), scores AS (
  SELECT doc_id, sum(ratio) AS s, count(*) AS n FROM g JOIN hashed USING (gram) JOIN ratios USING (bucket) GROUP BY doc_id
), tri AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3
), tri2 AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM tri
), rep AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tri2 WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d
), f AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(s, 0) AS s, coalesce(n, 0) AS n
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN scores USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND s >= -60000 * n AS kept
FROM f
"""
