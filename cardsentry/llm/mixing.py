"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: its target share of the output over
its share of the input. A document's number of copies inverts the Poisson
distribution of that rate at a number hashed from seed and document, so it is
the same on every run and needs no random state. Copies are exploded and the
whole output is put into the order of a second hash (one range shuffle).

Only the size per source is gathered, with partial sums before the shuffle;
a hot source is one row per task there. The rates are joined by broadcast
while their number is small, else by a shuffle join, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import key_hash, packed, read, unit_hash, unpacked
from cardsentry.sources.storage import materialize

# A rate above this is a sum of independent Poisson numbers of smaller rates,
# so that exp(-rate) stays far from underflow and the tables stay short.
RATE_PART = 64.0
# Rates are broadcast up to this many sources (each holds under 200 doubles).
BROADCAST_SOURCES = 10_000


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, epochs: float) -> DataFrame:
    """One row per source: its mean repetition rate and the table to invert.

    A document's size is its characters plus one, so that empty texts count.
    ``weights`` None gives every source the same weight; a source that the
    given weights do not name has weight 0.
    """
    sizes = materialize(
        docs.groupBy(F.col("source").alias("source")).agg(
            F.sum(F.coalesce(F.length("text"), F.lit(0)) + F.lit(1)).alias("size")
        ),
        "source-sizes",
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    weighed = sizes.withColumn("weight", weight)
    total = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    size, weight_sum = float(total["size"] or 0), float(total["weight"] or 0.0)
    if size and weight_sum <= 0:
        raise ValueError("no source that occurs has a positive weight")
    rate = F.col("weight") / F.lit(weight_sum or 1.0) * F.lit(epochs * size) / F.col("size").cast("double")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(RATE_PART))).cast("int")
    # the terms p(k) = p(k-1) * rate / k, summed up; 12 standard deviations
    # and 32 more leave less than the resolution of the hash
    table = """
        aggregate(sequence(1, cast(ceil(part_rate + 12 * sqrt(part_rate)) as int) + 32),
          named_struct('p', exp(-part_rate), 'cdf', array(exp(-part_rate))),
          (s, k) -> named_struct('p', s.p * part_rate / k,
                                 'cdf', concat(s.cdf, array(element_at(s.cdf, -1) + s.p * part_rate / k))),
          s -> s.cdf)"""
    return (
        weighed.withColumn("rate", rate)
        .withColumn("parts", parts)
        .withColumn("part_rate", F.col("rate") / F.col("parts"))
        .select("source", "rate", "parts", F.expr(table).alias("cdf"))
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    epochs: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """Repeat every document a Poisson number of times and shuffle globally.

    Returns the input columns and ``copy_no`` (1, 2, ...) and ``shuffle_key``;
    rows are in the order of shuffle_key, doc_id, copy_no. The mean output
    size of a source is its weight's share of ``epochs`` times the input size.
    Documents that draw 0 are left out, which is what the mixing does; no
    rate is capped. A null source is a source of its own, a null doc_id hashes
    as one value, repeated rows draw the same number, and an empty table gives
    an empty table. Input columns named like the two new ones are replaced.
    """
    rates = source_rates(docs, weights, epochs)
    n_sources = rates.count()
    if n_sources <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    rates = rates.withColumnRenamed("source", "rate_source")
    rows = docs.select(packed(docs), F.col("doc_id").alias("id"), F.col("source").alias("of"))
    joined = rows.join(rates, F.col("of").eqNullSafe(F.col("rate_source")))
    draw = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda n, i: n + F.size(F.filter("cdf", lambda c: c < unit_hash(seed, F.col("id"), i))),
    )
    copies = joined.withColumn("n", draw).where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    keyed = copies.withColumn("key", key_hash(seed + "-order", F.col("id"), F.col("copy")))
    return keyed.select(
        *unpacked(docs.columns, {"copy_no": F.col("copy"), "shuffle_key": F.col("key")})
    ).orderBy("shuffle_key", "doc_id", "copy_no")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to equal weights of their sources, one epoch."""
    return mix_sources(read(spark, sf_dir, "documents"))


OP2_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1) AS size FROM documents GROUP BY source
), totals AS (
  SELECT CAST(sum(size) AS DOUBLE) AS size, CAST(count(*) AS DOUBLE) AS n FROM sizes
), rates AS (
  SELECT source, 1.0::DOUBLE / t.n * (1.0::DOUBLE * t.size) / CAST(s.size AS DOUBLE) AS rate FROM sizes s, totals t
), part AS (
  SELECT source, CAST(greatest(1, ceil(rate / 64.0)) AS INT) AS parts,
         rate / CAST(greatest(1, ceil(rate / 64.0)) AS INT) AS r FROM rates
), cdf AS (
  SELECT source, r, 0 AS k, exp(-r) AS p, exp(-r) AS c FROM part
  UNION ALL
  SELECT source, r, k + 1, p * r / (k + 1), c + p * r / (k + 1) FROM cdf WHERE k < ceil(r + 12 * sqrt(r)) + 32
), tables AS (
  SELECT source, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source
), drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf, lambda c: c <
    (CAST(('0x' || substr(md5(concat_ws(':', 'mix', coalesce(CAST(d.doc_id AS VARCHAR), '~'), CAST(i AS VARCHAR))), 1, 13))::BIGINT AS DOUBLE) + 0.5) / 4503599627370496.0)))) AS n
  FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
  JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT * EXCLUDE (n), ('0x' || substr(md5(concat_ws(':', 'mix-order', coalesce(CAST(doc_id AS VARCHAR), '~'), CAST(copy_no AS VARCHAR))), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT *, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INT) AS copy_no FROM drawn WHERE n > 0)
"""
