"""MinHash near-dedup with one-permutation hashing and star-shaped candidates.

1. Each document's set of word shingles is hashed once (64 bits). The top bits
   of a hash choose a bin, the smallest hash of a bin is its value. Empty bins
   borrow from a bin that an optimal densification finds: bin and attempt
   number are hashed until a filled bin is hit, alike for all documents.
2. Documents with equal sets become one class with a number of its own and one
   of their texts, so rows that share an id are told apart.
3. Bins are grouped into bands, of a size that suits the similarity asked for;
   classes that agree in a band share a bucket. A bucket proposes a star: every
   member is paired with the smallest class, so m members give m - 1 pairs.
4. Each proposed pair is confirmed on the full sets. Members of a hot centre
   are dealt over several tasks, the centre's text with them. The links are
   closed into components. In two rounds more, members of buckets that are in
   several components try a few classes of other ones that share a bucket with
   them, so that a large group of near copies is closed before step 5.
5. Members of buckets that are then still in several components are compared
   exactly, by a prefix-filter join: two sets that are near enough share a
   shingle early in both of them, in an order that puts rare shingles first.
   Links found there join whole components.

Sets are compared in Arrow batches of a sorted partition, a centre at a time,
so memory holds one centre's set and one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import WORD, col, packed, read, small_batches, unpacked
from cardsentry.llm.components import connected_components
from cardsentry.llm.textwords import doc_shingles
from cardsentry.sources.storage import materialize

BINS_LOG = 8
# Bins of a band at most, and how many pairs at the threshold may share no band.
BAND_ROWS = 8
MISSED = 3e-4
# Members of a centre that one group of the confirming step takes.
DEALT = 64
# Logarithms of the least and largest number of counters that order shingles by
# how common they are (shared counters cost selectivity, not results), counters
# that are put together at a time, and ratio of set sizes of a class.
LEAST_COUNTERS, MOST_COUNTERS, COUNTERS_TOGETHER = 12, 24, 12
STEP = 1.1
# Rounds of further candidates before the exact comparison, and how many of them
# a class has in a round.
ROUNDS, TRIES = 2, 12


@dataclass(frozen=True)
class Near:
    """Shingle length in words, and the similarity from which two documents
    are linked: 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    @property
    def band_rows(self) -> int:
        """The most bins of a band with which enough pairs at the threshold
        share one."""
        fits = [r for r in range(1, BAND_ROWS + 1) if (1 - (self.percent / 100) ** r) ** ((1 << BINS_LOG) // r) < MISSED]
        return max(fits, default=1)


@lru_cache(maxsize=2)
def _attempts(bins: int, rounds: int) -> np.ndarray:
    """attempt[t, b]: the bin that empty bin b looks at in attempt t."""
    x = np.arange(rounds * bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.int64).reshape(rounds, bins) % bins


def sketch(sets: list[np.ndarray], bins_log: int = BINS_LOG) -> np.ndarray:
    """One row of bin values for each sorted, non-empty set of hashes."""
    bins = 1 << bins_log
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for i, s in enumerate(sets):
        at = (s >> np.uint64(64 - bins_log)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[i, at[first]] = s[first]
        filled[i, at[first]] = True
    row, empty = np.nonzero(~filled)
    rounds, t = 64, 0
    while len(row):
        look = _attempts(bins, rounds)
        if t == rounds:  # all attempts used: look again with new ones
            rounds *= 2
            continue
        source = look[t, empty]
        hit = filled[row, source]
        out[row[hit], empty[hit]] = out[row[hit], source[hit]]
        row, empty = row[~hit], empty[~hit]
        t += 1
    return out


def band_keys(values: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for each band of a row of bin values."""
    n, bins = values.shape
    bands = bins // band_rows
    parts = values[:, : bands * band_rows].reshape(n, bands, band_rows)
    key = np.zeros(parts.shape[:2], np.uint64)
    for i in range(band_rows):
        key = (key ^ parts[:, :, i]) * np.uint64(0x9FB21C651E98DF25)
        key ^= key >> np.uint64(29)
    return key


def signatures(docs: DataFrame, near: Near) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, bands) of every row; digest and
    bands are null for texts without words."""
    words, band_rows = near.words, near.band_rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = doc_shingles(b["text"], words)
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(sketch(some), band_rows).view(np.int64)) if some else iter(())
            yield pd.DataFrame({
                "doc": b["doc"],
                "text_hash": b["text_hash"],
                "n_shingles": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "bands": [next(keys) if len(s) else None for s in sets],
            })

    # the id goes as text: pandas holds no whole numbers beside nulls
    rows = docs.select(col("doc_id").cast("string").alias("doc"), F.xxhash64(col("text")).alias("text_hash"), col("text").alias("text"))
    signed = rows.mapInPandas(run, "doc string, text_hash bigint, n_shingles bigint, digest binary, bands array<bigint>")
    doc_id = F.col("doc").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id")
    return signed.select(doc_id, "text_hash", "n_shingles", "digest", "bands")


def confirm(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, c) that are similar enough on their full sets, as (u, v).

    ``texts`` holds (id, text). The members of a centre are dealt into groups
    of about DEALT; each group gets the centre's text too.
    """
    sizes = pairs.groupBy("c").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("groups", F.ceil(F.col("n") / DEALT).cast("int")).drop("n")
    dealt = pairs.join(sizes, "c").withColumn("g", F.pmod(F.xxhash64("a"), F.col("groups")).cast("int"))
    need = dealt.select(F.col("a").alias("id"), "c", "g").unionByName(
        sizes.select(F.col("c").alias("id"), "c", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    )
    rows = need.join(texts, "id").withColumn("member", F.col("id") != F.col("c"))
    rows = rows.repartition("c", "g").sortWithinPartitions("c", "g", "member").select("c", "id", "text")
    words, percent = near.words, near.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre, own = None, None
        for b in batches:
            out = []
            for c, i, s in zip(b["c"], b["id"], doc_shingles(b["text"], words)):
                if i == c:
                    centre, own = c, s
                    continue
                assert centre == c, "a centre comes before its members"
                # both are sorted and distinct
                at = np.searchsorted(own, s)
                both = int((own[np.minimum(at, len(own) - 1)] == s).sum())
                if 100 * both >= percent * (len(own) + len(s) - both):
                    out.append((i, c))
            yield pd.DataFrame(out, columns=["u", "v"])

    kind = dict(pairs.dtypes)["a"]
    return rows.mapInPandas(run, f"u {kind}, v {kind}")


def _commonness(texts: DataFrame, near: Near, log: int) -> np.ndarray:
    """How many sets hold a shingle of each of 2 ** ``log`` counters, as eight
    levels for each doubling, a byte each: the order is all that is needed."""
    words, shift = near.words, np.uint64(64 - log)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held = [s >> shift for s in doc_shingles(b["text"], words)]
            at, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            yield pd.DataFrame({"at": at.astype(np.int64), "n": n})

    def levels(part: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(1 << COUNTERS_TOGETHER, np.uint8)
        out[part["at"] & ((1 << COUNTERS_TOGETHER) - 1)] = np.minimum(8 * np.log2(part["n"]) + 1, 255)
        return pd.DataFrame({"part": [part["at"].iloc[0] >> COUNTERS_TOGETHER], "levels": [out.tobytes()]})

    counted = texts.select("text").mapInPandas(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    parts = counted.groupBy(F.shiftright("at", COUNTERS_TOGETHER)).applyInPandas(levels, "part bigint, levels binary")
    out = np.zeros((1 << log) >> COUNTERS_TOGETHER << COUNTERS_TOGETHER, np.uint8)
    for part, block in parts.toLocalIterator():
        out[part << COUNTERS_TOGETHER : (part + 1) << COUNTERS_TOGETHER] = np.frombuffer(block, np.uint8)
    return out


def prefix_pairs(texts: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, c), a > c, of ``texts`` (id, comp, n, text) in different
    components that may be similar enough; no pair that is gets lost.

    Sets of sizes m <= n that are share at least percent * (m + n) / (100 +
    percent) shingles, so in any common order their first common shingle leaves
    that many in both. Each set gives its prefixes as the smaller set, under its
    size class, and as the larger one, under each class that it may meet. Under
    a key all rows meet those outside the key's largest component, so a large
    group of linked sets does not meet itself.
    """
    words, percent = near.words, near.percent
    total = texts.agg(F.sum("n")).first()[0] or 1
    log = min(max(int(total).bit_length(), LEAST_COUNTERS), MOST_COUNTERS)
    sent = texts.sparkSession.sparkContext.broadcast(_commonness(texts, near, log))
    shift = np.uint64(64 - log)
    kinds = dict(texts.dtypes)

    def level(n: int) -> int:
        return int(np.log(n) / np.log(STEP))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held, rows = [], 0
            for i, (s, doc, comp) in enumerate(zip(doc_shingles(b["text"], words), b["id"], b["comp"])):
                n = len(s)
                s = s[np.lexsort((s, sent.value[(s >> shift).astype(np.int64)]))].view(np.int64)
                least = -(-percent * n // 100)
                roles = [(False, level(n), n)]
                # the smallest size of a class, taken one lower against rounding
                roles += [(True, g, max(least, int(STEP**g) - 1)) for g in range(level(least), level(n) + 1)]
                for larger, g, m in roles:
                    take = n - -(-percent * (m + n) // (100 + percent)) + 1
                    at = np.arange(min(n, max(take, 0)))
                    held.append(pd.DataFrame({"token": s[at], "g": g, "larger": larger, "id": doc, "comp": comp, "n": n, "pos": at}))
                    rows += len(at)
                if rows > 50_000:
                    yield pd.concat(held, ignore_index=True)
                    held, rows = [], 0
            if held:
                yield pd.concat(held, ignore_index=True)

    schema = f"token bigint, g int, larger boolean, id {kinds['id']}, comp {kinds['comp']}, n bigint, pos bigint"
    rows = materialize(texts.select("id", "comp", "text").mapInPandas(run, schema), "near-prefixes")
    sent.unpersist()
    of = rows.groupBy("token", "g", "comp").agg(F.count("*").alias("k"))
    most = of.groupBy("token", "g").agg(F.max_by("comp", "k").alias("main"), F.count("*").alias("comps")).where("comps > 1")
    rows = rows.join(most.drop("comps"), ["token", "g"])

    def side(which: str, name: str) -> DataFrame:
        return rows.where(which).select("token", "g", *[F.col(c).alias(f"{name}_{c}") for c in ("id", "comp", "n", "pos")])

    both = side("not larger and comp <> main", "x").join(side("larger", "y"), ["token", "g"]).unionByName(
        side("not larger and comp = main", "x").join(side("larger and comp <> main", "y"), ["token", "g"])
    )
    enough = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos")) * (100 + percent) >= percent * (F.col("x_n") + F.col("y_n"))
    both = both.where((F.col("x_comp") != F.col("y_comp")) & (F.col("x_n") <= F.col("y_n")) & enough)
    return both.select(F.greatest("x_id", "y_id").alias("a"), F.least("x_id", "y_id").alias("c")).distinct()


def _labelled(ids: DataFrame, component: DataFrame) -> DataFrame:
    """``ids`` with the component ``comp`` of each ``id``, its own if it has no link."""
    found = ids.join(component.withColumnRenamed("component", "comp"), "id", "left")
    return found.withColumn("comp", F.coalesce("comp", "id"))


def _closed(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, comp) after ``links`` (u, v): whole components join."""
    ends = links.join(labels.toDF("u", "u_comp"), "u").join(labels.toDF("v", "v_comp"), "v")
    over = connected_components(ends.select(F.col("u_comp").alias("u"), F.col("v_comp").alias("v")))
    joined = labels.join(over.toDF("comp", "joined"), "comp", "left")
    return materialize(joined.select("id", F.coalesce("joined", "comp").alias("comp")), "near-labels")


def _mixed(buckets: DataFrame, labels: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(members of all buckets with their component, buckets in several of them)."""
    labelled = buckets.join(labels, "id")
    mixed = labelled.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), *more)
    return labelled, mixed.where("lo < hi").drop("lo", "hi")


def _further_pairs(buckets: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, c): each member of a mixed bucket with up to TRIES classes of other
    components, that stand for buckets of its own, chosen by hash."""
    stands = F.min_by(F.struct("id", "comp"), F.xxhash64("id", "band", F.lit(turn))).alias("m")
    labelled, mixed = _mixed(buckets, labels, stands)
    met = labelled.join(mixed, ["band", "key"]).where(F.col("comp") != F.col("m.comp"))
    # a class has as many buckets as there are bands
    tries = F.slice(F.array_sort(F.collect_set(F.struct(F.xxhash64("id", "m.id").alias("h"), F.col("m.id").alias("m")))), 1, TRIES)
    pairs = met.groupBy("id").agg(tries.alias("tries")).select("id", F.explode("tries.m").alias("m"))
    return pairs.select(F.greatest("id", "m").alias("a"), F.least("id", "m").alias("c")).distinct()


def _class_components(classes: DataFrame, docs: DataFrame, repeated: bool, near: Near) -> DataFrame:
    """(id, comp) of every class of ``classes`` (id, doc_id, text_hash, n, bands)
    that shares a bucket with another one."""
    banded = classes.select("id", F.posexplode("bands").alias("band", "key"))
    centres = banded.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("id").alias("c")).where("n > 1")
    stars = materialize(banded.join(centres.drop("n"), ["band", "key"]), "near-buckets")
    buckets = stars.drop("c")
    wanted = classes.join(stars.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "text_hash", "n")
    texts = docs.select(col("doc_id").alias("doc_id"), F.xxhash64(col("text")).alias("text_hash"), col("text").alias("text"))
    texts = texts.join(wanted, ["doc_id", "text_hash"]).select("id", "n", "text")
    texts = materialize(texts.dropDuplicates(["id"]) if repeated else texts, "near-texts")

    pairs = materialize(stars.where("id <> c").select(F.col("id").alias("a"), "c").distinct(), "near-pairs")
    links = materialize(confirm(pairs, texts.drop("n"), near), "near-links")
    labels = materialize(_labelled(texts.select("id"), connected_components(links)), "near-labels")
    for turn in range(ROUNDS):
        fresh = materialize(_further_pairs(buckets, labels, turn).join(pairs, ["a", "c"], "left_anti"), "near-pairs")
        labels = _closed(labels, materialize(confirm(fresh, texts.drop("n"), near), "near-links"))
        pairs = pairs.unionByName(fresh)
    # the members of buckets that are still in several components
    labelled, mixed = _mixed(buckets, labels)
    left = labelled.join(mixed, ["band", "key"]).select("id", "comp").distinct()
    left = materialize(texts.join(left, "id"), "near-mixed")
    more = materialize(prefix_pairs(left, near).join(pairs, ["a", "c"], "left_anti"), "near-pairs")
    return _closed(labels, materialize(confirm(more, texts.drop("n"), near), "near-links"))


def near_groups(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, first) of every row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. Every row is a
    document, also where ids repeat; ``text_hash`` (xxhash64) tells the texts of
    an id apart. component_id is the smallest doc_id of the documents that links
    reach; ``first`` holds for the component's document with that id, the one of
    smallest text_hash if several have it, and for rows that repeat it. Texts
    that are null, empty or hold no word are linked with nothing, and first. Rows
    with a null doc_id form no links and have a null component. An empty table
    gives an empty table.
    """
    with small_batches(docs.sparkSession):
        signed = materialize(signatures(docs, near), "near-signatures")
        usable = signed.where("digest is not null and doc_id is not null")
        repeated = not signed.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).isEmpty()
        one = F.struct("doc_id", "text_hash")
        classes = usable.groupBy("digest").agg(
            F.min(one).alias("one"), F.min_by("bands", one).alias("bands"), F.first("n_shingles").alias("n")
        ).select(F.monotonically_increasing_id().alias("id"), "digest", "one.*", "n", "bands")
        classes = materialize(classes, "near-classes")
        comps = _class_components(classes, docs, repeated, near)
    placed = classes.select("id", "digest", one.alias("one")).join(comps, "id", "left")
    placed = placed.withColumn("comp", F.coalesce("comp", "id"))
    heads = placed.groupBy("comp").agg(F.min("one").alias("head"))
    placed = placed.join(heads, "comp").select("digest", "head")
    found = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(placed, "digest", "left")
    return found.select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("head.doc_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("head") == one, F.lit(True)).alias("first"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def near_components(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; see ``near_groups``."""
    return near_groups(docs, near).select("doc_id", "n_shingles", "component_id")


def first_of_groups(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The rows of ``docs`` without near copies of others: of each group the
    document with the smallest id, once if its row is repeated. Texts without
    words and rows without an id are in no group and all stay."""
    groups = materialize(near_groups(docs, near), "near-groups")
    key = [col("doc_id").alias("key_id"), F.xxhash64(col("text")).alias("key_text")]
    alone = col("doc_id").isNull() | ~F.coalesce(col("text").rlike(WORD), F.lit(False))
    rows = docs.where(~alone).select(packed(docs), *key)
    first = groups.where("first and n_shingles > 0").select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_text"))
    kept = rows.join(first.distinct(), ["key_id", "key_text"], "left_semi")
    if not first.groupBy("key_id", "key_text").count().where("count > 1").limit(1).isEmpty():
        kept = kept.dropDuplicates(["key_id", "key_text"])
    return kept.select(*unpacked(docs.columns, {})).unionByName(docs.where(alone).select(*map(col, docs.columns)))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies over all documents, three-word shingles, 85 %."""
    out = near_components(read(spark, sf_dir, "documents"), Near(words=3, percent=85))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
