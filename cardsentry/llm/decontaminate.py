"""Benchmark decontamination as a prefix-filtered set join.

A record is a window of benchmark words: ``window`` consecutive words of an
item, or a whole shorter item. Its set are its word shingles. A document holds
the record if some run of as many document words has all of them, in place.

1. The shingles of the benchmark go into a Bloom filter of bounded size. One pass
   over the documents counts those that pass, which orders shingles by rarity.
2. All of a record's shingles are required, so a prefix of one is enough: its
   rarest. Neighbouring windows mostly share it; the windows of an item around
   one rarest shingle are kept together as a segment, and equal segments of
   several items once.
3. A second pass over the documents emits the places of those shingles with the
   few words around them, and a join on the shingle meets the segments. Texts are
   never shuffled.
4. Length and position bounds leave out pairs in which no window fits; the rest
   is compared word by word, outwards from the shingle.
5. Word intervals are united per document. Items are looked up once for each
   distinct set of segments, so a passage in a third of all documents is not
   multiplied by the items that share it.

Hashes only choose candidates; words decide. The filter grows with the
benchmark up to 2 ** MOST_BITS bits; beyond that it lets more pass, and the
join does the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import col, read
from cardsentry.sources.storage import materialize

# Fixed values of the contract: what is no part of a word, and the words of a window.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
SHINGLE = 5
# Bits of the filter for each shingle, and logarithms of its least and largest size.
BITS_EACH = 64
LEAST_BITS, MOST_BITS = 20, 28
# Bytes of texts that are hashed together.
CHUNK = 1 << 20

U = np.uint64
_PROBES = [U(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@dataclass
class Words:
    """The words of several texts: lower-cased bytes, where each word starts and
    stops, the text it belongs to, its hash, and the first word of each text."""

    raw: bytes
    start: np.ndarray
    stop: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> "Words":
        raw = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        inside = _INSIDE[raw]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        start, stop = edge[::2], edge[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, np.int64)
        text = np.searchsorted(begins, start, "right") - 1
        size = stop - start
        offset = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(offset, size)
        value = _mixed((raw[inside].astype(U) + U(1)) * U(0x9FB21C651E98DF25) + place.astype(U) * _PROBES[0])
        hashed = _mixed(np.add.reduceat(value, offset) + size.astype(U)) if len(size) else np.zeros(0, U)
        return cls(raw.tobytes(), start, stop, text, hashed, np.searchsorted(text, np.arange(len(texts))))

    def shingles(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the first word, hash) of each run of ``words`` words inside
        one text."""
        n = max(len(self.hash) - words + 1, 0)
        out = np.full(n, U(words))
        for i in range(words):
            out = _mixed(out * _PROBES[0] + self.hash[i : i + n])
        at = np.flatnonzero(self.text[:n] == self.text[words - 1 : words - 1 + n])
        return at, out[at]

    def join(self, a: int, b: int) -> str:
        return b" ".join(self.raw[self.start[i] : self.stop[i]] for i in range(a, b)).decode("utf-8", "replace")


def chunks(texts: pd.Series) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes (null: none), together up to CHUNK bytes, and the number of
    the first."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        raw = t.encode() if isinstance(t, str) else b""
        if held and size + len(raw) > CHUNK:
            yield first, held
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def _places(tokens: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for p in _PROBES:
        yield (tokens * p) >> U(64 - bits)


class Filter:
    """A Bloom filter of shingle hashes for each number of words in use."""

    def __init__(self, widths: list[int], bits: int, table: np.ndarray):
        self.widths, self.bits, self.table = widths, bits, table

    def passing(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for width in self.widths:
            at, token = words.shingles(width)
            for p in _PROBES:
                i = (token * p) >> U(64 - self.bits)
                keep = self.table[(i >> U(3)).astype(np.int64)] >> (i & U(7)).astype(np.uint8) & 1 == 1
                at, token = at[keep], token[keep]
            yield width, at, token


def bloom(tokens: DataFrame) -> Filter:
    """The filter of ``tokens`` (token, width), put together in Spark; what
    reaches the driver is its 2 ** MOST_BITS bits at most."""
    n = tokens.count()
    bits = min(max(LEAST_BITS, int(n * BITS_EACH).bit_length()), MOST_BITS)
    widths = sorted(r[0] for r in tokens.select("width").distinct().collect())

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            token = b["token"].to_numpy(np.int64).view(U)
            yield pd.DataFrame({"i": np.concatenate([*_places(token, bits)]).astype(np.int64) + 1})

    set_ = tokens.select("token").mapInPandas(places, "i bigint")
    parts = set_.groupBy(F.expr("bitmap_bucket_number(i)").alias("part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(i))").alias("bits")
    )
    table = np.zeros(1 << (bits - 3), np.uint8)
    for part, block in parts.toLocalIterator():
        table[(part - 1) * 4096 : part * 4096] = np.frombuffer(block, np.uint8)[: len(table)]
    return Filter(widths, bits, table)


def item_shingles(items: DataFrame, shingle: int) -> DataFrame:
    """(item, pos, token, width, n) of every shingle of ``items`` (item, text);
    items of fewer words are one shingle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item, text in zip(b["item"], b["text"]):
                words = Words.of([text.encode()])
                n = len(words.hash)
                if n:
                    at, token = words.shingles(min(shingle, n))
                    yield pd.DataFrame({"item": item, "pos": at, "token": token.view(np.int64), "width": min(shingle, n), "n": n})

    return items.where("text is not null").mapInPandas(run, "item bigint, pos bigint, token bigint, width int, n bigint")


def count_tokens(docs: DataFrame, kept: Filter) -> DataFrame:
    """(token, times) of the shingles of ``docs`` (text) that pass the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, texts in chunks(b["text"]):
                found = np.concatenate([np.zeros(0, U), *(t for _, _, t in sent.value.passing(Words.of(texts)))])
                token, times = np.unique(found, return_counts=True)
                yield pd.DataFrame({"token": token.view(np.int64), "times": times})

    counted = docs.select("text").mapInPandas(run, "token bigint, times bigint")
    return counted.groupBy("token").agg(F.sum("times").alias("times"))


def segments(items: DataFrame, shingles: DataFrame, counts: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, token, length, before, words) of the windows of every item around
    one rarest shingle: ``before`` of the words come before it, and ``length`` of
    them are a window."""
    ranked = shingles.join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "token", "pos")).over(
        Window.partitionBy("item").orderBy("pos").rowsBetween(0, window - shingle)
    )
    length = F.least("n", F.lit(window)).cast("int")
    each = ranked.select("item", "pos", length.alias("length"), "n", rarest.alias("r")).where("pos <= n - length")
    around = each.groupBy("item", "length", F.col("r.pos").alias("at"), F.col("r.token").alias("token")).agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    words = items.select("item", F.expr(f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), r'({WORD})', 1)").alias("w"))
    return around.join(words, "item").select(
        "item", "token", "length", (F.col("at") - F.col("lo")).cast("int").alias("before"),
        F.array_join(F.slice("w", (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int") + F.col("length")), " ").alias("words"),
    )


def scan(docs: DataFrame, kept: Filter, window: int, shingle: int) -> DataFrame:
    """For each row of ``docs`` (key, doc, text) a row with n_words, and one for
    each shingle that passes the filter: its place and the words around it, of
    which ``back`` come before it and ``ahead`` from its start on."""
    sent = docs.sparkSession.sparkContext.broadcast(kept)
    names = ["key", "doc", "n_words", "token", "pos", "back", "ahead", "around"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, ids = b["key"].to_numpy(), b["doc"].tolist()
            for first, texts in chunks(b["text"]):
                words = Words.of(texts)
                last = np.append(words.first[1:], len(words.hash))
                n = last - words.first
                yield pd.DataFrame({"key": keys[first : first + len(texts)], "doc": ids[first : first + len(texts)], "n_words": n, "token": 0, "pos": -1, "back": 0, "ahead": 0, "around": None})
                rows = []
                for width, at, token in kept_of(words):
                    reach = (window - width, window) if width == shingle else (0, width)
                    for i, t, d in zip(at.tolist(), token.view(np.int64).tolist(), words.text[at].tolist()):
                        a, z = max(i - reach[0], words.first[d]), min(i + reach[1], last[d])
                        rows.append((keys[first + d], None, 0, t, i - words.first[d], i - a, z - i, words.join(a, z)))
                        if len(rows) == 4096:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    def kept_of(words: Words):
        return sent.value.passing(words)

    schema = "key bigint, doc string, n_words bigint, token bigint, pos bigint, back int, ahead int, around string"
    return docs.select("key", "doc", "text").mapInPandas(run, schema)


def common_run(around: list[str], back: int, words: list[str], before: int) -> tuple[int, int]:
    """How many words agree before the shingle, and from its start on."""
    left = 0
    while left < min(back, before) and around[back - left - 1] == words[before - left - 1]:
        left += 1
    right, most = 0, min(len(around) - back, len(words) - before)
    while right < most and around[back + right] == words[before + right]:
        right += 1
    return left, right


def verified(pairs: DataFrame) -> DataFrame:
    """(key, segment, start, stop) of the pairs whose words agree over a whole
    window: the document words of all windows of the segment that occur there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, seen = [], {}
            columns = ("key", "pos", "segment", "length", "around", "back", "words", "before")
            for key, pos, segment, length, *ends in zip(*(b[c].tolist() for c in columns)):
                ends = tuple(ends)
                if ends not in seen:  # the same passage in many documents
                    around, back, words, before = ends
                    seen[ends] = common_run(around.split(" "), back, words.split(" "), before)
                left, right = seen[ends]
                if left + right >= length:
                    out.append((key, segment, pos - left, pos + right))
            yield pd.DataFrame(out, columns=["key", "segment", "start", "stop"])

    return pairs.mapInPandas(run, "key bigint, segment string, start bigint, stop bigint")


@dataclass(frozen=True)
class Contamination:
    """``documents`` (key, doc, n_words), one row for each row of the table;
    ``hits`` (key, segment, start, stop), intervals of document words; and
    ``members`` (segment, item_id)."""

    documents: DataFrame
    hits: DataFrame
    members: DataFrame

    def spans(self) -> DataFrame:
        """(doc, item_id, start, stop): the words of each document that windows
        of an item cover; intervals of one item may overlap."""
        return self.hits.join(self.members, "segment").join(self.documents.select("key", "doc"), "key").select(
            "doc", "item_id", "start", "stop"
        ).distinct()

    def summary(self) -> DataFrame:
        """(doc, n_words, n_hit, n_items, items_sha256, contaminated) of each row."""
        before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
        new = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
        covered = self.hits.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").alias("n_hit"))
        of = self.hits.groupBy("key").agg(F.array_sort(F.collect_set("segment")).alias("segments"))
        of = of.withColumn("class", F.sha2(F.array_join("segments", ","), 256))
        classes = of.groupBy("class").agg(F.first("segments").alias("segments"))
        listed = classes.select("class", F.explode("segments").alias("segment")).join(self.members, "segment")
        listed = listed.groupBy("class").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        listed = listed.select("class", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", ",").alias("items"))
        found = covered.join(of.select("key", "class"), "key").join(listed, "class", "left")
        n_hit = F.coalesce("n_hit", F.lit(0))
        return self.documents.join(found, "key", "left").select(
            "doc", "n_words", n_hit.cast("bigint").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        )


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> Contamination:
    """Where windows of ``items`` (item_id, text) occur in ``docs`` (doc_id, text).

    Other columns are ignored. Every row of ``docs`` counts as a document of its
    own, also if it repeats an id or has none. Texts that are null or hold no
    word have no windows. Items that repeat an id are one item; an item without
    an id marks words, but is neither counted nor listed. An empty table on
    either side gives no hits.
    """
    items = materialize(
        items.select(F.monotonically_increasing_id().alias("item"), col("item_id").cast("string").alias("item_id"), col("text").alias("text")),
        "contamination-items",
    )
    docs = docs.select(F.monotonically_increasing_id().alias("key"), col("doc_id").cast("string").alias("doc"), col("text").alias("text"))
    shingles = materialize(item_shingles(items.select("item", "text"), shingle), "contamination-shingles")
    counts = materialize(count_tokens(docs, bloom(shingles.select("token", "width").distinct())), "contamination-counts")
    found = segments(items, shingles, counts, window, shingle)
    name = F.sha2(F.concat_ws(" ", "length", "before", "words"), 256)
    found = materialize(found.withColumn("segment", name), "contamination-segments")
    distinct = found.groupBy("segment").agg(*[F.first(c).alias(c) for c in ("token", "length", "before", "words")])
    distinct = materialize(distinct, "contamination-anchors")
    members = found.join(items.select("item", "item_id"), "item").where("item_id is not null").select("segment", "item_id").distinct()

    anchors = bloom(distinct.select("token", F.least("length", F.lit(shingle)).alias("width")).distinct())
    scanned = materialize(scan(docs, anchors, window, shingle), "contamination-scan")
    pairs = scanned.where("pos >= 0").join(distinct, "token")
    after = F.size(F.split("words", " ")) - F.col("before")
    pairs = pairs.where(F.least("back", "before") + F.least(F.col("ahead"), after) >= F.col("length"))
    hits = materialize(verified(pairs), "contamination-hits")
    return Contamination(scanned.where("pos < 0").select("key", "doc", "n_words"), hits, materialize(members, "contamination-members"))


def op12_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of benchmark items cover."""
    docs = read(spark, sf_dir, "documents")
    out = find_contamination(docs, read(spark, sf_dir, "benchmark")).summary()
    doc_id = F.col("doc").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id")
    return out.select(doc_id, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
OP12_SQL = f"""
with d as (select row_number() over () as key, doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w, least({WINDOW}, len(w)) as size from benchmark where text is not null),
iw as (select distinct item_id, size, array_to_string(w[p + 1:p + size], ' ') as words
  from (select *, unnest(range(0, len(w) - size + 1)) as p from i where size > 0)),
dw as (select key, p, size, array_to_string(w[p + 1:p + size], ' ') as words
  from (select *, unnest(range(0, len(w) - size + 1)) as p from d, (select distinct size from iw) where len(w) >= size)),
m as (select key, p, size, item_id from dw join iw using (size, words)),
h as (select key, count(distinct q) as n_hit from (select key, unnest(range(p, p + size)) as q from m) group by key),
t as (select key, count(distinct item_id) as n_items,
  array_to_string(list_sort(list(distinct item_id::varchar)), ',') as items from m where item_id is not null group by key)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (key) left join t using (key)
"""
