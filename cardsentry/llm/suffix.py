"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of WINDOW bytes covers it that also starts earlier.

1. Every window picks the smallest hash among its K-byte strings, the leftmost
   on ties. Equal windows pick equally, so they meet under that hash. Windows
   in a row that pick the same place form a run, and a run's piece is the
   text they cover.
2. Hashes are counted with partial sums; runs whose hash occurs once are
   unique and go no further. This is the only step over all runs.
3. Equal pieces are collapsed before the shuffle into one piece with the
   earliest place it occurs at. Copies of it are repeats as a whole.
4. The distinct pieces of a hash are a lane. Each lane's suffixes are put in
   order by the linear grouping of ``lyndon``; neighbours that agree on WINDOW
   bytes are equal windows, and all but the earliest are repeats.
5. The pieces of a hash with more than LANE distinct ones (a common line in
   changing surroundings) go through steps 1 to 4 again with longer strings,
   in the end whole windows, so that no lane grows with the input.
6. Each document gets its runs and verdicts back and cuts its text.

Texts are read where they lie in steps 1 and 2; two shuffles carry them, by
document, in steps 3 and 6. Tables between the steps are written to the shared
folder, and the shuffle files of a step are let go when it is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import read
from cardsentry.llm.lyndon import Strings, equal_windows, suffix_order
from cardsentry.llm.textwords import BASE, INVERSE, U, _mixed, _table
from cardsentry.sources.storage import materialize

WINDOW = 100
K = 32
# Distinct pieces under one hash that a lane takes at most, and the lengths of
# string by which larger ones are dealt anew.
LANE = 64
FINER = (64, 84, 94, WINDOW)
# Bytes of text that are hashed at once, and bytes that are ordered at once.
SEGMENT = 1 << 18
CHUNK = 1 << 19

# Places in a hash's low bits: as many as a segment and one window have.
_PLACE_BITS = 20
_PLACE = U((1 << _PLACE_BITS) - 1)
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_START_SPAN = 1 << 31


def text_runs(b: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, windows) of the runs of one text's bytes, by k-byte strings.

    Long texts are hashed in segments; a run that a segment's end cuts is two
    runs with the same hash, which changes no result.
    """
    out = []
    for at in range(0, max(1, len(b) - WINDOW + 1), SEGMENT):
        part = b[at : at + SEGMENT + WINDOW - 1]
        if len(part) < WINDOW:
            break
        n = len(part) - k + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _table(BASE, len(part)), out=sums[1:])
        full = _mixed((sums[k:] - sums[:-k]) * _table(INVERSE, n) + U(k))
        low = (full & ~_PLACE) | np.arange(n, dtype=np.uint64)
        wide, span = WINDOW - k + 1, 1
        while 2 * span <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if wide > span:
            low = np.minimum(low[: span - wide], low[wide - span :])
        start = np.flatnonzero(np.diff(low, prepend=~low[:1]))
        out.append((full[(low[start] & _PLACE).astype(np.int64)], start + at, np.diff(start, append=len(low))))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _bytes(text: object) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8) if isinstance(text, str) else np.zeros(0, np.uint8)


def all_runs(docs: DataFrame, places: bool) -> DataFrame:
    """(hash) or (hash, key, start, windows) of every run of ``docs`` (key, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [text_runs(_bytes(t)) for t in b["text"]]
            sizes = [len(f[0]) for f in found]
            out = {"hash": np.concatenate([f[0] for f in found]).view(np.int64)} if found else {"hash": []}
            if places and found:
                out |= {
                    "key": np.repeat(b["key"].to_numpy(), sizes),
                    "start": np.concatenate([f[1] for f in found]).astype(np.int32),
                    "windows": np.concatenate([f[2] for f in found]).astype(np.int32),
                }
            if found:
                yield pd.DataFrame(out)

    rest = f", key {dict(docs.dtypes)['key']}, start int, windows int" if places else ""
    source = docs.select("key", "text") if places else docs.select("text")
    return source.mapInPandas(run, "hash bigint" + rest)


def pieces(rows: DataFrame) -> DataFrame:
    """(hash, piece, key, start) of the runs in ``rows`` (key, text, runs);
    runs is an array of (start, windows, hash)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes, cut, keys, starts = [], [], [], []
            for key, text, runs in zip(b["key"], b["text"], b["runs"]):
                t = text.encode()
                for r in runs:
                    at = r["start"]
                    hashes.append(r["hash"])
                    cut.append(t[at : at + r["windows"] + WINDOW - 1])
                    keys.append(key)
                    starts.append(at)
            yield pd.DataFrame({"hash": hashes, "piece": cut, "key": keys, "start": starts})

    return rows.mapInPandas(run, f"hash bigint, piece binary, key {dict(rows.dtypes)['key']}, start int")


def lane_repeats(lanes: DataFrame) -> DataFrame:
    """(key, start, a, b): windows a <= i < b of the piece at (key, start) are
    repeats of earlier ones. ``lanes`` (hash, piece, key, start) holds distinct
    pieces, partitioned by hash and sorted so that a hash stands together."""
    kind = dict(lanes.dtypes)["key"]

    def judge(hashes: np.ndarray, cut: list[bytes], keys: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
        s = Strings(cut, np.cumsum(np.diff(hashes, prepend=hashes[:1]) != 0))
        at, same = equal_windows(s, suffix_order(s), WINDOW)
        string = np.searchsorted(s.begin, at, side="right") - 1
        offset = at - s.begin[string]
        _, rank = np.unique(keys, return_inverse=True)
        when = rank[string] * _START_SPAN + starts[string] + offset
        first = np.minimum.reduceat(when, np.flatnonzero(np.diff(same, prepend=-1))) if len(when) else when
        late = when != first[same]
        spot = np.sort(string[late] * (1 << 32) + offset[late])
        head = np.flatnonzero(np.diff(spot, prepend=-2) != 1)
        size = np.diff(head, append=len(spot))
        string, a = spot[head] >> 32, spot[head] & ((1 << 32) - 1)
        return pd.DataFrame({"key": keys[string], "start": starts[string].astype(np.int32), "a": a.astype(np.int32), "b": (a + size).astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for b in batches:
            held.append(b)
            size += int(b["piece"].str.len().sum())
            if size < CHUNK:
                continue
            rows = pd.concat(held, ignore_index=True)
            h = rows["hash"].to_numpy()
            whole = int(np.flatnonzero(np.diff(h, prepend=~h[:1]))[-1])  # the last hash may go on
            ends = np.cumsum(rows["piece"].str.len().to_numpy())
            at = 0
            while at < whole:
                upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK))
                upto = min(max(upto, at + 1), whole)
                while upto < whole and h[upto] == h[upto - 1]:
                    upto += 1
                part = rows.iloc[at:upto]
                yield judge(h[at:upto], list(part["piece"]), part["key"].to_numpy(), part["start"].to_numpy().astype(np.int64))
                at = upto
            held = [rows.iloc[whole:]]
            size = int(held[0]["piece"].str.len().sum())
        rows = pd.concat(held, ignore_index=True) if held else None
        if rows is not None and len(rows):
            yield judge(rows["hash"].to_numpy(), list(rows["piece"]), rows["key"].to_numpy(), rows["start"].to_numpy().astype(np.int64))

    return lanes.mapInPandas(run, f"key {kind}, start int, a int, b int")


def finer_pieces(lanes: DataFrame, k: int) -> DataFrame:
    """The pieces of hot lanes as runs by k-byte strings, in the same columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [text_runs(np.frombuffer(p, np.uint8), k) for p in b["piece"]]
            sizes = [len(f[0]) for f in found]
            at = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            cut = [p[i : i + n + WINDOW - 1] for p, f in zip(b["piece"], found) for i, n in zip(f[1].tolist(), f[2].tolist())]
            yield pd.DataFrame({
                "hash": np.concatenate([f[0] for f in found]).view(np.int64) if found else at,
                "piece": cut,
                "key": np.repeat(b["key"].to_numpy(), sizes),
                "start": (np.repeat(b["start"].to_numpy(), sizes) + at).astype(np.int32),
            })

    kind = dict(lanes.dtypes)["key"]
    return lanes.select("piece", "key", "start").mapInPandas(run, f"hash bigint, piece binary, key {kind}, start int")


@contextmanager
def _shuffles_let_go(spark: SparkSession):
    """Steps run inside drop their shuffle files when they are written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _place(key_is_id: bool) -> tuple[Column, Column, Column]:
    """A value that orders (key, start), and both read back from it (``first``).

    An integer key and a start make one decimal, which aggregates by hash.
    """
    if not key_is_id:
        return F.struct("key", "start"), F.col("first.key"), F.col("first.start")
    span = F.lit(_START_SPAN).cast("decimal(20,0)")
    both = (F.col("key").cast("decimal(20,0)") * span + F.col("start")).cast("decimal(38,0)")
    start = F.pmod(F.col("first"), F.lit(_START_SPAN).cast("decimal(38,0)"))
    return both, F.expr(f"(first - pmod(first, cast({_START_SPAN} as decimal(38,0)))) div {_START_SPAN}"), start.cast("int")


def _lanes(distinct: DataFrame) -> DataFrame:
    """Distinct pieces that share their hash with others, and how many do."""
    sizes = distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    return materialize(distinct.join(sizes, "hash"), "suffix-lanes")


def _ordered(lanes: DataFrame) -> DataFrame:
    """The lanes that are not too large, each in one task. Lanes that are put in
    order together take as many steps as the largest, so lanes of a size stand
    together."""
    small = lanes.where(F.col("n") <= LANE).repartition("hash")
    return small.sortWithinPartitions("n", "hash").drop("n")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, marks) for ``docs`` (key, text): what every document with runs
    needs for its cut; marks are structs (kind, start, a, b).

    Kind 0 is a run of b windows at start, kind 1 says that the piece there
    is the earliest of its copies, kind 2 that its windows a to b are repeats.
    """
    spark = docs.sparkSession
    key_is_id = dict(docs.dtypes)["key"] == "bigint"
    with _shuffles_let_go(spark):
        counts = all_runs(docs, places=False).groupBy("hash").agg(F.count("*").alias("n"))
        repeated = materialize(counts.where("n > 1").select("hash"), "suffix-hashes")
        runs = materialize(all_runs(docs, places=True).join(repeated, "hash"), "suffix-runs")
        by_doc = runs.groupBy("key").agg(F.collect_list(F.struct("start", "windows", "hash")).alias("runs"))
        cut = pieces(docs.join(by_doc, "key").select("key", "text", "runs"))
        value, key, start = _place(key_is_id)
        distinct = cut.select("hash", "piece", value.alias("first")).groupBy("hash", "piece").agg(F.min("first").alias("first"))
        distinct = materialize(distinct.select("hash", "piece", key.alias("key"), start.alias("start")), "suffix-pieces")
        lanes = _lanes(distinct)
        found = [lane_repeats(_ordered(lanes))]
        for k in FINER:
            hot = lanes.where(F.col("n") > LANE)
            if hot.isEmpty():
                break
            parts = materialize(finer_pieces(hot, k).withColumn("value", value), "suffix-parts")
            first = parts.groupBy("hash", "piece").agg(F.min("value").alias("first"))
            late = parts.join(first, ["hash", "piece"]).where(F.col("value") != F.col("first"))
            found.append(late.select("key", "start", F.lit(0).alias("a"), (F.octet_length("piece") - WINDOW + 1).alias("b")))
            lanes = _lanes(first.select("hash", "piece", key.alias("key"), start.alias("start")))
            found.append(lane_repeats(_ordered(lanes)))
        repeats = materialize(reduce(DataFrame.unionByName, found), "suffix-repeats")
    zero = F.lit(0)
    marks = (
        runs.select("key", F.struct(zero.alias("kind"), "start", zero.alias("a"), F.col("windows").alias("b")).alias("m"))
        .unionByName(distinct.select("key", F.struct(F.lit(1).alias("kind"), "start", zero.alias("a"), zero.alias("b")).alias("m")))
        .unionByName(repeats.select("key", F.struct(F.lit(2).alias("kind"), "start", "a", "b").alias("m")))
    )
    return marks.groupBy("key").agg(F.collect_list("m").alias("marks"))


def removed_spans(marks) -> list[tuple[int, int]]:
    """The maximal removed byte spans of one document from its marks."""
    if marks is None or not len(marks):
        return []
    first = {m["start"] for m in marks if m["kind"] == 1}
    spans = [(m["start"], m["start"] + m["b"] + WINDOW - 1) for m in marks if m["kind"] == 0 and m["start"] not in first]
    spans += [(m["start"] + m["a"], m["start"] + m["b"] + WINDOW - 1) for m in marks if m["kind"] == 2]
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the length of its text in
    bytes, the removed byte spans as structs (start, stop) and the bytes left.

    ``docs`` needs doc_id and text; other columns are ignored. Order is by
    doc_id; a row without an id comes after all others. Rows that share an id
    or have none are ordered among themselves by a hash of their text, and
    rows equal in both are one document that each of them stands for. A null
    text is empty. Texts under WINDOW bytes lose nothing. An empty table gives
    an empty table.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if _one_row_each(docs):
        keyed = once = docs.select(F.col("doc_id").cast("bigint").alias("key"), "doc_id", "text")
    else:
        # 16 digits of the id with its sign turned, so that text order is number order
        number = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        key = F.concat_ws(":", F.coalesce(number, F.lit("g")), F.sha2(F.col("text").cast("binary"), 256))
        keyed = docs.select(key.alias("key"), "doc_id", "text")
        once = keyed.dropDuplicates(["key"])
    marks = repeated_spans(once.select("key", "text"))
    joined = keyed.join(marks, "key", "left").select("doc_id", "text", "marks")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes, spans, kept = [], [], []
            for text, marks in zip(b["text"], b["marks"]):
                t = text.encode()
                gone = removed_spans(marks)
                ends = [0, *(x for span in gone for x in span), len(t)]
                sizes.append(len(t))
                spans.append([{"start": x, "stop": y} for x, y in gone])
                kept.append(b"".join(t[x:y] for x, y in zip(ends[::2], ends[1::2])))
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    kind = dict(docs.dtypes)["doc_id"]
    return joined.mapInPandas(
        run, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint, stop:bigint>>, kept binary"
    )


def _one_row_each(docs: DataFrame) -> bool:
    """Whether every row has an integer id of its own."""
    if dict(docs.dtypes)["doc_id"] not in ("bigint", "int", "smallint", "tinyint"):
        return False
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    return odd.limit(1).isEmpty()


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed from every document, and a digest of what is left."""
    rows = cut_repeats(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: dict) -> dict:
    """{id: (n_bytes, n_removed, n_spans, sha256)} of a few texts, window by window (for tests)."""
    seen: set[bytes] = set()
    out = {}
    for key in sorted(texts):
        t = (texts[key] or "").encode()
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - WINDOW + 1):
            w = t[i : i + WINDOW]
            if w in seen:
                gone[i : i + WINDOW] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(t, gone) if not g)
        n_spans = int((np.diff(gone[: len(t)].astype(int), prepend=0) == 1).sum())
        out[key] = (len(t), len(t) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
    return out
