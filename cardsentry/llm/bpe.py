"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never end up inside one
token of an encoding, so it marks a certain cut. Every piece of the
pre-tokeniser is cut at such pairs, the fragments are merged independently and
their ids concatenated.

The vocabulary file belongs to a public tokeniser; its path is a parameter and
each Python worker reads it once. Rows are never moved: both directions are
map-only, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import packed, read, unpacked

# Fixed value: the public split pattern of byte-level BPE, with white space
# spelled out as the tokenizer's regular-expression library understands it.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Parts of texts that a worker's cache holds; when it is full, the older half goes.
CACHE = 100_000
# Longer fragments are merged one by one with a heap, shorter ones together.
SHORT = 32
# Texts are looked up by parts that end where a single space follows one
# visible character and precedes another: the pattern always splits there.
ODD_SPACE = re.compile(rf"[{SPACE}] | [{SPACE}]")
PARTS = regex.compile(rf"(?<=[^{SPACE}])(?= [^{SPACE}])")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def printable_bytes() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = printable_bytes()
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.ids = {to_bytes(t): i for t, i in vocab.items()}
        self.token = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        # pair of ids -> rank, and what the merge of a rank makes
        self.rank: dict[tuple[int, int], int] = {}
        made: list[int] = []
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = map(to_bytes, m.split(" ") if isinstance(m, str) else m)
            self.rank[self.ids[a], self.ids[b]] = rank
            made.append(self.ids[a + b])
        self.made = np.array([*made, -1], np.int64)
        self.never = len(made)
        self._hash_ranks()
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        # joined[256 * a + b]: some token holds byte a followed by byte b
        joined = np.zeros(1 << 16, bool)
        for t in self.ids:
            b = np.frombuffer(t, np.uint8).astype(np.int64)
            joined[b[:-1] * 256 + b[1:]] = True
        self.joined = joined
        self.split = regex.compile(SPLIT)
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # all tokens one after the other, for decoding
        n = max(self.token) + 1
        self.size = np.array([len(self.token.get(i, b"")) for i in range(n)], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(n)), np.uint8)

    def _hash_ranks(self) -> None:
        """A hash table of the pairs for look-ups of whole arrays."""
        bits = max(8, int(self.never * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.ranks = np.full((1 << bits) + 64, self.never, np.int64)
        for (a, b), rank in self.rank.items():
            key = a << 32 | b
            at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> int(self.shift)
            while self.keys[at] != -1:
                at += 1
            self.keys[at], self.ranks[at] = key, rank

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of every pair; pairs that are never merged get ``never``."""
        key = a << 32 | b
        at = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        found = self.keys[at]
        out = self.ranks[at]
        todo = np.flatnonzero((found != key) & (found != -1))
        out[found != key] = self.never
        while len(todo):
            at[todo] += 1
            found = self.keys[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out

    def merge_long(self, ids: list[int]) -> list[int]:
        """Merges of one fragment with a heap over a linked list: n log n."""
        rank, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, *pair) for i, pair in enumerate(zip(ids, ids[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has changed meanwhile
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    pair = (ids[left], ids[after[left]])
                    if (r := rank(pair)) is not None:
                        heapq.heappush(heap, (r, left, *pair))
        return [i for i in ids if i >= 0]

    def merge(self, ids: np.ndarray) -> np.ndarray:
        """Merges of many fragments of one length, a row each: the lowest-ranked
        adjacent pair is joined, the leftmost first, until none is left. What
        a row no longer needs is -1 at its end."""
        out = np.full(ids.shape, -1, np.int64)
        row = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while ids.shape[1] > 1 and len(ids):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ids)), at]
            go = best < self.never
            out[row[~go], : ids.shape[1]] = ids[~go]
            row, at, best, ids, ranks = row[go], at[go], best[go], ids[go], ranks[go]
            each, width = np.arange(len(ids)), ids.shape[1]
            moved = np.arange(width - 1) > at[:, None]
            ids[each, at] = self.made[best]
            ids = np.where(moved, ids[:, 1:], ids[:, :-1])
            ranks = np.where(moved[:, :-1], ranks[:, 1:], ranks[:, :-1])
            left, right = at > 0, at < width - 2
            ranks[each[left], at[left] - 1] = self.pair_ranks(ids[each[left], at[left] - 1], ids[each[left], at[left]])
            ranks[each[right], at[right]] = self.pair_ranks(ids[each[right], at[right]], ids[each[right], at[right] + 1])
        out[row, : ids.shape[1]] = ids
        return out

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all pieces one after the other, and how
        many each has. Pieces are cut between the bytes of every pair that no
        token holds, and the fragments are merged independently."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        b = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        bound = np.zeros(len(b) + 1, bool)
        bound[1:-1] = ~self.joined[b[:-1] << 8 | b[1:]]  # the certain cuts
        bound[np.cumsum(size)] = True
        bound[0] = True
        begin = np.flatnonzero(bound)
        length = np.diff(begin)
        begin = begin[:-1]
        ids = self.single[b]
        for n in np.unique(length[length > 1]).tolist():
            at = begin[length == n][:, None] + np.arange(n)
            if n <= SHORT:
                ids[at] = self.merge(ids[at])
            else:
                for place in at:
                    merged = self.merge_long(ids[place].tolist())
                    ids[place] = merged + [-1] * (n - len(merged))
        used = ids >= 0
        upto = np.concatenate([[0], np.cumsum(used)])
        ends = np.cumsum(size)
        return ids[used], upto[ends] - upto[ends - size]

    def learn(self, parts: set[str]) -> None:
        """Put the ids of all these parts into the cache."""
        new = []
        for part in parts:
            known = self.older.get(part)
            if part in self.special:
                self.parts[part] = np.array([self.special[part]], "<u4").tobytes()
            elif known is None:
                new.append(part)
            else:
                self.parts[part] = known
        pieces: list[bytes] = []
        upto = []
        for part in new:
            if (part[1:] if part[:1] == " " else part).isalpha():
                pieces.append(part.encode())
            else:
                pieces.extend([p.encode() for p in self.split.findall(part)])
            upto.append(len(pieces))
        if not pieces:
            return
        ids, counts = self.encode_pieces(pieces)
        blob = ids.astype("<u4").tobytes()
        ends = (4 * np.cumsum(counts)[np.array(upto) - 1]).tolist()
        self.parts.update(zip(new, [blob[i:j] for i, j in zip([0, *ends], ends)]))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            split = [self.cut_up(t) for t in texts[at : at + 256]]
            want = set().union(*split).difference(self.parts)
            if len(self.parts) + len(want) > CACHE // 2:
                self.older, self.parts = self.parts, {}
                want = set().union(*split)
            self.learn(want)
            out.extend([b"".join(map(self.parts.__getitem__, s)) for s in split])
            for part in [p for p in want if len(p) > 256]:  # long parts are not worth the room
                del self.parts[part]
        return out

    def cut_up(self, text: str) -> list[str]:
        """The parts of a text; special tokens are parts of their own."""
        if self.marks is not None and any(m in text for m in self.special):
            return [p for t in self.marks.split(text) for p in ([t] if t in self.special else self.cut_up(t))]
        if not text:
            return []
        if text[0] == " " or text[-1] == " " or ODD_SPACE.search(text):
            return PARTS.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids that ``encode`` gave, or of any others; bytes that
        are not UTF-8 become replacement characters."""
        i = np.frombuffer(ids, "<u4").astype(np.int64)
        i = i[i < len(self.size)]
        size = self.size[i]
        end = np.cumsum(size)
        at = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.begin[i] - (end - size), size)
        return self.pool[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def with_ids(docs: DataFrame, path: str | None = None, out: str = "ids", text: str = "text") -> DataFrame:
    """Add the ids of every whole text as binary (little-endian uint32).

    Null and empty texts have no ids. Rows are kept as they are, repeated ones
    too; an input column named like ``out`` is replaced. An empty table gives
    an empty table.
    """
    path = path or vocabulary_path()

    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for t in texts:
            yield pd.Series(c.encode_all([x or "" for x in t]), dtype=object)

    return docs.select(packed(docs), F.col(text).alias("text")).select("row", encode("text").alias("ids")).select(
        *unpacked(docs.columns, {out: F.col("ids")})
    )


def with_text(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the decoded text of every row's ids; null ids give an empty text."""
    path = path or vocabulary_path()

    @F.pandas_udf("string")
    def decode(blobs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path)
        for b in blobs:
            yield pd.Series([c.decode(x) if x else "" for x in b], dtype=object)

    return rows.select(packed(rows), F.col(ids).alias("ids")).select("row", decode("ids").alias("text")).select(
        *unpacked(rows.columns, {out: F.col("text")})
    )


def with_round_trip(
    docs: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded", text: str = "text"
) -> DataFrame:
    """``with_ids`` and then ``with_text`` on its ids, by one Python worker a
    task instead of two; nulls, repeated rows and clashes as there."""
    path = path or vocabulary_path()

    @F.pandas_udf("ids binary, text string")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for t in texts:
            blobs = c.encode_all([x or "" for x in t])
            yield pd.DataFrame({"ids": blobs, "text": [c.decode(b) if b else "" for b in blobs]}, dtype=object)

    return docs.select(packed(docs), F.col(text).alias("text")).select("row", both("text").alias("both")).select(
        *unpacked(docs.columns, {ids: F.col("both.ids"), out: F.col("both.text")})
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return with_round_trip(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def reference_digest(text: str | None, tokenizer) -> tuple[int, str, str]:
    """What the tokenizers library gives for one text (for tests)."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    blob = np.array(ids, "<u4").tobytes()
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(blob).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
