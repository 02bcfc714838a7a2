"""Toxicity from subword-bag embeddings under a linear softmax.

A word is the bag of its character n-grams (with end marks), each hashed to a
row of an embedding table. The distinct words of a text, in the order they
first occur, make stretches of STRETCH words; the last is filled up with
blanks. A stretch is the average of the n-gram vectors of its words, and a
linear softmax over that average gives its probability. Misspelt words share
most n-grams with the words they come from. A document's score is that of its
most toxic stretch, so a few words are not averaged away in a long text and
repetition does not count; all of the text is read.

Table and softmax are trained jointly in numpy, by Adam, on a bounded sample
of labelled rows. Labels are per document: a toxic document is trained
through its stretch that scores highest so far, a clean one through the same.

Scoring is linear in the embeddings, so a word needs two numbers: the sum of
its n-grams' logits and how many there are. Workers keep them by word and
hash the new words of a batch together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import read
from cardsentry.llm.sampling import bounded_sample, fold
from cardsentry.llm.textwords import BASE, INVERSE, U, _mixed, _table

# Bound of the training sample: rows per label.
SAMPLE = 2500
BUCKETS_LOG = 17
SIZE = 8
GRAMS = (3, 4, 5)
STRETCH = 16
ROUNDS = 4
# Steps of gradient descent, and where the softmax starts from.
TABLE_RATE, WEIGHT_RATE, BIAS_RATE = 0.01, 0.01, 0.005
START_WEIGHT, START_BIAS = 30.0, 3.0
CACHE = 500_000
# n-grams that one missing word of a stretch counts as; they have the last bucket.
BLANK = 16
BUCKETS = (1 << BUCKETS_LOG) + 1

WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The distinct words of a text, in lower case."""
    return list(dict.fromkeys(WORDS.findall(text.lower()))) if text else []


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of every word; the whole word is one
    of its n-grams."""
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(size) - size
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mixed(codes.astype(np.uint64) + U(1)) * _table(BASE, len(codes)), out=sums[1:])
    back = _table(INVERSE, len(codes))
    found, owner = [], []
    of = np.repeat(np.arange(len(words)), size)
    end = (begin + size)[of]
    place = np.arange(len(codes))
    for n in (*GRAMS, 0):
        at = place[place + n <= end] if n else begin
        upto = at + n if n else begin + size
        h = _mixed((sums[upto] - sums[at]) * back[at] + U(n))
        found.append((h >> U(64 - BUCKETS_LOG)).astype(np.int64))
        owner.append(of[at])
    owner = np.concatenate(owner)
    by = np.argsort(owner, kind="stable")
    return np.concatenate(found)[by], np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    """n-gram embeddings (buckets x size), softmax weights (size x 2), bias (2)."""

    table: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def logits(self) -> np.ndarray:
        """What each n-gram adds to the log odds of the toxic class."""
        return (self.table @ (self.weight[:, 1] - self.weight[:, 0])).astype(np.float64)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


class Scorer:
    """Scores of texts under the n-gram logits of a model."""

    def __init__(self, logits: np.ndarray, offset: float):
        self.logits, self.offset = logits.astype(np.float64), offset
        # word -> (sum of logits, number of n-grams) as a complex number
        self.known: dict[str, complex] = {}

    def learn(self, words: list[str]) -> None:
        buckets, counts = grams_of(words)
        sums = np.add.reduceat(self.logits[buckets], np.cumsum(counts) - counts)
        self.known.update(zip(words, (sums + 1j * counts).tolist()))

    def stretches(self, words: list[str]) -> np.ndarray:
        """Log odds of each stretch of a text's distinct words, which are known."""
        blank = BLANK * (self.logits[-1] + 1j)
        values = np.array([self.known[w] for w in words] + [blank] * (-len(words) % STRETCH or STRETCH * (not words)))
        total = values.reshape(-1, STRETCH).sum(axis=1)
        return total.real / total.imag + self.offset

    def score_all(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = set().union(*split)
        if new:
            self.learn(sorted(new))
        odds = np.array([self.stretches(w).max() for w in split])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def train(rows: list[tuple[int, str]], rounds: int = ROUNDS, seed: int = 7) -> Model:
    """Fit table and softmax on (label, text) rows. No rows, or one label only,
    gives a model that answers with the bias."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32),
        rng.normal(0, 0.1, (SIZE, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    )
    labels = np.array([int(y) for y, _ in rows])
    if len(set(labels.tolist())) < 2:
        model.weight[:] = 0
        model.bias[:] = (5, -5) if not labels.any() else (-5, 5)
        return model
    # every distinct word once with its n-grams; stretches as word numbers
    split = [words_of(text) for _, text in rows]
    every = sorted(set().union(*split))
    number = {w: i for i, w in enumerate(every)}
    grams, counts = grams_of(every) if every else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    grams = grams.astype(np.int32)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    words = np.fromiter((number[w] for part in split for w in part), np.int32)
    lengths = [min(STRETCH, len(w) - i) for w in split for i in range(0, max(1, len(w)), STRETCH)]
    owner = np.array([r for r, w in enumerate(split) for _ in range(0, max(1, len(w)), STRETCH)])
    begin = np.concatenate([[0], np.cumsum(lengths)])
    blanks = BLANK * (STRETCH - np.array(lengths))
    head = np.flatnonzero(np.diff(owner, prepend=-1))
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum()) * len(labels)

    def part_sums(of_words: np.ndarray, of_blank: float) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(of_words[words])])
        return sums[begin[1:]] - sums[begin[:-1]] + blanks * of_blank

    size = part_sums(counts, 1)
    part_grams = lambda k: np.concatenate(
        [grams[bounds[w] : bounds[w + 1]] for w in words[begin[k] : begin[k + 1]]] + [np.full(blanks[k], BUCKETS - 1, np.int32)]
    )

    # a first guess of the toxic stretch: n-grams that more toxic rows have
    on, off = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for y, part in zip(labels, split):
        if part:
            own = np.concatenate([grams[bounds[k] : bounds[k + 1]] for k in (number[w] for w in part)])
            (on if y else off)[np.unique(own)] += 1
    # rare n-grams say little: a few rows are added to both sides
    odds = np.log((on + 3) / (labels.sum() + 6)) - np.log((off * labels.sum() / (1 - labels).sum() + 3) / (labels.sum() + 6))
    odds[-1] = 0
    # warm start: the first guess is one direction of the table, which the
    # softmax reads out; training then moves table, weights and bias together
    model.table *= 0.1
    model.table[:, 0] = odds
    model.weight[0] = (-START_WEIGHT, START_WEIGHT)
    model.bias[:] = (START_BIAS, -START_BIAS)
    for turn in range(rounds):
        by_gram = np.concatenate([[0.0], np.cumsum(odds[grams])])
        mean = part_sums(by_gram[bounds[1:]] - by_gram[bounds[:-1]], odds[-1]) / size
        # the stretch of each row that scores highest
        best = np.lexsort((-mean, owner))[head]
        pace = 1 - turn / rounds
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 16)):
            each = [part_grams(k) for k in best[part]]
            n = np.array([len(x) for x in each])
            g, of = np.concatenate(each), np.repeat(np.arange(len(part)), n)
            vectors = np.add.reduceat(model.table[g], np.cumsum(n) - n) / n[:, None]
            z = vectors @ model.weight + model.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            p *= share[part][:, None]
            back = p @ model.weight.T / n[:, None]
            np.subtract.at(model.table, g, (pace * TABLE_RATE * back)[of].astype(np.float32))
            model.weight -= pace * WEIGHT_RATE * vectors.T @ p
            model.bias -= pace * BIAS_RATE * p.sum(axis=0)
        odds = model.logits()
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns
    are ignored. Training reads labelled rows outside the held-out fold, at
    most SAMPLE per label. A null or empty text gets the score of an empty
    bag. Null labels are no labels, repeated rows are scored each, and an
    empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold(F.col("doc_id"), folds) != held_out)
    known = known.join(docs.select("doc_id").hint("merge"), "doc_id", "left_semi")  # ids only
    model = train(bounded_sample(known, docs, "toxic", SAMPLE))
    # one number per bucket; the size is a parameter
    sent = docs.sparkSession.sparkContext.broadcast((model.logits().astype(np.float32), model.offset()))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        logits, offset = sent.value
        scorer = Scorer(logits, offset)
        for t in texts:
            rows = []
            for at in range(0, len(t), 512):
                rows.append(scorer.score_all(t.iloc[at : at + 512].tolist()))
            yield pd.Series(np.concatenate(rows) if rows else [], dtype=float)

    out = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from ``labels``."""
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
