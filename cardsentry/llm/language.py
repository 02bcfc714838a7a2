"""Language identification with a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 bytes in stretches of STEPS bytes. Two gated recurrent
layers run over each stretch, one forward and one backward; a softmax over
both states labels every position. A document's probabilities are the mean
over all of its positions, so the whole text counts, at one cost per byte.

The network is trained in numpy by backpropagation through time, with Adam, on
a bounded sample of labelled rows. Prediction is map-only: a worker runs all
stretches of a batch in step, as matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm.common import key_hash, packed, read, unpacked
from cardsentry.llm.sampling import bounded_sample, fold

# Bound of the training sample: rows per language, and stretches of each row.
SAMPLE = 300
STRETCHES = 4
STEPS = 64
HIDDEN = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
# Stretches that run in step.
WIDE = 2048
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """Weights of both directions; gates stand in the order reset, update, new.

    ``inputs`` holds for each direction what a byte adds to the gates.
    """

    languages: list[str]
    inputs: list[np.ndarray] = field(default_factory=list)  # 2 of (3 * hidden, 256)
    states: list[np.ndarray] = field(default_factory=list)  # 2 of (3 * hidden, hidden)
    out: np.ndarray | None = None  # (languages, 2 * hidden)
    bias: np.ndarray | None = None  # (languages, 1)

    @staticmethod
    def fresh(languages: list[str], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return Network(
            languages,
            [draw(3 * HIDDEN, 256) for _ in range(2)],
            [draw(3 * HIDDEN, HIDDEN) for _ in range(2)],
            draw(len(languages), 2 * HIDDEN),
            np.zeros((len(languages), 1), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]


def _run(bytes_: np.ndarray, inputs: np.ndarray, states: np.ndarray, keep: bool):
    """States (steps, hidden, batch) of one direction over bytes (steps, batch);
    with ``keep``, also what its gates were."""
    steps, batch = bytes_.shape
    h = np.zeros((HIDDEN, batch), np.float32)
    out = np.empty((steps, HIDDEN, batch), np.float32)
    gates = []
    for t in range(steps):
        x = np.take(inputs, bytes_[t], axis=1)
        back = states @ h
        # both gates by one tanh
        rz = x[: 2 * HIDDEN] + back[: 2 * HIDDEN]
        rz *= 0.5
        np.tanh(rz, out=rz)
        rz *= 0.5
        rz += 0.5
        inner = back[2 * HIDDEN :]
        n = np.tanh(x[2 * HIDDEN :] + rz[:HIDDEN] * inner)
        if keep:
            gates.append((rz[:HIDDEN].copy(), rz[HIDDEN:].copy(), n, inner.copy(), h))
        h = n + rz[HIDDEN:] * (h - n)
        out[t] = h
    return out, gates


def position_probabilities(net: Network, bytes_: np.ndarray) -> np.ndarray:
    """(steps, languages, batch): the label distribution of every position."""
    ahead, _ = _run(bytes_, net.inputs[0], net.states[0], False)
    behind, _ = _run(bytes_[::-1], net.inputs[1], net.states[1], False)
    z = net.out[:, :HIDDEN] @ ahead + net.out[:, HIDDEN:] @ behind[::-1] + net.bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def gradients(net: Network, bytes_: np.ndarray, used: np.ndarray, labels: np.ndarray, weight: np.ndarray):
    """(loss, gradients in the order of ``parameters``) of the mean, over all
    used positions, of the cross entropy, by backpropagation through time."""
    steps, batch = bytes_.shape
    runs = [_run(b, net.inputs[d], net.states[d], True) for d, b in enumerate((bytes_, bytes_[::-1]))]
    h = np.concatenate([runs[0][0], runs[1][0][::-1]], axis=1)
    z = net.out @ h + net.bias
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    share = used * weight / max(1e-9, float((used * weight).sum()))
    loss = -float((np.log(p[:, labels, np.arange(batch)] + 1e-12) * share).sum())
    p[:, labels, np.arange(batch)] -= 1
    p *= share[:, None, :]
    d_out = np.einsum("tlb,thb->lh", p, h)
    d_h = np.einsum("lh,tlb->thb", net.out, p)
    grads: list[list[np.ndarray]] = [[], []]
    for d in range(2):
        seen = bytes_ if d == 0 else bytes_[::-1]
        came = d_h[:, :HIDDEN] if d == 0 else d_h[::-1, HIDDEN:]
        d_in, d_state = np.zeros_like(net.inputs[d]), np.zeros_like(net.states[d])
        back = np.zeros((HIDDEN, batch), np.float32)
        for t in range(steps - 1, -1, -1):
            r, u, n, inner, before = runs[d][1][t]
            back = back + came[t]
            d_n = back * (1 - u) * (1 - n * n)
            d_u = back * (before - n) * u * (1 - u)
            d_r = d_n * inner * r * (1 - r)
            d_x = np.concatenate([d_r, d_u, d_n])
            d_g = np.concatenate([d_r, d_u, d_n * r])
            d_state += d_g @ before.T
            np.add.at(d_in.T, seen[t], d_x.T)
            back = back * u + net.states[d].T @ d_g
        grads[0].append(d_in)
        grads[1].append(d_state)
    return loss, [*grads[0], *grads[1], d_out, p.sum(axis=(0, 2))[:, None]]


def stretches_of(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, used), both (steps, stretches), of bytes laid out in a row; the
    last stretch is filled up with spaces that do not count."""
    n = -(-len(blob) // STEPS)
    full = np.full(n * STEPS, 32, np.uint8)
    full[: len(blob)] = blob
    used = np.arange(n * STEPS) < len(blob)
    return full.reshape(n, STEPS).T, used.reshape(n, STEPS).T


def some_stretches(text: Column, doc_id: Column) -> Column:
    """STRETCHES of a text's stretches, chosen by hash of its id; all of fewer."""
    n = F.ceil(F.octet_length(text) / F.lit(STEPS)).cast("bigint")
    drawn = F.array_distinct(F.array(*[F.pmod(key_hash(f"stretch{k}", doc_id), n) for k in range(STRETCHES)]))
    at = F.when(n > STRETCHES, drawn).otherwise(F.sequence(F.lit(0).cast("bigint"), F.greatest(n, F.lit(1)) - 1))
    piece = lambda i: F.substr(text.cast("binary"), (i * STEPS + 1).cast("int"), F.lit(STEPS))
    return F.when(n > 0, F.transform(at, piece)).otherwise(F.array().cast("array<binary>"))


def train(rows: list[tuple[str, str | list[bytes]]], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit a network on (language, text) rows, or (language, stretches) as
    ``some_stretches`` gives them; every language weighs the same."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in rows})
    net = Network.fresh(languages or [UNKNOWN])
    parts, used, labels = [], [], []
    for lang, text in rows:
        pieces = [text.encode()] if isinstance(text, str) else text
        pieces = [stretches_of(np.frombuffer(p, np.uint8)) for p in pieces if p]
        if not pieces:
            continue
        b, u = (np.concatenate(x, axis=1) for x in zip(*pieces))
        for i in rng.permutation(b.shape[1])[:STRETCHES]:
            parts.append(b[:, i])
            used.append(u[:, i])
            labels.append(languages.index(lang))
    if len(languages) < 2 or not parts:
        return net
    bytes_, on, y = np.array(parts).T, np.array(used, np.float32).T, np.array(labels)
    weight = (len(y) / len(languages) / np.bincount(y, minlength=len(languages))[y]).astype(np.float32)
    parameters = net.parameters()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step, total = 0, epochs * -(-len(y) // BATCH)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
            _, grads = gradients(net, bytes_[:, part], on[:, part], y[part], weight[part])
            norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
            step += 1
            rate = RATE * (1 - 0.95 * step / total) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for value, grad, (m, v) in zip(parameters, grads, moments):
                grad = grad * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def document_probabilities(net: Network, texts: list[str | None]) -> np.ndarray:
    """(texts, languages): the mean over all positions of each text."""
    sums = np.zeros((len(texts), len(net.languages)))
    parts, owners, waiting = [], [], 0

    def flush() -> None:
        nonlocal parts, owners, waiting
        if not parts:
            return
        bytes_ = np.concatenate([p[0] for p in parts], axis=1)
        used = np.concatenate([p[1] for p in parts], axis=1)
        owner = np.repeat(owners, [p[0].shape[1] for p in parts])
        for at in range(0, bytes_.shape[1], WIDE):
            piece = slice(at, at + WIDE)
            p = position_probabilities(net, np.ascontiguousarray(bytes_[:, piece]))
            p *= used[:, None, piece]
            pooled = p.sum(axis=0, dtype=np.float64)
            for lang in range(len(net.languages)):
                sums[:, lang] += np.bincount(owner[piece], weights=pooled[lang], minlength=len(texts))
        parts, owners, waiting = [], [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        parts.append(stretches_of(np.frombuffer(text.encode(), np.uint8)))
        owners.append(i)
        waiting += parts[-1][0].shape[1]
        if waiting >= 8 * WIDE:
            flush()
    flush()
    return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)


def fit_languages(docs: DataFrame, held_out: int = 2, folds: int = 4) -> Network:
    """Train on rows with text and language outside the held-out fold: at most
    SAMPLE per language, 64 times that in all, and STRETCHES of each text."""
    known = docs.select("doc_id", "lang").where("lang is not null").where(fold(F.col("doc_id"), folds) != held_out)
    return train(bounded_sample(known, docs, "lang", SAMPLE, cut=some_stretches))


def with_language(docs: DataFrame, net: Network) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the pooled probability of that language.

    A text that is null or holds no letter is ``und`` with score 0; so is
    every text if nothing was learned. Ties go to the language first in order.
    Repeated rows are labelled each, input columns of these names are
    replaced, and an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)  # a few kilobytes, whatever the data

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for t in texts:
            known = [x if isinstance(x, str) and LETTER.search(x) else None for x in t]
            p = document_probabilities(model, known)
            best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
            found = np.array([x is not None for x in known], bool) & (model.languages != [UNKNOWN])
            names = np.array(model.languages, object)[best] if len(p) else best.astype(object)
            yield pd.DataFrame({
                "lang_pred": np.where(found, names, UNKNOWN),
                "score": np.where(found, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0),
            })

    rows = docs.select(packed(docs), label("text").alias("label"))
    return rows.select(*unpacked(docs.columns, {"lang_pred": F.col("label.lang_pred"), "score": F.col("label.score")}))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three folds of four."""
    docs = read(spark, sf_dir, "documents")
    net = fit_languages(docs)
    out = with_language(docs.select("doc_id", "text"), net)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
