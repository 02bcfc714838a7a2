"""A random forest trained on compact rows.

MLlib's trainer holds every row dense, one number a vector slot, and counts all
slots that a node has drawn: with one-hot slots its work is rows times slots. Here
a row is the bins of its numbers and the slots that are 1 in it (one a category
column at most). The method and its parameters are MLlib's: Poisson bags, a draw of
slots for each node, candidate thresholds from a sample of ``max(bins^2, 10000)``
rows, weighted Gini gain, least raw count of a child, leaves of one prediction
merged. The result is an MLlib model, read from the files that MLlib's writer makes.

Spark deals the rows in blocks. Each level of all trees is one pass: every block
moves its rows to the children, and sums class weights by tree, node and drawn bin
(or slot); the sums are shuffled by tree, and the best split of each node found
where they meet. The driver sees the nodes alone. Tasks draw bags and slots anew
from the seed, the tree and the block or level, so that a repeated task draws the same.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.sources.storage import materialize, new_location, write_table

# Rows of a block: a task holds some 300 bytes of each (100 trees).
BLOCK = 1 << 17
# Flags by which a row's slots are looked up among those that its node has drawn; a power of 2.
LOOKUP = 1 << 22
EPSILON = 2.0**-52
# Cumulative odds of a Poisson number of mean 1, in 2^32ths.
_POISSON = (np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 13)])) * 2.0**32).astype(np.uint64)
_POISSON = _POISSON[_POISSON < 2**32].astype(np.uint32)

# Tasks carry this module's code: executors need no copy of the package to train.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCKS = "block bigint, bins binary, slots binary, label binary, weight binary"
_STATE = f"{_BLOCKS}, places array<binary>, sums array<binary>"
_STATE_ARROW = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("bins", "slots", "label", "weight")],
                          ("places", pa.list_(pa.binary())), ("sums", pa.list_(pa.binary()))])


@dataclass
class Shape:
    """What the tasks know of the forest to be trained."""

    bins: np.ndarray  # bins of each numeric slot; these are the first of the vector
    width: int  # slots of the vector
    drawn: int  # slots that a node draws
    classes: int
    trees: int
    depth: int
    least: int
    seed: int
    bootstrap: bool

    def node(self) -> np.dtype:
        """A node of the frontier with its best split; ``slot`` -1: a leaf. Places of
        the children are those in the next frontier, -1: a leaf."""
        return np.dtype([
            ("count", "i8"), ("impurity", "f8"), ("gain", "f8"), ("slot", "i4"), ("value", "i4"), ("active", "?"),
            ("left", "i4"), ("right", "i4"), ("left_count", "i8"), ("sums", "f8", (self.classes,)),
            ("left_sums", "f8", (self.classes,)),
        ])


# ------------------------------------------------------------------ draws


def bag(shape: Shape, tree: int, block: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a block that are in a tree's bag, and how often each."""
    if not shape.bootstrap:
        return np.arange(n), np.ones(n)
    drawn = np.random.default_rng([shape.seed, tree, 0, block]).integers(0, 2**32, n, dtype=np.uint32)
    rows = np.flatnonzero(drawn >= _POISSON[0])
    drawn = drawn[rows]
    times = np.ones(len(rows), np.int8)
    for odds in _POISSON[1:]:
        times += drawn >= odds
    return rows, times.astype(np.float64)


def draw(shape: Shape, tree: int, level: int, nodes: int) -> np.ndarray:
    """The slots that each node of a tree's frontier draws, in order."""
    rng = np.random.default_rng([shape.seed, tree, 1, level])
    return np.sort([rng.choice(shape.width, shape.drawn, replace=False) for _ in range(nodes)]).astype(np.int32)


class Places:
    """Where the sums of the drawn slots' bins lie: one place for a slot of a category
    (the rows that have it; the others follow from the node's own sums, which lie
    behind all bins)."""

    def __init__(self, shape: Shape, slots: np.ndarray):
        self.slots, self.stride = slots, shape.width + 1
        self.numeric = slots < len(shape.bins)
        size = np.ones(slots.shape, np.int64)
        size[self.numeric] = shape.bins[slots[self.numeric]]
        self.at = (np.cumsum(size) - size.ravel()).reshape(size.shape)
        self.total = int(size.sum())
        self.numbers = self.numeric.sum(axis=1)
        node, k = np.nonzero(~self.numeric)
        self.keys, self.of_keys = node * self.stride + slots[node, k], self.at[node, k]  # in order


# ------------------------------------------------------------------ sums of a block


def children(nodes: np.ndarray, numbers: int, column: np.ndarray, values: np.ndarray, rows: np.ndarray,
             place: np.ndarray) -> np.ndarray:
    """The place of each row in the next frontier, -1 in a leaf.

    ``nodes``: the frontier; ``numbers``: numeric slots; ``values``: columns by rows;
    ``column``: that of every slot; ``place``: the node of each row, none a leaf."""
    slot, n = nodes["slot"], values.shape[1]
    number = slot < numbers
    # a row goes one way if its value is a number up to the threshold, or the slot itself
    low = np.where(number, 0, slot).astype(np.uint32)
    span = np.where(number, nodes["value"], 0).astype(np.uint32)
    swap = ~number & ~nodes["active"]
    to = np.stack([np.where(swap, nodes["left"], nodes["right"]), np.where(swap, nodes["right"], nodes["left"])], axis=1)
    to[slot < 0] = -1
    value = values.ravel().take((column[slot] * n).take(place) + rows).view(np.uint32)
    return to.ravel().take(2 * place + (value - low.take(place) <= span.take(place))).astype(np.int64)


def block_sums(shape: Shape, drawn: Places, flags: np.ndarray, values: np.ndarray, label: np.ndarray,
               weight: np.ndarray, rows: np.ndarray, times: np.ndarray, place: np.ndarray) -> bytes:
    """Counts and class weights of a tree's rows by place, without places that have none.
    ``flags``: LOOKUP flags, all off."""
    where, which, flat, n = [], [], values.ravel(), values.shape[1]
    some, k = np.flatnonzero(drawn.numbers.take(place) > 0), 0
    while len(some):  # the k-th number that each node has drawn: numbers come first
        node = place.take(some)
        begin = drawn.slots[:, k].astype(np.int64) * n
        where.append(drawn.at[:, k].take(node) + flat.take(begin.take(node) + rows.take(some)))
        which.append(some)
        k += 1
        some = some[drawn.numbers.take(node) > k] if k < drawn.slots.shape[1] else some[:0]
    base, mask = place * drawn.stride, len(flags) - 1
    flags[drawn.keys & mask] = True
    for own in values[len(shape.bins):]:
        key = base + own.take(rows)  # of slot -1: one that no node has
        some = np.flatnonzero(flags.take(key & mask))
        key = key.take(some)
        found = drawn.keys.searchsorted(key)
        found[found == len(drawn.keys)] = 0  # nothing is found if nothing is drawn: no flag is on
        same = drawn.keys.take(found) == key
        where.append(drawn.of_keys.take(found[same]))
        which.append(some[same])
    flags[drawn.keys & mask] = False
    where, which = np.concatenate(where), np.concatenate(which)
    each, of, k = times * weight.take(rows), label.take(rows), shape.classes
    count = [np.bincount(where, times.take(which), drawn.total), np.bincount(place, times, len(drawn.slots))]
    sums = [np.bincount(where * k + of.take(which), each.take(which), drawn.total * k),
            np.bincount(place * k + of, each, len(drawn.slots) * k)]
    count, sums = np.concatenate(count), np.concatenate(sums).reshape(-1, k)
    at = np.flatnonzero(count)
    return at.astype("<i4").tobytes() + count[at].astype("<i4").tobytes() + sums[at].astype("<f8").tobytes()


def _sum_level(shape: Shape, level: int, sent) -> Callable:
    """Task: rows moved to the children that the nodes of ``sent`` give them, and summed."""
    kind = np.dtype(np.int16 if shape.depth < 15 else np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, before, sizes = sent.value
        slots: dict[int, np.ndarray] = {}
        flags = np.zeros(LOOKUP, bool)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                label = np.frombuffer(row["label"], "<i2").astype(np.int64)
                weight = np.frombuffer(row["weight"], "<f8")
                values = np.frombuffer(row["bins"], "<u2").reshape(-1, len(label)).astype(np.int32)
                values = np.concatenate([values, np.frombuffer(row["slots"], "<i4").reshape(-1, len(label))])
                places, sums = [], []
                for tree, size in enumerate(sizes):
                    if not size:  # grown up
                        places.append(None)
                        sums.append(None)
                        continue
                    rows, times = bag(shape, tree, row["block"], len(label))
                    if level:
                        place = np.frombuffer(row["places"][tree], kind).astype(np.int64)
                        live = np.flatnonzero(place >= 0)
                        place[live] = children(before[tree], len(shape.bins), column, values, rows[live],
                                               place[live])
                    else:
                        place = np.zeros(len(rows), np.int64)
                    live = np.flatnonzero(place >= 0)
                    if tree not in slots:
                        slots[tree] = draw(shape, tree, level, size)
                    places.append(place.astype(kind).tobytes())
                    sums.append(block_sums(shape, Places(shape, slots[tree]), flags, values, label, weight, rows[live],
                                           times[live], place[live]))
                out = {c: [row[c]] for c in ("block", "bins", "slots", "label", "weight")}
                yield pa.RecordBatch.from_pydict(out | {"places": [places], "sums": [sums]}, schema=_STATE_ARROW)

    return run


# ------------------------------------------------------------------ best splits


def gini(sums: np.ndarray) -> np.ndarray:
    total = sums.sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(total > 0, 1 - ((sums / total[..., None]) ** 2).sum(axis=-1), 0.0)


def gains(shape: Shape, node_sums, node_count, node_impurity, sums, count) -> np.ndarray:
    """Of splits into ``sums`` and the rest of the node; -inf if a side has too few rows."""
    rest, total = np.maximum(node_sums - sums, 0), node_sums.sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(total > 0, sums.sum(axis=-1) / total, 0.0)
    gain = node_impurity - part * gini(sums) - (1 - part) * gini(rest)
    few = (count < shape.least) | (node_count - count < shape.least)
    return np.where(few, -np.inf, gain)


def best_splits(shape: Shape, tree: int, level: int, size: int, parts: list[bytes]) -> np.ndarray:
    """The nodes of a tree's frontier with their best splits, from the sums of all blocks."""
    drawn, k = Places(shape, draw(shape, tree, level, size)), shape.classes
    n = drawn.total + size
    count, sums = np.zeros(n, np.int64), np.zeros((n, k))
    for part in parts:
        m = len(part) // (8 + 8 * k)
        at = np.frombuffer(part, "<i4", m)
        count[at] += np.frombuffer(part, "<i4", m, 4 * m)
        sums[at] += np.frombuffer(part, "<f8", k * m, 8 * m).reshape(m, k)
    out = np.zeros(size, shape.node())
    out["count"], out["sums"] = count[drawn.total:], sums[drawn.total:]
    out["impurity"] = gini(out["sums"])
    out["slot"], out["left"], out["right"] = -1, -1, -1
    if level == shape.depth:
        return out
    gain = np.full(drawn.slots.shape, -np.inf)
    value = np.zeros(drawn.slots.shape, np.int64)
    nodes, j = np.nonzero(~drawn.numeric)
    at = drawn.at[nodes, j]
    gain[nodes, j] = gains(shape, out["sums"][nodes], out["count"][nodes], out["impurity"][nodes], sums[at], count[at])
    for c in range(int(drawn.numbers.max(initial=0))):
        nodes = np.flatnonzero(drawn.numbers > c)
        bins = shape.bins[drawn.slots[nodes, c]]
        most = int(bins.max())
        at = drawn.at[nodes, c][:, None] + np.minimum(np.arange(most), bins[:, None] - 1)
        real = np.arange(most) < bins[:, None]
        below, under = np.cumsum(sums[at] * real[..., None], axis=1), np.cumsum(count[at] * real, axis=1)
        own = out[nodes]
        found = gains(shape, own["sums"][:, None], own["count"][:, None], own["impurity"][:, None], below, under)
        found[np.arange(most) >= bins[:, None] - 1] = -np.inf  # the last bin has no threshold
        value[nodes, c] = found.argmax(axis=1)
        gain[nodes, c] = found.max(axis=1)
    pick = gain.argmax(axis=1)
    every = np.arange(size)
    out["gain"] = gain[every, pick]
    split = np.flatnonzero(out["gain"] > 0)
    slot, at = drawn.slots[split, pick[split]], drawn.at[split, pick[split]]
    number = drawn.numeric[split, pick[split]]
    out["slot"][split], out["value"][split] = slot, value[split, pick[split]]
    left_sums, left_count = sums[at].copy(), count[at].copy()
    for i in np.flatnonzero(number):
        up = at[i] + out["value"][split[i]] + 1
        left_sums[i], left_count[i] = sums[at[i]:up].sum(axis=0), count[at[i]:up].sum()
    # of the two values of a category's slot, the one with less of the second class goes left
    rest_sums, second = np.maximum(out["sums"][split] - left_sums, 0), min(1, k - 1)
    active = ~number & (left_sums[:, second] < rest_sums[:, second])
    swap = ~number & ~active
    left_sums[swap], left_count[swap] = rest_sums[swap], out["count"][split[swap]] - left_count[swap]
    out["active"][split], out["left_sums"][split], out["left_count"][split] = active, left_sums, left_count
    if level + 1 < shape.depth:
        rest_sums = np.maximum(out["sums"][split] - left_sums, 0)
        grows = np.stack([gini(left_sums), gini(rest_sums)], axis=1) >= EPSILON
        to = np.where(grows, np.cumsum(grows).reshape(grows.shape) - 1, -1)
        out["left"][split], out["right"][split] = to[:, 0], to[:, 1]
    return out


def _split_level(shape: Shape, level: int, sent) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        parts = list(pdf.sort_values("block")["part"])  # sums of one order in every run
        nodes = best_splits(shape, tree, level, sent.value[2][tree], parts)
        return pd.DataFrame({"tree": [tree], "nodes": [nodes.tobytes()]})

    return run


# ------------------------------------------------------------------ training


def thresholds(rows: DataFrame, numeric: list[str], n: int, total_weight: float, max_bins: int,
               seed: int) -> list[np.ndarray]:
    """MLlib's candidate thresholds of every number: middles between neighbouring values,
    of all values if they are few, else where about an equal weight of the sample lies between."""
    splits = min(max_bins, n) - 1
    fraction = min(1.0, max(max_bins**2, 10_000) / n)
    some = rows.sample(fraction=fraction, seed=seed) if fraction < 1 else rows
    seen = some.select("weight", F.posexplode(F.array(*numeric)).alias("slot", "value")).where("value <> 0")
    seen = seen.groupBy("slot", "value").agg(F.sum("weight").alias("weight")).toPandas()
    expected, out = fraction * total_weight, []
    for slot in range(len(numeric)):
        own = seen[seen["slot"] == slot]
        value, weight = own["value"].to_numpy(float), own["weight"].to_numpy(float)
        zeros = expected - weight.sum()
        if len(value) and zeros > EPSILON * n * 100:
            value, weight = np.append(value, 0.0), np.append(weight, zeros)
        order = np.argsort(value)
        value, weight = value[order], weight[order]
        middle = (value[:-1] + value[1:]) / 2
        if len(middle) <= splits:
            out.append(middle)
            continue
        stride = expected / (splits + 1)
        upto, target, chosen = np.cumsum(weight), stride, []
        for i in range(1, len(value)):
            if abs(upto[i - 1] - target) < abs(upto[i] - target):
                chosen.append(middle[i - 1])
                target += stride
        out.append(np.array(chosen))
    return out


def _pack(cuts: list[np.ndarray], numeric: list[str], slots: list[str]) -> Callable:
    """Task: the rows of a partition in blocks of BLOCK at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, waiting, n = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal made
            t = pa.Table.from_batches(waiting)
            bins = [np.searchsorted(cut, t[c].to_numpy()) for cut, c in zip(cuts, numeric)]
            row = {
                "block": part << 32 | made,
                "bins": np.stack(bins).astype("<u2").tobytes(),
                "slots": np.stack([t[c].to_numpy() for c in slots]).astype("<i4").tobytes(),
                "label": t["label"].to_numpy().astype("<i2").tobytes(),
                "weight": t["weight"].to_numpy().astype("<f8").tobytes(),
            }
            made += 1
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(list(_STATE_ARROW)[:5]))

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK - n)
                waiting.append(piece)
                n, at = n + piece.num_rows, at + piece.num_rows
                if n == BLOCK:
                    yield block()
                    waiting, n = [], 0
        if n:
            yield block()

    return run


def drawn_slots(strategy: str, width: int, trees: int) -> int:
    """How many slots a node draws, as MLlib's featureSubsetStrategy names it."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    named = {"all": width, "sqrt": np.ceil(np.sqrt(width)), "onethird": np.ceil(width / 3.0),
             "log2": max(1, np.ceil(np.log2(width)))}
    if strategy in named:
        return int(named[strategy])
    if strategy.isdigit() and int(strategy) > 0:
        return min(int(strategy), width)
    return int(np.ceil(float(strategy) * width))


def fit(rows: DataFrame, numbers: list[Column], slots: list[Column], sizes: list[int], label: str,
        trainer: RandomForestClassifier) -> RandomForestClassificationModel:
    """Train as ``trainer`` is set.

    ``numbers``: the first slots of the vector; ``slots``: for each category column,
    the slot that is 1 in a row, -1 if none is; ``sizes``: how many slots each of these
    columns has. Labels, weights and numbers that MLlib refuses are refused here."""
    if trainer.getMaxBins() > 1 << 16:
        raise ValueError("a bin is stored in two bytes")
    spark = rows.sparkSession
    numeric, coded = [f"n{j}" for j in range(len(numbers))], [f"s{j}" for j in range(len(slots))]
    y = F.col(label).cast("double")
    w = F.col(trainer.getWeightCol()).cast("double") if trainer.isSet("weightCol") else F.lit(1.0)
    finite = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))

    def sound(value: Column, good: Column, what: str) -> Column:
        return F.when(F.coalesce(good, F.lit(False)), value).otherwise(F.raise_error(F.lit(what)).cast("double"))

    compact = rows.select(
        *[sound(c, finite(c), "numbers of the forest must be finite").alias(a) for a, c in zip(numeric, numbers)],
        *[c.cast("int").alias(a) for a, c in zip(coded, slots)],
        sound(y, (y >= 0) & (y == F.floor(y)) & (y < 100), "labels must be whole numbers from 0 to 99").cast("int").alias("label"),
        sound(w, (w >= 0) & finite(w), "weights must not be negative").alias("weight"),
    )
    n, classes, total = compact.agg(F.count(F.lit(1)), F.max("label") + 1, F.sum("weight")).first()
    if not n:
        raise ValueError("no rows to train on")
    seed, trees = trainer.getSeed() % 2**64, trainer.getNumTrees()
    cuts = thresholds(compact, numeric, n, total, trainer.getMaxBins(), trainer.getSeed())
    parts = max(spark.sparkContext.defaultParallelism, -(-n // BLOCK))
    blocks = materialize(compact.repartition(parts).mapInArrow(_pack(cuts, numeric, coded), _BLOCKS), "forest-rows")
    width = len(numbers) + sum(sizes)
    column = np.concatenate([np.arange(len(numbers)), np.repeat(len(numbers) + np.arange(len(sizes)), sizes)])
    shape = Shape(np.array([len(c) + 1 for c in cuts]), width,
                  drawn_slots(trainer.getFeatureSubsetStrategy(), width, trees), classes, trees, trainer.getMaxDepth(),
                  trainer.getMinInstancesPerNode(), seed, trainer.getBootstrap())
    return read_model(spark, grow(blocks, shape, column), cuts, shape, trainer)


def grow(blocks: DataFrame, shape: Shape, column: np.ndarray) -> list[list[np.ndarray]]:
    """For every tree, the nodes of its levels."""
    spark = blocks.sparkSession
    homes = [new_location(spark, "forest-level") for _ in range(2)]  # a level takes the place of the last but one
    state = blocks.withColumn("places", F.lit(None).cast("array<binary>"))
    found: list[list[np.ndarray]] = [[] for _ in range(shape.trees)]
    sizes = [1] * shape.trees
    for level in range(shape.depth + 1):
        if not any(sizes):
            break
        sent = spark.sparkContext.broadcast((column, [t[-1] if t else None for t in found], sizes))
        write_table(state.drop("sums").mapInArrow(_sum_level(shape, level, sent), _STATE), homes[level % 2])
        state = spark.read.parquet(homes[level % 2])
        sums = state.select("block", F.posexplode("sums").alias("tree", "part")).where("part is not null")
        best = sums.groupBy("tree").applyInPandas(_split_level(shape, level, sent), "tree int, nodes binary").collect()
        sizes = [0] * shape.trees
        for tree, nodes in best:
            nodes = np.frombuffer(nodes, shape.node())
            found[tree].append(nodes)
            sizes[tree] = int((nodes["left"] >= 0).sum() + (nodes["right"] >= 0).sum())
        sent.destroy()
    return found


# ------------------------------------------------------------------ the model


def tree_rows(tree: int, levels: list[np.ndarray], cuts: list[np.ndarray]) -> list[tuple]:
    """A tree's nodes in preorder, as MLlib stores them. A split whose two leaves
    predict the same is a leaf."""
    out: list[tuple] = []

    def leaf(at: int, sums: np.ndarray, count: int) -> bool:
        out.append((tree, (at, float(sums.argmax()), float(gini(sums)), sums.tolist(), int(count), -1.0, -1, -1, (-1, [], -1))))
        return True

    def add(level: int, place: int) -> bool:
        """Adds the node and those below; whether it is a leaf."""
        own, at = levels[level][place], len(out)
        if own["slot"] < 0:
            return leaf(at, own["sums"], own["count"])
        out.append(())
        number = own["slot"] < len(cuts)
        kinds, begins = [], []
        for side, sums, count in (("left", own["left_sums"], own["left_count"]),
                                  ("right", np.maximum(own["sums"] - own["left_sums"], 0), own["count"] - own["left_count"])):
            begins.append(len(out))
            kinds.append(add(level + 1, own[side]) if own[side] >= 0 else leaf(len(out), sums, count))
        if all(kinds) and out[begins[0]][1][1] == out[begins[1]][1][1]:
            del out[at:]
            return leaf(at, own["sums"], own["count"])
        split = [float(cuts[own["slot"]][own["value"]])] if number else [float(own["active"])]
        out[at] = (tree, (at, float(own["sums"].argmax()), float(own["impurity"]), own["sums"].tolist(), int(own["count"]),
                          float(own["gain"]), *begins, (int(own["slot"]), split, -1 if number else 2)))
        return False

    add(0, 0)
    return out


def read_model(spark: SparkSession, found: list[list[np.ndarray]], cuts: list[np.ndarray], shape: Shape,
               trainer: RandomForestClassifier) -> RandomForestClassificationModel:
    """The MLlib model of these trees: written in the form of its writer, and loaded."""
    path = new_location(spark, "forest")
    name = "org.apache.spark.ml.classification"
    params = {p.name: v for p, v in trainer._paramMap.items()}
    defaults = {p.name: v for p, v in trainer._defaultParamMap.items()}
    of_trees = {"maxBins", "maxDepth", "minInstancesPerNode", "seed", "featuresCol", "labelCol", "weightCol"}

    def about(kind: str, uid: str, own: dict, default: dict, **more) -> str:
        return json.dumps({"class": f"{name}.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own, "defaultParamMap": default, **more})

    size = {"numFeatures": shape.width, "numClasses": shape.classes}
    whole = about("RandomForestClassificationModel", trainer.uid, params, defaults, **size, numTrees=shape.trees)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(t, about("DecisionTreeClassificationModel", f"{trainer.uid}_{t}", {k: v for k, v in params.items() if k in of_trees},
                      {}, **size), 1.0) for t in range(shape.trees)]
    write_table(spark.createDataFrame(each, "_1 int, _2 string, _3 double"), f"{path}/treesMetadata")
    nodes = [row for t, levels in enumerate(found) for row in tree_rows(t, levels, cuts)]
    split = "struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>"
    kind = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, "
            f"rawCount bigint, gain double, leftChild int, rightChild int, split {split}>")
    write_table(spark.createDataFrame(nodes, kind), f"{path}/data")
    return RandomForestClassificationModel.load(path)
