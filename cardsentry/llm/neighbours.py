"""Near-duplicate vectors by NN-descent.

1. Equal vectors of a label become one class; the rest works on classes.
2. Each class starts with a list of near ones from a few random splits of its
   label: sign patterns of random directions give leaves of about LEAF classes
   (larger ones are dealt further by hash), and leaves are compared within.
3. Every group that is compared gives its links too, as edges that span the
   components among its members, so no link found is lost when lists are cut.
   Links close into components after every round.
4. Lists are refined: every class has those that it lists and that list it
   compare with each other (a neighbours-of-neighbours join), and each keeps
   its K best in its component and its K best outside. So a list that is full
   of links goes on to what they have not reached. This repeats until two
   rounds in a row join no components. Classes that many others list are dealt
   over several groups of PIECE members, differently in each round.
5. The recall is audited: a bounded sample of queries, one half of them from
   small components, is compared with every vector, and the mean recall of each
   half counts. Links that the sample shows are added. Below the target, steps
   2 to 4 go on from new random splits, and after TRIES of them all vectors of
   a space are compared, block by block.
6. Links are counted within components, block by block. Only counts leave a
   block, no pairs.

Similarities are cosines in double precision throughout.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import key_hash, read
from cardsentry.llm.components import connected_components
from cardsentry.sources.storage import materialize

THRESHOLD = 0.98
K = 6
LEAF = 128
SPLITS = 4
PIECE = 64
BLOCK = 512
# Queries of each half of the audit, the recall it asks for, and how often it
# may ask for more before everything is compared.
AUDIT, TARGET, TRIES = 256, 0.97, 4
# Rounds of refinement at most, and how many without a new link end them.
ROUNDS, QUIET = 6, 2

log = logging.getLogger(__name__)


def groups_of(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of equal keys of rows that come sorted by them, one by one;
    memory holds a batch and a group."""
    held: list[pd.DataFrame] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        k = list(zip(*[b[c].tolist() for c in keys]))
        cuts = [i for i in range(1, len(k)) if k[i] != k[i - 1]]
        if held and k[0] != last:
            yield pd.concat(held, ignore_index=True)
            held = []
        for i, j in zip([0, *cuts], [*cuts, len(k)]):
            held.append(b.iloc[i:j])
            if j < len(k):
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
        last = k[-1]
    if held:
        yield pd.concat(held, ignore_index=True)


def units(vectors: pd.Series) -> np.ndarray:
    v = np.array(vectors.tolist(), np.float64)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, space, v) of the vectors that can be linked at all; a space is
    a label and a number of components."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = v.isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(ok, F.lit(False))).select(
        "vec_id", F.concat_ws(":", F.col("label").cast("string"), F.size(v).cast("string")).alias("space"), v.alias("v")
    )


def _joined(close: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """For each member of a group the place of one that stands for all members
    it reaches by close pairs and common components."""
    reach = close | (comp[:, None] == comp)
    label = np.arange(len(comp))
    while True:
        least = np.where(reach, label, len(comp)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _spanning(close: np.ndarray, comp: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of components that close pairs of a group join, as edges."""
    new = np.flatnonzero(comp != comp[root])
    _, once = np.unique(comp[new], return_index=True)
    new = new[once]
    return comp[new], comp[root[new]]


def _compare(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(id, other, sim): each row's ``k`` best of its own component in its
    group that beat ``least_in``, and the ``k`` best of others that beat
    ``least_out``. Rows without sim are links between components.

    ``rows`` holds the keys, id, comp, v and both limits; groups are of bounded
    size.
    """
    kind = dict(rows.dtypes)["id"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for g in groups_of(batches, keys):
            n = len(g)
            if n < 2:
                continue
            u, ids, comp = units(g["v"]), g["id"].to_numpy(), g["comp"].to_numpy()
            s = u @ u.T
            s[ids[:, None] == ids] = -2
            root = _joined(s >= THRESHOLD, comp)
            u, v = _spanning(s >= THRESHOLD, comp, root)
            held.append((u, v, np.full(len(u), np.nan)))
            own = root[:, None] == root
            top = min(k, n - 1)
            for use, limit in ((own, "least_in"), (~own, "least_out")):
                part = np.where(use, s, -2)
                at = np.argpartition(-part, top - 1, axis=1)[:, :top]
                sim = np.take_along_axis(part, at, axis=1)
                row, col_ = np.nonzero(sim > g[limit].to_numpy()[:, None])
                held.append((ids[row], ids[at[row, col_]], sim[row, col_]))
            size += sum(len(x[0]) for x in held[-3:])
            if size > 50_000:
                yield pd.DataFrame(dict(zip(("id", "other", "sim"), map(np.concatenate, zip(*held)))))
                held, size = [], 0
        if held:
            yield pd.DataFrame(dict(zip(("id", "other", "sim"), map(np.concatenate, zip(*held)))))

    out = dealt.mapInPandas(run, f"id {kind}, other {kind}, sim double")
    return out.withColumn("sim", F.nanvl("sim", F.lit(None).cast("double")))


def split_leaves(classes: DataFrame, seed: int, splits: int = SPLITS) -> DataFrame:
    """(split, space, leaf, part, id, comp, v, least_in, least_out): every class
    in one leaf per split. Leaves that are too large are dealt differently in
    each split."""
    sizes = classes.groupBy("space").agg(F.count("*").alias("n"))
    sized = classes.join(sizes, "space")

    def signs(v: pd.Series, n: pd.Series, split: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        widths = v.str.len().to_numpy()
        bits = np.ceil(np.log2(np.maximum(1, n.to_numpy() / LEAF))).astype(np.int64).clip(0, 62)
        for width, tree in {*zip(widths.tolist(), split.tolist())}:
            at = np.flatnonzero((widths == width) & (split.to_numpy() == tree))
            most = int(bits[at].max())
            if not most:
                continue
            ways = np.random.default_rng([seed, tree, width]).normal(size=(width, most))
            on = np.array(v.iloc[at].tolist(), np.float64) @ ways > 0
            use = np.arange(most) < bits[at][:, None]
            out[at] = ((on & use) << np.arange(most)).sum(axis=1)
        return pd.Series(out)

    signs_of = F.pandas_udf(signs, "bigint")
    each = sized.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    each = each.withColumn("leaf", signs_of("v", "n", "split")).drop("n")
    keys = ["split", "space", "leaf"]
    parts = each.groupBy(*keys).agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts"))
    each = each.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("id", "split", F.lit(seed)), F.col("parts")))
    limits = [F.lit(-2.0).alias(c) for c in ("least_in", "least_out")]
    return each.select(*keys, "part", "id", "comp", "v", *limits)


def _tagged(classes: DataFrame, component: DataFrame) -> DataFrame:
    """``classes`` with the component of each as comp."""
    return classes.join(component, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")


def _best(edges: DataFrame, component: DataFrame) -> DataFrame:
    """(id, other, sim, own): the K best of each id in its component, and the
    K best outside."""
    once = edges.groupBy("id", "other").agg(F.max("sim").alias("sim"))
    ends = component.select(F.col("id").alias("other"), F.col("component").alias("its"))
    once = once.join(component, "id", "left").join(ends, "other", "left")
    once = once.withColumn("own", F.coalesce("component", "id") == F.coalesce("its", "other")).drop("component", "its")
    order = Window.partitionBy("id", "own").orderBy(F.desc("sim"), "other")
    return once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= K).select("id", "other", "sim", "own")


def refine(graph: DataFrame, tagged: DataFrame, seed: int) -> DataFrame:
    """What one round finds: everyone who lists, or is listed by, the same
    class compares."""
    lists = graph.select(F.col("id").alias("u"), F.col("other").alias("id")).unionByName(
        graph.select(F.col("other").alias("u"), "id")
    )

    def limit(mine: Column, name: str) -> Column:
        full = F.count(F.when(mine, 1)) >= K
        return F.when(full, F.min(F.when(mine, F.col("sim")))).otherwise(F.lit(-2.0)).alias(name)

    least = graph.groupBy("id").agg(limit(F.col("own"), "least_in"), limit(~F.col("own"), "least_out"))
    crowd = lists.groupBy("u").agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    rows = lists.distinct().join(crowd, "u").withColumn("piece", F.pmod(F.xxhash64("id", "u", F.lit(seed)), F.col("pieces")))
    known = tagged.select("id", "comp", "v").join(least, "id", "left").fillna(-2.0, ["least_in", "least_out"])
    return _compare(rows.select("u", "piece", "id").join(known, "id"), ["u", "piece"], K)


def _close(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components that known ones and ``links`` (u, v) give."""
    if component is not None:
        links = links.unionByName(component.select(F.col("id").alias("u"), F.col("component").alias("v")))
    return connected_components(links)


def _links(found: DataFrame) -> DataFrame:
    return found.where("sim is null").select(F.col("id").alias("u"), F.col("other").alias("v"))


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` in blocks of about BLOCK of a group, which meet pairwise: i and
    j are the blocks that meet and mine the row's own."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(sizes, group)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("mine", "with")).withColumn("j", F.greatest("mine", "with")).drop("with", "blocks")
    keys = [group, "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def all_links(tagged: DataFrame) -> DataFrame:
    """(u, v): edges that span all components, every pair of a space compared."""
    kind = dict(tagged.dtypes)["id"]
    dealt = _blocks(tagged.select("space", "id", "comp", "v"), "space")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups_of(batches, ["space", "i", "j"]):
            u, comp = units(g["v"]), g["comp"].to_numpy()
            near = u @ u.T >= THRESHOLD
            yield pd.DataFrame(dict(zip(("u", "v"), _spanning(near, comp, _joined(near, comp)))))

    return dealt.mapInPandas(run, f"u {kind}, v {kind}")


def count_links(classes: DataFrame, component: DataFrame) -> DataFrame:
    """(id, n): for each class the vectors of other classes of its component
    that it links with. Blocks of a component meet pairwise."""
    dealt = _blocks(classes.join(component, "id").select("component", "id", "v", "copies"), "component")
    keys = ["component", "i", "j"]
    kind = dict(classes.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups_of(batches, keys):
            i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
            a = g if i == j else g[g["mine"] == i]
            b = g if i == j else g[g["mine"] == j]
            if not len(a) or not len(b):
                continue
            near = units(a["v"]) @ units(b["v"]).T >= THRESHOLD
            if i == j:
                np.fill_diagonal(near, False)
            yield pd.DataFrame({"id": a["id"].to_numpy(), "n": near @ b["copies"].to_numpy()})
            if i != j:
                yield pd.DataFrame({"id": b["id"].to_numpy(), "n": a["copies"].to_numpy() @ near})

    return dealt.mapInPandas(run, f"id {kind}, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def audit(tagged: DataFrame, turn: int) -> tuple[float | None, DataFrame]:
    """The mean recall of a sample of queries, and the links it misses (u, v).
    The recall is None if no query has a link: then there is nothing to measure.

    AUDIT queries come from components of at most K + 1 classes (also those
    that are alone) and AUDIT from larger ones, others in each turn. The recall
    of a query is the share of the classes it links with that are in its
    component; that of the worse half counts.
    """
    sizes = tagged.groupBy("comp").agg((F.count("*") <= K + 1).alias("small"))
    queries = tagged.join(sizes, "comp").select("id", "space", "v", "comp", "small")
    order = key_hash("audit", F.lit(turn), F.col("id"))
    halves = [queries.where(F.col("small") == x).orderBy(order).limit(AUDIT).toPandas() for x in (True, False)]
    sample = pd.concat([x for x in halves if len(x)] or halves, ignore_index=True)
    sent = tagged.sparkSession.sparkContext.broadcast({
        s: (g["id"].to_numpy(), units(g["v"]), g["comp"].to_numpy(), g["small"].to_numpy(bool)) for s, g in sample.groupby("space")
    })
    kind = dict(tagged.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for space, g in b.groupby("space"):
                if space not in sent.value:
                    continue
                ids, u, mine, small = sent.value[space]
                near = units(g["v"]) @ u.T >= THRESHOLD
                near &= g["id"].to_numpy()[:, None] != ids
                row, at = np.nonzero(near)
                found = pd.DataFrame({"id": ids[at], "u": mine[at], "v": g["comp"].to_numpy()[row], "small": small[at], "n": 1})
                yield found.groupby(["id", "u", "v", "small"], as_index=False)["n"].sum()

    true = tagged.mapInPandas(run, f"id {kind}, u {kind}, v {kind}, small boolean, n bigint")
    true = materialize(true, "vector-audit")
    each = true.groupBy("id", "small").agg((F.sum(F.when(F.col("u") == F.col("v"), F.col("n")).otherwise(0)) / F.sum("n")).alias("recall"))
    means = [r["recall"] for r in each.groupBy("small").agg(F.avg("recall").alias("recall")).collect()]
    return min(means, default=None), true.where("u <> v").select("u", "v").distinct()


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``vectors``.

    ``vectors`` needs vec_id, embedding and label; other columns are ignored.
    n_links is the number of other vectors linked directly, component_id the
    smallest vec_id that links reach. Vectors that are null, zero or hold null
    or non-finite components, and those without a label, link with nothing;
    so do rows without an id. Vectors of different lengths never link. Rows
    that repeat an id and its vector count as copies of each other. An empty
    table gives an empty table.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    good = usable(vectors.where("vec_id is not null"))
    grouped = good.groupBy("space", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes = materialize(grouped, "vector-classes")
    component, graph = None, None
    for turn in range(TRIES):
        tagged = classes.withColumn("comp", F.col("id")) if component is None else _tagged(classes, component)
        found = _compare(split_leaves(tagged, seed=turn), ["split", "space", "leaf", "part"], K)
        quiet = 0
        for round_ in range(ROUNDS + 1):
            found = materialize(found, "vector-found")
            links = _links(found)
            quiet = quiet + 1 if links.isEmpty() else 0
            if component is None or not quiet:
                component = _close(component, links)
            edges = found.where("sim is not null")
            if graph is not None:
                edges = edges.unionByName(graph.drop("own"))
            graph = materialize(_best(edges, component), "vector-graph")
            if round_ == ROUNDS or round_ and quiet >= QUIET:
                break
            found = refine(graph, _tagged(classes, component), turn * ROUNDS + round_)
        recall, missed = audit(_tagged(classes, component), turn)
        if recall is None:
            log.info("turn %d: recall not measured, no query of the audit has a link", turn)
        else:
            log.info("turn %d: mean recall %.4f of the audit's worse half", turn, recall)
        if not missed.isEmpty():
            component = _close(component, missed)
        if recall is None or recall >= TARGET:
            break
    else:
        log.warning("mean recall below %.2f after %d turns: comparing all vectors", TARGET, TRIES)
        component = _close(component, all_links(_tagged(classes, component)))
    counts = materialize(count_links(classes, component), "vector-links")
    rows = good.select("vec_id", "space", "v").join(classes, ["space", "v"])
    rows = rows.join(component, "id", "left").join(counts, "id", "left")
    linked = rows.select(
        "vec_id",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    alone = vectors.join(good.select("vec_id").distinct(), "vec_id", "left_anti")
    alone = alone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, cosine 0.98 within a label."""
    out = near_vectors(read(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
