"""Merkle manifest of a dataset: checkpoint a few levels, recompute the others.

Rows are leaves; the leaves of a group (here: a source) form a 16-ary tree, and
the roots of all groups form another one, whose root names the whole dataset.

1. Every row is hashed in Spark and numbered inside its tree: rows are dealt by
   range of (tree, order), sorted in their partitions, and the counts of the
   partitions before give the offset. No tree has to fit into one task.
2. Only every ``stride``-th level is stored. ``FAN ** stride`` consecutive stored
   nodes are an aligned subtree; one task rebuilds it, a subtree at a time, and
   keeps its top.
3. Proofs go from the root down. The missing nodes of each aligned subtree are
   computed again from its stored descendants, every descendant gets its
   siblings and the path of the subtree's top, and the nodes are dropped. A path
   is moved once for a whole subtree, never once for a leaf.

The number of steps is logarithmic in the rows; every step is written to the
shared folder, so a lost executor repeats a part of one step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import col, read
from cardsentry.sources.storage import materialize

FAN = 16
# Levels from one stored level to the next.
STRIDE = 3
HEX = 64
# Fixed values of the contract: what a leaf holds, and which rows are tampered with.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "at array<int>, others array<string>, roots array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its UTF-8 byte count in front; '-' for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def tree_name(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the row's number in its ``tree`` by ``order`` from
    0, and ``n``, the rows of the tree.

    Rows are read twice (the ranges are sampled), so they should be a written
    table. A tree may span any number of partitions.
    """
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    spread = materialize(spread.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    spread = spread.withColumn("part", F.shiftright("place", 33))
    runs = spread.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    before = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(tree).alias("n")
    )
    found = spread.join(materialize(runs, "merkle-runs"), ["tree", "part"])
    return found.withColumn("pos", F.col("place") - F.col("first") + F.col("before")).drop(
        "place", "part", "first", "before"
    )


def interior(nodes: list[str], top: bool, stride: int) -> list[list[str]]:
    """The levels above consecutive nodes of an aligned subtree, themselves
    first: up to a single node at the top of a tree, else ``stride`` levels."""
    levels = [nodes]
    while len(levels[-1]) > 1 if top else len(levels) <= stride:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]]) -> Iterator[tuple[list[int], list[str]]]:
    """For each node of the lowest level, upwards: its place in its run and the
    hashes of the run's others, joined."""
    runs = [["".join(level[i : i + FAN]) for i in range(0, len(level), FAN)] for level in levels[:-1]]
    for i in range(len(levels[0])):
        at, others = [], []
        for joined in runs:
            i, k = divmod(i, FAN)
            at.append(k)
            others.append(joined[i][: HEX * k] + joined[i][HEX * (k + 1) :])
        yield at, others


def fold(leaf: str, at: list[int], others: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for k, text in zip(at, others):
        leaf = digest(text[: HEX * k] + leaf + text[HEX * k :])
    return leaf


def _count(level: int, span: int) -> Column:
    """Nodes of a tree at stored level ``level``."""
    return F.ceil(F.col("n") / F.lit(span**level)).cast("bigint")


def _batches(rows: Iterator[tuple], columns: list[str], size: int = 4096) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def _raised(nodes: DataFrame, level: int, stride: int) -> DataFrame:
    """The tops (tree, pos, n, hash, top) of the aligned subtrees over ``nodes``
    of stored level ``level``; ``top`` marks the root of a tree."""
    span = FAN**stride
    rows = nodes.select("tree", F.expr(f"pos div {span}").alias("block"), "pos", "n", "hash")
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tops() -> Iterator[tuple]:
            every = (r for b in batches for r in zip(*(b[c].tolist() for c in b.columns)))
            for (tree, block), group in groupby(every, key=lambda r: r[:2]):
                group = list(group)  # a span of rows at most
                n = group[0][3]
                top = -(-n // span**level) <= span
                yield tree, block, n, interior([r[4] for r in group], top, stride)[-1][0], top

        yield from _batches(tops(), ["tree", "pos", "n", "hash", "top"])

    return rows.mapInPandas(run, "tree string, pos bigint, n bigint, hash string, top boolean")


@dataclass(frozen=True)
class Stored:
    """Checkpointed levels 0, stride, 2 * stride, ... as (tree, pos, n, hash),
    the lowest with the columns that the leaves carry, and the roots of all
    trees as (tree, n, hash)."""

    levels: list[DataFrame]
    roots: DataFrame
    stride: int


def store(leaves: DataFrame, stride: int) -> Stored:
    """Build the trees over ``leaves`` (tree, pos, n, hash, ...)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, roots = [leaves], []
    while True:
        made = materialize(_raised(levels[-1], len(levels) - 1, stride), "merkle-level")
        roots.append(made.where("top").select("tree", "n", "hash"))
        if most <= FAN ** (stride * len(levels)):
            return Stored(levels, reduce(DataFrame.unionByName, roots), stride)
        levels.append(made.where("not top").drop("top"))


def _opened(stored: Stored, level: int, paths: DataFrame, carry: list[str], end: Callable, out: str) -> DataFrame:
    """``end(row, at, others, roots)`` of every node of stored level ``level``.

    ``paths`` holds one row (tree, block, at, others, roots) for each aligned
    subtree: the path of its top. It is sorted before the subtree's nodes.
    """
    stride, span = stored.stride, FAN**stored.stride
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (p.split(" ") for p in PATH.split(", "))]
    rows = stored.levels[level].select("tree", F.expr(f"pos div {span}").alias("block"), "pos", "n", "hash", *carry, *nothing)
    heads = paths.select(
        "tree", "block", F.lit(-1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("string").alias("hash"), *[F.lit(None).cast("string").alias(c) for c in carry],
        "at", "others", "roots",
    )
    rows = rows.unionByName(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    names = [c.split(" ", 1)[0] for c in out.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ends() -> Iterator[tuple]:
            every = (r for b in batches for r in zip(*(b[c].tolist() for c in b.columns)))
            for _, group in groupby(every, key=lambda r: r[:2]):
                head = next(group)
                assert head[2] == -1, "the path comes before its nodes"
                at, others, roots = map(list, head[-3:])
                nodes = list(group)
                top = -(-nodes[0][3] // span**level) <= span
                for row, (own_at, own) in zip(nodes, siblings(interior([r[4] for r in nodes], top, stride))):
                    yield end(row[:-3], own_at + at, own + others, roots)

        yield from _batches(ends(), names, 1024)

    return rows.mapInPandas(run, out)


def descend(stored: Stored, paths: DataFrame, carry: list[str], end: Callable, out: str) -> DataFrame:
    """``end((tree, block, pos, n, hash, *carry), at, others, roots)`` of every
    leaf; ``out`` is the schema of what it returns. The columns in ``carry``
    must be strings.

    ``paths`` holds (tree, n, at, others, roots): where the root of each tree
    goes on to, upwards.
    """
    path_row = "tree string, block bigint, " + PATH
    emitted, span = None, FAN**stored.stride
    for level in range(len(stored.levels) - 1, -1, -1):
        begins = _count(level, span) <= span
        if level:
            begins &= _count(level - 1, span) > span
        heads = paths.where(begins).select("tree", F.lit(0).cast("bigint").alias("block"), "at", "others", "roots")
        heads = heads if emitted is None else heads.unionByName(emitted)
        if level:
            step = _opened(stored, level, heads, [], lambda r, *path: (r[0], r[2], *path), path_row)
            emitted = materialize(step, "merkle-paths")
    return _opened(stored, 0, heads, carry, end, out)


@dataclass(frozen=True)
class Manifest:
    """The stored trees of the groups and the one of their roots."""

    groups: Stored
    total: Stored

    def paths(self) -> DataFrame:
        """(tree, n, at, others, roots) of every group: the path from its root
        to the root of all; ``roots`` holds both, the group's first."""
        start = self.total.roots.select(
            "tree", "n", F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("others"),
            F.array("hash").alias("roots"),
        )
        found = descend(
            self.total, start, ["name", "size"],
            lambda r, at, others, roots: (r[5], int(r[6]), at, others, [r[4], *roots]),
            "tree string, n bigint, " + PATH,
        )
        return materialize(found, "merkle-paths")

    def proofs(self, carry: list[str] = ()) -> DataFrame:
        """(tree, pos, leaf, at, others, roots, *carry) of every leaf: the
        siblings, joined level by level, and the leaf's place among them."""
        out = "tree string, pos bigint, leaf string, " + PATH + "".join(f", {c} string" for c in carry)
        return descend(
            self.groups, self.paths(), list(carry), lambda r, *path: (r[0], r[2], r[4], *path, *r[5:]), out
        )

    def audit(self, carry: list[str], instead: str) -> DataFrame:
        """(leaf, subroot, root, proof_sha256, folded_root, *carry): the digest
        of each proof, and the root that the leaf in column ``instead``, or the
        stored one where that is null, leads to."""
        out = "leaf string, subroot string, root string, proof_sha256 string, folded_root string" + "".join(
            f", {c} string" for c in carry
        )
        k = len(carry)

        def end(r: tuple, at: list[int], others: list[str], roots: list[str]) -> tuple:
            leaf, other = r[4], r[5 + k]
            return (leaf, *roots, digest("".join(others)), fold(leaf if other is None else other, at, others), *r[5 : 5 + k])

        return descend(self.groups, self.paths(), [*carry, instead], end, out)


def build(leaves: DataFrame, order: list[str], stride: int = STRIDE) -> Manifest:
    """The manifest of ``leaves`` (tree, hash, ...), a written table whose trees
    are ordered by ``order``. Other columns stay with the stored leaves."""
    groups = store(materialize(numbered(leaves, order), "merkle-leaves"), stride)
    heads = groups.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("n").cast("string").alias("size"), "hash"
    )
    heads = numbered(materialize(heads, "merkle-roots"), ["name"])
    return Manifest(groups, store(materialize(heads, "merkle-tops"), stride))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc, doc_id, copy, hash, tampered) of ``documents``, written.

    ``tampered`` is the leaf of the text with A-Z lower-cased where 5 divides
    the crc32 of the id; null for other rows, rows without an id among them.
    """
    values = [col(c) for c in FIELDS]
    folded = values[:-1] + [F.translate(values[-1], UPPER, LOWER)]
    chosen = F.crc32(col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    rows = docs.select(
        tree_name(col("source")).alias("tree"), col("doc_id").cast("string").alias("doc"), col("doc_id").alias("doc_id"),
        F.monotonically_increasing_id().alias("copy"), leaf_hash(values).alias("hash"),
        F.when(chosen, leaf_hash(folded)).alias("tampered"),
    )
    return materialize(rows, "merkle-hashes")


def document_manifest(docs: DataFrame, stride: int = STRIDE) -> Manifest:
    """The manifest of ``documents``: a tree for each source, leaves by doc_id.

    Nulls in any column, a null id among them, are values of their own (a null
    id comes first, a null source is a group). Rows that repeat an id are leaves
    next to each other, ordered by their hash; equal rows have equal leaves.
    Other columns are not read. An empty table has no leaf and no root.
    """
    return build(document_leaves(docs), ["doc_id", "hash", "copy"], stride)


def audited(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """One row for each row of ``docs``: its leaf, the roots, its proof's digest
    and whether the leaf, tampered with where 5 divides the crc32 of its id,
    still leads to the root."""
    found = document_manifest(docs, stride).audit(["doc"], "tampered")
    return found.select(
        F.col("doc").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and tampering check of every document."""
    return audited(read(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same in DuckDB: all levels of both trees, spelled out."""
    value = lambda v: f"coalesce(strlen({v}::varchar)::varchar || ':' || {v}::varchar, '-')"
    leaf = lambda t: "sha256(" + " || ".join([*map(value, FIELDS[:-1]), value(t)]) + ")"
    crc = (
        "xor(list_reduce(list_transform(range(1, length(doc_id::varchar) + 1),"
        " lambda i: ascii(substr(doc_id::varchar, i::int, 1))::bigint), lambda a, b:"
        " list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda c, d: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b)),"
        " 4294967295::bigint), 4294967295::bigint)"
    )
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [f"""hashed as (select *, {leaf('text')} as leaf,
        case when {crc} % {TAMPER_EVERY} = 0 then {leaf(low)} else {leaf('text')} end as given from documents),
      a0 as (select coalesce('=' || source, '-') as tree, leaf as hash,
        row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by source) as n, doc_id, given from hashed)"""]

    def tree(name: str, levels: int) -> None:
        for k in range(levels):  # runs of a level, and the nodes above while several remain
            parts.append(f"""{name}r{k} as (select tree, pos // {FAN} as pos, list(hash order by pos) as run,
              max(n) as n from {name}{k} group by all),
              {name}{k + 1} as (select tree, pos, case when n = 1 then run[1] else sha256(array_to_string(run, '')) end
              as hash, ceil(n / {FAN})::bigint as n from {name}r{k})""")

    tree("a", 6)
    parts.append("""b0 as (select '' as tree, tree as name, hash, row_number() over (order by tree) - 1 as pos,
      count(*) over () as n from a6)""")
    tree("b", 6)
    columns, joins = [], []
    for name, at in (("a", "a0.pos"), ("b", "b0.pos")):
        first = "a0.tree" if name == "a" else "''"
        for k in range(6):
            joins.append(f"join {name}r{k} on {name}r{k}.tree = {first} and {name}r{k}.pos = {at} // {FAN ** (k + 1)}")
            columns.append((f"{name}r{k}", f"({at} // {FAN ** k} % {FAN})"))
        if name == "a":
            joins.append("join b0 on b0.name = a0.tree")
    others = [f"list_concat({r}.run[1:{p}], {r}.run[{p} + 2:])" for r, p in columns]
    proof = " || ".join(f"array_to_string({o}, '')" for o in others)
    parts.append(f"""p as (select a0.doc_id, a0.hash as leaf, a0.given, a6.hash as subroot, b6.hash as root,
      sha256({proof}) as proof_sha256, {', '.join(f'{r}.run as {r}_run, {r}.n as {r}_n, {p} as {r}_at' for r, p in columns)}
      from a0 join a6 on a6.tree = a0.tree cross join b6 {' '.join(joins)}),
      f0 as (select *, given as now from p)""")
    for i, (r, _) in enumerate(columns):
        parts.append(f"""f{i + 1} as (select * replace (case when {r}_n = 1 then now else sha256(
          array_to_string({r}_run[1:{r}_at], '') || now || array_to_string({r}_run[{r}_at + 2:], '')) end as now) from f{i})""")
    return f"""with {', '.join(parts)} select doc_id, leaf, subroot, root, proof_sha256, now as folded_root,
      now = root as verified from f{len(columns)}"""


OP11_SQL = _sql()
