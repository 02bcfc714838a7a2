"""Bounded training samples of labelled rows, and the folds of the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.llm.common import key_hash


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the text '~'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("~")).cast("binary")) % F.lit(folds)


def bounded_sample(
    labelled: DataFrame, docs: DataFrame, label: str, per_label: int, most_rows: int | None = None,
    cut: Callable[[Column, Column], Column] | None = None,
) -> list:
    """At most ``per_label`` rows (label, text) of each label and ``most_rows``
    (64 labels' worth) in all, the same on every run: the documents with the
    smallest hashes of their ids. Of more labels than that allows in full, each
    gets fewer, and of more than ``most_rows`` labels the first ones one each.

    ``labelled`` holds doc_id and the label, ``docs`` doc_id and text. Ids are
    picked first, for all labels in one pass: every task cuts each label to
    ``per_label`` ids before anything is sent. Texts are then looked up by
    broadcasting the picked ids, whose number the parameters bound, so no text
    is shuffled but theirs; ``cut(text, doc_id)`` says what of a text is used and
    is applied where the text is read. Rows without an id are not picked, of
    rows that share one a single one is.
    """
    hashed = key_hash("sample", F.col("doc_id"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(hashed, "doc_id"))
    ids = labelled.where("doc_id is not null").select("doc_id", F.col(label).alias("label"))
    top = ids.withColumn("place", place).where(F.col("place") <= per_label)
    picked = top.orderBy("place", "label", "doc_id").limit(most_rows or 64 * per_label).drop("place").collect()
    if not picked:
        return []
    ids = docs.sparkSession.createDataFrame(picked, ids.schema).dropDuplicates(["doc_id"])
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    if cut is not None:
        found = found.withColumn("text", cut(F.col("text"), F.col("doc_id")))
    rows = found.dropDuplicates(["doc_id"]).collect()
    return [(r.label, r.text) for r in sorted(rows, key=lambda r: (r.label, r.doc_id))]
