"""File sources: history CSV and the split-orient JSON payment feed.

The feed arrives as documents ``{"columns": [...], "index": [...],
"data": [[...], ...]}`` sent as a JSON *string* holding that JSON. Decoding
unwraps the string, parses the document with an explicit schema, explodes
its rows and looks every wanted column up *by name* in the document's own
column list, so column order may change between documents. Every value is
parsed with ``try_cast``; a bad value becomes null and is caught later by
validation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions import dates, text

# ------------------------------------------------------------------ history CSV

# Column layout of the history CSV (after its unnamed index column).
HISTORY_COLUMNS = [
    ("trans_date_trans_time", T.StringType()), ("cc_num", T.StringType()), ("merchant", T.StringType()),
    ("category", T.StringType()), ("amt", T.DoubleType()), ("first", T.StringType()),
    ("last", T.StringType()), ("gender", T.StringType()), ("street", T.StringType()),
    ("city", T.StringType()), ("state", T.StringType()), ("zip", T.StringType()),
    ("lat", T.DoubleType()), ("long", T.DoubleType()), ("city_pop", T.IntegerType()),
    ("job", T.StringType()), ("dob", T.StringType()), ("trans_num", T.StringType()),
    ("unix_time", T.LongType()), ("merch_lat", T.DoubleType()), ("merch_long", T.DoubleType()),
    ("is_fraud", T.IntegerType()),
]
HISTORY_SCHEMA = T.StructType(
    [T.StructField("_index", T.LongType())] + [T.StructField(n, t) for n, t in HISTORY_COLUMNS]
)


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """History CSV with header; explicit schema (no inference pass); the
    leading index column is dropped."""
    return (
        spark.read.schema(HISTORY_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .drop("_index")
    )


def read_history_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every data line of a history CSV: its typed columns, the raw ``line`` and
    ``damaged``, whether the line lacks fields, has too many, or holds a value
    that is not of its column's type. Header lines are left out. A record is one
    line; quoted line breaks are not part of this layout."""
    names = [n for n, _ in HISTORY_COLUMNS]
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    is_header = F.slice(F.split("line", ","), 2, len(names)) == F.array(*[F.lit(n) for n in names])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in HISTORY_SCHEMA) + ", _damaged string"
    row = F.from_csv("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"})
    parsed = lines.where(~is_header & (F.trim("line") != "")).select("line", row.alias("r"))
    return parsed.select(*[F.col("r")[n].alias(n) for n in names], "line", F.col("r._damaged").isNotNull().alias("damaged"))


def split_history_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(sound rows, raw lines of the damaged ones) of a history CSV; together
    they are all data lines."""
    rows = read_history_lines(spark, path)
    return rows.where(~F.col("damaged")).drop("line", "damaged"), rows.where("damaged").select("line")


def to_history_layout(payments: DataFrame) -> DataFrame:
    """Payments in the history CSV layout (index = id)."""
    ts = F.col("transaction_time")
    cols = {
        "_index": F.col("id"),
        "trans_date_trans_time": F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        "unix_time": dates.ntz_epoch(ts, "SECOND"),
        "amt": F.col("amt").cast("double"),
    }
    out = []
    for name, dtype in [("_index", T.LongType())] + HISTORY_COLUMNS:
        if name in cols:
            out.append(cols[name].cast(dtype).alias(name))
        elif name in payments.columns:
            out.append(F.col(name).cast(dtype).alias(name))
        else:
            out.append(F.lit(None).cast(dtype).alias(name))
    return payments.select(*out)


def write_history_csv(payments: DataFrame, path: str) -> str:
    to_history_layout(payments).write.mode("overwrite").option("header", True).csv(path)
    return path


# ------------------------------------------------------------------ split JSON

# Index labels are read as text: a document may label its rows with anything.
SPLIT_DOC_SCHEMA = "columns array<string>, index array<string>, data array<array<string>>"

# Feed column -> type after decoding (current_time holds epoch milliseconds).
FEED_TYPES: list[tuple[str, str]] = [
    ("trans_num", "string"), ("cc_num", "string"), ("merchant", "string"), ("category", "string"),
    ("amt", "double"), ("first", "string"), ("last", "string"), ("gender", "string"),
    ("street", "string"), ("city", "string"), ("state", "string"), ("zip", "string"),
    ("lat", "double"), ("long", "double"), ("city_pop", "int"), ("job", "string"), ("dob", "string"),
    ("merch_lat", "double"), ("merch_long", "double"), ("is_fraud", "int"), ("current_time", "bigint"),
]


def encode_split_documents(df: DataFrame, columns: Sequence[str], index_col: str,
                           rows_per_doc: int = 100) -> DataFrame:
    """Pack rows into split-orient documents of at most ``rows_per_doc`` rows
    (consecutive ``index_col`` values) and wrap each as a JSON string
    literal, one per line (``value``). Groups are bounded by construction."""
    row = F.struct(F.col(index_col).alias("i"),
                   F.array(*[F.col(c).cast("string") for c in columns]).alias("r"))
    docs = df.groupBy(F.floor(F.col(index_col) / rows_per_doc).alias("doc_id")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"))
    inner = F.to_json(F.struct(
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        F.col("rows.i").alias("index"),
        F.col("rows.r").alias("data"),
    ))
    # to_json of a one-element array gives ["<escaped document>"]; drop the brackets
    docs = docs.select("doc_id", F.to_json(F.array(inner)).alias("_w"))
    return docs.select("doc_id", F.expr("substring(_w, 2, length(_w) - 2)").alias("value"))


def unwrap_json_string(value: Column) -> Column:
    """Decode a JSON string literal (``"{\\"a\\":1}"`` -> ``{"a":1}``); null if
    ``value`` is none."""
    return F.get(F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>"), 0)


def read_documents(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``lines`` with ``document`` (the parsed document) and ``reason``: why it
    cannot be turned into rows, null for a sound document.

    A document is taken as a whole or not at all. It is sound if it has columns
    and data, every entry of ``data`` has a value for each column, and
    ``index``, if there, a label for each entry. An empty ``data`` array is no
    fault; a missing ``index`` is none either.

    Each line is parsed once: as a generated column the document is a value that
    is there, while a projected one would be put in place of every use, and so be
    parsed again for each of them and for each entry of ``data``.
    """
    text_ = unwrap_json_string(F.col(value_col))
    doc = F.from_json(F.col("_text"), SPLIT_DOC_SCHEMA)
    d = F.col("document")
    ragged = F.exists(d["data"], lambda r: F.coalesce(F.size(r) != F.size(d["columns"]), F.lit(True)))
    reason = (
        F.when(F.col("_text").isNull(), F.lit("not a JSON string"))
        .when(d.isNull() | (d["columns"].isNull() & d["data"].isNull()), F.lit("not a split document"))
        .when(d["columns"].isNull(), F.lit("no columns"))
        .when(d["data"].isNull(), F.lit("no data"))
        .when(ragged, F.lit("ragged rows"))
        .when(F.size(d["index"]) != F.size(d["data"]), F.lit("index does not fit"))
    )
    return (lines.select("*", F.explode_outer(F.array(text_)).alias("_text"))
            .select("*", F.explode_outer(F.array(doc)).alias("document"))
            .withColumn("reason", reason).drop("_text"))


def document_rows(documents: DataFrame, types: Sequence[tuple[str, str]] = FEED_TYPES,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One typed row per entry of the sound ``documents`` (of ``read_documents``),
    with the columns in ``keep``, the entry's place ``feed_pos``, its label
    ``feed_label`` (null without an index) and ``feed_index``: the label if all
    labels of the document are whole numbers, else the place."""
    d = F.col("document")
    numbered = F.forall(d["index"], lambda x: x.try_cast("bigint").isNotNull())
    rows = documents.where(F.col("reason").isNull()).select(
        *keep, d["columns"].alias("columns"), d["index"].alias("index"),
        F.coalesce(numbered, F.lit(False)).alias("numbered"), F.posexplode(d["data"]).alias("feed_pos", "entry"),
    )
    label = F.get(F.col("index"), F.col("feed_pos"))
    place = F.col("feed_pos").cast("bigint")
    out = [F.col("feed_pos"), label.alias("feed_label"),
           F.when(F.col("numbered"), label.try_cast("bigint")).otherwise(place).alias("feed_index")]
    for name, dtype in types:
        raw = F.get(F.col("entry"), F.array_position("columns", F.lit(name)).cast("int") - 1)
        out.append((raw if dtype == "string" else raw.try_cast(dtype)).alias(name))
    return rows.select(*keep, *out)


def decode_split_documents(lines: DataFrame, value_col: str = "value",
                           types: Sequence[tuple[str, str]] = FEED_TYPES) -> DataFrame:
    """The rows of all sound documents among ``lines``. Every other document
    gives no row here and one in ``broken_documents``."""
    return document_rows(read_documents(lines, value_col), types)


def broken_documents(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(value, reason) of the documents that are not sound, with their raw text,
    for quarantine."""
    found = read_documents(lines, value_col).where(F.col("reason").isNotNull())
    return found.select(F.col(value_col).alias("value"), "reason")


def feed_account(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(state, documents, entries): how many documents are sound and how many
    broken, by reason, and the entries of the sound ones. Documents add up to
    the lines, entries to the decoded rows."""
    found = read_documents(lines, value_col)
    entries = F.when(F.col("reason").isNull(), F.size(F.col("document")["data"])).otherwise(0)
    return found.groupBy(F.coalesce("reason", F.lit("sound")).alias("state")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(entries).cast("bigint").alias("entries"))


def feed_time(df: DataFrame, source: str = "current_time", target: str = "transaction_time") -> DataFrame:
    """Rename the feed clock to ``transaction_time``: epoch milliseconds to a
    timestamp (no zone shift), plus its display text with milliseconds."""
    ts = dates.epoch_to_ntz(F.col(source), "MILLISECOND")
    return df.withColumn(target, ts).withColumn(
        f"{target}_text", F.date_format(F.col(target), "yyyy-MM-dd HH:mm:ss.SSS")).drop(source)


def extract_rows(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of the sound ``documents`` (of ``read_documents``) with the
    columns in ``keep``: clock renamed, merchant names cleaned."""
    df = feed_time(document_rows(documents, keep=keep))
    return df.withColumn("merchant", text.clean_merchant(F.col("merchant")))


def extract_feed(lines: DataFrame) -> DataFrame:
    """Decode, rename the clock and clean merchant names (the extract step)."""
    return extract_rows(read_documents(lines))
