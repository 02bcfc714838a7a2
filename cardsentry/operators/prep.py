"""Preprocessing: stratified split, population standardisation, drop-first
one-hot encoding, feature assembly and balanced class weights.

The scaler and the category dictionary are ``pyspark.ml`` stages, so the fitted
preprocessing is part of one ``PipelineModel`` that is saved and loaded with
MLWriter. Fitting reads one aggregate row (means, deviations, numbers of
categories); the categories themselves stay in a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
    MLWritable, MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.operators.joins import BROADCAST_ROWS_LIMIT, broadcast_if_small, join_groups
from cardsentry.operators.ranking import dense_ids, hash_rank_flag
from cardsentry.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from cardsentry.sources.storage import new_location, shared_root, write_table

# ------------------------------------------------------------------ split


def split_key(key: str = "trans_num", seed: int = 42) -> Column:
    """Uniform, repeatable ordering key: md5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, label: str = "is_fraud", test_size: float = 0.2, seed: int = 42,
                     key: str = "trans_num", flag: str = "is_test") -> DataFrame:
    """Exact per-class split: in every class, the ``round(test_size * n)``
    rows with the smallest ``md5(seed:key)`` form the test set.

    Ranks come from bucket counts of the hash (see ``ranking``), never from
    a window over a whole class.
    """
    k = F.floor(F.lit(float(test_size)) * F.col("_n") + F.lit(0.5))
    return hash_rank_flag(df, [label], split_key(key, seed), key, k, flag)


# ------------------------------------------------------------------ scaler


class _ScalerParams(HasInputCols, HasOutputCol):
    pass


class PopulationStandardScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std per column into one vector; std 0 -> 0.

    ``pyspark.ml.feature.StandardScaler`` divides by the *sample* deviation
    and does not centre by default; this estimator reproduces the original
    preprocessing (mean 0, population deviation) in one aggregate pass.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PopulationStandardScalerModel":
        cols = self.getInputCols()
        row = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
        stds = [float(row[f"s{i}"] or 0.0) for i in range(len(cols))]
        model = PopulationStandardScalerModel(inputCols=cols, outputCol=self.getOutputCol())
        model._set(means=means, stds=stds)
        return model


class PopulationStandardScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population deviations", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def scaled_columns(self) -> list[Column]:
        out = []
        for c, m, s in zip(self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.stds)):
            x = F.col(c).cast("double")
            out.append(((x - F.lit(m)) / F.lit(s)) if s > 0 else F.when(x.isNotNull(), F.lit(0.0)))
        return out

    def vector_columns(self) -> list[Column]:
        # a missing value becomes the column mean (0 after scaling) in the vector
        return [F.coalesce(c, F.lit(0.0)) for c in self.scaled_columns()]

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getInputCols()
        meta = {"ml_attr": {"num_attrs": len(names),
                            "attrs": {"numeric": [{"idx": j, "name": n} for j, n in enumerate(names)]}}}
        vec = array_to_vector(F.array(*self.vector_columns()))
        return df.withColumn(self.getOutputCol(), vec.alias(self.getOutputCol(), metadata=meta))


# ------------------------------------------------------------------ one-hot


class _DictionaryWriter(MLWriter):
    """Saves the parameters and, beside them, the dictionary itself."""

    def __init__(self, instance: "CategoryDictionaryModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.dictionary(self.sparkSession).write.parquet(f"{path}/dictionary")


class _DictionaryReader(DefaultParamsReader):
    def load(self, path: str) -> "CategoryDictionaryModel":
        model = super().load(path)
        model._set(location=f"{path}/dictionary")
        return model


class CategoryDictionary(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Number the categories of every input column, the alphabetically last first.

    The dictionary is a table (column, value, id) made by a distributed sort; the
    driver sees one count per column. The alphabetically first category has the
    last index, which ``OneHotEncoder(dropLast=True)`` drops; unknown and missing
    values get that index too and encode as all zeros: the original drop-first /
    ignore-unknown rule.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CategoryDictionaryModel":
        cols = self.getInputCols()
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(j).alias("column"), F.col(c).cast("string").alias("value")) for j, c in enumerate(cols)
        ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull()).distinct()
        spark = df.sparkSession
        location = new_location(spark, "categories")
        write_table(dense_ids(pairs, ["column"], [F.col("value").desc()]), location)
        counts = {r[0]: r[1] for r in spark.read.parquet(location).groupBy("column").count().collect()}
        model = CategoryDictionaryModel(inputCols=cols, outputCols=self.getOutputCols())
        model._set(location=location, sizes=[counts.get(j, 0) for j in range(len(cols))])
        return model


class CategoryDictionaryModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    location = Param(Params._dummy(), "location", "folder of the dictionary", typeConverter=TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "known categories per column", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> MLWriter:
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _DictionaryReader(cls)

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """(column number, value, id) of every known category."""
        return spark.read.schema("column int, value string, id bigint").parquet(self.getOrDefault(self.location))

    def _transform(self, df: DataFrame) -> DataFrame:
        known = self.dictionary(df.sparkSession)
        columns, new = df.columns, []
        for j, (c, o, n) in enumerate(zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.sizes))):
            own = known.where(F.col("column") == j).select(F.col("value").alias(f"{o}__value"), F.col("id").alias(f"{o}__id"))
            if n <= BROADCAST_ROWS_LIMIT:  # counted when the dictionary was made
                own = F.broadcast(own)
            df = df.join(own, F.col(c).cast("string") == F.col(f"{o}__value"), "left")
            # the encoder asks for two values at least: a single one is the last of two
            width = max(n, 2)
            meta = {"ml_attr": {"type": "nominal", "num_vals": width, "name": o}}
            index = F.coalesce(F.col(f"{o}__id") + (width - n), F.lit(width - 1)).cast("double")
            new.append(index.alias(o, metadata=meta))
        return df.select(*columns, *new)


def preprocessing_stages(numeric: Sequence[str] = NUMERIC_FEATURES,
                         categorical: Sequence[str] = CATEGORICAL_FEATURES,
                         output: str = "features") -> list:
    """Stages: scaler over numeric columns, drop-first one-hot over
    categorical columns, assembler into ``output``."""
    idx = [f"{c}__idx" for c in categorical]
    onehot = [f"{c}__onehot" for c in categorical]
    return [
        PopulationStandardScaler(inputCols=list(numeric), outputCol="numeric__scaled"),
        CategoryDictionary(inputCols=list(categorical), outputCols=idx),
        # dropLast drops the last index = the alphabetically first category
        OneHotEncoder(inputCols=idx, outputCols=onehot, dropLast=True),
        VectorAssembler(inputCols=["numeric__scaled", *onehot], outputCol=output),
    ]


def _category_slots(pipeline_model, first: int) -> tuple[CategoryDictionaryModel, list[int], list[int]]:
    """The dictionary stage; how many vector slots each of its columns has; where they begin."""
    stage = next(s for s in pipeline_model.stages if isinstance(s, CategoryDictionaryModel))
    sizes = [max(n, 2) - 1 for n in stage.getOrDefault(stage.sizes)]
    return stage, sizes, [first + sum(sizes[:j]) for j in range(len(sizes))]


def vector_width(pipeline_model, numeric: Sequence[str] = NUMERIC_FEATURES) -> int:
    """How many slots the assembled vector has."""
    return len(numeric) + sum(_category_slots(pipeline_model, len(numeric))[1])


def compact(pipeline_model, rows: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
            ) -> tuple[DataFrame, list[Column], list[Column], list[int]]:
    """The assembled vector without its zeros: rows with their category numbers;
    the numeric slots; for each category column the slot that is 1 (-1: none is);
    how many slots each category column has."""
    scaler = next(s for s in pipeline_model.stages if isinstance(s, PopulationStandardScalerModel))
    stage, sizes, begins = _category_slots(pipeline_model, len(numeric))
    slots = [F.when(F.col(c) < n, F.col(c).cast("int") + F.lit(begin)).otherwise(F.lit(-1))
             for c, n, begin in zip(stage.getOutputCols(), sizes, begins)]
    return stage.transform(rows), scaler.vector_columns(), slots, sizes


def feature_names(pipeline_model, slots: Sequence[int] | None = None, numeric: Sequence[str] = NUMERIC_FEATURES,
                  categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list[str]:
    """Names of the assembled vector slots, or of those asked for: numeric names,
    then ``column_value`` for every encoded (non-dropped) category. Only the
    categories of these slots are read."""
    stage, sizes, begins = _category_slots(pipeline_model, len(numeric))
    width = len(numeric) + sum(sizes)
    slots = range(width) if slots is None else slots
    asked = []
    for slot in slots:
        if slot >= len(numeric):
            j = max(k for k in range(len(sizes)) if begins[k] <= slot)
            asked.append((slot, j, slot - begins[j]))
    spark = SparkSession.getActiveSession()
    wanted = spark.createDataFrame(asked, "slot bigint, column int, id bigint")
    found = stage.dictionary(spark).join(F.broadcast(wanted), ["column", "id"]).select("slot", "column", "value").collect()
    names = {r.slot: f"{categorical[r.column]}_{r.value}" for r in found} | dict(enumerate(numeric))
    columns = {k: categorical[j] for k, j, _ in asked}  # a column with a single category has an empty slot
    return [names.get(k) or f"{columns[k]}_" for k in slots]


# ------------------------------------------------------------------ long-form one-hot


def one_hot_long(df: DataFrame, train: DataFrame, key: str = "trans_num",
                 categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """(key, feature) for every active one-hot slot, fully distributed.

    The category dictionary is the distinct values seen in ``train`` per
    column (a DataFrame, never collected); the alphabetically first value of
    each column is dropped; values unknown to ``train`` activate nothing.
    """
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in categorical
    ]))
    rows = df.select(key, stack.alias("kv")).select(key, "kv.column", "kv.value")
    dictionary = train.select(stack.alias("kv")).select("kv.column", "kv.value").where(
        F.col("value").isNotNull()).distinct()
    first = dictionary.groupBy("column").agg(F.min("value").alias("first_value"))
    encoded = dictionary.join(first, "column").where(F.col("value") != F.col("first_value")).select(
        "column", "value")
    # a frequent category (one gender, say) is a hot join key; the dictionary
    # is bounded by the number of categories, so it is broadcast when a count
    # confirms it is small and no row is shuffled by category at all. It is
    # written once, so the count and the join do not both re-read ``train``.
    shared_root(df.sparkSession)
    encoded = encoded.checkpoint(eager=True)
    return rows.join(broadcast_if_small(encoded), ["column", "value"]).select(
        key, F.concat_ws("_", "column", "value").alias("feature"))


# ------------------------------------------------------------------ class weights


def class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Balanced weights n / (n_classes * n_class) per label value."""
    shared_root(df.sparkSession)
    # one pass over the rows; what follows reads one row per class
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class")).checkpoint(eager=True)
    total, classes = per.select(F.sum("n_class")).scalar(), per.select(F.count(F.lit(1))).scalar()
    return per.select(label, "n_class", (total / (classes * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "is_fraud", weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class. The weight table has
    one row per class (two here), so broadcasting it is bounded. Rows without
    a label are a class of their own."""
    w = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return join_groups(df, broadcast_if_small(w), [label])
