"""Category dictionary and dense numbering."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardsentry.operators import features as FE
from cardsentry.operators import prep
from cardsentry.operators.ranking import dense_ids
from cardsentry.sources.storage import new_location


def test_dense_ids_over_many_partitions(spark):
    rows = [(g, v) for g, n in (("hot", 700), ("b", 3), (None, 5), ("c", 1)) for v in range(n)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = {(r.g, r.v): r.id for r in dense_ids(df, ["g"], [F.col("v").desc()]).collect()}
    size = {"hot": 700, "b": 3, None: 5, "c": 1}
    assert got == {(g, v): size[g] - 1 - v for g, v in rows}


def test_dictionary_drops_the_first_and_ignores_the_unknown(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None), ("b", "x")], "p string, q string")
    stages = [prep.CategoryDictionary(inputCols=["p", "q"], outputCols=["pi", "qi"]),
              OneHotEncoder(inputCols=["pi", "qi"], outputCols=["pv", "qv"], dropLast=True)]
    model = Pipeline(stages=stages).fit(train)
    path = new_location(spark, "dictionary_model")
    model.write().save(path)
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("new", None), (None, "x")], "p string, q string")
    for m in (model, PipelineModel.load(path)):
        out = [(r.p, list(r.v), list(r.w)) for r in m.transform(rows).select(
            "p", vector_to_array("pv").alias("v"), vector_to_array("qv").alias("w")).collect()]
        # columns c and b of p; q has a single category, which is dropped: its slot stays empty
        assert sorted(out, key=str) == sorted([("a", [0.0, 0.0], [0.0]), ("b", [0.0, 1.0], [0.0]), ("c", [1.0, 0.0], [0.0]),
                                               ("new", [0.0, 0.0], [0.0]), (None, [0.0, 0.0], [0.0])], key=str)
    assert model.transform(rows).columns == ["p", "q", "pi", "qi", "pv", "qv"]


def test_no_category_is_gathered_by_the_fit():
    names = [type(s).__name__ for s in prep.preprocessing_stages()]
    assert names == ["PopulationStandardScaler", "CategoryDictionary", "OneHotEncoder", "VectorAssembler"]


def test_split_by_dtype(spark):
    df = spark.createDataFrame([(1, 2.0, "x", None)], "a int, b double, c string, d decimal(5,2)")
    assert FE.split_by_dtype(df) == (["a", "b", "d"], ["c"])
    assert FE.split_by_dtype(df, ["c", "a"]) == (["a"], ["c"])
