"""Registered preprocessing and learning queries.

Training rows are the retraining extract (training rows joined to their
predictions, label = predicted label as in the original job), split 80/20
per class. Forest keys have no SQL twin (rows-only check).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardsentry.operators import evaluate as EV
from cardsentry.operators import features as FE
from cardsentry.operators import model as M
from cardsentry.operators import prep as P
from cardsentry.plans import reports as R
from cardsentry.plans.catalog import Inputs, register
from cardsentry.schemas import ALERT_THRESHOLD, CATEGORICAL_FEATURES, NUMERIC_FEATURES
from cardsentry.sources.storage import materialize, new_location

_SRC = """(SELECT td.*, CAST(pred.is_fraud AS INTEGER) AS label
  FROM predictions pred JOIN training_data td ON td.trans_num = pred.trans_num)"""
_SPLIT = f"""(SELECT s.*, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', trans_num)), trans_num)
    <= floor(0.2 * count(*) OVER (PARTITION BY label) + 0.5) AS is_test FROM {_SRC} s)"""
_TRAIN = f"(SELECT * FROM {_SPLIT} x WHERE NOT is_test)"
_TEST = f"(SELECT * FROM {_SPLIT} x WHERE is_test)"


def _extract(i: Inputs):
    return R.train_extract(i.predictions, i.training_data, label="predicted")


def _split(i: Inputs):
    """The split reads its input three times (bucket counts, the cut bucket,
    the rest): write the joined extract once instead of re-joining thrice."""
    if not hasattr(i, "_extract_rows"):
        i._extract_rows = materialize(_extract(i), "train_extract")
    return P.stratified_split(i._extract_rows, "is_fraud")


def _split_rows(i: Inputs):
    """Model rows with the split flag, written once to the shared folder:
    the preprocessing fit and the forest read them many times."""
    if not hasattr(i, "_split_rows"):
        rows = FE.model_features(_split(i), keep=["trans_num", "is_fraud", "is_test"])
        i._split_rows = materialize(rows, "split_rows")
    return i._split_rows


@register("split_stratified", f"SELECT trans_num, label AS is_fraud, is_test FROM {_SPLIT} x")
def split_stratified(i: Inputs):
    return _split(i).select("trans_num", "is_fraud", "is_test")


def _num_sql(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


@register("prep_scaler_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({_num_sql(c)}), 6) AS mean, round(stddev_pop({_num_sql(c)}), 6) AS std "
    f"FROM {_TRAIN} t" for c in NUMERIC_FEATURES
))
def prep_scaler_stats(i: Inputs):
    train = _split_rows(i).where(~F.col("is_test"))
    model = P.PopulationStandardScaler(inputCols=NUMERIC_FEATURES, outputCol="scaled").fit(train)
    rows = [(c, m, s) for c, m, s in zip(NUMERIC_FEATURES, model.getOrDefault(model.means),
                                          model.getOrDefault(model.stds))]
    df = i.spark.createDataFrame(rows, "feature string, mean double, std double")
    return df.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _scaled_sql(rows: str, cols) -> str:
    stats = ", ".join(
        f"avg({_num_sql(c)}) AS m_{c}, stddev_pop({_num_sql(c)}) AS s_{c}" for c in cols)
    exprs = ", ".join(
        f"round(CASE WHEN st.s_{c} > 0 THEN coalesce(({_num_sql('r.' + c)} - st.m_{c}) / st.s_{c}, 0.0) "
        f"ELSE 0.0 END, 6) AS {c}" for c in cols)
    return f"SELECT r.trans_num, {exprs} FROM {rows} r JOIN (SELECT {stats} FROM {_TRAIN} t) st ON true"


def _scaled(i: Inputs, rows, cols):
    train = _split_rows(i).where(~F.col("is_test"))
    model = P.PopulationStandardScaler(inputCols=NUMERIC_FEATURES, outputCol="scaled").fit(train)
    vals = dict(zip(NUMERIC_FEATURES, model.vector_columns()))
    return rows.select("trans_num", *[F.round(vals[c], 6).alias(c) for c in cols])


@register("prep_standard_scale", _scaled_sql(_TRAIN, NUMERIC_FEATURES))
def prep_standard_scale(i: Inputs):
    return _scaled(i, _split_rows(i).where(~F.col("is_test")), NUMERIC_FEATURES)


@register("prep_sample_values", _scaled_sql(_TEST, NUMERIC_FEATURES[:10]))
def prep_sample_values(i: Inputs):
    """First 10 slots of the preprocessed vector of every test row (all numeric)."""
    train = _split_rows(i).where(~F.col("is_test"))
    test = _split_rows(i).where(F.col("is_test"))
    from pyspark.ml import Pipeline

    pm = Pipeline(stages=P.preprocessing_stages()).fit(train)
    arr = vector_to_array(F.col("features"))
    names = NUMERIC_FEATURES[:10]
    return pm.transform(test).select("trans_num", *[F.round(arr[j], 6).alias(c) for j, c in enumerate(names)])


@register("prep_one_hot", " UNION ALL ".join(
    f"SELECT s.trans_num, concat('{c}_', s.{c}) AS feature FROM {_SPLIT} s "
    f"WHERE s.{c} IN (SELECT {c} FROM {_TRAIN} t) AND s.{c} <> (SELECT min({c}) FROM {_TRAIN} t)"
    for c in CATEGORICAL_FEATURES
))
def prep_one_hot(i: Inputs):
    rows = _split_rows(i)
    return P.one_hot_long(rows, rows.where(~F.col("is_test")))


@register("prep_matrix_shape", f"""
SELECT count(*) AS n_rows,
  {len(NUMERIC_FEATURES)} + {' + '.join(f"(SELECT count(DISTINCT {c}) - 1 FROM {_TRAIN} t)" for c in CATEGORICAL_FEATURES)}
    AS width
FROM {_TRAIN} t
""")
def prep_matrix_shape(i: Inputs):
    from pyspark.ml import Pipeline

    train = _split_rows(i).where(~F.col("is_test"))
    pm = Pipeline(stages=P.preprocessing_stages()).fit(train)
    out = pm.transform(train)
    return out.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.max(F.size(vector_to_array("features"))).cast("long").alias("width"))


@register("ml_class_weights", f"""
SELECT label AS is_fraud, count(*) AS n_class,
  (SELECT count(*) FROM {_TRAIN} a) / ((SELECT count(DISTINCT label) FROM {_TRAIN} b) * count(*)) AS weight
FROM {_TRAIN} t GROUP BY label
""")
def ml_class_weights(i: Inputs):
    train = _split_rows(i).where(~F.col("is_test"))
    return P.class_weights(train, "is_fraud")


# ------------------------------------------------------------ forest († keys)

def _fitted(i: Inputs):
    if not hasattr(i, "_model"):
        rows = _split_rows(i).withColumn("is_fraud", F.col("is_fraud").cast("double"))
        train = P.with_class_weights(rows.where(~F.col("is_test")), "is_fraud")
        i._model = M.train(train, "is_fraud")
    return i._model


@register("ml_train_score")
def ml_train_score(i: Inputs):
    test = _split_rows(i).where(F.col("is_test"))
    return M.score(_fitted(i), test, keep=["trans_num", "is_fraud"])


@register("ml_feature_importance")
def ml_feature_importance(i: Inputs):
    pairs = M.feature_importance(_fitted(i), 10)
    return i.spark.createDataFrame(pairs, "feature string, importance double")


@register("ml_roundtrip")
def ml_roundtrip(i: Inputs):
    """Save the fitted pipeline, load it back and score again: both agree."""
    model = _fitted(i)
    path = M.save(model, new_location(i.spark, "fraud_model"))
    again = M.load(path)
    test = _split_rows(i).where(F.col("is_test"))
    a = M.score(model, test).select("trans_num", F.col("fraud_probability").alias("p_before"))
    b = M.score(again, test).select("trans_num", F.col("fraud_probability").alias("p_after"))
    return a.join(b, "trans_num").select("trans_num", "p_before", "p_after",
                                         (F.col("p_before") == F.col("p_after")).alias("same"))


@register("ml_roundtrip_same", f"SELECT trans_num, true AS same FROM {_TEST} t")
def ml_roundtrip_same(i: Inputs):
    """Whether each test row scores the same before saving and after loading."""
    return ml_roundtrip(i).select("trans_num", "same")


@register("ml_score_facts", f"""
SELECT trans_num, label AS is_fraud, true AS in_range, true AS label_agrees FROM {_TEST} t
""")
def ml_score_facts(i: Inputs):
    """Measured on the forest's scores: the probability lies in [0, 1] and the
    predicted label is what the threshold makes of it."""
    p = F.col("fraud_probability")
    return ml_train_score(i).select(
        "trans_num", F.col("is_fraud").cast("int").alias("is_fraud"),
        p.between(0, 1).alias("in_range"),
        (F.col("is_fraud_pred").cast("int") == (p > ALERT_THRESHOLD).cast("int")).alias("label_agrees"),
    )


@register("ml_model_run")
def ml_model_run(i: Inputs):
    """The run record: evaluation metrics of the test split, gates and the
    forest parameters (one row of ``model_runs``)."""
    scored = ml_train_score(i)
    g = EV.gates(EV.metrics(scored, "is_fraud", "is_fraud_pred", decimals=None))
    cfg = M.ForestConfig()
    return g.select(
        F.lit("run_latest").alias("run_id"), "*",
        F.lit(cfg.num_trees).alias("num_trees"), F.lit(cfg.max_depth).alias("max_depth"),
        F.lit(cfg.min_instances_per_node).alias("min_instances_per_node"), F.lit(cfg.seed).alias("seed"),
    )
