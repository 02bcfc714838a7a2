"""Training, scoring, importances and persistence of the fraud forest.

The random forest is trained level by level over the partitions (one
aggregation of split statistics per level), so training scales with the
cluster: by MLlib, which holds rows dense, while rows times slots are few, and
on compact rows (``forest``) beyond. Either gives an MLlib model; the fitted
``PipelineModel`` (preprocessing + forest) is saved with MLWriter under the
shared folder and loaded by the scoring jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import scoring
from cardsentry.operators import forest, prep
from cardsentry.schemas import FOREST_PARAMS

# Hyper-parameter mapping of the original forest (scikit-learn names) onto
# MLlib: n_estimators -> numTrees, max_depth -> maxDepth, min_samples_leaf ->
# minInstancesPerNode, random_state -> seed, max_features 'sqrt' ->
# featureSubsetStrategy. min_samples_split has no MLlib twin; the leaf
# minimum bounds splits from below instead.


@dataclass
class ForestConfig:
    num_trees: int = FOREST_PARAMS["n_estimators"]
    max_depth: int = FOREST_PARAMS["max_depth"]
    min_instances_per_node: int = FOREST_PARAMS["min_samples_leaf"]
    seed: int = FOREST_PARAMS["random_state"]
    max_bins: int = 32
    feature_subset_strategy: str = "sqrt"
    class_weighted: bool = True
    # execution only (the model definition does not change): split statistics
    # of more nodes per pass over the data, and node ids cached between levels
    max_memory_mb: int = 1024
    cache_node_ids: bool = True
    bootstrap: bool = True
    # rows times slots up to which MLlib trains, on dense rows of 4 bytes a number
    dense_numbers: int = 1 << 28


def build_pipeline(label: str = "is_fraud", config: ForestConfig | None = None) -> Pipeline:
    cfg = config or ForestConfig()
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        numTrees=cfg.num_trees,
        maxDepth=cfg.max_depth,
        minInstancesPerNode=cfg.min_instances_per_node,
        seed=cfg.seed,
        maxBins=cfg.max_bins,
        featureSubsetStrategy=cfg.feature_subset_strategy,
        maxMemoryInMB=cfg.max_memory_mb,
        cacheNodeIds=cfg.cache_node_ids,
        bootstrap=cfg.bootstrap,
    )
    if cfg.class_weighted:
        forest.setWeightCol("weight")
    return Pipeline(stages=[*prep.preprocessing_stages(), forest])


def train(train_rows: DataFrame, label: str = "is_fraud", config: ForestConfig | None = None) -> PipelineModel:
    """Fit preprocessing + forest. ``train_rows`` must hold the 21 features,
    the label and (when weighted) a ``weight`` column.

    Every tree level is one pass over the rows, so the rows are spread over
    at least the cluster's default parallelism (a no-op when the input already
    has more partitions, as any large table does).

    The bags and draws of ``forest`` are not MLlib's, so that a forest of the same
    seed has other trees there.

    The forest's copy goes without the summary of its training: that holds the
    session, which cannot be sent to the tasks once the session has observed a
    write (a stream's tables count their rows so)."""
    cfg = config or ForestConfig()
    parallelism = train_rows.sparkSession.sparkContext.defaultParallelism
    if train_rows.rdd.getNumPartitions() < parallelism:
        train_rows = train_rows.repartition(parallelism)
    *preparing, trainer = build_pipeline(label, cfg).getStages()
    prepared = Pipeline(stages=preparing).fit(train_rows)
    width = prep.vector_width(prepared)
    if train_rows.count() * width <= cfg.dense_numbers:
        fitted = trainer.fit(prepared.transform(train_rows)).copy()
    else:
        rows, numbers, slots, sizes = prep.compact(prepared, train_rows)
        fitted = forest.fit(rows, numbers, slots, sizes, label, trainer)
    return PipelineModel(stages=[*prepared.stages, fitted])


def score(model: PipelineModel, rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predicted label, positive-class probability, risk level and confidence."""
    out = model.transform(rows)
    p = vector_to_array("probability")[1]
    return out.select(
        *(keep or ["trans_num"]),
        F.col("prediction").cast("int").alias("is_fraud_pred"),
        p.alias("fraud_probability"),
        scoring.risk_level(p).alias("risk_level"),
        scoring.confidence(p).alias("confidence"),
    )


def feature_importance(model: PipelineModel, top: int | None = 10) -> list[tuple[str, float]]:
    """(name, importance) of the forest's features, largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    slots = sorted(range(len(imp)), key=lambda k: (-imp[k], k))[: top or None]
    return list(zip(prep.feature_names(model, slots), (float(imp[k]) for k in slots)))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
