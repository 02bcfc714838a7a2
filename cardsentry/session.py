"""SparkSession construction with the settings every plan here relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the library assumes. On a cluster they are normally given by the
# job submission; ``get_session`` only fills them in for local runs.
DEFAULT_CONF = {
    # Adaptive execution: coalesces tiny shuffles (top-10 reports), turns
    # sort-merge joins into broadcast joins once the *measured* side is
    # small, and splits skewed join partitions (a hot card or customer key).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Oracle comparisons and calendar features are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # No web UI, no extra ports.
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "cardsentry",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with AQE on and UTC session time.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``) only when
    no master was configured by the launcher.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("CARDSENTRY_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
