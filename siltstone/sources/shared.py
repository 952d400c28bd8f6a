"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir or, where it is unset and the master is local (as in tests), a folder of our own; else an error."""
    folder = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{KEY} must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="shared-")
    return _own[app]


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table that has fewer partitions than there are cores, dealt to all of them, for work that costs far more than the exchange; any other table as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.rdd().getNumPartitions() >= cores else df.repartition(cores)
