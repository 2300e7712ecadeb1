"""Spark session and lineage helpers.

The library never changes session settings on its own; ``get_session`` is a
convenience for scripts and tests.  On a cluster the caller's session (and its
``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session defaults for scripts/tests.  AQE re-plans joins at run time (a
# checked broadcast when a side turns out small, skew-join splitting for hot
# keys) and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "decklens", extra: dict | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only when the setting is absent under a local master (tests) is a scratch
    folder created; on a cluster an unset folder is an error, since a folder of
    one machine would lose rows.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="decklens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used before iterative work (grid search) so that a lost executor costs a
    re-read of the checkpoint, not a recomputation of the whole plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
