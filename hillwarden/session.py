"""Session factory and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "hillwarden", **conf: str) -> SparkSession:
    """Session with adaptive execution; on a cluster the submit settings win."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the cluster names.

    A folder is made up only where ``spark.checkpoint.dir`` is unset and the
    master is local, as in tests.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
    elif sc.getCheckpointDir() is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hillwarden-ckpt-"))
    return df.checkpoint()
