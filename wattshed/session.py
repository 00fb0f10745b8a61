"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(
    app_name: str = "wattshed", master: str | None = None, first_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the library is tuned for.

    Shuffle width is left to adaptive execution: start wide enough for a large
    cluster (``first_partitions``: about the input's size over 128 MB) and let it
    coalesce small partitions, split skewed join partitions and turn small join
    sides into broadcasts by their measured size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    if first_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(first_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder under the shared checkpoint folder of the cluster.

    Written tables, streaming checkpoints and staged runs all go there, so that
    they outlive any executor. Only a local session, where one machine is the
    whole cluster, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="wattshed-")
    return f"{root.rstrip('/')}/wattshed/{purpose}-{uuid.uuid4().hex}"
