"""Session set-up for tests and the bench, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("waycast")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_root() -> tempfile.TemporaryDirectory:
    """The folder of a local session; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="waycast-", ignore_cleanup_errors=True)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    All folders of an application lie in one that bears its id; whoever runs the
    application removes it afterwards.  A machine-local folder is used only by a local
    session that names none, and is removed at its end; a cluster without the setting
    is an error, since executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root().name
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: computed once, lineage cut."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
