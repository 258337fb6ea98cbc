"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # The warehouse's own time; tables of zone-less times are read in UTC instead.
    "spark.sql.session.timeZone": "Asia/Shanghai",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column slows the building of plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Hands this package to the Python workers, which may run in another folder or on another machine."""
    here = Path(__file__).resolve().parent
    if any("freshet" in name for name in spark.sparkContext.listFiles):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/freshet", "zip", here.parent, here.name)
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session takes a temporary folder and
    remembers it; on a cluster no folder of one machine would do, so that raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder there that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="freshet-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run's state and output."""
    return f"{shared_dir(spark)}/freshet/{name}-{uuid.uuid4().hex[:12]}"
