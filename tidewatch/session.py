"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "tidewatch",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the engine assumes.

    * session time zone UTC: every producer writes UTC and outputs are kept
      as TIMESTAMP_NTZ wall-clock values;
    * AQE on, so small sides are broadcast only when their *runtime* size is
      under the threshold, skewed shuffle partitions are split, and
      post-shuffle partitions are coalesced;
    * no web UI.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session.  Only a local master without the setting (tests)
    gets a private folder; on a cluster executors would not see one, so the
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver "
                                   "and all executors share")
            current = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder (URI) of the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(path: str) -> None:
    """Delete a folder of :func:`scratch_path` that nothing reads any more.  A file
    system that pyarrow cannot open keeps it."""
    import pyarrow as pa
    from pyarrow.fs import FileSystem
    try:
        fs, at = FileSystem.from_uri(path)
        fs.delete_dir(at)
    except (pa.ArrowException, OSError):
        pass
