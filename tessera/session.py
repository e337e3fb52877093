"""Session construction and checkpoint-directory discovery."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on.  AQE re-plans joins and
# coalesces shuffle partitions at run time; the session time zone is pinned
# so timestamps compare equal to the SQL oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the library.

    On a cluster pass ``master=None`` and let spark-submit decide; locally the
    checkpoint directory is created under a fresh temp folder (tests only).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it
    as is.  Only when nothing is configured *and* the master is local (tests,
    bench) do we create a private temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) visible to every executor"
        )
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, written once and read from there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers of a cluster, once per application.

    Functions that run in tasks are pickled by reference, so the workers must
    be able to import this package from wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-zip-"), "tessera.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.relpath(f, os.path.dirname(home)))
    sc.addPyFile(path)
    sc._tessera_shipped = True
