"""Session helpers: a test session, and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "ferrule") -> SparkSession:
    """A local session with the settings the engine is tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FERRULE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints.

    On a cluster it is the shared folder named in ``spark.checkpoint.dir``; only where that is unset,
    as in tests on one machine, a temporary folder is made.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="ferrule-checkpoint-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there on.

    Used where a result feeds several later steps: the files survive the loss of executors.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context, so that UDFs find it on any cluster."""
    sc = spark.sparkContext
    if getattr(sc, "_ferrule_shipped", False):
        return
    here = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="ferrule-package-")) / "ferrule.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(to))
    sc._ferrule_shipped = True
