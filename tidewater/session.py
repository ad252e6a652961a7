"""Session helpers.

The library never creates its own cluster settings beyond what a local run
needs: on a cluster the session is handed in by the caller and every value
set by the operator (shuffle partitions, checkpoint folder, AQE) is read from
it, not overridden.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", app: str = "tidewater", **conf: str) -> SparkSession:
    """Session for tests and the local benchmark (single JVM, no UI)."""
    settings = {**_LOCAL_DEFAULTS, **conf}
    if "spark.checkpoint.dir" not in settings:
        # Tests only: no shared folder is named, so take a fresh scratch one.
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a folder that all executors share")
    # Unset in a local session, as in tests: one machine, any folder is shared.
    path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint folder (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewater-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: cuts lineage, survives lost executors, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that functions of its modules can run there.

    Spark copies the archive from the driver to every executor; once per application.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidewater-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)
