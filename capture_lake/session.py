"""Session helpers: UTC zone, AQE, and the shared folder for written tables.

Nothing here builds a cluster; on a cluster the session comes from the
launcher and these helpers only read its settings.  A local session is made
only for tests, benches and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on.  AQE re-plans joins from real shuffle sizes
# (broadcast only when the built side proved small at runtime, skew split on
# hot keys), and the session zone pins `processed_at_day` to UTC days.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python workers are bounded by bytes as well as rows,
    # so a batch of large payloads (images, archives) stays small; a task has
    # several workers at once, and each holds its batch as Arrow and as Python values.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "capture_lake") -> SparkSession:
    """A local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs need to a session made elsewhere,
    and make the package importable in the Python workers."""
    for k, v in JOB_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # a static or locked setting: keep the launcher's value
            pass
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per local context.

    UDFs and extractors are pickled by reference to their module, so each
    Python worker must be able to import ``capture_lake``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        # On a cluster the package travels with the job (--py-files or an
        # installed wheel); only local sessions get it zipped here.
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="capture-lake-pyfiles-"), "capture_lake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Written tables and checkpoints go there, never to a machine-local folder.
    Only on a one-machine session without the setting (tests) a folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _one_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="capture-lake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, so a lost executor repeats nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one job's output."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
