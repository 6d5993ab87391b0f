"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "lamina", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job of this package relies on.

    AQE coalesces small partitions and splits skewed join partitions; on a
    cluster leave ``spark.sql.shuffle.partitions`` high (for instance three
    times the cores) and let AQE merge what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.compress", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Functions that run there import it, wherever the session was started and whether or not
    the package is installed on the workers.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lamina-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "lamina.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(at, name)
                out.write(path, os.path.join("lamina", os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and written layers, visible to all executors.

    Uses what the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of this machine, which goes
    when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="lamina-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has written."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have at most ``rows`` rows, in no more tasks than there are cores if these are few.

    Shuffles deal out as many partitions as the large tables need; the steps of a loop over a few
    links would else be thousands of tasks of a handful of rows each.
    """
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism) if rows <= BROADCAST_ROWS else df


def small_enough(df: DataFrame, text: str) -> bool:
    """True if a materialised lookup table may be broadcast: rows and text counted."""
    size = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")
    ).first()
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions on DataFrames made in here leave no shuffle files behind when they end.

    Without it these files stay until the driver happens to collect its garbage, so a loop of
    many small steps fills the disk with the files of all its rounds.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor cannot change it; its shuffle files go at once."""
    shared_folder(df.sparkSession)
    with short_lived_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
