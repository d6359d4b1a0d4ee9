"""Session helpers shared by tests, the benchmark and the operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = 8, app: str = "sparkvec", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; it is
    remembered in the session so that all callers see the same one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = spark.conf.get("sparkvec.local.dir", None)
    if not fallback:
        fallback = tempfile.mkdtemp(prefix="sparkvec-")
        spark.conf.set("sparkvec.local.dir", fallback)
    return fallback


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder the cluster already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, wherever they run.

    Spark copies the archive to every executor. Needed once per application
    unless the package is installed there.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="sparkvec-zip-"), "sparkvec_package")
        archive = shutil.make_archive(target, "zip", os.path.dirname(here), "sparkvec")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark
