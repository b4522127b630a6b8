"""Session settings and table access shared by queries, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tallyloom") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be a file or a folder on any Spark file system."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Only where that is unset, and all runs in one process (as in tests), a folder of its own serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        base = f"file://{tempfile.mkdtemp(prefix='tallyloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Paths that this driver has handed out and not yet removed.
_FRESH: list[str] = []


def fresh_path(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nothing has used; clear_fresh removes it."""
    import uuid

    path = f"{shared_dir(spark)}/tallyloom/{what}-{uuid.uuid4().hex}"
    _FRESH.append(path)
    return path


def clear_fresh(spark: SparkSession) -> int:
    """Remove all paths of fresh_path, once the results that read them have been written."""
    n = len(_FRESH)
    while _FRESH:
        at = spark._jvm.org.apache.hadoop.fs.Path(_FRESH.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage in the session's checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session; a session that has it is left alone."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_tallyloom_shipped", False):
        return
    top = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / "tallyloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(str(target))
    context._tallyloom_shipped = True
