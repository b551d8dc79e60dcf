"""Session helpers: shipping the package to executors, the shared folder, and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let executors import this package, as ``--py-files`` would; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="docketlake-")) / "docketlake.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(_PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only on a local master, as in tests, one of our own where it is unset;
    on a cluster that is an error, for executors would write to folders of their own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docketlake-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Paths made by ``scratch`` inside the innermost ``intermediate`` block.
_made: list[list[str]] = []


def _path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A new path in the shared folder, deleted when the application ends; without ``keep`` at the end of an ``intermediate`` block."""
    path = f"{shared_dir(spark)}/docketlake-{label}-{uuid.uuid4().hex}"
    jpath, store = _path(spark, path)
    store.deleteOnExit(jpath)
    if _made and not keep:
        _made[-1].append(path)
    return path


@contextmanager
def intermediate(spark: SparkSession):
    """Deletes the tables made inside when it ends; what shall outlive it has to be written with ``keep``."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            jpath, store = _path(spark, path)
            store.delete(jpath, True)


def written(df: DataFrame, label: str, keep: bool = False, rows: int = 0) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut and the rows survive lost executors. With ``rows``, files have so many at most: for large ones."""
    path = scratch(df.sparkSession, label, keep)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, sized_by: DataFrame, *keys: str, rows: int = 500_000) -> DataFrame:
    """``df`` by hash of ``keys`` in a partition for every so many rows of ``sized_by`` (a table as read: its files tell its rows), and as many as shuffles
    have at least. So what a task sorts or aggregates does not grow with the input, whatever the number of shuffle partitions."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sized_by.count() // rows))
    return df.repartition(n, *keys)


def sorted_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left`` and ``right`` joined by sorting both. Spark takes a Parquet table to be as large as its files, and where titles and keys repeat its rows are many times that:
    tables that grow with the input would be gathered in the driver and broadcast as long as their files are small."""
    return left.join(right.hint("merge"), on, how)
