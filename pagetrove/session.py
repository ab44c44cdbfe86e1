"""Small helpers around the running Spark session."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, whose Python workers run parts of it, and bound the Arrow
    batches they get by bytes as well as by rows, as some texts are very long."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root, name = os.path.split(_PACKAGE)
    # The driver serves this file to executors as long as the application runs.
    base = os.path.join(tempfile.mkdtemp(prefix="pagetrove-"), name)
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, name))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for one intermediate table.

    The folder lies under ``spark.checkpoint.dir``, which every executor of the cluster can reach, so
    what is written there outlives the executor that wrote it. Without that setting it lies in the
    warehouse folder, if there is one machine only; on a cluster the setting has to be there.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder, such as an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put one folder in the place of another.

    The old folder is set aside, not deleted, until the new one is in its place; if that fails it goes
    back, and an error tells so.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = f"{target.rstrip('/')}-old-{uuid.uuid4().hex}"
    had = system.exists(path(target))
    if had and not system.rename(path(target), path(aside)):
        raise OSError(f"{target} could not be set aside")
    try:
        if not system.rename(path(source), path(target)):
            raise OSError(f"{source} could not be moved to {target}")
    except BaseException:
        if had and not system.rename(path(aside), path(target)):
            raise OSError(f"{source} could not be moved to {target}, whose old content is in {aside}")
        raise
    if had:
        system.delete(path(aside), True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Results that still read them are lost."""
    drop_folder(spark, _scratch_root(spark))


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once and go on from the written table, so that further uses do
    not compute it again and a lost executor does not take it along."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that has fewer splits than the cluster has cores.

    A large table has more splits than cores and comes back as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read the named columns of one Parquet table of a folder."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
