"""Session settings and the shared work folder."""

import gc
import uuid
from contextvars import ContextVar
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

#: Paths written within the innermost function marked by ``drops_written``.
_MADE = ContextVar("made", default=None)

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name="trendmill", master=None, **conf):
    """Session with UTC time, AQE and skew handling on; everything else is the cluster's choice."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Keeps the state of streaming dedup off the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder every executor can reach, as named by the session in ``spark.checkpoint.dir``.

    Without that setting it is a folder in the session's warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    context.setCheckpointDir(f"{warehouse}/_scratch")
    return context.getCheckpointDir()


def work_path(spark, label):
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def passing_path(spark, label):
    """As ``work_path``, for what goes when the function around it ends that is marked by ``drops_written``."""
    path = work_path(spark, label)
    if _MADE.get() is not None:
        _MADE.get().append(path)
    return path


def written(df, label):
    """The rows of ``df`` read back from a parquet table in the shared folder.

    Cuts the lineage and gives later steps measured sizes. A lost executor costs nothing, as the
    table outlives it. The table stays until the folder is cleaned, or until the function that wrote
    it ends if that is marked by ``drops_written``.
    """
    path = passing_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_written(read, path):
    """``read(path)``, or None when nothing has been written there yet."""
    try:
        return read(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def path_bytes(spark, path):
    """Bytes of the files below a path."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def release_shuffles(spark):
    """Frees the disk of shuffles that no DataFrame needs any more.

    Spark removes their files when the driver collects garbage, which a driver with little to do hardly ever does.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_shuffles(rows):
    """Frees the disk of the shuffles that a micro-batch was computed by, once it is stored and not read again.

    The stream itself holds on to them until a later micro-batch, or its end.
    """
    rows._jdf.logicalPlan().rdd().cleanShuffleDependencies(False)


def delete_path(spark, path):
    """Removes a file or folder through Spark's file system; True if there was one."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def partition_values(spark, path, column):
    """Values of a table's outermost partition column, as text, from the names of its folders alone."""
    context = spark.sparkContext
    names = context._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(target)
    folders = [f.getPath().getName() for f in listed if f.isDirectory()]
    return sorted(names.unescapePathName(f.split("=", 1)[1]) for f in folders if f.startswith(f"{column}="))


def delete_partition(spark, path, column, value):
    """Removes the folder of one partition; ``value`` is its text as Spark casts it, or None."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return delete_path(spark, f"{path}/{names.getPartitionPathString(column, value)}")


def drops_written(function):
    """Marks a function of a session whose result no longer reads what it has ``written``."""

    @wraps(function)
    def run(spark, *args, **kwargs):
        made = []
        outer = _MADE.set(made)
        try:
            return function(spark, *args, **kwargs)
        finally:
            _MADE.reset(outer)
            for path in made:
                delete_path(spark, path)

    return run
