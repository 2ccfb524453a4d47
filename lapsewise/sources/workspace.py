"""Tables written once and read several times.

A plan that is read more than once is written as Parquet in the folder that the cluster names in
``spark.checkpoint.dir``. The table survives lost executors, cuts the lineage and gives later
joins real sizes. A machine-local folder is used only when Spark itself runs in local mode and
nothing is configured.

Results are lazy and read these tables, so they live as long as the application; ``release`` drops
all tables of the application when its results have been read.
"""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_DIRS:
        path = tempfile.mkdtemp(prefix="lapsewise-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _LOCAL_DIRS[context.applicationId] = path
    return _LOCAL_DIRS[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{owned_dir(spark)}/{name}-{uuid.uuid4().hex}"


def owned_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lapsewise/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Drop every table that this application has written here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(owned_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the rows once and return a DataFrame that scans the written table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
