"""Session helpers: the shared scratch folder and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``. A session on local threads that names none
    gets a fresh local folder; any other raises, as its executors could not read that.
    """
    sc = spark.sparkContext
    named = sc.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Rows that one task of ``spread`` takes, about, where the number of all rows is given.
TASK_ROWS = 1_000_000


def spread(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Deal rows by ``keys`` over at least two tasks a core, whatever files they come from; adaptive plans keep that number.

    With ``rows``, the number of all rows, tasks are so many that what one of them holds does not grow with the table.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(tasks, *keys)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: what follows reads committed files, so a lost
    executor costs no more than the tasks that it was running. The files go when
    the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallyseq-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)
