"""Tables that cut lineage, kept in the folder all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one in local mode only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='cornice-')}"
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/cornice/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


#: Paths made inside each open scope, innermost last.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scope(spark: SparkSession):
    """Deletes what materialize() and new_path() made inside, but for the paths taken out of the list it gives."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.pop()
        for path in made:
            drop(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    Later steps then never recompute what df was made from, also after an
    executor is lost, since the files outlive executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's API, so that it works on any store."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tasks_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """How many partitions give each about per_task rows, at least the session's number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // per_task))
