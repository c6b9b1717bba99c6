"""Sessions, and what Python workers need to find this package."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: Parts that one step is dealt to at most.
MOST_TASKS = 2000


def share_path(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed on the workers or sent with
    --py-files; then this changes nothing.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = ":".join([ROOT, *parts])
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine with the settings that the tests and the bench use."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cornice")
    options = {
        "spark.sql.shuffle.partitions": shuffle_partitions,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in options.items():
        builder = builder.config(key, str(value))
    return share_path(builder.getOrCreate())


def cut(df: DataFrame) -> DataFrame:
    """df written once to the checkpoint folder, so that steps which use it more than once don't work it out each time.

    The folder is the one that spark.checkpoint.dir names; in local mode without it, a temporary one.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        found = sc.getConf().get("spark.checkpoint.dir")
        if not found and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(found or f"file://{tempfile.mkdtemp(prefix='cornice-')}")
    return df.checkpoint()


def tasks_for(df: DataFrame, rows: int = 1 << 12) -> int:
    """In how many tasks df is worked on: about so many rows each, and no fewer than there are cores."""
    return min(MOST_TASKS, max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """df dealt out evenly, or by keys, in a number of tasks that grows with its rows.

    A small file is read by one task, whatever its rows become afterwards: pages, nodes, cells,
    lines.  What is dealt by a key stays so while its rows come apart, for windows and groups.
    """
    return df.repartition(tasks or tasks_for(df), *keys)
