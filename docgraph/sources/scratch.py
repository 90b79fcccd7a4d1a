"""Tables in the folder that all executors share (``spark.checkpoint.dir``).

Operators cut lineage by writing a table there and reading it back, so a lost
executor costs only the tasks it was running. Where the setting is absent a temporary
folder takes its place in local mode only: on a cluster no machine's own folder would do.
What an operator returns may still be read from there, so nothing is deleted before
:func:`clear` is called.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders and tables of a session (by its application's id) that nobody has cleared yet.
_FOLDERS: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def on_one_machine(master: str) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def shared_root(spark: SparkSession) -> str:
    """The shared folder; in local mode set on the session first if nobody has."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not on_one_machine(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="docgraph-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, operator: str) -> str:
    """A folder of its own for one run of an operator."""
    folder = f"{shared_root(spark)}/docgraph/{operator}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear(spark: SparkSession) -> None:
    """Delete all folders and tables that operators of this session have written: their results must have been used."""
    session = spark.sparkContext.applicationId
    for table in _TABLES.pop(session, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    jvm = spark.sparkContext._jvm
    for folder in _FOLDERS.pop(session, []):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``folder`` and return the table read back."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, folder: str, name: str, buckets: int, *keys: str, codec: str = "snappy") -> DataFrame:
    """As :func:`materialise`, bucketed by ``keys``: later joins on them need no shuffle."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", f"{folder}/{name}")
        .option("compression", codec)
        .saveAsTable(table)
    )
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
