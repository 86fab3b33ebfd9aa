"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``; a lost executor then costs a reread, never a recomputation
of everything before. Where the setting is absent, a session on one machine (tests) gets a temporary folder once; a cluster writes
beside its warehouse, which executors share.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_known: set[str] = set()
_tables: dict[int, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; another is set only where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("txnlake.local.checkpoint.dir", None)
    if not base:
        alone = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        base = "file://" + tempfile.mkdtemp(prefix="txnlake-") if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
        spark.conf.set("txnlake.local.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application's own; all of them are deleted when its JVM ends."""
    top = f"{shared_dir(spark)}/txnlake/{spark.sparkContext.applicationId}"
    if top not in _known:
        _known.add(top)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _tables[id(out)] = (weakref.ref(out), path)
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that `written` returned; nothing still to be computed may read them."""
    for df in tables:
        ref, path = _tables.pop(id(df), (None, None))
        if ref is None or ref() is not df:
            continue
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those asked for that df does not have, in any case of letters."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n in used:
            n += "_"
        used.add(n)
        out.append(n)
    return out
