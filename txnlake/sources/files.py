"""File sources and sinks: CSV in several encodings and in parallel, Excel, presets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.values import ENCODINGS
from txnlake.sources import quoted, workbook

PARALLEL_ABOVE = 256 << 20


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def size(spark: SparkSession, path: str) -> int:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def csv(spark: SparkSession, path: str, encoding: str = "UTF-8", one_line: bool = False, types: bool = False) -> DataFrame:
    """All columns as strings, or with types inferred; quotes are doubled.

    Fields may hold line breaks, which makes a file one task; with one_line they may not, and great files are split. quoted.scan splits
    files whose fields hold line breaks.
    """
    return spark.read.csv(path, header=True, multiLine=not one_line, escape='"', encoding=encoding, inferSchema=types)


def scan(spark: SparkSession, path: str, one_line: bool = False, types: bool = False) -> DataFrame:
    """A .csv or Excel export; CSV files beyond PARALLEL_ABOVE bytes are read in splits. A missing file is FileNotFoundError, another suffix ValueError."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    low = path.lower()
    if low.endswith(".csv"):
        if not one_line and not types and size(spark, path) > PARALLEL_ABOVE:
            return quoted.scan(spark, path)
        return csv(spark, path, one_line=one_line, types=types)
    if low.endswith((".xlsx", ".xls")):
        return workbook.scan(spark, path)
    raise ValueError(f"unsupported file: {path}")


def csv_any_encoding(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The file in the first encoding that reads without replacement characters."""
    for name in ENCODINGS:
        df = csv(spark, path, {"utf-8-sig": "UTF-8", "latin-1": "ISO-8859-1"}.get(name, name))
        if df.columns and df.columns[0].startswith("﻿"):
            df = df.withColumnRenamed(df.columns[0], df.columns[0].lstrip("﻿"))
        bad = F.exists(F.array(*[F.col(f"`{c}`") for c in df.columns]), lambda x: F.contains(x, F.lit("�")))
        if not any("�" in c for c in df.columns) and not df.where(bad).limit(1).count():
            return df, name
    raise ValueError(f"no encoding of {ENCODINGS} fits {path}")


def export_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """single: one file, written by one task, for reports; otherwise files whose names follow the order of the rows."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, header=True, escape='"')


def presets(path: str, template: str | None = None) -> dict[str, dict]:
    """Account presets of a YAML file, or of the template if it is missing. An empty or malformed mapping is ValueError."""
    import os

    import yaml

    with open(path if os.path.exists(path) or not template else template) as f:
        found = (yaml.safe_load(f) or {}).get("presets")
    if not isinstance(found, dict) or not found:
        raise ValueError("presets must be a mapping with an entry at least")
    for name, p in found.items():
        if not isinstance(p, dict) or not p.get("allowed_accounts"):
            raise ValueError(f"preset {name} has no allowed_accounts")
    return found
