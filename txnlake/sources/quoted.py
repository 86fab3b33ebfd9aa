"""CSV files whose fields may hold line breaks, read by many tasks.

A line break inside quotes doesn't end a record, and a split of a file does not know whether it starts inside quotes. So physical lines are
read in splits, and each line tells in which state, inside or outside, it ends for either state that it may start in. Such functions of two
states are composed along the lines of a split and then along a file's splits, of which there are few, and every line knows its state.
Lines that start and end outside are records; the others are joined up to the line that ends their record, wherever splits cut them.

Quotes are doubled within quotes; a quote that does not begin a field is a character like others. Line ends are those of a file's first
line; carriage returns before line feeds go with them, within quotes too. Blank lines are no records. Quotes that are never closed make the rest of the file one record.
"""

from __future__ import annotations

import csv as python_csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.functions.store import written

MARK = "﻿"


def ends_inside(line: Column, delimiter: str = ",") -> Column:
    """Whether a line that starts outside quotes, at a field's start, ends inside them."""
    d = "\\" + delimiter
    whole = rf'(?:"[^"]*+(?:""[^"]*+)*+"[^{d}]*+|[^"{d}][^{d}]*+)?+'
    return line.rlike(rf'(?s)^(?:{whole}{d})*+"[^"]*+(?:""[^"]*+)*+$')


def _state(values: Column, swaps: Column, start: Column) -> Column:
    """The state after some lines: the last that was forced, turned by the swaps since; without a forced one, the start's."""
    return F.when(values.isNull(), (start + swaps) % 2).otherwise((values["to"] + swaps - values["swaps"]) % 2)


def records(spark: SparkSession, path: str, delimiter: str = ",", split_bytes: int | None = None) -> DataFrame:
    """(file, start, line, record): every record of the files with the split and place of its first line, which order those of a file.

    split_bytes: the size of splits, by default the session's.
    """
    reader = spark.read.option("lineSep", "\n")
    key, before = "spark.sql.files.maxPartitionBytes", None
    if split_bytes:
        before = spark.conf.get(key)
        spark.conf.set(key, str(split_bytes))
    try:
        lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"))
        lines = lines.withColumns({"to0": ends_inside(F.col("text"), delimiter).cast("int"), "to1": ends_inside(F.concat(F.lit('"'), "text"), delimiter).cast("int")})
        lines = written(lines, "lines")
    finally:
        if before:
            spark.conf.set(key, before)
    along = Window.partitionBy("file", "start").orderBy("line")
    swap = ((F.col("to0") == 1) & (F.col("to1") == 0)).cast("long")
    lines = lines.withColumn("swaps", F.sum(swap).over(along))
    forced = F.when(F.col("to0") == F.col("to1"), F.struct(F.col("to0").alias("to"), "swaps"))
    lines = lines.withColumn("forced", F.last(forced, ignorenulls=True).over(along))
    # a row for each split: how it turns the state, and so in which state it starts
    splits = lines.groupBy("file", "start").agg(F.max_by("forced", "line").alias("forced"), F.max("swaps").alias("total"), F.min_by(F.endswith("text", F.lit("\r")), "line").alias("crlf"))
    over = Window.partitionBy("file").orderBy("start")
    splits = splits.withColumn("sum", F.sum("total").over(over))
    fixed = F.when(F.col("forced").isNotNull(), F.struct(((F.col("forced.to") + F.col("total") - F.col("forced.swaps")) % 2).alias("to"), F.col("sum").alias("swaps")))
    splits = splits.withColumn("last", F.last(fixed, ignorenulls=True).over(over))
    end = _state(F.col("last"), F.col("sum"), F.lit(0))
    splits = splits.select("file", "start", F.coalesce(F.lag(end).over(over), F.lit(0)).alias("enters"), F.first("crlf").over(over).alias("crlf"))
    lines = lines.join(splits, ["file", "start"])
    after = _state(F.col("forced"), F.col("swaps"), F.col("enters"))
    lines = lines.withColumn("inside_after", after).withColumn("inside", F.coalesce(F.lag("inside_after").over(along), F.col("enters")))
    text = F.when(F.col("crlf"), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text")).alias("text")
    lines = written(lines.select("file", "start", "line", text, "inside", "inside_after"), "states")
    single = lines.where("inside = 0 AND inside_after = 0").select("file", "start", "line", F.col("text").alias("record"))
    # the others: runs from a line that opens quotes to the one that closes them; runs may cross splits, so they are counted over a file
    several = lines.where("inside = 1 OR inside_after = 1")
    opened = several.groupBy("file", "start").agg(F.count_if(F.col("inside") == 0).alias("n"))
    earlier = opened.select("file", "start", F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    run = F.sum(F.when(F.col("inside") == 0, 1).otherwise(0)).over(along) + F.col("before")
    runs = several.join(earlier, ["file", "start"]).withColumn("run", run)
    each = F.sort_array(F.collect_list(F.struct("start", "line", "text")))
    joined = runs.groupBy("file", "run").agg(each.alias("parts"))
    joined = joined.select("file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["line"].alias("line"), F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("record"))
    return single.unionByName(joined).where(F.col("record") != "")


def scan(spark: SparkSession, path: str, delimiter: str = ",", split_bytes: int | None = None) -> DataFrame:
    """The files' rows under the names in their first record, all as strings; of several files each has the same header."""
    every = records(spark, path, delimiter, split_bytes)
    place = F.struct("start", "line")
    heads = every.groupBy("file").agg(F.min(place).alias("head"))
    first = every.join(heads, "file").where(place == F.col("head")).orderBy("file").select("record").first()
    if first is None:
        return spark.createDataFrame([], "value string")
    names = next(python_csv.reader(io.StringIO(first.record.lstrip(MARK)), delimiter=delimiter))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = every.join(heads, "file").where(place != F.col("head"))
    return rows.select(F.from_csv("record", schema, {"escape": '"', "sep": delimiter, "multiLine": "true"}).alias("r")).select("r.*")
