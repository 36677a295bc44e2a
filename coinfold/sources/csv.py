"""CSV whose quoted fields may hold line breaks, read by as many tasks as the files have splits.

Whether a line break ends a record depends on all quotes before it. So the lines of each split are counted first:
the parity of their quotes, summed over the splits of a file in order, tells each split whether it begins
inside a field. With that, each split finds its own records; only lines of records that span several are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Quotes are doubled inside quoted fields, which may hold line breaks; blanks are kept.
CSV = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",\n\r][^",\n\r]*+|)'
#: A record whose quotes stand around whole fields, and are doubled inside them.
_REGULAR = rf"(?s)^{_FIELD}(?:,{_FIELD})*+\r?$"


def read_csv(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """CSV with a header in every file; all values are text, and an empty or missing field is the empty text.

    Files without line breaks in fields are read by Spark's own reader, which splits them at lines. Files with
    quotes inside unquoted fields, which leave open where records end, are read whole, a task each.
    """
    whole = spark.read.options(**CSV, multiLine="true")
    schema = whole.csv(source).schema
    lines = _lines(spark, source)
    splits = _splits(lines)
    if not splits.where("odd").take(1):
        return spark.read.options(**CSV).schema(schema).csv(source).fillna("")
    records = _records(lines, splits)
    # in a file whose first line ends in CR LF all records do; the last one need not end at all
    ended = F.endswith("text", F.lit("\r"))
    mixed = (F.col("crlf") != ended) & ~(F.col("last") & F.col("crlf"))
    if records.where(mixed | ~F.col("text").rlike(_REGULAR)).take(1):
        return whole.schema(schema).csv(source).fillna("")
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
    text = F.when(ended, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    text = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    row = F.from_csv(text, columns, {**CSV, "header": "false", "multiLine": "true", "lineSep": "\n"})
    # rows keep the order of the files
    rows = records.where(~F.col("heads")).orderBy("file", "split", "first").select(row.alias("row"))
    return rows.select("row.*").fillna("")


def _lines(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """Lines with their file, split, place in it and number of quotes; line breaks are LF, a CR before stays."""
    return (
        spark.read.option("lineSep", "\n").text(source)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"), "value",
        )
        .withColumn("quotes", F.length("value") - F.length(F.translate("value", '"', "")))
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row for each split: whether it begins inside a field, whether any line is no record by itself, whether
    lines of the file end in CR LF, and the last line if that is in the split."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.endswith("value", F.lit("\r"))
    counted = lines.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"),
        F.bool_or(~F.col("value").rlike(_REGULAR)).alias("odd"),
        F.min_by(ended, "line").alias("crlf"),
        F.max(F.struct("line", ended.alias("ended"))).alias("final"),
        F.count_if(ended).alias("ended"),
        F.count("*").alias("lines"),
    )
    of_file = Window.partitionBy("file")
    last = F.col("split") == F.max("split").over(of_file)
    # a file of either kind of line end, but for its last line
    other = F.when(F.col("crlf"), F.col("lines") - F.col("ended") - (last & ~F.col("final.ended")).cast("int")).otherwise(F.col("ended"))
    return counted.select(
        "file", "split", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        (F.min_by("crlf", "split").over(of_file)).alias("crlf"),
        F.when(last, F.col("final.line")).alias("final"), (F.col("odd") | (other > 0)).alias("odd"),
    )


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """text of each record, whether it is the header of its file, the last one, and of a file with CR LF; and its place."""
    in_split = Window.partitionBy("file", "split").orderBy("line")
    before = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = (before + F.col("inside").cast("int")) % 2 == 1
    blank = F.col("value").isin("", "\r")
    placed = (
        lines.join(splits.drop("odd"), ["file", "split"])
        .withColumn("inside", inside)
        .where(F.col("inside") | ~blank)
        .withColumn("starts", ~F.col("inside"))
        .withColumn("closes", F.col("inside") == (F.col("quotes") % 2 == 1))
        .withColumn("record", F.sum(F.col("starts").cast("long")).over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
    )
    heads = ((F.col("split") == 0) & (F.col("record") == 1)).alias("heads")
    last = F.coalesce(F.col("line") == F.col("final"), F.lit(False)).alias("last")
    alone = F.col("starts") & F.col("closes")
    single = placed.where(alone).select(F.col("value").alias("text"), heads, last, "crlf", "file", "split", F.col("line").alias("first"))
    # the lines of a record, within a split
    joined = lambda parts: F.array_join(F.transform(F.sort_array(parts), lambda x: x["text"]), "\n")
    held = placed.where(~alone).withColumn("text", F.col("value"))
    pieces = held.groupBy("file", "split", "record").agg(
        joined(F.collect_list(F.struct("line", "text"))).alias("text"), F.bool_or("closes").alias("closed"),
        F.bool_or(last).alias("last"), F.first("crlf").alias("crlf"), F.min("line").alias("first"),
    )
    whole = F.col("closed") & (F.col("record") > 0)
    within = pieces.where(whole).select("text", heads, "last", "crlf", "file", "split", "first")
    # at most two pieces of a split go on in another one
    begun = F.sum((F.col("record") > 0).cast("long")).over(Window.partitionBy("file").orderBy("split", "record"))
    across = (
        pieces.where(~whole)
        .withColumn("begun", begun)
        .groupBy("file", "begun")
        .agg(joined(F.collect_list(F.struct("split", "record", "text"))).alias("text"), F.min(F.struct("split", "record", "first")).alias("at"),
             F.bool_or("last").alias("last"), F.first("crlf").alias("crlf"))
        .select("text", ((F.col("at.split") == 0) & (F.col("at.record") == 1)).alias("heads"), "last", "crlf", "file", "at.split", "at.first")
    )
    return single.unionByName(within).unionByName(across)
