"""Raw nested blocks: landed JSON files or JSON text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinfold.schemas import CORRUPT, RAW_BLOCK, RAW_TX
from coinfold.session import KEPT_COMPRESSION, dropping_shuffles

DEFAULT_BUCKET = 10_000


def read_raw_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan newline-delimited raw blocks.

    Number tokens are read into text, so amounts keep every digit the file has. Blocks
    with an element of an unexpected kind keep what can be used of them, see
    :func:`recover_malformed`; lines that are no block keep their text in
    ``_corrupt_record``.
    """
    reader = spark.read.schema(_with_corrupt()).option("columnNameOfCorruptRecord", CORRUPT)
    return recover_malformed(reader.json(path))


def raw_block_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """The same scan as a stream over a landing folder."""
    reader = (
        spark.readStream.schema(_with_corrupt())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files)
    )
    return recover_malformed(reader.json(path))


def parse_raw_blocks(df: DataFrame, text: str = "value") -> DataFrame:
    """Raw blocks from a text column, for topics and tables.

    Parsing text takes numbers through doubles, so fractional number tokens are quoted
    first: as text they keep every digit.
    """
    parsed = F.from_json(
        F.expr(_quoted(f"`{text}`")), _with_corrupt(), {"columnNameOfCorruptRecord": CORRUPT}
    )
    rows = df.select(F.col(text).alias("_text"), parsed.alias("_block"))
    return recover_malformed(
        rows.selectExpr(
            *[f"_block.{name}" for name in RAW_BLOCK.names],
            f"if(_block.{CORRUPT} IS NULL, null, _text) AS {CORRUPT}",
        )
    )


def recover_malformed(df: DataFrame) -> DataFrame:
    """Rebuild blocks that the typed parser gave up on.

    One element of the wrong kind makes the typed parser drop the whole array around it.
    For such rows the arrays are rebuilt from the schemaless value: objects are kept,
    anything else becomes null at its position, transactions given as a plain id go to
    ``bare_txid``. Other rows only test one column.
    """
    # The lambda keeps the large rebuild expression out of generated code.
    document = f"try_parse_json({_quoted(CORRUPT)})"
    rebuilt = f"transform(array({document}), block_ -> {_shape('block_', RAW_BLOCK)})[0]"
    with_rebuilt = df.selectExpr("*", f"if({CORRUPT} IS NULL, null, {rebuilt}) AS _rebuilt")
    chosen = [f"if({CORRUPT} IS NULL, {n}, _rebuilt.{n}) AS {n}" for n in RAW_BLOCK.names]
    # What stays broken: text that is no object, or an object without a hash.
    return with_rebuilt.selectExpr(
        *chosen, f"if(_rebuilt.hash IS NULL, {CORRUPT}, null) AS {CORRUPT}"
    )


def height_range(df: DataFrame, start: int, end: int, column: str = "height") -> DataFrame:
    """Blocks with ``start <= height <= end``; reversed bounds are an error."""
    if start > end:
        raise ValueError(f"start {start} lies behind end {end}")
    return df.where(F.col(column).between(start, end))


def clamped_range(start: int | None, end: int | None, head: int) -> tuple[int, int]:
    """Ingest bounds: never below zero, an end before the start means the start."""
    first = max(0, 1 if start is None else start)
    return first, max(first, head if end is None else end)


def tail(df: DataFrame, blocks: int, column: str = "height") -> DataFrame:
    """Blocks of the last ``blocks`` heights up to the highest one. The highest height is
    asked for first, so that the filter is a constant the scan can use."""
    head = df.agg(F.max(column)).first()[0]
    if head is None:
        return df
    return df.where(F.col(column) > max(-1, head - max(1, blocks)))


def with_height_bucket(
    df: DataFrame, column: str = "height", size: int = DEFAULT_BUCKET
) -> DataFrame:
    bucket = F.floor(F.col(column) / F.lit(size)).cast("bigint")
    return df.withColumn("height_bucket", F.coalesce(bucket, F.lit(-1).cast("bigint")))


def land_raw_blocks(df: DataFrame, path: str, bucket_size: int = DEFAULT_BUCKET) -> None:
    """Keep parsed raw blocks as parquet below height buckets.

    Text is parsed once; the four tables then read only the nested fields they use, and a
    height range only opens its buckets.
    """
    bucketed = with_height_bucket(df, "height", bucket_size).hint("rebalance", "height_bucket")
    with dropping_shuffles(df.sparkSession):
        bucketed.write.mode("overwrite").partitionBy("height_bucket").parquet(path, compression=KEPT_COMPRESSION)


def _with_corrupt() -> T.StructType:
    return T.StructType([*RAW_BLOCK.fields, T.StructField(CORRUPT, T.StringType())])


def _quoted(text: str) -> str:
    """SQL that turns fractional number tokens into text tokens, except for the fields that
    are doubles.

    The text is read once from left to right, in whole text tokens, so nothing is looked for behind a
    place: a name with such a number behind it is one match, any other text token one that stays as it is.
    """
    inside = r'(?:[^"\\]++|\\.)*+'
    number = r"-?[0-9]+(?:\.[0-9]+(?:[eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)"
    doubles = '(?!(?:vsize|discountvsize|difficulty)")'
    # The first group is a quote: it is there only where a number was found, and is set around it.
    named = rf'(")({doubles}{inside})"(\s*+:\s*+)({number})(?=\s*[,}}\]])'
    other = f'("{inside}")'
    return f"regexp_replace({text}, r'(?s){named}|{other}', '$1$2$1$3$1$4$1$5')"


def _shape(value: str, dtype: T.StructType) -> str:
    """SQL for a schemaless object in the form of a struct type, null for anything else.

    Text, because one parsed expression is far quicker to build than thousands of calls.
    """
    fields = {f.name: _field(value, f.name, f.dataType) for f in dtype.fields}
    usable = f"startswith(schema_of_variant({value}), 'OBJECT')"
    if dtype == RAW_TX:
        is_text = f"schema_of_variant({value}) = 'STRING'"
        fields["bare_txid"] = f"if({is_text}, try_variant_get({value}, '$', 'string'), null)"
        usable = f"({usable} OR {is_text})"
    listed = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    return f"if({usable}, named_struct({listed}), null)"


def _field(value: str, name: str, dtype: T.DataType) -> str:
    # Lambda variables are named after the field they walk into, so that none hides another.
    if isinstance(dtype, T.StructType):
        inner = f"try_variant_get({value}, '$.{name}', 'variant')"
        return f"transform(array({inner}), {name}_ -> {_shape(f'{name}_', dtype)})[0]"
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        inner = f"try_variant_get({value}, '$.{name}', 'array<variant>')"
        return f"transform({inner}, {name}_ -> {_shape(f'{name}_', dtype.elementType)})"
    return f"try_variant_get({value}, '$.{name}', '{dtype.simpleString()}')"
