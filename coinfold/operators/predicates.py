"""JSON predicates as Columns.

A predicate is a leaf ``{"field": path, "op": name, "value": literal}`` or a compound
``{"and": [...]}``, ``{"or": [...]}``, ``{"not": {...}}``. It becomes one Column before any
job starts; a malformed predicate raises :class:`PredicateError`.

Logic has two values: a leaf on a missing value is false, so its negation is true. In a
filter, null rows are dropped anyway, so leaves stay bare comparisons that reach the parquet
scan; only below ``not`` the missing case is spelled out.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from decimal import Context, Decimal
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinfold.functions.amounts import exact_decimal, sort_key
from coinfold.sources.csv import CSV, read_csv

# Names of the operators and texts that count as true.
COMPARISONS = ("lt", "le", "gt", "ge")
OPERATORS = (
    "eq", "ne", *COMPARISONS, "contains", "startswith", "endswith", "in", "regex", "exists",
)
TRUE_TEXTS = ("1", "true", "t", "yes", "y")
_NUMERIC = (T.IntegralType, T.DecimalType)
_WIDE = Context(prec=80)


class PredicateError(ValueError):
    """The predicate is malformed."""


@dataclass(frozen=True)
class Value:
    """A resolved path: the Column, and its type as far as the plan knows it. A path into a list may lead to what
    is made of the whole list."""

    column: Column
    dtype: T.DataType | None
    listed: bool = False


def matches(df: DataFrame, predicate: str | dict[str, Any]) -> Column:
    """Two-valued Column: true or false for every row."""
    return F.coalesce(_node(_load(predicate), _resolver(df), False), F.lit(False))


def where(df: DataFrame, predicate: str | dict[str, Any]) -> DataFrame:
    """Rows that satisfy the predicate, with comparisons the scan can use."""
    return df.where(_node(_load(predicate), _resolver(df), False))


def filter_ndjson(spark: SparkSession, source: str, target: str, predicate) -> None:
    """Filter newline-delimited items of any shape; kept lines are written as they were."""
    lines = spark.read.text(source).where(F.length(F.trim("value")) > 0)
    filter_lines(lines, predicate).write.mode("overwrite").text(target)


def filter_lines(lines: DataFrame, predicate, column: str = "value") -> DataFrame:
    """Lines of JSON text that satisfy the predicate; the text is parsed without schema."""
    document = F.parse_json(column)
    parsed = lines.withColumn("_document", document)
    node = _node(_load(predicate), lambda path: _variant(F.col("_document"), path), False)
    return parsed.where(node).drop("_document")


def filter_csv(spark: SparkSession, source: str, target: str, predicate) -> None:
    """Filter CSV with a header. All values are text, an empty field is the empty text."""
    kept = where(read_csv(spark, source), predicate)
    kept.write.mode("overwrite").options(**CSV, emptyValue="").csv(target)


# ---- structure ---------------------------------------------------------------------------


def _load(predicate: Any) -> Any:
    if not isinstance(predicate, str):
        return predicate
    try:
        return json.loads(predicate)
    except json.JSONDecodeError as error:
        raise PredicateError(f"predicate is no JSON: {error}") from error


def _node(node: Any, resolve, negated: bool) -> Column:
    if not isinstance(node, dict):
        raise PredicateError(f"predicate must be an object, not {type(node).__name__}")
    for name in ("and", "or"):
        if name in node:
            parts = node[name]
            if not isinstance(parts, list) or not parts:
                raise PredicateError(f"'{name}' needs a list with at least one predicate")
            columns = [_node(part, resolve, negated) for part in parts]
            # A negated conjunction is the disjunction of the negated parts.
            conjunction = (name == "and") != negated
            joined = columns[0]
            for column in columns[1:]:
                joined = joined & column if conjunction else joined | column
            return joined
    if "not" in node:
        return _node(node["not"], resolve, not negated)
    return _leaf(node, resolve, negated)


def _leaf(node: dict[str, Any], resolve, negated: bool) -> Column:
    path, op, literal = node.get("field"), node.get("op"), node.get("value")
    if not isinstance(path, str) or not path:
        raise PredicateError("'field' must be a non-empty text")
    if op not in OPERATORS:
        raise PredicateError(f"unknown op {op!r}, known are {', '.join(OPERATORS)}")
    if op == "regex":
        try:
            re.compile(str(literal))
        except re.error as error:
            raise PredicateError(f"regex {literal!r}: {error}") from error
    value = resolve(path.split("."))
    missing = F.lit(True) if value is None else value.column.isNull()
    if op == "exists":
        wanted = _wanted(literal) != negated
        return ~missing if wanted else missing
    if value is None:
        return F.lit(negated)

    def decided(value: Value) -> Column:
        test = _test(value, op, literal)
        return value.column.isNull() | ~test if negated else test

    # No scan can use a test on an element of a list. Bound, the list is made once, however often the test looks at it.
    return F.transform(F.array(value.column), lambda x: decided(Value(x, value.dtype)))[0] if value.listed else decided(value)


def _wanted(literal: Any) -> bool:
    if literal is None:
        return True
    if isinstance(literal, str):
        return literal.strip().lower() in TRUE_TEXTS
    return bool(literal)


# ---- paths -------------------------------------------------------------------------------


def _resolver(df: DataFrame):
    def resolve(path: list[str]) -> Value | None:
        dtype: T.DataType = df.schema
        column: Column | None = None
        listed = False
        for at, part in enumerate(path):
            if isinstance(dtype, T.StructType):
                if part not in dtype.names:
                    return None
                quoted = f"`{part}`"
                column = F.col(quoted) if column is None else column.getField(part)
                dtype = dtype[part].dataType
            elif isinstance(dtype, T.ArrayType):
                if not re.fullmatch(r"\s*[+-]?\d+\s*", part):
                    return None
                index = int(part)
                column = F.try_element_at(column, F.lit(index + 1 if index >= 0 else index))
                dtype, listed = dtype.elementType, True
            elif isinstance(dtype, T.MapType):
                column = F.try_element_at(column, F.lit(part))
                dtype = dtype.valueType
            elif isinstance(dtype, T.VariantType):
                return _variant(column, path[at:])
            else:
                return None
        return Value(column, dtype, listed)

    return resolve


def _variant(document: Column, path: list[str]) -> Value:
    """Path into a schemaless value. A numeric part is a key of an object or a position in
    an array; positions from the end need the array itself."""
    current = document
    for part in path:
        key = part.replace("\\", "\\\\").replace("'", "\\'")
        by_key = F.try_variant_get(current, f"$['{key}']", "variant")
        if re.fullmatch(r"\+?\d+", part):
            current = F.coalesce(by_key, F.try_variant_get(current, f"$[{int(part)}]", "variant"))
        elif re.fullmatch(r"-\d+", part):
            listed = F.try_variant_get(current, "$", "array<variant>")
            current = F.coalesce(by_key, F.try_element_at(listed, F.lit(int(part))))
        else:
            current = by_key
    absent = current.isNull() | F.is_variant_null(current)
    return Value(F.when(~absent, current), T.VariantType())


# ---- leaves ------------------------------------------------------------------------------


def _test(value: Value, op: str, literal: Any) -> Column:
    if op == "eq":
        return _equal(value, literal)
    if op == "ne":
        return ~_equal(value, literal)
    if op in COMPARISONS:
        return _compare(value, op, literal)
    if op == "in":
        if not isinstance(literal, list):
            return F.lit(False)
        found = F.lit(False)
        for one in literal:
            found = found | _equal(value, one)
        return found
    if op == "contains":
        return _contains(value, literal)
    text = _text(value)
    if op == "startswith":
        return text.startswith(_literal_text(literal))
    if op == "endswith":
        return text.endswith(_literal_text(literal))
    return text.rlike(str(literal))


def _contains(value: Value, literal: Any) -> Column:
    in_text = _text(value).contains(_literal_text(literal))
    if isinstance(value.dtype, T.ArrayType):
        inner = value.dtype.elementType
        same = F.exists(value.column, lambda x: _same_kind_equal(Value(x, inner), literal))
        return F.coalesce(same, F.lit(False))
    if isinstance(value.dtype, T.VariantType):
        listed = F.try_variant_get(value.column, "$", "array<variant>")
        same = F.exists(
            listed, lambda x: _same_kind_equal(Value(x, T.VariantType()), literal)
        )
        is_list = F.schema_of_variant(value.column).startswith("ARRAY")
        return F.when(is_list, F.coalesce(same, F.lit(False))).otherwise(in_text)
    return in_text


def _same_kind_equal(value: Value, literal: Any) -> Column:
    """Membership compares without converting between text and numbers."""
    if isinstance(value.dtype, T.VariantType):
        kind = F.schema_of_variant(value.column)
        is_text = kind == "STRING"
        if isinstance(literal, str):
            return is_text & (_text(value) == literal)
        return ~is_text & _equal(value, literal)
    if isinstance(value.dtype, T.StringType) != isinstance(literal, str):
        return F.lit(False)
    if isinstance(literal, str):
        return value.column == literal
    return _equal(value, literal)


def _equal(value: Value, literal: Any) -> Column:
    if literal is None:
        return F.lit(False)
    number = _literal_number(literal)
    if isinstance(value.dtype, T.BooleanType) and isinstance(literal, (bool, int, float)):
        return value.column.cast("int") == F.lit(literal).cast("double")
    if number is None:
        return _text(value) == _literal_text(literal)
    if isinstance(value.dtype, _NUMERIC):
        return _against(value, "eq", literal)
    by_text = _text(value) == _literal_text(literal)
    return _by_number(value, literal, number, lambda a, b: a == b, by_text)


def _compare(value: Value, op: str, literal: Any) -> Column:
    number = None if literal is None else _literal_number(literal)
    by_text = _ordered(_text(value), op, F.lit(_literal_text(literal)))
    if number is None:
        return by_text
    if isinstance(value.dtype, _NUMERIC):
        return _against(value, op, literal)
    return _by_number(value, literal, number, lambda a, b: _ordered(a, op, b), by_text)


_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _against(value: Value, op: str, literal: Any) -> Column:
    """An integer or decimal column against any number, as a bare comparison with a value of the column's
    own type, which the scan can use. Between two values of the column, the lower one is compared
    with; beyond its range the answer is the same for all that is there."""
    number = Decimal(str(literal).strip())
    if isinstance(value.dtype, T.DecimalType):
        scale = value.dtype.scale
        most = 10**value.dtype.precision - 1
        least = -most
    else:
        scale, most = 0, 2 ** (_BITS[type(value.dtype)] - 1) - 1
        least = -most - 1
    power = number.adjusted() + scale if number else 0
    if power > 40:
        at, exact = (least - 1 if number < 0 else most + 1), False
    elif power < -1:
        at, exact = (-1 if number < 0 else 0), False
    else:
        units = Fraction(number) * 10**scale
        at = units.numerator // units.denominator
        exact = at == units
    if at < least or at > most:
        above = op in ("lt", "le") if at > most else op in ("gt", "ge")
        return F.when(value.column.isNotNull(), F.lit(above))
    if not exact:
        if op == "eq":
            return F.when(value.column.isNotNull(), F.lit(False))
        op = {"lt": "le", "ge": "gt"}.get(op, op)
    kind = value.dtype.simpleString()
    bound = F.lit(at if scale == 0 and abs(at) < 2**63 else str(Decimal(at).scaleb(-scale, _WIDE))).cast(kind)
    return value.column == bound if op == "eq" else _ordered(value.column, op, bound)


def _by_number(value: Value, literal: Any, number: Column, test, by_text: Column) -> Column:
    """``test`` on the numbers: as exact decimals where both fit, else by their sort keys."""
    exact = _number(value)
    if exact is None:
        return by_text
    in_range = exact.isNotNull() & number.isNotNull()
    # Inside a lambda the long expression stays out of generated code, and in this branch it is
    # only reached by what is no exact decimal.
    far = F.transform(
        F.array(_number_text(value)), lambda text: test(sort_key(text), sort_key(F.lit(str(literal))))
    )[0]
    return F.when(in_range, test(exact, number)).otherwise(F.coalesce(far, by_text))


def _ordered(left: Column, op: str, right: Column) -> Column:
    return {"lt": left < right, "le": left <= right, "gt": left > right, "ge": left >= right}[op]


def _text(value: Value) -> Column:
    """The value as text; booleans read ``True`` and ``False`` as in the predicate's source."""
    column = value.column
    if isinstance(value.dtype, T.StringType):
        return column
    if isinstance(value.dtype, T.BooleanType):
        return F.when(column, "True").otherwise("False")
    if isinstance(value.dtype, T.VariantType):
        text = F.try_variant_get(column, "$", "string")
        is_flag = F.schema_of_variant(column) == "BOOLEAN"
        return F.when(is_flag, F.initcap(text)).otherwise(text)
    if isinstance(value.dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def _number(value: Value) -> Column | None:
    if isinstance(value.dtype, (T.BooleanType, T.StructType, T.ArrayType, T.MapType)):
        return None
    return exact_decimal(_number_text(value))


def _number_text(value: Value) -> Column:
    if isinstance(value.dtype, T.VariantType):
        return F.try_variant_get(value.column, "$", "string")
    return value.column.cast("string")


def _literal_text(literal: Any) -> str:
    return str(literal)


def _literal_number(literal: Any) -> Column | None:
    """The literal as a number when it reads as one. Whole numbers stay integers, so that a
    comparison with an integer column needs no cast."""
    if isinstance(literal, (bool, list, dict)):
        return None
    text = str(literal).strip()
    if re.fullmatch(r"[+-]?\d{1,18}", text):
        return F.lit(int(text))
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,17})?", text):
        return exact_decimal(F.lit(text))
    return None
