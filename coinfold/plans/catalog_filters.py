"""Catalog: predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinfold.operators import predicates
from coinfold.plans import ledger_view as view
from coinfold.plans.catalog import LINE, query, with_views
from coinfold.session import shared_dir

_VALUE = "CASE WHEN NOT hidden THEN CAST(kept AS VARCHAR) END"
_SEEN = with_views(LINE).rstrip() + f", seen AS (SELECT id, height, asset, {_VALUE} AS value, pegin, " \
    "l_quantity, l_linenumber, payload FROM line) "
_PICK = "SELECT id, height, value FROM seen WHERE "


def _seen(spark, sf):
    lines = view.with_line_columns(view.spread(view.table(spark, sf, "lineitem")))
    return lines.select(
        "id", "height", "asset", F.when(~F.col("hidden"), F.col("kept").cast("string")).alias(
            "value"), "pegin", "l_quantity", "l_linenumber", "payload",
    )


def _where(spark, sf, predicate):
    return predicates.where(_seen(spark, sf), predicate).select("id", "height", "value")


_NUM = "CAST(value AS DECIMAL(38,18))"


@query(
    "Q1 Q3",
    _SEEN + _PICK + f"NOT coalesce({_NUM} >= 20000, false) AND NOT (coalesce(asset = 'a1', false)"
    " OR coalesce(height < 4000, false))",
)
def filter_logic_on_missing(spark, sf):
    """A comparison with a missing value is false, so its negation holds."""
    return _where(
        spark, sf,
        {"and": [
            {"not": {"field": "value", "op": "ge", "value": 20000}},
            {"not": {"or": [{"field": "asset", "op": "eq", "value": "a1"},
                            {"field": "height", "op": "lt", "value": 4000}]}},
        ]},
    )


@query(
    "Q1",
    _SEEN + f"SELECT id, coalesce({_NUM} < 30000 OR pegin, false) AS kept FROM seen",
)
def filter_as_column(spark, sf):
    seen = _seen(spark, sf)
    test = predicates.matches(
        seen,
        '{"or": [{"field": "value", "op": "lt", "value": "30000.0"},'
        ' {"field": "pegin", "op": "eq", "value": true}]}',
    )
    return seen.select("id", test.alias("kept"))


@query(
    "Q2",
    _SEEN + _PICK + "l_quantity = 7 OR asset = 'a3' OR TRY_CAST(payload AS DOUBLE) = 10 OR"
    f" (value IS NOT NULL AND {_NUM} <> 0 AND height = 12)",
)
def filter_equality(spark, sf):
    """Numbers equal by value, whatever their text; other text by text."""
    return _where(
        spark, sf,
        {"or": [
            {"field": "l_quantity", "op": "eq", "value": "7.00"},
            {"field": "asset", "op": "eq", "value": "a3"},
            {"field": "payload", "op": "eq", "value": "10"},
            {"and": [{"field": "value", "op": "ne", "value": 0},
                     {"field": "height", "op": "eq", "value": "12"}]},
        ]},
    )


@query(
    "Q2",
    _SEEN + _PICK + f"value IS NOT NULL AND {_NUM} <> 5000 AND asset <> 'a3'",
)
def filter_inequality(spark, sf):
    return _where(
        spark, sf,
        {"and": [{"field": "value", "op": "ne", "value": 5000},
                 {"field": "asset", "op": "ne", "value": "a3"}]},
    )


@query(
    "Q3",
    _SEEN + _PICK + f"{_NUM} > 1000.5 AND {_NUM} <= 45000 AND asset >= 'a4'"
    " AND payload < 'zz'",
)
def filter_order(spark, sf):
    """Text compares as numbers when both sides are numbers, otherwise by letters."""
    return _where(
        spark, sf,
        {"and": [
            {"field": "value", "op": "gt", "value": 1000.5},
            {"field": "value", "op": "le", "value": "45000"},
            {"field": "asset", "op": "ge", "value": "a4"},
            {"field": "payload", "op": "lt", "value": "zz"},
        ]},
    )


@query(
    "Q2 Q3 Q6",
    _SEEN + "SELECT id, height FROM seen WHERE height > 3000 AND height < 30000 AND NOT (height IN (4000, 4001))"
    " AND l_linenumber >= 2 AND l_linenumber <> 3 AND l_quantity > 12",
)
def filter_far_numbers_on_integers(spark, sf):
    """Integer, decimal and double columns against numbers beyond their range and between their values."""
    wide = _seen(spark, sf).withColumns(
        {"small": F.col("l_linenumber").cast("tinyint"), "fixed": F.col("l_quantity").cast("decimal(6,2)")}
    )
    leaf = lambda field, op, value: {"field": field, "op": op, "value": value}
    tests = [
        leaf("height", "lt", 1e30), leaf("height", "gt", -1e30), leaf("height", "ne", 1e30),
        leaf("height", "lt", 10**25), leaf("height", "gt", "1e-25"), leaf("height", "gt", "3000.5"),
        leaf("height", "le", "29999.999"), {"not": leaf("height", "in", ["4000.0", 4001, 1e25, "1e-25", "4002.5"])},
        {"not": leaf("height", "ge", "9223372036854775808")}, {"not": leaf("height", "eq", "1e99999999999")},
        leaf("small", "gt", "1.0000000000000000000000001"), leaf("small", "lt", 300), leaf("small", "ne", "3.00"),
        {"not": leaf("small", "lt", -129)}, leaf("fixed", "gt", "12.0000001"), leaf("fixed", "lt", "1e400"),
        {"not": leaf("fixed", "eq", "13.005")}, leaf("l_quantity", "gt", "1e-400"), {"not": leaf("l_quantity", "ge", "1e400")},
    ]
    return predicates.where(wide, {"and": tests}).select("id", "height")


@query(
    "Q4 Q5",
    _SEEN + _PICK + "contains(value, '99') AND starts_with(payload, '0000')"
    " AND (ends_with(value, '00') OR ends_with(CAST(height AS VARCHAR), '7'))",
)
def filter_text(spark, sf):
    return _where(
        spark, sf,
        {"and": [
            {"field": "value", "op": "contains", "value": 99},
            {"field": "payload", "op": "startswith", "value": "0000"},
            {"or": [{"field": "value", "op": "endswith", "value": "00"},
                    {"field": "height", "op": "endswith", "value": 7}]},
        ]},
    )


@query(
    "Q6 Q7 Q8",
    _SEEN + _PICK + "(asset IN ('a1', 'a2') OR l_linenumber IN (3, 4))"
    " AND regexp_matches(payload, '[0-9]{2}[a-f]') AND value IS NOT NULL",
)
def filter_membership_and_regex(spark, sf):
    return _where(
        spark, sf,
        {"and": [
            {"or": [{"field": "asset", "op": "in", "value": ["a1", "a2"]},
                    {"field": "l_linenumber", "op": "in", "value": ["3", 4.0]}]},
            {"field": "payload", "op": "regex", "value": "[0-9]{2}[a-f]"},
            {"field": "value", "op": "exists"},
        ]},
    )


@query("Q8", _SEEN + _PICK + "value IS NULL")
def filter_missing(spark, sf):
    return _where(
        spark, sf,
        {"and": [{"field": "value", "op": "exists", "value": "false"},
                 {"field": "nowhere.0.x", "op": "exists", "value": False}]},
    )


@query(
    "Q9 Q4",
    with_views(LINE) + "SELECT 't' || id AS txid FROM line WHERE NOT hidden AND price > 30000"
    " AND l_quantity > 10",
)
def filter_items_by_path(spark, sf):
    """Dotted paths into the arrays of transaction items."""
    from coinfold.operators import items

    made = items.transaction_items(view.raw_blocks(spark, sf))
    return predicates.where(
        made,
        {"and": [
            {"field": "inputs.0.value", "op": "gt", "value": 30000},
            {"field": "inputs.-1.addresses", "op": "contains", "value": "second"},
            {"field": "outputs.7.value", "op": "exists", "value": False},
            {"field": "virtual_size", "op": "gt", "value": 10.5},
        ]},
    ).select("txid")


@query(
    "Q9",
    """SELECT event_id, props FROM events
    WHERE CAST(json_extract(props, '$.k') AS INTEGER) >= 50
      AND NOT CAST(json_extract(props, '$.k') AS INTEGER) IN (60, 70)""",
)
def filter_schemaless(spark, sf):
    events = view.table(spark, sf, "events").select("event_id", "props")
    return predicates.filter_lines(
        events,
        {"and": [{"field": "k", "op": "ge", "value": 50},
                 {"not": {"field": "k", "op": "in", "value": [60, "70"]}},
                 {"field": "k.x", "op": "exists", "value": False}]},
        "props",
    )


@query(
    "Q10 S4 S6",
    """SELECT event_id, user_id, event_type FROM events
    WHERE user_id >= 20 AND event_type IN ('click', 'view')""",
)
def filtered_ndjson(spark, sf):
    """Write items, filter the file, read what was kept."""
    source, target = shared_dir(spark, "items"), shared_dir(spark, "kept")
    columns = "event_id", "user_id", "event_type", "props"
    view.table(spark, sf, "events").select(*columns).write.mode("overwrite").json(source)
    predicates.filter_ndjson(
        spark, source, target,
        '{"and": [{"field": "user_id", "op": "ge", "value": "20"},'
        ' {"field": "event_type", "op": "in", "value": ["click", "view"]}]}',
    )
    kept = spark.read.schema("event_id bigint, user_id bigint, event_type string")
    return kept.json(target)


@query(
    "Q10 S5",
    """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_totalprice > 250000.5 AND o_orderstatus = 'F'""",
)
def filtered_csv(spark, sf):
    source, target = shared_dir(spark, "rows"), shared_dir(spark, "kept")
    view.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.lit("").alias("nothing"),
    ).write.mode("overwrite").option("header", True).csv(source)
    predicates.filter_csv(
        spark, source, target,
        {"and": [{"field": "o_totalprice", "op": "gt", "value": 250000.5},
                 {"field": "o_orderstatus", "op": "eq", "value": "F"},
                 {"field": "nothing", "op": "exists"}]},
    )
    kept = spark.read.option("header", True).csv(target)
    return kept.select(F.col("o_orderkey").cast("bigint"), "o_orderpriority")


@query(
    "Q2 Q3 Q6",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE CASE l_linenumber % 3
      WHEN 2 THEN l_partkey BETWEEN 1 AND 499 OR l_partkey = 1200 ELSE l_partkey > 1000 END""",
)
def filter_far_numbers(spark, sf):
    """Numbers far beyond the exact decimals, on either side, compare as numbers."""
    key, form = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 3
    far = (
        F.when(form == 0, F.concat(key, F.lit("e22")))
        .when(form == 1, F.concat(F.lit("-"), key, F.lit("0" * 22)))
        .otherwise(F.concat(key, F.lit(".0e-25")))
    )
    lines = view.table(spark, sf, "lineitem").withColumn("far", far)
    leaf = lambda op, value: {"field": "far", "op": op, "value": value}
    wanted = {"or": [leaf("gt", "1000" + "0" * 22), leaf("lt", "-1e25"),
                     {"and": [leaf("gt", 0), leaf("lt", "5e-23")]}, leaf("in", ["x", "1.2e-22"])]}
    return predicates.where(lines, wanted).select("l_orderkey", "l_linenumber")


@query(
    "Q10 S5",
    """SELECT event_id, ' "' || event_type || '", ' || user_id || chr(10) || 'line two ' AS quoted
    FROM events WHERE user_id < 50""",
)
def filtered_csv_of_any_text(spark, sf):
    """Quotes, commas, line breaks and blanks at the edges come back as they were."""
    source, target = shared_dir(spark, "rows"), shared_dir(spark, "kept")
    layout = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}
    view.table(spark, sf, "events").select(
        "event_id", "user_id",
        F.concat(F.lit(' "'), "event_type", F.lit('", '), "user_id", F.lit("\nline two ")).alias("quoted"),
    ).write.options(**layout).csv(source)
    predicates.filter_csv(spark, source, target, {"field": "user_id", "op": "lt", "value": 50})
    kept = spark.read.options(**layout, multiLine="true").csv(target)
    return kept.select(F.col("event_id").cast("bigint"), "quoted")
