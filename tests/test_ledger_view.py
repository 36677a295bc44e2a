"""The nested view of the driver tables."""

from pyspark.sql import functions as F

from coinfold.functions.amounts import to_base_units
from coinfold.functions.scripts import disassemble
from coinfold.operators import items
from coinfold.plans import ledger_view as view
from coinfold.plans.catalog_rows import _map_totals
from coinfold.schemas import RAW_BLOCK
from coinfold.sources.raw import parse_raw_blocks

LINES = (
    "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, l_quantity double,"
    "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def _lines(spark):
    given = [
        (k, n, 7 * k, 30 + n, float(q), 10.25 * k, 0.04, flag, status)
        for k, (flag, status, q) in enumerate([("A", "F", 1), ("N", "O", 50), ("R", "F", 7), (None, None, 3)], 1)
        for n in range(1, 8)
    ] + [(9, 2, None, 4, None, None, None, "A", "F")]
    made = spark.createDataFrame(given, LINES.rpartition(",")[0])
    return made.withColumn("l_shipdate", F.timestamp_seconds(F.col("l_orderkey") * 100_000))


def test_typed_blocks_are_what_their_text_parses_to(spark):
    lines = _lines(spark)
    typed, parsed = view.line_blocks(lines), parse_raw_blocks(view.raw_block_text(lines))
    assert typed.columns == parsed.columns
    assert [f.dataType.simpleString() for f in typed.schema] == [f.dataType.simpleString() for f in parsed.schema]
    text = lambda df: sorted(
        r[0] for r in df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).collect()
    )
    assert text(typed) == text(parsed)


def test_blocks_of_the_view_are_not_parsed(spark):
    """Only fields that are asked for are made; nothing is written as text and read again."""
    blocks = view.line_blocks(_lines(spark))
    plan = blocks.select("height", F.size("tx"))._jdf.queryExecution().optimizedPlan().toString()
    assert set(RAW_BLOCK.names) < set(blocks.columns)
    assert "json" not in plan.lower() and "valuecommitment" not in plan


def test_map_totals_beyond_bigint(spark):
    """Each sum of a row is a bigint, their total need not be one."""
    columns = "explicit_in_by_asset map<string,bigint>, explicit_out_by_asset map<string,bigint>, fee_by_asset map<string,bigint>"
    most = 2**63 - 1
    small = _map_totals(spark.createDataFrame([({"a": 5}, {"a": most}, None), ({"a": 6}, None, None)], columns))
    assert small.schema["units"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, small.collect())) == [("in", "a", 2, 11, 6), ("out", "a", 1, most, most)]
    large = _map_totals(spark.createDataFrame([({"a": most}, None, {"b": 1})] * 3, columns))
    assert sorted(map(tuple, large.collect())) == [("fee", "b", 3, 3, 1), ("in", "a", 3, 3 * most, most)]


def test_totals_do_not_need_the_arrays_of_items(spark):
    """Totals are read from the source: scripts and addresses are not made for them."""
    made = items.transaction_items(view.line_blocks(_lines(spark)))
    plan = made.select("hash", "input_count", "output_value", "fee")._jdf.queryExecution().optimizedPlan().toString()
    assert "scriptsig_asm" not in plan and "op_return_data_hex" not in plan
    plan = made.select("hash", "inputs")._jdf.queryExecution().optimizedPlan().toString()
    assert "_given" not in plan
    both = made.where("index = 1").select("fee", F.size("inputs").alias("n"), "input_count").collect()
    assert {(r.n, r.input_count) for r in both} == {(2, 2)}


def test_operations_across_strides(spark):
    """Scripts of about one, two and three strides, of pushes and of single operations, whole and cut off."""
    hexes = {}
    for n in (63, 64, 65, 127, 128, 129, 200):
        hexes["51" * n] = " ".join(["OP_1"] * n)
        hexes["02abcd" * n] = " ".join(["OP_PUSHBYTES_2 ABCD"] * n)
        hexes["51" * n + "02ab"] = None
    df = spark.createDataFrame([(h,) for h in hexes], "h string")
    assert {r.h: r.a for r in df.select("h", disassemble(F.col("h")).alias("a")).collect()} == hexes


def test_amounts_read_quickly_are_what_the_long_way_gives(spark):
    forms = ["0", "+5", "-0.1", "7.", "1.50", "9999999999.99999999", "99999999999", ".5", "1e-8", "1.000000000",
             "0.123456789", " 2.5 ", "", "-", "nan", "true", None, "12345678901234567890.123456789012345678"]
    want = [0, 500000000, -10000000, 700000000, 150000000, 999999999999999999, None, 50000000, 1, 100000000,
            None, 250000000, None, None, None, None, None, None]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, f string").where("i <> 6")
    got = {r.i: r.u for r in df.select("i", to_base_units(F.col("f")).alias("u")).collect()}
    assert got == {i: w for i, w in enumerate(want) if i != 6}


def test_script_of_an_input_is_read_once(spark):
    assert str(items._input(F.col("v"))).count("unhex(") == 1
