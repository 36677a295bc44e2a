import random
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from coinfold.functions.amounts import decimal_text, exact_decimal, fraction_digits, to_base_units
from coinfold.functions.assets import fee_units, sum_by_asset
from coinfold.functions.scripts import disassemble, op_return_payload


def one_column(spark, values, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def units(text):
    """Exact base units of a text, by decimal arithmetic."""
    try:
        value = Decimal(text)
    except (InvalidOperation, TypeError):
        return None
    if not value.is_finite():
        return None
    scaled = value * 10**8
    whole = int(scaled)
    return whole if whole == scaled and abs(whole) < 2**63 else None


def test_base_units_of_edge_values(spark):
    values = [
        None, "true", "0.00000001", "1.00000000", "1.5", "1", "0", "0.1", "2.0", "0.000000005",
        "1.999999999", "21000000", "nan", "inf", "x", "", "1e-8", "1E-19", "-0.5", " 3 ", ".5",
        "5.", "92233720368.54775807", "0.1" + "0" * 30, "1e3", "1e-99999", "0e99999999999",
        "0" * 40 + "7", "12345678901234567890.123456789", "-92233720368.54775807",
    ]
    got = one_column(spark, values, to_base_units(F.col("v")))
    assert got == [(units(v),) for v in values]


@pytest.mark.parametrize("value", ["92233720368.54775808", "100000000000", "1e30", "-1e12", "1e99999999999", "9" * 45])
def test_base_units_beyond_bigint_are_loud(spark, value):
    with pytest.raises(Exception, match="beyond bigint"):
        one_column(spark, [value], to_base_units(F.col("v")))


def written(values, signs):
    """Exact total as text, with the most digits behind the point that an operand was written with."""
    total, digits = 0, 0
    numbers = []
    for value, sign in zip(values, signs, strict=True):
        try:
            number = Decimal(value)
        except (InvalidOperation, TypeError):
            continue
        if number.is_finite():
            digits = max(digits, -number.as_tuple().exponent)
            numbers.append((number, sign))
    for number, sign in numbers:
        part = number.as_tuple()
        total += sign * (-1 if part.sign else 1) * int("".join(map(str, part.digits))) * 10 ** (part.exponent + digits)
    text = str(abs(total)).rjust(digits + 1, "0")
    text = f"{text[:-digits]}.{text[-digits:]}" if digits else text
    return f"-{text}" if total < 0 else text


def totals(spark, rows):
    from coinfold.functions.amounts import amount, total_text

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>")
    some = lambda c: F.transform(c, amount)
    out = df.orderBy("i").select(total_text(some("a")).alias("x"), total_text(some("a"), some("b")).alias("y"))
    return [tuple(r) for r in out.collect()]


def test_totals_of_any_size(spark):
    rnd = random.Random(9)

    def number():
        whole, fraction = (rnd.randrange(10 ** rnd.choice([1, 3, 9, 20, 25, 40])) for _ in range(2))
        return rnd.choice(["", "", "-"]) + rnd.choice([f"{whole}", f"{whole}.{fraction}", f"0.{fraction:060d}", f"{whole}e{rnd.randrange(-30, 30)}"])

    fixed = [
        (["2.0000000000000000001", "1.0"], []), (["1.0", "x", None, "2.50"], ["0.5"]), ([], []), (["nan"], ["1"]),
        (["0.1" + "0" * 30], []), (["1" * 25 + "." + "2" * 25, "8" * 25 + "." + "7" * 25], ["1.5"]),
        (["99999999999999999999.999999999999999999"] * 3, ["0.000000000000000001"]), (["-0.0"], []), (["1e400", "-1e400"], []),
        (["1"], ["1e25"]), (["999999999", "1"], ["1e9"]), (["1e-30"], ["1"]),
    ]
    rows = fixed + [([number() for _ in range(rnd.randrange(5))], [number() for _ in range(rnd.randrange(4))]) for _ in range(150)]
    want = [(written(a, [1] * len(a)), written(a + b, [1] * len(a) + [-1] * len(b))) for a, b in rows]
    assert totals(spark, rows) == want


def test_totals_of_wide_amounts_need_no_limbs(spark, monkeypatch):
    """Amounts of up to 28 digits on either side of the point are summed as two decimals."""
    from coinfold.functions import amounts

    monkeypatch.setattr(amounts, "_limbs", lambda *_: F.raise_error(F.lit("limbs")).cast("string"))
    rnd = random.Random(21)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def number():
        kinds = [f"{digits(rnd.randint(1, 28))}.{digits(rnd.randint(0, 28))}", digits(25), "1." + digits(25), "2e-8", "0.50", "x", None]
        n = rnd.choice(kinds)
        return rnd.choice(["", "-", "+"]) + n if n and n != "x" else n

    wide = "1" * 25 + "." + "2" * 25
    fixed = [
        ([wide], [wide]), ([wide, "-" + wide], ["0.5"]), (["-" + wide], []), (["0." + "0" * 27 + "1"], ["1"]), (["9" * 28 + "." + "9" * 28] * 9, []),
        (["9" * 25 + ".5"], ["9" * 25 + ".50"]), ([wide, "1.0" + "0" * 30], []), (["-0." + "0" * 25], []), ([], [wide]),
    ]
    rows = fixed + [(["1" + digits(24) + ".1"] + [number() for _ in range(rnd.randrange(5))], [number() for _ in range(rnd.randrange(4))]) for _ in range(150)]
    want = [(written(a, [1] * len(a)), written(a + b, [1] * len(a) + [-1] * len(b))) for a, b in rows]
    assert totals(spark, rows) == want


def test_totals_of_too_many_digits_are_loud(spark):
    with pytest.raises(Exception, match="too many digits"):
        totals(spark, [(["1e999999"], [])])


def test_sort_keys_of_far_exponents(spark):
    from coinfold.functions.amounts import sort_key

    values = ["-1e99999999999", "-2", "-1e-99999999999", "0", "1e-99999999999", "2", "1e99999999999", "2e99999999999"]
    keys = [r[0] for r in one_column(spark, values, sort_key(F.col("v")))]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    same = [r[0] for r in one_column(spark, ["100", "1e2", "0.1e3", "+100.00"], sort_key(F.col("v")))]
    assert len(set(same)) == 1


def test_base_units_of_random_values(spark):
    rnd = random.Random(3)
    values = [
        f"{rnd.randint(0, 10**rnd.randint(0, 10))}.{rnd.randint(0, 10**rnd.randint(1, 14))}"
        for _ in range(400)
    ]
    assert one_column(spark, values, to_base_units(F.col("v"))) == [(units(v),) for v in values]


def test_base_units_of_native_numbers(spark):
    df = spark.createDataFrame([(1, 0.1, True)], "a int, b double, c boolean")
    row = df.select(*[to_base_units(F.col(c)) for c in "abc"]).first()
    assert tuple(row) == (100_000_000, 10_000_000, None)


def test_decimal_text_keeps_written_digits(spark):
    values = ["1.0", "0.99990000", "7", "1e-8", "-2.50"]
    text = decimal_text(exact_decimal(F.col("v")), fraction_digits(F.col("v")))
    got = [r[0] for r in one_column(spark, values, text)]
    assert got == ["1.0", "0.99990000", "7", "0.00000001", "-2.50"]


def test_op_return_payloads(spark):
    cases = {
        "6a": "", "6A04deadbeef": "deadbeef", "0x6a0100": "00", "6a4c02abcd": "abcd",
        "6a4d0200abcd": "abcd", "6a4e02000000abcd": "abcd", "6a00": "", "6a02abcdffff": "abcd",
        "6a05deadbeef": None, "6a4c": None, "6a4d02": None, "6a51": None, "0014abcd": None,
        "6a0": None, "": None, None: None, "6azz": None,
    }
    got = one_column(spark, list(cases), op_return_payload(F.col("v")))
    assert [r[0] for r in got] == list(cases.values())


def test_disassembly(spark):
    cases = {
        "01710101": "OP_PUSHBYTES_1 71 OP_PUSHBYTES_1 01",
        "6a02abcd": "OP_RETURN OP_PUSHBYTES_2 ABCD",
        "00": "OP_0", "5160": "OP_1 OP_16", "ff": "OP_UNKNOWN_0xFF", "4c01aa": "OP_PUSHDATA1 AA",
        "4d0100aa": "OP_PUSHDATA2 AA", "4e01000000aa": "OP_PUSHDATA4 AA",
        "02aa": None, "4c": None, "4d01": None, "0": None, "": None, None: None, "0x": "",
    }
    got = one_column(spark, list(cases), disassemble(F.col("v")))
    assert [r[0] for r in got] == list(cases.values())


def test_plain_scripts_are_read_without_the_fold(spark, monkeypatch):
    """Every operation but pushes with length bytes, whole, cut off and in a row; and what the fold says to the same."""
    from coinfold.functions import scripts

    one = ["%02x" % op + "c5" * (op if op <= 75 else 0) for op in range(256) if op not in (76, 77, 78)]
    cases = [*one, *(h + "51" for h in one), *(h[:-2] for h in one), *(h[:-1] for h in one), "".join(one), *(f"6a{h}" for h in one)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "i int, h string").repartition(2)
    read = lambda: [r[1:] for r in sorted(df.select("i", disassemble(F.col("h")), op_return_payload(F.col("h"))).collect())]
    quick = read()
    monkeypatch.setattr(scripts, "_PLAIN_SCRIPT", "^never$")
    monkeypatch.setattr(scripts, "_PLAIN_RETURN", "^never$")
    assert quick == read()
    monkeypatch.undo()
    monkeypatch.setattr(scripts, "_bind", lambda value, body: F.raise_error("folded") if "unhex" in str(value) else body(value))
    plain = df.where("i < 253").select(disassemble(F.col("h")))
    assert plain.count() == 253 and all(r[0] for r in plain.collect())


def test_asset_sums(spark):
    rows = [
        (0, [("a", 1), ("b", 2), ("a", 3), (None, 9), ("c", None)]), (1, []), (2, None),
        (3, [("z", 5)] * 1000),
    ]
    df = spark.createDataFrame(rows, "i int, e array<struct<asset:string,units:bigint>>")
    got = [r[0] for r in df.orderBy("i").select(sum_by_asset(F.col("e"))).collect()]
    assert got == [{"a": 4, "b": 2}, None, None, {"z": 5000}]


def test_fee_map_drops_what_is_no_amount(spark):
    df = spark.createDataFrame(
        [({"a": "0.00000001", "b": None, "c": "0.000000005", "d": "2"},)],
        "m map<string,string>",
    )
    assert df.select(fee_units(F.col("m"))).first()[0] == {"a": 1, "d": 200_000_000}


@pytest.mark.parametrize("size", [600, 10_000, 100_000])
def test_long_scripts(spark, tmp_path, size):
    """Read inside tasks, from a file, as scripts come."""
    from coinfold.functions.scripts import disassemble, op_return_payload

    data = "c5" * size
    script = "6a4e" + size.to_bytes(4, "little").hex() + data
    path = str(tmp_path / "scripts")
    spark.createDataFrame([(script,), (script[:-1],), (" ".join([script[:8], script[8:]]),)], "s string").write.parquet(path)
    read = spark.read.parquet(path)
    got = [tuple(r) for r in read.select(op_return_payload(F.col("s")), disassemble(F.col("s"))).collect()]
    whole = (data, f"OP_RETURN OP_PUSHDATA4 {data.upper()}")
    assert sorted(got, key=str) == sorted([whole, whole, (None, None)], key=str)


def test_sums_of_assets_never_vanish(spark):
    from coinfold.functions.assets import sum_by_asset

    most = 2**63 - 1
    entries = lambda *v: spark.createDataFrame([([("a", x) for x in v],)], "e array<struct<asset:string,units:bigint>>")
    assert entries(most, 5, -5).select(sum_by_asset(F.col("e"))).first()[0] == {"a": most}
    with pytest.raises(Exception, match="beyond bigint"):
        entries(most, 5).select(sum_by_asset(F.col("e"))).collect()


def test_scripts_of_many_operations(spark):
    """Four times the operations take nowhere near sixteen times as long, and every word is there."""
    import time

    seconds = {}
    for size in (200, 10_000, 40_000):
        df = spark.createDataFrame([("51" * (size - 3) + "0201ff",)], "s string")
        began = time.perf_counter()
        text = df.select(disassemble(F.col("s"))).first()[0]
        seconds[size] = time.perf_counter() - began
        assert text.split(" ") == ["OP_1"] * (size - 3) + ["OP_PUSHBYTES_2", "01FF"]
    assert seconds[40_000] < 8 * max(seconds[10_000], 1.0)
