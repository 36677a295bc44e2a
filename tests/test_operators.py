import csv
import json
import random
import re
from datetime import datetime, timezone
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from coinfold.operators import days, enrich, heights, predicates
from coinfold.operators.predicates import PredicateError
from coinfold.sources.raw import clamped_range, height_range, tail

# ---- predicates --------------------------------------------------------------------------


def kept(spark, predicate, *objects):
    """Positions of the objects a predicate keeps, read without schema."""
    lines = spark.createDataFrame(
        [(json.dumps(o), i) for i, o in enumerate(objects)], "value string, i int"
    )
    return [r.i for r in predicates.filter_lines(lines, predicate).orderBy("i").collect()]


def leaf(field, op, value=None):
    return {"field": field, "op": op, "value": value}


def test_nested_logic_against_a_reading_of_it(spark):
    """Random trees over one field, missing in some objects, read node by node."""
    rnd = random.Random(31)
    objects = [{"k": n} for n in (-7, 0, 3, 41, 42)] + [{"k": None}, {}]

    def tree(depth):
        kind = rnd.choice(["and", "or", "not", "leaf"]) if depth else "leaf"
        if kind == "leaf":
            return leaf("k", rnd.choice(["lt", "ge", "eq"]), rnd.choice([0, 3, 42]))
        if kind == "not":
            return {"not": tree(depth - 1)}
        return {kind: [tree(depth - 1) for _ in range(rnd.randint(1, 3))]}

    def holds(node, value):
        if "and" in node:
            return all(holds(n, value) for n in node["and"])
        if "or" in node:
            return any(holds(n, value) for n in node["or"])
        if "not" in node:
            return not holds(node["not"], value)
        if value is None:
            return False
        x = node["value"]
        return {"lt": value < x, "ge": value >= x, "eq": value == x}[node["op"]]

    for _ in range(8):
        predicate = tree(3)
        expected = [i for i, o in enumerate(objects) if holds(predicate, o.get("k"))]
        assert kept(spark, predicate, *objects) == expected, predicate


def test_numbers_of_any_size(spark):
    """Numbers beyond the exact decimals compare as numbers, not as text."""
    texts = ["1e22", "10000000000000000000000", "-1e22", "1e-25", "0.0000000000000000000000001", "5", "-3", "1234567890123456789012345", "x"]
    typed = spark.createDataFrame([(t,) for t in texts], "v string")
    for literal in ("1e22", 5, "1e-25", "-1e22", 1234567890123456789012345, "1234567890123456789012345.5"):
        for op in ("eq", "lt", "ge"):
            a = lambda t: Decimal(t) if t != "x" else None
            x = Decimal(str(literal))
            expected = []
            for t in texts:
                left, right = (a(t), x) if t != "x" else (t, str(literal))
                expected += [t] if {"eq": left == right, "lt": left < right, "ge": left >= right}[op] else []
            got = [r.v for r in predicates.where(typed, leaf("v", op, literal)).collect()]
            assert got == expected, (op, literal)


def test_csv_keeps_its_fields(spark, tmp_path):
    rows = [["b", "a"], [" lead ", "1"], ['x "q" y', "2"], ["two\nlines", "3"], ["", "4"], ["a,b\\", "5"], ["no", "0"]]
    source = tmp_path / "in.csv"
    with source.open("w", newline="") as file:
        csv.writer(file).writerows(rows)
    predicates.filter_csv(spark, str(source), str(tmp_path / "out"), leaf("a", "gt", 0))
    back = []
    for part in (tmp_path / "out").glob("*.csv"):
        with part.open(newline="") as file:
            back += list(csv.reader(file))
    assert back == rows[:-1]


def test_paths_into_lists(spark):
    first = leaf("inputs.0.value", "eq", "0.5")
    objects = [{"inputs": [{"value": "0.50"}]}, {"inputs": [{"value": "0.6"}]}, {"inputs": []}, {}]
    assert kept(spark, first, *objects) == [0]
    assert kept(spark, leaf("inputs.-1.value", "eq", 0.6), *objects) == [1]


def test_a_list_is_made_once_for_a_test(spark):
    """However often a test looks at an element, the list it is in is made once; below ``not`` as well."""
    rows = [(1, ["5", "1e30"]), (2, ["x"]), (3, None), (4, ["-7", None])]
    made = spark.createDataFrame(rows, "i int, v array<string>").select(
        "i", F.transform("v", lambda x: F.struct(F.concat(x, F.lit("")).alias("value"), F.array(x).alias("all"))).alias("made")
    )
    first, last = leaf("made.0.value", "gt", 0), leaf("made.-1.all", "contains", "1e30")
    for predicate, want in ((first, [1, 2]), ({"not": first}, [3, 4]), (last, [1]), ({"not": last}, [2, 3, 4])):
        found = predicates.where(made, predicate).select("i")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.i for r in found.collect()) == want
        assert plan.count("named_struct(value") <= (2 if "not" in predicate else 1)


def test_leaf_operators(spark):
    objects = [
        {"a": "abc", "n": 10, "l": [1, "x"], "f": True},
        {"a": "9", "n": "10.0", "l": ["1"], "f": False},
        {"a": None, "n": "ten"},
    ]
    cases = [
        (leaf("n", "eq", 10), [0, 1]), (leaf("n", "ne", 10), [2]), (leaf("n", "lt", "9"), []),
        (leaf("a", "lt", 10), [1]), (leaf("a", "gt", "aa"), [0]),
        (leaf("l", "contains", 1), [0]), (leaf("l", "contains", "1"), [1]),
        (leaf("a", "contains", "b"), [0]), (leaf("a", "startswith", 9), [1]),
        (leaf("a", "endswith", "c"), [0]), (leaf("n", "in", [10, 11]), [0, 1]),
        (leaf("n", "in", 10), []), (leaf("a", "regex", "b|9"), [0, 1]),
        (leaf("a", "exists"), [0, 1]), (leaf("a", "exists", False), [2]),
        (leaf("a", "exists", "no"), [2]), (leaf("f", "eq", True), [0]),
        (leaf("f", "eq", "False"), [1]), (leaf("zz", "ne", 1), []),
    ]
    for predicate, expected in cases:
        assert kept(spark, predicate, *objects) == expected, predicate


def test_typed_columns_agree_with_schemaless(spark):
    rnd = random.Random(5)
    texts = ["1", "1.0", "01", "x", "10", "9", "", "-2", "1e1"]
    rows = [(rnd.choice(texts + [None]), rnd.randint(-3, 12)) for _ in range(60)]
    typed = spark.createDataFrame(rows, "s string, n bigint")
    objects = [{"s": s, "n": n} for s, n in rows]

    def number(v):
        try:
            return Decimal(str(v).strip())
        except InvalidOperation:
            return None

    def holds(v, op, x):
        if v is None:
            return False
        a, b = number(v), number(x)
        if a is None or b is None:
            a, b = str(v), str(x)
        return {"eq": a == b, "ne": a != b, "lt": a < b, "ge": a >= b}[op]

    for field in "sn":
        for op in ("eq", "ne", "lt", "ge"):
            for x in (1, "1", 9.5, "x", "10"):
                wanted = [holds(o[field], op, x) for o in objects]
                p = leaf(field, op, x)
                flag = predicates.matches(typed, p).alias("k")
                assert [r.k for r in typed.select(flag).collect()] == wanted, p
                inverse = predicates.where(typed, {"not": p}).count()
                assert inverse == wanted.count(False), p
                assert len(kept(spark, p, *objects)) == wanted.count(True), p


def test_numbers_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("s", F.lit("a")).write.parquet(path)
    df = spark.read.parquet(path)
    p = {"and": [leaf("id", "ge", 3), {"not": leaf("id", "gt", 7)}, leaf("s", "eq", "a")]}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = predicates.where(df, p)._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(id,3)" in pushed and "EqualTo(s,a)" in pushed


FAR = ["1e30", "-1e30", 10**25, -(10**25), "1e-25", "-1e-25", 5, "5.0", 4.5, "5.5", -7, "-7.25", 127, 128, -128, -129,
       "9223372036854775807", "9223372036854775808", "-9223372036854775809", "1e99999999999", "0", "-0.0", 99.99, "99.995", 100]


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint", "decimal(4,2)", "decimal(38,0)", "decimal(38,18)", "double", "string"])
def test_numbers_of_any_type_against_any_number(spark, kind):
    """Every comparison, also below ``not``, against exact arithmetic; a missing value satisfies none."""
    values = [5, -7, 0, 99, None]
    df = spark.createDataFrame([(v,) for v in values], "v int").selectExpr(f"CAST(v AS {kind}) AS v")
    tests = {
        "eq": lambda a, b: a == b, "ne": lambda a, b: a != b, "lt": lambda a, b: a < b, "le": lambda a, b: a <= b,
        "gt": lambda a, b: a > b, "ge": lambda a, b: a >= b,
    }
    flags, want = [], []
    for literal in FAR:
        for op, test in tests.items():
            flags += [predicates.matches(df, leaf("v", op, literal)), predicates.matches(df, {"not": leaf("v", op, literal)})]
            found = [v is not None and test(Decimal(v), Decimal(str(literal))) for v in values]
            want += [found, [not f for f in found]]
    columns = [f"c{i}" for i in range(len(flags))]
    rows = df.select("v", *[f.alias(c) for f, c in zip(flags, columns, strict=True)]).collect()
    got = {None if r.v is None else int(float(r.v)): [r[c] for c in columns] for r in rows}
    for k, v in enumerate(values):
        assert got[v] == [w[k] for w in want], v


def test_comparisons_of_integers_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(10).write.parquet(path)
    plan = predicates.where(spark.read.parquet(path), leaf("id", "lt", "4.5"))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,4)" in plan


@pytest.mark.parametrize(
    "predicate",
    ["no json {", "[1]", {"or": []}, {"and": 3}, leaf("x", "bogus", 1), leaf("", "eq", 1),
     leaf("x", "regex", "("), "__import__('os')"],
)
def test_malformed_predicates(spark, predicate):
    with pytest.raises(PredicateError):
        predicates.where(spark.range(1), predicate)


# ---- enrichment --------------------------------------------------------------------------


def test_every_lookup_has_its_outcome(spark, land):
    """Random spending over a few known transactions, some ids unknown, some positions too far."""
    from coinfold.operators.items import transaction_items

    rnd = random.Random(14)
    known = {f"from{k}": [coin for coin in rnd.sample(range(1, 900), k)] for k in range(1, 5)}
    txs = [
        {"txid": name, "vin": [{"coinbase": "00"}], "vout": [
            {"n": n, "value": str(coin), "asset": "gold", "scriptPubKey": {"address": f"to{coin}"}} for n, coin in enumerate(coins)]}
        for name, coins in known.items()
    ]
    spending = {}
    for k in range(30):
        points = [(rnd.choice([*known, "nowhere"]), rnd.randint(0, 5)) for _ in range(rnd.randint(1, 4))]
        spending[f"spend{k}"] = points
        txs.append({"txid": f"spend{k}", "vin": [{"txid": t, "vout": n} for t, n in points], "vout": []})
    txs.append(txs[-1])  # a copy of a transaction shares its lookups
    txs.append({"txid": "blank", "vin": [{"txid": "", "vout": 0}], "vout": []})
    made = transaction_items(land({"hash": "b", "height": 1, "tx": txs}))
    sources = made.where("txid like 'from%'")
    done = enrich.enrich_transactions(made, enrich.outpoints(sources), enrich.output_counts(sources)).collect()
    assert len(done) == len(txs)
    totals = [0, 0]
    for row in done:
        for point, got in zip(spending.get(row.txid, []), row.inputs):
            coins = known.get(point[0])
            found = coins is not None and point[1] < len(coins)
            totals[0 if found else 1] += 1
            if found:
                assert (got.value, got.addresses, got.enrichment_error) == (str(coins[point[1]]), [f"to{coins[point[1]]}"], None)
            elif coins is None:
                assert got.enrichment_error == enrich.UNKNOWN_TX
            else:
                assert got.enrichment_error == f"prevout index {point[1]} out of range ({len(coins)} vouts)"
    assert [i.enrichment_error for r in done if r.txid == "blank" for i in r.inputs] == [None]
    stats = enrich.item_stats(spark.createDataFrame(done, made.schema)).agg(
        F.sum("attempted"), F.sum("enriched"), F.sum("failed")).first()
    assert tuple(stats) == (sum(totals), *totals)


def test_an_input_is_looked_up_once(spark):
    """What an input found is used many times, but looked for once; its list is hashed without a text of it."""
    from coinfold.schemas import TX_ITEM

    one = lambda txid, vout: f"named_struct({', '.join(f(n, txid, vout) for n in fields)})"
    fields = {x.name: x.dataType.simpleString() for x in TX_ITEM["inputs"].dataType.elementType.fields}
    f = lambda n, txid, vout: f"'{n}', CAST({ {'txid': txid, 'vout': vout}.get(n, 'null') } AS {fields[n]})"
    twice = f"array({one('concat(id % 3)', 'id')}, {one("'0'", '0')}, {one("'0'", '0')}, {one("''", '1')}, {one('null', 'null')})"
    rows = spark.range(6).selectExpr("concat('t', id) AS txid", f"{twice} AS inputs")
    outputs = spark.sql("SELECT concat(id) AS txid, id * 0 AS vout, array('a') AS addresses, 1L AS required_signatures, 'k' AS type, concat(id, '.5') AS value, 'g' AS asset FROM range(2)")
    done = enrich.enrich_transactions(rows, outputs, outputs.selectExpr("txid", "1 AS vout_count"))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at(") == 1 and "to_json" not in plan
    got = {r.txid: [(i.value, i.enrichment_error) for i in r.inputs] for r in done.collect()}
    behind = lambda n: (None, f"prevout index {n} out of range (1 vouts)")
    first = [("0.5", None), behind(1), (None, enrich.UNKNOWN_TX), behind(3), behind(4), (None, enrich.UNKNOWN_TX)]
    assert got == {f"t{n}": [first[n], ("0.5", None), ("0.5", None), (None, None), (None, None)] for n in range(6)}


# ---- heights -----------------------------------------------------------------------------


def ranges(df):
    return sorted((r.start_missing, r.end_missing) for r in df.collect())


def gaps_of(present, start, end):
    missing = [h for h in range(start, end + 1) if h not in present]
    found = []
    for h in missing if any(start <= p <= end for p in present) else []:
        if found and found[-1][1] == h - 1:
            found[-1][1] = h
        else:
            found.append([h, h])
    return [tuple(g) for g in found]


@pytest.mark.parametrize("bucket", [1, 3, 10, 1000])
def test_missing_ranges(spark, bucket):
    rnd = random.Random(bucket)
    present = {rnd.randint(10, 90) for _ in range(40)}
    df = spark.createDataFrame([(h,) for h in [*present, 15, 15]] + [(None,)], "height bigint")
    present.add(15)
    assert ranges(heights.missing_ranges(df, 0, 100, bucket)) == gaps_of(present, 0, 100)
    assert ranges(heights.repair_ranges(df, 60, 30)) == gaps_of(present, 30, 60)
    assert ranges(heights.missing_ranges(df, 200, 300, bucket)) == []


@pytest.mark.parametrize("bucket", [1, 4, 25, 1000])
def test_merged_ranges(spark, bucket):
    rnd = random.Random(bucket)
    given = [(a, a + rnd.choice([0, 1, 2, 30])) for a in (rnd.randint(0, 300) for _ in range(60))]
    covered = {h for a, b in given for h in range(a, b + 1)}
    df = spark.createDataFrame(given, heights.GAPS)
    expected = []
    for h in sorted(covered):
        if expected and expected[-1][1] == h - 1:
            expected[-1] = (expected[-1][0], h)
        else:
            expected.append((h, h))
    assert ranges(heights.merge_ranges(df, bucket)) == expected


def test_range_reports(spark):
    df = spark.createDataFrame([(1, 3), (7, 7)], heights.GAPS)
    assert tuple(heights.range_totals(df).first()) == (4, 2)
    assert tuple(heights.range_totals(df.limit(0)).first()) == (0, 0)
    assert heights.range_report(df, 1).count() == 1
    blocks = spark.range(20).withColumnRenamed("id", "height")
    taken = heights.blocks_in_ranges(blocks, df)
    assert sorted(r.height for r in taken.collect()) == [1, 2, 3, 7]
    whole = heights.repair_ranges(blocks, 9, 4, backfill_present=True)
    assert ranges(whole) == [(4, 9)]


def test_blocks_in_ranges_of_any_size(spark):
    """Ranges within, at and across the bounds of cells, next to each other, and very long ones."""
    rnd = random.Random(4)
    starts = sorted(rnd.sample(range(2_000), 60))
    some = [(a, rnd.randint(a, b - 1)) for a, b in zip(starts, [*starts[1:], 2_300])] + [(2_304, 2_367), (2_368, 2_368), (5_000, 900_000)]
    blocks = spark.createDataFrame([(h, f"b{h}") for h in [*range(2_500), 4_999, 5_000, 899_999, 900_000, 900_001]] + [(None, "x")], "height bigint, hash string")
    taken = heights.blocks_in_ranges(blocks, spark.createDataFrame(some, heights.GAPS))
    assert taken.columns == ["height", "hash"]
    want = [r.height for r in blocks.collect() if r.height is not None and any(a <= r.height <= b for a, b in some)]
    assert sorted(r.height for r in taken.collect()) == want
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert ">= start" not in plan and "<= end" not in plan


def test_kept_block_order(spark):
    blocks = spark.createDataFrame(
        [("a", 1, 5), ("b", 1, 9), ("c", 2, None), ("d", 2, 1), ("e", 3, 7), ("f", 3, 7),
         ("g", 4, 1), ("h", None, 1), ("i", None, 1)],
        "hash string, height bigint, time bigint",
    )
    txs = spark.createDataFrame([("t1", "a"), ("t2", "a"), ("t3", "b")],
                                "txid string, block_hash string")
    kept_hashes = {r.height: r.keep_hash for r in heights.kept_blocks(blocks, txs).collect()}
    assert kept_hashes == {1: "a", 2: "d", 3: "f"}
    losers = heights.losing_blocks(blocks, txs)
    assert {r.hash for r in losers.collect()} == {"b", "c", "e"}
    children = spark.createDataFrame([("t1", 0), ("t3", 0)], "txid string, vin int")
    left = heights.drop_blocks(
        {"blocks": blocks, "transactions": txs, "txins": children, "txouts": children}, losers)
    assert {r.hash for r in left["blocks"].collect()} == {"a", "d", "f", "g", "h", "i"}
    assert {r.txid for r in left["txins"].collect()} == {"t1"}


def test_batches_and_bounds(spark):
    made = heights.batch_ranges(spark, 5, 17, 5).orderBy("block_start").collect()
    assert [tuple(r) for r in made] == [(5, 9), (10, 14), (15, 17)]
    placed = heights.with_batches(spark.range(30).toDF("height"), 5, 17, 5).collect()
    assert {(r.block_start, r.block_end) for r in placed} == {(5, 9), (10, 14), (15, 17)}
    assert clamped_range(-4, 2, 9) == (0, 2) and clamped_range(8, 3, 9) == (8, 8)
    with pytest.raises(ValueError):
        height_range(spark.range(3).toDF("height"), 2, 1)
    assert tail(spark.range(10).toDF("height"), 3).count() == 3
    assert heights.resume_height(spark.range(0).toDF("height")) == 0


# ---- days --------------------------------------------------------------------------------


def test_block_range_of_a_day(spark):
    """Blocks at irregular times: the range holds exactly the heights of the day or the hours."""
    rnd = random.Random(23)
    midnight = int(datetime(2019, 11, 30, tzinfo=timezone.utc).timestamp())
    at, chain = midnight - 30_000, []
    while at < midnight + 130_000:
        chain.append((400 + len(chain), at))
        at += rnd.choice([40, 611, 3_000, 7_777])
    frame = spark.createDataFrame(chain, "height bigint, time bigint")

    def inside(low, high):
        heights = [h for h, t in chain if midnight + low <= t < midnight + high]
        return min(heights), max(heights)

    assert days.block_range_for_day(frame, "2019-11-30") == inside(0, 86_400)
    for first, last in ((0, 3), (9, 17), (20, 24)):
        found = days.block_range_for_day(frame, "2019-11-30", first, last)
        assert found == inside(first * 3600, last * 3600), (first, last)
    for other in ("2019-11-27", "2019-12-05"):
        with pytest.raises(ValueError):
            days.block_range_for_day(frame, other)
    # blocks on both sides of the day and none within
    with pytest.raises(ValueError):
        days.block_range_for_day(frame.where(f"time < {midnight} OR time >= {midnight + 86_400}"), "2019-11-30")
