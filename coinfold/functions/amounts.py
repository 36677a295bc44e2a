"""Exact coin amounts. Decimal text in, integer base units or exact decimals out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One coin is 10^8 base units.
UNITS_PER_COIN = 100_000_000
COIN_DIGITS = 8

EXACT = "decimal(38,18)"
EXACT_DIGITS = 18
_COIN = "decimal(28,8)"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# Text that a decimal surely holds: as base units in a bigint, as an exact decimal.
_PLAIN_COINS = r"^[+-]?[0-9]{1,10}(?:\.[0-9]{0,8})?$"
_PLAIN_EXACT = r"^[+-]?[0-9]{1,20}(?:\.[0-9]{0,18})?$"
# Text of which two decimals hold the digits on either side of the point, and sums of any array of them.
_HALF = 28
_PLAIN_WIDE = r"^[+-]?[0-9]{1,28}(?:\.[0-9]{0,28})?\z"
_FRACTION = r"\.([0-9]*)"
_EXPONENT = r"[eE]([+-]?[0-9]+)$"


def _text(value: Column) -> Column:
    return F.trim(value.cast("string"))


def _exponent(text: Column) -> Column:
    """The exponent, 0 without one; null where it is beyond bigint."""
    found = F.regexp_extract(text, _EXPONENT, 1)
    return F.when(found == "", F.lit(0).cast("bigint")).otherwise(found.try_cast("bigint"))


def fraction_digits(value: Column) -> Column:
    """Digits behind the point as written: ``1.50`` has 2, ``1e-8`` has 8, ``7`` has 0."""
    text = _text(value)
    written = F.length(F.regexp_extract(text, _FRACTION, 1))
    plain = F.when(F.instr(text, ".") > 0, F.length(text) - F.instr(text, ".")).otherwise(0)
    with_exponent = F.greatest(F.lit(0).cast("bigint"), written - _exponent(text))
    return F.when(text.rlike("[eE]"), with_exponent.try_cast("int")).otherwise(plain)


def exact_decimal(value: Column) -> Column:
    """Decimal value of a number or its text; null when it is no finite number, is a
    boolean, or has digits that ``decimal(38,18)`` cannot hold exactly."""
    text = _text(value)
    # Short text without exponent cannot have more than 18 digits behind the point.
    short = (F.length(text) <= EXACT_DIGITS + 1) & ~text.rlike("[eE]")
    significant = F.length(
        F.regexp_replace(F.regexp_extract(text, _FRACTION, 1), "0+$", "")
    ) - _exponent(text)
    held = text.rlike(_NUMBER) & (significant <= EXACT_DIGITS)
    return F.when(short | held, text.try_cast(EXACT))


_POWERS, _POWER_DIGITS = 10**20, 21
_COMPLEMENT = ("0123456789", "9876543210")


def _power(text: Column) -> Column:
    """The power of ten of the first digit that is not zero, as decimal(38,0); null for an exponent beyond bigint."""
    whole, digits, first = _digits(text)
    shift = (F.length(whole) - (F.length(digits) - F.length(first))).cast("decimal(38,0)")
    return (shift + _exponent(text).cast("decimal(20,0)")).cast("decimal(38,0)")


def _digits(text: Column) -> tuple[Column, Column, Column]:
    """Digits before the point, all digits, and those without opening zeros."""
    whole = F.regexp_extract(text, r"^[+-]?([0-9]*)", 1)
    digits = F.concat(whole, F.regexp_extract(text, _FRACTION, 1))
    return whole, digits, F.regexp_replace(digits, "^0+", "")


def sort_key(value: Column) -> Column:
    """Text that orders like the number a text stands for, however large or fine it is; equal
    numbers have equal keys. Null for anything that is no finite number.

    A sign, the power of ten of the first digit that is not zero, and the digits from there on
    without closing zeros; for negative numbers the digits' complements, which turn the order.
    """
    text = _text(value)
    _, _, first = _digits(text)
    power = F.lpad((_power(text) + F.lit(str(_POWERS)).cast("decimal(38,0)")).cast("string"), _POWER_DIGITS, "0")
    key = F.concat(power, F.regexp_replace(first, "0+$", ""))
    # behind a shorter number comes a longer one, and before it among negative ones
    turned = F.concat(F.lit("0"), F.translate(key, *_COMPLEMENT), F.lit("~"))
    signed = F.when(first == "", F.lit("1")).when(text.startswith("-"), turned).otherwise(
        F.concat(F.lit("2"), key)
    )
    return F.when(text.rlike(_NUMBER), signed)


#: Whole coins of this power of ten and above are beyond bigint in base units.
_TOO_LARGE = 12


def to_base_units(value: Column) -> Column:
    """Whole-coin amount as integer base units.

    Null for missing values, booleans, text that is no finite number, and amounts finer
    than one base unit: a money value is never rounded. An amount that is a whole number of base
    units but beyond bigint fails the job rather than to go missing.
    """
    text = _text(value)
    coins = exact_decimal(value).try_cast(_COIN)
    units = F.when(exact_decimal(value) == coins, (coins * F.lit(UNITS_PER_COIN)).try_cast("bigint"))
    # Only what gave no units is looked at closer, inside a lambda that generated code leaves alone.
    closer = F.coalesce(units, F.transform(F.array(text), _loud)[0])
    plain = (text.try_cast(_COIN) * F.lit(UNITS_PER_COIN)).try_cast("bigint")
    return F.when(text.rlike(_PLAIN_COINS), plain).when(text.isNotNull(), closer)


def _loud(text: Column) -> Column:
    """For what a decimal does not hold: null for what is no amount, an error for one beyond bigint."""
    _, _, first = _digits(text)
    trailing = F.length(first) - F.length(F.regexp_replace(first, "0+$", ""))
    fraction = F.length(F.regexp_extract(text, _FRACTION, 1)) - trailing - _exponent(text)
    whole = text.rlike(_NUMBER) & (first != "") & (fraction <= COIN_DIGITS)
    close = F.when(_power(text) <= _TOO_LARGE, text.try_cast("decimal(38,8)") * F.lit(UNITS_PER_COIN))
    error = F.raise_error(F.concat(F.lit("an amount is beyond bigint in base units: "), F.left(text, F.lit(60))))
    zero = F.when(text.rlike(_NUMBER) & (first == ""), F.lit(0).cast("bigint"))
    return F.coalesce(zero, F.when(whole, F.coalesce(close.try_cast("bigint"), error.cast("bigint"))))


# ---- totals ------------------------------------------------------------------------------

_WHOLE = "decimal(38,0)"
_HALVES = f"struct<whole:{_WHOLE},part:{_WHOLE}>"
AMOUNT = f"struct<exact:{EXACT},digits:int,text:string,halves:{_HALVES}>"
#: A total has at most so many digits; one beyond fails the job.
MOST_DIGITS = 100_000
_LIMB = 9


def amount(value: Column) -> Column:
    """An amount for :func:`total_text`: as a decimal if one holds it, else its text, and its halves if two
    decimals hold them; the digits behind the point as written. All are null for what is no finite number."""
    exact, text = exact_decimal(value), _text(value)
    other = F.when(exact.isNull() & text.rlike(_NUMBER), text)
    digits = F.when(F.instr(text, ".") > 0, F.length(text) - F.instr(text, ".")).otherwise(0)
    nothing = {"exact": F.lit(None).cast(EXACT), "text": F.lit(None).cast("string"), "halves": F.lit(None).cast(_HALVES)}

    def made(**given: Column) -> Column:
        fields = nothing | given
        return F.struct(*(fields[n].alias(n) for n in ("exact", "digits", "text", "halves"))).cast(AMOUNT)

    return (
        F.when(text.rlike(_PLAIN_EXACT), made(exact=text.try_cast(EXACT), digits=digits))
        .when(text.rlike(_PLAIN_WIDE), made(text=text, digits=digits, halves=_halves(text)))
        .otherwise(made(exact=exact, digits=fraction_digits(value), text=other))
    )


def _halves(text: Column) -> Column:
    """The digits before the point, and those behind it filled up to 28, of plain text; both with its sign."""
    sign, digits = F.when(text.startswith("-"), "-").otherwise(""), F.translate(text, "+-", "")
    fraction = F.when(F.instr(digits, ".") > 0, F.substring_index(digits, ".", -1)).otherwise("")
    return F.struct(
        F.concat(sign, F.substring_index(digits, ".", 1)).cast(_WHOLE).alias("whole"),
        F.concat(sign, F.rpad(fraction, _HALF, "0")).cast(_WHOLE).alias("part"),
    ).cast(_HALVES)


def is_amount(item: Column) -> Column:
    return item["exact"].isNotNull() | item["text"].isNotNull()


def total_text(plus: Column, minus: Column | None = None) -> Column:
    """Sum of an array of amounts, less that of another one, as plain text with the most digits behind the
    point that any of them was written with. What is no number counts zero.

    Sums that ``decimal(38,18)`` holds are made of decimals. Those of amounts with at most 28 digits on either
    side of the point are made of two, one for each side. Others, of any size, are made of limbs of nine digits
    with carry.
    """
    sides = [plus] if minus is None else [plus, minus]
    digits = F.greatest(F.lit(0), *(F.array_max(F.transform(s, lambda a: F.when(is_amount(a), a["digits"]))) for s in sides))
    zero = F.lit(0).cast(EXACT)

    def short(side: Column) -> Column:
        # a flag beside the sum, as a fold that starts from a number is taken to stay one
        start = F.struct(zero.alias("sum"), F.lit(True).alias("held"))

        def add(total: Column, a: Column) -> Column:
            more = F.try_add(total["sum"], F.coalesce(a["exact"], zero)).try_cast(EXACT)
            held = total["held"] & a["text"].isNull() & more.isNotNull()
            return F.struct(F.coalesce(more, zero).alias("sum"), held.alias("held"))

        return F.aggregate(side, start, add)

    def numbers(side: Column, sign: int) -> Column:
        return F.filter(F.transform(side, lambda a: _number_of(a, sign)), lambda n: n["digits"].isNotNull())

    def shown(x: Column) -> Column:
        held, quick, terms = x["plus_sum"]["held"], x["plus_sum"]["sum"], numbers(x["plus"], 1)
        if minus is not None:
            quick = F.try_subtract(quick, x["minus_sum"]["sum"]).try_cast(EXACT)
            held = held & x["minus_sum"]["held"] & quick.isNotNull()
            terms = F.concat(terms, numbers(x["minus"], -1))
        two = F.lit(True)
        for name in ("plus", "minus")[: len(sides)]:
            two = two & F.forall(x[name], lambda a: a["text"].isNull() | a["halves"].isNotNull())
        wide = _bound(
            F.struct(*(_halves_sum(x[name]).alias(name) for name in ("plus", "minus")[: len(sides)])),
            lambda sums: _halves_text(sums["plus"], None if minus is None else sums["minus"], x["digits"]),
        )
        return (
            F.when(held, decimal_text(quick, x["digits"])).when(two, wide).otherwise(_limbs(terms, x["digits"]))
        )

    named = zip(("plus", "minus"), sides, strict=False)
    parts = [(side.alias(name), short(side).alias(f"{name}_sum")) for name, side in named]
    return F.transform(F.array(F.struct(digits.alias("digits"), *(c for pair in parts for c in pair))), shown)[0]


def _bound(value: Column, use) -> Column:
    """A value that is computed once and used often."""
    return F.transform(F.array(value), use)[0]


def _halves_sum(side: Column) -> Column:
    """Sums of either half. An array has fewer than 2^31 amounts, so that 38 digits hold them."""
    zero = F.lit(0).cast(_WHOLE)
    start = F.struct(zero.alias("whole"), zero.alias("part")).cast(_HALVES)

    def add(total: Column, a: Column) -> Column:
        own = F.coalesce(a["halves"], F.when(a["exact"].isNotNull(), _halves(a["exact"].cast("string"))))
        return F.when(own.isNull(), total).otherwise(
            F.struct(*((total[h] + own[h]).cast(_WHOLE).alias(h) for h in ("whole", "part"))).cast(_HALVES)
        )

    return F.aggregate(side, start, add)


def _halves_text(plus: Column, minus: Column | None, digits: Column) -> Column:
    """Text of a sum, or of one less another, with ``digits`` digits behind the point."""
    one = F.lit("1" + "0" * _HALF).cast(_WHOLE)
    whole, part = (plus[h] if minus is None else (plus[h] - minus[h]).cast(_WHOLE) for h in ("whole", "part"))

    def carried(left: Column) -> Column:
        more = F.call_function("div", (part - left).cast(_WHOLE), one)
        return F.struct((whole + more).cast(_WHOLE).alias("whole"), left.alias("part"))

    def shown(total: Column) -> Column:
        # a part is never negative here: -1.25 is -2 and 0.75
        negative, some = total["whole"] < 0, total["part"] > 0
        before = F.abs(F.when(negative & some, total["whole"] + 1).otherwise(total["whole"])).cast(_WHOLE).cast("string")
        behind = F.when(negative & some, one - total["part"]).otherwise(total["part"]).cast(_WHOLE).cast("string")
        padded = F.rpad(F.lpad(behind, _HALF, "0"), digits, F.lit("0"))
        text = F.when(digits > 0, F.concat(before, F.lit("."), padded)).otherwise(before)
        return F.when(negative, F.concat(F.lit("-"), text)).otherwise(text)

    return _bound(_bound(F.pmod(part, one).cast(_WHOLE), carried), shown)


def _number_of(item: Column, sign: int) -> Column:
    """Sign, all digits and how many of them are behind the point."""
    text = F.coalesce(item["text"], item["exact"].cast("string"))
    _, digits, first = _digits(text)
    far = text.rlike("[eE]") & (first == "") & F.coalesce(F.abs(_exponent(text)) > MOST_DIGITS, F.lit(True))
    exponent = F.when(far, F.lit(0).cast("bigint")).otherwise(_exponent(text))  # zero is zero
    scale = F.length(F.regexp_extract(text, _FRACTION, 1)) - exponent
    too_long = F.coalesce(F.abs(exponent) > MOST_DIGITS, F.lit(True)) & text.rlike("[eE]")
    error = F.raise_error(F.concat(F.lit("a sum of amounts has too many digits: "), F.left(text, F.lit(60))))
    padded = F.concat(digits, F.repeat(F.lit("0"), F.greatest(F.lit(0), -scale).cast("int")))
    return F.struct(
        F.when(text.startswith("-"), F.lit(-sign)).otherwise(F.lit(sign)).cast("bigint").alias("sign"),
        F.when(too_long, error.cast("string")).otherwise(padded).alias("digits"),
        F.greatest(F.lit(0), scale).cast("int").alias("scale"),
    )


def _limbs(numbers: Column, digits: Column) -> Column:
    """Sum of such numbers as text with ``digits`` digits behind the point."""
    scale = F.greatest(digits, F.coalesce(F.array_max(F.transform(numbers, lambda n: n["scale"])), digits))

    def summed(x: Column) -> Column:
        def limb(k: Column) -> Column:
            start = x["width"] - (k + 1) * _LIMB + 1
            part = lambda n: F.substring(n["digits"], start, F.lit(_LIMB)).cast("bigint") * n["sign"]
            return F.aggregate(x["aligned"], F.lit(0).cast("bigint"), lambda total, n: total + part(n))

        return F.transform(F.sequence(F.lit(0), F.floor(x["width"] / _LIMB).cast("int") - 1), limb)

    def carried(limbs: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

        def step(state: Column, limb: Column) -> Column:
            total = limb + state["carry"]
            left = F.pmod(total, F.lit(10**_LIMB))
            return F.struct(
                F.floor((total - left) / F.lit(10**_LIMB).cast("decimal(20,0)")).cast("bigint").alias("carry"),
                F.concat(state["out"], F.array(left)).alias("out"),
            )

        return F.aggregate(limbs, start, step)

    def written(limbs: Column) -> Column:
        digits_of = F.array_join(F.transform(F.reverse(limbs), lambda v: F.lpad(v.cast("string"), _LIMB, "0")), "")
        # what decimals have more of than was written are zeros
        plain = F.regexp_replace(F.left(digits_of, F.length(digits_of) - (scale - digits)), "^0+", "")
        return F.lpad(plain, F.greatest(F.length(plain), digits + 1), F.lit("0"))

    def pointed(text: Column) -> Column:
        whole = F.left(text, F.length(text) - digits)
        return F.when(digits > 0, F.concat(whole, F.lit("."), F.right(text, digits))).otherwise(whole)

    def shown(x: Column) -> Column:
        # a negative sum leaves a negative carry: then its opposite is written
        negative = x["carried"]["carry"] < 0
        opposite = carried(F.transform(x["limbs"], lambda v: -v))["out"]
        text = _bound(written(F.when(negative, opposite).otherwise(x["carried"]["out"])), pointed)
        return F.when(negative, F.concat(F.lit("-"), text)).otherwise(text)

    def aligned(scale: Column) -> Column:
        return F.transform(
            numbers,
            lambda n: F.struct(n["sign"].alias("sign"), F.concat(n["digits"], F.repeat(F.lit("0"), scale - n["scale"])).alias("digits")),
        )

    def padded(rows: Column) -> Column:
        # two limbs to spare take the carry of any number of amounts
        width = (F.floor(F.array_max(F.transform(rows, lambda n: F.length(n["digits"]))) / _LIMB).cast("int") + 3) * _LIMB
        return _bound(
            width,
            lambda w: F.struct(
                w.alias("width"),
                F.transform(rows, lambda n: F.struct(n["sign"].alias("sign"), F.lpad(n["digits"], w, F.lit("0")).alias("digits"))).alias("aligned"),
            ),
        )

    rows = _bound(_bound(scale, aligned), padded)
    return _bound(_bound(_bound(rows, summed), lambda v: F.struct(v.alias("limbs"), carried(v).alias("carried"))), shown)


def decimal_text(value: Column, digits: Column) -> Column:
    """Plain text of an exact decimal with the given number of fraction digits."""
    text = value.cast(EXACT).cast("string")
    whole = F.length(text) - F.lit(EXACT_DIGITS)
    kept = F.when(digits > 0, whole + F.least(digits, F.lit(EXACT_DIGITS))).otherwise(whole - 1)
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), digits - EXACT_DIGITS).cast("int"))
    return F.concat(F.substring(text, F.lit(1), kept.cast("int")), zeros)
