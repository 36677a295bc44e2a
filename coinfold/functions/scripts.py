"""Script bytes as SQL expressions over hexadecimal text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Script operation codes and their names.
OP_0 = 0x00
LAST_DIRECT_PUSH = 75
PUSH_LENGTH_BYTES = {76: 1, 77: 2, 78: 4}
PUSH_NAMES = {76: "OP_PUSHDATA1", 77: "OP_PUSHDATA2", 78: "OP_PUSHDATA4"}
OP_1, OP_16 = 0x51, 0x60
OP_RETURN = 0x6A

WORDS_AT_ONCE = 128
STRIDE = 64
_NO_HEX = r"[^0-9a-f\s]"
# One whole operation of a script that holds no push with length bytes: a direct push with its data, or a byte.
_PUSHES = "|".join(
    f"{high:x}(?:{'|'.join(f'{n % 16:x}[0-9a-f]{{{2 * n}}}' for n in range(max(1, 16 * high), min(16 * high + 15, LAST_DIRECT_PUSH) + 1))})"
    for high in range(LAST_DIRECT_PUSH // 16 + 1)
)
_OPERATION = rf"(?:00|4f|[5-9a-f][0-9a-f]|{_PUSHES})"
# Possessive, so that it is matched in a loop and takes no stack frame per operation.
_PLAIN_SCRIPT = rf"^{_OPERATION}++\z"
_PLAIN_RETURN = rf"^6a(?:{_PUSHES})(?:[0-9a-f]{{2}})*+\z"


def _bare_hex(script: Column) -> Column:
    """Lower-case digits without prefix; null when the text is not whole bytes.

    Blanks may stand between bytes. Each test is one pass without a repeated group, whose
    matching would take a stack frame per byte.
    """
    text = F.regexp_replace(F.lower(F.trim(script)), "^0x", "")
    whole = F.forall(F.split(text, r"\s+"), lambda run: F.length(run) % 2 == 0)
    return F.when(~text.rlike(_NO_HEX) & whole, F.regexp_replace(text, r"\s", ""))


def _byte(hex_text: Column, index: Column) -> Column:
    """Value of the byte at a zero-based index."""
    return F.conv(F.substring(hex_text, index * 2 + 1, F.lit(2)), 16, 10).cast("bigint")


def _little_endian(hex_text: Column, index: Column, width: int) -> Column:
    total = _byte(hex_text, index)
    for i in range(1, width):
        total = total + _byte(hex_text, index + i) * F.lit(256**i)
    return total


def _by_width(op: Column, value, otherwise: Column) -> Column:
    """``value(width)`` for the opcode that carries a length of that width."""
    choice = None
    for code, width in PUSH_LENGTH_BYTES.items():
        choice = (F if choice is None else choice).when(op == code, value(width))
    return choice.otherwise(otherwise)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def op_return_payload(script: Column) -> Column:
    """Payload of the first push behind OP_RETURN.

    A bare OP_RETURN gives the empty string. Null for other scripts, for a push that runs
    past the end and for anything but a push behind OP_RETURN.
    """

    def pushed(hx: Column) -> Column:
        size = (F.length(hx) / 2).cast("int")
        op = _byte(hx, F.lit(1))
        width = _by_width(op, lambda w: F.lit(w), F.lit(0))
        length = _by_width(op, lambda w: _little_endian(hx, F.lit(2), w), op)
        start = width + 2
        inside = (start <= size) & (start + length <= size)
        data = F.substring(hx, (start * 2 + 1).cast("int"), (length * 2).cast("int"))
        return F.when(size == 1, F.lit("")).when((op <= max(PUSH_LENGTH_BYTES)) & inside, data)

    is_return = F.lower(F.trim(script)).rlike("^(?:0x)?6a")
    # Plain text whose first push is a direct one needs no arithmetic on bytes.
    return (
        F.when(script == "6a", F.lit(""))
        .when(script.rlike(_PLAIN_RETURN), F.substring(script, F.lit(5), 2 * _byte(script, F.lit(1)).cast("int")))
        .when(is_return, _bind(_bare_hex(script), pushed))
    )


def disassemble(script: Column) -> Column:
    """Readable operations of a script; null for missing, malformed or truncated scripts.

    Plain text without pushes that carry their length is cut into operations by one expression, see
    :func:`_plain_operations`. Others are read by a fold over the bytes: every step reads the operation at the
    current position and moves behind it; steps behind the end do nothing. The words are listed, and joined to
    a text whenever there are many, so that a long script's words are not copied at each operation.
    """
    state_type = "struct<at:int,words:array<string>,texts:array<string>>"

    def read(state: Column, behind: Column, *token: Column) -> Column:
        def kept(words: Column) -> Column:
            full = F.size(words) >= WORDS_AT_ONCE
            texts = F.concat(state["texts"], F.array(F.array_join(words, " ")))
            return F.struct(
                behind.cast("int").alias("at"),
                F.when(full, F.array().cast("array<string>")).otherwise(words).alias("words"),
                F.when(full, texts).otherwise(state["texts"]).alias("texts"),
            ).cast(state_type)

        return _bind(F.concat(state["words"], F.array(*token)), kept)

    def operation(data: Column, size: Column, state: Column, op: Column) -> Column:
        after = state["at"] + 1

        def push(name: Column, data_at: Column, length: Column) -> Column:
            behind = data_at + length
            pushed = F.hex(F.substring(data, (data_at + 1).cast("int"), length.cast("int")))
            return F.when(behind <= size, read(state, behind, name, pushed))

        def long_push(code: int, width: int) -> Column:
            # Without whole length bytes the length is null, and so is the new state.
            length = F.when(after + width <= size, _number_at(data, after, width))
            return push(F.lit(PUSH_NAMES[code]), after + width, length)

        result = F.when(
            op.between(1, LAST_DIRECT_PUSH),
            push(F.concat(F.lit("OP_PUSHBYTES_"), op.cast("string")), after, op),
        )
        for code, width in PUSH_LENGTH_BYTES.items():
            result = result.when(op == code, long_push(code, width))
        return result.otherwise(read(state, after, _name(op, F.lpad(F.hex(op), 2, "0"))))

    def step(data: Column, size: Column, state: Column) -> Column:
        # A null state marks a truncated push; behind the end the state stays as it is.
        at = state["at"]
        following = _bind(_number_at(data, at, 1), lambda op: operation(data, size, state, op))
        return F.when(at >= size, state).when(at < size, following)

    def scan(data: Column, size: Column) -> Column:
        nothing = F.array().cast("array<string>")
        start = F.struct(F.lit(0).alias("at"), nothing.alias("words"), nothing.alias("texts"))

        # As many steps as bytes, in strides: behind the end a whole stride is one step that does nothing.
        def stride(state: Column) -> Column:
            steps = F.sequence(F.lit(1), F.least(size, F.lit(STRIDE)))
            more = F.aggregate(steps, state, lambda inner, _: step(data, size, inner))
            return F.when(state["at"] >= size, state).when(state["at"] < size, more)

        text = F.aggregate(
            F.sequence(F.lit(1), F.ceil(size / STRIDE).cast("int")),
            start.cast(state_type),
            lambda state, _: stride(state),
            lambda state: F.when(state.isNotNull(), F.array_join(F.concat(state["texts"], state["words"]), " ")),
        )
        return F.when(size == 0, F.lit("")).when(size > 0, text)

    def run(data: Column) -> Column:
        return _bind(F.octet_length(data), lambda size: scan(data, size))

    # as bytes, where a position is found without reading what is before it
    return F.when(script.rlike(_PLAIN_SCRIPT), _plain_operations(script)).when(
        F.length(script) > 0, _bind(F.unhex(_bare_hex(script)), run)
    )


def _name(op: Column, in_hex: Column) -> Column:
    """Name of an operation that pushes no data."""
    return (
        F.when(op == OP_0, F.lit("OP_0"))
        .when(op.between(OP_1, OP_16), F.concat(F.lit("OP_"), (op - OP_1 + 1).cast("string")))
        .when(op == OP_RETURN, F.lit("OP_RETURN"))
        .otherwise(F.concat(F.lit("OP_UNKNOWN_0x"), in_hex))
    )


def _plain_operations(script: Column) -> Column:
    """Readable operations of a script that :data:`_PLAIN_SCRIPT` matches."""

    def read(operation: Column) -> Column:
        def shown(op: Column) -> Column:
            data = F.upper(F.substring(operation, F.lit(3), F.length(operation)))
            push = F.concat(F.lit("OP_PUSHBYTES_"), op.cast("string"), F.lit(" "), data)
            return F.when(op.between(1, LAST_DIRECT_PUSH), push).otherwise(_name(op, F.upper(operation)))

        return _bind(_byte(operation, F.lit(0)), shown)

    return F.array_join(F.transform(F.regexp_extract_all(script, F.lit(f"({_OPERATION})"), F.lit(1)), read), " ")


def _number_at(data: Column, index: Column, width: int) -> Column:
    """Little-endian number of some bytes at a zero-based index."""
    total = None
    for i in range(width):
        byte = F.conv(F.hex(F.substring(data, (index + 1 + i).cast("int"), F.lit(1))), 16, 10).cast("bigint")
        total = byte if total is None else total + byte * F.lit(256**i)
    return total
