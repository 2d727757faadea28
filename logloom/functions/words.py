"""Solidity words as Spark expressions.

A log's data is decoded to bytes once and cut into 32-byte binary *words*: a binary slice is a copy,
while a slice of a long string scans it from its start. Topics stay text, since an address topic is
taken as it stands, hex or not. Everything here is a built-in expression, and nothing depends on the
session's ANSI flag: hex is validated before it is converted, and overflowing numbers become NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..registry.model import constant

WORD = 32  # bytes
WIDE_MARK = "wide:"
_HEX = "0123456789abcdef"


def bits(kind: str) -> int:
    """``uint16`` -> 16; a bare ``uint`` or ``int`` has 256."""
    return int(kind.lstrip("uint") or 256)


def n_bytes(kind: str) -> int:
    return int(kind.removeprefix("bytes") or WORD)


def is_numeric(kind: str) -> bool:
    return kind == "bool" or kind.startswith(("uint", "int"))


def _zeros(n: int) -> Column:
    return F.lit(bytes(n))


def _slice(data: Column, start: int, length: int) -> Column:
    return F.substring(data, start + 1, length)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, for the rare long conversions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hex_text(data: Column) -> Column:
    return F.lower(F.hex(data))


def without_prefix(text: Column) -> Column:
    """Drops one lower-case ``0x``."""
    return F.when(text.startswith("0x"), F.substr(text, F.lit(3))).otherwise(text)


# -- topics: text ------------------------------------------------------------------------------


def topic_digits(topic: Column) -> Column:
    """Prefix stripped, lower case, left-padded to 64 digits; longer input is kept whole."""
    digits = F.lower(without_prefix(topic))
    return F.when(F.length(digits) < 64, F.lpad(digits, 64, "0")).otherwise(digits)


def is_number_topic(topic: Column) -> Column:
    """Hex digits, however many."""
    return F.unhex(without_prefix(topic)).isNotNull()


def _is_long(topic: Column) -> Column:
    """More than 64 significant digits: a number that no word holds."""
    digits = without_prefix(topic)
    beyond = F.length(digits) - 64
    return (F.length(digits) > 64) & (F.substr(digits, F.lit(1), beyond) != F.repeat(F.lit("0"), beyond))


def topic_address(topic: Column) -> Column:
    """The last 40 digits, whatever they are."""
    padded = F.concat(F.lit("0" * 40), without_prefix(topic))
    return F.concat(F.lit("0x"), F.lower(F.substring(padded, -40, 40)))


def _short_word(topic: Column) -> Column:
    """The last 64 digits as a binary word; NULL when the digits are not hex."""
    padded = F.concat(F.lit("0" * 64), without_prefix(topic))
    return F.unhex(F.substring(padded, -64, 64))


def topic_word(topic: Column) -> Column:
    """The number as a binary word, the largest one for what no word holds; NULL when the digits are not hex.

    No table column takes the largest word, and as a boolean it is true, as any longer number.
    """
    return F.when(_is_long(topic) & is_number_topic(topic), F.lit(b"\xff" * WORD)).otherwise(_short_word(topic))


def topic_text(topic: Column, kind: str) -> Column:
    """The decoded text of an indexed field; numbers may come back marked, see ``finish_text``."""
    if kind == "address":
        return topic_address(topic)
    if kind == "bool":
        return boolean_text(topic_word(topic))
    if is_numeric(kind):
        # every condition reads the word and the length, so that generated code computes them once
        word, short, digits = _short_word(topic), ~_is_long(topic), topic_digits(topic)
        cases, rest = _signed_cases(word, bits(kind)) if kind.startswith("int") else _unsigned_cases(word)
        if kind.startswith("int"):
            # above 2^n for certain: v - 2^n takes one from the digits before the last n bits
            n_digits = bits(kind) // 4
            high = _minus_one(F.substr(digits, F.lit(1), F.length(digits) - n_digits))
            digits = F.concat(high, F.substring(digits, -n_digits, n_digits))
        return _choice([(condition & short, text) for condition, text in cases], F.when(short, rest).otherwise(_marked(digits)))
    if kind.startswith("bytes"):
        return F.concat(F.lit("0x"), F.substring(topic_digits(topic), 1, 2 * n_bytes(kind)))
    return F.concat(F.lit("0x"), topic_digits(topic))


# -- data: binary ------------------------------------------------------------------------------


def data_bytes(data: Column) -> Column:
    """The bytes of a data field, with or without prefix. NULL when it is not hex or of odd length;
    NULL data counts as empty."""
    body = F.coalesce(without_prefix(data), F.lit(""))
    return F.when(F.octet_length(body) % 2 == 0, F.unhex(body))


def data_word(data: Column, position: Column | int) -> Column:
    if isinstance(position, int):
        return _slice(data, WORD * position, WORD)
    return F.substr(data, position * WORD + 1, F.lit(WORD))


def is_strict_word(word: Column, kind: str) -> Column | None:
    """What a strict ABI decoder demands of a data word of this type; None when anything goes."""
    if kind == "bool":
        return word.isin(_zeros(WORD), F.lit(bytes(WORD - 1) + b"\x01"))
    if kind == "address":
        return _slice(word, 0, 12) == _zeros(12)
    if kind.startswith("uint"):
        pad = WORD - bits(kind) // 8
        return _slice(word, 0, pad) == _zeros(pad) if pad else None
    if kind.startswith("int"):
        pad = WORD - bits(kind) // 8
        negative = _slice(word, pad, 1) >= F.lit(b"\x80")
        extension = F.when(negative, F.lit(b"\xff" * pad)).otherwise(_zeros(pad))
        return _slice(word, 0, pad) == extension if pad else None
    if kind.startswith("bytes"):
        size = n_bytes(kind)
        return _slice(word, size, WORD - size) == _zeros(WORD - size) if size < WORD else None
    raise ValueError(f"no data layout for type {kind!r}")


def data_text(word: Column, kind: str) -> Column:
    """The decoded text of a strict data word; numbers may come back marked, see ``finish_text``."""
    if kind == "address":
        return address(word)
    if kind == "bool":
        return boolean_text(word)
    if kind.startswith("uint"):
        return marked_uint_text(word)
    if kind.startswith("int"):
        return signed_text(word)
    return fixed_bytes(word, n_bytes(kind))


# -- values of a binary word -------------------------------------------------------------------


def address(word: Column) -> Column:
    return F.concat(F.lit("0x"), _hex_text(_slice(word, 12, 20)))


def boolean(word: Column) -> Column:
    return word != _zeros(WORD)


def boolean_text(word: Column) -> Column:
    return F.initcap(boolean(word).cast("string"))


def fixed_bytes(word: Column, size: int = WORD) -> Column:
    return F.concat(F.lit("0x"), _hex_text(_slice(word, 0, size)))


def _limb(word: Column, start: int, size: int, sql_type: str) -> Column:
    return F.conv(F.hex(_slice(word, start, size)), 16, 10).cast(sql_type)


def uint_decimal(word: Column) -> Column:
    """decimal(38,0), NULL from 10^38 on. Values below 2^64 take one limb, larger ones two."""
    low = _limb(word, 24, 8, "decimal(20,0)")
    shifted = F.try_multiply(_limb(word, 16, 8, "decimal(20,0)"), F.lit(Decimal(2**64)))
    large = F.try_add(shifted, low).cast("decimal(38,0)")
    return F.when(_slice(word, 0, 24) == _zeros(24), low.cast("decimal(38,0)")).when(
        _slice(word, 0, 16) == _zeros(16), large
    )


def uint_bigint(word: Column) -> Column:
    """bigint, NULL from 2^63 on."""
    return F.when(_slice(word, 0, 24) == _zeros(24), F.conv(F.hex(_slice(word, 24, 8)), 16, 10).try_cast("bigint"))


def uint_int(word: Column) -> Column:
    """int, NULL from 2^31 on."""
    return uint_bigint(word).try_cast("int")


def uint_text(word: Column) -> Column:
    """Exact base-10 text of all 256 bits."""
    return finish_text(marked_uint_text(word))


def marked_uint_text(word: Column) -> Column:
    """Base-10 text below 2^120; larger words come back marked, for ``finish_text`` to spell out.

    Splitting the two steps lets a row convert all its words with plain expressions and pay for
    the wide conversion only where a wide word turns up.
    """
    return _choice(*_unsigned_cases(word))


Cases = tuple[list[tuple[Column, Column]], Column]  # conditions with their texts, and the text where none holds


def _choice(cases: list[tuple[Column, Column]], rest: Column) -> Column:
    chosen = F
    for condition, text in cases:
        chosen = chosen.when(condition, text)
    return chosen.otherwise(rest)


def _unsigned_cases(word: Column) -> Cases:
    low = F.conv(F.hex(_slice(word, 24, 8)), 16, 10)
    shifted = _limb(word, 16, 8, "decimal(20,0)") * F.lit(Decimal(2**64))
    large = (shifted + low.cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    return [(_slice(word, 0, 24) == _zeros(24), low), (_slice(word, 0, 17) == _zeros(17), large)], _marked(F.hex(word))


def _marked(digits: Column, sign: str = "") -> Column:
    return F.concat(F.lit(WIDE_MARK + sign), digits)


def finish_text(text: Column) -> Column:
    """Spells out a marked number, of any number of digits; other texts stay. Hand it a column: it reads it several times."""
    number = F.substr(text, F.lit(len(WIDE_MARK) + 1))
    digits = F.when(number.startswith("-"), F.substr(number, F.lit(2))).otherwise(number)
    value = F.when(F.length(digits) <= 64, _fixed_text(digits, 4))
    for n_longs in range(5, 9):
        value = value.when(F.length(digits) <= 16 * n_longs, _fixed_text(digits, n_longs))
    sign = F.when(number.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(text.startswith(WIDE_MARK), F.concat(sign, value.otherwise(_long_text(digits)))).otherwise(text)


def _fixed_text(digits: Column, n_longs: int) -> Column:
    """Hex digits of at most eight times 64 bits to base 10: 32-bit limbs, base-10^8 column sums of limb x digits of
    2^(32 i), carries. A column sum stays below 16 * 2^32 * 10^8 < 2^63.

    Lambdas are interpreted, so everything is written out and nothing is built for a limb or a column: a product is three
    nodes, a carry three for each column it comes through. The carries into every fifth column are computed once.
    """
    base, block, n_limbs = 10**8, 5, 2 * n_longs
    places = -(-len(str(2 ** (64 * n_longs))) // 16) * 2
    products = [[f"v[{i}] * {w}L" for i in range(n_limbs) if (w := 2 ** (32 * i) // base**j % base)] for j in range(places)]

    def total(j: int, first: int, carried: str) -> str:
        """Column ``j`` with the carry from the columns ``first`` and on, ``carried`` into ``first``."""
        before = total(j - 1, first, carried) + f" div {base}L" if j > first else carried
        return f"(s[{j}] + {before})"

    def digits_at(j: int) -> str:
        first = j - j % block
        return f"{total(j, first, f's[{places + first // block - 1}]' if first else '0L')} % {base}L"

    pairs = [f"lpad(cast({digits_at(j + 1)} * {base}L + {digits_at(j)} AS string), 16, '0')" for j in range(0, places, 2)]
    text = f"concat({', '.join(reversed(pairs))})"
    steps = [
        f"p -> array({', '.join(f'try_cast(conv(substring(p, {16 * i + 1}, 16), 16, -10) AS bigint)' for i in reversed(range(n_longs)))})",
        f"l -> array({', '.join(f'l[{i}] & 4294967295L, shiftrightunsigned(l[{i}], 32)' for i in range(n_longs))})",
        f"v -> array({', '.join(' + '.join(column or ['0L']) for column in products)})",
        f"s -> concat(s, array({', '.join(f'{total(j - 1, 0, '0L')} div {base}L' for j in range(block, places, block))}))",
        f"s -> {text}",
        f"t -> concat(ltrim('0', left(t, {8 * places - 1})), right(t, 1))",
    ]
    value = F.array(F.lpad(digits, 16 * n_longs, "0"))
    for step in steps:
        value = F.call_function("transform", value, F.expr(step))
    return F.get(value, F.lit(0))


def _long_text(digits: Column) -> Column:
    """Hex digits of any number to base 10: Horner's rule over eight digits a step, on limbs of 10^9."""
    base, step = 10**9, 16**8
    zero = F.lit(0).cast("bigint")

    def parts(padded: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded), F.lit(8))
        return F.transform(starts, lambda i: F.conv(F.substr(padded, i, F.lit(8)), 16, 10).try_cast("bigint"))

    def divided(total: Column) -> Column:
        return F.call_function("div", total, F.lit(base).cast("bigint"))

    def carry(acc: Column, limb: Column) -> Column:
        total = limb * step + acc["carry"]
        return F.struct(divided(total).alias("carry"), F.concat(acc["limbs"], F.array(total % base)).alias("limbs"))

    def times_plus(limbs: Column, part: Column) -> Column:
        start = F.struct(part.alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
        # what is left to carry is below 16^8: at most two limbs
        end = lambda acc: F.concat(acc["limbs"], F.when(acc["carry"] == 0, F.array().cast("array<bigint>")).when(acc["carry"] < base, F.array(acc["carry"])).otherwise(F.array(acc["carry"] % base, divided(acc["carry"]))))
        return F.aggregate(limbs, start, carry, end)

    padded = F.lpad(digits, F.ceil(F.length(digits) / 8).cast("int") * 8, F.lit("0"))
    limbs = F.aggregate(_let(padded, parts), F.array().cast("array<bigint>"), times_plus)
    text = F.ltrim(F.array_join(F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), ""), F.lit("0"))
    return _let(text, lambda t: F.when(t == "", F.lit("0")).otherwise(t))


def _minus_one(digits: Column) -> Column:
    """Hex text minus one; the text holds a nonzero digit."""
    kept = F.rtrim(digits, F.lit("0"))
    last = F.translate(F.substring(kept, -1, 1), _HEX[1:], _HEX[:-1])
    return F.rpad(F.concat(F.substr(kept, F.lit(1), F.length(kept) - 1), last), F.length(digits), F.lit("f"))


def _negated(digits: Column) -> Column:
    """2^(4 n) minus the value of n hex digits, not all zero: the complement of the value minus one."""
    return F.translate(_minus_one(digits), _HEX, _HEX[::-1])


def signed_text(word: Column, n_bits: int = 256) -> Column:
    """v - 2^n when v >= 2^(n-1), over the full 256-bit v: upper bits are not masked off. May come back marked.

    With 256 bits this is the two's complement of a sign-extended word.
    """
    return _choice(*_signed_cases(word, n_bits))


def _signed_cases(word: Column, n_bits: int) -> Cases:
    low64, (unsigned, rest) = F.hex(_slice(word, 24, 8)), _unsigned_cases(word)
    if n_bits == 256:
        near = (_slice(word, 0, 24) == F.lit(b"\xff" * 24)) & (_slice(word, 24, 1) >= F.lit(b"\x80"))
        negative = F.when(_slice(word, 0, 1) >= F.lit(b"\x80"), _marked(_negated(_hex_text(word)), "-"))
        return [*unsigned, (near, F.conv(low64, 16, -10))], negative.otherwise(rest)
    n_digits, first = n_bits // 4, WORD - n_bits // 8
    high, low = F.substring(_hex_text(word), 1, 64 - n_digits), F.substring(_hex_text(word), -n_digits, n_digits)
    cases = [
        (_slice(word, 0, first) != _zeros(first), _marked(F.concat(_minus_one(high), low))),
        (_slice(word, first, 1) >= F.lit(b"\x80"), _marked(_negated(low), "-")),
        *unsigned,
    ]
    if n_bits <= 56:
        value = F.conv(low64, 16, 10).cast("bigint")
        signed = value - F.when(value >= 2 ** (n_bits - 1), 2**n_bits).otherwise(0)
        cases.insert(0, (_slice(word, 0, 25) == _zeros(25), signed.cast("string")))
    return cases, rest
