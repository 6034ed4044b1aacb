"""Scalar functions of the decoding step, as Column expressions: no Python runs on a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(entries: Column, name: str, required: bool = True) -> Column:
    """The value of a JSON object's member (map<string, variant>) by name: exactly, or else regardless of case.

    A missing member is an error (null if not required); a JSON null is null.
    """
    loose = F.get(F.filter(F.map_entries(entries), lambda e: F.lower(e["key"]) == name.lower()), F.lit(0))
    other = loose["value"]
    if required:
        other = F.when(loose.isNull(), F.raise_error(F.lit(f"no member {name} in the change"))).otherwise(other)
    # the exact name is a plain lookup; the slower search runs only for rows without it
    return F.when(entries.isNull(), None).when(
        F.map_contains_key(entries, name), F.try_element_at(entries, F.lit(name))
    ).otherwise(other)


def has_field(entries: Column, name: str) -> Column:
    """Whether the object has the member at all; a JSON null counts as there."""
    found = F.map_contains_key(entries, name) | F.exists(F.map_keys(entries), lambda k: F.lower(k) == name.lower())
    return F.coalesce(found, F.lit(False))


def clean_text(x: Column) -> Column:
    """Text without the zero character, which the target's text types do not hold."""
    return F.replace(x, F.lit("\x00"), F.lit(""))


def binary_of_base64(x: Column) -> Column:
    return F.unbase64(x)


def bits_of_int(x: Column, width: int) -> Column:
    """A bit string of at least `width` digits; wider values keep all of theirs."""
    digits = F.bin(x.cast("bigint"))
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def _bytes(x: Column) -> Column:
    """The two hex digits of each byte of a binary."""
    digits = F.hex(x)
    return F.when(F.length(digits) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(2)), F.lit(2)),
            lambda i: F.substr(digits, i, F.lit(2))
        )
    )


def bits_of_base64(x: Column, width: int) -> Column:
    """A bit string: 'true' and 'false' are 1 and 0; else Base64 of little-endian bytes, the last `width` bits."""
    octets = F.transform(
        F.reverse(_bytes(F.try_to_binary(x, F.lit("base64")))), lambda h: F.lpad(F.conv(h, 16, 2), 8, "0")
    )
    digits = F.concat_ws("", octets)
    return F.when(F.lower(x) == "true", "1").when(F.lower(x) == "false", "0").when(x.isNull(), None).otherwise(
        F.right(F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")), F.lit(width))
    )


def date_of_days(x: Column) -> Column:
    return F.date_from_unix_date(x.cast("int"))


def _whole(x: Column, by: int) -> Column:
    """x floored to a multiple of `by` and divided by it, without a detour through floating point."""
    return ((x - F.pmod(x, F.lit(by))).cast("decimal(20,0)") / F.lit(by).cast("decimal(15,0)")).cast("bigint")


def micros_of_nanos(x: Column) -> Column:
    """Whole microseconds at or before so many nanoseconds; exact for negative values."""
    return _whole(x, 1000)


def timestamp_of_nanos(x: Column, scale: int = 6) -> Column:
    """Timestamp of nanoseconds since the epoch, its fraction cut to `scale` digits (six at most)."""
    unit = 10 ** (9 - min(scale, 6))
    return F.timestamp_micros(_whole(x - F.pmod(x, F.lit(unit)), 1000))


def time_of_nanos(x: Column, scale: int = 0) -> Column:
    """HH:mm:ss with `scale` digits of fraction, of nanoseconds since midnight (of any day)."""
    day = F.pmod(x, F.lit(86_400_000_000_000))
    seconds = _whole(day, 10**9)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat_ws(
        ":", two(F.floor(seconds / 3600)), two(F.floor(F.pmod(seconds, F.lit(3600)) / 60)),
        two(F.pmod(seconds, F.lit(60)))
    )
    if scale <= 0:
        return text
    fraction = F.substring(F.lpad(F.pmod(day, F.lit(10**9)).cast("string"), 9, "0"), 1, scale)
    return F.concat(text, F.lit("."), fraction)


def decimal_of_base64(x: Column, precision: int, scale: int) -> Column:
    """Decimal of a Base64 two's-complement big-endian unscaled value; over 38 digits is an error."""
    digits = F.hex(F.unbase64(x))
    # up to eight bytes: sign-extended to 64 bits and read at once
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
    short = F.conv(F.lpad(digits, F.lit(16), sign), 16, -10).cast("decimal(38,0)")
    octets = F.transform(_bytes(F.unbase64(x)), lambda h: F.conv(h, 16, 10).cast("decimal(38,0)"))
    raw = F.aggregate(octets, F.lit(0).cast("decimal(38,0)"), lambda a, b: (a * F.lit(256) + b).cast("decimal(38,0)"))
    span = F.aggregate(octets, F.lit(1).cast("decimal(38,0)"), lambda a, _: (a * F.lit(256)).cast("decimal(38,0)"))
    long = F.when(F.get(octets, F.lit(0)) >= 128, raw - span).otherwise(raw).cast("decimal(38,0)")
    value = F.when(F.length(digits) <= 16, short).otherwise(long)
    one = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({max(scale, 1)},{scale})")
    return (
        value.cast(f"decimal({max(precision, 1)},0)") * one
    ).cast(f"decimal({precision},{scale})") if scale else value.cast(f"decimal({precision},0)")


def millis_of_seconds(x: Column) -> Column:
    return x * F.lit(1000)


def topic_suffix(topic: Column) -> Column:
    """From the topic's first dot on."""
    return F.substr(topic, F.instr(topic, "."))


# Rendering for bulk text loads and for comparison.


def quoted_text(x: Column) -> Column:
    """A text cell of the load format: quoted, quote and backslash escaped by a backslash, no zero character."""
    return F.concat(F.lit('"'), F.regexp_replace(clean_text(x), r'(["\\])', r"\\$1"), F.lit('"'))


def octal_text(x: Column) -> Column:
    """Binary as text: backslash doubled, bytes outside the printable ASCII range as backslash and three octal digits."""

    def one(h: Column) -> Column:
        n = F.conv(h, 16, 10).cast("int")
        return F.when(n == 92, F.lit("\\\\")).when(
            (n < 32) | (n > 126), F.concat(F.lit("\\"), F.lpad(F.conv(h, 16, 8), 3, "0"))
        ).otherwise(F.chr(n))

    return F.when(x.isNotNull(), F.concat_ws("", F.transform(_bytes(x), one)))


def load_cell(x: Column, kind: str) -> Column:
    """A cell of the load format by Spark type name; null is the empty unquoted cell."""
    if kind in ("string", "char", "varchar"):
        cell = quoted_text(x)
    elif kind == "binary":
        cell = octal_text(x)
    else:
        cell = x.cast("string")
    return F.coalesce(cell, F.lit(""))


def plain_decimal(x: Column) -> Column:
    """A decimal without trailing zeros of its fraction."""
    text = x.cast("string")
    return F.when(
        F.instr(text, ".") > 0, F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")
    ).otherwise(text)


def compared_cell(x: Column, kind: str) -> Column:
    """A cell as it is compared: None for null, hex for binary, 1 and 0 for booleans, decimals without zeros."""
    if kind == "binary":
        cell = F.lower(F.hex(x))
    elif kind == "boolean":
        cell = x.cast("int").cast("string")
    elif kind.startswith("decimal"):
        cell = plain_decimal(x)
    else:
        cell = x.cast("string")
    return F.coalesce(cell, F.lit("None"))
