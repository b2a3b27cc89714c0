"""Text rendering and parsing of typed columns.

Every rule here is a built-in Spark expression, so rendering a row stays
inside whole-stage codegen; nothing goes through Python per row.

Rendering (export):
  * NULL becomes an empty field.
  * A value that is empty or consists only of NUL characters gets one more NUL
    character appended, so that an empty string survives the trip and is not
    confused with NULL. Parsing removes exactly one NUL again.
  * booleans as 1 / 0, binary as upper-case hex, arrays / maps / structs as
    JSON, timestamps as their UTC wall clock, every other supported type through ``cast(... as string)``.

Parsing (import) has two NULL policies:
  * ``"marker"``: empty field -> NULL, NUL-only field -> one NUL fewer
    (the exact inverse of rendering);
  * ``"tokens"``: the fields ``NULL``, ``null`` and the empty field -> NULL
    (the token rules of an inferred-schema load).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.text import quoted

NUL = "\u0000"

# Tokens read as NULL by the "tokens" policy.
NULL_TOKENS = ("NULL", "null")

_CAST_TO_STRING = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType,
    T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)
# Inside JSON: microseconds and an offset, in UTC, so nested instants survive as well.
_JSON_OPTIONS = {"timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                 "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_JSON_TYPES = (T.ArrayType, T.MapType, T.StructType)
_STRING_TYPES = (T.StringType, T.CharType, T.VarcharType)


class UnsupportedTypeError(TypeError):
    """A column type with no text mapping (the reference's "missing mapping" guard)."""


def is_supported(dt: T.DataType) -> bool:
    return isinstance(dt, _CAST_TO_STRING + _JSON_TYPES + _STRING_TYPES + (T.BooleanType, T.BinaryType, T.NullType))


def _raw_text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    if isinstance(dt, _JSON_TYPES):
        return F.to_json(c, _JSON_OPTIONS)
    if isinstance(dt, _STRING_TYPES):
        return c
    if isinstance(dt, T.TimestampType):
        return _utc_text(c)
    if isinstance(dt, _CAST_TO_STRING):
        return c.cast("string")
    raise UnsupportedTypeError(f"no text mapping for type {dt.simpleString()}")


def _utc_text(instant: Column) -> Column:
    """An instant as its UTC wall clock, whatever the session's zone: two instants never share a text."""
    micros = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    none = F.lit(0)
    return (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(none, none, none, micros)).cast("string")


def _utc_instant(text: Column) -> Column:
    """Text of an instant with UTC as its zone, unless it names one itself."""
    zoned = text.rlike(r"(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2}){0,2})$") & text.contains(":")
    return F.when(zoned, text).otherwise(F.concat(text, F.when(text.contains(":"), F.lit("Z")).otherwise(F.lit(" 00:00:00Z"))))


def render(c: Column | str, dt: T.DataType, nulls: str = "marker") -> Column:
    """Field text of a value: NULL stays NULL here (the encoder makes it empty).

    ``nulls="tokens"`` writes values plainly (no NUL marker): under that policy
    an empty string, ``NULL`` and ``null`` read back as NULL, by design.
    """
    col = F.col(quoted(c)) if isinstance(c, str) else c
    txt = _raw_text(col, dt)
    if nulls == "tokens":
        return txt
    if isinstance(dt, _STRING_TYPES):
        nul_only = (txt == "") | (txt.startswith(NUL) & (F.length(F.replace(txt, F.lit(NUL), F.lit(""))) == 0))
        return F.when(nul_only, F.concat(txt, F.lit(NUL))).otherwise(txt)
    if isinstance(dt, T.BinaryType):
        return F.when(txt == "", F.lit(NUL)).otherwise(txt)
    return txt


def render_field(name: str, dt: T.DataType, nulls: str = "marker") -> Column:
    """Rendered field with NULL as the empty string (what lands in the file)."""
    return F.coalesce(render(name, dt, nulls), F.lit(""))


def untoken(field: Column, nulls: str = "marker") -> Column:
    """Apply a NULL policy to a raw field string; result is the value text or NULL."""
    if nulls == "marker":
        return (F.when(field == "", F.lit(None).cast("string"))
                .when(field.startswith(NUL) & (F.length(F.replace(field, F.lit(NUL), F.lit(""))) == 0),
                      F.substring(field, 2, 1 << 30))
                .otherwise(field))
    if nulls == "tokens":
        return F.when(field.isin("", *NULL_TOKENS), F.lit(None).cast("string")).otherwise(field)
    raise ValueError(f"unknown NULL policy {nulls!r}")


def parse(text: Column, dt: T.DataType, strict: bool = True) -> Column:
    """Typed value from value text (already passed through ``untoken``).

    ``strict`` uses ANSI casts, so a field that does not fit the type fails the
    job (the import reports the error); otherwise such fields become NULL.
    """
    if isinstance(dt, _STRING_TYPES):
        return text
    if isinstance(dt, T.NullType):
        return F.lit(None)
    if isinstance(dt, T.BooleanType):
        as_bool = F.when(text == "1", F.lit(True)).when(text == "0", F.lit(False))
        rest = text.cast("boolean") if strict else text.try_cast("boolean")
        return as_bool.otherwise(rest)
    if isinstance(dt, T.BinaryType):
        if not strict:
            return F.unhex(text)
        bad = text.isNotNull() & F.unhex(text).isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit("not a hex field: "), F.substring(text, 1, 100))).cast("binary")) \
            .otherwise(F.unhex(text))
    if isinstance(dt, _JSON_TYPES):
        return F.from_json(text, dt, {**_JSON_OPTIONS, "mode": "FAILFAST" if strict else "PERMISSIVE"})
    if isinstance(dt, T.TimestampType):
        return _utc_instant(text).cast(dt) if strict else _utc_instant(text).try_cast(dt)
    if isinstance(dt, _CAST_TO_STRING):
        return text.cast(dt) if strict else text.try_cast(dt)
    raise UnsupportedTypeError(f"no text mapping for type {dt.simpleString()}")


def type_label(dt: T.DataType) -> str:
    """Stable, engine-neutral type name used in plans and exclusion lists."""
    return dt.typeName() if not isinstance(dt, T.DecimalType) else "decimal"


def rendering_rule(dt: T.DataType) -> str:
    """How a type lands as text (the type map's "file type" column)."""
    if isinstance(dt, T.NullType):
        return "always empty"
    if isinstance(dt, T.BooleanType):
        return "1 / 0"
    if isinstance(dt, T.BinaryType):
        return "hex"
    if isinstance(dt, _JSON_TYPES):
        return "json"
    if isinstance(dt, _STRING_TYPES):
        return "as is"
    if isinstance(dt, _CAST_TO_STRING):
        return "cast as string"
    raise UnsupportedTypeError(f"no text mapping for type {dt.simpleString()}")


def max_text_length(dt: T.DataType) -> int | None:
    """Longest text a value of ``dt`` can render to, in characters; None if unbounded.

    Derived from the type, not from data: integer types by their digit count
    plus sign, decimals by precision plus sign and point, doubles / floats by
    the longest shortest-round-trip form, dates and timestamps by their
    pattern (years 1-9999, microseconds), fixed / bounded strings by length.
    """
    if isinstance(dt, T.NullType):
        return 0
    if isinstance(dt, T.BooleanType):
        return 1
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    for t, d in digits.items():
        if isinstance(dt, t):
            return d + 1
    if isinstance(dt, T.DecimalType):
        return dt.precision + 2 + (1 if dt.scale == dt.precision else 0)
    if isinstance(dt, T.DoubleType):
        return 24      # e.g. -2.2250738585072014E-308
    if isinstance(dt, T.FloatType):
        return 15      # e.g. -1.17549435E-38
    if isinstance(dt, T.DateType):
        return 10
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return 26
    if isinstance(dt, (T.CharType, T.VarcharType)):
        return dt.length
    return None


def type_map(dts: list[T.DataType]) -> list[tuple[str, str, int | None]]:
    """(type, rendering rule, max text length) for the given types."""
    return [(dt.simpleString(), rendering_rule(dt), max_text_length(dt)) for dt in dts]

