"""Casts from and to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_long(text: Column) -> Column:
    """Integer text as a long; other text fails the query."""
    return text.cast("bigint")


def safe_long(text: Column) -> Column:
    """Integer text as a long; other text ('12.0', 'None') is NULL.

    The pattern keeps the usual 'None' from the cast, where every failure costs
    an exception; integers out of range are left to it.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint"))


def safe_bool(text: Column) -> Column:
    """true/false in any case; other text ('yes', '1') is NULL, unlike with try_cast."""
    lowered = F.lower(text)
    return F.when(lowered == "true", True).when(lowered == "false", False)


def spell(value: Column, data_type: T.DataType, null_text: str | None = "None") -> Column:
    """A value as the extractor spells it: True/False, None, ['a', 'b'], {'k': 1}.

    Text stays as it is, but inside lists, maps and structs it is quoted and
    escaped as Python does it; structs are spelled like maps of their fields, a
    missing field as None.
    """
    text = value if isinstance(data_type, T.StringType) else _literal(value, data_type)
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def _literal(value: Column, data_type: T.DataType) -> Column:
    """A value as Python spells it inside a list; NULL stays NULL."""

    def item(x: Column, kind: T.DataType) -> Column:
        return F.coalesce(_literal(x, kind), F.lit("None"))

    if isinstance(data_type, T.StringType):
        return _quoted(value)
    if isinstance(data_type, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    if isinstance(data_type, T.ArrayType):
        items = F.transform(value, lambda x: item(x, data_type.elementType))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(data_type, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda e: F.concat(item(e["key"], data_type.keyType), F.lit(": "), item(e["value"], data_type.valueType)),
        )
        return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    if isinstance(data_type, T.StructType):
        fields = [F.concat(F.lit(repr(f.name) + ": "), item(value[f.name], f.dataType)) for f in data_type]
        return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}")))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _plain(value.cast("double"))
    return value.cast("string")


#: Characters that Python writes as escapes: controls, formats, unassigned ones, separators but the space.
_UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def _quoted(text: Column) -> Column:
    """Text between quotes: single ones, or double ones if it holds single ones only."""
    double = text.contains("'") & ~text.contains('"')
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    body = F.when(double, body).otherwise(F.replace(body, F.lit("'"), F.lit("\\'")))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(escape))
    body = F.when(
        body.rlike(_UNPRINTABLE), F.array_join(F.transform(F.regexp_extract_all(body, F.lit("(?s)."), 0), _escaped), "")
    ).otherwise(body)
    quote = F.when(double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, body, quote)


def _escaped(char: Column) -> Column:
    """One character, as an escape if it can't be printed."""
    digits = F.lower(F.hex(F.ascii(char)))
    size = F.length(digits)
    escape = (
        F.when(size <= 2, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(size <= 4, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )
    return F.when(char.rlike(_UNPRINTABLE), escape).otherwise(char)


def _plain(number: Column) -> Column:
    """A double as Python spells it: without an exponent from 0.0001 up to below 1e16, otherwise with one like 1e-05."""
    text, size = number.cast("string"), F.abs(number)
    digits = F.rtrim(number.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    exponent = F.concat(
        F.when(power < 0, F.lit("-")).otherwise(F.lit("+")), F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0"))
    )
    special = F.when(F.isnan(number), "nan").when(number == float("inf"), "inf").when(number == float("-inf"), "-inf")
    return F.coalesce(
        special,
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), exponent)),
    )


def strip_pattern(text: Column, pattern: str) -> Column:
    """Remove every match of `pattern`."""
    return F.regexp_replace(text, pattern, "")
