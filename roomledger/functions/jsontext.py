"""Nested columns as JSON text with ", " and ": " between the parts.

The merge rule compares nested values by the length of this text, and the CSV
sink writes it, so the separators and the explicit nulls matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(text: Column) -> Column:
    """A JSON string literal (escaped by the built-in writer, which keeps non-ASCII).

    Few texts have anything to escape; the others are not given to the writer. A pattern sees bytes that are no
    UTF-8 as U+FFFD, so the writer gets these too.
    """
    written = F.to_json(F.array(text))
    escaped = F.substring(written, F.lit(2), F.length(written) - 2)
    plain = ~text.rlike(r'["\\\x00-\x1f\uFFFD]')
    return F.when(plain, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(escaped)


def _decimal(value: Column) -> Column:
    """A double without exponent between 1e7 and 1e16, as a plain decimal."""
    plain = value.cast("string").cast("decimal(38,18)").cast("string")  # the shortest digits
    plain = F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", ".0")
    large = (F.abs(value) >= 1e7) & (F.abs(value) < 1e16)
    return F.when(large, plain).otherwise(value.cast("string"))


def json_text(value: Column, kind: T.DataType) -> Column:
    """JSON text of a column of the given type; a null gives the text null."""
    if isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda e: json_text(e, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda e: F.concat(_quoted(e["key"]), F.lit(": "), json_text(e["value"], kind.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    elif isinstance(kind, T.StructType):
        fields = [
            F.concat(F.lit(f'"{f.name}": '), json_text(value[f.name], f.dataType)) for f in kind
        ]
        text = F.when(
            value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
        )
    elif isinstance(kind, T.StringType):
        text = F.when(value.isNotNull(), _quoted(value))
    elif isinstance(kind, T.DoubleType):
        text = _decimal(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))
