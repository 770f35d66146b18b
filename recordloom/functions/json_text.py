"""Strict JSON reading and JSON-safe writing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON's own white space; Spark's trim() alone would only remove blanks.
_JSON_SPACE = " \t\n\r"
_STRICT_READER = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


# Fixed value: characters that Spark's JSON reader takes as one string.
LARGEST_TEXT = 100_000_000


def is_too_large(text: str) -> str:
    """SQL: is the named text longer (in bytes) than what is read as one document?"""
    return f"coalesce(octet_length(`{text}`) > {LARGEST_TEXT}, false)"


def whole_document(text: Column) -> Column:
    """VARIANT array holding the parsed text, or NULL / a misfit when it is not JSON.

    Spark's parsers stop at the end of the first value and ignore what follows.  The
    text is therefore read as the first element of a two-element array whose second
    element is the text's own hash: only when the text is exactly one JSON value does
    the hash arrive in second place (see :func:`is_whole`).
    """
    closed = F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))
    return F.when(F.octet_length(text) <= LARGEST_TEXT, F.try_parse_json(closed))


def is_whole(document: Column, text: Column) -> Column:
    """True when ``document`` (from :func:`whole_document`) covers all of ``text``."""
    return F.coalesce(
        F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(text), F.lit(False)
    )


def prompt_list(text: Column) -> Column:
    """The elements of a JSON list as ARRAY<VARIANT> plus a digest, or NULL.

    The digest takes the place of the closing bracket, so that text after the list
    cannot go unnoticed.  Unlike one VARIANT for the whole file, the array is not
    subject to the VARIANT size limit; only each element is.
    """
    body = F.trim(text, F.lit(_JSON_SPACE))
    closed = F.concat(
        body.substr(F.lit(1), F.length(body) - 1), F.lit(',"'), F.md5(body), F.lit('"]')
    )
    return F.when(
        body.startswith("[") & body.endswith("]"),
        F.from_json(closed, T.ArrayType(T.VariantType()), _STRICT_READER),
    )


def is_empty_list(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[ \t\n\r]*\[[ \t\n\r]*\][ \t\n\r]*$"), F.lit(False))


def is_string_list(text: Column, elements: str) -> Column:
    """Verdict for a whole prompt file: a JSON list with nothing but strings in it.

    ``elements`` names the column that holds :func:`prompt_list` of ``text``.
    """
    body = F.trim(text, F.lit(_JSON_SPACE))
    complete = F.expr(
        f"try_variant_get(get(`{elements}`, size(`{elements}`) - 1), '$', 'string')"
    ) == F.md5(body)
    only_strings = F.expr(f"forall(`{elements}`, e -> schema_of_variant(e) = 'STRING')")
    return F.coalesce(
        F.is_valid_utf8(text) & (is_empty_list(text) | (complete & only_strings)), F.lit(False)
    )


def string_elements(elements: str) -> Column:
    """The strings of a list that passed :func:`is_string_list` (digest dropped)."""
    listed = f"slice(`{elements}`, 1, size(`{elements}`) - 1)"
    return F.expr(f"transform({listed}, e -> try_variant_get(e, '$', 'string'))")


def _is_plain(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _is_plain(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return isinstance(data_type.keyType, T.StringType) and _is_plain(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return all(_is_plain(f.dataType) for f in data_type.fields)
    return isinstance(
        data_type,
        (
            T.StringType,
            T.BooleanType,
            T.ByteType,
            T.ShortType,
            T.IntegerType,
            T.LongType,
            T.FloatType,
            T.DoubleType,
            T.NullType,
            T.VariantType,
        ),
    )


def _safe(value: Column, data_type: T.DataType) -> Column:
    if _is_plain(data_type):
        return value
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda e: _safe(e, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.map_from_entries(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    e["key"].cast("string").alias("key"),
                    _safe(e["value"], data_type.valueType).alias("value"),
                ),
            )
        )
    if isinstance(data_type, T.StructType):
        packed = F.struct(*[_safe(value[f.name], f.dataType).alias(f.name) for f in data_type])
        return F.when(value.isNotNull(), packed)
    return value.cast("string")


def json_safe(df: DataFrame, *names: str) -> Column:
    """JSON text of the named columns (all by default), nulls kept as explicit keys.

    Lists, structs and maps nest; strings, numbers and booleans stay as they are; any
    other leaf (dates, timestamps, decimals, binary, intervals) becomes its text.
    """
    wanted = names or tuple(df.columns)
    parts = [_safe(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in wanted]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


# A failed cast is an exception inside the JVM, costly over many rows; the pattern leaves
# only numbers to the cast.
_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def _whole_number(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("bigint"))


def tolerant_int(text: Column) -> Column:
    """Integer value of a setting's text, NULL where it is not one; 0 counts as unset."""
    return F.nullif(_whole_number(text), F.lit(0).cast("bigint"))


def is_bad_int(text: Column) -> Column:
    """True where a setting is given but is no integer (a warning, not an error)."""
    given = F.coalesce(text != "", F.lit(False))
    return given & _whole_number(text).isNull()
