"""Value rules: replacements, lookups, flags, list-to-text and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions.text import as_column
from reelsift.lookups import MODE_NAMES, OTHER_TAG, PITCH_NAMES
from reelsift.sources.readers import inline_table

MAP_LITERAL_LIMIT = 100


def replace_value_in_column(df: DataFrame, column: str, old, new) -> DataFrame:
    """Put ``new`` where the value equals ``old``; ``None`` stands for null on both sides."""
    current = F.col(column)
    return df.withColumn(column, F.when(current.eqNullSafe(F.lit(old)), F.lit(new)).otherwise(current))


def map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def map_column_values(
    df: DataFrame, mapping: dict, column: str, new_column: str | None = None, default=None
) -> DataFrame:
    """Look the column up in ``mapping``; keys that are missing, or mapped to null, give ``default``.

    Large mappings become a lookup table, because a map literal is searched key by key. The types are those of the
    table in either form (whole numbers are ``bigint``), so one more entry never changes the result; the result's type is the
    one that holds the values and the default. A value that is none of the keys' type (text where they are numbers) is missing.
    """
    target = new_column or column
    if not mapping:
        return df.withColumn(target, F.lit(default))
    lookup = inline_table(df.sparkSession, list(mapping.items()), ["__key", "__value"])
    key_type, value_type = (lookup.schema[c].dataType for c in ("__key", "__value"))
    default_value = F.lit(default)
    if len(mapping) <= MAP_LITERAL_LIMIT:
        literal = map_literal(mapping).cast(T.MapType(key_type, value_type))
        return df.withColumn(target, F.coalesce(literal[F.col(column).try_cast(key_type)], default_value))
    order = df.columns if target in df.columns else [*df.columns, target]
    return (
        df.join(lookup, F.col(column).try_cast(key_type) == F.col("__key"), "left")
        .withColumn(target, F.coalesce("__value", default_value))
        .select(*order)
    )


def string_boolean(column: str | Column) -> Column:
    """1 for ``true``, 0 for ``false`` in any case, else null."""
    folded = F.lower(as_column(column))
    return F.when(folded == "true", 1).when(folded == "false", 0)


def convert_string_boolean_to_int(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, string_boolean(column))


def fill_string_nulls(df: DataFrame, value: str = OTHER_TAG) -> DataFrame:
    """Fill the nulls of every string column."""
    return df.na.fill(value, subset=[f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def percent_to_unit(column: str | Column) -> Column:
    """0-100 popularity as 0-1."""
    return as_column(column) / F.lit(100.0)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient as a double, null when the denominator is zero."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def pitch_name(column: str | Column) -> Column:
    return map_literal(PITCH_NAMES)[as_column(column).cast("int")]


def mode_name(column: str | Column) -> Column:
    return map_literal(MODE_NAMES)[as_column(column).cast("int")]


def list_to_comma_separated_string(items: str | Column) -> Column:
    """Array of strings as ``"a, b"``; an empty or null array gives null."""
    array = as_column(items)
    return F.when(F.size(array) > 0, F.array_join(array, ", "))


def field_values(items: str | Column, field: str) -> Column:
    """The given field of every struct in an array."""
    return F.transform(as_column(items), lambda item: item[field])


def names_text(items: str | Column, field: str = "name") -> Column:
    """Names of an array of structs as ``"a, b"``; entries without a name are left out."""
    present = F.filter(field_values(items, field), lambda name: name.isNotNull())
    return list_to_comma_separated_string(present)


def is_colour(colours: str | Column) -> Column:
    """``Yes`` when the first listed colour is ``Color``, ``No`` otherwise."""
    return F.when(F.get(as_column(colours), F.lit(0)) == "Color", "Yes").otherwise("No")


def is_present(column: str | Column) -> Column:
    return F.when(as_column(column).isNotNull(), "Yes").otherwise("No")
