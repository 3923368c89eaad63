"""Column renames, additions, casts and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions.text import as_list
from reelsift.lookups import PLATFORMS


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)


def add_prefix_to_column_names(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{name}`").alias(prefix + name) for name in df.columns])


def ensure_column_existence(df: DataFrame, name: str, kind: str | T.DataType, default=None) -> DataFrame:
    """Add a constant column of the given type unless the name is taken."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(kind))


def merge_schema_into_dataframe(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed nulls."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def add_null_columns(df: DataFrame, names: list[str], kind: str = "string") -> DataFrame:
    missing = {name: F.lit(None).cast(kind) for name in names if name not in df.columns}
    return df.withColumns(missing) if missing else df


def coalesce_prefixed_columns(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    """Take ``prefix + column`` where it is not null, else ``column``; the prefixed columns go."""
    merged = {c: F.coalesce(F.col(prefix + c), F.col(c)) for c in columns}
    return df.withColumns(merged).drop(*[prefix + c for c in columns])


def ensure_list_column(
    df: DataFrame, column: str, separator: str = ", ", null_value: str | None = None
) -> DataFrame:
    """Split a text column by a separator regex; ``null_value`` gives null, arrays stay as they are."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df
    text = F.nullif(F.col(column), F.lit(null_value)) if null_value else F.col(column)
    return df.withColumn(column, F.split(text, separator))


def convert_bool_columns_to_int(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({name: F.col(name).cast("int") for name in flags}) if flags else df


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast by name; text that does not fit the type becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def add_platform_column(df: DataFrame, prefix: str, column: str = "platform") -> DataFrame:
    """Add the platform name for an id prefix."""
    if prefix not in PLATFORMS:
        raise ValueError(f"unknown platform prefix {prefix!r}; known: {sorted(PLATFORMS)}")
    return df.withColumn(column, F.lit(PLATFORMS[prefix]))


def project(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Keep the named columns, in that order."""
    return df.select(*as_list(columns))
