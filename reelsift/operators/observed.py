"""Quality figures that are taken while rows are written, so that they cost no second scan."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F


def null_counts(columns: list[str]) -> dict[str, Column]:
    """The figures of :func:`~reelsift.operators.quality.count_na`."""
    return {f"{c}_na": F.count_if(F.col(c).isNull()) for c in columns}


def pattern_counts(columns: list[str], pattern: str) -> dict[str, Column]:
    """The figures of :func:`~reelsift.operators.quality.regexp_match_count`."""
    hits = [F.col(c).rlike(pattern) for c in columns]
    figures = {f"{c}_count": F.count_if(hit) for c, hit in zip(columns, hits, strict=True)}
    return figures | {"all_columns_match_count": F.count_if(reduce(and_, hits)), "any_column_match_count": F.count_if(reduce(or_, hits))}


def flag_counts(flags: dict[str, str]) -> dict[str, Column]:
    """Rows with a flag, and the share of them among all rows; the dict maps names of figures to flag columns."""
    counted = {name: F.count_if(F.col(flag) == 1) for name, flag in flags.items()}
    return counted | {f"share_of_{name}": F.count_if(F.col(flag) == 1) / F.nullif(F.count(F.lit(1)), F.lit(0)) for name, flag in flags.items()}


def write_observed(df: DataFrame, write: Callable[[DataFrame], object], figures: dict[str, Column]) -> dict[str, object]:
    """Write ``df`` with ``write`` and return the figures of the rows that were written.

    ``figures`` are aggregates by name. They are taken where the rows pass on their way to the sink. ``write`` has to run ``df`` once and to the end, as a
    sink does: where it reads ``df`` several times, the figures are those of the first time.
    """
    if not figures:
        write(df)
        return {}
    seen = Observation()
    write(df.observe(seen, *[column.alias(name) for name, column in figures.items()]))
    return {name: seen.get[name] for name in figures}


def as_row(df: DataFrame, figures: dict[str, object]) -> DataFrame:
    """The figures as a table of one row."""
    return df.sparkSession.createDataFrame([Row(**figures)])
