"""Row numbers, ids, batches and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.functions.text import as_list
from reelsift.session import durable

# A monotonically increasing id holds the partition above its lower 33 bits and the row within it below.
ROW_BITS = 33
#: Rows of a range, about, where the session's number of partitions would give more.
RANGE_ROWS = 2_000_000


def global_row_number(df: DataFrame, order_by: str | list[str], new_column: str) -> DataFrame:
    """Number all rows 1, 2, ... in a total order, without gathering them in one task.

    Rows are range-partitioned and sorted; each one's number is its place in its partition plus the
    sizes of the partitions before. The placed rows are made durable first, so both parts of that
    sum see the same placement even when an executor is lost. There are as many ranges as the session has shuffle
    partitions, and more where they would hold over ``RANGE_ROWS``. ``order_by`` should identify a row.
    """
    order = as_list(order_by)
    # Written before it is counted and its ranges are sampled, so its own plan runs once.
    df = durable(df)
    slots = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    placed = durable(
        df.repartitionByRange(slots, *order)
        .sortWithinPartitions(*order)
        .withColumn("__slot_row", F.monotonically_increasing_id())
    )
    slot = F.shiftright("__slot_row", ROW_BITS)
    sizes = placed.groupBy(slot.alias("__slot")).agg(F.count("*").alias("__size"))
    # One row per partition: the only rows that meet in a single task.
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__slot", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    place = F.col("__slot_row").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        placed.withColumn("__slot", slot)
        # As few rows as there are slots, so the numbered rows stay where they are.
        .join(F.broadcast(offsets), "__slot")
        .withColumn(new_column, F.col("__offset") + place + 1)
        .drop("__slot", "__slot_row", "__offset")
    )


def dense_ids(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """(value, id) with ids 1, 2, ... in the order of the distinct values."""
    return global_row_number(df.select(column).distinct(), column, id_column)


def hashed_id(column: Column) -> Column:
    """Id computed from the value alone, so every table gets the same one without a join."""
    return F.xxhash64(column)


def id_collisions(dimension: DataFrame, id_column: str) -> DataFrame:
    """Ids shared by several values of a dimension; empty when hashed ids are safe to use."""
    return dimension.groupBy(id_column).agg(F.count("*").alias("values")).where(F.col("values") > 1)


def top_k_per_group(
    df: DataFrame, group_by: str | list[str], order_by: list, k: int, rank_column: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group with their rank; map tasks cut each group to ``k`` rows before the shuffle."""
    window = Window.partitionBy(*as_list(group_by)).orderBy(*order_by)
    return df.withColumn(rank_column, F.row_number().over(window)).where(F.col(rank_column) <= k)


def top_n(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """First ``n`` rows overall."""
    return df.orderBy(*order_by).limit(n)


def sort_rows(df: DataFrame, order_by: list) -> DataFrame:
    return df.orderBy(*order_by)


def assign_batches(df: DataFrame, id_column: str, size: int, batch_column: str = "batch_id") -> DataFrame:
    """Number the ids in batches of ``size`` from 0, in id order."""
    numbered = global_row_number(df.select(id_column), id_column, "__row")
    return numbered.withColumn(batch_column, F.floor((F.col("__row") - 1) / size)).drop("__row")


def request_groups(df: DataFrame, id_column: str, size: int) -> DataFrame:
    """One row per batch with its ids (at most ``size`` of them)."""
    batches = assign_batches(df, id_column, size)
    return batches.groupBy("batch_id").agg(F.sort_array(F.collect_list(id_column)).alias("ids"))
