"""Sinks, upserts and table definitions."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.functions.dates import run_date as run_date_column
from reelsift.operators.dedup import display_duplicates, drop_duplicates_by_ordered_partition, total_order
from reelsift.session import durable, table_root

UPDATE_DATE = "last_updated_date"
KEY_BUCKET = "key_bucket"
#: Rows that a bucket of a co-bucketed table may have on average where its maker asks for a bound: a join sorts them in one task.
BUCKET_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def save_to_db(df: DataFrame, database: str, table: str, overwrite_schema: bool = False, fmt: str = "parquet") -> None:
    """Append to a table, or replace it with its schema."""
    mode = "overwrite" if overwrite_schema else "append"
    name = f"{database}.{table}"
    if mode == "append" and df.sparkSession.catalog.tableExists(name):
        df = align_to_table(df, name)
    df.write.format(fmt).mode(mode).option("mergeSchema", "true").saveAsTable(name)


def save_tables(tables: dict[str, DataFrame], database: str, fmt: str = "parquet") -> None:
    """Replace several tables of a database, such as the ones of a dimensional model."""
    for name, df in tables.items():
        save_to_db(df, database, name, overwrite_schema=True, fmt=fmt)


def align_to_table(df: DataFrame, name: str) -> DataFrame:
    """Columns in the order of the table; a new column is added to the table, a missing one is null."""
    spark = df.sparkSession
    target = spark.table(name)
    added = [f for f in df.schema.fields if f.name not in target.columns]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        target = spark.table(name)
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def save_to_db2(df: DataFrame, database: str, table: str, partition_by: list[str] | None = None) -> None:
    """Replace the partitions that ``df`` has rows for, or create the parquet table.

    Columns are matched by name. A table without partitions is replaced as a whole.
    """
    spark = df.sparkSession
    name = f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        writer = _gathered(df, partition_by).write.mode("overwrite").format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        _gathered(df.select(*spark.table(name).columns), partitions).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def publish(df: DataFrame, table: str, base_path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new folder and point the table at it; return the table.

    The folder in use is never overwritten, so ``df`` may read the table it replaces, and a failed
    write leaves the table as it was. A table that exists keeps its partitions and properties, unless
    ``partition_by`` names other partitions. Without ``base_path`` the folder is in the database's. Where the layout changes, the new table is made under another
    name and takes the old one's place when it is complete. One writer at a time; old folders are for the
    caller to expire.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and partition_by is None:
        partition_by = [c for c in _partitions(spark, table) if c in df.columns]
    if exists and (layout := cobuckets(spark, table)):
        return _publish_cobucketed(df, table, layout.keys, layout.buckets, base_path, partition_by)
    folder = _write_folder(df, table, base_path, partition_by)
    if exists and _same_layout(spark, table, df, partition_by):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        _refresh(spark, table, partition_by)
        return spark.table(table)
    # Of the rows and not of the files: without rows a partitioned folder has none.
    fields = sorted(df.schema.fields, key=lambda f: f.name in (partition_by or []))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    properties = _properties(spark, table) if exists else {}
    kept = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    made = f"{table}__{uuid.uuid4().hex[:12]}" if exists else table
    spark.sql(f"CREATE TABLE {made} ({columns}) USING parquet{layout} LOCATION '{folder}'" + (f" TBLPROPERTIES ({kept})" if kept else ""))
    if exists:
        _take_place(spark, made, table)
    _refresh(spark, table, partition_by)
    return spark.table(table)


def _take_place(spark: SparkSession, made: str, table: str) -> None:
    old = f"{table}__{uuid.uuid4().hex[:12]}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


@dataclass(frozen=True)
class Cobuckets:
    buckets: int
    keys: list[str]


def cobuckets(spark: SparkSession, table: str) -> Cobuckets | None:
    """The buckets a table's rows are laid out in for joins, if it is a :func:`publish_cobucketed` one."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if int(told.get("Num Buckets", 0) or 0) < 1:
        return None
    return Cobuckets(int(told["Num Buckets"]), [c.strip(" `[]") for c in told["Bucket Columns"].split(",")])


def publish_cobucketed(
    df: DataFrame, table: str, keys: str | list[str], buckets: int | str, base_path: str | None = None, partition_by: list[str] | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Publish a table in ``buckets`` by ``keys``, each sorted by them, so tables with the same buckets join without a shuffle.

    ``buckets`` is their number, or the name of a table to join with, which has its buckets already. With ``rows_per_bucket`` the rows
    are counted and the number is doubled until a bucket has no more of them on average, so that what a task sorts does not grow with the table.

    Merges and :func:`publish` keep the layout; :func:`add_slice` adds partitions to it. A join reads a bucket in one task, which
    nothing splits: where :func:`largest_bucket` says that one key has a large share of the rows, leave the table
    unbucketed, and adaptive execution splits that key.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if isinstance(buckets, str):
        layout = cobuckets(df.sparkSession, buckets)
        if layout is None:
            raise ValueError(f"{buckets} has no buckets")
        buckets = layout.buckets
    elif rows_per_bucket:
        rows = df.count()
        while rows > buckets * rows_per_bucket:
            buckets *= 2
    return _publish_cobucketed(df, table, keys, buckets, base_path, partition_by)


def _publish_cobucketed(df: DataFrame, table: str, keys: list[str], buckets: int, base_path: str | None, partition_by: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    made = f"{table}__{uuid.uuid4().hex[:12]}" if exists else table
    folder = _new_folder(spark, table, base_path)
    # One task per bucket, so that a bucket is one file (in each partition).
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", folder)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(made)
    if exists:
        for name, value in _properties(spark, table).items():
            spark.sql(f"ALTER TABLE {made} SET TBLPROPERTIES ('{name}' = '{value}')")
        _take_place(spark, made, table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def add_slice(df: DataFrame, table: str) -> DataFrame:
    """Replace the partitions of a partitioned, co-bucketed table that ``df`` has rows for; the others are not touched."""
    spark = df.sparkSession
    layout = cobuckets(spark, table)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(table).columns).repartition(layout.buckets, *layout.keys).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def largest_bucket(table: DataFrame, layout: Cobuckets) -> float:
    """The share of the rows that the fullest bucket has; ``1 / buckets`` is even."""
    sizes = table.groupBy(F.pmod(F.hash(*layout.keys), F.lit(layout.buckets)).alias("bucket")).agg(F.count("*").alias("rows"))
    return sizes.agg((F.max("rows") / F.sum("rows")).alias("share")).first().share or 0.0


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What users have set on a table; the catalogue's own entries are left out."""
    own = ("spark.sql.", "transient_", "numFiles", "totalSize", "option.", "EXTERNAL", "view.")
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if not r.key.startswith(own)}


def _new_folder(spark: SparkSession, table: str, base_path: str | None) -> str:
    root = f"{base_path}/{table.split('.')[-1]}" if base_path else table_root(spark, table)
    return f"{root}/{uuid.uuid4().hex}"


def _write_folder(df: DataFrame, table: str, base_path: str | None, partition_by: list[str] | None) -> str:
    folder = _new_folder(df.sparkSession, table, base_path)
    writer = _gathered(df, partition_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return folder


def _gathered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Bring the rows of a partition together, in as many tasks as its size asks for, so that files are few and even."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _same_layout(spark: SparkSession, table: str, df: DataFrame, partition_by: list[str] | None) -> bool:
    types = {c.name: c.dataType for c in spark.catalog.listColumns(table)}
    return _partitions(spark, table) == (partition_by or []) and types == {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _refresh(spark: SparkSession, table: str, partition_by: list[str] | None) -> None:
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def publish_bucketed(df: DataFrame, table: str, key: str, buckets: int, base_path: str | None = None) -> DataFrame:
    """Publish a table in partitions by a hash of its key, so that later merges rewrite only those they touch."""
    spark = df.sparkSession
    publish(df.withColumn(KEY_BUCKET, key_bucket(key, buckets)), table, base_path, [KEY_BUCKET])
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEY_BUCKET}s' = '{buckets}')")
    return spark.table(table)


def _merge_buckets(
    target: DataFrame, updates: DataFrame, table: str, key: str, run_date, base_path: str | None, **rules
) -> DataFrame:
    """Upsert into the buckets that have updates; each is written anew and switched, the others stay untouched."""
    # Which buckets are touched and what goes into them must come from the same rows.
    updates = durable(_one_per_key(updates, key, **rules))
    return _switch_buckets(
        table, key, updates.select(key), lambda before: _replaced(before, updates, key, run_date), base_path, target.sparkSession
    )


def _switch_buckets(
    table: str, key: str, touching: DataFrame, change: Callable[[DataFrame], DataFrame], base_path: str | None, spark: SparkSession
) -> DataFrame:
    """Change the buckets of the keys in ``touching``, written to a new folder and switched one by one.

    After a failure among the switches some buckets are new and the others as before; the same change again mends that.
    """
    target = spark.table(table)
    buckets = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{KEY_BUCKET}s')").first().value)
    bucket = key_bucket(key, buckets)
    # At most one row per bucket.
    touched = [r[0] for r in touching.select(bucket.alias(KEY_BUCKET)).distinct().collect()]
    if not touched:
        return target
    before = target.where(F.col(KEY_BUCKET).isin(touched)).drop(KEY_BUCKET)
    folder = _write_folder(change(before).withColumn(KEY_BUCKET, bucket), table, base_path, [KEY_BUCKET])
    for number in touched:
        partition, place = f"PARTITION ({KEY_BUCKET} = {number})", f"{folder}/{KEY_BUCKET}={number}"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def merge_best(rows: DataFrame, table: str, key: str, order_by: list, base_path: str | None = None, buckets: int = 16) -> DataFrame:
    """Keep the first row of each key in ``order_by``, out of the table's and the new ones, in the buckets of the new ones' keys.

    The table is made from the first rows. The same rows again change nothing. A null key is a key like others.
    """
    spark = rows.sparkSession
    best = durable(drop_duplicates_by_ordered_partition(rows, key, order_by))
    if not spark.catalog.tableExists(table):
        return publish_bucketed(best, table, key, buckets, base_path)
    columns = [c for c in spark.table(table).columns if c != KEY_BUCKET]
    better = lambda before: drop_duplicates_by_ordered_partition(before.select(*columns).unionByName(best.select(*columns)), key, order_by)
    return _switch_buckets(table, key, best.select(key), better, base_path, spark)


def save_checkpoint(df: DataFrame, table: str, base_path: str | None = None) -> DataFrame:
    """Replace a checkpoint table, with a new schema if need be, and continue from what was written."""
    return publish(df, table, base_path)


SIGNATURE = "built_from"


def signature(inputs: list[DataFrame], arguments: dict | None = None) -> str:
    """What a result is built from: the files of its inputs (path, size, time of change), their columns, and ``arguments``.

    The files are summed up in a few numbers where they are listed; inputs that are not read from files count by their columns
    alone, so name their version in ``arguments``.
    """
    told = []
    for df in inputs:
        files = []
        if df.inputFiles():
            meta = df.select(*[F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size", "file_modification_time")]).distinct()
            row = F.xxhash64("file_path", "file_size", F.unix_micros("file_modification_time"))
            files = list(meta.agg(F.count("*"), F.bit_xor(row), F.sum(F.pmod(row, F.lit(1 << 40)))).first())
        told.append([df.schema.simpleString(), files])
    return hashlib.sha256(json.dumps([told, arguments or {}], sort_keys=True, default=str).encode()).hexdigest()


def checkpoint_or_build(
    spark: SparkSession, table: str, build: Callable[[], DataFrame], inputs: list[DataFrame], arguments: dict | None = None, base_path: str | None = None
) -> DataFrame:
    """The saved table if it was built from the same inputs and arguments, else what ``build`` gives, saved with its signature.

    Rows that come while the table is being built belong to the next signature, which is taken before.
    """
    now = signature(inputs, arguments)
    if spark.catalog.tableExists(table) and _properties(spark, table).get(SIGNATURE) == now:
        return spark.table(table)
    built = save_checkpoint(build(), table, base_path)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SIGNATURE}' = '{now}')")
    return built


def publish_clustered(
    df: DataFrame, table: str, range_by: str | list[str], key: str | None = None, base_path: str | None = None, rows_per_page: int = 20_000,
    group_bytes: int = 64 << 20, distinct_keys: int = 1_000_000,
) -> DataFrame:
    """Publish a table whose files hold ranges of ``range_by``, so that reads of a date or key skip what they do not want.

    Rows are range-partitioned and sorted, so each file, row group and page has a narrow span of the first columns, which their
    statistics and page index tell. ``key`` gets a Bloom filter in every row group, for lookups of single keys. A range with very many
    equal rows is one file, since equal values are not parted: add a column to ``range_by`` that tells them apart.
    """
    columns = [range_by] if isinstance(range_by, str) else range_by
    options = {"parquet.page.row.count.limit": str(rows_per_page), "parquet.block.size": str(group_bytes)}
    if key:
        options |= {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(distinct_keys)}
    spark = df.sparkSession
    folder = _new_folder(spark, table, base_path)
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.options(**options).parquet(folder)
    if spark.catalog.tableExists(table) and _same_layout(spark, table, df, []):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return spark.table(table)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    made = f"{table}__{uuid.uuid4().hex[:12]}" if spark.catalog.tableExists(table) else table
    spark.sql(f"CREATE TABLE {made} ({fields}) USING parquet LOCATION '{folder}'")
    if made != table:
        _take_place(spark, made, table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str = "show_id",
    run_date: str | date | None = None,
    on_duplicate: str = "first",
    order_by: list | None = None,
    null_keys: str = "append",
) -> DataFrame:
    """Target rows with their updates applied and new keys added.

    Updated and added rows get the run date as ``last_updated_date`` when the target has that column.
    Of several updates for a key the first in ``order_by`` (all columns by default) is taken, or with
    ``on_duplicate="raise"`` an error raised. Updates without a key match nothing and are added, each of them and
    every time, as MERGE does; with ``null_keys="raise"`` they are an error.
    """
    # Written once: the same rows replace and are added, whatever the updates would give a second time.
    return _replaced(target, durable(_one_per_key(updates, key, on_duplicate, order_by, null_keys)), key, run_date)


def _one_per_key(updates: DataFrame, key: str, on_duplicate: str = "first", order_by: list | None = None, null_keys: str = "append") -> DataFrame:
    """The update of each key, and the updates without a key."""
    named, unnamed = updates.where(F.col(key).isNotNull()), updates.where(F.col(key).isNull())
    if null_keys == "raise" and not unnamed.isEmpty():
        raise ValueError(f"updates without {key}")
    if on_duplicate == "raise":
        if not display_duplicates(named, key).isEmpty():
            raise ValueError(f"several updates for one {key}")
    else:
        named = drop_duplicates_by_ordered_partition(named, key, order_by or total_order(updates))
    return named.unionByName(unnamed)


def _replaced(target: DataFrame, updates: DataFrame, key: str, run_date: str | date | None) -> DataFrame:
    """``target`` with its rows replaced by ``updates`` (one per key, written), stamped with the run date."""
    stamped = updates
    if UPDATE_DATE in target.columns:
        stamped = updates.withColumn(UPDATE_DATE, run_date_column(run_date).cast(target.schema[UPDATE_DATE].dataType))
    return target.join(updates.select(key), key, "left_anti").select(*target.columns).unionByName(
        stamped.select(*target.columns)
    )


def merge_statement(table: str, view: str, columns: list[str], key: str = "show_id") -> str:
    """MERGE for table formats that support it."""
    def source(column: str) -> str:
        return "current_date()" if column == UPDATE_DATE else f"updates.`{column}`"

    assignments = ", ".join(f"target.`{c}` = {source(c)}" for c in columns if c != key)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(source(c) for c in columns)
    return (
        f"MERGE INTO {table} AS target USING {view} AS updates ON target.`{key}` = updates.`{key}` "
        f"WHEN MATCHED THEN UPDATE SET {assignments} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def merge_tables(
    spark: SparkSession,
    database: str,
    table: str,
    new_data_view: str,
    key: str = "show_id",
    run_date: str | date | None = None,
    base_path: str | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Upsert a view into a table by key: MERGE where the table format has it, else rewrite and switch.

    A table from :func:`publish_bucketed` has only the buckets with updates rewritten. Others keep their partitions, if
    ``partition_by`` names no others.
    """
    return merge_updates(f"{database}.{table}", spark.table(new_data_view), key, run_date, base_path, partition_by, view=new_data_view)


def merge_updates(
    name: str,
    updates: DataFrame,
    key: str = "show_id",
    run_date: str | date | None = None,
    base_path: str | None = None,
    partition_by: list[str] | None = None,
    view: str | None = None,
    **rules,
) -> DataFrame:
    """:func:`merge_tables` of a DataFrame; ``rules`` are :func:`upsert`'s about duplicates and null keys."""
    spark = updates.sparkSession
    target = spark.table(name)
    provider = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Provider"]
    if provider and provider[0].lower() in {"delta", "iceberg"}:
        if view is None:
            view = f"updates_{uuid.uuid4().hex}"
            updates.createOrReplaceTempView(view)
        spark.sql(merge_statement(name, view, target.columns, key))
        return spark.table(name)
    if KEY_BUCKET in target.columns:
        return _merge_buckets(target, updates, name, key, run_date, base_path, **rules)
    return publish(upsert(target, updates, key, run_date, **rules), name, base_path, partition_by)


def replace_by_key(target: DataFrame, new: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """Rows of ``target`` whose key is not among the replaced ones, and the rows of ``new``.

    ``keys`` has the keys that the slice speaks of (those of ``new`` by default): a key without new rows loses all it
    had. Several rows of a key are replaced together, and a null key is a key like others, so the same slice
    again changes nothing.
    """
    new = durable(new)
    gone = (new if keys is None else keys.select(key).unionByName(new.select(key))).select(F.col(key).alias("__gone")).distinct()
    kept = target.join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*target.columns))


def _replace_in_buckets(table: str, new: DataFrame, key: str, keys: DataFrame, base_path: str | None) -> DataFrame:
    """:func:`replace_by_key` in a table from :func:`publish_bucketed`, in the buckets of ``keys`` and ``new`` alone."""
    spark = new.sparkSession
    new, keys = durable(new), durable(keys.select(key).distinct())
    return _switch_buckets(
        table, key, keys.unionByName(new.select(key)), lambda before: replace_by_key(before, new, key, keys), base_path, spark
    )


def merge_model(
    spark: SparkSession,
    database: str,
    entities: dict[str, tuple[DataFrame, str]],
    bridges: dict[str, tuple[DataFrame, str] | tuple[DataFrame, str, DataFrame]] | None = None,
    run_date: str | date | None = None,
    base_path: str | None = None,
    buckets: int = 16,
) -> None:
    """Bring a day's slice of a dimensional model into its tables.

    ``entities`` are dimensions and facts with their key: rows are upserted, the ones of other days stay. ``bridges`` have
    the key whose rows they replace together, such as the show's, and the slice's entities as third part: a show
    that comes without any genre loses those it had. Without the third part, the keys are those of the first entity
    that has the bridge's key as its own, or else the bridge's. Ids must come from the values themselves (hashed ids) or from a
    :class:`~reelsift.sources.keytable.KeyTable`, or the slices would disagree about them.

    A table that doesn't exist yet is made in ``buckets`` by its key, and later slices rewrite only the buckets they touch.
    """
    for name, (df, key) in entities.items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            merge_updates(table, df, key, run_date, base_path)
        else:
            publish_bucketed(drop_duplicates_by_ordered_partition(df, key, total_order(df)), table, key, buckets, base_path)
    owners = {key: df for df, key in reversed(entities.values())}
    for name, (df, key, *given) in (bridges or {}).items():
        table = f"{database}.{name}"
        keys = (given[0] if given else owners.get(key, df)).select(key)
        if not spark.catalog.tableExists(table):
            publish_bucketed(df, table, key, buckets, base_path)
        elif KEY_BUCKET in spark.table(table).columns:
            _replace_in_buckets(table, df, key, keys, base_path)
        else:
            publish(replace_by_key(spark.table(table), df, key, keys), table, base_path)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")


def create_table(spark: SparkSession, database: str, table: str, columns: str, partition_by: list[str] | None = None):
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet{layout}")


def rename_table(spark: SparkSession, database: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {database}.{old} RENAME TO {database}.{new}")


def expose_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
