"""The fact-table warehouse: Parquet tables under one root path.

``<root>/fact_orders`` and ``<root>/fact_order_products`` hold one folder for each
written batch. Which of them are live, in both tables at once, is said by the newest
snapshot (``snapshots``), and every reader reads a snapshot. Within a batch every
file is sorted by the table's sort key (``order_id``, then ``product_name``), which
gives Parquet row groups tight min/max ranges on ``order_id`` for pruning; ``compact``
merges small batches into ranges of order ids.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from cartwheel.operators.rejects import REJECTS
from cartwheel.schemas import FACT_ORDER_PRODUCTS, FACT_ORDERS, nullable
from cartwheel.sources import snapshots, storage
from cartwheel.sources.snapshots import Batch, Snapshot

BATCH_COLUMN = "batch_id"
FACT_ORDERS_TABLE = "fact_orders"
FACT_ORDER_PRODUCTS_TABLE = "fact_order_products"
TABLES = {
    FACT_ORDERS_TABLE: (FACT_ORDERS, ["order_id"]),
    FACT_ORDER_PRODUCTS_TABLE: (FACT_ORDER_PRODUCTS, ["order_id", "product_name"]),
}


LAYOUT_MARKER = "_cartwheel_layout"
_layouts: dict[str, int | None] = {}


class MissingTableError(RuntimeError):
    """A fact table the load needs does not exist yet."""


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def table_schema(name: str) -> T.StructType:
    schema = TABLES[name][0] if name in TABLES else T.StructType.fromDDL(_NOTES[name])
    return T.StructType(nullable(schema).fields + [T.StructField(BATCH_COLUMN, T.LongType(), True)])


def buckets_of(spark: SparkSession, root: str) -> int | None:
    """The bucket count the warehouse was created with (None: not bucketed)."""
    if root not in _layouts:
        marker = os.path.join(root, LAYOUT_MARKER)
        _layouts[root] = (spark.read.json(marker).first()["buckets"]
                          if storage.exists(spark, marker) else None)
    return _layouts[root]


def catalog_name(root: str, name: str) -> str:
    """Catalog name of a bucketed table: one database per warehouse root."""
    return f"cartwheel_{hashlib.sha1(root.encode()).hexdigest()[:12]}.{name}"


def _register(spark: SparkSession, root: str, name: str, buckets: int, live: list[Batch]) -> str:
    """The catalog table of a bucketed fact, with the live batches as its partitions.

    The catalog entry is session metadata; layout and snapshot lie in the
    files, so every session registers the same folders for itself.
    """
    qualified = catalog_name(root, name)
    if not spark.catalog.tableExists(qualified):
        schema, sort_key = TABLES[name]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified.split('.')[0]}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {qualified} ({cols}, `{BATCH_COLUMN}` bigint) "
            f"USING parquet PARTITIONED BY ({BATCH_COLUMN}) "
            f"CLUSTERED BY (order_id) SORTED BY ({', '.join(sort_key)}) INTO {buckets} BUCKETS "
            f"LOCATION '{table_path(root, name)}'")
    known = {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {qualified}").collect()}
    for batch in known - {b.batch for b in live}:
        spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS PARTITION ({BATCH_COLUMN} = {batch})")
    for b in live:
        where = f"PARTITION ({BATCH_COLUMN} = {b.batch})"
        location = f"LOCATION '{table_path(root, name)}/{b.path}'"
        if b.batch in known:
            spark.sql(f"ALTER TABLE {qualified} {where} SET {location}")
        else:
            spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {where} {location}")
    return qualified


def create_tables(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for both facts: an empty, typed table.

    With ``buckets`` the tables are bucketed by ``order_id``: joins and
    groupings by order between the two facts then need no shuffle at all.
    The layout is fixed at creation; an existing warehouse keeps its own.
    """
    marker = os.path.join(root, LAYOUT_MARKER)
    if buckets and not storage.exists(spark, marker) and not storage.exists(
            spark, table_path(root, FACT_ORDERS_TABLE)):
        spark.createDataFrame([(int(buckets),)], "buckets int").coalesce(1).write.json(marker)
    _layouts.pop(root, None)
    for name in TABLES:
        storage.make_folder(spark, table_path(root, name))


class TableSchemaError(RuntimeError):
    """A fact table's stored files do not match the table contract."""


def _stored_schema(spark: SparkSession, root: str, name: str) -> T.StructType | None:
    """The schema in one footer of the live files; None for a table without files."""
    live = snapshots.current(spark, root).of(name)
    if not live:
        return None
    return spark.read.parquet(f"{table_path(root, name)}/{live[0].path}").schema


def require_tables(spark: SparkSession, root: str) -> None:
    """Fail before loading anything when a fact table is missing, or when its
    stored files disagree with the contract (names or types)."""
    for name in TABLES:
        path = table_path(root, name)
        if not storage.exists(spark, path):
            raise MissingTableError(f"table {name} does not exist under {root}; create it first")
        stored = _stored_schema(spark, root, name)
        if stored is None:
            continue
        # The partition column's type is inferred from folder names; skip it.
        want = {f.name: f.dataType for f in table_schema(name).fields if f.name != BATCH_COLUMN}
        have = {f.name: f.dataType for f in stored.fields}
        wrong = sorted(c for c in want if c in have and have[c] != want[c])
        missing = sorted(c for c in want if c not in have)
        if wrong or missing:
            raise TableSchemaError(
                f"table {name} under {root} does not match its schema: "
                f"missing {missing}, wrong type {wrong}")


def read_table(spark: SparkSession, root: str, name: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The rows of a table in a snapshot (the newest, unless one is given). To read
    both facts as of one moment, pass the same snapshot to both reads."""
    live = (snapshot or snapshots.current(spark, root)).of(name)
    n = buckets_of(spark, root) if name in TABLES else None
    if n:
        qualified = _register(spark, root, name, n, live)
        spark.catalog.refreshTable(qualified)
        return spark.table(qualified)
    if not live:
        return spark.createDataFrame([], table_schema(name))
    path = table_path(root, name)
    return spark.read.schema(table_schema(name)).option("basePath", path).parquet(*[f"{path}/{b.path}" for b in live])


def live_rows(spark: SparkSession, root: str, name: str, snapshot: Snapshot) -> int:
    """The rows of a table in a snapshot, which notes them; batches from before snapshots are counted."""
    noted = snapshot.rows(name)
    return read_table(spark, root, name, snapshot).count() if noted is None else noted


def describe(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Column names and types of the stored table, one row per column; a table
    without files yet has its contract's. A missing table is an error."""
    path = table_path(root, name)
    if not storage.exists(spark, path):
        raise MissingTableError(f"table {name} does not exist under {root}; create it first")
    stored = _stored_schema(spark, root, name) or table_schema(name)
    fields = [f for f in stored.fields if f.name != BATCH_COLUMN] + [f for f in table_schema(name).fields if f.name == BATCH_COLUMN]
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields],
                                 "col_name string, data_type string")


def preview(spark: SparkSession, root: str, name: str, n: int = 10,
            ordered: bool = False) -> DataFrame:
    """``SELECT * … LIMIT n``: a bare limit, which stops reading after the
    first rows (no full scan). ``ordered=True`` returns the first ``n`` rows
    by the sort key instead — a top-k, which reads the whole table."""
    df = read_table(spark, root, name)
    if ordered:
        _, sort_key = TABLES[name]
        df = df.orderBy(*sort_key)
    return df.limit(n)


def stage_batch(df: DataFrame, root: str, name: str, batch_id: int) -> Batch:
    """Write one batch of a table into a folder of its own, which no reader sees before
    it is published. ``df`` arrives clustered by its de-duplication key (order_id within
    a source file); a batch without rows leaves no folder. Sorting within partitions by the table's sort key gives every
    output file one sorted run with tight row-group ranges, without another shuffle.
    """
    spark = df.sparkSession
    schema, sort_key = TABLES.get(name, (None, []))
    place = f"{BATCH_COLUMN}={int(batch_id)}/{uuid.uuid4().hex}"
    path = f"{table_path(root, name)}/{place}"
    written = Observation()
    columns = schema.fieldNames() if schema else df.columns
    out = df.select(*columns).observe(written, F.count(F.lit(1)).alias("n"))
    n = buckets_of(spark, root) if schema else None
    if n:
        # One task per bucket: the batch gets exactly one sorted file per bucket.
        # A table over the batch's folder alone gives the files their bucket numbers.
        database = catalog_name(root, name).split(".")[0]
        alone = f"{database}.batch_{uuid.uuid4().hex}"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        storage.make_folder(spark, path)
        spark.sql(f"CREATE TABLE {alone} ({cols}) USING parquet CLUSTERED BY (order_id) "
                  f"SORTED BY ({', '.join(sort_key)}) INTO {n} BUCKETS LOCATION '{path}'")
        try:
            out.repartition(n, "order_id").sortWithinPartitions(*sort_key).write.insertInto(alone)
        finally:
            spark.sql(f"DROP TABLE {alone}")
    else:
        (out.sortWithinPartitions(*sort_key) if sort_key else out).write.parquet(path)
    files = [size for file, size in storage.names(spark, path) if file.endswith(".parquet")]
    rows = written.get.get("n")
    if rows is None:                     # no metric at all says nothing about the rows
        rows = spark.read.parquet(path).count() if files else 0
    if not rows:                         # no snapshot will name it
        storage.delete(spark, path)
    return Batch(name, int(batch_id), place, int(rows), sum(files), len(files))


def write_batch(df: DataFrame, root: str, name: str, batch_id: int) -> None:
    """(Re)write one batch of one table and publish it: a batch written before under
    this id is replaced in one step, also by one without rows."""
    spark = df.sparkSession
    base = snapshots.current(spark, root)
    snapshots.publish(spark, root, base, [stage_batch(df, root, name, batch_id)])


LOADED_TABLE = "_loaded_files"
REJECTS_TABLE = "_rejected_values"
# Tables beside the facts, live by the same snapshots.
_NOTES = {
    LOADED_TABLE: "landing_file string, modified bigint, bytes bigint",
    REJECTS_TABLE: f"{REJECTS}, loaded_at timestamp",
}


def loaded_files(spark: SparkSession, root: str, snapshot: Snapshot | None = None) -> DataFrame:
    """Landing files that the live batches were loaded from, by path, modification time and length."""
    return read_table(spark, root, LOADED_TABLE, snapshot)


def rejected(spark: SparkSession, root: str, snapshot: Snapshot | None = None) -> DataFrame:
    """The values that the live batches did not load as written, with place, reason and batch."""
    return read_table(spark, root, REJECTS_TABLE, snapshot)


def compact(spark: SparkSession, root: str, target_bytes: int = 256 << 20, fewest: int = 8) -> dict[str, int]:
    """Merge small batches of both facts, of the rejects and of the note of loaded files; returns the
    number of batches merged in each table.

    A table's batches of less than ``target_bytes`` are merged once there are
    ``fewest`` of them (what has reached the target is never rewritten, so a row is
    rewritten about ``log(rows)`` times). The merged batch is dealt by ranges of
    the order id into files of about the target size, sorted by the table's key, so
    a lookup by order id reads few of them. It has the greatest id of the
    merged ones. All tables change in one snapshot; readers of the last one go on.
    """
    base = snapshots.current(spark, root)
    new, gone, merged = [], set(), {}
    for name in (*TABLES, *_NOTES):
        small = [b for b in base.of(name) if b.bytes < target_bytes]
        if len(small) < max(fewest, 2):
            continue
        df = read_table(spark, root, name, Snapshot(base.version, tuple(small))).drop(BATCH_COLUMN)
        files = max(1, -(-sum(b.bytes for b in small) // target_bytes))
        if name in TABLES:
            df = df.repartitionByRange(files, *TABLES[name][1][:1])
        else:
            df = df.coalesce(files)
        whole = stage_batch(df, root, name, max(b.batch for b in small))
        if all(b.low is not None for b in small):
            whole = replace(whole, low=min(b.low for b in small), high=max(b.high for b in small))
        new.append(whole)
        gone |= {(name, b.batch) for b in small}
        merged[name] = len(small)
    if new:
        snapshots.publish(spark, root, base, new, gone, base.totals)
    return merged


def clean(spark: SparkSession, root: str) -> int:
    """Delete the folders of batches that no kept snapshot names (of loads that crashed, and
    of merged batches). Not while a load runs."""
    return snapshots.clean(spark, root, [*TABLES, *_NOTES], BATCH_COLUMN)


def register_views(spark: SparkSession, root: str) -> None:
    """Expose both fact tables as temporary views for ad-hoc ``spark.sql``."""
    snapshot = snapshots.current(spark, root)
    for name in TABLES:
        read_table(spark, root, name, snapshot).createOrReplaceTempView(name)
