"""Load every not-yet-processed landing file into the two fact tables.

What has been loaded is part of the warehouse's snapshot, beside the facts themselves:

1. *pending*: the landing folder's listing without the files that the snapshot notes;
2. *admission*: a landing (``sources.landing``) is loaded as a whole, once all the files that its
   ledger entry names are there; any other file is a payload of its own. Micro-batches are
   made of whole payloads, so their size never changes a result;
3. *schema groups*: the footers of a batch's files are read in parallel and grouped by the types of
   the contract's columns. A file without a required column is an error that names it. Every group
   is scanned with its own schema and coerced; the groups meet as typed rows;
4. *rejects*: every value that is not loaded as written becomes a row of the reject table, with its place and reason
   (``operators.rejects``); the load's counts are taken from these rows;
5. *commit*: both facts, the rejects and the note of the files are staged and published in one snapshot.

A crash at any point before the publication leaves nothing visible, and the next run does
the batch again; after it, nothing of the batch is pending any more. Processed files can
then be moved to an archive folder. ``start_ingest_stream`` runs the same steps
whenever the landing folder's file stream sees new files.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from cartwheel.operators.facts import (
    MissingColumnsError,
    coerce_orders,
    empty_fact_order_products,
    first_orders,
    first_products,
    flatten_products,
    loaded_at_literal,
)
from cartwheel.operators.rejects import failed_order_values, rejected_values, unparsed_cells
from cartwheel.schemas import ORDER_COLUMNS, PRODUCTS_COLUMN, ROW_BLOCK, ROW_INDEX, SOURCE_FILE
from cartwheel.session import checkpoint_dir
from cartwheel.sources import gate, landing, snapshots, storage, warehouse

# The text contract of landed files, for streams over an empty folder.
LANDING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in (*ORDER_COLUMNS, PRODUCTS_COLUMN)]
    + [T.StructField(SOURCE_FILE, T.StringType(), True),
       T.StructField(ROW_BLOCK, T.LongType(), True),
       T.StructField(ROW_INDEX, T.LongType(), True)]
)
READ_COLUMNS = LANDING_SCHEMA.fieldNames()


@dataclass
class IngestStats:
    files_processed: int = 0
    orders_loaded: int = 0
    products_loaded: int = 0
    unparsed_product_cells: int = 0
    coercion_failures: int = 0
    rejected_values: int = 0
    total_orders_in_db: int | None = None
    total_products_in_db: int | None = None

    def as_dict(self) -> dict:
        d = dict(self.__dict__)
        if not self.rejected_values:
            d.pop("rejected_values")
        if self.files_processed == 0:
            d.pop("total_orders_in_db")
            d.pop("total_products_in_db")
        return d


def with_provenance(df: DataFrame) -> DataFrame:
    """Fill source_file / row_block / row_index from the file metadata when the
    landing writer did not record them (plain raw Parquet dropped in the folder).

    The source file is the de-duplication scope, so it says which landing, or
    which other file, a row came with: a payload that is delivered again is a scope of its own."""
    def have(c):
        return F.col(c) if c in df.columns else F.lit(None)
    payload = [c for c in (*ORDER_COLUMNS, PRODUCTS_COLUMN) if c in df.columns]
    number = F.regexp_extract(F.col("_metadata.file_name"), landing.LANDED_NAME, 1)
    unit = F.when(number != "", number).otherwise(F.col("_metadata.file_path"))
    return df.select(
        *payload,
        F.concat_ws("#", have(SOURCE_FILE).cast("string"), unit).alias(SOURCE_FILE),
        F.coalesce(have(ROW_BLOCK), F.lit(0)).cast("bigint").alias(ROW_BLOCK),
        F.coalesce(have(ROW_INDEX), F.col("_metadata.row_index")).cast("bigint").alias(ROW_INDEX),
    )


# -- the files to load -------------------------------------------------------------

def pending_units(spark: SparkSession, landing_dir: str, warehouse_root: str,
                  snapshot: snapshots.Snapshot | None = None) -> list[list[Row]]:
    """The files to load, ``path, modified, bytes`` each, as lists that belong together:
    whole landings by number, then other files by name. Only names meet on the driver.
    Landings of which files are missing wait."""
    found = storage.listing(spark, landing_dir, "*.parquet")
    known = warehouse.loaded_files(spark, warehouse_root, snapshot).select(
        F.col("landing_file").alias("path"), "modified", "bytes")
    files = sorted(found.join(known, found.columns, "left_anti").collect(), key=lambda r: r.path)
    numbers = {f.path: m[1] for f in files if (m := re.match(landing.LANDED_NAME, f.path.rpartition("/")[2]))}
    wanted = {str(m.number): set(m.files) for m in landing.manifests(spark, landing_dir)
              .where(F.col("number").isin([int(n) for n in set(numbers.values())])).collect()} if numbers else {}
    whole: dict[str, list[Row]] = {}
    single = []
    for f in files:
        if numbers.get(f.path) in wanted:
            whole.setdefault(numbers[f.path], []).append(f)
        else:
            single.append([f])
    ready = [whole[n] for n in sorted(whole, key=int) if {f.path.rpartition("/")[2] for f in whole[n]} == wanted[n]]
    return ready + single


def form_batches(units: list[list[Row]], max_files: int | None) -> list[list[Row]]:
    """Micro-batches of at most ``max_files`` files; a unit is never cut, so a larger one is a batch alone."""
    out: list[list[Row]] = []
    for unit in units:
        if out and (max_files is None or len(out[-1]) + len(unit) <= max_files):
            out[-1] = out[-1] + unit
        else:
            out.append(list(unit))
    return out


# -- schema groups -----------------------------------------------------------------

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _footer(path: str) -> str | None:
    """The schema in a file's footer, as Spark writes it down; None where this process cannot tell."""
    import pyarrow.fs
    import pyarrow.parquet
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        system, name = pyarrow.fs.FileSystem.from_uri(path if "://" in path else re.sub("^(\\w+):/", r"\1:///", path))
        schema = pyarrow.parquet.read_schema(name, filesystem=system)
        if _SPARK_SCHEMA in (schema.metadata or {}):
            return schema.metadata[_SPARK_SCHEMA].decode()
        fields = [T.StructField(f.name, from_arrow_type(f.type), True) if f.name in READ_COLUMNS
                  else T.StructField(f.name, T.NullType(), True) for f in schema]
        return T.StructType(fields).json()
    except Exception:   # a store or type that only Spark's own reader knows: the caller asks that
        return None


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_footer(path.as_py()) for path in batch.column(0)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "schema"])


def footer_schemas(spark: SparkSession, paths: list[str]) -> dict[str, T.StructType]:
    """The columns of each Parquet file, from its footer, read by many tasks."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    spread = listed.repartition(min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    found = {r.path: r.schema for r in spread.mapInArrow(_footers, "path string, schema string").collect()}
    out = {p: T.StructType.fromJson(json.loads(s)) for p, s in found.items() if s is not None}
    rest = [p for p in paths if p not in out]
    if rest:
        with ThreadPoolExecutor(16) as pool:
            out |= zip(rest, pool.map(lambda p: spark.read.parquet(storage.plain(p)).schema, rest))
    return out


def schema_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files by the types of the columns that a load reads. ``MissingColumnsError``
    names every file (the first ten) that lacks a required one."""
    groups: dict[str, list[str]] = {}
    lacking = []
    for path, schema in sorted(footer_schemas(spark, paths).items()):
        have = {f.name: f.dataType for f in schema}
        missing = [c for c in ORDER_COLUMNS if c not in have]
        if missing:
            lacking.append(f"{path}: {missing}")
            continue
        read = T.StructType([T.StructField(c, have[c], True) for c in READ_COLUMNS if c in have])
        groups.setdefault(read.json(), []).append(path)
    if lacking:
        raise MissingColumnsError(f"required columns missing in {len(lacking)} of {len(paths)} files: {'; '.join(lacking[:10])}")
    return [(T.StructType.fromJson(json.loads(k)), v) for k, v in sorted(groups.items())]


def scan_files(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One raw frame with provenance for each schema group of the files."""
    return [with_provenance(spark.read.schema(schema).parquet(*map(storage.plain, group)))
            for schema, group in schema_groups(spark, paths)]


# -- one batch ---------------------------------------------------------------------

def stage_facts(raws: list[DataFrame], warehouse_root: str, batch_id: int,
                loaded_at: datetime) -> tuple[list[snapshots.Batch], IngestStats]:
    """Write both facts and the rejects of a batch, given as raw frames that share no de-duplication scope."""
    orders = [coerce_orders(raw) for raw in raws]
    products = [flatten_products(raw) for raw in raws if PRODUCTS_COLUMN in raw.columns]
    fo = first_orders(reduce(DataFrame.unionByName, orders), loaded_at)
    fp = (first_products(reduce(DataFrame.unionByName, products), loaded_at) if products
          else empty_fact_order_products(raws[0].sparkSession))
    counts = Observation()
    rejects = (reduce(DataFrame.unionByName, [rejected_values(raw) for raw in raws])
               .withColumn("loaded_at", loaded_at_literal(loaded_at))
               .observe(counts, unparsed_cells().alias("cells"), failed_order_values().alias("values")))
    staged = [warehouse.stage_batch(df, warehouse_root, name, batch_id) for df, name in (
        (fo, warehouse.FACT_ORDERS_TABLE), (fp, warehouse.FACT_ORDER_PRODUCTS_TABLE), (rejects, warehouse.REJECTS_TABLE))]
    counted = counts.get if staged[2].rows else {}
    return staged, IngestStats(
        orders_loaded=staged[0].rows, products_loaded=staged[1].rows, rejected_values=staged[2].rows,
        unparsed_product_cells=int(counted.get("cells", 0) or 0), coercion_failures=int(counted.get("values", 0) or 0))


def load_batch(raw: DataFrame, warehouse_root: str, batch_id: int,
               loaded_at: datetime | None = None) -> IngestStats:
    """Build both facts from a raw frame and (re)write them as batch ``batch_id``, in one step."""
    spark = raw.sparkSession
    loaded_at = loaded_at or _now()
    base = snapshots.current(spark, warehouse_root)
    staged, stats = stage_facts([raw], warehouse_root, batch_id, loaded_at)
    staged, totals = gate.with_totals(spark, warehouse_root, base, staged)
    snapshots.publish(spark, warehouse_root, base, staged, frozenset(), totals)
    return stats


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def load_files(spark: SparkSession, files: list[Row], warehouse_root: str, base: snapshots.Snapshot,
               loaded_at: datetime | None = None) -> IngestStats:
    """Load the files as one new batch after ``base`` and publish facts and note together.
    ``SnapshotConflict`` if another load has published meanwhile: then nothing has been loaded."""
    batch = base.next_batch()
    staged, stats = stage_facts(scan_files(spark, [f.path for f in files]), warehouse_root, batch, loaded_at or _now())
    note = spark.createDataFrame(files, storage.LISTED).withColumnRenamed("path", "landing_file").coalesce(1)
    staged.append(warehouse.stage_batch(note, warehouse_root, warehouse.LOADED_TABLE, batch))
    staged, totals = gate.with_totals(spark, warehouse_root, base, staged)
    snapshots.publish(spark, warehouse_root, base, staged, frozenset(), totals)
    stats.files_processed = len(files)
    return stats


def _archive(spark: SparkSession, files: list[Row], archive_dir: str) -> None:
    storage.make_folder(spark, archive_dir)
    for f in files:
        name = f.path.rpartition("/")[2]
        try:
            storage.rename_new(spark, f.path, f"{archive_dir}/{name}")
        except storage.Taken:       # another file of that name has been archived
            tag = hashlib.sha1(f"{f.path}|{f.modified}|{f.bytes}".encode()).hexdigest()[:12]
            storage.rename_new(spark, f.path, f"{archive_dir}/{tag}-{name}")


RETRIES = 5


def ingest(spark: SparkSession, landing_dir: str, warehouse_root: str,
           checkpoint: str | None = None, archive_dir: str | None = None,
           max_files_per_batch: int | None = None) -> dict:
    """Process every landing file not processed before; return load statistics.

    ``max_files_per_batch`` bounds a micro-batch in files, whole payloads at a time. What
    was loaded is known to the warehouse, so no checkpoint is needed (``checkpoint`` is
    accepted for callers that pass one, and not looked at)."""
    warehouse.require_tables(spark, warehouse_root)
    landing.finish_landings(spark, landing_dir)
    totals, conflicts = IngestStats(), 0
    while True:
        base = snapshots.current(spark, warehouse_root)
        batches = form_batches(pending_units(spark, landing_dir, warehouse_root, base), max_files_per_batch)
        if not batches:
            break
        try:
            stats = load_files(spark, batches[0], warehouse_root, base)
        except snapshots.SnapshotConflict:
            conflicts += 1
            if conflicts > RETRIES:
                raise
            continue
        for name in ("files_processed", "orders_loaded", "products_loaded", "unparsed_product_cells", "coercion_failures",
                     "rejected_values"):
            setattr(totals, name, getattr(totals, name) + getattr(stats, name))
        if archive_dir:
            _archive(spark, batches[0], archive_dir)
    if totals.files_processed:
        after = snapshots.current(spark, warehouse_root)
        totals.total_orders_in_db = warehouse.live_rows(spark, warehouse_root, warehouse.FACT_ORDERS_TABLE, after)
        totals.total_products_in_db = warehouse.live_rows(spark, warehouse_root, warehouse.FACT_ORDER_PRODUCTS_TABLE, after)
    return totals.as_dict()


def start_ingest_stream(spark: SparkSession, landing_dir: str, warehouse_root: str,
                        interval: str = "1 minute", checkpoint: str | None = None,
                        archive_dir: str | None = None,
                        max_files_per_batch: int | None = None) -> StreamingQuery:
    """Run the same load continuously: the landing folder's file stream looks for new files
    every ``interval``, and each micro-batch of it loads what is pending. The stream only says
    that there is something; what to load, and what has been, the warehouse's snapshot says. Returns the running
    query (``stop()`` it); its ``recentProgress`` carries per-batch input counts.
    """
    warehouse.require_tables(spark, warehouse_root)
    storage.make_folder(spark, landing_dir)
    if checkpoint is None:
        key = hashlib.sha1(f"{landing_dir}|{warehouse_root}".encode()).hexdigest()[:16]
        checkpoint = os.path.join(checkpoint_dir(spark), f"cartwheel-ingest-{key}")
    arrivals = spark.readStream.schema(LANDING_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(landing_dir)

    def load_pending(_: DataFrame, __: int) -> None:
        ingest(spark, landing_dir, warehouse_root, archive_dir=archive_dir, max_files_per_batch=max_files_per_batch)

    return (arrivals.writeStream.foreachBatch(load_pending)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())
