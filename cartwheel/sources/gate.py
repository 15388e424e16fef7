"""The load gate without a scan of history.

The gate's counts merge: a snapshot carries those of its live order rows (``Totals``), and a load
adds its own. Only the distinct orders of a load need more than the load: they are the ids that are
not stored yet. Each batch notes the bounds of its order ids, so the ids of a load are compared with the
order ids, no other column, of the batches whose bounds meet the load's, and there of the row groups
that hold ids in the load's range (files are sorted by order id). A load of new, higher ids meets none.

Merging batches changes no total. A batch that is written again takes the totals away; the next
gate then counts the whole tables once, and loads go on from that.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession, functions as F

from cartwheel.plans.quality import LoadReport, bad_dow, bad_hour, check_report, load_report
from cartwheel.sources import snapshots, warehouse
from cartwheel.sources.snapshots import Batch, Snapshot, Totals


class TotalsError(RuntimeError):
    """The totals of a snapshot are not those of its rows."""


def meeting(base: Snapshot, batch: Batch) -> list[Batch]:
    """The live batches of orders whose id bounds meet those of a batch, or are not known."""
    return [b for b in base.of(warehouse.FACT_ORDERS_TABLE)
            if b.low is None or (b.low <= batch.high and b.high >= batch.low)]


def _unstored(spark: SparkSession, root: str, base: Snapshot, batch: Batch) -> int:
    """The distinct order ids of a staged batch that no live batch holds."""
    path = warehouse.table_path(root, warehouse.FACT_ORDERS_TABLE)

    def ids(batches: list[Batch]):
        # combined before the shuffle: an order stored very often is no hot key
        return (spark.read.schema("order_id bigint").parquet(*[f"{path}/{b.path}" for b in batches])
                .where(F.col("order_id").between(batch.low, batch.high)).distinct())
    met = meeting(base, batch)
    new = ids([batch])
    return (new.join(ids(met), "order_id", "left_anti") if met else new).count()


def with_totals(spark: SparkSession, root: str, base: Snapshot, staged: list[Batch]) -> tuple[list[Batch], Totals | None]:
    """Staged batches, the orders' with their id bounds, and the totals once they are published after ``base``."""
    live = {b.batch for b in base.of(warehouse.FACT_ORDERS_TABLE)}
    totals, out = base.totals, []
    for batch in staged:
        if batch.table != warehouse.FACT_ORDERS_TABLE:
            out.append(batch)
            continue
        if batch.batch in live:             # rows that the totals hold go away
            totals = None
        if batch.rows:
            path = f"{warehouse.table_path(root, batch.table)}/{batch.path}"
            own = spark.read.schema(warehouse.TABLES[batch.table][0]).parquet(path).agg(
                F.count(F.lit(1)).alias("orders"), F.count_if(bad_dow()).alias("dow"), F.count_if(bad_hour()).alias("hour"),
                F.min("order_id").alias("low"), F.max("order_id").alias("high")).first()
            batch = replace(batch, low=own.low, high=own.high)
            if totals is not None:
                totals = Totals(totals.orders + own.orders, totals.unique_orders + _unstored(spark, root, base, batch),
                                totals.bad_dow + own.dow, totals.bad_hour + own.hour)
        out.append(batch)
    return out, totals


def _counted(spark: SparkSession, root: str, snapshot: Snapshot) -> LoadReport:
    return load_report(*[warehouse.read_table(spark, root, name, snapshot)
                         for name in (warehouse.FACT_ORDERS_TABLE, warehouse.FACT_ORDER_PRODUCTS_TABLE)])


def warehouse_report(spark: SparkSession, root: str, recount: bool = False) -> LoadReport:
    """The gate's counts of the newest snapshot, from its totals; no table is read.

    Unknown totals are counted and published, so that they are known from then on (unless
    another writer publishes first). ``recount`` counts in any case; ``TotalsError`` if
    the totals are others."""
    snapshot = snapshots.current(spark, root)
    known = snapshot.totals
    noted = None
    if known is not None:
        noted = LoadReport(known.orders, warehouse.live_rows(spark, root, warehouse.FACT_ORDER_PRODUCTS_TABLE, snapshot),
                           known.orders - known.unique_orders, known.bad_dow, known.bad_hour)
        if not recount:
            return noted
    report = _counted(spark, root, snapshot)
    if noted is not None and noted != report:
        raise TotalsError(f"snapshot {snapshot.version} of {root} notes {noted}, its rows give {report}")
    if known is None:
        totals = Totals(report.orders_count, report.orders_count - report.duplicate_orders,
                        report.invalid_order_dow, report.invalid_order_hour)
        try:
            snapshots.publish(spark, root, snapshot, [], totals=totals)
        except snapshots.SnapshotConflict:
            pass                            # the report is of the snapshot that was read
    return report


def validate_warehouse(spark: SparkSession, root: str, recount: bool = False) -> LoadReport:
    """The load gate on a warehouse: raises on the first failing rule."""
    return check_report(warehouse_report(spark, root, recount))
