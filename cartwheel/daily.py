"""The daily load as one driver program: land → load → validate.

Mirrors the reference's three steps without a scheduler: payload files are
landed as Parquet, every unprocessed landing file is loaded into the fact
tables (idempotent, checkpointed), then the load gate runs on the tables.
A failure in any step raises; re-running the same call resumes safely:
payload files already landed are skipped, and loading replays only
uncommitted batches (each overwriting its own partition).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwheel.sources import warehouse
from cartwheel.sources.gate import validate_warehouse
from cartwheel.sources.landing import land_payloads
from cartwheel.streaming.ingest import ingest


def run_daily_load(spark: SparkSession, payload_dir: str | None, landing_dir: str,
                   warehouse_root: str, checkpoint: str | None = None,
                   archive_dir: str | None = None, lines: bool = False,
                   buckets: int | None = None) -> dict:
    """Land new payloads (if a payload folder is given), load, validate.

    ``lines=True`` reads the payload folder as JSON Lines (one record per line).
    ``buckets`` creates a new warehouse bucketed by order_id (see
    ``warehouse.create_tables``); an existing warehouse keeps its layout.

    Returns the load statistics merged with the gate's counts; raises
    ``LoadValidationError`` when the gate fails.
    """
    warehouse.create_tables(spark, warehouse_root, buckets=buckets)
    landed = (land_payloads(spark, payload_dir, landing_dir, lines=lines, archive_dir=archive_dir)
              if payload_dir else 0)
    stats = ingest(spark, landing_dir, warehouse_root, checkpoint, archive_dir)
    report = validate_warehouse(spark, warehouse_root)
    return {"rows_landed": landed, **stats, "gate": report.__dict__}
