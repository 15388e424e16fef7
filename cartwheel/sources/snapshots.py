"""Snapshots: which written batches of the warehouse's tables are live.

Data files are written first, each batch of a table into a folder that no reader looks
at. A snapshot is one small file, ``_snapshots/<version>.json``, that names the live folders of
all tables with their rows and bytes; the next version is written beside it and renamed
to its number, which only one writer can do. So both facts and the note of the loaded files
change in one step, a crash before it leaves nothing visible, and a reader keeps
the snapshot that it began with.

The file grows with the number of live batches, not with the rows; ``compact`` in
``warehouse`` bounds that number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from cartwheel.sources import storage

FOLDER = "_snapshots"
KEEP = 10


class SnapshotConflict(RuntimeError):
    """Another writer has published in the meantime; nothing of this one is visible."""


@dataclass(frozen=True)
class Batch:
    """One written batch of one table: its id, its folder below the table's, rows, bytes and files."""
    table: str
    batch: int
    path: str
    rows: int
    bytes: int
    files: int
    low: int | None = None          # bounds of the order ids, where they are known
    high: int | None = None


@dataclass(frozen=True)
class Totals:
    """What the load gate asks of the live order rows (``gate``)."""
    orders: int = 0
    unique_orders: int = 0
    bad_dow: int = 0
    bad_hour: int = 0


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    batches: tuple[Batch, ...] = field(default=())
    totals: Totals | None = field(default=Totals())     # None: not known, to be counted

    def of(self, table: str) -> list[Batch]:
        return [b for b in self.batches if b.table == table]

    def next_batch(self) -> int:
        return max((b.batch for b in self.batches), default=-1) + 1

    def rows(self, table: str) -> int | None:
        """The live rows of a table; None where a batch from before the first snapshot is among them."""
        counts = [b.rows for b in self.of(table)]
        return None if any(n < 0 for n in counts) else sum(counts)

    def with_batches(self, new: list[Batch], gone: set[tuple[str, int]], totals: Totals | None = None) -> Snapshot:
        """The next snapshot: without the ``(table, batch)`` of ``gone``, with the new ones that have rows."""
        gone = gone | {(b.table, b.batch) for b in new}
        stay = [b for b in self.batches if (b.table, b.batch) not in gone]
        return Snapshot(self.version + 1, (*stay, *(b for b in new if b.rows)), totals)


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name[:-5]) for name, _ in storage.names(spark, f"{root}/{FOLDER}")
                  if name.endswith(".json") and name[:-5].isdigit())


def current(spark: SparkSession, root: str) -> Snapshot:
    """The newest snapshot. A warehouse from before the first one has every batch folder live."""
    found = versions(spark, root)
    if found:
        content = storage.read_json(spark, f"{root}/{FOLDER}/{found[-1]}.json")
        totals = content.get("totals")
        return Snapshot(content["version"], tuple(Batch(**b) for b in content["batches"]), totals and Totals(**totals))
    from cartwheel.sources.warehouse import BATCH_COLUMN, LOADED_TABLE, TABLES
    if storage.names(spark, f"{root}/{LOADED_TABLE}") and any(
            n.endswith(".parquet") for f, _ in storage.names(spark, f"{root}/{LOADED_TABLE}")
            for n, _ in storage.names(spark, f"{root}/{LOADED_TABLE}/{f}")):
        raise RuntimeError(f"{root} notes loaded files in an earlier form; load it anew")
    old = []
    for table in TABLES:
        for name, _ in storage.names(spark, f"{root}/{table}"):
            if name.startswith(f"{BATCH_COLUMN}="):
                files = [size for n, size in storage.names(spark, f"{root}/{table}/{name}") if n.endswith(".parquet")]
                if files:
                    old.append(Batch(table, int(name.partition("=")[2]), name, -1, sum(files), len(files)))
    return Snapshot(0, tuple(old), None if old else Totals())


def publish(spark: SparkSession, root: str, base: Snapshot, new: list[Batch],
            gone: set[tuple[str, int]] = frozenset(), totals: Totals | None = None) -> Snapshot:
    """Make the next snapshot from ``base``; ``SnapshotConflict`` if somebody else has.
    Without ``totals`` those of the new snapshot are unknown until they are counted."""
    after = base.with_batches(new, set(gone), totals)
    storage.make_folder(spark, f"{root}/{FOLDER}")
    content = {"version": after.version, "batches": [vars(b) for b in after.batches],
               "totals": totals and vars(totals)}
    try:
        storage.write_new(spark, f"{root}/{FOLDER}/{after.version}.json", content)
    except storage.Taken as error:
        raise SnapshotConflict(f"version {after.version} of {root} is another writer's") from error
    for old in versions(spark, root)[:-KEEP]:
        storage.delete(spark, f"{root}/{FOLDER}/{old}.json")
    return after


def clean(spark: SparkSession, root: str, tables: list[str], batch_column: str) -> int:
    """Delete batch folders that no kept snapshot names; returns how many. Run it
    when no load is under way: what a running load has written is not named yet."""
    named = {(b["table"], b["path"]) for v in versions(spark, root)
             for b in storage.read_json(spark, f"{root}/{FOLDER}/{v}.json")["batches"]}
    if not named:
        return 0
    removed = 0
    for table in tables:
        for name, _ in storage.names(spark, f"{root}/{table}"):
            if not name.startswith(f"{batch_column}="):
                continue
            for part, _ in storage.names(spark, f"{root}/{table}/{name}"):
                if not part.endswith(".parquet") and not part.startswith(("_", ".")) and (table, f"{name}/{part}") not in named:
                    storage.delete(spark, f"{root}/{table}/{name}/{part}")
                    removed += 1
    return removed
