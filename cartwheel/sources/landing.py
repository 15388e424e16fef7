"""Land order payloads as Parquet (the fetch side of the pipeline).

A payload is one JSON document per file, in any of these envelopes:

* a list of records → the records;
* an object → the value of its *first* key (document order) that holds a
  list; if no key holds a list, the object itself is the one record;
* a scalar → one record holding it.

Records become rows. A column exists when any record has that key. Values
that are lists or objects (``products``) are stored as JSON text, ``''`` for
missing; scalars are stored as their text. Each landed row also carries
``source_file`` (the payload it came from) and ``row_index`` (its position
in the payload), which give the ingest its per-file de-duplication scope
and its "keep first" order.

Everything is expressed on the VARIANT type with built-in functions. The
one driver round trip is the list of distinct record keys (the landing
schema), which is bounded by the number of field names, not by the data.
A single payload is one ``wholetext`` record and does not split, so
payloads should be fetched in bounded pages; many payload files are read in
parallel.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cartwheel.sources import storage
from cartwheel.schemas import ORDER_COLUMNS, PRODUCTS_COLUMN, ROW_BLOCK, ROW_INDEX, SOURCE_FILE

SCALAR_RECORD_COLUMN = "0"
# The declared landing schema for order payloads: (column, holds nested JSON).
CONTRACT_COLUMNS = [(c, False) for c in ORDER_COLUMNS] + [(PRODUCTS_COLUMN, True)]


class PayloadError(ValueError):
    """A payload file is not valid JSON."""


def read_payloads(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """One row per payload file: source_file, text, payload (VARIANT, NULL if unparseable)."""
    text = (
        spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
        .select(F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("value").alias("text"))
    )
    return text.select(SOURCE_FILE, "text", F.try_parse_json("text").alias("payload"))


def read_record_lines(spark: SparkSession, path: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """JSON Lines files: one record per non-blank line, read in parallel splits.

    source_file, row_block, row_index, text, record (VARIANT, NULL if the line
    is not JSON). Large files split across tasks; the file order of lines is
    kept as (start of the split, increasing id within the split), which is
    what "keep the first row" needs, without a window over the whole file.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    return (
        lines.where(F.trim(F.col("value")) != "")
        .select(
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_block_start").alias(ROW_BLOCK),
            F.monotonically_increasing_id().alias(ROW_INDEX),
            F.col("value").alias("text"),
            F.try_parse_json("value").alias("record"),
        )
    )


def _as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _is_nested(v: Column) -> Column:
    """True for a JSON list or object. Looks at the top level only (unlike
    ``schema_of_variant``, which walks every nested value)."""
    return _as_list(v).isNotNull() | _as_map(v).isNotNull()


def _first_list_key(as_map: Column, text: Column) -> Column:
    """Name of the first key, in document order, whose value is a JSON list.

    VARIANT objects keep their keys sorted, so document order comes from
    re-reading the key names of the text — only when more than one key
    holds a list and the order actually matters.
    """
    def holds_list(k):
        return _as_list(F.element_at(as_map, k)).isNotNull()
    listed = F.filter(F.map_keys(as_map), holds_list)
    in_document_order = F.filter(F.json_object_keys(text), holds_list)
    return F.when(F.size(listed) <= 1, F.get(listed, 0)).otherwise(F.get(in_document_order, 0))


def envelope_records(payloads: DataFrame) -> DataFrame:
    """source_file, row_index, record (VARIANT): one row per record."""
    payload, text = F.col("payload"), F.col("text")
    as_list, as_map = _as_list(payload), _as_map(payload)
    records = (
        F.when(as_list.isNotNull(), as_list)
        .when(as_map.isNotNull(),
              F.coalesce(_as_list(F.element_at(as_map, _first_list_key(as_map, text))),
                         F.array(payload)))
        .otherwise(F.array(payload))
    )
    return payloads.select(SOURCE_FILE, F.lit(0).cast("bigint").alias(ROW_BLOCK),
                           F.posexplode(records).alias(ROW_INDEX, "record"))


def record_columns(records: DataFrame) -> list[tuple[str, bool]]:
    """[(key, nested)] over all records: nested when any value is a list/object.

    Non-object records contribute the single column ``"0"``. The result is
    the landing schema: one row per distinct field name.
    """
    record = F.col("record")
    as_map = _as_map(record)
    entries = records.select(
        F.explode_outer(as_map).alias("key", "value"),
        as_map.isNull().alias("scalar"), record)
    fields = entries.select(
        F.when(F.col("scalar"), F.lit(SCALAR_RECORD_COLUMN)).otherwise(F.col("key")).alias("key"),
        _is_nested(F.when(F.col("scalar"), record).otherwise(F.col("value"))).alias("nested"),
    ).where(F.col("key").isNotNull())
    summary = fields.groupBy("key").agg(F.max("nested").alias("nested"))
    return sorted((r.key, bool(r.nested)) for r in summary.collect())


def _struct_type(columns: list[tuple[str, bool]]) -> str:
    fields = ", ".join("`{}`: variant".format(k.replace("`", "``")) for k, _ in columns)
    return f"struct<{fields}>"


def records_to_rows(records: DataFrame, columns: list[tuple[str, bool]]) -> DataFrame:
    """Project each record to the discovered columns (text / JSON text).

    One ``struct<…>`` cast per record pulls every field at once; it is NULL
    for a record that is not an object.
    """
    named = [(k, n) for k, n in columns if k != SCALAR_RECORD_COLUMN]
    out = [F.col(SOURCE_FILE), F.col(ROW_BLOCK).cast("bigint").alias(ROW_BLOCK),
           F.col(ROW_INDEX).cast("bigint").alias(ROW_INDEX)]
    fields = F.try_variant_get(F.col("record"), "$", _struct_type(named)) if named else None
    for key, nested in columns:
        if key == SCALAR_RECORD_COLUMN:
            value = F.when(_as_map(F.col("record")).isNull(), F.col("record"))
        else:
            value = fields.getField(key)
        if nested:
            cell = F.when(F.is_variant_null(value), F.lit("")).otherwise(
                F.coalesce(F.to_json(value), F.lit("")))
        else:
            cell = F.try_variant_get(value, "$", "string")
        out.append(cell.alias(key))
    return records.select(*out)


LEDGER = "_ledger"
STAGING = "_staging"
# Files of a landing are named by its number: with the ledger's list of them, a reader
# can tell whether all are there.
LANDED_NAME = r"^landing-([0-9]+)-"
_MANIFEST = "attempt string, files array<string>, staged array<string>, rows bigint"


def committed(spark: SparkSession, landing_dir: str) -> list[int]:
    """Numbers of the committed landings, ascending."""
    return sorted(int(name[:-5]) for name, _ in storage.names(spark, f"{landing_dir}/{LEDGER}")
                  if name.endswith(".json") and name[:-5].isdigit())


def manifests(spark: SparkSession, landing_dir: str) -> DataFrame:
    """One row for each committed landing: ``number, attempt, files, staged, rows``."""
    if not committed(spark, landing_dir):
        return spark.createDataFrame([], f"number long, {_MANIFEST}")
    return (spark.read.schema(_MANIFEST).json(f"{storage.plain(landing_dir)}/{LEDGER}/*.json")
            .withColumn("number", F.regexp_extract(F.col("_metadata.file_name"), "^([0-9]+)", 1).cast("long")))


def finish_landings(spark: SparkSession, landing_dir: str) -> int:
    """Move what committed landings have left in staging to its place; returns the number of files.
    A landing that died after its commit is finished by this, one that died before has left nothing
    that anybody reads."""
    staging, moved = f"{landing_dir}/{STAGING}", 0
    attempts = [name for name, _ in storage.names(spark, staging)]
    if not attempts:
        return 0
    for m in manifests(spark, landing_dir).where(F.col("attempt").isin(attempts)).orderBy("number").collect():
        left = {name for name, _ in storage.names(spark, f"{staging}/{m.attempt}")}
        for name, source in zip(m.files, m.staged):
            if source in left:
                storage.rename_new(spark, f"{staging}/{m.attempt}/{source}", f"{landing_dir}/{name}")
                moved += 1
        storage.delete(spark, f"{staging}/{m.attempt}")
    return moved


def new_payloads(spark: SparkSession, payload_dir: str, landing_dir: str, glob: str) -> DataFrame:
    """Payload files that no committed landing has taken: ``path, modified, bytes``.
    The same name with another time or length is a new payload."""
    found = storage.listing(spark, payload_dir, glob)
    taken = [f"{landing_dir}/{LEDGER}/payloads/{r.attempt}" for r in manifests(spark, landing_dir).select("attempt").collect()]
    if not taken:
        return found
    return found.join(spark.read.schema(found.schema).parquet(*taken), found.columns, "left_anti")


def land_payloads(spark: SparkSession, payload_dir: str, landing_dir: str,
                  glob: str | None = None,
                  columns: list[tuple[str, bool]] | None = None,
                  lines: bool = False, archive_dir: str | None = None) -> int:
    """Read every payload file not landed before, normalise it and add the
    rows to ``landing_dir``. Returns the number of rows landed.

    ``lines=False``: each file is one JSON document in any envelope (the
    source's API response). ``lines=True``: JSON Lines, one record per line,
    which Spark splits across tasks — the form to use for large landings.
    ``columns`` declares the landing schema (e.g. ``CONTRACT_COLUMNS``); when
    omitted it is inferred from the records, like the source does: a column
    for every key any record has. An unparseable payload (or line) fails the whole
    call before anything is written. ``archive_dir`` is not looked at: the ledger knows
    what has landed, wherever the landed files are.

    Each payload, known by path, modification time and length, lands exactly once.
    The rows are staged and the payloads noted, both under the attempt's own name. The
    landing's manifest, which names them, is then given the next free number by one rename:
    that is the commit. Moving the staged files to their place can be repeated
    (``finish_landings``, at the beginning of the next call), and the ingest admits a landing only
    when all its files are there. Where another call has taken the number first, this
    one starts over and lands what the other has not.
    """
    finish_landings(spark, landing_dir)
    while True:
        number = max(committed(spark, landing_dir), default=-1) + 1
        # Names, times and lengths of the new files, noted before they are read: one that is
        # replaced meanwhile counts as new the next time.
        new = new_payloads(spark, payload_dir, landing_dir, glob or ("*.jsonl" if lines else "*.json")).collect()
        if not new:
            return 0
        try:
            return _land(spark, new, landing_dir, number, columns, lines)
        except storage.Taken:
            finish_landings(spark, landing_dir)


def _land(spark: SparkSession, new: list, landing_dir: str, number: int,
          columns: list[tuple[str, bool]] | None, lines: bool) -> int:
    paths = [storage.plain(r.path) for r in new]
    if lines:
        records = read_record_lines(spark, paths, "*")
        bad_rows = records.where(F.col("record").isNull())
    else:
        payloads = read_payloads(spark, paths, "*")
        bad_rows = payloads.where(F.col("payload").isNull())
        records = envelope_records(payloads)
    bad = bad_rows.select(SOURCE_FILE).limit(5).collect()
    if bad:
        raise PayloadError(f"payload is not valid JSON: {[r[SOURCE_FILE] for r in bad]}")
    if columns is None:
        columns = record_columns(records)
    attempt = uuid.uuid4().hex
    staged, rows = f"{landing_dir}/{STAGING}/{attempt}", 0
    if columns:
        landed = Observation("landed")
        records_to_rows(records, columns).observe(landed, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
        rows = int(landed.get["rows"])
    sources = [name for name, _ in storage.names(spark, staged) if name.endswith(".parquet")] if rows else []
    spark.createDataFrame(new, storage.LISTED).write.parquet(
        f"{landing_dir}/{LEDGER}/payloads/{attempt}")
    storage.write_new(spark, f"{landing_dir}/{LEDGER}/{number}.json", {
        "attempt": attempt, "files": [f"landing-{number}-{k:05d}.parquet" for k in range(len(sources))],
        "staged": sources, "rows": rows})
    finish_landings(spark, landing_dir)
    return rows
