"""Filter interaction audit by incremental retraction streaming.

Five filters judge a text; for every order in which they can be applied the audit says
what each step removes, what it would have removed had it come earlier, and what it costs.
All of that follows from one histogram: documents by part, by the *mask* of the filters
they fail and by their labels. The histogram is kept by a stream:

* the files of the table are read as available-now micro-batches (``batches`` of about
  equal numbers of files); each task works out the masks and drops the texts;
* filter E (an equal text with a smaller id) depends on rows that may not have arrived.
  Keyed state holds, for the SHA-256 of each text, the least id so far and how its rows
  were counted. Rows beside a smaller id count as failing E. When a smaller id arrives, the
  earlier least one is retracted from its mask and counted again with E. A state key is a
  bucket of about ``texts_per_state`` texts, dealt by hash, so there are as many as the table asks for;
* the resulting changes, positive and negative, are summed and written a micro-batch at a
  time, each to a folder of its own, so a repeated batch replaces its own changes.

Copies of one text are combined in every task before they are shuffled to its state, so a
text that a third of the rows hold arrives as a few rows a task. State lives in RocksDB
with its checkpoint in the shared folder.

Null texts are empty. Rows without an id have no smaller id, are no smaller id to others, and
have no labels. Several rows of the least id all pass E. Several labels of an id count as
given if one of them is. A null part reads as the empty string. An empty table has no part and
gives no rows. Columns beside the four named ones are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cartwheel.llm.common import materialize, new_path, table

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(0x41, 0x5B))
E = 1 << FILTERS.index("E")
HELD = 50_000

_STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: what each sets aside ahead would be more than it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def fails(text: str) -> int:
    """The mask of the filters A to D that a text fails."""
    raw = text.encode()
    words = raw.split()                 # at 0x20 and 0x09 to 0x0D
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > CAPITALS_PERCENT * len(text)) << 2
            | (len(raw) != len(raw.translate(None, SIGNS))) << 3)


_MARKS = pa.schema([("id", pa.int64()), ("at", pa.int64()), ("part", pa.string()), ("key", pa.binary()),
                    ("mask", pa.int32()), ("n", pa.int64())])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without their text; rows equal in id, part and text are one. ``at`` is the id, or
    for rows without one a number that spreads them."""
    for batch in batches:
        seen: dict[tuple, list] = {}
        for number, part, text in zip(*(batch.column(k) for k in range(3))):
            text = text.as_py() or ""
            key = hashlib.sha256(text.encode()).digest()
            row = seen.setdefault((number.as_py(), part.as_py(), key), [0, 0])
            if not row[1]:
                row[0] = fails(text)
            row[1] += 1
        rows = [(number, int.from_bytes(key[:8], "big", signed=True) if number is None else number, part, key, mask, n)
                for (number, part, key), (mask, n) in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MARKS)] if rows
                                         else [pa.array([], f.type) for f in _MARKS], schema=_MARKS)


_GROUPS = pa.schema([("key", pa.binary()), ("mask", pa.int32()), ("part", pa.string()), ("quality", pa.bool_()),
                     ("toxic", pa.bool_()), ("least", pa.int64()), ("at_least", pa.int64()), ("others", pa.int64()),
                     ("without", pa.int64())])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text, part and labels of a task: its least id, how many rows have it, how
    many another id, and how many none. What is held is bounded: at ``HELD`` groups they are sent on."""
    held: dict[tuple, list] = {}

    def send() -> pa.RecordBatch:
        rows = [(*group, least or 0, *counts) for group, (least, *counts) in held.items()]      # 0 without a row is no id
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _GROUPS)], schema=_GROUPS)

    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("key", "mask", "part", "quality", "toxic", "id", "n")}
        for *group, number, n in zip(*columns.values()):
            counts = held.setdefault(tuple(group), [None, 0, 0, 0])
            if number is None:
                counts[3] += n
            elif counts[0] is None or number < counts[0]:
                counts[:3] = [number, n, counts[1] + counts[2]]
            elif number == counts[0]:
                counts[1] += n
            else:
                counts[2] += n
        if len(held) >= HELD:
            yield send()
    if held:
        yield send()


_CHANGE = "part string, mask int, quality boolean, toxic boolean, n long"
# One entry for each text, part and labels of the rows that have the text's least id.
_STATE = "text array<binary>, least array<long>, part array<string>, quality array<boolean>, toxic array<boolean>, n array<long>"


def _retract(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Count the new rows of a bucket's texts; where a text's least id falls, retract what was counted for the earlier one."""
    texts: dict[bytes, list] = {}            # text: least id, rows that have it by part and labels
    for key, least, *group, n in zip(*state.get) if state.exists else ():
        texts.setdefault(bytes(key), [least, {}])[1][tuple(group)] = n
    change: dict[tuple, int] = {}

    def count(mask: int, groups: dict[tuple, int], sign: int = 1) -> None:
        for (part, quality, toxic), n in groups.items():
            at = (part, mask, quality, toxic)
            change[at] = change.get(at, 0) + sign * n

    for frame in frames:
        for key, mask, part, quality, toxic, low, at_low, others, without in zip(
                *(frame[c].tolist() for c in ("key", "mask", "part", "quality", "toxic", "least", "at_least", "others", "without"))):
            group = (part, bool(quality), bool(toxic))
            count(mask, {group: without})
            count(mask | E, {group: others})
            if not at_low:
                continue
            held = texts.setdefault(bytes(key), [None, {}])
            if held[0] is None or low < held[0]:
                count(mask, held[1], -1)
                count(mask | E, held[1])
                held[:] = [int(low), {}]
            if low == held[0]:
                count(mask, {group: at_low})
                held[1][group] = held[1].get(group, 0) + at_low
            else:
                count(mask | E, {group: at_low})
    entries = [(key, least, *group, int(n)) for key, (least, groups) in texts.items() for group, n in groups.items()]
    if entries:
        state.update(tuple(map(list, zip(*entries))))
    rows = [(*at, n) for at, n in change.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "quality", "toxic", "n"])


def failure_histogram(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4, texts_per_state: int = 1000,
                      id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, quality, toxic, n`` over all rows of the Parquet files at ``path``."""
    given = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("quality"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    given = materialize(given, "labels")
    still = spark.read.parquet(path)
    buckets = max(1, -(-still.count() // texts_per_state))
    names = still.inputFiles()
    files = max(1, -(-len(names) // batches))
    if [n.rpartition("/")[2] for n in names] == [path.rpartition("/")[2]]:
        path = f"{path[:-1]}[{path[-1]}]"       # the file source takes a single file only by a pattern
    rows = (spark.readStream.schema(still.schema).option("maxFilesPerTrigger", files).parquet(path)
            .select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                    F.col(text_col).alias("text"))
            .mapInArrow(_marks, "id long, at long, part string, key binary, mask int, n long"))
    rows = rows.join(given, (rows["at"] == given["labelled"]) & rows["id"].isNotNull(), "left").select(
        "key", "mask", "part", F.coalesce("quality", F.lit(False)).alias("quality"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "id", "n")
    groups = rows.mapInArrow(_combine, "key binary, mask int, part string, quality boolean, toxic boolean, "
                                       "least long, at_least long, others long, without long")
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    changes = groups.groupBy("bucket").applyInPandasWithState(_retract, _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout)

    counters = new_path(spark, "counters")
    spark.createDataFrame([], _CHANGE).write.parquet(f"{counters}/batch=-1")

    def write(changed: DataFrame, batch: int) -> None:
        (changed.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
         .write.mode("overwrite").parquet(f"{counters}/batch={batch}"))

    before = {key: spark.conf.get(key, None) for key in _STREAM_CONF}
    for key, value in _STREAM_CONF.items():
        spark.conf.set(key, value)
    try:
        query = (changes.writeStream.foreachBatch(write).outputMode("append").trigger(availableNow=True)
                 .option("checkpointLocation", new_path(spark, "stream")).start())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    return (spark.read.schema(_CHANGE).parquet(counters).groupBy("part", "mask", "quality", "toxic")
            .agg(F.sum("n").alias("n")).where("n <> 0"))


def interactions(histogram: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``part, mask, quality, toxic, n``."""
    full = 1 << len(FILTERS)

    def kept_after(n: Column) -> Column:
        """At place U: rows that fail no filter of the set U."""
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(u) == 0, n)), F.lit(0)) for u in range(full)])

    n = F.col("n")
    alone = F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == 1 << k, n)), F.lit(0)) for k in range(len(FILTERS))])
    share = F.array(*[F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.expr(f"n * {_orders()} div bit_count(mask)"))), F.lit(0))
                      for k in range(len(FILTERS))])
    parts = histogram.groupBy("part").agg(
        kept_after(n).alias("z"), kept_after(F.when(F.col("quality"), n)).alias("zq"),
        kept_after(F.when(F.col("toxic"), n)).alias("zt"), alone.alias("alone"), share.alias("share"))
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        done = 0
        for step, k in enumerate(order, 1):
            steps.append(f"('{''.join(FILTERS[j] for j in order)}', {step}, {k}, {done}, {done | 1 << k})")
            done |= 1 << k
    spread = parts.select("*", F.explode(F.expr(
        f"transform(array({', '.join(steps)}), x -> named_struct('filter_order', x.col1, 'step', x.col2, 'k', x.col3, 'old', x.col4, 'new', x.col5))"
    )).alias("s"))
    return spread.select("part", "s.filter_order", "s.step", *[F.expr(f"{e}").cast("long").alias(name) for name, e in (
        ("kept", "z[s.new]"), ("removed", "z[s.old] - z[s.new]"),
        ("redundant", "(z[0] - z[shiftleft(1, s.k)]) - (z[s.old] - z[s.new])"), ("unique_fails", "alone[s.k]"),
        ("good_lost", "zq[s.old] - zq[s.new]"), ("toxic_lost", "zt[s.old] - zt[s.new]"), ("shapley", "share[s.k]"))])


def _orders() -> int:
    """Orders of the filters. Of those, one in ``bit_count(mask)`` has a given filter of the mask first."""
    out = 1
    for k in range(2, len(FILTERS) + 1):
        out *= k
    return out


def op11_filter_interactions(spark, sf_dir: str) -> DataFrame:
    """The audit of the five filters over all documents, by source."""
    histogram = failure_histogram(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))
    return interactions(histogram)


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT doc_id, part, CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS q, bool_or(toxic = 1) AS x FROM labels GROUP BY doc_id),
h AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (q) AS nq, count(*) FILTER (x) AS nx
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31),
s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(CAST(list_sum(bits[1:step - 1]) AS INTEGER), 0) AS before
  FROM (SELECT *, unnest(range(1, 6)) AS step FROM p))
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(nq) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(nx) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & bit <> 0), 0) AS BIGINT) AS shapley
FROM h, s GROUP BY ALL
"""
