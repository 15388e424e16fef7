"""WARC writing, and reading by boundary-chain verification.

Writing: each page is one record; equal payloads (by SHA-1 and length) are stored
once, in the record of the smallest page id, and the others refer to it as
revisits. Records end in an empty line, so Spark's text writer with that as its
line separator writes archives, one file for each task, on any file system.

Reading: Spark's text reader splits files at the record magic. Each task notes for
its pieces the length and, from the header, where the next record must begin; a
magic inside a payload makes such a candidate too. Offsets are running sums of
the lengths. Then the chain is verified from the start of each file: every
split folds its candidates to the first offset beyond the split, pointer jumping
over these exits (two, four, eight ... splits at once) finds where the chain enters each split, and a
second look at the split keeps what the chain reaches. All else is payload, and
the pieces of a record that a magic cut apart are joined again. For these the archives are
read a second time, split as they were the first time whatever cores are alive by then; a
record whose pieces are not found whole is an error, never a missing row.

Null html reads as empty. Pages equal in payload and smallest id are all
responses. A null id never becomes the smallest while another is there. A record cut
off by the end of its file is not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, new_path, table

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
# The base-32 alphabet of RFC 4648 and the digits that conv() writes.
_BASE32, _CONV = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(binary: Column) -> Column:
    """Upper-case base-32 SHA-1: five hex digits at a time are four base-32 digits."""
    digest = F.sha1(binary)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _CONV, _BASE32)


def _record_id(page: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit(""))))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, none for null; line breaks in the value are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> None:
    """Write one record for each page (``page_id, url, html``) under ``path``.
    Payloads shorter than ``least`` bytes are always stored."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    size, digest = F.octet_length("payload"), F.sha1(F.col("payload").cast("binary"))
    # only digests found more than once: usually few, and then the planner, which sees the table's size, does not shuffle the payloads
    repeated = materialize(
        rows.select("page_id", size.cast("long").alias("size"), digest.alias("digest")).where(F.col("size") >= least)
        .groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    joined = rows.withColumns({"size": size.cast("long"), "digest": digest}).join(repeated, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload").cast("binary")))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))), _line("WARC-Profile", F.when(revisit, F.lit(_REVISIT))),
        _line("X-Page-Id", F.col("page_id").cast("string")), _line("X-Refers-To-Page-Id", F.when(revisit, F.col("first").cast("string"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")))
    record = F.concat(head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


_SPLITS = ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


def _split_settings(spark: SparkSession) -> dict[str, str]:
    """What Spark splits files by. Without a least number of partitions it takes that of the
    cores alive at planning, so it is taken down as well."""
    least = spark.conf.get(_SPLITS[0], None) or str(spark.sparkContext.defaultParallelism)
    return {_SPLITS[0]: least, **{name: spark.conf.get(name) for name in _SPLITS[1:]}}


@contextmanager
def _splitting(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Files read and written on inside the block are split by ``settings``."""
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between magics in file order: file, split, place in the split, and the raw piece."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("place"), "value"))


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(F.concat(F.lit("\r\n"), head), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _candidates(pieces: DataFrame) -> DataFrame:
    """What each piece's header says. ``size``: bytes of the piece with the magic before it;
    ``whole``: bytes of the record that it claims to be, 0 if it is none."""
    value, raw = F.col("value"), F.col("value").cast("binary")
    head = F.substring_index(value, END, 1)
    head_bytes = F.octet_length(head)
    length = F.regexp_extract(_field(head, "Content-Length"), r"^(\d{1,12})$", 1)
    is_record = (head_bytes < F.octet_length(value)) & (F.coalesce(length, F.lit("")) != "")
    # the HTTP header ends at the first empty line of the block
    block_at = head_bytes + len(END)
    http = F.substring_index(F.substr(raw, block_at + 1).cast("string"), END, 1)
    body_at = block_at + F.octet_length(http) + len(END)
    block_bytes = F.when(is_record, length.cast("long")).otherwise(F.lit(0))
    body_bytes = F.greatest(block_bytes - (body_at - block_at), F.lit(0))
    body = F.substr(raw, (body_at + 1).cast("int"), body_bytes.cast("int"))
    return pieces.select(
        "file", "block", "file_size", "place", F.octet_length(value).cast("long").alias("bytes"),
        F.when(is_record, len(MAGIC) + block_at + block_bytes + len(END)).otherwise(F.lit(0)).cast("long").alias("whole"),
        F.struct(_field(head, "WARC-Type").alias("type"), _field(head, "X-Page-Id").cast("long").alias("page_id"),
                 _field(head, "X-Refers-To-Page-Id").cast("long").alias("refers_to"),
                 _field(head, "WARC-Target-URI").alias("url"), _field(head, "WARC-Payload-Digest").alias("digest"),
                 _field(http, "Content-Length").cast("long").alias("full_bytes"), body_at.cast("long").alias("body_at"),
                 body_bytes.cast("long").alias("body_bytes"), F.sha1(body).alias("sha1")).alias("record"))


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, the first offset of its chain beyond the split, or -1."""
    pdf = pdf.sort_values("offset")
    offset, nxt = pdf["offset"].to_numpy(), pdf["next"].to_numpy()
    stop = int(pdf["stop"].iloc[0])
    at = {o: k for k, o in enumerate(offset.tolist())}
    leave = np.full(len(offset), -1, np.int64)
    for k in range(len(offset) - 1, -1, -1):
        if nxt[k] >= stop:
            leave[k] = nxt[k]
        elif nxt[k] > offset[k] and nxt[k] in at:
            leave[k] = leave[at[nxt[k]]]
    return pd.DataFrame({"file": pdf["file"], "offset": offset, "leave": leave})


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The chain through a split from where it enters; pieces off the chain are
    given to the record that holds them."""
    pdf = pdf.sort_values("offset")
    enter = pdf["enter"].dropna()
    if not len(enter):
        return pdf.iloc[:0][["file", "block", "place", "offset"]].assign(owner=0)
    offset, nxt = pdf["offset"].to_numpy(), pdf["next"].to_numpy()
    following = dict(zip(offset.tolist(), nxt.tolist()))
    at, chain = int(enter.iloc[0]), []
    while at in following:
        chain.append(at)
        if following[at] <= at:
            break
        at = following[at]
    begin = np.array(chain, np.int64)
    end = np.array([following[o] for o in chain], np.int64)
    holder = np.searchsorted(begin, offset, side="right") - 1
    inside = (holder >= 0) & (offset < end[holder])
    owner = np.where(inside, begin[holder], -1)
    return pdf.assign(owner=owner)[["file", "block", "place", "offset", "owner"]]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record on the chain of its file: ``file, offset, type, page_id,
    refers_to, url, digest, payload_bytes, sha1``; for a revisit the payload's
    length and digest are those that it declares."""
    splits_by = _split_settings(spark)
    with _splitting(spark, splits_by):
        cands = materialize(_candidates(_pieces(spark, path)), "candidates")
    # offsets: running sums over the splits of a file, then over the pieces of a split
    splits = cands.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("total"), F.max("file_size").alias("file_size"))
    before = F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", before.alias("base"), F.least(before + F.col("total") - len(MAGIC), F.col("file_size")).alias("stop"))
    within = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum(F.col("bytes") + len(MAGIC)).over(within), F.lit(0))
    # the magic stands before its piece; the first piece of a file is what precedes the first magic
    offset = F.col("base") + F.col("run") - len(MAGIC)
    chain = (cands.select("file", "block", "place", "bytes", "whole", "file_size", run.alias("run")).join(splits, ["file", "block"])
             .select("file", "block", "place", "bytes", "file_size", "stop", offset.alias("offset"), (offset + F.col("whole")).alias("next"),
                     F.col("whole"))
             .where((F.col("offset") >= 0) | (F.col("bytes") > 0)))
    chain = materialize(chain.where("offset >= 0"), "chain")
    exits = materialize(chain.groupBy("file", "block").applyInPandas(_fold, "file string, offset long, leave long"), "exits")
    entered = exits.select("file", F.col("leave").alias("offset")).unionByName(exits.select("file", F.lit(0).cast("long").alias("offset"))).distinct()
    jump = materialize(exits.join(entered, ["file", "offset"]), "jumps")
    reached = jump.where("offset = 0").select("file", "offset")
    known = 0
    while True:
        step = jump.select("file", "offset", "leave")
        reached = materialize(reached.unionByName(
            reached.join(step, ["file", "offset"]).select("file", F.col("leave").alias("offset"))).distinct(), "reached")
        now = reached.count()
        if now == known:
            break
        known = now
        further = step.select("file", F.col("offset").alias("leave"), F.col("leave").alias("beyond"))
        jump = materialize(step.join(further, ["file", "leave"]).select("file", "offset", F.col("beyond").alias("leave")), "jumps")
    entries = reached.withColumnRenamed("offset", "enter")
    marked = chain.join(entries, (chain["file"] == entries["file"]) & (chain["offset"] == entries["enter"]), "left").drop(entries["file"])
    return _records(spark, path, splits_by, cands, materialize(marked, "marked"))


def _records(spark: SparkSession, path: str, splits_by: dict[str, str], cands: DataFrame, marked: DataFrame) -> DataFrame:
    owned = materialize(marked.groupBy("file", "block").applyInPandas(
        _follow, "file string, block long, place long, offset long, owner long"), "owned")
    key = ["file", "block", "place"]
    on_chain = owned.where("owner = offset").select(*key, "offset")
    records = cands.join(on_chain, key).join(marked.select(*key, F.col("next")), key).where("next <= file_size")
    cut = (F.col("whole") - len(END) - len(MAGIC)) > F.col("bytes")      # a magic inside the payload
    plain = records.where(~cut).select("file", "offset", "record.*")
    broken = materialize(records.where(cut).select("file", "offset", "next", "record"), "broken")
    if broken.isEmpty():
        return _shaped(plain)
    # pieces of a cut record, wherever their splits end: those from its offset to its end
    bounds = broken.select(F.col("file").alias("f"), F.col("offset").alias("lo"), F.col("next").alias("hi"))
    inside = marked.join(bounds, (marked["file"] == bounds["f"]) & (marked["offset"] >= bounds["lo"]) & (marked["offset"] < bounds["hi"]))
    inside = materialize(inside.select(*key, F.col("offset").alias("at"), "lo"), "inside")
    joined = (_pieces(spark, path).join(inside, key).groupBy("file", "lo")
              .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
              .select("file", F.col("lo").alias("offset"), F.array_join(F.col("parts.value"), MAGIC).cast("binary").alias("raw")))
    rec, raw = F.col("record"), F.col("raw")
    body = F.substr(raw, (rec.body_at + 1).cast("int"), rec.body_bytes.cast("int"))
    # the magic stands before the first piece; after the last come the record's end and what the next record's magic cut off
    found = F.octet_length(raw) >= F.col("next") - F.col("offset") - len(MAGIC) - len(END)
    lost = F.raise_error(F.concat(F.lit("a record was read in part: "), F.col("file"), F.lit(" at "), F.col("offset").cast("string")))
    sha1 = F.when(F.coalesce(found, F.lit(False)), F.sha1(body)).otherwise(lost.cast("string"))
    whole = broken.join(joined, ["file", "offset"], "left").withColumn("record", rec.withField("sha1", sha1))
    with _splitting(spark, splits_by):
        whole = materialize(whole.select("file", "offset", "record.*"), "joined_records")
    return _shaped(plain.unionByName(whole))


def _shaped(records: DataFrame) -> DataFrame:
    revisit = F.col("type") == "revisit"
    parts = [F.lpad(F.conv(F.substring("sha1", 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    seen = F.translate(F.concat(*parts), _CONV, _BASE32)
    return records.select(
        "file", "offset", "type", "page_id", "refers_to", "url",
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(seen).alias("digest"),
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"))


def op10_warc_records(spark, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back."""
    path = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS x, min(page_id) OVER (PARTITION BY b) AS first FROM p),
k AS (SELECT page_id, x, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1), '' ORDER BY i) AS payload_digest
      FROM h, range(32) t(i) GROUP BY page_id, x)
SELECT h.page_id, payload_bytes, payload_digest, CASE WHEN h.page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN h.page_id <> first THEN first END AS refers_to
FROM h JOIN k ON h.page_id = k.page_id AND h.x = k.x
"""
