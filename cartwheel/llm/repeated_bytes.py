"""Suffix-array dedup: remove every byte that a repeated string of 400 bytes covers.

A depth-limited radix sort of the suffixes, most significant digit first, that
stops at the threshold: suffixes equal in the first ``length`` bytes are exactly
the repeated windows. To keep one row for many neighbouring suffixes, the
windows are sorted by bytes relative to an *anchor*: the leftmost least 16-byte
hash among the first 128 grams of the window, a function of the window's bytes
alone. Windows with one anchor are a run, told apart by the distance of the
anchor from their start.

Each pass compares a longer string, common to all windows of a block, and drops
what is alone in its group:

* pass 1: the 273 bytes from the anchor, shared by all windows of a run;
* pass 2: blocks of 8 distances, 393 bytes;
* pass 3: single windows, 400 bytes.

A group whose members agree beyond the common string, out to the ends of the
block, is settled without a further pass. Every pass is a grouped count, minimum
and maximum, combined before the shuffle, so a passage found in a third of all
documents costs one row for each task; where its occurrences are looked up again,
they meet one row, and a join of two written tables lets Spark split them over tasks. Equal strings are
those with equal 64-bit hashes.

Null text reads as empty; texts shorter than ``length`` lose nothing; identical
rows count as copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import attach, keyed, materialize, table
from cartwheel.llm.textkit import U, chunks, mix, prefix_hash, span_hash

GRAM = 16
REACH = 128
BLOCK = 8


def _anchors(prefix: np.ndarray, n: int, length: int, reach: int) -> np.ndarray:
    """Anchor position of the window at each start: hash above, position below in
    one integer, so the sliding minimum finds the leftmost least gram."""
    at = np.arange(n - GRAM + 1)
    bits = U(max(int(n).bit_length(), 1))
    best = (mix(span_hash(prefix, at, at + GRAM)) >> bits << bits) | at.astype(U)
    span = 1
    while span < reach:
        step = min(span, reach - span)
        best = np.minimum(best[:len(best) - step], best[step:])
        span += step
    return (best[:n - length + 1] & ((U(1) << bits) - U(1))).astype(np.int64)


def _run_rows(length: int, reach: int):
    """Runs of each text: string hash from the anchor, hash out to the ends, and place."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, rk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, _, data, offs in chunks(batch.column(2)):
                n = len(data)
                if n < length:
                    continue
                prefix = prefix_hash(data)
                anchor = _anchors(prefix, n, length, reach)
                doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n - length + 1]
                p = np.flatnonzero(np.arange(n - length + 1) + length <= offs[doc + 1])
                if not len(p):
                    continue
                anchor, doc = anchor[p], doc[p]
                new = np.ones(len(p), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(p)) - 1
                p0, p1, a, d = p[first], p[last], anchor[first], doc[first]
                core = mix(span_hash(prefix, a, a + length - reach + 1))
                ends = ((a - p0) * 4096 + (p1 - p0)).astype(U)
                span = mix(mix(span_hash(prefix, p0, p1 + length)) ^ mix(ends))
                yield pa.record_batch({
                    "did": did[lo + d], "rk": rk[lo + d], "core": core.view(np.int64), "span": span.view(np.int64),
                    "p0": (p0 - offs[d]).astype(np.int32), "len": (p1 - p0 + 1).astype(np.int32),
                    "back": (a - p0).astype(np.int32)})
    return rows


_RUNS = "did long, rk long, core long, span long, p0 int, len int, back int"


def _contexts(length: int):
    """The bytes of the chosen runs of each text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, picks in zip(batch.column(0), batch.column(1)):
                raw = text.as_py().encode()
                out += [{**r, "bytes": raw[r["p0"]:r["p0"] + r["len"] - 1 + length]} for r in picks.as_py()]
            if out:
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("span", "w", "len", "back", "bytes")} for r in out],
                                                 schema=_CTX)
    return rows


_CTX = pa.schema([("span", pa.int64()), ("w", pa.int64()), ("len", pa.int32()), ("back", pa.int32()), ("bytes", pa.binary())])


def _pieces(length: int, block: int):
    """For each context, its blocks of distances: hash of the bytes that all
    windows of the block share, and hash out to the ends of the block's windows.
    With a column of wanted blocks only those, cut to single windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            raw = col["bytes"].cast(pa.large_binary())
            _, offsets, buf = raw.buffers()
            data_offs = np.frombuffer(offsets, np.int64)[raw.offset:raw.offset + len(raw) + 1]
            span, w, ln, back = (col[k].to_numpy(zero_copy_only=False) for k in ("span", "w", "len", "back"))
            lo = 0
            while lo < len(raw):
                hi = min(max(int(np.searchsorted(data_offs, data_offs[lo] + (1 << 20), side="right")) - 1, lo + 1), len(raw))
                data = np.frombuffer(buf, np.uint8)[data_offs[lo]:data_offs[hi]]
                prefix = prefix_hash(data)
                row = np.arange(lo, hi)
                near, far = back[row] - ln[row] + 1, back[row]          # least and greatest distance of the run
                if "wanted" in col:
                    lists = col["wanted"].slice(lo, hi - lo)
                    counts = np.diff(lists.offsets.to_numpy())
                    row = np.repeat(row, counts)
                    blk = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    near, far = np.repeat(near, counts), np.repeat(far, counts)
                    lo_d, hi_d = np.maximum(blk * block, near), np.minimum(blk * block + block - 1, far)
                    counts = hi_d - lo_d + 1
                    row = np.repeat(row, counts)
                    d = np.repeat(lo_d, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    start = data_offs[row] - data_offs[lo] + back[row] - d
                    core = mix(span_hash(prefix, start, start + length))
                    yield pa.record_batch({"key": core.view(np.int64), "span": span[row], "w": w[row], "d": d.astype(np.int32)})
                else:
                    counts = far // block - near // block + 1
                    row = np.repeat(row, counts)
                    blk = np.repeat(near // block, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    lo_d = np.maximum(blk * block, np.repeat(near, counts))
                    hi_d = np.minimum(blk * block + block - 1, np.repeat(far, counts))
                    a = data_offs[row] - data_offs[lo] + back[row]
                    core = mix(span_hash(prefix, a - blk * block, a - (blk * block + block - 1) + length))
                    # the distance of the block tells equal bytes at other distances apart
                    core = mix(core ^ mix(blk.astype(U)))
                    ends = (lo_d * 4096 + hi_d).astype(U)
                    out = mix(mix(span_hash(prefix, a - hi_d, a - lo_d + length)) ^ mix(ends))
                    yield pa.record_batch({
                        "key": core.view(np.int64), "out": out.view(np.int64), "span": span[row], "w": w[row],
                        "blk": blk.astype(np.int32), "lo": lo_d.astype(np.int32), "hi": hi_d.astype(np.int32)})
                lo = hi
    return rows


def repeated_runs(docs: DataFrame, length: int = 400, reach: int = REACH) -> DataFrame:
    """Byte ranges ``did, rk, start, end`` of each text that repeated windows cover
    (they may overlap). ``docs`` has ``did, rk, text``."""
    runs = materialize(docs.mapInArrow(_run_rows(length, reach), _RUNS), "runs")
    shared = (runs.groupBy("core").agg(F.count("*").alias("n"), F.min("span").alias("lo"), F.max("span").alias("hi"))
              .where("n >= 2").select("core", (F.col("lo") == F.col("hi")).alias("whole")))
    # Written tables on both sides: one string may be in a third of all texts, and Spark then splits its occurrences.
    occ = materialize(runs.join(materialize(shared, "shared_strings"), "core"), "occurrences")

    mixed = occ.where(~F.col("whole"))
    reps = (mixed.groupBy("core", "span")
            .agg(F.count("*").alias("w"), F.min(F.struct("did", "rk", "p0", "len", "back")).alias("r"))
            .select("r.did", "r.rk", F.struct("span", "w", "r.p0", "r.len", "r.back").alias("pick")))
    picks = reps.groupBy("did", "rk").agg(F.collect_list("pick").alias("picks"))
    texts = docs.join(picks, ["did", "rk"]).select("text", "picks")
    ctx = texts.mapInArrow(_contexts(length), "span long, w long, len int, back int, bytes binary")
    ctx = materialize(ctx.groupBy("span").agg(*[F.first(c).alias(c) for c in ("w", "len", "back", "bytes")]), "contexts")

    blocks = materialize(ctx.mapInArrow(
        _pieces(length, BLOCK), "key long, out long, span long, w long, blk int, lo int, hi int"), "blocks")
    state = (blocks.groupBy("key").agg(F.sum("w").alias("n"), F.min("out").alias("a"), F.max("out").alias("b"))
             .where("n >= 2").select("key", (F.col("a") == F.col("b")).alias("settled")))
    blocks = materialize(blocks.join(state, "key").select("span", "w", "blk", "lo", "hi", "settled"), "live_blocks")

    wanted = blocks.where(~F.col("settled")).groupBy("span").agg(F.collect_list("blk").alias("wanted"))
    windows = materialize(ctx.join(wanted, "span").mapInArrow(
        _pieces(length, BLOCK), "key long, span long, w long, d int"), "windows")
    again = windows.groupBy("key").agg(F.sum("w").alias("n")).where("n >= 2").select("key")
    found = windows.where("w = 1").join(again, "key").select("span", F.col("d").alias("lo"), F.col("d").alias("hi"))

    repeated = (blocks.where("settled and w = 1").select("span", "lo", "hi").unionByName(found)
                .unionByName(ctx.where("w >= 2").select("span", (F.col("back") - F.col("len") + 1).alias("lo"),
                                                        F.col("back").alias("hi"))))
    repeated = materialize(repeated, "repeated_windows")
    at = F.col("p0") + F.col("back")
    return (occ.where("whole").select("did", "rk", F.col("p0").alias("start"), (F.col("p0") + F.col("len") - 1 + length).alias("end"))
            .unionByName(mixed.join(repeated, "span").select(
                "did", "rk", (at - F.col("hi")).alias("start"), (at - F.col("lo") + length).alias("end"))))


def _cut(columns: list[str]):
    """Merge the ranges of each text and cut them out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, info = batch.column("__text"), batch.column("__info")
            kept, spans = [], []
            for text, cuts in zip(texts, info):
                raw = (text.as_py() or "").encode()
                merged: list[list[int]] = []
                for start, end in sorted((c["start"], c["end"]) for c in ((cuts.as_py() or {}).get("cuts") or [])):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                pieces, at = [], 0
                for start, end in merged:
                    pieces.append(raw[at:start])
                    at = end
                pieces.append(raw[at:])
                kept.append(b"".join(pieces))
                spans.append([{"start": s, "end": e} for s, e in merged])
            arrays = [batch.column(c) for c in columns]
            arrays += [pa.array([len((t.as_py() or "").encode()) for t in texts], pa.int64()), pa.array(kept, pa.binary()),
                       pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_bytes", "kept", "removed"])
    return rows


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` with ``n_bytes``, the ``kept`` bytes and the ``removed`` ranges of each row."""
    cuts = (repeated_runs(keyed(docs, id_col, text_col), length)
            .distinct().groupBy("did", "rk").agg(F.collect_list(F.struct("start", "end")).alias("cuts")))
    slim = docs.select(id_col, F.col(text_col).alias("__text"))
    joined = attach(slim, cuts, "left", id_col, "__text")
    kind = slim.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_cut([id_col]), f"{id_col} {kind}, n_bytes long, kept binary, removed array<struct<start:int,end:int>>")


def op5_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    """Bytes left of every document when all repeated strings of 400 bytes go."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
