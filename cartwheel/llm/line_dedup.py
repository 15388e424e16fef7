"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of words (A-Z lower-cased). Lines of ``min_words`` words or
more count as copies of each other within one edit: a word replaced, inserted or
deleted. Shorter lines must be equal. Of all copies the earliest stays, in the order
of document id, row hash and line number: a line goes if an earlier line,
anywhere, is equal to it or within the edit bound.

Every line emits its deletion variants (the line without word i) as hashed keys,
with what verification needs in the key itself: two lines that share the variant
*and its position* differ in that word alone, and a line equal to another's
variant is that line without a word. So equal keys are pairs within the bound,
up to 64-bit hashes, and the earliest line of a key is a grouped minimum, combined
before the shuffle: no pairs, no group in one task.

Variants are emitted only where a line can have a partner. An edit lies in one
third of a line, so partners agree in the two others; only words of a third
whose surroundings another line shares are deleted.

Lines without words always stay. Null text stays null. Identical rows (id and
text equal) count as one row and get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import attach, keyed, materialize, table
from cartwheel.llm.textkit import SPACE, U, chunks, coefficients, mix, words

NEWLINE = 10
PARTS = 3


def _lines(data: np.ndarray, offs: np.ndarray):
    """Lines with words: text number, line number, first and end word; and two prefix
    sums, from which stretches of a line's words are hashed.

    A word's part in a sum is its hash times a coefficient drawn for its place in the line; in the second sum
    the coefficient of the place before, as if a word to its left were gone. Coefficients that
    are no powers leave sequences no common pattern by which their sums agree."""
    start, _, doc, h = words(data, offs, ~SPACE)
    breaks = np.concatenate([[0], np.cumsum(data == NEWLINE)])
    line = breaks[start] - breaks[offs[doc]]
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(start))
    h = mix(h ^ U(0x9FB21C651E98DF25))
    place = np.arange(len(h)) - np.repeat(first, end - first)
    drawn = coefficients(int(place.max()) + 1 if len(place) else 1)
    sums = np.zeros((2, len(h) + 1), U)
    np.cumsum(h * drawn[place], out=sums[0, 1:])
    np.cumsum(h * drawn[np.maximum(place - 1, 0)], out=sums[1, 1:])
    return doc[first], line[first], first, end, sums


def _stretch(sums: np.ndarray, a: np.ndarray, b: np.ndarray, left: int = 0) -> np.ndarray:
    """Hash of the words [a, b) at their places in the line, or each ``left`` (0, 1) places to the left."""
    return sums[left][b] - sums[left][a]


def _part(a: np.ndarray, short: np.ndarray, part: int, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of a third of a line, in which a pair may differ; the
    longer line of a pair has one word more there."""
    return a + short * part // PARTS, a + short * (part + 1) // PARTS + longer


def _line_rows(min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, rk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, _, data, offs in chunks(batch.column(2)):
                doc, line, a, b, sums = _lines(data, offs)
                if not len(doc):
                    continue
                n = b - a
                whole = mix(_stretch(sums, a, b) + n.astype(U))
                around = []
                # as the shorter (or equally long) line of a pair, and as the longer one
                for longer in (0, 1):
                    short = n - longer
                    for part in range(PARTS):
                        x, y = _part(a, short, part, longer)
                        tag = mix((short * PARTS + part).astype(U) ^ U(0xA0761D6478BD642F))
                        rest = mix(_stretch(sums, a, x) + tag) ^ mix(_stretch(sums, y, np.maximum(y, b), longer) - tag)
                        around.append(mix(rest).view(np.int64))
                long_enough = n >= min_words
                keys = np.stack(around, axis=1)[long_enough].ravel()
                ends = np.append(0, np.cumsum(long_enough * 2 * PARTS)).astype(np.int32)
                yield pa.record_batch({
                    "did": did[lo + doc], "rk": rk[lo + doc], "ln": line.astype(np.int32), "lh": whole.view(np.int64),
                    "around": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))})
    return rows


def _variant_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the chosen lines: one for the line itself, one for each word of the
    chosen thirds. ``picks``: line number * 8 + (third, or 3 + third as the longer line)."""
    for batch in batches:
        did, rk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        picks = batch.column(3)
        for lo, hi, data, offs in chunks(batch.column(2)):
            doc, line, a, b, sums = _lines(data, offs)
            mine = picks.slice(lo, hi - lo)
            pick = mine.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(hi - lo), np.diff(mine.offsets.to_numpy()))
            if not len(pick):
                continue
            at = np.searchsorted(doc.astype(np.int64) << 32 | line, row << 32 | pick >> 3)
            which = (pick & 7).astype(np.int64)
            longer, part = which // PARTS, which % PARTS
            n = b[at] - a[at]
            whole = mix(_stretch(sums, a[at], b[at]) + n.astype(U))
            x = a[at] + (n - longer) * part // PARTS
            y = a[at] + (n - longer) * (part + 1) // PARTS + longer
            of = np.repeat(np.arange(len(at)), y - x)
            cut = np.repeat(x - (np.cumsum(y - x) - (y - x)), y - x) + np.arange(len(of))
            i = cut - a[at][of]
            rest = _stretch(sums, a[at][of], cut) + _stretch(sums, cut + 1, b[at][of], 1)
            short = mix(rest + (n[of] - 1).astype(U))            # the hash that the shorter line has itself
            place = mix(short ^ mix(i.astype(U) + U(0xE7037ED1A0B428DB)))
            self_at = np.flatnonzero(longer == 0)
            idx = np.concatenate([self_at, of])
            l_of = longer[of]
            yield pa.record_batch({
                "key": np.concatenate([whole[self_at], np.where(l_of == 1, short, place)]).view(np.int64),
                "role": np.concatenate([np.zeros(len(self_at)), np.where(l_of == 1, 1, 2)]).astype(np.int8),
                "did": did[lo + row[idx]], "rk": rk[lo + row[idx]], "ln": line[at][idx].astype(np.int32),
                "lh": whole[idx].view(np.int64)})


def duplicate_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """``did, rk, drop``: the numbers of the lines to drop from each row that has some."""
    lines = materialize(docs.select("did", "rk", "text").mapInArrow(
        _line_rows(min_words), "did long, rk long, ln int, lh long, around array<long>"), "lines")
    place = F.struct("did", "rk", "ln")
    uniq = materialize(lines.select("lh", "did", "rk", "ln").groupBy("lh").agg(
        F.min(place).alias("first"), F.max(place).alias("last")), "distinct_lines")
    around = lines.select("lh", F.posexplode("around").alias("which", "key"))
    close = around.groupBy("key").agg(F.min("lh").alias("lo"), F.max("lh").alias("hi")).where("lo <> hi").select("key")
    able = around.join(close, "key").select("lh", "which").distinct()
    chosen = materialize(uniq.join(able, "lh").select("first.did", "first.rk", (F.col("first.ln") * 8 + F.col("which")).alias("pick")), "close_lines")
    picks = chosen.groupBy("did", "rk").agg(F.sort_array(F.collect_set("pick")).alias("picks"))
    variants = materialize(docs.select("did", "rk", "text").join(picks, ["did", "rk"]).select("did", "rk", "text", "picks").mapInArrow(
        _variant_rows, "key long, role byte, did long, rk long, ln int, lh long"), "variants")
    # a key is of use if two lines meet there; partners: the line itself and its longer ones, or lines cut at one place
    met = variants.groupBy("key").agg(
        F.min("lh").alias("lo"), F.max("lh").alias("hi"),
        *[F.min(F.when(F.col("role") == r, place)).alias(f"f{r}") for r in (0, 1, 2)]).where("lo <> hi").drop("lo", "hi")
    partner = F.when(F.col("role") == 0, F.col("f1")).when(F.col("role") == 1, F.col("f0")).otherwise(F.col("f2"))
    near = (variants.join(met, "key").select("lh", place.alias("mine"), partner.alias("other")).where("other < mine")
            .groupBy("lh").agg(F.min("other").alias("other")))
    # first place of each line or of a line close to it; only lines that lose an occurrence
    verdict = materialize(uniq.join(near, "lh", "left").select("lh", "last", F.least("first", F.coalesce("other", "first")).alias("stays"))
                          .where("stays < last").select("lh", "stays"), "verdicts")
    gone = lines.select("lh", "did", "rk", "ln").join(verdict, "lh").where(place > F.col("stays"))
    return gone.groupBy("did", "rk").agg(F.collect_set("ln").alias("drop"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("__text")
        info = batch.column(batch.schema.get_field_index("__info"))
        out, total, gone = [], [], []
        for text, drop in zip(batch.column(at).to_pylist(), info.to_pylist()):
            lines = text.split("\n") if text is not None else []
            drop = set((drop or {}).get("drop") or ())
            out.append("\n".join(x for k, x in enumerate(lines) if k not in drop) if text is not None else None)
            total.append(len(lines))
            gone.append(len(drop))
        kept = [c for c in batch.schema.names if c not in ("__text", "__info")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            names=[*kept, "__kept", "__n_lines", "__n_removed"])


def dedup_lines(docs: DataFrame, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` with the row's text less its duplicate lines in ``__kept``,
    ``__n_lines`` and ``__n_removed``, and all other columns of ``docs`` in the struct ``__row``."""
    drops = duplicate_lines(keyed(docs, id_col, text_col), min_words)
    slim = docs.select(F.struct(*[c for c in docs.columns if c != text_col]).alias("__row"), F.col(text_col).alias("__text"),
                       F.col(id_col).alias("__id"))
    joined = attach(slim, drops, "left", "__id", "__text").drop("__id")
    row = joined.schema["__row"].dataType.simpleString()
    return joined.mapInArrow(_without, f"__row {row}, __kept string, __n_lines long, __n_removed long")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and the SHA-256 of what is left."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("__row.doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"))
