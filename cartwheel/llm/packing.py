"""Packing into optimal length buckets.

The global histogram of token counts (one row for each length that occurs) goes
to the driver; dynamic programming over it chooses the bucket boundaries that
minimise the padding ``sum(boundary - length)``. No length is rounded: with n
lengths a bucket more takes n log n steps, since a longer last length never has
an earlier best start of its bucket. Inside each
bucket, batches hold as many sequences as fit the token budget at the bucket's
boundary. A task fills batches from its own input split as rows come, a
bucket's next batch when the last is full: no row is shuffled, and at most one batch of
each bucket and split is not full. A batch is named by bucket, split and number.

A token is a run of letters and digits or a single other visible character. Null
and empty texts have length 0 and fill the first bucket. A text longer than the
budget is a batch of its own, never cut. Identical rows are packed as
separate sequences. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import table

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def n_tokens(text: Column) -> Column:
    """Tokens of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def _layer(before: np.ndarray, size: np.ndarray, mass: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each j the least ``before[i] + cost(i..j)`` over i <= j, and the first such i. These
    never fall as j rises, so the j halfway between two known ones searches only between theirs."""
    n = len(size)
    least, pick = np.empty_like(before), np.zeros(n, np.int64)
    step = 1 << (n - 1).bit_length()
    while step:
        j = np.arange(step - 1, n, 2 * step)
        lo = np.where(j >= step, pick[np.maximum(j - step, 0)], 0)
        hi = np.minimum(np.where(j + step < n, pick[np.minimum(j + step, n - 1)], n - 1), j)
        many = hi - lo + 1
        first = np.cumsum(many) - many
        i = np.arange(int(many.sum())) + np.repeat(lo - first, many)
        at = np.repeat(j, many)
        total = before[i] + size[at] * (mass[at + 1] - mass[i]) - (weight[at + 1] - weight[i])
        least[j] = np.minimum.reduceat(total, first) if len(j) else 0
        hit = np.flatnonzero(total == np.repeat(least[j], many))
        pick[j] = i[hit[np.searchsorted(hit, first)]] if len(j) else 0
        step //= 2
    return least, pick


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The at most ``buckets`` upper bounds, each one of ``lengths`` (ascending),
    with the least total padding; the last is the greatest length."""
    n = len(lengths)
    if not n:
        return []
    # whole numbers as long as the greatest product fits
    kind = np.int64 if int(lengths[-1]) * sum(map(int, counts)) < 1 << 62 else np.float64
    size, counts = lengths.astype(kind), counts.astype(kind)
    mass = np.concatenate([[0], np.cumsum(counts)]).astype(kind)
    weight = np.concatenate([[0], np.cumsum(counts * size)]).astype(kind)
    # cost[j] over i: lengths i..j in one bucket, padded to lengths[j]
    best = size * mass[1:] - weight[1:]
    choice = []
    for _ in range(1, min(buckets, n)):
        best, pick = _layer(np.concatenate([best[:1] * 0, best[:-1]]), size, mass, weight)
        choice.append(pick)
    bounds, j = [], n - 1
    for pick in reversed(choice):
        bounds.append(int(lengths[j]))
        j = int(pick[j]) - 1
        if j < 0:
            return bounds[::-1]
    bounds.append(int(lengths[j]))
    return bounds[::-1]


ADDED = {"n_tokens": "long", "bucket": "int", "boundary": "long", "batch": "string", "slot": "int"}


def _fill(bounds: list[int], budget: int):
    """Put each row, whose number of tokens stands last, into the open batch of its bucket."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = TaskContext.get().partitionId()
        upper = np.array(bounds, np.int64)
        fit = np.maximum(budget // np.maximum(upper, 1), 1)
        filled = np.zeros(len(upper), np.int64)
        for batch in batches:
            tokens = batch.column(batch.num_columns - 1)
            bucket = np.searchsorted(upper, tokens.to_numpy(zero_copy_only=False))
            order = np.argsort(bucket, kind="stable")
            many = np.bincount(bucket, minlength=len(upper))
            at = np.empty(len(bucket), np.int64)            # place of the row among those of its bucket in this split
            at[order] = np.arange(len(bucket)) - np.repeat(np.cumsum(many) - many, many)
            at += filled[bucket]
            filled += many
            names = [f"{b}-{split}-{n}" for b, n in zip(bucket.tolist(), (at // fit[bucket]).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket, pa.int32()), pa.array(upper[bucket]), pa.array(names, pa.string()),
                 pa.array(at % fit[bucket], pa.int32())], names=[*batch.schema.names, *list(ADDED)[1:]])
    return rows


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65536, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) beside ``n_tokens, bucket, boundary, batch, slot`` (null-free; a
    column of the input with such a name is replaced)."""
    counted = n_tokens(F.col(text_col))
    histogram = docs.groupBy(counted.alias("n_tokens")).agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    bounds = optimal_boundaries(np.array([r["n_tokens"] for r in histogram], np.int64),
                                np.array([r["n"] for r in histogram], np.int64), buckets)
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], counted.alias("n_tokens"))
    schema = T.StructType([*sized.schema.fields[:-1], *[T.StructField(c, T.StructType.fromDDL(f"x {k}")[0].dataType) for c, k in ADDED.items()]])
    return sized.mapInArrow(_fill(bounds or [0], budget), schema)


def op8_length_buckets(spark, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return pack(table(spark, sf_dir, "documents"), keep=["doc_id"])
