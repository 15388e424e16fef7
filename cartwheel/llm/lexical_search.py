"""Ranked lexical search: an Aho-Corasick scan of the documents for all item terms.

There is no document index. The distinct terms of the items form one automaton,
sent to every task, whose keys carry a guard at either end (`` term ``). Texts are
brought to the same form (term bytes lower-cased, every other byte a space), so a
match is always a whole term. Two scans of the texts:

* the first counts the documents and terms of the corpus and, for each item term,
  the documents that hold it (one row for each term and task);
* the second counts term frequencies again straight from the text, adds up what
  each term is worth to the items it belongs to, and keeps the best ``k``
  documents for each item and task; a window over those ranks them.

Items are searched in blocks of about ``block_pairs`` (item, term) pairs, so neither
the automaton nor what the driver holds grows with the benchmark; an item is
never cut. Scores are whole numbers, so neither the order of rows nor their
partitioning changes them.

Null and empty texts hold no term and are in no ranking; without any term in the
corpus nothing is returned. Rows of ``items`` with equal ids are one item, null
ids too. Documents with equal or null ids are ranked as rows of their own, null ids
after others of equal score. Columns beside id and text are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table
from cartwheel.llm.textkit import LOWER, chunks, runs

UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IS_TERM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_TERM[_lo:_hi + 1] = True
# Term bytes in lower case, every other byte a space.
FORM = np.where(IS_TERM, LOWER, np.uint8(0x20)).astype(np.uint8)


def terms_of(text: Column) -> Column:
    """The terms of a text, in order, with repeats."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER_AZ, LOWER_AZ), F.lit(TERM), F.lit(0))


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Finds each term, with a guard at either end, in bytes that are read as Latin-1."""
    machine = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        machine.add_word(" " + term.encode().decode("latin-1") + " ", k)
    if terms:
        machine.make_automaton()
    return machine


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """For each chunk of a text column: first row, number of terms of each row, and the guarded texts."""
    for lo, hi, data, offs in chunks(column):
        body = FORM[data]
        start, _, doc = runs(body != 0x20, offs)
        raw = body.tobytes().decode("latin-1")
        yield lo, np.bincount(doc, minlength=hi - lo), [f" {raw[a:b]} " for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


_second = itemgetter(1)


def _counts(terms: list[str]):
    """``term, n``: documents with each term; documents at -1 and terms at -2."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, df, n_docs, n_terms = automaton(terms), Counter(), 0, 0
        for batch in batches:
            for _, n, texts in _texts(batch.column(1)):
                n_docs += int((n > 0).sum())
                n_terms += int(n.sum())
                if terms:
                    for text in texts:
                        df.update(set(map(_second, machine.iter(text))))
        keys = [-1, -2, *df]
        yield pa.record_batch({"term": pa.array(keys, pa.int32()),
                               "n": pa.array([n_docs, n_terms, *df.values()], pa.int64())})
    return rows


class _Best:
    """The best ``k`` documents of each of ``n`` items seen so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        none = np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.null = none, none, none, np.zeros(0, bool)
        self.least = np.ones(n, np.int64)          # a score below this cannot enter

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores``: one row a document, one column an item."""
        d, i = np.nonzero(scores >= self.least)
        if not len(d):
            return
        item, score = np.append(self.item, i), np.append(self.score, scores[d, i])
        doc, null = np.append(self.doc, doc[d]), np.append(self.null, null[d])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.searchsorted(item, np.arange(self.n + 1))
        keep = np.arange(len(item)) - first[item] < self.k
        self.item, order = item[keep], order[keep]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=self.n) == self.k)
        self.least[full] = self.score[np.searchsorted(self.item, full, side="right") - 1]


def _scores(terms: list[str], weight: list[int], owners: list[list[int]], n_items: int, n_docs: int, n_terms: int, k: int):
    """``item, doc_id, score``: the best ``k`` of this task for each item."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, w, best = automaton(terms), np.array(weight, np.int64), _Best(n_items, k)
        first = np.cumsum([0, *map(len, owners)])
        items = np.concatenate([np.array(o, np.int64) for o in owners])
        block = max(1, (1 << 21) // n_items)

        def flush(docs: list[tuple[int | None, int, Counter]]) -> None:
            row = np.repeat(np.arange(len(docs)), [len(c) for _, _, c in docs])
            term = np.fromiter((t for _, _, c in docs for t in c), np.int64, len(row))
            tf = np.fromiter((f for _, _, c in docs for f in c.values()), np.int64, len(row))
            m = np.array([100 - 90 + (90 * n * n_docs) // n_terms for _, n, _ in docs], np.int64)
            worth = w[term] * ((1000000000 * tf) // (1000 * tf + 8 * m[row]))
            many = first[term + 1] - first[term]
            at = np.arange(int(many.sum())) + np.repeat(first[term] - (np.cumsum(many) - many), many)
            scores = np.zeros(len(docs) * n_items, np.int64)
            np.add.at(scores, np.repeat(row * n_items, many) + items[at], np.repeat(worth, many))
            null = np.array([d is None for d, _, _ in docs])
            best.add(scores.reshape(len(docs), n_items), np.array([d or 0 for d, _, _ in docs], np.int64), null)

        held: list[tuple[int | None, int, Counter]] = []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, n, texts in _texts(batch.column(1)):
                for j, text in enumerate(texts):
                    if n[j] and (found := Counter(map(_second, machine.iter(text)))):
                        held.append((ids[lo + j], int(n[j]), found))
                        if len(held) == block:
                            flush(held)
                            held = []
        if held:
            flush(held)
        yield pa.record_batch({"item": pa.array(best.item.astype(np.int32)),
                               "doc_id": pa.array(best.doc, mask=best.null), "score": pa.array(best.score)})
    return rows


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = 200_000, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pairs = materialize(items.select(F.col(item_col).alias("item_id"), F.explode(terms_of(F.col(item_text_col))).alias("term"))
                        .distinct(), "item_terms")
    blocks = max(1, -(-pairs.count() // block_pairs))
    kind = items.schema[item_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    totals = None
    for b in range(blocks):
        mine = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        owners: dict[str, list[int]] = {}
        names: dict = {}
        for item, term in mine.collect():
            owners.setdefault(term, []).append(names.setdefault(item, len(names)))
        terms = sorted(owners)
        counted = {r.term: r.n for r in texts.mapInArrow(_counts(terms), "term int, n long")
                   .groupBy("term").agg(F.sum("n").alias("n")).collect()}
        totals = totals or (counted.get(-1, 0), counted.get(-2, 0))
        n_docs, n_terms = totals
        if not n_docs or not terms:
            continue
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(terms))]
        best = texts.mapInArrow(_scores(terms, weight, [owners[t] for t in terms], len(names), n_docs, n_terms, k),
                                "item int, doc_id long, score long")
        known = spark.createDataFrame([(i, x) for x, i in names.items()], f"item int, item_id {kind}")
        out = out.unionByName(best.join(F.broadcast(known), "item").select("item_id", "doc_id", "score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
t AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM t) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, g GROUP BY term),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM tf JOIN w USING (term) JOIN t USING (term), g GROUP BY item_id, r, doc_id),
k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
