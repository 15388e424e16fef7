"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are reduced to their words: A-Z lower-cased, words are maximal runs of
digits, ASCII letters and non-ASCII characters, joined by single spaces, with a
space at either end. A pattern is a window of ``window`` consecutive words of an
item in the same form (an item of fewer words is one pattern), so a pattern
occurs exactly where its words do.

Search: with ``m`` the least pattern length of a group and blocks of ``B``
bytes, a shift table says by how much a cursor may advance when a block ends
under it; blocks that occur nowhere in the first ``m`` bytes of a pattern, which
is most of them, allow ``m - B + 1``. Where the shift is 0, the block's hash
selects a bucket of patterns and these are compared byte for byte with the text.
Many cursors run through a chunk side by side, each over its own stretch, so the
loop is a few numpy calls for each step.

Patterns are grouped by length, so that a short one does not shorten the shifts
of the others. The benchmark is read in blocks of ``block_items`` items; each block
is a bounded broadcast and one pass, so a benchmark of any size can be searched.

Null texts have no words and are never hit; items without words match nothing;
equal windows of several items count for each of them. Items without an id are searched like
others and are together one item: a null in ``items``, which counts in ``n_items`` and is left out of the hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import attach, free_name, keyed, materialize, table
from cartwheel.llm.textkit import LOWER, U, chunks, mix, prefix_hash, runs, span_hash

WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SHIFT_BITS = 18
CURSOR_STRETCH = 1024


def normalise(data: np.ndarray, offs: np.ndarray):
    """Words of a chunk as ``' w1 w2 '`` per text: the bytes, each word's start in
    them, its text, and the start of each text's stretch."""
    start, end, doc = runs(WORD[data], offs)
    n_docs = len(offs) - 1
    lens = end - start
    # each word brings one space before it; each text ends with one more
    out_start = np.cumsum(lens + 1) - lens + doc
    size = int((lens + 1).sum()) + n_docs
    out = np.full(size, 32, np.uint8)
    src = np.repeat(start - out_start, lens) + (at := np.repeat(out_start - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum()))
    out[at] = LOWER[data[src]]
    return out, out_start, doc


class WuManber:
    """Shift table, buckets and patterns of one length group."""

    def __init__(self, patterns: list[bytes], ids: list[int]):
        self.patterns = [np.frombuffer(p, np.uint8) for p in patterns]
        self.ids = ids
        self.m = min(map(len, patterns))
        self.block = max(1, min(8, self.m // 2))
        self.shift = np.full(1 << SHIFT_BITS, self.m - self.block + 1, np.int32)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(self.patterns):
            h = self._hash(p[:self.m])
            np.minimum.at(self.shift, h, self.m - self.block - np.arange(len(h), dtype=np.int32))
            buckets.setdefault(int(h[-1]), []).append(k)
        # bucket lists as one flat array with an offset for each hash
        self.order = np.array([k for h in sorted(buckets) for k in buckets[h]], np.int64)
        count = np.zeros((1 << SHIFT_BITS) + 1, np.int64)
        for h, ks in buckets.items():
            count[h + 1] = len(ks)
        self.first = np.cumsum(count)
        self.lens = np.array([len(p) for p in patterns])
        self.full = np.array([int(self._full(p)) for p in self.patterns], U)

    def _blocks(self, data: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = np.zeros(len(end), U)
        for j in range(self.block):
            value = (value << U(8)) | data[end - self.block + j].astype(U)
        return (mix(value) >> U(64 - SHIFT_BITS)).astype(np.int64)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        return self._blocks(data, np.arange(self.block, len(data) + 1))

    @staticmethod
    def _full(p: np.ndarray) -> np.uint64:
        return span_hash(prefix_hash(p), np.array([0]), np.array([len(p)]))[0]

    def search(self, data: np.ndarray, prefix: np.ndarray):
        """Start positions and pattern numbers of all occurrences."""
        n = len(data)
        none = np.zeros(0, np.int64)
        if n < self.m:
            return none, none
        cursor = np.arange(self.m, n + 1, CURSOR_STRETCH)
        stop = np.minimum(cursor + CURSOR_STRETCH, n + 1)
        starts, found = [], []
        while len(cursor):
            h = self._blocks(data, cursor)
            shift = self.shift[h]
            hit = shift == 0
            if hit.any():
                begin, bucket = cursor[hit] - self.m, h[hit]
                counts = self.first[bucket + 1] - self.first[bucket]
                pos = np.repeat(begin, counts)
                k = self.order[np.repeat(self.first[bucket], counts) + np.arange(counts.sum())
                               - np.repeat(np.cumsum(counts) - counts, counts)]
                fits = pos + self.lens[k] <= n
                pos, k = pos[fits], k[fits]
                same = span_hash(prefix, pos, pos + self.lens[k]) == self.full[k]   # a cheap refusal first
                for p, j in zip(pos[same].tolist(), k[same].tolist()):
                    if np.array_equal(data[p:p + self.lens[j]], self.patterns[j]):
                        starts.append(p)
                        found.append(j)
            cursor = cursor + np.maximum(shift, 1)
            alive = cursor < stop
            cursor, stop = cursor[alive], stop[alive]
        return np.array(starts, np.int64), np.array(found, np.int64)


def build(items: list[tuple[str, str]], window: int) -> tuple[list[WuManber], list[list[str]]]:
    """Search tables, and for each distinct window the items that hold it."""
    owners: dict[bytes, list[str]] = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        body, start, _ = normalise(raw, np.array([0, len(raw)]))
        bounds = [*start.tolist(), len(body)]
        n = len(start)
        for k in range(max(n - window + 1, min(n, 1))):
            last = min(k + window, n)
            w = body[bounds[k] - 1:bounds[last]].tobytes()       # the spaces at either end included
            if item not in (o := owners.setdefault(w, [])):
                o.append(item)
    groups: dict[int, list[bytes]] = {}
    for p in sorted(owners):
        groups.setdefault(max(len(p), 4).bit_length(), []).append(p)
    tables, names, at = [], [], 0
    for _, patterns in sorted(groups.items()):
        tables.append(WuManber(patterns, list(range(at, at + len(patterns)))))
        names += [owners[p] for p in patterns]
        at += len(patterns)
    return tables, names


def _hits(items: list[tuple[str, str]], window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = build(items, window)
        for batch in batches:
            did, rk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for lo, hi, raw, offs in chunks(batch.column(2)):
                data, start, doc = normalise(raw, offs)
                prefix = prefix_hash(data)
                n_words = np.bincount(doc, minlength=hi - lo)
                delta = np.zeros(len(start) + 1, np.int64)
                found: dict[int, set[str]] = {}
                for t in tables:
                    pos, k = t.search(data, prefix)
                    if not len(pos):
                        continue
                    first = np.searchsorted(start, pos)                     # the word after the leading space
                    last = np.searchsorted(start, pos + t.lens[k] - 1)
                    np.add.at(delta, first, 1)
                    np.add.at(delta, last, -1)
                    for d, j in zip(doc[first].tolist(), k.tolist()):
                        found.setdefault(d, set()).update(names[t.ids[j]])
                word_hit = np.cumsum(delta[:-1]) > 0
                hit_words: list[list[int]] = [[] for _ in range(hi - lo)]
                begin = np.searchsorted(doc, np.arange(hi - lo))
                for d in found:
                    w = np.flatnonzero(word_hit[begin[d]:begin[d] + n_words[d]])
                    hit_words[d] = w.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(did[lo:hi]), pa.array(rk[lo:hi]), batch.column(3).slice(lo, hi - lo), pa.array(n_words.astype(np.int64)),
                     pa.array(hit_words, pa.list_(pa.int32())),
                     pa.array([sorted(found.get(d, ()), key=lambda x: (x is not None, x)) for d in range(hi - lo)], pa.list_(pa.string()))],
                    names=["did", "rk", "id", "n_words", "words", "items"])
    return rows


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_items: int = 2000, block_bytes: int = 1 << 22,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``did, rk, id, n_words, words`` (numbers of the hit words) and ``items`` of each
    row. Items are searched ``block_items`` at a time; a block's search
    tables are the only thing sent to every task."""
    rows = keyed(docs, id_col, text_col)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    items = items.where("text is not null").distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    out = None
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    for b in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        block = [tuple(r) for r in mine.collect()]
        part = rows.mapInArrow(_hits(block, window), "did long, rk long, id long, n_words long, words array<int>, items array<string>")
        out = part if out is None else out.unionByName(part)
    if blocks == 1:
        return out
    merged = out.groupBy("did", "rk", "id").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return rows.select("did", "rk").join(merged, ["did", "rk"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    hit = materialize(find_windows(docs, benchmark, window).where(F.size("words") > 0).select("did", "rk").distinct(), "contaminated")
    info = free_name(docs, "__info")
    return attach(docs, hit.withColumn("hit", F.lit(True)), "left").where(F.col(info).isNull()).drop(info)


def op7_benchmark_windows(spark, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_windows(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("words") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM p),
o AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)),
h AS (SELECT o.doc_id, o.k, o.n, p.item FROM o JOIN p ON o.s = p.s AND o.n = p.n),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
