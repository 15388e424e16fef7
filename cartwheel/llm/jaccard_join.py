"""N-gram Jaccard join over token-combination prefixes.

A document is its set of distinct word shingles. Two sets whose Jaccard
similarity is at least t share at least ``ceil(t * n)`` tokens of either, so in
any global order of tokens they share one among the first
``n - ceil(t * n) + 1`` (the prefix).

* Order: rare tokens first, so that prefixes hold tokens few others have. A
  token is at most as frequent as its rarest word, so it stands by that word's
  count (then by the sum of its words' logarithms): counts of all words of all
  documents in ``2**18`` hashed classes, a table of fixed size. Any order gives
  whole results; a good one gives few candidates.
* Index: prefix tokens found in at most ``frequent`` sets are indexed alone. Sets
  with a more frequent token in their prefix are extended to whole sets and indexed by
  combinations of tokens, about eight at t = 0.9: if the first common token of
  two similar sets is frequent, both are, and they agree in one combination at least.
* Pruning: an entry of at most ``frequent`` sets tests its sets by pairs, by their sizes, the token's places
  in their prefixes and their parities (below). It goes if no two of its sets may link; one of over ``SHORT`` sets
  is split into groups that possible links connect. What sets share by chance so costs one shuffle, not one in
  every round, and only texts of sets that are left are read again. Two similar sets pass at their first common token.
* Disk: of a whole set only parities and combinations are written, its tokens once a pair is left to verify. What is
  shuffled for tokens, combinations or pairs is shuffled in up to ``SLICES`` slices by key, one after another, of
  ``AT_ONCE`` tokens or more each, so it takes its share of disk only, however many tokens sets share by chance.
* Candidates: equal sets count once. In rounds, each index entry proposes links to
  one leader only, so an entry with m sets gives m - 1 pairs, and
  after each round entries whose sets are connected already drop out. What
  is left apart is then compared in full: sets outside an entry's largest
  component with those in other components. This comes after ``rounds`` rounds, or as
  soon as it takes at most ``FEW`` comparisons for each set of an entry on average. Similar sets share many entries;
  there the two are proposed by the first of them: each set goes with its ``LEAST`` least keys, and an entry
  leaves out two sets whose lists share a lesser key, since that one is an entry of both. Two sets whose lists share
  none may be proposed more than once.
* Parities: each set has ``PARITY_BITS`` bits, the parities of its tokens by hash; a longer set has a bit for each token,
  up to ``MOST_BITS``, since few bits are all unequal by chance where many tokens may differ. Two sets
  differ in at least as many tokens as in bits, so a candidate with more differing bits
  than its sizes allow is no link; this never drops a link. Where candidates are made, the bits are tested folded
  to ``FOLDED_BITS`` (parities of unions of places), which each index entry carries; pairs that pass are tested by all
  bits of the set that has fewer.
* Verification: exact overlap of the two sets.

Null or empty texts and texts without words have no set and link with nothing.
Tokens are 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import attach, free_name, key_names, keyed, materialize, noted, release, table, with_key
from cartwheel.llm.components import components
from cartwheel.llm.textkit import SPACE, U, chunks, mix, words

CLASS_BITS = 18
CLASSES = 1 << CLASS_BITS
PARITY_BITS = 1024
MOST_BITS = 1 << 15
FOLDED_BITS = 256
SLICES = 8
AT_ONCE = 1 << 23
FEW = 16
LEAST = 8
SHORT = 8
PAIRS_AT_ONCE = 1 << 20
FILTER_BITS = 22


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES, np.int64)
    for batch in batches:
        for _, _, data, offs in chunks(batch.column(0)):
            _, _, _, h = words(data, offs, ~SPACE)
            total += np.bincount((h >> U(64 - CLASS_BITS)).astype(np.int64), minlength=CLASSES)
    used = np.flatnonzero(total)
    yield pa.record_batch({"cls": used.astype(np.int32), "n": total[used]})


def word_classes(docs: DataFrame) -> np.ndarray:
    """A rarity score for each class of words: the logarithm of its count, in steps."""
    counts = docs.select("text").mapInArrow(_class_counts, "cls int, n long").groupBy("cls").agg(F.sum("n").alias("n"))
    out = np.zeros(CLASSES, np.int64)
    for r in materialize(counts, "word_classes").collect():  # at most CLASSES rows; written, so that the shuffle goes
        out[r["cls"]] = r["n"]
    return np.round(16 * np.log2(out + 1)).astype(np.int64)


def _shingles(data: np.ndarray, offs: np.ndarray, k: int):
    """Distinct shingles by text: text number, first word's position, hash; and each word's hash."""
    start, _, doc, h = words(data, offs, ~SPACE)
    n_docs = len(offs) - 1
    count = np.bincount(doc, minlength=n_docs)
    size = np.minimum(count, k)                              # a short text is one shingle of all its words
    first = np.cumsum(count) - count
    at = np.arange(len(h))
    mine = at[at + size[doc] <= (first + count)[doc]] if len(h) else at
    token = np.zeros(len(mine), U)
    for j in range(k):
        inside = j < size[doc[mine]]
        token = np.where(inside, mix(token * U(0x2545F4914F6CDD1D) + h[np.minimum(mine + j, len(h) - 1)] + U(j + 1)), token)
    return doc[mine], mine, token, h, size


def _parities(doc: np.ndarray, token: np.ndarray, width: np.ndarray) -> pa.ListArray:
    """For each text the parities of its tokens, dealt by hash into ``width`` words of 64 places."""
    first = np.append(0, np.cumsum(width))
    place = (mix(token ^ U(0xA0761D6478BD642F)) % (width[doc] * 64).astype(U)).astype(np.int64)
    bits = np.zeros(int(first[-1]), U)
    np.bitwise_xor.at(bits, first[doc] + place // 64, U(1) << (place % 64).astype(U))
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(bits.view(np.int64)))


def _widths(n: np.ndarray) -> np.ndarray:
    """Words of parities for sets of ``n`` tokens: powers of two, so that one width divides another."""
    bits = 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    return np.clip(bits, PARITY_BITS, MOST_BITS) // 64


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and values of a list column."""
    offs = column.offsets.to_numpy().astype(np.int64)
    return offs - offs[0], column.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]].view(U)


def _possible(a: str, b: str, n: str, m: str, percent: int, bits: int):
    """Sizes ``n, m`` and ``bits`` parities ``a, b`` leave room for a link."""
    apart = sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(bits // 64)), F.lit(0))
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return near & (apart * (100 + percent) <= (F.col(n) + F.col(m)) * (100 - percent))


def _alike(percent: int):
    """Of the pairs ``a, b, n, m``, given the parities ``ab, bb`` of their sets, those that may be links."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            lists = [_lists(batch.column(c)) for c in (4, 5)]
            width = np.minimum(*(np.diff(offs) for offs, _ in lists))
            first = np.cumsum(width) - width
            folded = np.zeros(int(width.sum()), U)
            for offs, bits in lists:
                of = np.repeat(np.arange(len(n)), np.diff(offs))
                np.bitwise_xor.at(folded, first[of] + (np.arange(len(of)) - offs[of]) % width[of], bits)
            apart = np.zeros(len(n), np.int64)
            np.add.at(apart, np.repeat(np.arange(len(n)), width), np.bitwise_count(folded))
            near = apart * (100 + percent) <= (n + m) * (100 - percent)
            yield batch.select(["a", "b", "n", "m"]).filter(pa.array(near))
    return rows


def _not_before(key: str, a: str, b: str):
    """Lists ``a, b`` of the least keys of two sets share none below ``key``."""
    return F.coalesce(F.array_min(F.array_intersect(a, b)) >= F.col(key), F.lit(True))


def _sets(k: int, percent: int, scores: np.ndarray | None):
    """Set hash, size and ordered prefix of each text; without scores the whole set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = [batch.column(c) for c in range(batch.num_columns - 1)]
            for lo, hi, data, offs in chunks(batch.column(batch.num_columns - 1)):
                doc, at, token, h, size = _shingles(data, offs, k)
                if scores is None:
                    order = np.lexsort((token, doc))
                else:
                    cls = scores[(h >> U(64 - CLASS_BITS)).astype(np.int64)]
                    low, total = np.full(len(at), 1 << 20), np.zeros(len(at), np.int64)
                    for j in range(k if len(at) else 0):
                        inside, value = j < size[doc], cls[np.minimum(at + j, len(h) - 1)]
                        low = np.where(inside, np.minimum(low, value), low)
                        total += np.where(inside, value, 0)
                    order = np.lexsort((token, low << 24 | total, doc))
                doc, token = doc[order], token[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
                doc, token = doc[new], token[new]
                n = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(n) - n
                names = list(batch.schema.names[:-1])
                arrays = [c.slice(lo, hi - lo) for c in lead]
                if scores is None:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype(np.int32)), pa.array(token.view(np.int64))))
                    yield pa.RecordBatch.from_arrays(arrays, names=[*names, "tokens"])
                    continue
                # an order-free hash of the set
                total = np.zeros(hi - lo, U)
                np.add.at(total, doc, mix(token ^ U(0xD6E8FEB86659FD93)))
                sig = mix(total + n.astype(U))
                keep = np.minimum(n, n - (n * percent + 99) // 100 + 1)
                rank = np.arange(len(doc)) - first[doc]
                mine = rank < keep[doc]
                ends = np.append(0, np.cumsum(keep)).astype(np.int32)
                arrays += [pa.array(sig.view(np.int64)), pa.array(n.astype(np.int64)),
                           pa.ListArray.from_arrays(pa.array(ends), pa.array(token[mine].view(np.int64))),
                           _parities(doc, token, np.full(hi - lo, FOLDED_BITS // 64))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sig", "n", "prefix", "folded"])
    return rows


def size_bounds(percent: int, most: int) -> list[int]:
    """Starts of the size buckets: a set's partners are in its bucket or one beside it."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, -(-100 * out[-1] // percent)))
    return [*out, max(out[-1] + 1, -(-100 * out[-1] // percent))]


def _combinations(token: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Token combinations of sets of ``n`` tokens each: set and key. In a class of sizes, similar sets differ in at most
    h tokens; with tokens dealt by hash into h + 1 combinations, one at least is equal."""
    doc = np.repeat(np.arange(len(n)), n)
    bounds = np.array(size_bounds(percent, int(n.max(initial=1))), np.int64)
    bucket = np.searchsorted(bounds, n, side="right") - 1
    sets, keys = [], []
    for above in (0, 1):
        cls = bucket + above
        parts = 2 * (bounds[cls + 1] - 1) * (100 - percent) // (100 + percent) + 1
        first = np.cumsum(parts) - parts
        part = (mix(token ^ mix(cls[doc].astype(U))) % parts[doc].astype(U)).astype(np.int64)
        total = np.zeros(int(parts.sum()), U)
        np.add.at(total, first[doc] + part, mix(token + U(0x94D049BB)))
        of = np.repeat(np.arange(len(n)), parts)
        place = (np.arange(len(of)) - first[of]).astype(U)
        sets.append(of)
        keys.append(mix(total ^ mix(cls[of].astype(U) << U(32) | place)))
    return np.concatenate(sets), np.concatenate(keys)


def _described(k: int, percent: int):
    """Of each text with its ``sig, did, rk, often``: the size and parities of its whole set, and if ``often`` its combinations."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sets(k, percent, None)(batches):
            often = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            offs, token = _lists(batch.column(4))
            n = np.diff(offs)
            doc = np.repeat(np.arange(len(n)), n)
            of, key = _combinations(token[often[doc]], n[often], percent)
            order = np.argsort(of, kind="stable")
            count = np.zeros(len(n), np.int64)
            count[often] = np.bincount(of, minlength=int(often.sum()))
            ends = np.append(0, np.cumsum(count)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n), _parities(doc, token, _widths(n)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(key[order].view(np.int64)))],
                names=["sig", "did", "rk", "n", "bits", "keys"])
    return rows


def _plausible(percent: int):
    """Splits entries, lists of ``sig, n, rest`` and folded parities, into the sets worth a comparison."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offs = lists.offsets.to_numpy().astype(np.int64)
            offs -= offs[0]
            sig, n, rest, *bits = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            bits = [b.view(U) for b in bits]                 # of signed numbers numpy counts the bits of the absolute value
            m = np.diff(offs)
            of = np.repeat(np.arange(len(m)), m)             # each set's entry
            after = offs[of + 1] - np.arange(len(of)) - 1    # sets that follow it there
            total = np.append(0, np.cumsum(after))
            label = np.arange(len(of))                       # the first set that a chain of possible links reaches
            lo = 0
            while lo < len(m):                               # some entries at a time
                hi = max(lo + 1, int(np.searchsorted(total[offs], total[offs[lo]] + PAIRS_AT_ONCE, side="right")) - 1)
                x = np.repeat(np.arange(offs[lo], offs[hi]), after[offs[lo]:offs[hi]])
                y = x + 1 + np.arange(len(x)) - (total[x] - total[offs[lo]])
                # all that the two can share from here on: this is their first common token or of no use
                near = (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent) & (
                    np.minimum(rest[x], rest[y]) * (100 + percent) >= (n[x] + n[y]) * percent)
                x, y = x[near], y[near]
                apart = sum((np.bitwise_count(b[x] ^ b[y]).astype(np.int64) for b in bits), np.zeros(len(x), np.int64))
                near = apart * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
                x, y = x[near], y[near]
                while (label[x] != label[y]).any():
                    least = np.minimum(label[x], label[y])
                    np.minimum.at(label, x, least)
                    np.minimum.at(label, y, least)
                lo = hi
            paired = np.bincount(label, minlength=len(of))[label] > 1
            short = m[of] <= SHORT
            mine = np.where(short, np.bincount(of[paired], minlength=len(m))[of] > 0, paired)
            key = batch.column(0).to_numpy(zero_copy_only=False)[of]
            key = np.where(short, key, mix(key.view(U) ^ mix(sig[label].view(U))).view(np.int64))
            yield pa.record_batch({"key": key[mine], "sig": sig[mine], "n": n[mine]})
    return rows


def _those_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` whose hash falls in a class that holds a row of ``wanted``: all of these and few others. The table of
    classes has a fixed size, so it is broadcast, and texts that no join needs are not shuffled."""
    word, bit = F.col("rk").bitwiseAND((1 << FILTER_BITS - 6) - 1), F.shiftrightunsigned("rk", 58).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    classes = wanted.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"))
    return (docs.withColumn("word", word).join(F.broadcast(classes), "word")
            .where(F.col("bits").bitwiseAND(one) != 0).drop("word", "bits"))


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted``, with ``did, rk`` of a row each, and that row's ``text``."""
    # repeated rows go where the join has put them together: no further shuffle
    return _those_of(docs.select("did", "rk", "text"), wanted).join(wanted, ["did", "rk"]).dropDuplicates(["did", "rk"])


def _slices(tokens: int | None, column: str) -> list:
    """Conditions that deal rows of ``tokens`` tokens in all into slices by a hash in ``column``."""
    parts = min(SLICES, 1 + (tokens or 0) // AT_ONCE)
    return [F.pmod(F.xxhash64(column), F.lit(parts)) == part for part in range(parts)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _entries(docs: DataFrame, uniq: DataFrame, k: int, percent: int, frequent: int) -> tuple[DataFrame, DataFrame]:
    """Index entries ``key, sig, n`` of keys that at least two sets share, and ``sig, did, rk, n, bits`` of those sets."""
    tokens = uniq.select("sig", "n", F.posexplode("prefix").alias("place", "key")).select("sig", (F.col("n") - F.col("place")).alias("rest"), "key")
    parts = [F.col("folded")[i].alias(f"part{i}") for i in range(FOLDED_BITS // 64)]
    few, often = [], []
    for mine in _slices(uniq.agg(F.sum(F.expr(f"n - ceil(n * {percent} / 100) + 1"))).first()[0], "key"):
        with noted() as folders:
            single = tokens.where(mine)
            shared = materialize(single.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "shared_tokens")
            found = materialize(single.join(shared, "key"), "entries")
            lists = (found.where(F.col("m") <= frequent).select("key", "sig", "rest").join(uniq.select("sig", "n", "folded"), "sig")
                     .groupBy("key").agg(F.collect_list(F.struct("sig", "n", "rest", *parts)).alias("sets")))
            few.append(materialize(lists.mapInArrow(_plausible(percent), "key long, sig long, n long"), "plausible"))
            often.append(materialize(found.where(F.col("m") > frequent).select("sig").distinct(), "often"))
        release(docs.sparkSession, folders, few[-1], often[-1])
    # which sets have a frequent token goes along with the texts: whole sets are not shuffled for it
    marks = _union([df.select("sig", F.lit(True).alias("often")) for df in often] + [df.select("sig", F.lit(False).alias("often")) for df in few])
    involved = materialize(uniq.select("sig", "at.did", "at.rk").join(marks.groupBy("sig").agg(F.max("often").alias("often")), "sig"), "involved")
    texts = _texts_of(docs, involved).select("sig", "did", "rk", "often", "text")
    sets = materialize(texts.mapInArrow(_described(k, percent), "sig long, did long, rk long, n long, bits array<long>, keys array<long>"), "whole_sets")
    many = sets.select("sig", "n", F.explode("keys").alias("key"))
    met = []
    for mine in _slices(sets.agg(F.sum(F.size("keys"))).first()[0], "key"):
        some = many.where(mine)
        more = some.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
        met.append(materialize(some.join(more, "key").select("key", "sig", "n"), "combinations"))
    return materialize(_union(few + met), "index"), materialize(sets.drop("keys"), "set_bits")


def _verified(docs: DataFrame, pairs: DataFrame, tokens: int, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets, of so many ``tokens``, are similar enough."""
    ends = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    used = materialize(sets.select("sig", "did", "rk").join(ends, "sig"), "paired_rows")
    used = materialize(_texts_of(docs, used).select("sig", "text").mapInArrow(_sets(k, percent, None), "sig long, tokens array<long>"), "paired_sets")
    left = used.select(F.col("sig").alias("a"), F.col("tokens").alias("ta"))
    right = used.select(F.col("sig").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    ok = 100 * both >= percent * (F.size("ta") + F.size("tb") - both)
    return _union([materialize(pairs.where(mine).select("a", "b").join(left.where(mine), "a").join(right, "b").where(ok).select("a", "b"), "links")
                   for mine in _slices(tokens, "a")])


def links(docs: DataFrame, k: int = 3, percent: int = 90, frequent: int = 64, rounds: int = 3):
    """``(rows, labels)``: each row's ``id, did, rk, sig, n``, and each linked set's
    ``node`` (its hash) and component ``label``."""
    with noted() as folders:
        return _links(docs, k, percent, frequent, rounds, folders)


def _links(docs: DataFrame, k: int, percent: int, frequent: int, rounds: int, folders: list[str]):
    """``links``; of the written tables in ``folders`` only those go on that a later step reads."""
    spark = docs.sparkSession
    scores = word_classes(docs)
    rows = materialize(docs.select("id", "did", "rk", "text").mapInArrow(
        _sets(k, percent, scores), "id long, did long, rk long, sig long, n long, prefix array<long>, folded array<long>"), "sets")
    uniq = materialize(rows.where("n > 0").groupBy("sig", "n").agg(
        F.min(F.struct("did", "rk")).alias("at"), F.first("prefix").alias("prefix"), F.first("folded").alias("folded")), "distinct_sets")
    rows = materialize(rows.drop("prefix", "folded"), "rows")
    release(spark, folders, rows, uniq)
    index, sets = _entries(docs, uniq, k, percent, frequent)
    bits = sets.select("sig", "bits")
    folded = materialize(uniq.select("sig", F.col("folded").alias("bits")).join(sets.select("sig"), "sig", "left_semi"), "folded")
    release(spark, folders, rows, index, sets, folded)
    found, labels, tried, turn = None, None, None, -1
    while turn < rounds:
        turn += 1
        if labels is None:
            at = index.withColumn("comp", F.col("sig"))
        else:
            at = index.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("label", "sig")).drop("label")
            parts = at.groupBy("key", "comp").agg(F.count("*").alias("m"))
            split = parts.groupBy("key").agg((F.sum("m") - F.max("m")).alias("beside")).where("beside > 0")
            left = materialize(at.join(split, "key").select("key", "sig", "n", "comp", "beside"), "index")
            at, index = left.drop("beside"), left.select("key", "sig", "n")
            size, in_full = left.agg(F.count("*"), F.sum("beside")).first()     # each set with all outside the largest component
            if not size:
                break
            if in_full <= FEW * size:
                turn = rounds
        if turn < rounds:
            order = F.xxhash64("sig", F.lit(turn))
            leader = at.groupBy("key").agg(F.min(F.struct(order.alias("o"), "sig", "n", "comp")).alias("l"))
            rest = leader.select("key", F.col("l.sig").alias("s"), F.col("l.n").alias("sn"), F.col("l.comp").alias("sc"))
            marks = folded
        else:
            parts = at.groupBy("key", "comp").agg(F.count("*").alias("m"))
            main = parts.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("main"))
            rest = at.join(main, "key").where("comp <> main.comp").select("key", F.col("sig").alias("s"), F.col("n").alias("sn"), F.col("comp").alias("sc"),
                                                                          F.col("main.comp").alias("main"))
            least = at.groupBy("sig").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LEAST).alias("least"))
            marks = folded.join(least, "sig")
        rest = rest.join(marks.withColumnsRenamed({"sig": "s", "bits": "sb", "least": "sleast"}), "s")
        near = at.join(marks, "sig").join(rest, "key").where("comp <> sc").where(_possible("bits", "sb", "n", "sn", percent, FOLDED_BITS))
        if turn == rounds:
            # of two sets that are both outside the largest component either meets the other
            near = near.where("comp = main or sig < s").where(_not_before("key", "least", "sleast"))
        near = near.select(F.least("sig", "s").alias("a"), F.greatest("sig", "s").alias("b"),
                           F.least("n", "sn").alias("n"), F.greatest("n", "sn").alias("m")).distinct()
        if tried is not None:
            near = near.join(tried, ["a", "b"], "left_anti")
        near = materialize(near, "near_pairs")
        pairs = materialize(near.join(bits.select(F.col("sig").alias("a"), F.col("bits").alias("ab")), "a")
                            .join(bits.select(F.col("sig").alias("b"), F.col("bits").alias("bb")), "b")
                            .select("a", "b", "n", "m", "ab", "bb").mapInArrow(_alike(percent), "a long, b long, n long, m long"), "pairs")
        tokens = pairs.agg(F.sum(F.col("n") + F.col("m"))).first()[0]
        if not tokens:
            if turn == rounds:
                break
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = _verified(docs, pairs, tokens, sets, k, percent)
        found = new if found is None else found.unionByName(new)
        labels = components(found)
        release(spark, folders, rows, index, sets, folded, found, tried, labels)
    release(spark, folders, rows, labels)
    return rows, labels


def jaccard_groups(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """``id, did, rk, n`` of each row, with ``component`` (least id reachable) and
    ``keeper``: the (did, rk) of the one row of its group that stays. ``docs`` as of ``keyed``."""
    rows, labels = links(docs, k, percent)
    uniq = rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("least"), F.min(F.struct("did", "rk")).alias("first"))
    if labels is not None:
        uniq = uniq.join(labels.withColumnRenamed("node", "sig"), "sig", "left")
    else:
        uniq = uniq.withColumn("label", F.lit(None).cast("long"))
    uniq = materialize(uniq.withColumn("label", F.coalesce("label", "sig")), "set_labels")
    groups = uniq.groupBy("label").agg(F.min("least").alias("component"), F.min("first").alias("keeper"))
    named = materialize(uniq.join(groups, "label").select("sig", "component", "keeper"), "named")
    out = rows.join(named, (rows["sig"] == named["sig"]) & (rows["n"] > 0), "left")
    return out.select("id", "did", "rk", "n", F.coalesce("component", "id").alias("component"),
                      F.coalesce("keeper", F.struct("did", "rk")).alias("keeper"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates. Rows equal in id and text,
    null ids and texts without words included, are one: of them the least by all columns stays."""
    with noted() as folders:
        marks = _marks(docs, k, percent)
    release(docs.sparkSession, folders, marks)
    info = free_name(docs, "__info")
    left = attach(docs, marks, "left").where(F.col(info).isNull()).drop(info)
    again = materialize(marks.where("not gone"), "repeated_rows")
    if again.isEmpty():
        return left
    copies = with_key(attach(docs, again, "inner").drop(info))
    row = free_name(copies, "row")
    one = copies.groupBy(*key_names(docs)).agg(F.min(F.struct(*docs.columns)).alias(row))
    return left.unionByName(one.select(f"{row}.*"))


def _marks(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``did, rk, gone`` of the rows that go and of those that stay but are repeated."""
    groups = jaccard_groups(keyed(docs), k, percent)
    # equal rows have one keeper; they are counted before the shuffle, so a row with many copies is no hot key
    marks = groups.groupBy("did", "rk").agg(F.max(F.expr("keeper.did <> did or keeper.rk <> rk")).alias("gone"), F.count("*").alias("m"))
    return materialize(marks.where("gone or m > 1").select("did", "rk", "gone"), "near_copies")


def op3_jaccard_components(spark, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    groups = jaccard_groups(keyed(table(spark, sf_dir, "documents")))
    return groups.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS u FROM d UNION SELECT r.v, e.b FROM r JOIN e ON r.u = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(u) AS component_id FROM r GROUP BY v) c USING (doc_id)
"""
