"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Training uses a bounded sample of labelled rows (``sample_rows``, the least hashes
of the id), dealt by another hash into three parts: one teaches the lexicon, one
the trees, one the calibration, so no part is judged by what it taught.

* Lexicon: whole words and word beginnings of four and five letters, that are much more frequent
  in toxic documents, by document counts with smoothing.
* Features of a whole text: densities and weights of lexicon words, how many stand
  within five words of a second-person pronoun, capitals, punctuation, exclamation
  marks, obfuscation (digits or signs between letters), letters repeated three
  times, words and their length. Before words are compared, digits and signs that
  stand for letters are read as those letters.
* Score: the calibrated probability, with one thousandth of the raw
  probability added so that documents in one step of the calibration keep their order.

Null and empty texts get features of an empty text and a score like any other.
Null ids are never labelled. A document with several labels counts as toxic if one
says so. With fewer than ``least`` examples of either class, every score is the share
of toxic examples.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table
from cartwheel.llm.textkit import chunks

# Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes "
                          "vous votre vos tú ti tus usted ustedes vosotros".split())
# Digits and signs that stand for letters.
LOOKALIKE = str.maketrans("013457@$", "oieastas")
_EDGE = re.compile(r"(?<!\w)[^\w\s]+|[^\w\s]+(?!\w)")
_SIGNS = re.compile(r"[^\w\s]+")
NEAR = 5
BEGINNINGS = (4, 5)
NAMES = ("hits", "hit_share", "weight", "weight_share", "most", "near_you", "near_share", "you_share",
         "capitals", "signs", "exclaimed", "obfuscated", "repeated", "log_words", "word_length")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 0xF5), *range(0x80, 0xC0)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_INNER = _SIGN.copy()
_INNER[0x30:0x3A] = True


def tokens(text: str) -> list[str]:
    """Lower-cased words, freed of signs and of stand-ins for letters."""
    plain = _EDGE.sub("", text.lower()).translate(LOOKALIKE)
    return _SIGNS.sub("", plain).split()


def terms(text: str) -> set[str]:
    """The words of a text and their beginnings."""
    words = set(tokens(text))
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[toxic].update(terms(text or ""))
    rows = [(t, seen[1][t], seen[0][t]) for t in seen[1]]      # a term never seen in a toxic text cannot enter
    rows += [(t, 0, n) for t, n in seen[0].items() if t not in seen[1]]
    for lo in range(0, len(rows), 20000):
        part = rows[lo:lo + 20000]
        yield pa.record_batch({"term": pa.array([r[0] for r in part], pa.string()), "toxic": pa.array([r[1] for r in part], pa.int64()),
                               "clean": pa.array([r[2] for r in part], pa.int64())})


def _features(lexicon: dict[str, float], carried: list[str]):
    heads = {t[:4] for t in lexicon}

    def lexical(text: str) -> list[float]:
        words = tokens(text)
        n = max(len(words), 1)
        at, weight, most = [], 0.0, 0.0
        for i, w in enumerate(words):
            if w[:4] in heads:
                value = max(lexicon.get(w, 0.0), *[lexicon.get(w[:k] + "*", 0.0) if len(w) > k else 0.0 for k in BEGINNINGS])
                if value:
                    at.append(i)
                    weight += value
                    most = max(most, value)
        you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        spots = set(you)
        near = sum(any(j in spots for j in range(i - NEAR, i + NEAR + 1)) for i in at)
        return [math.log1p(len(at)), len(at) / n, math.log1p(weight), weight / n, most, math.log1p(near), near / n, len(you) / n,
                math.log1p(len(words)), sum(map(len, words)) / n]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text_at = batch.schema.get_field_index("__text")
            for lo, hi, data, offs in chunks(batch.column(text_at)):
                length = np.maximum(np.diff(offs), 1)
                total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])
                letter = _LETTER[data]
                inner, same = np.zeros(len(data), bool), np.zeros(len(data), bool)
                if len(data) > 2:
                    inner[1:-1] = _INNER[data[1:-1]] & letter[:-2] & letter[2:]
                    same[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
                letters = np.maximum(total(letter), 1)
                shape = np.stack([total(_UPPER[data]) / letters, total(_SIGN[data]) / length, total(data == 0x21) / length,
                                  total(inner) / letters, total(same) / letters], axis=1)
                words = np.array([lexical(t or "") for t in batch.column(text_at).slice(lo, hi - lo).to_pylist()]).reshape(-1, 10)
                out = np.concatenate([words[:, :8], shape, words[:, 8:]], axis=1)
                arrays = [batch.column(c).slice(lo, hi - lo) for c in carried]
                arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, len(NAMES), dtype=np.int32)), pa.array(out.ravel())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, "__features"])
    return rows


@dataclass
class Model:
    """A trained scorer: the lexicon, and the trees and calibration (or a constant)."""
    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    constant: float = 0.0

    def features(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All columns of ``docs`` in the struct ``__row``, and ``__features``. Narrow: nothing is shuffled."""
        slim = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).alias("__text"))
        row = slim.schema["__row"].dataType.simpleString()
        return slim.mapInArrow(_features(self.lexicon, ["__row"]), f"__row {row}, __features array<double>")

    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with a column ``__score``."""
        if self.trees is None:
            return features.withColumn("__score", F.lit(self.constant))
        raw = _raw(self.trees, features)
        out = self.calibration.transform(raw)
        mixed = 0.999 * F.col("__calibrated") + 0.001 * F.col("__raw")
        return out.withColumn("__score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), mixed))).drop("__calibrated", "__raw")


def _raw(trees, features: DataFrame) -> DataFrame:
    out = trees.transform(features.withColumn("__vector", array_to_vector("__features")))
    return out.withColumn("__raw", vector_to_array("probability")[1]).drop("__vector", "rawPrediction", "probability", "__prediction")


def held_out(doc_id: Column) -> Column:
    """The rows that teach nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20000, lexicon_size: int = 2000, ratio: float = 6.0,
          trees: int = 30, depth: int = 4, least: int = 3) -> Model:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = F.xxhash64("doc_id", F.lit("sample"))
    sample = known.orderBy(order, "doc_id").limit(sample_rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    sample = materialize(sample.withColumn("part", F.when(part < 4, 0).when(part < 8, 1).otherwise(2)), "label_sample")
    count = {(r["part"], r["toxic"]): r["count"] for r in sample.groupBy("part", "toxic").count().collect()}
    toxic, clean = (sum(count.get((p, t), 0) for p in range(3)) for t in (1, 0))
    if min(count.get((p, t), 0) for p in range(3) for t in (0, 1)) < least:
        return Model({}, constant=toxic / max(toxic + clean, 1))
    # at most sample_rows rows of two numbers: small by its parameter
    taught = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    n_toxic, n_clean = count[0, 1], count[0, 0]
    rate = ((F.col("toxic") + 0.1) / (n_toxic + 0.2)) / ((F.col("clean") + 0.5) / (n_clean + 1.0))
    words = (taught.where("part = 0").select("text", "toxic").mapInArrow(_term_counts, "term string, toxic long, clean long")
             .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where(F.col("toxic") >= 2 + n_toxic // 400).withColumn("rate", rate).where(F.col("rate") >= ratio)
             .orderBy(F.desc("rate"), F.desc("toxic"), "term").limit(lexicon_size).collect())
    model = Model({r["term"]: math.log(r["rate"]) for r in words})
    featured = materialize(model.features(taught.where("part > 0")).select("__row.doc_id", "__row.part", F.col("__row.toxic").alias("toxic"), "__features"), "training_rows")
    # one partition in a fixed order: the sums of the fit, and so the model, are the same every time
    fixed = featured.repartition(1).sortWithinPartitions("doc_id", "__features")
    rows = fixed.where("part = 1").withColumn("label", F.col("toxic").cast("double")).withColumn("__vector", array_to_vector("__features")).cache()
    fit = GBTClassifier(featuresCol="__vector", labelCol="label", predictionCol="__prediction", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=7)
    model.trees = fit.fit(rows)
    rows.unpersist()
    graded = _raw(model.trees, fixed.where("part = 2")).withColumn("label", F.col("toxic").cast("double"))
    model.calibration = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__calibrated").fit(graded)
    return model


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    model = train(docs, labels)
    return model.score(model.features(docs)).where(F.col("__score") < threshold).select("__row.*")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """A score for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = model.score(model.features(docs))
    return out.select("__row.doc_id", held_out(F.col("__row.doc_id")).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= 0.7).cast("int").alias("predicted"))
