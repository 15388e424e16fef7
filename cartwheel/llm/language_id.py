"""Language identification by Bayesian evidence fusion.

For each page the posterior of a language is the product of

* the likelihood of its visible text: hashed byte trigrams, learnt from a sample of the
  ``documents`` table, with the evidence of a long text saturating, since its trigrams are not
  independent. Every label that occurs beside a text is a language, however rare: of each the rows
  with the least hashes of id and text, about ``per_language`` of them (all if there are no more;
  rows equal in both go together);
* the likelihood of the language that its markup declares (anywhere in the html), and of the suffix of its
  address: tables over all pages, each page weighted by its text posterior;
* the prior of its host: counts of the host's other pages, smoothed towards its site
  (the last two labels), smoothed towards the site's other hosts and all pages. The page itself is
  taken out of its own prior.

Counts and tables are grouped sums over all pages; hosts and sites are joined
back by key. Null or empty html says nothing and leaves the other evidence; a null
address has the host and suffix ''. Without any labelled document there is no
language: ``lang`` is null, confidence 0.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table
from cartwheel.llm.textkit import LOWER, U, chunks, mix

CLASSES = 1 << 14
CELLS = 1 << 22                   # pages times languages scored at once
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_ROOT = re.compile(r"<html\b[^>]*", re.I)
_DECLARED = re.compile(r"\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", re.I)


def _declared(html: str) -> str:
    """The first part of the language tag (``fil``, not ``fi``) of the first html tag that names one, wherever it is; '' without one."""
    for tag in _ROOT.finditer(html):
        if found := _DECLARED.search(html, tag.start(), tag.end()):
            return found.group(1).lower()
    return ""


def _trigrams(data: np.ndarray, offs: np.ndarray):
    """Text number and class of each byte trigram; digits and ASCII signs read as one space."""
    body = LOWER[data].astype(U)
    body[(body < 97) | ((body > 122) & (body < 128))] = U(32)
    if len(body) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = body[:-2] << U(16) | body[1:-1] << U(8) | body[2:]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    keep = (doc[:-2] == doc[2:]) & (code != U(0x202020))
    return doc[:-2][keep], (mix(code[keep]) >> U(50)).astype(np.int64)


def _class_counts(languages: list[str]):
    number = {lang: i for i, lang in enumerate(languages)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi, data, offs in chunks(batch.column(0)):
                doc, cls = _trigrams(data, offs)
                at, n = np.unique(lang[lo:hi][doc] * CLASSES + cls, return_counts=True)
                yield pa.record_batch({"lang": (at // CLASSES).astype(np.int32), "cls": (at % CLASSES).astype(np.int32), "n": n.astype(np.int64)})
    return rows


class TextModel(NamedTuple):
    """Log-likelihood of the trigram classes in each language: that of the classes seen in it
    (language i has ``first[i]`` to ``first[i + 1]``), and one for all others."""
    first: np.ndarray
    cls: np.ndarray
    seen: np.ndarray
    other: np.ndarray

    def of(self, i: int) -> np.ndarray:
        out = np.full(CLASSES, self.other[i])
        mine = slice(self.first[i], self.first[i + 1])
        out[self.cls[mine]] = self.seen[mine]
        return out


def learn_text(documents: DataFrame, per_language: int = 500) -> tuple[list[str], TextModel | None]:
    """All languages, and the model of their text."""
    order = F.xxhash64("doc_id", F.lit("language"), "text")
    labelled = documents.where("lang is not null and text is not null").select("lang", "text", order.alias("o"))
    # the share of all hashes that holds about per_language rows, and at least the row of the least hash
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.count("*"))
    quantile = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((F.lit(-(2.0 ** 63)) + share * 2.0 ** 64).cast("long"))
    limits = materialize(labelled.groupBy("lang").agg(F.greatest(quantile, F.min("o")).alias("most")), "language_limits")
    languages = sorted(r["lang"] for r in limits.select("lang").collect())
    if not languages:
        return [], None
    texts = labelled.join(F.broadcast(limits), "lang").where("o <= most").select("text", "lang")        # one row a language
    counts = texts.mapInArrow(_class_counts(languages), "lang int, cls int, n long").groupBy("lang", "cls").agg(F.sum("n").alias("n")).toArrow()
    lang, cls, n = (counts.column(c).to_numpy() for c in ("lang", "cls", "n"))       # no row for a class not seen in a language
    by = np.lexsort((cls, lang))
    lang, cls, n = lang[by], cls[by], n[by]
    total = np.bincount(lang, weights=n, minlength=len(languages)) + 0.5 * CLASSES
    first = np.searchsorted(lang, np.arange(len(languages) + 1))
    return languages, TextModel(first, cls, np.log((n + 0.5) / total[lang]), np.log(0.5 / total))


def _normal(logs: np.ndarray) -> np.ndarray:
    """Probabilities from logarithms, by row."""
    weights = np.exp(logs - logs.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True)


def _smoothed(counts: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
    """Shares of counts by row, with ``strength`` counts dealt as in ``prior``."""
    counts = np.maximum(counts, 0.0)
    return (counts + strength * prior) / (counts.sum(axis=1, keepdims=True) + strength)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def _by_row(size: int, arrays: int, out: Callable[..., list], names: list[str]):
    """The last ``arrays`` columns go to ``out`` as matrices of ``size`` columns; its columns stand beside the others."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, max(1, CELLS // size)):
                batch = whole.slice(at, max(1, CELLS // size))
                other = batch.num_columns - arrays
                found = out(*[c.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) for c in batch.columns[other:]])
                yield pa.RecordBatch.from_arrays([*batch.columns[:other], *found], names=names)
    return rows


def _evidence(model: TextModel, saturation: float):
    size = len(model.other)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, max(1, CELLS // size)):
                batch = whole.slice(at, max(1, CELLS // size))
                html = [h or "" for h in batch.column(2).to_pylist()]
                declared = [_declared(h) for h in html]
                visible = pa.array([_HIDDEN.sub(" ", h) for h in html], pa.large_string())
                for lo, hi, data, offs in chunks(visible):
                    doc, cls = _trigrams(data, offs)
                    n = np.bincount(doc, minlength=hi - lo)
                    score = np.empty((hi - lo, size))
                    for i in range(size):
                        score[:, i] = np.bincount(doc, weights=model.of(i)[cls], minlength=hi - lo)
                    score *= (saturation / (saturation + n))[:, None]
                    score -= score.max(axis=1, keepdims=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(declared[lo:hi], pa.string()),
                         _lists(score), _lists(_normal(score))], names=["page_id", "url", "declared", "text", "q"])
    return rows


def _sums(df: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    totals = df.groupBy(*keys).agg(*[F.sum(F.col("q")[k]).alias(f"s{k}") for k in range(size)])
    return totals.select(*keys, F.array(*[f"s{k}" for k in range(size)]).alias(name))


def identify(pages: DataFrame, documents: DataFrame, saturation: float = 60.0, strength: float = 4.0) -> DataFrame:
    """``page_id, lang, confidence``, and the single pieces of evidence ``text_lang, declared, suffix, host``."""
    languages, model = learn_text(documents)
    size = len(languages)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    if not size:
        none = F.lit(None).cast("string")
        return slim.select("page_id", none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), none.alias("declared"),
                           F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))
    seen = slim.mapInArrow(_evidence(model, saturation), "page_id long, url string, declared string, text array<double>, q array<double>")
    seen = materialize(seen.select("page_id", "declared", host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"),
                                   F.substring_index(host, ".", -2).alias("site"), "text", "q"), "evidence")
    everyone = _sums(seen, [], size, "all")

    def given(column: str) -> DataFrame:
        """log P(value | language), smoothed by the value's share of all pages."""
        def logs(n: np.ndarray, of: np.ndarray) -> list:
            share = n.sum(axis=1, keepdims=True) / of.sum(axis=1, keepdims=True)
            return [_lists(np.log((n + strength * share) / (of + strength)))]
        return _sums(seen, [column], size, "n").crossJoin(F.broadcast(everyone)).select(column, "n", "all").mapInArrow(        # one row
            _by_row(size, 2, logs, [column, f"log_{column}"]), f"{column} string, log_{column} array<double>")

    sites = _sums(seen, ["site"], size, "n_site")
    hosts = _sums(seen, ["host", "site"], size, "n_host")

    def near_prior(host: np.ndarray, site: np.ndarray, of: np.ndarray) -> list:
        whole = _smoothed(of - site, np.full((1, size), 1.0 / size), strength)
        return [_lists(host), _lists(_smoothed(site - host, whole, strength))]

    def posterior(text: np.ndarray, q: np.ndarray, host: np.ndarray, near: np.ndarray, by_declared: np.ndarray, by_suffix: np.ndarray) -> list:
        p = _normal(text + np.log(_smoothed(host - q, near, strength)) + by_declared + by_suffix)
        names = pa.array(languages, pa.string())
        return [names.take(pa.array(p.argmax(axis=1))), pa.array(p.max(axis=1)), names.take(pa.array(q.argmax(axis=1)))]

    # sums of a host, and what the rest of its site and all others say: one row for each host; then to the pages
    near = materialize(hosts.join(sites, "site").crossJoin(F.broadcast(everyone)).select("host", "n_host", "n_site", "all").mapInArrow(
        _by_row(size, 3, near_prior, ["host", "n_host", "near"]), "host string, n_host array<double>, near array<double>"), "host_counts")
    joined = seen.join(near, "host").join(given("declared"), "declared").join(given("suffix"), "suffix")
    out = joined.select("page_id", "declared", "suffix", "host", "text", "q", "n_host", "near", "log_declared", "log_suffix").mapInArrow(
        _by_row(size, 6, posterior, ["page_id", "declared", "suffix", "host", "lang", "p", "text_lang"]),
        "page_id long, declared string, suffix string, host string, lang string, p double, text_lang string")
    return out.select("page_id", "lang", F.round("p", 6).alias("confidence"), "text_lang",
                      F.when(F.col("declared") != "", F.col("declared")).alias("declared"), "suffix", "host")


def op2_page_languages(spark, sf_dir: str) -> DataFrame:
    """The language of every page."""
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
