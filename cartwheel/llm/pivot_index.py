"""Embedding near-dedup over a pivot-permutation index.

Reference points (pivots) are chosen from a bounded sample, none close to another.
Every vector is described by its ``near`` nearest pivots in order, and stands in the
inverted lists of these. Two vectors are candidates if they share ``shared`` or more
of them; candidates are verified by cosine in double precision.

Lists are worked on in blocks of at most ``block`` vectors against each other, so a
list of any length, even one that a third of all vectors fall into, is many bounded
tasks; nothing in it is left out. A pair is counted in the list of its least shared
pivot only. A block pair returns for each vector its number of links and one
edge to the least vector it is connected to, never the pairs.

Equal vectors are one vector with a count. Null or zero vectors, and those with
null or non-finite components, link with nothing. Vectors of different lengths never link;
each length is an index of its own. Rows with a null id are counted as vectors and get their
component, but are never the kept one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize, table
from cartwheel.llm.components import components


def choose_pivots(sample: np.ndarray, most: int, apart: float) -> np.ndarray:
    """Unit vectors of the sample, in order, each with cosine below ``apart`` to all chosen before."""
    chosen = np.zeros((0, sample.shape[1]))
    for v in sample:
        if len(chosen) == most:
            break
        if not len(chosen) or (chosen @ v).max() < apart:
            chosen = np.vstack([chosen, v])
    return chosen


def _permutations(pivots: np.ndarray, near: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1)[:, None]
                order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :near]
                yield pd.DataFrame({"node": pdf["node"], "m": pdf["m"], "v": pdf["v"], "pivots": list(order.astype(np.int32))})
    return rows


def _compare(n_pivots: int, shared: int, least: float):
    def block_pair(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pivot, i, j = key
        pdf = pdf.sort_values("node", kind="stable")
        x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        on = np.zeros((len(pdf), n_pivots), np.float32)
        on[np.arange(len(pdf))[:, None], np.stack(pdf["pivots"].to_numpy())] = 1
        own, node, m = pdf["block"].to_numpy(), pdf["node"].to_numpy(), pdf["m"].to_numpy()
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        candidate = on[a] @ on[b].T >= shared
        first = on[a][:, :pivot] @ on[b][:, :pivot].T == 0          # no lesser pivot in common
        if i == j:
            candidate &= np.tri(len(a), len(b), -1, dtype=bool).T
        p, q = np.nonzero(candidate & first & (x[a] @ x[b].T >= least))
        p, q = a[p], b[q]
        links = np.bincount(p, weights=m[q], minlength=len(pdf)) + np.bincount(q, weights=m[p], minlength=len(pdf))
        label = np.arange(len(pdf))                                 # rows stand in order of node
        while True:
            low = np.minimum(label[p], label[q])
            new = label.copy()
            np.minimum.at(new, p, low)
            np.minimum.at(new, q, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        used = links > 0
        return pd.DataFrame({"node": node[used], "links": links[used].astype(np.int64), "other": node[label[used]]})
    return block_pair


def _links(uniq: DataFrame, n: int, least: float, near: int, shared: int, sample_rows: int, most_pivots: int,
           apart: float, block: int) -> DataFrame:
    """``node, links, other`` among ``n`` distinct vectors of one length."""
    sample = np.array([r["v"] for r in uniq.orderBy(F.xxhash64("node"), "node").limit(sample_rows).collect()])
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    pivots = choose_pivots(sample, min(most_pivots, max(32, int(2 * n ** 0.5))), apart)
    near, shared = min(near, len(pivots)), min(shared, len(pivots))
    placed = materialize(uniq.mapInPandas(_permutations(pivots, near), "node long, m long, v array<double>, pivots array<int>"), "permutations")
    sizes = {r["pivot"]: r["count"] for r in placed.select(F.explode("pivots").alias("pivot")).groupBy("pivot").count().collect()}
    blocks = F.array(*[F.lit(max(1, -(-sizes.get(k, 0) // block))) for k in range(len(pivots))])
    listed = placed.withColumn("pivot", F.explode("pivots")).withColumn("of", blocks[F.col("pivot")])
    listed = listed.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("of").cast("long")).cast("int"))
    # a vector meets every block of its list, its own included
    met = listed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    pairs = met.groupBy("pivot", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    return materialize(pairs.applyInPandas(_compare(len(pivots), shared, least), "node long, links long, other long"), "links")


def near_duplicates(vectors: DataFrame, least: float = 0.9, near: int = 8, shared: int = 2, sample_rows: int = 4096,
                    most_pivots: int = 1024, apart: float = 0.7, block: int = 1024,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component`` of every row. The pivots number twice the square
    root of the distinct vectors, at most ``most_pivots``, from ``sample_rows`` of them."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.coalesce((F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
                       & F.exists(v, lambda c: c != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(sound, v).alias("v"))
    rows = materialize(rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors")
    uniq = materialize(rows.where("v is not null").groupBy("node").agg(F.count("*").alias("m"), F.first("v").alias("v")), "distinct_vectors")
    lengths = {r["dim"]: r["count"] for r in uniq.groupBy(F.size("v").alias("dim")).count().collect()}
    if not lengths:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    found = None                     # vectors of each length are an index of their own
    for dim, n in sorted(lengths.items()):
        part = _links(uniq if len(lengths) == 1 else uniq.where(F.size("v") == dim), n, least, near, shared, sample_rows, most_pivots, apart, block)
        found = part if found is None else found.unionByName(part)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (uniq.select("node", "m").join(links, "node", "left").join(labels, "node", "left")
             .select("node", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("label", "node").alias("label")))
    least_id = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    named = materialize(named.join(least_id, "node"), "named")
    groups = named.groupBy("label").agg(F.min("least").alias("component"))
    named = materialize(named.join(groups, "label").select("node", "n_links", "component"), "named")
    return rows.join(named, "node", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def op4_near_vectors(spark, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    out = near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS v, vec_id AS u FROM v UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT v AS vec_id, min(u) AS component_id FROM r GROUP BY v) c USING (vec_id)
"""
