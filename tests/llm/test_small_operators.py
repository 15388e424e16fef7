"""Packing, secret rules, toxicity, vectors, languages, windows: on small inputs."""

import itertools

import duckdb
import numpy as np
import pytest

from cartwheel.llm.decontamination import OP7_SQL, find_windows, op7_benchmark_windows, remove_contaminated
from cartwheel.llm.jaccard_join import keep_one
from cartwheel.llm.language_id import _declared, identify, learn_text
from cartwheel.llm.packing import optimal_boundaries, pack
from cartwheel.llm.pivot_index import near_duplicates
from cartwheel.llm.registry import ORACLE_SQL, QUERIES
from cartwheel.llm.secret_scan import RULES, scan, trigram_query
from cartwheel.llm.toxicity import op1_toxicity, tokens
from llm_fixtures import docs_of  # noqa: F401
from oracle_compare import compare, duck

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])
    assert ok, message


def test_boundaries_are_optimal():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        lengths = np.unique(rng.integers(0, 40, 9))
        counts, most = rng.integers(1, 9, len(lengths)), int(rng.integers(1, 5))
        cost = lambda bounds: sum(c * (min(x for x in bounds if x >= n) - n) for n, c in zip(lengths, counts))
        got = optimal_boundaries(lengths, counts, most)
        best = min(cost([*x, lengths[-1]]) for k in range(most) for x in itertools.combinations(lengths[:-1], k))
        assert len(got) <= most and cost(got) == best


def least_padding(lengths, counts, buckets):
    """Plain dynamic programming over every length."""
    mass, weight = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * lengths))
    best = lengths * mass[1:] - weight[1:]
    for _ in range(1, buckets):
        before = np.append(0, best[:-1])
        best = np.array([(before[:j + 1] + lengths[j] * (mass[j + 1] - mass[:j + 1]) - weight[j + 1] + weight[:j + 1]).min() for j in range(len(lengths))])
    return int(best[-1])


def test_boundaries_of_many_lengths_are_optimal():
    for seed in range(12):
        rng = np.random.default_rng(seed)
        lengths = np.unique(rng.integers(0, [600, 10**6][seed % 2], 400 + seed))
        counts = rng.integers(1, [3, 10**5][seed % 3 // 2], len(lengths))
        for buckets in (2, 7):
            bounds = np.array(optimal_boundaries(lengths, counts, buckets))
            assert ((bounds[np.searchsorted(bounds, lengths)] - lengths) * counts).sum() == least_padding(lengths, counts, buckets)
    lengths = np.unique(np.random.default_rng(1).integers(0, 10**7, 10**5))
    assert len(optimal_boundaries(lengths, np.ones(len(lengths), np.int64), 16)) == 16


def test_packing_with_many_lengths_and_one_long_text(spark):
    sizes = [*range(1, 2101), *[5] * 300, 100_000]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, n int").selectExpr("doc_id", "repeat('w ', n) AS text")
    out = pack(docs, buckets=4).select("n_tokens", "boundary").toPandas()
    lengths, counts = np.unique(sizes, return_counts=True)
    assert sorted(out.n_tokens) == sorted(sizes) and set(out.boundary) <= set(sizes)
    assert (out.boundary - out.n_tokens).sum() == least_padding(lengths, counts, 4)


def test_packing_keeps_every_row_within_the_budget(docs_of):
    rows = [(i, "w " * (i % 40)) for i in range(200)] + [(None, None), (1, "w " * 500), (1, "w " * 500)]
    out = pack(docs_of(rows), buckets=4, budget=100).toPandas()
    assert len(out) == len(rows) and not out.duplicated(["batch", "slot"]).any()
    per = out.groupby("batch").agg(n=("slot", "size"), bound=("boundary", "max"))
    assert ((per.n * per.bound <= 100) | (per.n == 1)).all() and (out.n_tokens <= out.boundary).all()
    assert pack(docs_of([])).count() == 0


def test_trigram_queries():
    by = {r.kind: [set(a) for a in trigram_query(r.pattern)] for r in RULES}
    assert by["access"] == [{"aki", "kia"}] and by["hex"] == [] and {"tok", "oke", "ken"} in by["assign"]


def test_secret_spans(docs_of):
    rows = [(1, "é Token = 'abcdefghijkl' x"), (2, "password:short token=secret:abcdefghijklmnop"), (3, "AKIA" + "B" * 13 + " AKIA" + "C" * 14),
            (4, "0123456789abcdef" * 2), (5, None), (6, "")]
    got = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in scan(docs_of(rows)).collect()}
    assert got == {1: [("assign", 2, 23)], 2: [], 3: [("access", 18, 36)], 4: [("hex", 0, 32)], 5: [], 6: []}


def test_windows_and_odd_benchmark_rows(spark, docs_of):
    bench = spark.createDataFrame([(1, "One two, three"), (2, "a b c d e f g h i j k"), (3, None), (4, "--"), (None, "x")], "item_id long, text string")
    rows = [(1, "zero ONE two three four"), (2, "a b c d e f g h i j k l"), (3, None), (4, ""), (5, "a b c d e f g h i"), (None, "one two three")]
    for block in (2000, 1):
        found = find_windows(docs_of(rows), bench, block_items=block).collect()
        got = {r.id: (r.n_words, len(r["words"]), sorted(r["items"])) for r in found}
        assert got == {1: (5, 3, ["1"]), 2: (12, 11, ["2"]), 3: (0, 0, []), 4: (0, 0, []), 5: (9, 0, []), None: (3, 3, ["1"])}


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (None, [0.0, 3.0])]
    got = {r.id: (r.n_links, r.component) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (1, 3), 4: (2, 1), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8), 9: (0, 9), None: (1, 3)}


def test_toxicity_scores_every_document(spark):
    out = op1_toxicity(spark, SF_SMALL).toPandas()
    assert len(out) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()
    assert tokens("You 1d10t, i.d.i.o.t!") == ["you", "idiot", "idiot"]


def test_languages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    known = docs.where("length(text) > 300").limit(40).collect()
    pages = [(r.doc_id, f"http://h.example.org/{r.doc_id}", f"<html><body><p>{r.text}</p></body></html>") for r in known]
    out = {r.page_id: r.lang for r in identify(spark.createDataFrame([*pages, (-1, None, None)], "page_id long, url string, html string"), docs).collect()}
    assert len(out) == len(pages) + 1 and sum(out[r.doc_id] == r.lang for r in known) >= 0.9 * len(known)


def test_declared_language_after_long_leading_markup(spark):
    lead = "<!-- licence -->\n" * 1000
    assert _declared(f"{lead}<HTML class='x'\n LANG = 'De-AT'>") == "de" and _declared("<html><p lang=fr><html lang=en>") == "en"
    assert _declared("") == _declared("<htmlx lang=en>") == _declared("<html " * 50_000) == ""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pages = [(i, f"http://h{i}.example.org/", f"{lead * (i % 2)}<html lang=de><p>x</p></html>") for i in range(4)]
    out = identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()
    assert [r.declared for r in out] == ["de"] * 4


def test_every_label_is_a_language(spark):
    rng = np.random.default_rng(2)
    said = {f"l{i:02}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for i in range(70)}
    text = lambda lang, n: " ".join(rng.choice(said[lang], n))
    docs = [(None if i % 2 else i, lang, text(lang, 60)) for i, lang in enumerate([*said, *list(said)[:66]])]
    docs += [(1000, "l00", docs[0][2])] * 20                     # more rows than the sample, all equal
    pages = [(i, f"http://h{i}.example.org/", f"<html><p>{text(lang, 60)}</p></html>") for i, lang in enumerate(said)]
    docs = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    pages = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    for per_language in (500, 1):
        languages, model = learn_text(docs, per_language)
        assert languages == sorted(said) and (np.diff(model.first) > 0).all()
    got = {r.page_id: (r.lang, r.text_lang) for r in identify(pages, docs).collect()}
    assert got == {i: (lang, lang) for i, lang in enumerate(said)}


def test_benchmark_rows_without_id_are_searched(spark, docs_of, tmp_path):
    sf = str(tmp_path)
    bench = spark.createDataFrame([(None, "one two"), (None, "six"), ("b", "two three"), ("a", "two three"), (None, None)], "item_id string, text string")
    docs = docs_of([(1, "zero one two"), (2, "one two three"), (3, "five"), (4, "six one two"), (5, None)])
    docs.coalesce(1).write.parquet(f"{sf}/documents.parquet")
    bench.coalesce(1).write.parquet(f"{sf}/benchmark.parquet")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in op7_benchmark_windows(spark, sf).collect()}
    assert got == {1: (2, 1, True), 2: (3, 3, True), 3: (0, 0, False), 4: (3, 1, True), 5: (0, 0, False)}
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet/*.parquet')")
    ok, message = compare(op7_benchmark_windows(spark, sf), con, OP7_SQL)
    assert ok, message
    split = {r.id: set(r["items"]) for r in find_windows(docs, bench, block_items=1).collect()}
    assert split == {1: {None}, 2: {None, "a", "b"}, 3: set(), 4: {None}, 5: set()}
    assert sorted(r.doc_id for r in remove_contaminated(docs, bench).collect()) == [3, 5]


def test_vectors_of_every_length_link(spark):
    rows = [(i, [1.0, 0.1 * i, 0.0]) for i in range(5)] + [(10, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [1.0, 0.01]), (13, [0.0, 1.0]), (14, [5.0])]
    out = {r.id: (r.n_links, r.component) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i, v in rows:
        near = [j for j, w in rows if j != i and len(v) == len(w)
                and np.dot(v, w) >= 0.9 * np.linalg.norm(v) * np.linalg.norm(w)]
        assert out[i][0] == len(near)
    assert {out[i][1] for i in (10, 11, 12)} == {10} and out[13] == (0, 13) and out[14] == (0, 14)


def test_batches_fill_the_budget(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "'a b c' text", "1 slot", "id Batch").coalesce(1)
    out = pack(docs)
    assert out.columns == ["doc_id", "text", "n_tokens", "bucket", "boundary", "batch", "slot"]
    rows = out.toPandas()
    assert rows.batch.nunique() == 1 and sorted(rows.slot) == list(range(20_000))
    several = pack(docs.repartition(3), budget=3000).toPandas().groupby("batch").size()
    assert (several == 1000).sum() >= len(several) - 3           # one open batch a split


def test_columns_with_inner_names_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", 5, 6, 7, "row"), (2, "x", 8, 9, 10, "r")],
                                 "doc_id long, text string, __info int, __rk int, __did int, row string")
    items = spark.createDataFrame([("i", "a b c d e f g h i j")], "item_id string, text string")
    assert remove_contaminated(docs, items).collect() == docs.where("doc_id = 2").collect()
    assert scan(docs).drop("spans").orderBy("doc_id").collect() == docs.orderBy("doc_id").collect()
    both = docs.unionByName(docs)
    assert sorted(keep_one(both).collect()) == sorted(docs.collect()) and keep_one(both).columns == docs.columns


def test_whole_language_codes():
    assert [_declared(f"<html lang={x}>") for x in ("fil", "'haw-US'", '"en-GB"', "")] == ["fil", "haw", "en", ""]
