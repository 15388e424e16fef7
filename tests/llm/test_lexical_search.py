"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

from cartwheel.llm.lexical_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = {}
    for item, its in wanted.items():
        scored = []
        for d, c in held:
            n, score = sum(c.values()), 0
            for t in its & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1):
            out[item, rank] = (d, -s)
    return out


def check(spark, docs, items, k=10, **options):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, item_id long, score long").repartition(5)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    got = search(d, i, k, **options).collect()
    assert len({(r.item_id, r.rank) for r in got}) == len(got)
    assert {(r.item_id, r.rank): (r.doc_id, r.score) for r in got} == ranking(docs, items, k)
    return got


def test_against_plain_python(spark):
    rng = random.Random(3)
    words = ["a", "b", "The", "the", "Été", "été", "x1", "-", "a-b", "a_b", "日本", "c" * 300, " ", "a\x00b"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(0, 40))) for i in range(150)]
    docs += [(None, None), (None, "the the x1"), (7, "the x1"), (7, "the x1"), (9, ""), (10, "..."), (11, "b " * 100_000)]
    items = [(1, "the x1"), (2, text(12)), (2, "日本"), (None, "été a"), (4, ""), (5, None), (6, "nowhere"), (8, "a a a")]
    for options in ({}, {"block_pairs": 3}, {"k": 3}):
        check(spark, docs, items, **options)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(60, 0, -1)] + [(100, "other"), (101, "")]
    got = check(spark, docs, [(1, "words"), (2, "words here")])
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.item_id == 1] == list(range(1, 11))


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a")]) == [] and check(spark, [(1, "a b")], []) == [] and check(spark, [(1, "--")], [(1, "a")]) == []
