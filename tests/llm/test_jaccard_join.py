import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql.classic.dataframe import DataFrame

from llm_fixtures import docs_of, keyed_of  # noqa: F401
import cartwheel.llm.jaccard_join as J


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(len(w) - k, 0) + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for x, (d, _) in enumerate(rows):
        if d is not None:
            least[find(x)] = min(d, least.get(find(x), d))
    return sorted([(d, len(sets[x]), least.get(find(x))) for x, (d, _) in enumerate(rows)], key=repr)


def test_against_brute_force(keyed_of, monkeypatch):
    monkeypatch.setattr(J.links, "__defaults__", (5, 80, 4, 3))        # tokens of five sets count as frequent
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"), (7, "a b c"), (7, "a b c d")]
    for size, copies in ((40, 1), (80, 3), (40, 8), (80, 60), (150, 30)):
        base = [rnd.choice(words) for _ in range(size)]
        for _ in range(copies):
            b = list(base)
            for _ in range(rnd.randrange(5)):
                b[rnd.randrange(size)] = rnd.choice(words)
            rows.append((10 + len(rows), " ".join(b)))
    got = sorted([tuple(r) for r in J.jaccard_groups(keyed_of(rows), 5, 80).select("id", "n", "component").collect()], key=repr)
    assert got == brute(rows, 5, 80)


def test_size_bounds_reach_every_partner():
    for percent in (50, 80, 90):
        b = J.size_bounds(percent, 1000)
        for small in range(1, 500):
            i = max(k for k, x in enumerate(b) if x <= small)
            assert 100 * small // percent < b[i + 2]


def test_few_sets_apart_are_compared_in_full_at_once(keyed_of, monkeypatch):
    """Rounds by leaders go on only while entries are long: the full round takes whatever a token still joins."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for group in range(12):
        shared = [f"g{group}_{i}" for i in range(12)]           # rare words, which a group's texts share
        for _ in range(4):
            text = shared + [rnd.choice(words) for _ in range(40)]
            rows.append((len(rows), " ".join(text)))
            rows.append((len(rows), " ".join(text[:-1] + ["other"])))
    written, write = [], J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, name: written.append(name) or write(df, name))

    def found():
        written.clear()
        return sorted([tuple(r) for r in J.jaccard_groups(keyed_of(rows), 3, 70).select("id", "n", "component").collect()], key=repr)
    assert found() == brute(rows, 3, 70)
    assert written.count("near_pairs") == 2
    monkeypatch.setattr(J, "FEW", 0)
    assert found() == brute(rows, 3, 70)
    assert written.count("near_pairs") == 4


def _mixed(rnd):
    """Groups of texts that share rare words by chance, each text with a near copy or two, of many sizes."""
    words, rows = [f"w{i}" for i in range(40)], []
    for group, size in enumerate((14, 14, 60, 60, 300)):
        shared = [f"g{group}_{i}" for i in range(8)]
        for _ in range(12):
            text = shared + [rnd.choice(words) for _ in range(size)]
            for c in range(rnd.randrange(1, 4)):
                copy = list(text)
                for _ in range(c):
                    copy[rnd.randrange(size)] = rnd.choice(words)
                rows.append((len(rows), " ".join(copy)))
    return rows


def test_entries_are_split_without_loss(keyed_of, monkeypatch):
    rows = _mixed(random.Random(23))
    want = {(k, p): brute(rows, k, p) for k, p in ((3, 90), (5, 80), (3, 60))}
    for short, at_once in ((8, 1 << 20), (0, 5)):
        monkeypatch.setattr(J, "SHORT", short)
        monkeypatch.setattr(J, "PAIRS_AT_ONCE", at_once)
        for (k, p), rest in want.items():
            got = J.jaccard_groups(keyed_of(rows), k, p).select("id", "n", "component").collect()
            assert sorted([tuple(r) for r in got], key=repr) == rest, (short, k, p)


def test_sets_that_share_tokens_by_chance_leave_the_index(keyed_of, monkeypatch):
    """Texts with a rare passage in common, none similar to another, but for one pair."""
    rnd = random.Random(3)
    rows = [(i, " ".join([f"g{i % 8}_{j}" for j in range(6)] + [f"w{rnd.randrange(40)}" for _ in range(90)])) for i in range(40)]
    rows.append((40, rows[0][1] + " more"))
    counts, write = {}, J.materialize

    def counted(df, name):
        out = write(df, name)
        counts.setdefault(name, out.count())
        return out
    monkeypatch.setattr(J, "materialize", counted)
    got = J.jaccard_groups(keyed_of(rows), 3, 90).select("id", "n", "component").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, 3, 90)
    # the pair's entries are short and stay whole, with the four other texts of its passage
    assert counts["entries"] > 41 and counts["whole_sets"] == 6


def test_two_sets_that_share_many_entries_are_proposed_by_one(keyed_of, monkeypatch):
    """Copies of one long text, too far apart for a link: every two share some dozens of entries."""
    rnd = random.Random(29)
    base, rows = [f"w{rnd.randrange(10 ** 6)}" for _ in range(600)], []
    for c in range(12):
        copy = list(base)
        for e, at in enumerate(rnd.sample(range(0, 600, 3), 6)):
            copy[at] = f"c{c}_{e}"
        rows.append((len(rows), " ".join(copy)))
    rows.append((len(rows), rows[0][1] + " more"))
    proposed, distinct = [], DataFrame.distinct

    def counted(df):
        out = distinct(df)
        if df.columns == ["a", "b", "n", "m"]:
            proposed.append((df.count(), out.count()))
        return out
    monkeypatch.setattr(DataFrame, "distinct", counted)
    got = J.jaccard_groups(keyed_of(rows), 3, 90).select("id", "n", "component").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, 3, 90)
    made, once = proposed[-1]
    assert len(proposed) > 1 and once >= 50 and made <= 2 * once, proposed


def test_no_link_is_lost_whatever_the_lists_of_least_keys_hold(keyed_of, monkeypatch):
    rows = _mixed(random.Random(31))
    want = {(k, p): brute(rows, k, p) for k, p in ((3, 90), (3, 60))}
    for least, rounds in ((1, 0), (8, 1)):                          # no round by leaders, or one
        monkeypatch.setattr(J, "LEAST", least)
        for (k, p), rest in want.items():
            monkeypatch.setattr(J.links, "__defaults__", (k, p, 4, rounds))
            got = J.jaccard_groups(keyed_of(rows), k, p).select("id", "n", "component").collect()
            assert sorted([tuple(r) for r in got], key=repr) == rest, (least, rounds, k, p)


def test_long_texts_with_a_passage_in_common_are_not_read_in_full(keyed_of, monkeypatch):
    """Texts of more tokens than the least parities can tell apart: only the tokens of the one similar pair are written."""
    rnd = random.Random(41)
    passage = [f"g{j}" for j in range(12)]
    rows = [(i, " ".join(passage + [f"w{rnd.randrange(300)}" for _ in range(4000)])) for i in range(6)]
    rows.append((6, rows[0][1] + " more"))
    read, columns, write = [], {}, J.materialize

    def counted(df, name):
        out = write(df, name)
        columns[name] = set(out.columns)
        if name == "paired_sets":
            read.append(out.count())
        return out
    monkeypatch.setattr(J, "materialize", counted)
    got = J.jaccard_groups(keyed_of(rows), 5, 80).select("id", "n", "component").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(rows, 5, 80)
    assert read == [2]
    assert [name for name, names in columns.items() if "tokens" in names] == ["paired_sets"]
    assert not {"prefix", "folded"} & columns["rows"]


def test_slices_lose_nothing(keyed_of, monkeypatch):
    rows = _mixed(random.Random(37))
    written, write = [], J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, name: written.append(name) or write(df, name))
    monkeypatch.setattr(J, "AT_ONCE", 50)
    monkeypatch.setattr(J, "SLICES", 3)
    for frequent in (4, 64):                                        # with combinations of whole sets and without
        monkeypatch.setattr(J.links, "__defaults__", (3, 80, frequent, 3))
        written.clear()
        got = J.jaccard_groups(keyed_of(rows), 3, 80).select("id", "n", "component").collect()
        assert sorted([tuple(r) for r in got], key=repr) == brute(rows, 3, 80), frequent
        assert written.count("entries") == 3 and written.count("links") >= 3


def test_parities_of_unequal_width_keep_every_pair_in_reach():
    rnd = np.random.default_rng(7)
    token = rnd.integers(0, 1 << 63, 9000).astype(np.uint64)
    sets = [token[:1020], token[:1030], token[10:2100], token[1000:2100], token[2100:], token[2600:], token[:0], token[:3]]
    n = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), n)
    bits = J._parities(doc, np.concatenate(sets), J._widths(n))
    assert set(np.diff(bits.offsets.to_numpy())) == {16, 32, 64, 128}
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    # a slice, since a batch need not begin where its lists do
    batch = pa.record_batch({"a": a, "b": b, "n": n[a], "m": n[b], "ab": bits.take(pa.array(a)), "bb": bits.take(pa.array(b))}).slice(5)
    for percent in (60, 80, 90):
        kept = {(x["a"], x["b"]) for out in J._alike(percent)(iter([batch])) for x in out.to_pylist()}
        for x, y in zip(a[5:].tolist(), b[5:].tolist()):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= percent * (n[x] + n[y] - both):
                assert (x, y) in kept, (percent, x, y)
        assert percent == 60 or not {(3, 4), (0, 3)} & kept
