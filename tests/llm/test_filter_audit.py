"""The filter audit against plain Python, with smaller ids arriving after larger ones."""

import itertools
import random
import re

from cartwheel.llm.filter_audit import FILTERS, failure_histogram, fails, interactions


def masks(rows):
    """Mask of each ``doc_id, text, source``, the texts compared pair by pair."""
    out = []
    for number, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        twin = number is not None and any(m is not None and m < number and (t or "") == text for m, t, _ in rows)
        out.append((len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
                   + 4 * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text)) + 16 * twin)
    return out


def audit(rows, labels):
    found = masks(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(d, m) for (d, _, s), m in zip(rows, found) if (s or "") == part]
        shapley = dict.fromkeys(FILTERS, 0)
        for order in itertools.permutations(FILTERS):
            left = mine
            for step, f in enumerate(order, 1):
                bit = 1 << FILTERS.index(f)
                gone = [x for x in left if x[1] & bit]
                before = len(mine) - len(left)
                left = [x for x in left if not x[1] & bit]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(bool(m & bit) for _, m in mine) - len(gone), sum(m == bit for _, m in mine),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                assert before + len(gone) + len(left) == len(mine)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def texts(rng):
    long = " ".join(f"w{i}" for i in range(230))
    pool = [None, "", "short", "same same " * 150, long, long + " $", long.replace("w1", "W1"), long.upper(), "\x0b\x1cé " * 300]
    return [rng.choice(pool) for _ in range(60)]


def run(spark, tmp_path, rows, labels, batches=4):
    path = str(tmp_path / "documents.parquet")
    schema = "doc_id long, text string, source string, part string, mask int, n long, key string"
    for k in range(0, max(len(rows), 1), 15):            # one file after another
        spark.createDataFrame([(*r, "x", 7, 7, "k") for r in rows[k:k + 15]], schema).coalesce(1).write.mode("append").parquet(path)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    histogram = failure_histogram(spark, path, given, batches, texts_per_state=3)
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in interactions(histogram).collect()}


def test_audit_against_plain_python(spark, tmp_path):
    rng = random.Random(5)
    ids = [rng.choice([None, *range(40), -3, 2**60 + 1, 2**60]) for _ in range(60)]
    rows = [(d, t, rng.choice(["a", "a", "", None, "b"])) for d, t in zip(ids, texts(rng))]
    rows.sort(key=lambda r: -(r[0] or 0))                # smaller ids come later: every copy is retracted
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(50)]
    assert run(spark, tmp_path, rows, labels) == audit(rows, labels)


def test_number_of_batches_changes_nothing(spark, tmp_path):
    rng = random.Random(6)
    rows = [(60 - i, t, "s") for i, t in enumerate(texts(rng))]
    one = run(spark, tmp_path / "one", rows, [(3, 1, 1)], batches=1)
    assert one == run(spark, tmp_path / "four", rows, [(3, 1, 1)], batches=9) == audit(rows, [(3, 1, 1)])


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, [], []) == {}


def test_masks_of_single_texts():
    assert fails("") == 1
    assert fails("x\x1cy " * 200) == 2                   # 0x1C is no white space
    assert fails("A b") == 1 | 4 and fails("a|b") == 1 | 8
