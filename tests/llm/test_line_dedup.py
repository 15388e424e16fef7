import random
import re

from llm_fixtures import docs_of  # noqa: F401
from cartwheel.llm.common import keyed
from cartwheel.llm.line_dedup import dedup_lines


def close(x, y, least):
    if x == y:
        return True
    if min(len(x), len(y)) < least:
        return False
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:j] + y[j + 1:] == x for j in range(len(y)))


def test_against_brute_force(docs_of):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([1, 2, 4, 8, 9, 12]))] for _ in range(12)]
    rows = [(1, None), (2, ""), (3, " \n \n"), (None, "a b\nc d")]
    for i in range(10, 60):
        lines = []
        for _ in range(rnd.randrange(8)):
            b = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k, op = rnd.randrange(len(b)), rnd.randrange(3)
                if op == 1 and len(b) > 1:
                    del b[k]
                elif op == 2:
                    b.insert(k, rnd.choice(words))
                else:
                    b[k] = rnd.choice(words)
            lines.append(rnd.choice([" ".join(b), "  ".join(b) + " ", " ".join(b).upper()]))
        rows.append((i, "\n".join(lines)))
    docs = docs_of(rows)
    key = {(r.id, r.text): (r.did, r.rk) for r in keyed(docs).collect()}
    places = sorted(((*key[d, t or ""], n), re.findall(r"[^\x20\x09-\x0D]+", x.lower()))
                    for d, t in rows for n, x in enumerate((t or "").split("\n")) if x.strip())
    gone = {p for i, (p, w) in enumerate(places) if any(close(w, v, 8) for _, v in places[:i])}
    want = [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (*key[d, t], n) not in gone)) for d, t in rows]
    got = [(r[0].doc_id, r[1]) for r in dedup_lines(docs, 8).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_lines_of_two_words_in_mirrored_order_are_two_lines(docs_of):
    # sums of powers modulo 2**64 take these for one line, whatever the base
    order = [bin(i).count("1") & 1 for i in range(1024)]
    one, other = (" ".join("ab"[b ^ flip] for b in order) for flip in (0, 1))
    got = {r[0].doc_id: (r[1], r[3]) for r in dedup_lines(docs_of([(1, one), (2, other), (3, one)]), 8).collect()}
    assert got == {1: (one, 0), 2: (other, 0), 3: ("", 1)}


def test_words_in_mirrored_order_are_two_words(docs_of):
    order = [bin(i).count("1") & 1 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in order) for flip in (0, 1))
    got = {r[0].doc_id: r[3] for r in dedup_lines(docs_of([(1, one), (2, other), (3, f"{one}\n{other}")]), 8).collect()}
    assert got == {1: 0, 2: 0, 3: 2}
