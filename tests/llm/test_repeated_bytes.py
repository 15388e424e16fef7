import random
from collections import Counter

from llm_fixtures import docs_of  # noqa: F401
from cartwheel.llm.repeated_bytes import remove_repeats


def brute(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((d, len(b), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def test_against_brute_force(docs_of):
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice("abcde é ") for _ in range(n))
    p, q, base = text(600), text(450), text(1500)
    rows = [(1, text(500) + p + text(300)), (2, text(20) + p[50:] + text(900)), (3, p), (4, text(300) + p[:410] + q), (5, "x" * 1000),
            (6, q + text(5) + q[:420]), (7, None), (8, ""), (9, text(399)), (10, q[:399] + "zz" + q), (None, p + "abc"), (12, "ab" * 700)]
    for k in range(20):
        b = list(base)
        for _ in range(k % 4):
            b[rnd.randrange(1500)] = "Z"
        rows.append((100 + k, "".join(b)))
    rows.append(rows[1])                       # a repeated row
    got = sorted([(r.doc_id, r.n_bytes, bytes(r.kept)) for r in remove_repeats(docs_of(rows)).collect()], key=repr)
    assert got == brute(rows, 400)


def test_empty_table(docs_of):
    assert remove_repeats(docs_of([])).count() == 0
