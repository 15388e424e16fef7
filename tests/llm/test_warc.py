import base64
import hashlib

import pytest

from cartwheel.llm.common import new_path
from cartwheel.llm.warc import read_archives, write_archives

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 99\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "5000b"])
def test_round_trip_with_magic_in_payloads(spark, split):
    pages = [(1, "u1", "abc"), (2, "u\r\n2", FAKE), (3, None, "abc"), (4, "u4", None), (5, "u5", ""), (6, "u6", f"x WARC/1.1\r\n y {FAKE}tail é"),
             (7, "u7", "WARC/1.1\r\n"), (8, "u8", "end\r\n\r\nWARC/1.1\r\nContent-Length: 99999\r\n\r\nzz"), (None, "u", "abc"), (None, "v", "null")]
    pages += [(100 + i, "h", f"page {i} " + "q" * (i * 37 % 500) + ("WARC/1.1\r\n" if i % 7 == 0 else "")) for i in range(150)]
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = []
    for p, _, h in pages:
        b, f = (h or "").encode(), first.get(h or "")
        again = f is not None and p != f
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", f if again else None))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = new_path(spark, "archives")
        write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2), path)
        got = [tuple(r) for r in read_archives(spark, path).select("page_id", "payload_bytes", "digest", "type", "refers_to").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_archives_are_split_alike_in_both_reads(spark, monkeypatch):
    """Other settings, as after the loss of executors, between the two reads of a record that magics cut."""
    from cartwheel.llm import warc
    pages = [(i, "u", f"page {i} " + FAKE * (i % 4)) for i in range(300)]
    path = new_path(spark, "archives")
    write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2), path)
    read, old = warc._pieces, spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []

    def pieces(spark, path):
        out = read(spark, path)
        seen.append(spark.conf.get("spark.sql.files.minPartitionNum", None))
        return out
    monkeypatch.setattr(warc, "_pieces", pieces)
    shaped = warc._records

    def records(spark, *rest):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
        return shaped(spark, *rest)
    monkeypatch.setattr(warc, "_records", records)
    try:
        got = read_archives(spark, path).select("page_id", "payload_bytes", "digest").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(p, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()) for p, _, h in pages]
    assert sorted(map(tuple, got)) == sorted(want)
    assert len(seen) == 2 and spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_many_records_in_one_split_take_linear_time():
    import time
    import numpy as np
    import pandas as pd
    from cartwheel.llm.warc import _follow
    n = 80_000
    at = np.arange(n, dtype=np.int64) * 100
    # every second candidate is inside a record of 200 bytes
    rows = pd.DataFrame({"file": "f", "block": 0, "place": np.arange(n), "offset": at, "next": at + 200, "enter": np.nan})
    rows.loc[0, "enter"] = 0
    began = time.monotonic()
    out = _follow(rows)
    assert time.monotonic() - began < 2
    assert out["owner"].tolist() == (at // 200 * 200).tolist()
