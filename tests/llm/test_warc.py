import gzip
import hashlib
import io
import random

from vigil.llm import warc

REC = [warc.record("response", i, f"http://e/{i}", (b"%d " % i) * (i * 37 % 400), len((b"%d " % i) * (i * 37 % 400)),
                   hashlib.sha1((b"%d " % i) * (i * 37 % 400)).hexdigest(), None) for i in range(60)]


def ids(data, size, keep=False):
    """Page ids of all ranges of ``size`` bytes, in order."""
    return [r["page_id"] for a in range(0, len(data), size) for r in warc.records_in(io.BytesIO(data), a, min(a + size, len(data)), keep)]


def test_every_split_finds_each_record_once():
    data = b"".join(gzip.compress(r) for r in REC)
    for size in (1, 7, 50, 113, 1000, 1 << 20):
        assert ids(data, size) == list(range(60))


def test_magic_bytes_within_members_are_no_records(monkeypatch):
    rnd = random.Random(1)
    noise = [b"".join(rnd.choice([warc.MAGIC + b"\0" * 7, rnd.randbytes(9), gzip.compress(b"no record"), gzip.compress(b"")]) for _ in range(40)) for _ in range(20)]
    recs = [warc.record("response", i, None, n, len(n), hashlib.sha1(n).hexdigest(), None) for i, n in enumerate(noise)]
    data = b"".join(warc._member(r, 0 if i % 2 else 6) for i, r in enumerate(recs))
    monkeypatch.setattr(warc, "READ", 512)
    monkeypatch.setattr(warc, "STEP", 64)
    for size in (1, 100, 999, 1 << 20):
        got = [r for a in range(0, len(data), size) for r in warc.records_in(io.BytesIO(data), a, min(a + size, len(data)), True)]
        assert [(r["page_id"], r["payload"]) for r in got] == list(enumerate(noise))


def test_foreign_files():
    several = gzip.compress(REC[0] + REC[1]) + b"junk" + gzip.compress(b"not a record") + gzip.compress(REC[2])
    assert ids(several, 10) == [0, 1, 2]
    cut = gzip.compress(REC[3]) + gzip.compress(REC[40])[:-60]
    assert ids(cut, 1 << 20) == [3]
    assert ids(b"", 5) == [] and ids(b"\x1f\x8b\x08" * 50, 5) == []


def test_written_and_read_back(spark):
    big = "é" * 700
    rows = [(1, "http://a/ b\n", big), (2, None, big), (9, "u", big), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999), (6, "u", "x" * 999),
            (None, "n", big), (7, "u", "y" * 3_000_000), (8, "u", "y" * 3_000_000), (8, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([(i, u, h, "z") for i, u, h in rows], "page_id long, url string, html string, payload string")
    for file_bytes in (1, 1 << 30):
        got = warc.with_referred(warc.read(warc.write(df, file_bytes=file_bytes), keep_payload=True, range_bytes=100)).collect()
        payload = {r.page_id: r.payload for r in got if r.record_type == "response"}
        seen = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
        top = {big: 9, "y" * 3_000_000: 8}
        want = []
        for i, _, h in rows:
            b = (h or "").encode()
            revisit = len(b) >= 1000 and top[h] != i
            want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top[h] if revisit else None))
        assert seen == sorted(want, key=str)
        assert payload[9].decode() == big and payload[3] == b"" and len(payload[8]) == 3_000_000
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_headers_of_any_length(spark, scratch):
    long = "http://e/" + "é" * 400_000  # over 2 MB once percent-encoded
    pages = spark.createDataFrame([(1, "http://e/1", "a"), (2, long, "b" * 1500), (3, "http://e/3", "c")], "page_id long, url string, html string")
    got = warc.read(warc.write(pages), range_bytes=1000).select("page_id", "payload_bytes", "url").collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(1, 1), (2, 1500), (3, 1)]
    assert len(next(r.url for r in got if r.page_id == 2)) > 2_000_000
