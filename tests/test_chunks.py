import random

import pytest
from pyspark.sql import functions as F

from vigil.config import StreamConfig
from vigil.sinks.chunks import HEADER, MARK, split_messages
from vigil.sinks.envelope import publish
from vigil.streaming.assemble import Messages, assemble

SCHEMA = "key binary, value binary"


def frame(spark, rows):
    return spark.createDataFrame([(None if k is None else bytearray(k), None if v is None else bytearray(v)) for k, v in rows], SCHEMA)


def send(spark, src, batches):
    for i, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.parquet(f"{src}/b={i:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")


def pairs(df, *cols):
    return sorted(tuple(None if x is None else bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.select(*cols).collect())


def test_parts_keep_to_the_limit_and_rejects_are_kept(spark):
    rows = [(b"k%d" % i, random.Random(i).randbytes(n)) for i, n in enumerate([0, 1, 90, 97, 98, 99, 100, 5000, 5001])]
    rows += [(b"mark", MARK), (b"null", None), (None, b"x" * 300), (b"k" * 100, b"v"), (b"k" * 80, b"v" * 50)]
    ok, bad = split_messages(frame(spark, rows), 100, 5000)
    got = [(bytes(r.key or b""), None if r.value is None else bytes(r.value)) for r in ok.collect()]
    assert all(len(k) + len(v or b"") <= 100 for k, v in got)
    assert (b"k3", rows[3][1]) in got and (b"k4", rows[4][1]) in got and (b"k5", rows[5][1]) not in got
    assert sum(k == b"k7" for k, _ in got) == -(-5000 // (100 - HEADER - 2))
    assert pairs(bad, "key", "value", "reason") == sorted([(b"k8", rows[8][1], "too_large"), (b"k" * 100, b"v", "key_too_long"), (b"k" * 80, b"v" * 50, "key_too_long")])
    with pytest.raises(ValueError):
        split_messages(frame(spark, rows), HEADER)
    assert split_messages(frame(spark, []), 100)[0].count() == 0


def test_parts_in_any_order_over_triggers(spark, scratch):
    rng = random.Random(7)
    rows = [(b"k%02d" % (i % 7), rng.randbytes(rng.choice([0, 40, 200, 900]))) for i in range(30)] + [(b"mark", MARK + b"y" * 30), (None, b"z" * 500), (b"t", None)]
    rows = list(dict.fromkeys(rows))
    sent = [(None if r.key is None else bytes(r.key), None if r.value is None else bytes(r.value)) for r in split_messages(frame(spark, rows), 100)[0].collect()]
    sent += [s for s in sent if s[1] and s[1].startswith(MARK)][::3]  # parts that come twice
    rng.shuffle(sent)
    out = scratch("out")
    stream = send(spark, scratch("src"), [sent[i::4] for i in range(4)])
    assemble(stream, out, scratch("ck"))
    m = Messages(out)
    key = lambda r: (r[0] or b"", r[1] or b"")
    got = [(None if r.key is None else bytes(r.key), None if r.value is None else bytes(r.value)) for r in m.read(spark, "delivered").collect()]
    assert sorted(got, key=key) == sorted(rows, key=key)
    assert m.read(spark, "undeliverable").count() == 0
    assert m.waiting(spark).count() == 0


def test_lost_and_spoiled_parts_are_reported(spark, scratch):
    parts = [(bytes(r.key), bytes(r.value)) for r in split_messages(frame(spark, [(b"a", b"1" * 200), (b"b", b"2" * 200), (b"c", b"3" * 200)]), 100)[0].collect()]
    a, b, c = ([p for p in parts if p[0] == k] for k in (b"a", b"b", b"c"))
    assert len(a) == 3
    b[1] = (b"b", b[1][1][:-1] + b"!")
    batches = [a[:2] + b, [], c[:1] + a[:1], [(b"w", b"whole")], []]
    out, ck = scratch("out"), scratch("ck")
    stream = send(spark, scratch("src"), [x or [(b"pad", None)] for x in batches])
    assemble(stream, out, ck, wait_batches=3)
    m = Messages(out)
    assert pairs(m.read(spark, "undeliverable"), "key", "parts", "received", "reason") == [(b"a", 3, 2, "incomplete"), (b"b", 3, 3, "corrupt")]
    assert pairs(m.waiting(spark), "key", "parts", "received") == [(b"c", 3, 1)]
    assert (b"w", b"whole") in pairs(m.read(spark, "delivered").where(F.col("key") != F.lit(b"pad")), "key", "value")


def test_twenty_megabytes_pass_a_small_limit(spark, scratch):
    value = random.Random(1).randbytes(20_000_000)
    src, out = scratch("src"), scratch("out")
    ok, bad = split_messages(frame(spark, [(b"big", value)]), 512_000)
    ok.repartition(3).write.parquet(src)
    assert bad.count() == 0
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    assemble(stream, out, scratch("ck"))
    row = Messages(out).read(spark, "delivered").select(F.length("value"), F.md5("value")).collect()
    from hashlib import md5
    assert [tuple(r) for r in row] == [(20_000_000, md5(value).hexdigest())]


def test_publish_with_a_limit(spark, scratch):
    topic, lost = scratch("topic"), scratch("lost")
    cfg = StreamConfig(format="parquet", max_request_size=100)
    publish(frame(spark, [(b"a", b"1" * 300), (b"k" * 100, b"v"), (b"b", b"2")]), cfg, topic, lost)
    assert pairs(spark.read.parquet(lost), "key", "reason") == [(b"k" * 100, "key_too_long")]
    assert spark.read.parquet(topic).where(F.octet_length("key") + F.octet_length("value") > 100).count() == 0
    with pytest.raises(ValueError):
        publish(frame(spark, []), cfg, topic)
    with pytest.raises(ValueError):
        StreamConfig(max_request_size=0)


def test_bytes_are_written_once_and_a_message_can_be_sent_anew(spark, scratch):
    """Waiting messages are known by their parts' numbers only; a corrupt message's old parts are not used again."""
    from pyspark.sql import functions as F
    from vigil.sinks.chunks import split_messages
    from vigil.streaming.assemble import Messages, assemble

    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    sent, _ = split_messages(spark.createDataFrame([(bytearray(b"k"), bytearray(b"abcdefghij" * 30))], "key binary, value binary"), 100)
    parts = sorted(bytes(r.value) for r in sent.collect())
    spoiled = parts[0][:-1] + b"#"
    for batch in [[spoiled], parts[1:], parts[:2], parts[2:]]:
        rows = [(bytearray(b"k"), bytearray(p)) for p in batch]
        spark.createDataFrame(rows, "key binary, value binary").coalesce(1).write.mode("append").parquet(src)
        assemble(spark.readStream.schema("key binary, value binary").parquet(src), out, ck)
    m = Messages(out)
    assert [bytes(r.value) for r in m.read(spark, "delivered").collect()] == [b"abcdefghij" * 30]
    assert [r.reason for r in m.read(spark, "undeliverable").collect()] == ["corrupt"]
    assert "body" not in m.state(spark, 0, 3).columns and m.read(spark, "parts").count() == 2 * len(parts)
