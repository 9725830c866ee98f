import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm import wavelet
from vigil.sources.tables import table

SF0001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = ["", " ", "Don't STOP, we've it's 'tis y'all'd x's'", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>x", "Ünïcode é Éx, Å. ≠ ,́",
          " nbsp em\u0085nel\x1cfs", "don''t ''s 12345 3.14,15 x9y a1's", "...!!!word***,and\nlines\r\n\ttabs\x0b\x0c", "ÀÉÎÕÜÞ àéîõüþÿ Ÿ × ÷ ßß ẞ µ ª º Àe\u0301 é́ ÈOU",  "Σίσυφος ΣΑΣ İstanbul ẞ ﬁ", "日本語テキスト 한국어 العربية",
          "x" * 5000, "a,b" * 1000, "<|", "|>", "a'", "'", "'S 'T 'Ll", "힣ᆨ 하"]


def whole(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_encoder_equals_the_library_on_whole_texts(spark):
    texts = TRICKY + [r.text for r in table(spark, SF0001, "documents").collect()]
    encoder = wavelet.Encoder(PATH)
    got = encoder([t.encode() for t in texts])
    for t, g, w in zip(texts, got, whole(texts)):
        assert np.frombuffer(g, encoder.kind).tolist() == w, t[:80]


def test_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 3)
    e, texts = wavelet.Encoder(PATH), ["one two three four", "five one six", "two seven"]
    assert [np.frombuffer(x, e.kind).tolist() for t in texts for x in e([t.encode()])] == whole(texts)


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 40000), (511, 3), (512, 9), (513, 49408), (5000, 300), (1000, 70000)])
def test_matrix_against_the_plain_list(n, top):
    rnd = np.random.default_rng(n + top)
    ids = rnd.integers(0, top, n).astype(np.uint32)
    m = wavelet.WaveletMatrix(b"".join(wavelet.build(ids, [7], [n])))
    assert m.decode().tolist() == ids.tolist()
    for i in rnd.integers(0, n, 40) if n else []:
        assert m.access(int(i)) == ids[i]
    for token in [*ids[:20].tolist(), top + 5, 0]:
        lo, hi = sorted(rnd.integers(0, n + 1, 2).tolist())
        assert m.count(token, lo, hi) == (ids[lo:hi] == token).sum()
        places = np.flatnonzero(ids == token)
        for k in (0, len(places) // 2, len(places) - 1, len(places)):
            assert m.select(token, k) == (places[k] if 0 <= k < len(places) else -1)


def expected(rows, end=2):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole([t or ""])[0], end], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_written_and_read_back(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").collect()]
    df = table(spark, SF0001, "documents")
    for tokens in (wavelet.SHARD_TOKENS, 700):
        got = sorted(tuple(r) for r in wavelet.read(wavelet.write(df, PATH, 2, shard_tokens=tokens)).collect())
        assert got == expected(rows)


def test_edge_rows(spark):
    rows = [(5, None), (3, ""), (None, "null id"), (-4, "minus"), (9, "word " * 20000), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, uri int")
    got = wavelet.read(wavelet.write(df, PATH, 2, shard_tokens=10)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == expected(rows)
    assert wavelet.read(wavelet.write(df.limit(0), PATH, 2)).count() == 0


def test_a_tokenizer_with_other_rules_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, t = wavelet.Encoder(path), Tokenizer.from_file(path)
    assert wavelet.Encoder(PATH).by_words and not e.by_words
    for x, got in zip(TRICKY, e([x.encode() for x in TRICKY])):
        assert np.frombuffer(got, e.kind).tolist() == t.encode(x, add_special_tokens=False).ids, x[:80]


def test_rows_of_one_id_are_spread_and_keep_the_order(spark):
    rows = [(i, f"t{i}") for i in range(30)] + [(17, f"same {i % 3} " + "w " * 20) for i in range(400)] + [(None, "nothing")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    shards = wavelet.write(df, PATH, 2, shard_tokens=300)
    got = wavelet.read(shards).collect()
    assert sorted((r.id is not None, r.id or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in rows)
    got.sort(key=lambda r: r.start)
    assert [r.id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert shards.where("first_id = 17 AND last_id = 17").count() > 10
    dealt = wavelet.text_rows(df, "doc_id", "text").withColumn("place", F.monotonically_increasing_id()).repartitionByRange(8, "id", "place")
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) < 200
