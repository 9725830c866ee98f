import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from vigil.llm import sentence_pieces as sp
from vigil.sources.tables import table

SF0001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = SentencePieceProcessor(model_file=PATH)


def by_scan(text, chunk, group):
    """Encoding by the scan alone, without Spark."""
    p, t = sp.pieces(PATH), sp.MARK + text.replace(" ", sp.MARK)
    places = range(0, len(t), chunk)
    windows = [(t[max(0, q - p.longest):q + chunk + p.longest], min(q, p.longest), min(chunk, len(t) - q), q + chunk >= len(t)) for q in places]
    ms = [p.transfer(w, lo, lo + n, final) for w, lo, n, final in windows]
    products = []
    for i in range(0, len(ms), group):
        m = ms[i]
        for x in ms[i + 1:i + group]:
            m = sp.product(m, x)
        products.append(m)
    at = sp.walk(products, 0, None)
    out = []
    for g, (a, b) in enumerate(zip(at[:-1], at[1:])):
        part = windows[g * group:(g + 1) * group]
        states = sp.walk(ms[g * group:(g + 1) * group], a, b)
        for (w, lo, n, final), s, e in zip(part, states[:-1], states[1:]):
            out += p.backtrace(w, lo, lo + n, p.states(w, lo, False)[s], p.states(w, lo + n, final)[e])
    return out


TEXTS = ["the internationalisation of words", "  two  blanks   here    and trailing   ", "a" * 300, "abcabcabc" * 40, "日本語のテキスト" * 12, "▁▁ ▁x▁ y", "\n\n\nlines\n of\ttext\n",
         "ܐܒܓ mixed \x00 bytes é̂ ﬁ 🤦🏼‍♂️" * 5, " ", "x", " lead", "hello     world" * 9, "0123456789" * 30, "https://example.com/a?b=c&d=e#f" * 8, "eeeeeeeeeeeeeeeeeeeeeeeeee ee eee" * 7]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("chunk,group", [(16, 2), (37, 3), (64, 64)])
def test_scan_equals_the_library(text, chunk, group):
    assert by_scan(text, chunk, group) == LIB.encode(text)


def test_scan_equals_the_library_on_random_texts():
    rnd = random.Random(3)
    words = ["tion", "the", "ing", " ", " ", "  ", "a", "er", "▁", "\n", "é", "日", "00", "un", "ation", "ly", "x", ".", ",,", "🙂"]
    for n in range(150):
        text = "".join(rnd.choice(words) for _ in range(rnd.randint(20, 160)))
        assert by_scan(text, rnd.choice([16, 23, 50]), rnd.choice([1, 2, 5])) == LIB.encode(text), text


def test_merging_equals_the_library():
    rnd = random.Random(4)
    p = sp.pieces(PATH)
    for _ in range(500):
        text = "".join(rnd.choice("abeinorst ▁é.") for _ in range(rnd.randint(1, 20)))
        parts = p.merged(sp.MARK + text.replace(" ", sp.MARK))
        assert [i for x in parts for i in p.ids(x)] == LIB.encode(text)


def expected(text):
    ids = LIB.encode(text or "")
    decoded = LIB.decode(ids).encode() if ids else b""
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256(decoded).hexdigest(), len(decoded), ids, decoded.decode()


def test_table_and_edge_rows(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").collect()][:120]
    docs += [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(1, None), (1, None), (None, ""), (None, "b " * 500), (3, "giant twice " * 60), (3, "giant twice " * 60)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, chunk int")
    want = sorted(((i, *expected(t)) for i, t in docs), key=str)
    got = sp.encode(df, PATH, more=("ids", "decoded"), chunk=250, group=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    thin = sp.encode(df, PATH, chunk=100, group=2).collect()
    assert sorted((tuple(r) for r in thin), key=str) == sorted((w[:5] for w in want), key=str)
    for _, t in docs:  # decoding gives the text back; a literal word mark reads as a blank
        assert expected(t)[5] == (t or "").replace(sp.MARK, " ")
    assert sp.encode(df.limit(0), PATH).count() == 0
