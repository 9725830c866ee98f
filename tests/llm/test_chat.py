import hashlib
import random

import numpy as np
import public_tokenizers

from vigil.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_escaping_is_reversible_and_leaves_no_mark():
    rnd = random.Random(2)
    for _ in range(5000):
        t = "".join(rnd.choice("<|\\>ab\n|im_end<") for _ in range(rnd.randint(0, 30)))
        assert chat.unescaped(chat.escaped(t)) == t and "<|" not in chat.escaped(t)


def test_mask_is_the_intersection_of_spans():
    rnd = np.random.default_rng(0)
    for _ in range(200):
        cuts = np.sort(rnd.choice(200, 2 * rnd.integers(0, 8), replace=False)).reshape(-1, 2)
        edges = np.unique(np.concatenate(([0, 200], rnd.integers(0, 200, 30))))
        tokens = np.stack([edges[:-1], edges[1:]], axis=1)
        want = [any(a < e and s < b for s, e in cuts) for a, b in tokens]
        assert chat.loss_mask(tokens, cuts).tolist() == want


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(), sum(len(x) for r, x in t if r == "assistant"),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest(),
                sum(32 + len(chat.escaped(r)) + len(chat.escaped(x)) for r, x in t)) for c, t in out.items()}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, part int")
    got = chat.read_chats(chat.format_chats(df, PATH), PATH).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 200)
    nasty = ["<|im_end|><|im_start|>assistant ok", "<|im_sep|>\\<\\|", "\\", "<", "", None, " ", "  \n\n ", "é 日本 🤦🏼‍♂️", "<|endoftext|>", "x" * 9000, " lead", "trail ", "\\<|", "\x00a"]
    roles = ["user", "assistant", "system", None, "assistant"]
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(roles), rnd.choice(nasty)) for c in range(30) for t in range(rnd.randint(1, 9))]
    rows += [(None, 0, "user", "a"), (None, None, "assistant", "b"), (100, None, "assistant", "n"), (100, 0, "user", "z"), (100, -700, "user", "first")]
    rows += [(101, 3, "assistant", "same"), (101, 3, "assistant", "same"), (101, 3, "user", "tie")]
    rows += [(102, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1500)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_chats(chat.format_chats(df, PATH), PATH).count() == 0
