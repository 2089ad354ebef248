"""Formatting, byte-level BPE and the rule ledger against brute force on a small fixture."""

import base64
import hashlib
import re
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

from reelstar.llm import byte_bpe, chat, rules

LONG = "alpha beta gamma\n" * 3000 + "ünïcode ≈ 東京 #*$ " * 500
TEXTS = [None, "", " \n\t ", "a", "One two three. One two three.\nOne two three. One two three.\n\nx", LONG, LONG,
         "<|endoftext|> </s>[INST] \\ \\0 ok", "don't   stop\r\n\r\n  1234 ñandú", "a b c d a b c d"]


def _docs(spark):
    rows = [(i, t, "en", "s", 7, "x") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None, None, None), (None, "k", "", "", 1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, block string, at int, n_words string").repartition(3)


def _key(rows):
    return Counter(tuple(r) for r in rows)


def test_byte_bpe_equals_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = _docs(spark)
    encoded = byte_bpe.encode(docs, path, P.PATTERN)
    assert _key((r.doc_id, bytes(r.decoded)) for r in byte_bpe.decode(encoded, path).collect()) == _key(
        (r.doc_id, (r.text or "").encode()) for r in docs.collect())
    got = byte_bpe.digests(encoded, path).collect()
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert _key(got) == _key(want)


def test_byte_bpe_of_long_texts_by_windows(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WINDOW", 50)
    monkeypatch.setattr(byte_bpe, "TOKENS", 7)
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 300)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = ["ab  12\n\n 'll don't, x" * 40, "x" * 900, "東京" * 300, "я я. " * 100, "\n" * 200, "1 " * 130, "!? " * 99, "", None, "東 京1 ²\u00a0a\u2003b " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for slices in (1, 3, 300):
        rows = {r.doc_id: list(memoryview(bytes(r.ids)).cast("I")) for r in byte_bpe.encode(docs, path, P.PATTERN, slices).collect()}
        assert rows == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    got = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(byte_bpe.encode(docs, path, P.PATTERN), path).collect()}
    assert got == {i: (hashlib.sha256(",".join(map(str, enc.encode_ordinary(t or ""))).encode()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t in enumerate(texts)}


def _measures(text):
    text = text or ""
    word = r"[^\x20\x09-\x0D]+"
    words = re.findall(word, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(word, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_rule_ledger_equals_brute_force(spark):
    docs = _docs(spark)
    rows = rules.apply_policy(rules.ledger(docs), rules.BASE)
    got = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept").collect()
    want = []
    for r in docs.collect():
        m = _measures(r.text)
        want.append((r.doc_id, *m, not (m[0] < 50 or 100 * m[4] > 50 * m[0])))
    assert _key(got) == _key(want)


def test_ablation_counts(spark):
    rows = spark.createDataFrame([(0b1,), (0b1,), (0b11,), (0,), (0b100,)], "fail_bits int")
    got = {r.rule: (r.failed, r.only_here) for r in rules.ablation(rows, rules.BASE).collect()}
    assert got == {"few_words": (3, 2), "repeated_windows": (1, 0)}


@pytest.mark.parametrize("budget,history", [(8, 0), (40, 12), (4096, 512)])
def test_windows_hold_every_turn_and_target_once(spark, budget, history):
    odd = "</s>[INST] ok [/INST]\\3 \\"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd), (1, 3, "user", None),
            (1, 4, "assistant", "a " * 50), (1, 5, "assistant", ""), (2, 0, "assistant", "solo"), (2, 0, "assistant", "solo"),
            (None, 0, None, "x"), (3, None, "user", "")]
    rows += [(9, i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 7)) for i in range(200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(turns, budget, history)
    by = {r.conv_id: r for r in chat.digests(windows).collect()}
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -9, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(by) == set(convs)
    for c, items in convs.items():
        loss = "".join(t for r, t in items if r == "assistant")
        assert by[c].n_turns == len(items)
        assert by[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in items).encode()).hexdigest()
        assert (by[c].loss_chars, by[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        parsed = chat.parse(w.formatted)
        assert w.n_tokens <= budget or len(parsed) - w.n_repeated == 1
        if w.conv_id == 1:
            assert parsed[0][:2] == ("system", "be kind")


def test_empty_tables(spark):
    docs = _docs(spark).limit(0)
    assert rules.ledger(docs).count() == 0
    assert byte_bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_windows(turns)).count() == 0
