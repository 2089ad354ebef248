"""Best-fit packing: pieces against the tokenizer library, sequences against the contract, the plan against brute force."""

import random
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from reelstar.llm import bestfit
from reelstar.llm.word_bpe import word_bpe

PATH = P.path("word_bpe_49k.json")
LONG = "alpha beta gamma don't 1234 ünïcode ≈ 東京 #*$\n" * 900
TEXTS = [None, "", " \n\t ", "a", "One two three.", "One two three.", LONG, LONG, "<|endoftext|> <|startoftext|> x",
         "no break space \x1c end", "İstanbul ÀÉ ſ Ｆｕｌｌ", "x" * 30000]


def _docs(spark):
    rows = [(i, t, 1, "k") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None), (None, "k", 2, "")]
    rows += [(1000 + i, "word " * (i % 37), 0, "") for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece int, rank string").repartition(5)


def _want(docs, capacity):
    tok, want = Tokenizer.from_file(PATH), Counter()
    tok.encode_special_tokens = True   # as the vocabulary's notes say: their strings in a text are ordinary text
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [bestfit.END_ID]
        for p, a in enumerate(range(0, len(ids), capacity)):
            cut = ids[a:a + capacity]
            want[r.doc_id, p, a, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    return want


def _check_sequences(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_and_sequences(spark):
    docs = _docs(spark)
    for capacity in (4096, 64):
        rows = bestfit.pack_documents(docs, PATH, capacity, keep_ids=True).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == _want(docs, capacity)
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
        least = -(-sum(r.length for r in rows) // capacity)
        assert _check_sequences(rows, capacity) <= least * 1.05 + 1
    assert bestfit.pack_documents(docs.limit(0), PATH).count() == 0


def test_plan_holds_every_length_once():
    rng = random.Random(7)
    for _ in range(60):
        capacity = rng.randint(4, 40)
        histogram = {k: rng.randint(1, 30) for k in rng.sample(range(1, capacity + 1), rng.randint(1, min(9, capacity)))}
        runs = bestfit.plan_runs(histogram, capacity)
        used = Counter()
        for run in runs:
            assert sum(n * k for k, n in run.items) <= capacity
            for k, n in run.items:
                used[k] += run.copies * n
        assert used == Counter(histogram)


def test_gap_is_filled_exactly_where_three_lengths_can():
    rng = random.Random(8)
    for _ in range(300):
        capacity, gap = 30, rng.randint(1, 30)
        count = {k: rng.randint(1, 3) for k in rng.sample(range(1, 31), rng.randint(1, 5))}
        bits, rev = sum(1 << k for k in count), sum(1 << (capacity - k) for k in count)
        got = bestfit._exact(gap, bits, rev, capacity, lambda x: count.get(x, 0))
        pool = [k for k, n in count.items() for _ in range(n)]
        sums = {sum(c) for n in (1, 2, 3) for c in combinations(pool, n)}
        assert (got is not None) == (gap in sums)
        assert got is None or sum(got) == gap and not Counter(got) - Counter(pool)


def test_a_batch_is_read_in_blocks_of_bounded_memory():
    with open(PATH, encoding="utf-8") as f:
        bpe = word_bpe(f.read())
    text = b"one two a word in between " * 100
    buf, n = np.frombuffer(text * 5000, np.uint8), 5000
    offs = np.arange(n + 1, dtype=np.int64) * len(text)
    want = bestfit._block_ids(bpe, buf, offs[:2])[0]
    tracemalloc.start()
    at = 0
    for i, j, flat, ptr in bestfit._ids_by_block(bpe, buf, offs):
        assert i == at and (flat.reshape(j - i, -1) == want).all() and (np.diff(ptr) == len(want)).all()
        at = j
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert at == n and peak < 96 << 20
