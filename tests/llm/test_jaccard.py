"""The Jaccard join against brute force over all pairs of a small fixture."""

import random
import re

import corpus_pipeline
from reelstar.llm import jaccard
from reelstar.session import cut_lineage


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*(words[k:] for k in range(5))))


def _brute(rows):
    ids = [i for i, _ in rows]
    sets = [_set(t) for _, t in rows]
    link = {k: [] for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and ids[a] is not None and ids[b] is not None and sets[a] and sets[b]:
                if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    link[a].append(b)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((ids[a], None if ids[a] is None else min(ids[b] for b in seen), len(link[a])))
    return sorted(out, key=str)


def _fixture():
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(400)]
    rows, base = [], []
    for _ in range(25):
        base.append([rng.choice(vocab) for _ in range(rng.randint(40, 300))])
    for words in base:
        for _ in range(rng.choice([1, 1, 3, 6])):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append(" ".join(copy))
    hot = [rng.choice(vocab) for _ in range(600)]
    for k in range(40):
        copy = list(hot)
        copy[rng.randrange(600)] = f"x{k}"
        rows.append(" ".join(copy))
    rows += ["short text", "Short  TEXT", "", None, " \n", rows[0].upper(), "a b c d e " * 4000]
    return list(enumerate(rows)) + [(None, rows[0]), (3, rows[3]), (len(rows) - 9, rows[-9]), (len(rows) - 9, rows[-9])]


def test_classes_equal_brute_force(spark, monkeypatch):
    rows = _fixture()
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, content string, node int").repartition(4)
    want = _brute(rows)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert got == want
    monkeypatch.setattr(jaccard, "CHUNK", 8)  # large ranges in blocks
    again = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert again == want


def test_empty(spark):
    assert jaccard.similarity_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefix_depth():
    d = jaccard.prefix_depth(0.8, 0.999)
    assert 1 - (1 - 0.8**d) ** jaccard.TREES >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES


def _depths(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    contents = cut_lineage(jaccard._contents(cut_lineage(jaccard.signatures(docs))))
    return [depth for depth, _ in jaccard.forest_rounds(docs, contents, 0.8, 0.999)]


def test_prefixes_are_shortened_as_far_as_the_pairs_ask(spark):
    rng = random.Random(3)
    texts = [[f"w{rng.randrange(5000)}" for _ in range(1000)] for _ in range(8)]

    def copies(edits):
        out = []
        for words in texts:
            changed = list(words)
            for k in range(edits):
                changed[50 + 10 * k] = f"new{k}"
            out += [" ".join(words), " ".join(changed)]
        return list(enumerate(out))

    assert _depths(spark, copies(2)) == [jaccard.DEPTH]          # similarity 0.98: deep prefixes do
    assert _depths(spark, copies(15))[-1] in (4, 5)                # 0.86
    assert _depths(spark, copies(22))[-1] == 3                     # 0.80
    assert _depths(spark, list(enumerate("one two three four five six".split())))[-1] == 3   # no pair seen


def test_recall_at_the_threshold(spark):
    """Of 600 pairs that share 144 of 180 shingles (0.8), the forest finds nearly all."""
    rng = random.Random(9)
    rows = []
    for k in range(600):
        words = [f"w{rng.randrange(10**6)}" for _ in range(166)]
        other = list(words)
        for c in range(3):
            other[20 + 40 * c] = f"x{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other + [f"y{k}-{c}" for c in range(3)]))]
    near = sum(n == 1 for _, _, n in _brute(rows[:40])) / 40
    assert near == 1
    out = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("n_links = 1").count() >= 0.99 * len(rows)


def test_long_sets_are_split_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHINGLES", 500)
    rows = _fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert got == _brute(rows)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in jaccard.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {101: 100}


def _clashing():
    rng = random.Random(8)
    a, b, c = (" ".join(rng.choice("abcdefghijk") * rng.randint(1, 9) for _ in range(80)) for _ in range(3))
    # two texts of doc 1, each with a near copy of its own, and a repeated row
    return [(1, a), (1, b), (1, a), (2, a + " end"), (3, b + " end"), (4, c), (5, c.upper()), (6, ""), (6, None), (None, a)]


def test_texts_of_one_doc_id_have_their_own_links(spark):
    rows = _clashing()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    assert got == _brute(rows)


def test_stage_keeps_a_text_of_each_class(spark):
    rows = _clashing()
    docs = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, _text_of string, doc_id long")
    out = corpus_pipeline.jaccard_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (1, rows[1][1]), (4, rows[5][1]), (6, ""), (None, rows[0][1])], key=str)
