"""The corpus pipeline's rows, stage by stage, against plain Python over the models' scores."""

import re

import corpus_pipeline
from reelstar.llm import bestfit, language, toxicity

SF = "/root/testdata/sf0.001"


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else frozenset([tuple(words)])


def _first_of_each_class(rows):
    """Without null ids or clashing ids: the rows whose id is the smallest one that links reach."""
    texts = dict(rows)
    sets = {i: _set(t) for i, t in texts.items()}
    near = {i: [j for j in sets if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in sets}
    kept = []
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        if min(seen) == i:
            kept.append(i)
    return kept


def test_rows_of_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    some = docs.limit(1).collect()[0]
    extra = spark.createDataFrame([(900, None, "en", "s", 0), (901, " 1 2 ", "en", "s", 0), (None, some.text, "en", "s", 0),
                                   (some.doc_id, some.text, some.lang, "again", 0)], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sf = str(tmp_path)

    said = language.predict(docs, language.fit(docs)).collect()
    want = sorted(((r.doc_id, r.text) for r in said if r.lang_pred != language.UNKNOWN and r.lang_score >= 0.5), key=str)
    first = corpus_pipeline.language_stage(spark, docs, sf).cache()
    assert first.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in first.collect()), key=str) == want
    assert not {900, 901} & {i for i, _ in want}

    scored = toxicity.score(first, toxicity.fit(first, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
    want = sorted(((r.doc_id, r.text) for r in scored if r.score < 0.5), key=str)
    second = corpus_pipeline.toxicity_stage(spark, first, sf).cache()
    assert second.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in second.collect()), key=str) == want

    ids = _first_of_each_class([(i, t) for i, t in want if i is not None]) + [i for i, _ in want if i is None]
    third = corpus_pipeline.jaccard_stage(spark, second, sf).cache()
    assert sorted((r.doc_id for r in third.collect()), key=str) == sorted(ids, key=str)

    path = corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")
    want = sorted(((r.doc_id, r.piece, r.length) for r in bestfit.pack_documents(third, path).collect()), key=str)
    got = sorted(((r.doc_id, r.piece, r.length) for r in corpus_pipeline.run(spark, sf).collect()), key=str)
    assert got == want and {i for i, _, _ in got} == set(ids)


def test_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_named_like_the_stages_own_keep_their_values(spark):
    import corpus_pipeline as C
    rows = [(i, f"plain words of a clean text number {i} and a few more of them to make it long enough " * 3, "en", "s", 9, "a", -0.5, -7.0,
             f"of{i}", i + 100, "t", "u", f"c{i}", True) for i in range(30)]
    names = ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "lang_score", "score", "_of", "_id", "_text", "text_id", "_c0", "positive"]
    docs = spark.createDataFrame(rows, names)
    want = {tuple(r) for r in docs.collect()}
    for _, stage in C.STAGES[:3]:
        got = stage(spark, docs, SF)
        assert got.columns == names
        assert {tuple(r) for r in got.collect()} <= want
    assert {tuple(r) for r in C.jaccard_stage(spark, docs.limit(0), SF).collect()} == set()
