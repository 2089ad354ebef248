"""Registered queries of the training-data operators and their DuckDB texts.

Each ``opN_`` query applies its operator with production parameters to the
whole intended table and derives the contract's columns from the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm import (
    bestfit, byte_bpe, chat, jaccard, language, licenses, prefix_trie, rule_ensemble, rules, search, suffix_tree, toxicity,
    whitening,
)
from reelstar.llm.folds import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted windows of all conversations and of conversation -7."""
    odd = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_windows(turns.unionByName(extra)))


def op2_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside fold 0 of 5."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside fold 1 of 3."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    said = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return said.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred",
                       F.col("lang_score").alias("score"))


def op4_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and suffix-tree scores of all documents, learned outside fold 2 of 7."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_tree.score(docs, suffix_tree.fit(docs))


def op6_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector among all others."""
    return search.top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the byte-level BPE ids of all documents and of their decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)


def op7_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signatures of all documents."""
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("detections")


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, base verdict and the verdict of the current policy for all documents."""
    rows = rules.ledger(_table(spark, sf_dir, "documents"))
    kept = rules.apply_policy(rules.apply_policy(rows, rules.STRICT), rules.BASE, "base_kept")
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


def op8_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences of 4096 ids."""
    packed = bestfit.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "sequence_id", "offset")


def op10_lsh_forest_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class and number of links of every document."""
    return jaccard.similarity_classes(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of all embeddings."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside fold 0 of 5."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = rule_ensemble.assess(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_budgeted_windows": op1_budgeted_windows,
    "op2_nnpu_toxicity": op2_nnpu_toxicity,
    "op3_byte_cnn_language": op3_byte_cnn_language,
    "op4_suffix_tree_lm": op4_suffix_tree_lm,
    "op6_ball_tree_search": op6_ball_tree_search,
    "op5_distinct_word_bpe": op5_distinct_word_bpe,
    "op7_license_signatures": op7_license_signatures,
    "op9_rule_ledger": op9_rule_ledger,
    "op8_bestfit_packing": op8_bestfit_packing,
    "op10_lsh_forest_jaccard": op10_lsh_forest_jaccard,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_rule_ensemble": op13_rule_ensemble,
}

# Naive measurements of every document: lists of words, lines and three-word windows.
_LEDGER_SQL = r"""
    WITH d AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
        FROM documents),
    windows AS (
        SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    repeated AS (
        SELECT r, count(DISTINCT i + o) AS n
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM windows), (VALUES (0), (1), (2)) AS v(o)
        WHERE c > 1 GROUP BY r),
    lines AS (
        SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY r),
    m AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
               coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
               length(regexp_replace(t, '[^A-Za-z\x{C0}-\x{10FFFF}]', '', 'g')) AS n_letters,
               length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
        FROM d LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
    f AS (
        SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                  + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                  + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
                  + CASE WHEN 100 * n_letters < 50 * word_chars THEN 64 ELSE 0 END
                  + CASE WHEN 100 * n_upper > 50 * n_letters THEN 128 ELSE 0 END AS fail_bits
        FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits % 4 > 0 AS base_failed,
           fail_bits = 0 AS kept, fail_bits
    FROM f"""

# Every query vector against all others.
_SEARCH_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * 256)) AS x FROM embeddings),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 5"""

# Every rebuilt conversation as a list of turns; a node is a prefix, its subtree the nodes it begins.
# crc32 runs bit by bit over the decimal id: 0xEDB88320 is the reversed polynomial.
_TRIE_SQL = r"""
    WITH RECURSIVE own AS (
        SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    crc(conv_id, s, k, v) AS (
        SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM own
        UNION ALL
        SELECT conv_id, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
        FROM (SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(s, CAST(k // 8 + 1 AS BIGINT), 1)) AS BIGINT)) ELSE v END AS x
              FROM crc WHERE k < 8 * length(s))),
    head AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM crc WHERE k = 8 * length(s)),
    built AS (
        SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
        FROM own o JOIN head USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
    member AS (SELECT conv_id, d, turns[1:d] AS node, turns[d].t AS said, d = len(turns) AS at_end
               FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
    node AS (
        SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(strlen(said)), 0) AS saved,
               sha256(coalesce(string_agg(CASE WHEN at_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends
        FROM member GROUP BY node, d),
    kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
    below AS (
        SELECT up AS node, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves
        FROM (SELECT n.node[1:unnest(range(0, n.d + 1))] AS up, n.saved, kids.n IS NULL AS leaf FROM node n LEFT JOIN kids USING (node))
        GROUP BY up)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
           below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
    FROM node n JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN node p ON n.d > 0 AND p.node = n.node[1:n.d - 1]"""

ORACLE: dict[str, str] = {"op6_ball_tree_search": _SEARCH_SQL, "op9_rule_ledger": _LEDGER_SQL, "op12_prefix_trie": _TRIE_SQL}

# Every other query and why it has no SQL text.
NO_ORACLE: dict[str, str] = {
    "op1_budgeted_windows": "digests of formatted windows; brute force and round trip in tests/llm",
    "op2_nnpu_toxicity": "a trained classifier",
    "op3_byte_cnn_language": "a trained network",
    "op4_suffix_tree_lm": "a trained model; brute force in tests/llm",
    "op5_distinct_word_bpe": "byte-pair merges; the tiktoken library in tests/llm",
    "op7_license_signatures": "ordered rules with suppression; brute force in tests/llm",
    "op8_bestfit_packing": "word-piece merges; the tokenizers library in tests/llm",
    "op11_embedding_whitening": "eigenvectors; brute force in tests/llm",
    "op13_rule_ensemble": "a trained classifier; brute force of its measurements and rules, held-out accuracy in tests/llm",
    "op10_lsh_forest_jaccard": "connected components of MinHash candidates; brute force in tests/llm",
    "pipeline": "a trained network and classifier decide the first two stages; tests/llm/test_pipeline.py",
}
