"""The query of each operator over the test tables, with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import byte_bpe, covertree, decontamination, exact_dedup, hpylm, html_content, hyperminhash, licenses, merkle, mixing, quality, toxicity, whitening
from tallymark.llm.common import crc_remainder, table

TOKENIZER = "byte_bpe_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def op8_hierarchical_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(table(spark, sf_dir, "documents"), crc_remainder("doc_id", 5) != 1)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select("doc_id", "score", "kept")


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_toxicity, op3_licenses, op4_cover_tree, op5_mix_sources, op6_byte_bpe, op7_html_content,
        op8_hierarchical_lm, op9_quality, op10_hyperminhash, op11_whitening, op12_decontamination, op13_merkle_manifest,
    )
}

ORACLE = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
    """,
    "op4_cover_tree": """
        WITH e AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
            FROM e q JOIN e x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op12_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS passage
            FROM b, LATERAL (SELECT unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i) WHERE len(w) > 0),
        here AS (
            SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS passage
            FROM d, (SELECT DISTINCT n FROM win), LATERAL (SELECT unnest(range(0, len(w) - n + 1)) AS i)),
        hit AS (SELECT h.r, h.i, h.n, win.item_id FROM here h JOIN win USING (passage, n)),
        covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """,
    "op13_merkle_manifest": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, source,
                   concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
                   text,
                   CASE WHEN list_reduce(
                       list_concat([4294967295], list_transform(range(0, 8 * len(CAST(doc_id AS VARCHAR))),
                           lambda i: CASE WHEN i % 8 = 0 THEN ascii(CAST(doc_id AS VARCHAR)[1 + i // 8]) ELSE 0 END)),
                       lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) % 2 = 1 THEN 3988292384 ELSE 0 END)) % 2 = 1
                        THEN replace(text, chr(10), '') ELSE text END AS changed
            FROM documents),
        leaves AS (
            SELECT doc_id, source, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
                   sha256(concat(head, coalesce(strlen(changed) || ':' || changed, '-'))) AS tampered
            FROM t),
        ranked AS (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves),
        own(level, tree, pos, digest) AS (
            SELECT 0, tree, pos, leaf FROM ranked
            UNION ALL
            SELECT level + 1, tree, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM own) WHERE n > 1 GROUP BY level, tree, pos // 3),
        height AS (SELECT tree, max(level) AS h FROM own GROUP BY tree),
        above(level, pos, digest) AS (
            SELECT 0, own.tree, digest FROM own JOIN height ON own.tree = height.tree AND level = h
            UNION ALL
            SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
            FROM (SELECT *, count(*) OVER () AS n FROM above) WHERE n > 1 GROUP BY level, pos // 3),
        run AS (
            SELECT level, tree, pos // 3 AS parent, list(digest ORDER BY pos) AS nodes FROM own GROUP BY level, tree, pos // 3
            UNION ALL
            SELECT level, -1, pos // 3, list(digest ORDER BY pos) FROM above GROUP BY level, pos // 3),
        walk AS (
            SELECT row_number() OVER () AS r, doc_id, leaf, tampered, tree, pos, h,
                   (SELECT max(level) FROM above) AS top,
                   (SELECT digest FROM above ORDER BY level DESC LIMIT 1) AS root FROM ranked JOIN height USING (tree)),
        climb(r, step, level, tree, pos, proof, folded) AS (
            SELECT r, 0, 0, tree, pos, '', tampered FROM walk
            UNION ALL
            SELECT c.r, c.step + 1,
                   CASE WHEN c.tree >= 0 AND c.level = w.h THEN 0 ELSE c.level + 1 END,
                   CASE WHEN c.tree >= 0 AND c.level = w.h THEN -1 ELSE c.tree END,
                   CASE WHEN c.tree >= 0 AND c.level = w.h THEN c.tree ELSE c.pos // 3 END,
                   CASE WHEN c.tree >= 0 AND c.level = w.h THEN c.proof
                        ELSE concat(c.proof, array_to_string(run.nodes[: c.pos % 3], ''), array_to_string(run.nodes[c.pos % 3 + 2 :], '')) END,
                   CASE WHEN c.tree >= 0 AND c.level = w.h THEN c.folded
                        ELSE sha256(concat(array_to_string(run.nodes[: c.pos % 3], ''), c.folded, array_to_string(run.nodes[c.pos % 3 + 2 :], ''))) END
            FROM climb c JOIN walk w USING (r)
                 JOIN run ON run.tree = c.tree AND run.level = c.level AND run.parent = c.pos // 3
            WHERE c.tree >= 0 OR c.level < w.top)
        SELECT doc_id, leaf, (SELECT digest FROM above a WHERE a.level = 0 AND a.pos = w.tree) AS subroot, root,
               sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = root AS verified
        FROM walk w JOIN climb c USING (r) WHERE c.tree = -1 AND c.level = w.top
    """,
}
