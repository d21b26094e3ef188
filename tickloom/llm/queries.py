"""The registered queries of this folder: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, collocations, decontaminate, html_text, lm, pii, quality, shards, simhash, suffix_dedup, toxicity, warc, whitening


#: The permutations' key of the registered queries; users of :mod:`tickloom.llm.pii` bring a secret one.
PII_KEY = b"registered-run-key-not-a-secret!"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word SimHash groups of all documents at up to four differing bits."""
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"), size=4, max_bits=4)
    return groups.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of all documents."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and bigram log-probabilities of all documents, learned outside the held-out fifth."""
    return lm.scores(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a template window of a benchmark item, with the item."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of the line-first rules for all documents."""
    judged = quality.judged(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms, what was replaced and how often."""
    docs = pii.pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return docs.selectExpr("doc_id", "text", "CAST(size(pii) AS LONG) AS n_replaced", "pii")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, equal texts together as far as a shard holds them."""
    return shards.sharded(_table(spark, sf_dir, "documents"), shards=16)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learned from the labels outside the held-out quarter."""
    scored = toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.selectExpr("doc_id", "held_out", "score", f"CAST(score >= {toxicity.REJECT_SCORE} AS INT) AS predicted")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through WARC archives and back, in the order of the capture index."""
    index = warc.archived(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two or three words of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"), size=3, least=10, first=2000)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 32 whitened coordinates."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=32)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 100 bytes that start earlier."""
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), length=100)


OP10_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), heads AS (
    SELECT payload_digest, min(page_id) AS head FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM payloads LEFT JOIN heads USING (payload_digest)
"""

OP11_SQL = r"""
WITH pieces AS (
    SELECT doc_id, row_number() OVER () AS text_row, coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, row_number() OVER () AS piece_row, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), words AS (
    SELECT lang, piece_row, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split
), runs AS (
    SELECT lang, w AS w1, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY piece_row ORDER BY i)
), totals AS (
    SELECT lang, count(*) AS n FROM runs GROUP BY lang
), one AS (
    SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL
), two AS (
    SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
), three AS (
    SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT lang, w1 || ' ' || w2 AS phrase, two.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM two JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, f FROM one) y USING (lang, w2) WHERE two.f >= 10
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, three.f, 1, x.f, y.f
    FROM three JOIN one x USING (lang, w1) JOIN (SELECT lang, w1 AS w2, w2 AS w3, f FROM two) y USING (lang, w2, w3)
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, three.f, 2, x.f, y.f
    FROM three JOIN two x USING (lang, w1, w2) JOIN (SELECT lang, w1 AS w3, f FROM one) y USING (lang, w3)
), scored AS (
    SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, w1 || ' ' || w2 AS phrase, f FROM three UNION ALL SELECT lang, w2 || ' ' || w3, f FROM three) GROUP BY ALL
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank, c.phrase, c.a, c.l, c.r, t.n, c.score
FROM weakest c JOIN totals t USING (lang) LEFT JOIN longer g ON c.lang = g.lang AND c.phrase = g.phrase
WHERE g.f IS NULL OR 100 * g.f < 50 * c.a
QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_html": op3_html,
    "op4_lm_score": op4_lm_score,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLES: dict[str, str] = {"op10_warc": OP10_SQL, "op11_collocations": OP11_SQL}
