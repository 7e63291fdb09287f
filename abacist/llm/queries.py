"""The operators of this package on the generated tables, and SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    exact_dedup,
    html_content,
    minhash,
    sharding,
    simhash,
    suffix_tree,
    token_alignment,
    toxicity,
    url_filter,
    warc,
)
from abacist.llm.common import new_dir
from abacist.sources.tables import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, benchmark)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.suffix_tree_scores(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(*(read_table(spark, sf_dir, t) for t in ("documents", "labels")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(read_table(spark, sf_dir, "pages"), new_dir(spark, "warc"))
    found = archive.records(archive.captures(), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = (read_table(spark, sf_dir, t) for t in ("pages", "documents"))
    return html_content.main_texts(pages, html_content.linked_pages(pages, docs))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sharding.hilbert_shards(docs, ["lang", "source", "size"], shards=40)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    found = url_filter.judge(pages, url_filter.rule_labels(pages, URL_RULES), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(read_table(spark, sf_dir, "documents"), a, b).measures


URL_RULES = [
    url_filter.Rule("block", "net"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_byte_bpe,
        op3_suffix_tree,
        op4_toxicity,
        op5_warc,
        op6_exact_dedup,
        op7_html_content,
        op8_simhash,
        op9_hilbert_shards,
        op10_url_filter,
        op11_collocations,
        op12_minhash,
        op13_token_alignment,
    )
}

ORACLE = {
    "op5_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT payload_digest, payload_bytes, max(page_id) AS keep
            FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
        )
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN g.keep <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN g.keep <> p.page_id THEN g.keep END AS refers_to
        FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
    """,
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (
            SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
        )
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
        FROM d JOIN g USING (norm)
    """,
    "op11_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang, string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]') AS pieces
            FROM documents
        ), p AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (SELECT lang, unnest(pieces) AS piece FROM d)
        ), place AS (
            SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p
        ), f AS (
            SELECT lang, words[i : i + m - 1] AS phrase, m, count(*) AS f
            FROM place, (VALUES (1), (2), (3), (4)) AS sizes(m)
            WHERE i + m - 1 <= len(words)
            GROUP BY ALL HAVING count(*) >= 30
        ), cut AS (
            SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
                   CAST(2000000 * CAST(c.f AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
            JOIN f x ON x.lang = c.lang AND x.phrase = c.phrase[1 : k]
            JOIN f y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1 : c.m]
        ), lowest AS (
            SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_phrases AS (
            SELECT lang, phrase[s : s + n - 1] AS phrase, max(f) AS longer
            FROM (SELECT *, unnest(range(1, m - n + 2)) AS s
                  FROM (SELECT *, unnest(range(2, m)) AS n FROM f WHERE m > 2))
            GROUP BY ALL
        ), total AS (
            SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang
        ), ranked AS (
            SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score
            FROM lowest LEFT JOIN inner_phrases USING (lang, phrase)
            WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM ranked JOIN total USING (lang)
        QUALIFY rank <= 2000
    """,
}
