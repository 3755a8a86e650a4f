"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from resultlake.llm import bpe, scratch
from resultlake.llm.conversations import damage, repair
from resultlake.llm.exact_dedup import exact_dedup
from resultlake.llm.html_text import extract
from resultlake.llm.language_id import identify
from resultlake.llm.licenses import license_spans, summary
from resultlake.llm.media import describe, encode_media
from resultlake.llm.mixing import mix
from resultlake.llm.near_dedup import near_dedup
from resultlake.llm.phrases import collocations
from resultlake.llm.sharding import ShardedTable, free_name
from resultlake.llm.token_counts import count_tokens
from resultlake.llm.toxicity import toxicity

#: Tokenizer files; a path is a parameter of the operators.
BPE_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNT_FILE = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media of the bytes of each text and what is read back from them.

    Null texts count as empty, of which 64 bytes are stored; equal texts have equal values;
    repeated rows have a row each; an empty table gives an empty result; other columns are ignored.
    """
    return describe(encode_media(_read(spark, sf_dir, "documents")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals, one compaction, and the rows that the newest version holds.

    All columns go through the shards, whatever their names. Null and repeated ids and texts
    stay as they are, a row each; of a null text n_bytes is 0 and the digest null. An empty
    table gives an empty result.
    """
    docs = _read(spark, sf_dir, "documents")
    table = ShardedTable(spark, scratch.path(spark, "sharded"), target=64 << 20)
    late = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == 0
    table.append(docs.filter(~late))
    table.append(docs.filter(late))
    table.compact()
    shard = free_name(docs.columns, "shard")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    facts = [F.col(f"{shard}.{a}").alias(b) for a, b in (("rows", "shard_rows"), ("bytes", "shard_bytes"), ("tier", "tier"), ("written", "written"))]
    return table.read(shard_col=shard).select("doc_id", "source", size.alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), *facts)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page.

    Null and empty pages have an empty text; repeated rows have a row each; an empty table
    gives an empty result; other columns are ignored.
    """
    return extract(_read(spark, sf_dir, "pages"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document.

    Null texts have no words and are taken with 0; a null source is one, the last; repeated
    rows have a row each; an empty table gives an empty result; other columns are ignored.
    """
    return mix(_read(spark, sf_dir, "documents")).drop("repeats")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents from 85 percent of common shingles on.

    Null and empty texts stand alone; repeated rows are linked; a null doc_id is a
    component's id only where it stands alone; an empty table gives an empty result; other
    columns are ignored.
    """
    return near_dedup(_read(spark, sf_dir, "documents"), percent=85)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of each text and of the bytes that they decode to.

    Null and empty texts have no ids; repeated rows have a row each; an empty table gives an
    empty result; other columns are ignored.
    """
    coded = bpe.decode(bpe.encode(_read(spark, sf_dir, "documents"), BPE_FILE), BPE_FILE)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of two arrivals, the second against the cache that the first has left.

    Together they are all rows: three quarters of the ids, then the rest and null ids. Null
    texts count as empty; repeated rows have a row each; an empty table gives an empty
    result; other columns are ignored.
    """
    docs, cache = _read(spark, sf_dir, "documents"), scratch.path(spark, "token-counts")
    late = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == 0
    first = count_tokens(docs.filter(~late), COUNT_FILE, cache)
    return first.unionByName(count_tokens(docs.filter(late), COUNT_FILE, cache))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of each document, learned from the labelled rows that are not held out.

    Null and empty texts have the score of a text without hits; repeated rows have a row
    each; an empty table gives an empty result; other columns are ignored.
    """
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of each group of equal texts.

    Null texts count as empty; repeated rows are marked alike; a null doc_id stays only in a
    group without another; an empty table gives an empty result; other columns are ignored.
    """
    return exact_dedup(_read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and labels of licenses in each text.

    Null texts count as empty, without words and labels; repeated rows have a row each; an
    empty table gives an empty result; other columns are ignored.
    """
    return summary(license_spans(_read(spark, sf_dir, "documents")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each whole text, from byte trees of a sample of the rows that are not held out.

    Null, empty and letterless texts are ``und`` with a score of 0; repeated rows have a row
    each; an empty table gives an empty result; other columns are ignored.
    """
    return identify(_read(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by the score of their worst cut.

    Null texts are empty, a null language is ``und``; repeated rows count each; an empty
    table gives an empty result; other columns are ignored.
    """
    return collocations(_read(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of each damaged conversation.

    Nulls are one blank, but a null turn is first and has no number; rows of a null conv_id
    are one conversation; equal rows are duplicates; an empty table gives an empty result;
    other columns are ignored.
    """
    return repair(damage(_read(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_sharding": op2_sharding,
    "op3_html_text": op3_html_text,
    "op4_mixing": op4_mixing,
    "op5_near_dedup": op5_near_dedup,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_licenses": op10_licenses,
    "op11_language_id": op11_language_id,
    "op12_phrases": op12_phrases,
    "op13_conversations": op13_conversations,
}

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), o AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS nth FROM w
), p AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         1.5::DOUBLE * sum(source_size) OVER () AS whole_share
  FROM o
), q AS (
  SELECT (whole_share - used)::DOUBLE AS level_left, free::DOUBLE AS level_by FROM p
  WHERE NOT cap * free < (whole_share - used) * weight ORDER BY nth LIMIT 1
), t AS (
  SELECT source, source_size, least(level_left * weight / level_by, cap::DOUBLE) AS target FROM p, q
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN size > 0 AND ahead * 2 + size <= (target - whole * source_size) * 2 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d
), s AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p
), g AS (
  SELECT lang, k AS words, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, words, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), t AS (
  SELECT lang, count(*) AS n FROM g WHERE words = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1
), b AS (
  SELECT c.lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, max(a) AS a
  FROM c, (SELECT unnest([2, 3, 4]) AS k), (SELECT unnest([1, 2, 3, 4]) AS i)
  WHERE k < words AND i + k - 1 <= words GROUP BY ALL
), x AS (
  SELECT c.* FROM c LEFT JOIN b USING (lang, phrase) WHERE b.a IS NULL OR 100 * b.a < 100 * c.a
), e AS (
  SELECT x.lang, x.phrase, x.a, l.a AS l, r.a AS r, t.n, k AS cut,
         ((1000::HUGEINT * x.a * t.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM x JOIN (SELECT unnest([1, 2, 3, 4]) AS k) ON k < x.words
  JOIN f AS l ON l.lang = x.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN f AS r ON r.lang = x.lang AND r.phrase = array_to_string(list_slice(w, k + 1, x.words), ' ')
  JOIN t ON t.lang = x.lang
), o AS (
  SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank,
       phrase, a, l, r, n, score, cut::BIGINT AS cut
FROM o QUALIFY rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op4_mixing": OP4_SQL, "op9_exact_dedup": OP9_SQL, "op12_phrases": OP12_SQL}
