"""Registered queries of the operators, over whole tables, and the DuckDB twins of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import (
    byte_bpe,
    collocations,
    exact_dedup,
    html_text,
    merkle_manifest,
    mixing,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_counts,
    topk,
    warc_fixity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its chances, its site's rates, and whether it stays."""
    return quality.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_shared_windows(_documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


DAMAGE_EVERY, CHANGED, LOST = 97, 13, 31


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit all pages, laid out as WARC records, against a replica with known damage.

    In the replica one page of ``DAMAGE_EVERY`` has its first byte overwritten and another is lost.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    turn = F.pmod(F.col("page_id"), F.lit(DAMAGE_EVERY))
    body = F.when(turn == CHANGED, F.overlay("html", F.lit("#"), F.lit(1), F.lit(1))).otherwise(F.col("html"))
    sound, other = (warc_fixity.record_bytes(F.col("url"), b) for b in (F.col("html"), body))
    hashed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.octet_length(sound).cast("bigint").alias("n_bytes"),
        F.octet_length(other).cast("bigint").alias("n_other"),
        warc_fixity.leaf(sound).alias("digest"),
        warc_fixity.leaf(other).alias("other"),
        F.coalesce(turn != LOST, F.lit(True)).alias("there"),
    )
    laid = stored(warc_fixity.archived(hashed, ["page_id", "url", "digest"]))
    first = laid.select("archive", "offset", "n_bytes", "digest")
    second = laid.where("there").select("archive", "offset", F.col("n_other").alias("n_bytes"), F.col("other").alias("digest"))
    found = warc_fixity.audit(first, second).join(laid.select("archive", "offset", "page_id"), ["archive", "offset"])
    return found.select("page_id", "status", "first_sha256", "second_sha256")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_groups(_documents(spark, sf_dir))


def op9_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(_documents(spark, sf_dir), tokenizer, public_tokenizers.PATTERN)


def op11_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document: where it lies, and the checksum of its ids."""
    files = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    found = packing.pack_documents(_documents(spark, sf_dir), *files, public_tokenizers.PATTERN)
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "row")


TAMPER_EVERY = 7


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf and its proof, against a copy in which some rows have one character more."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    change = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    found = merkle_manifest.manifest(_documents(spark, sf_dir), changed, change)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return collocations.mine(_documents(spark, sf_dir)).drop("k")


def queries() -> dict[str, Query]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_html_text": op3_html_text,
        "op4_quality": op4_quality,
        "op5_cube_mixing": op5_cube_mixing,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_warc_fixity": op7_warc_fixity,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_simhash_components": op9_simhash_components,
        "op10_token_counts": op10_token_counts,
        "op11_cost_packing": op11_cost_packing,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_collocations": op13_collocations,
    }


OP1 = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

OP6 = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, i, list_slice(ws, i, i + 12) AS gram
  FROM split, unnest(range(1, len(ws) - 11)) AS t(i)
), begun AS (
  SELECT gram, min(doc_id) AS earliest FROM starts GROUP BY gram
), gone AS (
  SELECT DISTINCT doc_id, i + j AS k
  FROM starts JOIN begun USING (gram), range(13) AS r(j)
  WHERE earliest < doc_id
), words AS (
  SELECT doc_id, k, ws[k] AS word FROM split, unnest(range(1, len(ws) + 1)) AS t(k)
), kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS body
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH body AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, page_id % 97 AS turn FROM pages
  WHERE page_id % 97 IN (13, 31)
), sides AS (
  SELECT page_id, turn, url, html, '#' || substr(html, 2) AS changed FROM body
)
SELECT page_id,
       CASE turn WHEN 13 THEN 'changed' ELSE 'missing' END AS status,
       sha256(chr(0) || record(url, html)) AS first_sha256,
       CASE turn WHEN 13 THEN sha256(chr(0) || record(url, changed)) END AS second_sha256
FROM sides
"""
for _name in ("html", "changed"):
    OP7 = OP7.replace(
        f"record(url, {_name})",
        "concat('WARC/1.0', crlf, 'WARC-Type: resource', crlf, 'WARC-Record-ID: <urn:md5:', "
        f"md5(url || chr(10) || {_name}), '>', crlf, 'WARC-Date: 1970-01-01T00:00:00Z', crlf, "
        "'WARC-Target-URI: ', url, crlf, 'Content-Type: text/html', crlf, 'Content-Length: ', "
        f"strlen({_name}), crlf, crlf, {_name}, crlf, crlf)".replace("crlf", "chr(13) || chr(10)"),
    )

OP8 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# A step of a path is the sibling's digest behind its side, or empty where the node is hashed alone.
_AT = "(pos >> level)"
_STEP = f"CASE WHEN {_AT} % 2 = 1 THEN 'L' || nodes[{_AT}] WHEN {_AT} + 1 < len(nodes) THEN 'R' || nodes[{_AT} + 2] ELSE '' END"
_PAIRED = "list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], '')))"


def _leaf_sql(n_chars: str) -> str:
    columns = ("doc_id", "source", "lang", n_chars, "text")
    told = (f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in columns)
    return f"sha256({' || '.join(told)})"


OP12 = f"""
WITH RECURSIVE told AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN crc % {TAMPER_EVERY} = 0 THEN {_leaf_sql('n_chars::HUGEINT + 1')} ELSE {_leaf_sql('n_chars')} END AS other
  FROM (
    SELECT *, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, x: list_reduce(
        list_prepend(xor(crc, x), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
      )
    ), 4294967295) AS crc
    FROM documents
  )
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM told
), lower_levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, {_PAIRED} FROM lower_levels WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS pos
  FROM lower_levels WHERE len(nodes) = 1
), upper_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, {_PAIRED} FROM upper_levels WHERE len(nodes) > 1
), lower_paths AS (
  SELECT d.doc_id, d.lang, d.pos, list({_STEP} ORDER BY level) FILTER (len(nodes) > 1) AS steps
  FROM placed d JOIN lower_levels l ON d.lang IS NOT DISTINCT FROM l.lang
  GROUP BY d.doc_id, d.lang, d.pos
), upper_paths AS (
  SELECT s.lang, list({_STEP} ORDER BY level) FILTER (len(nodes) > 1) AS steps
  FROM subroots s, upper_levels GROUP BY s.lang
), whole AS (
  SELECT d.doc_id, d.leaf, d.other, s.subroot,
         list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
  FROM placed d
  JOIN lower_paths a ON d.lang IS NOT DISTINCT FROM a.lang AND d.pos = a.pos
  JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang
  JOIN upper_paths b ON d.lang IS NOT DISTINCT FROM b.lang
), folded AS (
  SELECT *, (SELECT nodes[1] FROM upper_levels WHERE len(nodes) = 1) AS root,
         list_reduce(list_prepend(other, steps), lambda h, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || h) ELSE sha256(h || x[2:]) END) AS folded_root
  FROM whole
)
SELECT doc_id, leaf, subroot, root,
       sha256(list_reduce(list_prepend('', steps), lambda a, x: a || x[2:])) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), counted AS (
  SELECT lang, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS phrase, count(*) AS f
  FROM split, unnest([1, 2, 3, 4]) AS s(size), unnest(range(1, len(ws) - size + 2)) AS t(i)
  GROUP BY lang, size, phrase HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counted WHERE size > 1
), inner_parts AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase, max(a) AS longer
  FROM candidates, unnest([2, 3]) AS s(m), unnest(range(1, size - m + 2)) AS t(i)
  WHERE m < size GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM candidates c, unnest(range(1, c.size)) AS t(k)
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(ws, 1, k), ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(ws, k + 1, c.size), ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
         phrase, a, l, r, n, score::BIGINT AS score
  FROM lowest JOIN totals USING (lang) LEFT JOIN inner_parts USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT * FROM placed WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1,
        "op6_substring_dedup": OP6,
        "op7_warc_fixity": OP7,
        "op8_exact_dedup": OP8,
        "op12_merkle_manifest": OP12,
        "op13_collocations": OP13,
    }
