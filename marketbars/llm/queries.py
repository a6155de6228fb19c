"""The training-data operators over the given tables, with DuckDB SQL where SQL
can state the same result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm.common import ship_package, table

LLM_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        LLM_QUERIES[name] = (run, sql)
        return run
    return wrap


# ---- 2: benchmark decontamination ------------------------------------------

@query("op2_decontaminate", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
         array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i
        FROM b WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lengths
        WHERE len(ws) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, t.item_id
         FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.n = t.n),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM hits),
counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
          FROM hits GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.decontaminate import find_leaks, leak_digest
    return leak_digest(find_leaks(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark")))


# ---- 3: quality classifier --------------------------------------------------

@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---- 4: approximate nearest neighbours --------------------------------------

QUERY_STEP = 50


@query("op4_nearest")
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.one_bit_search import nearest
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), k=5)


# ---- 5: token-ID / binary output --------------------------------------------

def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.token_files import read_token_files, write_token_files
    from marketbars.session import scratch_path
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_file(), folder)
    return read_token_files(manifest, folder)


# ---- 9: mixing sources to target weights -------------------------------------

@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.mixing import mix_sources
    return (mix_sources(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


# ---- 10: URL filter ------------------------------------------------------------

URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query("op10_url_filter", r"""
WITH rules(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fits AS (
  SELECT s.page_id, s.host, s.path, r.rh || r.rp AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id
                            ORDER BY length(r.rh || r.rp) DESC NULLS LAST, length(r.rh) DESC) AS k
  FROM split s LEFT JOIN rules r
    ON (s.host = r.rh OR ends_with(s.host, '.' || r.rh)) AND starts_with(s.path, r.rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.url_filter import judge_urls
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


# ---- 6: n-gram Jaccard join ------------------------------------------------------

@query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.jaccard_join import link_texts
    return (link_texts(table(spark, sf_dir, "documents"), words=4, percent=85)
            .select("doc_id", "n_shingles", "component_id"))


# ---- 1: line dedup -----------------------------------------------------------------

@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.line_dedup import dedup_report
    return dedup_report(table(spark, sf_dir, "documents"))


# ---- 7: license scans ----------------------------------------------------------------

def document_path():
    """A file tree for the documents, which have no paths: four levels by source,
    language and id, in which every tenth document is its directory's licence file
    (those of round numbers stand one and two levels up)."""
    i = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")))
    block = F.floor(i / 1000).cast("string")
    leaf = F.floor(i / 100).cast("string")
    return (F.when(i % 1000 == 0, F.concat_ws("/", top, F.concat(F.lit("LICENSE."), i)))
            .when(i % 100 == 0, F.concat_ws("/", top, block, F.concat(F.lit("LICENSE."), i)))
            .when(i % 10 == 0, F.concat_ws("/", top, block, leaf, F.concat(F.lit("LICENSE."), i)))
            .when(i.isNotNull(), F.concat_ws("/", top, block, leaf, F.concat(i, F.lit(".txt")))))


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.license_scan import scan_licenses
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), document_path().alias("path"), "text")
    return scan_licenses(files, all_words=True).select(
        F.col("id").alias("doc_id"), "path", "own", F.round("score", 9).alias("score"),
        "license", "from_dir")


# ---- 8: substring dedup ---------------------------------------------------------------

@query("op8_sentence_spans")
def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.sentence_spans import span_report
    return span_report(table(spark, sf_dir, "documents"))


# ---- 11: collocations --------------------------------------------------------------------

@query("op11_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
sized AS (SELECT lang, ws, unnest([1, 2, 3, 4]) AS k FROM pieces WHERE len(ws) > 0),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM sized WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, 2000000 * c.a // (l.a + r.a) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
              JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:c.k], ' ')),
least_cut AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, a, k, ws, size, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS size FROM c)) GROUP BY 1, 2),
kept AS (
  SELECT s.* FROM least_cut s LEFT JOIN inside i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * s.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


# ---- 12: HTML extraction --------------------------------------------------------------------

@query("op12_main_text")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.page_template import extract_pages
    return extract_pages(table(spark, sf_dir, "pages"))


# ---- 13: cross-tokenizer alignment -----------------------------------------------------------

@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketbars.llm.token_alignment import alignment_report
    return alignment_report(table(spark, sf_dir, "documents"), tokenizer_file(),
                            tokenizer_file("piece_bpe_32k.model"))
