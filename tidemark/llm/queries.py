"""One query an operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, clustering, conversation_repair, mixing, quality_rules
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.fingerprints import edited_fingerprints
from tidemark.llm.html_extract import html_extract
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.pseudonyms import pseudonyms
from tidemark.llm.token_store import token_store
from tidemark.llm.toxicity import toxicity
from tidemark.llm.url_filter import host_of, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(_table(spark, sf_dir, "pages"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: Dated entries of hand-kept lists: domains, hosts and path prefixes.
LISTS = """('spam', 'spam-farm.example.com', 'add', DATE '2024-01-10'), ('spam', 'spam-farm.example.org', 'add', DATE '2024-02-01'),
  ('spam', 'spam-farm.example.org', 'remove', DATE '2024-06-01'), ('spam', 'spam-farm.example.org', 'add', DATE '2024-09-15'),
  ('pills', 'cheap-pills.example.com', 'add', DATE '2024-01-01'), ('pills', 'cheap-pills.example.com', 'remove', DATE '2024-12-01'),
  ('gambling', 'casino-win.example.com', 'add', DATE '2024-03-05'), ('gambling', 'free-bets.example.com', 'add', DATE '2024-03-05'),
  ('gambling', 'free-bets.example.com', 'add', DATE '2024-05-05'), ('ads', 'ads-track.example.com', 'remove', DATE '2024-01-05'),
  ('ads', 'ads-track.example.com', 'add', DATE '2024-01-05'), ('ads', 'ads-track.example.com', 'add', DATE '2024-04-01'),
  ('adult', 'adult-x.example.net', 'add', DATE '2023-12-31'), ('german', 'www.thering.example.org/de', 'add', DATE '2024-02-20')"""


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages; a page's day of fetch follows from its id.

    Beside the hand-kept lists there is one as long as the table has hosts: an
    eighth of the hosts come and go on dates that follow from their names.
    """
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int")).alias("fetched"))
    host = host_of(F.col("url"))
    n = F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("int")
    hosts = pages.select(host.alias("host")).filter("host != ''").distinct().filter(n % 8 == 0)
    day = F.date_add(F.lit("2024-01-01").cast("date"), n % 200)
    listed = hosts.select(F.lit("hosts").alias("list"), F.col("host").alias("pattern"), F.explode(F.array(F.struct(F.lit("add").alias("action"), day.alias("date")), F.struct(F.lit("remove").alias("action"), F.date_add(day, 120).alias("date")))).alias("x")).select("list", "pattern", "x.*")
    static = spark.sql(f"SELECT * FROM VALUES {LISTS} AS t(list, pattern, action, date)")
    return url_filter(pages, static.unionByName(listed))


_URL_ORACLE = rf"""
WITH p AS (SELECT page_id, url, (DATE '2024-01-01' + ((page_id * 7919) % 366)::INTEGER)::DATE AS fetched, rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9a-f:.]+\]|[^/?#:\[]+)', 1), '.') AS host,
      list_filter(string_split(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS parts FROM pages),
h AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 7))::INTEGER AS n FROM p WHERE host <> ''),
e AS (SELECT * FROM (VALUES {LISTS}) t(list, pattern, action, date)
      UNION ALL SELECT 'hosts', host, 'add', (DATE '2024-01-01' + (n % 200)::INTEGER)::DATE FROM h WHERE n % 8 = 0
      UNION ALL SELECT 'hosts', host, 'remove', (DATE '2024-01-01' + (n % 200 + 120)::INTEGER)::DATE FROM h WHERE n % 8 = 0),
d AS (SELECT list, pattern, date, max(action) AS action FROM e GROUP BY ALL),
m AS (SELECT p.*, d.list, d.pattern, arg_max(d.action, d.date) AS action,
      (SELECT max(x.date) FROM d x WHERE x.list = d.list AND x.pattern = d.pattern AND x.action = 'add' AND x.date <= p.fetched
        AND NOT EXISTS (SELECT 1 FROM d y WHERE y.list = x.list AND y.pattern = x.pattern AND y.action = 'add' AND y.date < x.date
          AND NOT EXISTS (SELECT 1 FROM d z WHERE z.list = x.list AND z.pattern = x.pattern AND z.action = 'remove' AND z.date > y.date AND z.date < x.date))) AS since
      FROM p JOIN d ON d.date <= p.fetched AND (p.host = d.pattern OR (ends_with(p.host, '.' || d.pattern) AND contains(d.pattern, '.') AND NOT regexp_matches(p.host, '^[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}$'))
        OR (contains(d.pattern, '/') AND starts_with(p.host || '/' || array_to_string(p.parts, '/') || '/', d.pattern || '/')))
      GROUP BY p.page_id, p.url, p.fetched, p.host, p.parts, d.list, d.pattern),
a AS (SELECT page_id, url, fetched, count(*) AS n_active, first(struct_pack(list := list, pattern := pattern, since := since) ORDER BY -length(pattern), list, pattern) AS r FROM m WHERE action = 'add' GROUP BY page_id, url, fetched)
SELECT p.page_id, p.url, p.fetched, p.host, coalesce(n_active, 0)::BIGINT AS n_active, n_active IS NOT NULL AS blocked, r.list AS list, r.pattern AS pattern, r.since AS since
FROM p LEFT JOIN a ON p.page_id = a.page_id AND p.url IS NOT DISTINCT FROM a.url AND p.fetched = a.fetched"""

#: The key of the registered query; a deployment passes its own secret.
DEMO_KEY = "tidemark-demo-key"


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(_table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{control}'), (-7L, 1L, 'assistant', '{control}') AS t(conv_id, turn, role, text)")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.chat_format(rows.unionByName(more))


def tokenizer_path() -> str:
    """Where the public tokenizers' files are on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, seed=2)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(_table(spark, sf_dir, "conversations")))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_rules, op2_mixing, op3_html_extraction, op4_ngram_join, op5_decontamination, op6_url_filters, op7_pseudonyms, op8_chat_formatting, op9_token_output, op10_toxicity, op11_centroid_clustering, op12_conversation_repair, op13_document_fingerprints]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules.oracle(), "op2_mixing": mixing.ORACLE, "op6_url_filters": _URL_ORACLE, "op8_chat_formatting": chat_format.ORACLE, "op11_centroid_clustering": clustering.oracle(), "op12_conversation_repair": conversation_repair.ORACLE}
