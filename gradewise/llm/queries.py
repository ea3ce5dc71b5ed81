"""One query per operator over whole tables, and DuckDB SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.llm.decontamination import find_leaks
from gradewise.llm.divergence import source_divergence
from gradewise.llm.exact_dedup import exact_groups
from gradewise.llm.html_extraction import extract_main_text
from gradewise.llm.licenses import BLOCK, PHRASES, TEMPLATES, scan_licenses
from gradewise.llm.line_dedup import drop_shared_lines
from gradewise.llm.mixing import mix_sources
from gradewise.llm.pii import KINDS, in_order, personal_data
from gradewise.llm.quality import held_out, score_documents
from gradewise.llm.sharding import hex_hash, shard_documents, text_bytes
from gradewise.llm.simhash import near_copies
from gradewise.llm.substring_dedup import drop_repeated_passages
from gradewise.llm.text import LOWER, UPPER
from gradewise.llm.whitening import whitened_components

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_fold(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


# Exact copies ------------------------------------------------------------------------


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op8_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {sql_fold("text")} AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t"""


# Shared lines ------------------------------------------------------------------------


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
     l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS place FROM s),
     k AS (SELECT *, {sql_fold("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
           FROM l),
     f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


# Shards ------------------------------------------------------------------------------


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        text_bytes(F.col("text")).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        hex_hash(text).alias("text_hash"),
    )
    placed = shard_documents(rows, 16, size=F.col("size"), text_hash=F.col("text_hash"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Benchmark passages ------------------------------------------------------------------


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "leaks.n_words",
        "leaks.n_hit",
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"),
        (F.col("leaks.n_hit") > 0).alias("contaminated"),
    )


# Fixed value: what separates words.
SQL_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def sql_words(text: str) -> str:
    return f"list_filter(string_split_regex({sql_fold(text)}, '{SQL_BREAKS}'), lambda x: x <> '')"


ORACLE["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
     b AS (SELECT item_id, {sql_words("text")} AS w FROM benchmark),
     windows AS (
       SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
       FROM b, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p(i) WHERE len(w) > 0),
     grams AS (
       SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
       FROM d, (SELECT DISTINCT size FROM windows) AS s, unnest(generate_series(1, len(w) - size + 1)) AS p(i)),
     hits AS (SELECT doc_id, i, g.size, item_id FROM grams g JOIN windows USING (size, gram)),
     n AS (SELECT doc_id, count(DISTINCT place) AS n_hit
           FROM hits, unnest(generate_series(i, i + size - 1)) AS p(place) GROUP BY doc_id),
     m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                  string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
           FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


# Near copies -------------------------------------------------------------------------


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_copies(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Repeated passages -------------------------------------------------------------------


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_passages(table(spark, sf_dir, "documents"))


# Quality -----------------------------------------------------------------------------


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, table(spark, sf_dir, "labels")).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


# Mixing ------------------------------------------------------------------------------


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.taken().select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "first_shard", "last_shard"
    )


# Licenses ----------------------------------------------------------------------------


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def sql_pairs(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs.items())


def sql_templates() -> str:
    return ", ".join(f"('{t.label}', '{t.wording}', '{t.telling}')" for t in TEMPLATES)


ORACLE["op2_licenses"] = f"""
WITH d AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
     phrases(phrase, label) AS (VALUES {sql_pairs(PHRASES)}),
     listed(label, wording, telling) AS (VALUES {sql_templates()}),
     templates AS (SELECT label, telling, list_distinct(string_split(wording, ' ')) AS needed FROM listed),
     places AS (
       SELECT doc_id, i - 1 AS place, label
       FROM d, phrases, unnest(generate_series(1, len(w))) AS p(i)
       WHERE array_to_string(w[i : i + len(string_split(phrase, ' ')) - 1], ' ') = phrase),
     base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                     list(DISTINCT label) AS labels
              FROM places GROUP BY doc_id),
     likely AS (  -- a run holds no more of a template than its whole text does
       SELECT doc_id, w, templates.*
       FROM (SELECT doc_id, w, list_distinct(w) AS own FROM d) AS t, templates
       WHERE len(list_intersect(own, needed)) / len(needed) >= 0.8 - 1e-9),
     runs AS (
       SELECT doc_id, label, telling, needed, w[b : b + {BLOCK - 1}] AS own
       FROM likely, unnest(generate_series(1, greatest(1, len(w) - {BLOCK - 1}))) AS p(b)),
     shares AS (SELECT *, len(list_intersect(own, needed)) / len(needed) AS share FROM runs),
     found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share
               FROM shares
               WHERE share >= 0.8 - 1e-9 AND regexp_matches(' ' || array_to_string(own, ' ') || ' ', telling)
               GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         coalesce(base.labels, []::VARCHAR[]) || coalesce(found.labels, []::VARCHAR[]))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(found.share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


# Web pages ---------------------------------------------------------------------------


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages"), into="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# Source divergence -------------------------------------------------------------------


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


# Fixed value: what separates terms.
SQL_NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE["op11_source_divergence"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  list_filter(string_split_regex({sql_fold("text")}, '{SQL_NO_TERM}'), lambda x: x <> '') AS w
           FROM documents),
     t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
     kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
     groups AS (SELECT DISTINCT lang, source FROM d),
     grid AS (SELECT groups.lang, source, kept.term, coalesce(own.n, 0) AS n
              FROM groups JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)),
     p AS (SELECT lang, source, term, n,
                  1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER (PARTITION BY lang, source)) + 5 * v) AS p
           FROM grid JOIN v USING (lang)),
     whole AS (SELECT lang, term, sum(n) AS n FROM grid GROUP BY lang, term),
     q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER (PARTITION BY lang)) + 5 * v) AS q
           FROM whole JOIN v USING (lang)),
     apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
               GROUP BY a.lang, a.source, b.source),
     found AS (
       SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
       FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
       UNION ALL
       SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""


# Whitened embeddings -----------------------------------------------------------------


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))


# Personal data -----------------------------------------------------------------------


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [number_of(kind).alias(f"n_{kind}") for kind in KINDS]
    every = in_order(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(every).alias("spans")
    )
