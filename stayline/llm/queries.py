"""The registered queries of this subpackage, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    periodic_runs,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packing_model(path: str | None = None) -> str:
    """The tokenizer's definition; read by the driver and sent along, so executors need no file."""
    import public_tokenizers

    return Path(path or public_tokenizers.path("byte_bpe_50k.json")).read_text()


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(table(spark, folder, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(table(spark, folder, "documents"), packing_model())


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(table(spark, folder, "documents"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, folder, "documents"))


@query("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query(
    "op9_warc",
    r"""
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), g AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM g
    """,
)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query(
    "op10_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
    ), g AS (
        SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
        FROM n
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
    """,
)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents")).drop("row_id")


def repeat_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """A tenth of all texts, by a checksum of the id, repeat a part of themselves to the end; null ids change nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digest(table(spark, folder, "documents"), change=repeat_tail)


@query("op12_alignment")
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.link_figures(table(spark, folder, "documents"), *alignment.models())


@query(
    "op13_line_dedup",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), l AS (
        SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d
    ), x AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l
    ), hot AS (
        SELECT key FROM x WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
    )
    SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
    FROM x LEFT JOIN hot ON x.key = hot.key
    GROUP BY r, doc_id
    """,
)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(table(spark, folder, "documents"))
