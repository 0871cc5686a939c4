"""The registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import garbled, linkage, near_duplicates, packing, quality, scans, subjects, tokens, truncation
from quire.llm.base import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _subject_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in ("documents", "extractions", "subject_labels")}


def _packing_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in ("documents", "extractions", "corpus_specs")}


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: linkage.found(table(s, d, "works"), table(s, d, "catalog_records")),
        "p1_matches": lambda s, d: linkage.linked(table(s, d, "works"), table(s, d, "catalog_records")),
        "p2_found": lambda s, d: scans.found(_documents(s, d)),
        "p2_repaired": lambda s, d: scans.repaired(_documents(s, d)),
        "p3_found": lambda s, d: near_duplicates.found(_documents(s, d)),
        "p3_groups": lambda s, d: near_duplicates.grouped(_documents(s, d)),
        "p4_found": lambda s, d: quality.found(_documents(s, d)),
        "p4_statistics": lambda s, d: quality.judged(_documents(s, d)),
        "p5_found": lambda s, d: garbled.found(_documents(s, d)),
        "p5_restored": lambda s, d: garbled.garbled(_documents(s, d)),
        "p6_found": lambda s, d: subjects.found(_subject_tables(s, d)),
        "p6_composition": lambda s, d: subjects.composition(_subject_tables(s, d)),
        "p7_ids": lambda s, d: tokens.encode_corpus(_documents(s, d)),
        "p7_offsets": lambda s, d: tokens.corpus_offsets(_documents(s, d)),
        "p8_containers": lambda s, d: packing.packed(_packing_tables(s, d)),
        "p8_usage": lambda s, d: packing.usage(_packing_tables(s, d)),
        "p9_found": lambda s, d: truncation.found(_documents(s, d)),
        "p9_sources": lambda s, d: truncation.by_source(_documents(s, d)),
    }


#: Documents that count for problem 3 with their distinct runs of three words, and the share of them that two documents have in common.
RUNS = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\x0b\\f]+'), lambda x: x <> '') ws FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
  k AS (SELECT DISTINCT doc_id, ws, array_to_string(ws, ' ') whole FROM w WHERE len(ws) >= 30), e AS (SELECT doc_id, ws, min(doc_id) OVER (PARTITION BY whole) rep FROM k),
  s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) g FROM e WHERE {only}), n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
  c AS (SELECT a.doc_id a, b.doc_id b, count(*) m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2), p AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE m >= 0.5 * (x.n + y.n - m))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": RUNS.format(only="true") + " SELECT a AS doc_id_a, b AS doc_id_b FROM p",
        "p3_groups": RUNS.format(only="doc_id = rep") + ", l AS (SELECT d, count(*) n FROM (SELECT a d FROM p UNION ALL SELECT b FROM p) GROUP BY 1) SELECT e.doc_id, e.rep AS class_id, count(*) OVER (PARTITION BY e.rep) AS copies, coalesce(l.n, 0) AS links FROM e LEFT JOIN l ON l.d = e.rep",
    }
