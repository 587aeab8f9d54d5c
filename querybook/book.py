"""Registration, and the SQL that derives the curation tables from the raw ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# One row per sample.
DOCS = """docs AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS sample_id, d.doc_id AS ord,
         'doc/' || d.doc_id AS filepath, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

SAMPLES = """samples AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, o_orderkey AS ord,
         'order/' || o_orderkey AS filepath, o_orderstatus AS tag_1,
         o_orderpriority AS tag_2, o_totalprice AS score, o_orderdate AS created_at
  FROM orders
)"""

# One row per label, with its place in the sample's list.
DETECTIONS = """detections AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, o_orderkey AS ord,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         l_returnflag AS label, l_quantity / 50.0 AS confidence, l_linestatus AS tag,
         l_discount * 5 + 0.0 AS x, l_tax * 6.25 AS y, o_orderstatus AS tag_1,
         o_orderpriority AS tag_2,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey) AS place
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)"""

TURNS = """turns AS (
  SELECT concat_ws('-', conv_id, turn) AS sample_id, conv_id AS group_id,
         role AS slice, 'text' AS media_type, turn, text
  FROM conversations
)"""

# Cosine similarity of all ordered pairs of distinct samples.
PAIRS = """v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS cosine
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
)"""


def query(name: str, sql: str | None = None, using: tuple[str, ...] = ()):
    """Register a query and its SQL; ``using`` are the common tables the SQL reads."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = build
        if sql is not None:
            prefix = "WITH RECURSIVE " + ", ".join(using) + " " if using else ""
            ORACLE[name] = prefix + sql.strip()
        return build

    return register
