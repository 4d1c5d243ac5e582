"""Queries of the core's own operators for training data (problem 3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators import nested


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/key_datasets.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.key_links(_payloads(spark, sf_dir))


def p3_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of nodes with the typed fields and the keys around each."""
    t = nested.key_tables(_payloads(spark, sf_dir))["nodes"]
    return t.select(
        F.col("rec_id").alias("dataset_id"), F.array_join("lineage", "/").alias("parent_key"), F.col("own_key").alias("node_key"),
        F.col("num").cast("int").alias("num"), F.coalesce("prime", F.lit("")).alias("prime"), F.col("is_terminal").cast("boolean").alias("is_terminal"),
        "terminal_name", F.col("leads_to").cast("int").alias("leads_to"), F.length("text").cast("long").alias("text_len"),
    ).distinct()


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different rows of each table, and rows at each depth of nesting, by dataset."""
    links = nested.key_links(_payloads(spark, sf_dir))
    depth = F.when(F.col("kind") == "node", F.size(F.split("parent_key", "/"))).otherwise(0).alias("depth")
    return links.groupBy("dataset_id", "kind", depth).agg(F.count("*").alias("n_rows"), F.sum(F.length("child_key")).alias("key_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p3_found": p3_found, "p3_nodes": p3_nodes, "p3_counts": p3_counts}
_OBJ = "(SELECT dataset_id, coalesce(j->'data', j) AS o FROM (SELECT dataset_id, CAST(payload AS JSON) AS j FROM key_datasets WHERE payload IS NOT NULL AND json_valid(payload)))"


def members(c: str, key: str) -> str:
    """Members of a container, object or array, as a list of (k, v)."""
    return (
        f"(CASE json_type({c}) WHEN 'OBJECT' THEN list_transform(json_keys({c}), lambda k: {{'k': k, 'v': json_extract({c}, '$.\"' || k || '\"')}}) "
        f"WHEN 'ARRAY' THEN list_transform(from_json({c}, '[\"JSON\"]'), lambda v: {{'k': v->>'{key}', 'v': v}}) END)"
    )


_KEYS = "CASE WHEN json_type(o->'keys') = 'VARCHAR' THEN CAST(o->>'keys' AS JSON) ELSE o->'keys' END"
#: The keys of key files in SQL, as ks.
KEYS = f"""
    src AS {_OBJ},
    ks AS (
        SELECT dataset_id, m.k AS k, m.v AS v FROM (SELECT dataset_id, unnest({members('c', 'id')}) AS m FROM (SELECT dataset_id, {_KEYS} AS c FROM src))
        WHERE json_type(m.v) = 'OBJECT')"""
_NODES = f"""
    {KEYS},
    ns AS (
        SELECT dataset_id, par, m.k AS k, m.v AS v FROM (SELECT dataset_id, k AS par, unnest({members("(v->'nodes')", 'node_key')}) AS m FROM ks) WHERE json_type(m.v) = 'OBJECT'
        UNION ALL
        SELECT dataset_id, par, m.k, m.v FROM (SELECT dataset_id, par || '/' || k AS par, unnest({members("(v->'children')", 'node_key')}) AS m FROM ns)
        WHERE json_type(m.v) = 'OBJECT')"""
_LINK = "CASE json_type(m.v) WHEN 'OBJECT' THEN m.v->>'key' ELSE m.v->>'$' END"
_LINKS = f"""
    SELECT dataset_id, 'key' AS kind, '' AS parent_key, k AS child_key FROM ks
    UNION SELECT dataset_id, 'node', par, k FROM ns
    UNION SELECT dataset_id, 'figure', '', m.k FROM (SELECT dataset_id, unnest({members("(o->'figures')", 'slug')}) AS m FROM src) WHERE json_type(m.v) = 'OBJECT'
    UNION SELECT dataset_id, 'genus_link', {_LINK}, m.k FROM (SELECT dataset_id, unnest({members("(o->'genus_links')", 'genus')}) AS m FROM src)
        WHERE json_type(m.v) <> 'NULL' AND {_LINK} IS NOT NULL
    UNION SELECT dataset_id, 'default_key', '', o->>'default_key' FROM src WHERE o->>'default_key' IS NOT NULL"""
SQL: dict[str, str] = {
    "p3_found": f"WITH RECURSIVE {_NODES} {_LINKS}",
    "p3_nodes": f"""
        WITH RECURSIVE {_NODES}
        SELECT DISTINCT dataset_id, par AS parent_key, k AS node_key, CAST(v->>'num' AS INTEGER) AS num, coalesce(v->>'prime', '') AS prime,
               CAST(v->>'is_terminal' AS BOOLEAN) AS is_terminal, v->>'terminal_name' AS terminal_name, CAST(v->>'leads_to' AS INTEGER) AS leads_to, length(v->>'text') AS text_len
        FROM ns""",
    "p3_counts": f"""
        WITH RECURSIVE {_NODES}, links AS ({_LINKS})
        SELECT dataset_id, kind, CASE kind WHEN 'node' THEN CAST(len(string_split(parent_key, '/')) AS INTEGER) ELSE 0 END AS depth, count(*) AS n_rows, CAST(sum(length(child_key)) AS BIGINT) AS key_chars
        FROM links GROUP BY ALL""",
}
