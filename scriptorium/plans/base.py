"""Inputs that queries and their SQL share."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.documents import paged_lines
from scriptorium.operators.lineage import spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A few literal rows (fixtures); schema as DDL."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)


def sql_values(schema: str, rows: Sequence[tuple]) -> str:
    """The same rows as a SQL subquery."""

    def lit(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(map(lit, v)) + "]"
        return "'" + str(v).replace("'", "''") + "'"

    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    kinds = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}
    cols = ", ".join(f"CAST({n} AS {kinds[k]}) AS {n}" for n, k in fields)
    return f"(SELECT {cols} FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") AS v({', '.join(n for n, _ in fields)}))"


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts, dealt out by document where they come in few files; windows by document need no further shuffle then."""
    return spread(table(spark, sf_dir, "documents_md").select("doc_id", "volume", "family", "engine", "text"), "doc_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the extracts: doc_id, volume, family, engine, line_no (from 1), line."""
    return _texts(spark, sf_dir).select("doc_id", F.trim("volume").alias("volume"), "family", "engine", F.posexplode(F.split("text", "\n")).alias("p", "line")).select("doc_id", "volume", "family", "engine", (F.col("p") + 1).alias("line_no"), "line")


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with the page they stand on."""
    return paged_lines(_texts(spark, sf_dir).withColumn("volume", F.trim("volume")), "doc_id", "volume", "family", "engine")


#: The same lines in SQL.
LINES = "(SELECT doc_id, trim(volume) AS volume, family, engine, CAST(unnest(range(1, len(ls) + 1)) AS INTEGER) AS line_no, unnest(ls) AS line FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents_md))"
#: Lines with the page they stand on: 0 before the first marker.
PAGED = f"(SELECT *, coalesce(last_value(pn IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 0) AS page FROM (SELECT *, TRY_CAST(nullif(regexp_extract(line, '<!--\\s*page\\s+([0-9]+)\\s*-->', 1), '') AS INTEGER) AS pn FROM {LINES}))"
#: Characters that only a compatibility decomposition changes, and what they become; by rule, below the mathematical signs.
_COMPAT = {c: n for c, n in ((c, unicodedata.normalize("NFKD", c)) for c in map(chr, range(0xA0, 0x2200))) if n != c and unicodedata.normalize("NFD", c) == c}


def fold_sql(x: str) -> str:
    """The text x in SQL under compatibility decomposition, without marks."""
    for c, n in (("½", "1⁄2"), ("¼", "1⁄4"), ("¾", "3⁄4"), ("…", "..."), ("™", "TM")):
        x = f"replace({x}, '{c}', '{n}')"
    one = {c: n for c, n in _COMPAT.items() if len(n) == 1}
    return f"translate(strip_accents({x}), '{''.join(one)}', '{''.join(one.values())}')"


def mapped(source: Query, out: Callable[[Column], Column], name: str = "output") -> Query:
    """A query over the distinct inputs (column x) of a source: input and what a scalar function gives."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return source(spark, sf_dir).select(F.col("x").alias("input")).distinct().select("input", out(F.col("input")).alias(name))

    return run
