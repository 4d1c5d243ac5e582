"""Writing results: documents, figure lists, metadata, taxa, keys, failures.

Partitions follow volume and family, so a later run of one family replaces only
its own folder; what is complete is listed in a small table beside them, which
is written last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METADATA = "vol_label string, family string, engine string, pdf string, dpi int, page_count int, figure_count int, char_count int, elapsed_seconds double, completed_at timestamp"


def write_documents(docs: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Texts by volume and family; only the partitions at hand are replaced, and listed as complete in <folder>/_complete afterwards."""
    docs.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("volume", "family").parquet(folder)
    docs.select("volume", "family").distinct().write.mode("append").parquet(f"{folder}/_complete")


def write_images(figures: DataFrame, folder: str) -> None:
    """Figure bytes as a binary column beside their names."""
    figures.write.mode("overwrite").parquet(folder)


def write_taxa(taxa: DataFrame, folder: str) -> None:
    """The taxon index as JSON lines and as quoted tab-separated text with a header."""
    taxa.write.mode("overwrite").json(f"{folder}/json")
    taxa.write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{folder}/tsv")


def write_text(lines: DataFrame, folder: str) -> None:
    """One text row for each document (column text)."""
    lines.select("text").write.mode("overwrite").text(folder)


def write_cache(blocks: DataFrame, folder: str) -> None:
    """Raw results of an engine, to start again from without it."""
    blocks.write.mode("overwrite").parquet(folder)


def write_failures(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with an error put aside (appended); the others are returned."""
    rows.filter("error is not null").write.mode("append").json(folder)
    return rows.filter("error is null").drop("error")


def unified_metadata(*layouts: DataFrame) -> DataFrame:
    """Run metadata of several layouts in one, missing fields null."""
    out = layouts[0]
    for layout in layouts[1:]:
        out = out.unionByName(layout, allowMissingColumns=True)
    fields = [f.rsplit(" ", 1) for f in METADATA.split(", ")]
    return out.select(*[(F.col(n) if n in out.columns else F.lit(None)).cast(k).alias(n) for n, k in fields])


def provenance(model: str, source: Column) -> Column:
    """The header comment of a translation: model, day (UTC) and kind of source."""
    return F.concat(F.lit(f"<!-- translated by {model} on "), F.date_format(F.current_timestamp(), "yyyy-MM-dd"), F.lit(" from "), source, F.lit(" -->"))
