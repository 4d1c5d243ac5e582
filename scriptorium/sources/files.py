"""Reading corpora: configuration, volumes, texts, pages with front matter."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Corpus:
    """Where a corpus lies and how its volumes are named."""

    name: str
    pdf_dir: str
    output_dir: str
    vol_pattern: str
    pdf_glob: str = "*.pdf"
    language: str = "fr"
    title: str = ""


def load_corpus(path: str) -> Corpus:
    """A corpus from a TOML file; relative folders are taken from the file's own; missing required keys are an error."""
    raw = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    own = raw if "pdf_dir" in raw else next((v for v in raw.values() if isinstance(v, dict)), raw)
    missing = [k for k in ("pdf_dir", "output_dir", "vol_pattern") if k not in own]
    if missing:
        raise KeyError(f"missing: {', '.join(missing)}")
    folder = Path(path).parent
    place = lambda p: str(p if Path(p).is_absolute() else folder / p)
    return Corpus(own.get("name", folder.name), place(own["pdf_dir"]), place(own["output_dir"]), own["vol_pattern"], own.get("pdf_glob", "*.pdf"), own.get("language", "fr"), own.get("title", folder.name))


def volumes(names: DataFrame, pattern: str = r"^vol_0*([0-9]+(?:bis)?)\.pdf$") -> DataFrame:
    """(label, filename) of the file names (column name) that fit the pattern."""
    return names.select(F.regexp_extract("name", pattern, 1).alias("label"), F.col("name").alias("filename")).filter("label <> ''").distinct()


def read_volumes(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """(label, filename, path, size) of a folder's files, contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.col("length").alias("size"))
    return volumes(files.select(F.element_at(F.split("path", "/"), -1).alias("name")).distinct()).join(files.withColumn("filename", F.element_at(F.split("path", "/"), -1)), "filename")


def read_texts(spark: SparkSession, glob: str) -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def directory_parts(path: str = "path") -> list:
    """family, volume and engine from the folder that a text lies in."""
    return [F.regexp_extract(path, "([^/]+)_vol([^_/]+)_([a-z]+)", k).alias(n) for k, n in ((1, "family"), (2, "volume"), (3, "engine"))]


def front_matter(pages: DataFrame) -> DataFrame:
    """(page, field, value) of the scalar fields of pages' (page, text) front matter, values as text without quotes; list items as one field each, numbered."""
    block = F.regexp_extract("text", r"(?s)\A---\n(.*?)\n---", 1)
    rows = pages.select("page", F.posexplode(F.split(block, "\n")).alias("k", "row")).filter("row <> ''")
    field = F.regexp_extract("row", r"^([A-Za-z_]+):", 1)
    from pyspark.sql import Window

    held = rows.withColumn("field", F.last(F.nullif(field, F.lit("")), ignorenulls=True).over(Window.partitionBy("page").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)))
    value = F.trim(F.regexp_replace(F.regexp_replace("row", r"^(?:[A-Za-z_]+:|\s*-)\s*", ""), "^[\"']|[\"']$", ""))
    return held.select("page", "field", "k", value.alias("value")).filter("value <> ''")


