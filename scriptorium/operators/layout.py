"""Operators on laid-out pages: items to lines, sizes, headings, captions, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V


def visual_lines(items: DataFrame, *page: str) -> DataFrame:
    """Lines of items (page columns, ord, text, x, y, size): band of y (half-even), text by x, largest size, mean y."""
    band = F.bround(F.col("y") / F.lit(V.Y_STEP), 0).cast("int")
    grouped = items.withColumn("band", band).groupBy(*page, "band").agg(
        F.array_sort(F.collect_list(F.struct("x", "ord", "text"))).alias("ts"), F.max("size").alias("size"), F.avg("y").alias("mean_y")
    )
    return grouped.select(*page, "band", S.joined(F.transform("ts", lambda t: t["text"])).alias("line"), "size", "mean_y")


def body_size(items: DataFrame, *page: str) -> DataFrame:
    """The commonest size of each page's items, of equally common ones the first seen."""
    counted = items.groupBy(*page, "size").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return counted.groupBy(*page).agg(F.max_by("size", F.struct("n", -F.col("first"))).alias("body"))


def is_margin(mean_y: Column, height: Column) -> Column:
    """A running header or footer, by where it stands."""
    return (mean_y < height * V.TOP_FRACTION) | (mean_y > height * V.BOTTOM_FRACTION)


def page_markdown(items: DataFrame, heights: DataFrame) -> DataFrame:
    """(page, band, kind, md) of laid-out items: lines of pages as markdown, captions apart.

    Margins are left out, broken capitals mended; a caption goes on over smaller
    lines that begin with a dash or without a capital; then key headings, species
    headings and headings by size.
    """
    lines = visual_lines(items, "page").join(body_size(items, "page"), "page").join(heights, "page")
    kept = lines.filter(~is_margin(F.col("mean_y"), F.col("height")) & (F.col("line") != "")).withColumn("raw", S.mixed_case(F.col("line")))
    begins = S.is_caption(F.col("raw"))
    goes_on = (F.col("size") < F.col("body")) & (F.col("raw").startswith("–") | ~F.col("raw").rlike(r"^\p{Lu}"))
    w = Window.partitionBy("page").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    runs = kept.withColumn("run", F.sum((begins | ~goes_on).cast("int")).over(w)).withColumn("cap", F.first(begins).over(Window.partitionBy("page", "run").orderBy("band")))
    md = F.when(F.col("raw").rlike(V.KEY_LINE) | S.is_species_heading(F.col("raw")), F.concat(F.lit("### "), "raw")).otherwise(S.font_heading(F.col("size"), F.col("body"), F.col("raw")))
    caps = runs.filter("cap").groupBy("page", "run").agg(F.min("band").alias("band"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("band", "raw"))), lambda x: x["raw"]), " ").alias("md"))
    return runs.filter("not cap").select("page", "band", F.lit("text").alias("kind"), md.alias("md")).unionByName(caps.select("page", "band", F.lit("caption").alias("kind"), "md"))


def block_markdown(blocks: DataFrame, *doc: str) -> DataFrame:
    """(doc columns, page_num, block_idx, md, fig_no) of layout blocks (page_num, block_idx, label, content): running heads, captions and unknown labels vanish, figures are numbered across the pages of a document from 0."""
    own = F.lit(None).cast("string")
    for label, prefix in V.HEADING_PREFIX.items():
        own = F.when(F.col("label") == label, prefix).otherwise(own)
    known = F.col("label").isin(V.TEXT_LABELS + list(V.HEADING_PREFIX) + ["table"] + V.FIGURE_LABELS)
    is_figure = F.col("label").isin(V.FIGURE_LABELS)
    kept = blocks.filter(known & ~F.col("label").isin(V.IGNORE_LABELS) & (is_figure | (F.trim("content") != "")))
    pages = kept.filter(is_figure).groupBy(*doc, "page_num").agg(F.count("*").alias("n"))
    # numbers run on over the pages of a volume: counts by page first, then places inside a page
    before = pages.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy(*(doc or [F.lit(0)])).orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy(*doc, "page_num", "is_fig").orderBy("block_idx")) - 1
    numbered = kept.withColumn("is_fig", is_figure).withColumn("inside", inside).join(before, [*doc, "page_num"], "left").withColumn("fig_no", F.when(F.col("is_fig"), F.col("base") + F.col("inside")).cast("int"))
    taxon = F.when(F.length("content") <= 80, S.taxon_level(F.col("content")))
    md = F.when(F.col("is_fig"), S.placeholder(F.col("fig_no"), F.col("page_num") + 1)).when(F.col("label") == "table", F.col("content")).otherwise(F.concat(F.coalesce(taxon, own, F.lit("")), F.trim("content")))
    return numbered.select(*doc, "page_num", "block_idx", md.alias("md"), "fig_no")
