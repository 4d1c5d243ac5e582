"""Operators on figures and captions: pairing, lookup, blocks."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V
from scriptorium.operators.lineage import spread


def nearest(captions: DataFrame, figures: DataFrame, by: list[str]) -> DataFrame:
    """Captions (by, cap_idx) with the position of the nearest figure (by, fig_idx) of their page; ties go to the lower.

    The figures of a page are looked up by one window over both sides, so no
    caption is compared with every figure.
    """
    both = figures.select(*by, F.col("fig_idx").alias("pos"), F.lit(0).alias("side")).unionByName(captions.select(*by, F.col("cap_idx").alias("pos"), F.lit(1).alias("side")))
    fig = F.when(F.col("side") == 0, F.col("pos"))
    up = Window.partitionBy(*by).orderBy("pos", "side").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by).orderBy(F.desc("pos"), "side").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("lo", F.last(fig, ignorenulls=True).over(up)).withColumn("hi", F.last(fig, ignorenulls=True).over(down)).filter("side = 1")
    pick = F.when(F.col("hi").isNull() | (F.col("pos") - F.col("lo") <= F.col("hi") - F.col("pos")), F.coalesce("lo", "hi")).otherwise(F.col("hi"))
    return placed.select(*by, F.col("pos").alias("cap_idx"), pick.alias("fig_pos"))


def zipped(figures: DataFrame, captions: DataFrame, by: list[str]) -> DataFrame:
    """The i-th figure with the i-th caption of a page; figures left over get '(no caption)', captions left over no figure."""
    f = figures.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("fig_ord"))).select(*by, "rn", "figure")
    c = captions.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy("cap_ord"))).select(*by, "rn", "caption")
    joined = f.join(c, [*by, "rn"], "full_outer")
    return joined.withColumn("caption", F.when(F.col("caption").isNull(), "(no caption)").otherwise(F.col("caption")))


def overlaid(low: DataFrame, high: DataFrame, key: str) -> DataFrame:
    """Rows of both (key, path), those of high before those of low."""
    return low.withColumnRenamed("path", "lo").join(high.withColumnRenamed("path", "hi"), key, "full_outer").select(key, F.coalesce("hi", "lo").alias("path"))


def _most_deleted(n: int, cutoff: float) -> int:
    """The most letters that a name of n letters can have beside what it shares with one no longer than itself at a ratio of cutoff."""
    best = 0
    for shorter in range(n + 1):
        apart = int((1 - cutoff) * (n + shorter) + 1e-9)  # letters of either that are not shared
        over = n - shorter
        if apart >= over:
            best = max(best, (apart + over) // 2)
    return best


def _similarity_keys(name: str, cutoff: float, short: int = 20) -> set[str]:
    """Keys of which two names share one if their ratio is at least cutoff (0.88 or more).

    Up to short letters: what is left without so many letters as may differ, so
    a key is nearly a whole name and none is hot.  From 16 letters on also runs
    of four: a longer pair of that ratio shares one, as the letters that differ
    leave too few pieces for all runs to be shorter.
    """
    keys = set()
    if len(name) <= short:
        level = {name}
        keys |= level
        for _ in range(_most_deleted(len(name), cutoff)):
            level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
            keys |= level
    if len(name) >= 16:
        keys |= {"\u0001" + name[i : i + 4] for i in range(len(name) - 3)}
    return keys


def similar_names(queries: DataFrame, names: DataFrame, cutoff: float = V.CUTOFF, others: bool = False) -> DataFrame:
    """(query, match, ratio): for each query the most similar name by matching blocks, at least cutoff; ties go to the greater name.

    With others, a name equal to the query is no match of it.  Candidates meet on keys by an equi-join; the exact ratio decides.
    """

    def keyed(df: DataFrame, col: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = [(k, n) for n in pdf[col] for k in _similarity_keys(n, cutoff)]
                for at in range(0, max(1, len(rows)), 100_000):
                    yield pd.DataFrame(rows[at : at + 100_000], columns=["k", col])

        return spread(df.select(col).filter(F.length(col) > 0).distinct(), col).mapInPandas(run, f"k string, {col} string")

    # a name has hundreds of keys, which the planner does not see: left to it, they would be broadcast
    likely = keyed(queries, "query").join(keyed(names, "name").hint("merge"), "k").select("query", "name").distinct()
    likely = likely.filter("query <> name") if others else likely
    likely = likely.filter(2 * F.least(F.length("query"), F.length("name")) >= cutoff * (F.length("query") + F.length("name")))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ratios = [difflib.SequenceMatcher(None, b, a).ratio() for a, b in zip(pdf["query"], pdf["name"])]
            yield pd.DataFrame({"query": pdf["query"], "name": pdf["name"], "ratio": ratios})

    scored = likely.select("query", "name").mapInPandas(score, "query string, name string, ratio double").filter(F.col("ratio") >= cutoff)
    return scored.groupBy("query").agg(F.max(F.struct("ratio", "name")).alias("m")).select("query", F.col("m.name").alias("match"), F.round("m.ratio", 6).alias("ratio"))


def found_for(terminals: DataFrame, figures: DataFrame) -> DataFrame:
    """Terminals (key_genus, terminal_name) with a figure (genus, epithet, ord, path): by genus and epithet, else by epithet alone (first in order), else by the most similar epithet."""
    t = terminals.withColumn("epi", S.figure_epithet(F.col("terminal_name"))).withColumn("g", F.lower(F.coalesce("key_genus", F.lit(""))))
    exact = figures.select(F.col("genus").alias("g"), F.col("epithet").alias("epi"), F.col("path").alias("p1"))
    alone = figures.groupBy(F.col("epithet").alias("epi")).agg(F.min_by("path", "ord").alias("p2"))
    close = similar_names(t.select(F.col("epi").alias("query")).filter("query is not null"), figures.select(F.col("epithet").alias("name")).distinct()).select(F.col("query").alias("epi"), F.col("match").alias("epi3"))
    out = t.join(exact, ["g", "epi"], "left").join(alone, "epi", "left").join(close, "epi", "left")
    out = out.join(exact.select("g", F.col("epi").alias("epi3"), F.col("p1").alias("p3")), ["g", "epi3"], "left").join(alone.select(F.col("epi").alias("epi3"), F.col("p2").alias("p4")), "epi3", "left")
    level = F.when(F.col("epi").isNull(), None).when(F.col("p1").isNotNull(), "exact").when(F.col("p2").isNotNull(), "epithet").when(F.col("p3").isNotNull() | F.col("p4").isNotNull(), "similar")
    return out.select("key_genus", "terminal_name", F.when(F.col("epi").isNotNull(), F.coalesce("p1", "p2", "p3", "p4")).alias("path"), level.alias("match_level"))


def figure_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, block_no, path, caption, plate, species) of figure lists: blocks between rules that hold an image."""
    blocks = docs.select("doc_id", F.posexplode(F.split("text", r"\n---\n")).alias("block_no", "block"))
    path = F.regexp_extract("block", r"!\[.*?\]\(figures/(fig_\S+?)\)", 1)
    cap = S.caption_of(F.col("block"))
    pair = r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b"
    pairs = F.arrays_zip(F.regexp_extract_all(cap, F.lit(pair), F.lit(1)).alias("g"), F.regexp_extract_all(cap, F.lit(pair), F.lit(2)).alias("e"))
    named = F.transform(F.filter(pairs, lambda x: ~x["g"].isin(V.SKIP_WORDS)), lambda x: F.lower(F.concat(x["g"], F.lit(":"), x["e"])))
    return blocks.filter(path != "").select("doc_id", "block_no", path.alias("path"), cap.alias("caption"), F.upper(F.nullif(F.regexp_extract(cap, V.PLATE, 1), F.lit(""))).alias("plate"), F.array_distinct(named).alias("species"))


# Fixed value: how a text names a plate.
PLATE_REF = r"(?i)(?:^#{1,6}\s+[0-9]+\.\s+)?([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})[^()\n]*\(PL\.?\s*([IVXLC]+)\)"


def plate_references(docs: DataFrame) -> DataFrame:
    """(doc_id, species, plate): species named with a plate, each once, at its first place."""
    hits = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(PLATE_REF), F.lit(k)).alias(n) for k, n in ((1, "g"), (2, "e"), (3, "p"))])
    rows = docs.select("doc_id", F.posexplode(hits).alias("k", "h")).select("doc_id", "k", F.lower(F.concat("h.g", F.lit(":"), "h.e")).alias("species"), F.upper("h.p").alias("plate"))
    return rows.groupBy("doc_id", "species").agg(F.min_by("plate", "k").alias("plate"))
