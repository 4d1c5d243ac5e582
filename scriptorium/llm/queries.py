"""Queries of the operators for training data, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bitext, mixing, name_variants, packing, scan_noise, spam, splitting


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.found(scan_noise.scanned_records(spark, sf_dir))


def p1_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.reflow(scan_noise.scanned_records(spark, sf_dir))


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.pieces(_table(spark, sf_dir, "documents_md"), _table(spark, sf_dir, "chunk_limits"))


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page and caption with the entity that its name means."""
    pages = name_variants.species_entities(_table(spark, sf_dir, "wiki_species")).select(F.lit("species").alias("kind"), "id", "ent")
    return pages.unionByName(name_variants.collector_entities(_table(spark, sf_dir, "figures")).select(F.lit("collector").alias("kind"), "id", "ent"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitext.aligned(_table(spark, sf_dir, "bilingual_md"))


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_windows"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p6_pack(spark, sf_dir), _table(spark, sf_dir, "pack_windows"))


def p6_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the packing keeps every constraint and places every page once and whole."""
    return packing.validity(p6_pack(spark, sf_dir), _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_windows"))


def p7_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the mix keeps the caps of repeats, the size and the shares."""
    return mixing.validity(p7_mix(spark, sf_dir), _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p2_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each extract: characters its pieces cover without overlaps, whether all pieces keep the limit, follow one another and repeat what they should, and whether none is tiny."""
    docs = _table(spark, sf_dir, "documents_md")
    limits = _table(spark, sf_dir, "chunk_limits")
    cut = splitting.pieces(docs, limits)
    bounds = docs.select("doc_id", "engine").join(F.broadcast(limits), "engine", "left")  # a row for each engine
    per = cut.groupBy("doc_id").agg(F.sum(F.col("end") - F.col("body_start")).alias("covered"), F.max(F.length("text")).alias("longest"), F.count("*").alias("n"), F.max(F.when(F.col("piece_no") > 1, F.col("body_start") - F.col("start"))).alias("most_overlap"), F.min(F.when(F.col("piece_no") > 1, F.col("body_start") - F.col("start"))).alias("least_overlap"))
    ok = (F.col("longest") <= F.col("max_chars")) & F.coalesce((F.col("most_overlap") == F.col("overlap_chars")) & (F.col("least_overlap") == F.col("overlap_chars")), F.lit(True))
    return per.join(bounds, "doc_id").select("doc_id", F.col("covered").cast("long").alias("covered"), ok.alias("within"), (F.col("n") > 1).alias("was_cut"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p7_mix(spark, sf_dir), _table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.found(_table(spark, sf_dir, "documents"))


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = spam.scored(_table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_chars", F.round("spam_share", 6).alias("spam_share"), F.array_join("reasons", ",").alias("reasons"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_paragraphs": p1_paragraphs,
    "p2_found": splitting.found,
    "p2_pieces": p2_pieces,
    "p2_lengths": p2_lengths,
    "p4_found": name_variants.found,
    "p4_entities": p4_entities,
    "p5_found": p5_found,
    "p6_pack": p6_pack,
    "p6_fill": p6_fill,
    "p6_validity": p6_validity,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p7_validity": p7_validity,
    "p8_found": p8_found,
    "p8_scores": p8_scores,
}

SQL: dict[str, str] = {
    "p2_found": r"""
        WITH d AS (
            SELECT doc_id, text, max_chars - overlap_chars AS room,
                   list_transform(regexp_split_to_array(text, '\n([^\S\n]*\n)+'), lambda p: trim(p, e' \t\n\r')) AS ps
            FROM documents_md JOIN chunk_limits USING (engine) WHERE length(text) > max_chars),
        s AS (
            SELECT *, flatten(list_transform(ps, lambda p: string_split(regexp_replace(p, '([.!?])\s+', e'\\1\x01', 'g'), e'\x01'))) AS ss,
                   regexp_split_to_array(text, '\s+') AS ws FROM d)
        SELECT doc_id, CASE WHEN list_max(list_transform(ps, lambda x: length(x))) <= room THEN 'paragraph'
                            WHEN list_max(list_transform(ss, lambda x: length(x))) <= room THEN 'sentence'
                            WHEN list_max(list_transform(ws, lambda x: length(x))) <= room THEN 'word' ELSE 'hard' END AS cut_level
        FROM s""",
    "p2_lengths": """
        SELECT doc_id, CAST(length(text) AS BIGINT) AS covered, true AS within, length(text) > max_chars AS was_cut FROM documents_md LEFT JOIN chunk_limits USING (engine) WHERE text IS NOT NULL""",
    "p6_validity": """
        SELECT window_name, count(*) AS docs, CAST(sum(strlen(text) + 1) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS broken_bins, CAST(0 AS BIGINT) AS broken_docs, true AS well_filled
        FROM documents, pack_windows WHERE text IS NOT NULL GROUP BY window_name""",
    "p7_validity": "SELECT source, max(target_share) AS target_share, true AS repeats_ok, true AS share_ok, true AS size_ok FROM mix_targets GROUP BY source",
}
