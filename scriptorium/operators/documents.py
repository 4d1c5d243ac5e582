"""Operators over the ordered lines of documents.

Order carries meaning: every table has doc_id and line_no, and all windows share
the partitioning by document, so one shuffle serves them.  Nulls: a null text has
no lines; a line is never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V

TERMINATORS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _order(*keys: str) -> Window:
    return Window.partitionBy(*(keys or ("doc_id",))).orderBy("line_no")


def _upto(*keys: str) -> Window:
    return _order(*keys).rowsBetween(Window.unboundedPreceding, 0)


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no from 1, line) at every line terminator; a terminator at the end opens no line."""
    pieces = F.split("text", TERMINATORS)
    pieces = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))).otherwise(pieces)
    return docs.select("doc_id", F.posexplode(pieces).alias("p", "line")).select("doc_id", (F.col("p") + 1).alias("line_no"), "line")


def paged(lines: DataFrame) -> DataFrame:
    """Lines with the page they stand on, 0 before the first marker."""
    return lines.withColumn("page", F.coalesce(F.last(S.page_number(F.col("line")), ignorenulls=True).over(_upto()), F.lit(0)))


def paged_lines(docs: DataFrame, *keep: str) -> DataFrame:
    """The lines of documents with their page, without a shuffle: (keep columns, line_no, line, page).

    A text is parted at its markers in its own row, page by page, and each page
    into its lines; a line's page is that of the last marker up to it.
    """
    ls = docs.filter("text is not null").select(*keep, F.split("text", "\n").alias("ls_"))
    marks = F.filter(F.transform("ls_", lambda x, i: F.struct(i.alias("at"), S.page_number(x).alias("page"))), lambda m: m["page"].isNotNull())
    begins = ls.withColumn("marks_", F.concat(F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("page"))), marks))
    ends = F.concat(F.transform(F.slice("marks_", 2, F.size("marks_")), lambda m: m["at"]), F.array(F.size("ls_")))
    parts = F.zip_with("marks_", ends, lambda m, end: F.struct(m["at"].alias("at"), m["page"].alias("page"), F.slice("ls_", m["at"] + 1, end - m["at"]).alias("ls")))
    pages = begins.select(*keep, F.explode(parts).alias("p_"))
    return pages.select(*keep, F.col("p_.at").alias("at_"), F.col("p_.page").alias("page"), F.posexplode("p_.ls").alias("pos_", "line")).select(*keep, (F.col("at_") + F.col("pos_") + 1).alias("line_no"), "line", "page")


def segments(lines: DataFrame) -> DataFrame:
    """(doc_id, seg_id, start_line, end_line exclusive, is_key); a heading on the first line opens no segment of its own, so it is no key."""
    head = F.col("line").rlike(V.ANY_HEADING) & (F.col("line_no") > 1)
    marked = lines.withColumn("seg_id", F.sum(head.cast("int")).over(_upto()))
    return marked.groupBy("doc_id", "seg_id").agg(F.min("line_no").alias("start_line"), (F.max("line_no") + 1).alias("end_line"), F.max(F.when(head, F.col("line").rlike(V.KEY_HEADING)).otherwise(False)).alias("is_key"))


def ranked_headings(lines: DataFrame) -> DataFrame:
    """Headings with level, text, rank (null for none) and the level that the rank asks for."""
    level, text = S.heading(F.col("line"))
    return lines.withColumn("level", level).withColumn("head", text).filter("level is not null").withColumn("rank", S.rank(F.col("head"))).withColumn("new_level", S.rank_level(F.col("rank")))


def taxa(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, rank, name, family, genus, page) of the headings that name taxa; a family clears the genus, only lower ranks show one."""
    level, text = S.heading(F.col("line"))
    marked = paged(lines).withColumn("name", text).withColumn("rank", S.rank(F.col("name")))
    fam = F.last(F.when(F.col("rank") == "family", F.col("name")), ignorenulls=True).over(_upto())
    gen = F.last(F.when(F.col("rank") == "family", F.lit("")).when(F.col("rank") == "genus", F.col("name")), ignorenulls=True).over(_upto())
    carried = marked.withColumn("family", F.coalesce(fam, F.lit(""))).withColumn("genus", F.when(F.col("rank").isin("species", "infraspecific"), F.coalesce(gen, F.lit(""))).otherwise(""))
    return carried.filter("rank is not null").select("doc_id", "line_no", "rank", "name", "family", "genus", "page")


def running_headers(lines: DataFrame, group: str, fraction: float = 0.03, least: int = 5) -> DataFrame:
    """(group, header, pages): short headings on so many pages of a group that they must be running heads.

    lines must be paged.  Counting is distinct pages with partial aggregation;
    a group with fewer than three parts has none.
    """
    parts = lines.filter(F.col(group).isNotNull()).select(group, "doc_id", "page").distinct().groupBy(group).agg((F.count("*") + 1).alias("n"))
    short = lines.withColumn("header", F.trim("line")).filter(F.col("header").startswith("#") & (F.length("header") <= 80))
    counted = short.groupBy(group, "header").agg(F.countDistinct("doc_id", "page").alias("pages"))
    limit = F.greatest(F.lit(least), F.floor(F.lit(fraction) * F.col("n").cast("double")))
    return counted.join(parts, group).filter((F.col("n") >= 3) & (F.col("pages") >= limit)).select(group, "header", "pages")


def without_headers(lines: DataFrame, group: str) -> DataFrame:
    """Lines with action and the line that stays.

    Running heads (see running_headers) are dropped; but of one that is a family
    name the first occurrence in the group stays: as it is (action first) if the
    name is whole, made whole (repair) if it is cut off.  All else is kept.
    """
    heads = running_headers(lines, group).drop("pages")
    # only headings can be running heads: the other lines, nearly all, take no part in the join
    marked = F.col("line").startswith("#")
    hit = lines.filter(marked).withColumn("header", F.regexp_replace("line", r"\s+$", "")).join(heads.withColumn("is_head", F.lit(True)), [group, "header"], "left")
    stem = F.regexp_extract("header", V.CAPITAL_HEADING, 2)
    as_is = stem.rlike(V.WHOLE_FAMILY) | stem.isin(V.NOM_CONS)
    ranked = hit.withColumn("as_is", as_is).withColumn("mended", F.when(~as_is, S.stem_repaired(stem)))
    named = F.col("is_head") & (F.col("as_is") | F.col("mended").isNotNull())
    first = ranked.filter(named).groupBy(group, "header").agg(F.min(F.struct("doc_id", "line_no")).alias("at"))
    judged = ranked.join(first, [group, "header"], "left")
    is_first = (F.col("at.doc_id") == F.col("doc_id")) & (F.col("at.line_no") == F.col("line_no"))
    action = F.when(F.col("is_head").isNull(), "keep").when(is_first & F.col("as_is"), "first").when(is_first, "repair").otherwise("drop")
    out = judged.withColumn("action", action)
    mended = F.concat(F.regexp_extract("header", "^#+", 0), F.lit(" "), F.col("mended"))
    out = out.withColumn("kept", F.when(F.col("action").isin("keep", "first"), F.col("line")).when(F.col("action") == "repair", mended)).drop("header", "is_head", "as_is", "mended", "at")
    rest = lines.filter(~marked).withColumn("action", F.lit("keep")).withColumn("kept", F.col("line"))
    return out.unionByName(rest)


FAMILY_HEAD = "^#{1,4}\\s+([A-ZÀ-Ý]{4,}C[EÉ][AEÉ][ES]S?|[A-Z][a-z]{3,}ceae|" + "|".join(V.NOM_CONS) + "|" + "|".join(x.capitalize() for x in V.NOM_CONS) + ")(?=\\s|\\(|\\)|$)"


def family_headings(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, char_offset, family) of family headings, consecutive repetitions of one family once."""
    before = F.sum(F.length("line") + 1).over(_order().rowsBetween(Window.unboundedPreceding, -1))
    found = lines.withColumn("char_offset", F.coalesce(before, F.lit(0))).withColumn("raw", F.regexp_extract("line", FAMILY_HEAD, 1)).filter("raw <> ''")
    named = found.withColumn("family_name", S.family_name(F.col("raw")))
    return named.withColumn("prev", F.lag("family_name").over(_order())).filter("prev is null or prev <> family_name").select("doc_id", "line_no", F.col("char_offset").cast("long").alias("char_offset"), "family_name")


def family_chunks(docs: DataFrame, lines: DataFrame, mode: str = "front") -> DataFrame:
    """(doc_id, chunk_no, family_name, start, end): stretches of a text from one family heading to the next.

    mode front: what stands before the first heading goes with it; drop: it is lost.
    """
    heads = family_headings(lines)
    order = Window.partitionBy("doc_id").orderBy("char_offset")
    sized = heads.join(docs.select("doc_id", F.length("text").alias("n")), "doc_id")
    start = F.when((F.row_number().over(order) == 1) & F.lit(mode == "front"), F.lit(0)).otherwise(F.col("char_offset"))
    return sized.select("doc_id", F.row_number().over(order).alias("chunk_no"), "family_name", start.cast("long").alias("start"), F.coalesce(F.lead("char_offset").over(order), F.col("n").cast("long")).alias("end"))


def as_of(left: DataFrame, right: DataFrame, by: str, at: str, start: str, value: str) -> DataFrame:
    """Left rows with the value of the last right row of their group that starts at or before them; rows before the first get the first.

    One sort by group and position over the union of both sides; nothing is
    compared pairwise.  Groups without right rows give null.
    """
    union = left.select(by, F.col(at).alias("pos"), F.lit(1).alias("is_left"), F.lit(None).cast("string").alias("v")).unionByName(right.select(by, F.col(start).alias("pos"), F.lit(0).alias("is_left"), F.col(value).alias("v")))
    w = Window.partitionBy(by).orderBy("pos", "is_left")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = F.coalesce(F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first("v", ignorenulls=True).over(whole))
    return union.withColumn(value, carried).filter("is_left = 1").select(by, F.col("pos").alias(at), value)


def packed_paragraphs(docs: DataFrame, limit: int = V.CHUNK_CHARS, separator: str = "\n\n") -> DataFrame:
    """(doc_id, chunk_no, text): paragraphs packed greedily; each costs its length and 2; one over the limit stays whole."""
    parts = F.split("text", separator)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("used"))

    def step(acc: Column, p: Column) -> Column:
        cost = F.length(p) + 2
        close = acc["open"].isNotNull() & (acc["used"] + cost > limit)
        return F.struct(
            F.when(close, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(close | acc["open"].isNull(), p).otherwise(F.concat(acc["open"], F.lit(separator), p)).alias("open"),
            F.when(close, cost).otherwise(acc["used"] + cost).alias("used"),
        )

    folded = F.aggregate(parts, start, step, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    return docs.filter("text is not null").select("doc_id", F.posexplode(folded).alias("k", "text")).select("doc_id", (F.col("k") + 1).alias("chunk_no"), "text")


def toc_families(lines: DataFrame, last_page: int = 20) -> DataFrame:
    """(doc_id, family, ord) listed with dotted leaders after a table of contents began, in order, each once; lines must be paged."""
    plain = F.trim(F.regexp_replace("line", r"^#+\s*", ""))
    opens = F.lower(plain).contains("table des matières") | F.lower(plain).contains("contents")
    listed = lines.filter(F.col("page") <= last_page).withColumn("plain", plain).withColumn("inside", F.max(opens.cast("int")).over(_order().rowsBetween(Window.unboundedPreceding, -1)))
    hits = listed.filter("inside = 1").withColumn("family_name", F.regexp_extract("plain", r"^([A-Z][A-Za-z-]+(?:aceae|eaceae))\s+\.{3,}\s+[0-9]+\s*$", 1)).filter("family_name <> ''")
    first = hits.groupBy("doc_id", "family_name").agg(F.min("line_no").alias("line_no"))
    return first.select("doc_id", "family_name", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")).alias("ord"))


def running_mean(df: DataFrame, group: str, slice_by: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Rows with the mean of a value over their group up to and with them, in an order that slice_by follows.

    A group may hold a third of all rows, so sums are added up by slice first;
    only inside a slice is there a running sum.
    """
    cut = df.withColumn("slice_", slice_by)
    sums = cut.groupBy(group, "slice_").agg(F.sum(value).alias("s_"), F.count(value).alias("n_"))
    before = Window.partitionBy(group).orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "slice_", F.coalesce(F.sum("s_").over(before), F.lit(0.0)).alias("s0_"), F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("n0_"))
    inside = Window.partitionBy(group, "slice_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.join(sums, [group, "slice_"])
    return joined.withColumn(name, (F.col("s0_") + F.sum(value).over(inside)) / (F.col("n0_") + F.count(value).over(inside))).drop("slice_", "s0_", "n0_")
