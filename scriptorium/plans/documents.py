"""Queries over documents and their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V
from scriptorium.operators import documents as D
from scriptorium.operators.lineage import spread
from scriptorium.plans.base import LINES, PAGED, Query, fold_sql, lines, paged, sql_values, table, values
from scriptorium.plans.scalars import _rank_sql as RANK

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _q(name: str, run: Query, sql: str | None) -> None:
    QUERIES[name] = run
    if sql:
        SQL[name] = sql


def _docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents_md")


def decorated(s: SparkSession, d: str) -> DataFrame:
    """Lines with taxonomic headings put in: genus headings get a number and capitals, comparisons become species headings, sections become keys."""
    genus = r"^### ([A-Z][a-z]{3,}) ([A-Z][a-z]+\.?)$"
    species = r"^Elle se distingue de ([A-Z][a-z]+ [a-z]+)"
    line = (
        F.when(F.col("line").rlike(genus), F.concat(F.lit("### "), (F.col("line_no") % 9 + 1).cast("string"), F.lit(". "), F.upper(F.regexp_extract("line", genus, 1)), F.lit(" "), F.regexp_extract("line", genus, 2)))
        .when(F.col("line").rlike(species), F.concat(F.lit("#### 2. "), F.regexp_extract("line", species, 1)))
        .when(F.col("line").isin("### Écologie", "### Notes"), "### CLÉ DES ESPÈCES")
        .otherwise(F.col("line"))
    )
    return lines(s, d).withColumn("line", line)


_G, _S = "^### ([A-Z][a-z]{3,}) ([A-Z][a-z]+\\.?)$", "^Elle se distingue de ([A-Z][a-z]+ [a-z]+)"
DECORATED = f"(SELECT doc_id, volume, family, engine, line_no, CASE WHEN regexp_matches(line, '{_G}') THEN concat('### ', line_no % 9 + 1, '. ', upper(regexp_extract(line, '{_G}', 1)), ' ', regexp_extract(line, '{_G}', 2)) WHEN regexp_matches(line, '{_S}') THEN concat('#### 2. ', regexp_extract(line, '{_S}', 1)) WHEN line IN ('### Écologie', '### Notes') THEN '### CLÉ DES ESPÈCES' ELSE line END AS line FROM {LINES})"
DPAGED = PAGED.replace(LINES, DECORATED)

_q("s_text", lambda s, d: _docs(s, d).select("doc_id", F.length("text").alias("n_chars"), F.size(F.split("text", "\n")).alias("n_lines")).filter("n_chars is not null"),
   "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines FROM documents_md WHERE text IS NOT NULL")
_T = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"
_q("g_lines", lambda s, d: D.split_lines(table(s, d, "documents")).select("doc_id", "line_no", F.length("line").alias("text_len")),
   f"SELECT doc_id, CAST(i AS INTEGER) AS line_no, CAST(length(ls[i]) AS INTEGER) AS text_len FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1 - CASE WHEN ls[-1] = '' THEN 1 ELSE 0 END)) AS i FROM (SELECT doc_id, string_split_regex(text, '{_T}') AS ls FROM documents WHERE text IS NOT NULL))")
_q("w_page", lambda s, d: paged(s, d).select("doc_id", "line_no", "page"), f"SELECT doc_id, line_no, page FROM {PAGED}")
_KEYH = "(?i)^#{1,6}\\s+(KEY(\\s|[^A-Za-zÀ-ÿ0-9_]|$)|CL[EÉé]S?([^A-Za-zÀ-ÿ0-9_]|$))"
SEGS = f"(SELECT *, sum(CASE WHEN regexp_matches(line, '^#{{1,6}}\\s') AND line_no > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS seg_id FROM {DECORATED})"
_q("w_seg", lambda s, d: D.segments(decorated(s, d)), f"SELECT doc_id, CAST(seg_id AS BIGINT) AS seg_id, min(line_no) AS start_line, max(line_no) + 1 AS end_line, bool_or(line_no > 1 AND regexp_matches(line, '{_KEYH}')) AS is_key FROM {SEGS} GROUP BY doc_id, seg_id")
TAXA = (
    f"(SELECT doc_id, line_no, r AS rank, input AS name, coalesce(last_value(CASE WHEN r = 'family' THEN input END IGNORE NULLS) OVER w, '') AS family, CASE WHEN r IN ('species', 'infraspecific') THEN coalesce(last_value(CASE WHEN r = 'family' THEN '' WHEN r = 'genus' THEN input END IGNORE NULLS) OVER w, '') ELSE '' END AS genus, page "
    f"FROM (SELECT *, {RANK} AS r FROM (SELECT doc_id, line_no, page, trim(regexp_replace(line, '^#+\\s+', ''), ' ') AS input FROM {DPAGED} WHERE regexp_matches(line, '^#{{1,6}}\\s+'))) WHERE r IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))"
)
_q("w_crumb", lambda s, d: D.taxa(decorated(s, d)), f"SELECT * FROM {TAXA}")
_q("a_rankcnt", lambda s, d: D.taxa(decorated(s, d)).join(_docs(s, d).select("doc_id", "engine"), "doc_id").groupBy("engine").agg(F.count("*").alias("n"), *[F.count_if(F.col("rank") == r).alias(f"n_{r}") for r in V.RANK_LEVEL]),
   f"SELECT engine, count(*) AS n, " + ", ".join(f"count_if(rank = '{r}') AS n_{r}" for r in V.RANK_LEVEL) + f" FROM {TAXA} JOIN (SELECT doc_id, engine FROM documents_md) USING (doc_id) GROUP BY engine")
_q("a_changed", lambda s, d: D.ranked_headings(decorated(s, d)).groupBy("doc_id").agg(F.count_if(F.col("new_level").isNotNull() & (F.col("new_level") != F.col("level"))).alias("changed"), F.count_if(F.col("new_level").isNull() | (F.col("new_level") == F.col("level"))).alias("kept")),
   f"SELECT doc_id, count_if(nl IS NOT NULL AND nl <> lv) AS changed, count_if(nl IS NULL OR nl = lv) AS kept FROM (SELECT *, CASE r WHEN 'family' THEN 2 WHEN 'genus' THEN 3 WHEN 'species' THEN 4 WHEN 'infraspecific' THEN 5 END AS nl FROM (SELECT *, {RANK} AS r FROM (SELECT doc_id, length(regexp_extract(line, '^(#+)', 1)) AS lv, trim(regexp_replace(line, '^#+\\s+', ''), ' ') AS input FROM {DECORATED} WHERE regexp_matches(line, '^#{{1,6}}\\s+')))) GROUP BY doc_id")
HEADS = f"""(
    SELECT volume, header, pages
    FROM (SELECT volume, trim(line, ' ') AS header, count(DISTINCT (doc_id, page)) AS pages FROM {PAGED} WHERE starts_with(trim(line, ' '), '#') AND length(trim(line, ' ')) <= 80 GROUP BY ALL)
    JOIN (SELECT volume, count(DISTINCT (doc_id, page)) + 1 AS n FROM {PAGED} WHERE volume IS NOT NULL GROUP BY volume) USING (volume)
    WHERE n >= 3 AND pages >= greatest(5, floor(0.03::DOUBLE * n)))"""
_q("a_runhdr", lambda s, d: D.running_headers(paged(s, d), "volume"), f"SELECT * FROM {HEADS}")
#: Lines with what becomes of them.  A head in capitals alone is a family name if it ends like one or is conserved, or a cut-off one that can be made whole.
DROPPED = f"""(
    SELECT *, CASE WHEN is_head IS NULL THEN 'keep' WHEN nth > 1 OR whole IS NULL THEN 'drop' WHEN whole = stem THEN 'first' ELSE 'repair' END AS action
    FROM (
        SELECT *, row_number() OVER (PARTITION BY volume, head, is_head ORDER BY doc_id, line_no) AS nth,
               CASE WHEN regexp_matches(stem, '^[A-ZÀ-Ý]{{3,}}(CEAE|CÉES|CEES|EAE)$') OR stem IN ('{"', '".join(V.NOM_CONS)}') THEN stem
                    WHEN regexp_matches(stem, '^[A-ZÀ-Ý]{{4,}}AC$') THEN stem || 'EAE' WHEN regexp_matches(stem, '^[A-ZÀ-Ý]{{4,}}ACE$') THEN stem || 'AE'
                    WHEN regexp_matches(stem, '^[A-ZÀ-Ý]{{4,}}AC[EÉ]E$') THEN stem || 'S' END AS whole
        FROM (
            SELECT p.doc_id, p.volume, p.line_no, p.line, p.head, h.pages AS is_head, nullif(regexp_extract(p.head, '^#{{1,6}}\\s+([A-ZÀ-Ý]{{4,}})\\s*$', 1), '') AS stem
            FROM (SELECT *, regexp_replace(line, '\\s+$', '') AS head FROM {PAGED}) p LEFT JOIN {HEADS} h ON p.volume = h.volume AND p.head = h.header)))"""
KEPT = "CASE WHEN action IN ('keep', 'first') THEN line WHEN action = 'repair' THEN regexp_extract(head, '^#+') || ' ' || whole END"


def _dropped(s: SparkSession, d: str) -> DataFrame:
    counts = [F.count_if(F.col("action") == a).alias(a) for a in ("keep", "first", "drop", "repair")]
    return D.without_headers(paged(s, d), "volume").groupBy("volume").agg(*counts, F.sum(F.length("kept")).alias("chars"))


_counts = ", ".join(f"count_if(action = '{a}') AS \"{a}\"" for a in ("keep", "first", "drop", "repair"))
_q("a_drophdr", _dropped, f"SELECT volume, {_counts}, CAST(sum(length({KEPT})) AS BIGINT) AS chars FROM {DROPPED} GROUP BY volume")
_FH = D.FAMILY_HEAD.replace("(?=\\s|\\(|\\)|$)", "(?:\\s|\\(|\\)|$)")
_fam = f"regexp_replace(upper({fold_sql('raw')}), '(?i)C[EÉ][AEÉ][ES]S?$', 'ceae')"
FAMS = (
    f"(SELECT doc_id, line_no, char_offset, family_name FROM (SELECT *, lag(family_name) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev FROM (SELECT doc_id, line_no, char_offset, concat(upper(({_fam})[1]), lower(({_fam})[2:])) AS family_name FROM (SELECT doc_id, line_no, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_offset, regexp_extract(line, '{_FH}', 1) AS raw FROM {LINES}) WHERE raw <> '')) WHERE prev IS NULL OR prev <> family_name)"
)
_q("g_famfind", lambda s, d: D.family_headings(lines(s, d)), f"SELECT * FROM {FAMS}")
for _m in ("front", "drop"):
    _q("j_offset" if _m == "front" else "j_offset_drop", lambda s, d, m=_m: D.family_chunks(_docs(s, d), lines(s, d), m),
       f"SELECT doc_id, CAST(row_number() OVER w AS INTEGER) AS chunk_no, family_name, " + ("CASE WHEN row_number() OVER w = 1 THEN 0 ELSE char_offset END" if _m == "front" else "char_offset") + f" AS start, coalesce(lead(char_offset) OVER w, length(text)) AS \"end\" FROM {FAMS} JOIN documents_md USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY char_offset)")


def _fampage(s: SparkSession, d: str) -> DataFrame:
    """At most one family for each page of a volume: the first heading that yields a name; then consecutive repetitions once."""
    name = S.family_front(S.letters(S.accents_folded(F.regexp_replace(F.regexp_replace("line", r"^#+\s*", ""), "(?i)C[EÉ][EÉ]S$", "ceae"))))
    hits = paged(s, d).filter(F.col("line").rlike("^#{1,6} ")).withColumn("family_name", name).filter("family_name is not null and volume is not null")
    first = hits.groupBy("volume", "doc_id", "page").agg(F.min_by("family_name", "line_no").alias("family_name"))
    w = Window.partitionBy("volume").orderBy("doc_id", "page")
    return first.withColumn("prev", F.lag("family_name").over(w)).filter("prev is null or prev <> family_name").drop("prev")


_bare_line = "regexp_replace(regexp_replace(line, '^#+\\s*', ''), '(?i)C[EÉ][EÉ]S$', 'ceae')"
_let = f"lower(regexp_replace({fold_sql(_bare_line)}, '[^A-Za-z]+', '', 'g'))"
FAMPAGE = f"(SELECT volume, doc_id, page, family_name FROM (SELECT *, lag(family_name) OVER (PARTITION BY volume ORDER BY doc_id, page) AS prev FROM (SELECT volume, doc_id, page, arg_min(concat(upper(x[1]), x[2:]), line_no) AS family_name FROM (SELECT *, nullif(regexp_extract({_let}, '^([a-z]{{4,30}}(?:aceae|eaceae))', 1), '') AS x FROM {PAGED} WHERE regexp_matches(line, '^#{{1,6}} ') AND volume IS NOT NULL) WHERE x IS NOT NULL GROUP BY ALL)) WHERE prev IS NULL OR prev <> family_name)"
_q("g_fampage", _fampage, f"SELECT * FROM {FAMPAGE}")
_q("w_firstpage", lambda s, d: _fampage(s, d).groupBy("volume").agg(F.count("*").alias("n_starts"), F.min("family_name").alias("least")), f"SELECT volume, count(*) AS n_starts, min(family_name) AS least FROM {FAMPAGE} GROUP BY volume")


def _asof(s: SparkSession, d: str) -> DataFrame:
    pages = paged(s, d).filter("volume is not null").select("volume", F.concat_ws("#", "doc_id", F.lpad(F.col("page").cast("string"), 6, "0")).alias("at")).distinct()
    starts = _fampage(s, d).select("volume", F.concat_ws("#", "doc_id", F.lpad(F.col("page").cast("string"), 6, "0")).alias("start"), "family_name")
    return D.as_of(pages, starts, "volume", "at", "start", "family_name")


_q("j_asof", _asof, f"WITH p AS (SELECT DISTINCT volume, concat(doc_id, '#', lpad(CAST(page AS VARCHAR), 6, '0')) AS at FROM {PAGED} WHERE volume IS NOT NULL), f AS (SELECT volume, concat(doc_id, '#', lpad(CAST(page AS VARCHAR), 6, '0')) AS start, family_name FROM {FAMPAGE}) SELECT p.volume, p.at, coalesce(f.family_name, (SELECT arg_min(g.family_name, g.start) FROM f g WHERE g.volume = p.volume)) AS family_name FROM p ASOF LEFT JOIN f ON p.volume = f.volume AND p.at >= f.start")
_q("w_collapse", lambda s, d: _docs(s, d).filter("volume is not null").withColumn("fam", F.coalesce("family", F.lit(""))).withColumn("prev", F.lag("fam").over(Window.partitionBy(F.trim("volume")).orderBy("doc_id"))).filter("prev is null or prev <> fam").select("doc_id", F.trim("volume").alias("vol"), "fam"),
   "SELECT doc_id, vol, fam FROM (SELECT doc_id, trim(volume) AS vol, coalesce(family, '') AS fam, lag(coalesce(family, '')) OVER (PARTITION BY trim(volume) ORDER BY doc_id) AS prev FROM documents_md WHERE volume IS NOT NULL) WHERE prev IS NULL OR prev <> fam")
_TOCL = [("a", 1, "# Table des matières"), ("a", 2, "Myrtaceae ...... 12"), ("a", 3, "Annonaceae ..... 40"), ("a", 4, "Myrtaceae .... 99"), ("a", 5, "Index ... 3"), ("b", 1, "Rubiaceae ..... 3"), ("b", 2, "CONTENTS"), ("b", 3, "Huaceae ... 7")]
_TS = "doc_id string, line_no int, line string"
_TOCSQL = f"(SELECT doc_id, nm AS family_name, min(line_no) AS line_no FROM (SELECT *, nullif(regexp_extract(trim(regexp_replace(line, '^#+\\s*', '')), '^([A-Z][A-Za-z-]+(?:aceae|eaceae))\\s+\\.{{3,}}\\s+[0-9]+\\s*$', 1), '') AS nm, bool_or(regexp_matches(lower(line), 'table des matières|contents')) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ins FROM {sql_values(_TS, _TOCL)}) WHERE ins AND nm IS NOT NULL GROUP BY ALL)"
_q("g_toc", lambda s, d: D.toc_families(values(s, _TS, _TOCL).withColumn("page", F.lit(1))), f"SELECT doc_id, family_name, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS INTEGER) AS ord FROM {_TOCSQL}")


def _prefix(s: SparkSession, d: str) -> DataFrame:
    """Headings' letters against the families of the list, the first in order that they begin with; the list is a few hundred names."""
    known = table(s, d, "key_index").filter("family is not null").select("family").distinct().select("family", S.letters(F.col("family")).alias("p"))
    heads = lines(s, d).filter(F.col("line").rlike("^#{1,6} ")).select(S.letters(S.accents_folded(F.regexp_replace("line", "(?i)C[EÉ][EÉ]S$", "ceae"))).alias("h")).distinct().filter("h <> ''")
    # an equi-join on the first letters instead of comparing all with all; no family has fewer than 6
    return heads.join(known, (F.substring("h", 1, 6) == F.substring("p", 1, 6)) & F.expr("startswith(h, p)")).groupBy("h").agg(F.min("family").alias("family"))


_latin_line = "regexp_replace(line, '(?i)C[EÉ][EÉ]S$', 'ceae')"
_q("j_prefix", _prefix, f"SELECT h, min(family) AS family FROM (SELECT DISTINCT lower(regexp_replace({fold_sql(_latin_line)}, '[^A-Za-z]+', '', 'g')) AS h FROM {LINES} WHERE regexp_matches(line, '^#{{1,6}} ')) JOIN (SELECT DISTINCT family FROM key_index WHERE family IS NOT NULL) ON starts_with(h, lower(regexp_replace(family, '[^A-Za-z]+', '', 'g'))) WHERE h <> '' GROUP BY h")
_q("a_famstats", lambda s, d: _docs(s, d).groupBy("family").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"), F.sum(F.size(F.regexp_extract_all("text", F.lit(V.PAGE), F.lit(1)))).alias("pages")).join(table(s, d, "figures").groupBy("family").agg(F.count("*").alias("figs")), "family", "left").na.fill(0, ["figs"]),
   "SELECT d.family, docs, chars, pages, coalesce(figs, 0) AS figs FROM (SELECT family, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(regexp_extract_all(text, '<!--\\s*page\\s+([0-9]+)\\s*-->', 1))) AS BIGINT) AS pages FROM documents_md GROUP BY family) d LEFT JOIN (SELECT family, count(*) AS figs FROM figures GROUP BY family) f ON d.family = f.family")
_PT = lambda s, d: paged(s, d).groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("page_text"))
PTEXT = f"(SELECT doc_id, page, string_agg(line, chr(10) ORDER BY line_no) AS page_text FROM {PAGED} GROUP BY doc_id, page)"
_q("a_concat", lambda s, d: _PT(s, d).groupBy("doc_id").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "page_text"))), lambda x: x["page_text"]), "\n\n---\n\n")).alias("joined")), f"SELECT doc_id, md5(string_agg(page_text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page)) AS joined FROM {PTEXT} GROUP BY doc_id")
_q("a_grouplist", lambda s, d: table(s, d, "figures").groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fig_idx", "fig_id"))), lambda x: x["fig_id"].cast("string")), ",").alias("figs")), "SELECT doc_id, page, string_agg(CAST(fig_id AS VARCHAR), ',' ORDER BY fig_idx, fig_id) AS figs FROM figures GROUP BY doc_id, page")
_q("a_any", lambda s, d: lines(s, d).groupBy("doc_id").agg(F.bool_or(F.col("line").rlike(V.COUPLET.replace("\\s", "(?:\\s|$)"))).alias("has_key"), F.bool_or(F.col("line").rlike(V.DASH_COUPLET)).alias("is_dash")), f"SELECT doc_id, bool_or(regexp_matches(line, '^[0-9]{{1,2}}(''|\"|[’′])*\\.(\\s|$)')) AS has_key, bool_or(regexp_matches(line, '^[0-9]{{1,2}}\\.\\s+-\\s+')) AS is_dash FROM {LINES} GROUP BY doc_id")
_q("a_mean", lambda s, d: D.running_mean(table(s, d, "run_metadata").distinct().filter("elapsed_seconds is not null"), "engine", F.to_date("completed_at"), ["completed_at", "doc_id", "elapsed_seconds", "loaded_at"], "elapsed_seconds", "m").select("doc_id", "elapsed_seconds", F.floor(F.col("m") * 100 + 0.000001).alias("mean_cents")),
   "SELECT doc_id, elapsed_seconds, CAST(floor(avg(elapsed_seconds) OVER (PARTITION BY engine ORDER BY completed_at, doc_id, elapsed_seconds, loaded_at ROWS UNBOUNDED PRECEDING) * 100 + 0.000001) AS BIGINT) AS mean_cents FROM (SELECT DISTINCT * FROM run_metadata) WHERE elapsed_seconds IS NOT NULL")
_q("g_chunk", lambda s, d: D.packed_paragraphs(table(s, d, "documents"), 1200).select("doc_id", "chunk_no", F.length("text").alias("n_chars"), F.md5("text").alias("digest")),
   "WITH RECURSIVE p AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS ps FROM documents WHERE text IS NOT NULL), r AS (SELECT doc_id, ps, 1 AS i, 1 AS chunk_no, length(ps[1]) + 2 AS used FROM p UNION ALL SELECT doc_id, ps, i + 1, CASE WHEN used + length(ps[i + 1]) + 2 > 1200 THEN chunk_no + 1 ELSE chunk_no END, CASE WHEN used + length(ps[i + 1]) + 2 > 1200 THEN length(ps[i + 1]) + 2 ELSE used + length(ps[i + 1]) + 2 END FROM r WHERE i < len(ps)), t AS (SELECT doc_id, chunk_no, string_agg(ps[i], chr(10) || chr(10) ORDER BY i) AS txt FROM r GROUP BY doc_id, chunk_no) SELECT doc_id, chunk_no, CAST(length(txt) AS INTEGER) AS n_chars, md5(txt) AS digest FROM t")
_SC = "(SELECT source, count(*) AS n, count_if(score >= 10) AS bad FROM documents JOIN (" + "{}" + ") USING (doc_id) GROUP BY source)"


def corrupt(n: Column, bad: Column) -> Column:
    """Whether so many bad pages of n make a volume corrupt."""
    return (n > 0) & (bad >= F.greatest(F.lit(V.GARBAGE_PAGES), F.floor(n.cast("double") * F.lit(V.GARBAGE_FRACTION) + 0.999)))


def _garbage(s: SparkSession, d: str) -> DataFrame:
    pages = spread(table(s, d, "documents").select("doc_id", "source", "text"), "doc_id")
    per = pages.groupBy("source").agg(F.count("*").alias("n"), F.count_if(S.garbage_score(F.col("text")) >= V.GARBAGE_SCORE).alias("bad"))
    return per.withColumn("fallback", corrupt(F.col("n"), F.col("bad")))


def _garbage_sql() -> str:
    from scriptorium.plans.scalars import SQL as SCALARS

    return f"SELECT source, n, bad, n > 0 AND bad >= greatest(8, floor(n * 0.15::DOUBLE + 0.999::DOUBLE)) AS fallback FROM {_SC.format(SCALARS['p_garbage'])}"


_q("a_garbage", _garbage, _garbage_sql())
_q("s_pdf_text", lambda s, d: _PT(s, d).join(_docs(s, d).select("doc_id", "family"), "doc_id").groupBy("family").agg(F.sum(F.when(F.col("page").between(4, 13), F.length(F.trim("page_text"))).otherwise(0)).alias("chars"), F.count_if(F.col("page").between(4, 13)).alias("pages")).withColumn("has_text", F.coalesce(F.floor(F.col("chars") / F.nullif(F.col("pages"), F.lit(0))) >= 200, F.lit(False))),
   f"SELECT family, CAST(sum(CASE WHEN page BETWEEN 4 AND 13 THEN length(trim(page_text, ' ')) ELSE 0 END) AS BIGINT) AS chars, count_if(page BETWEEN 4 AND 13) AS pages, coalesce(floor(sum(CASE WHEN page BETWEEN 4 AND 13 THEN length(trim(page_text, ' ')) ELSE 0 END) / nullif(count_if(page BETWEEN 4 AND 13), 0)) >= 200, false) AS has_text FROM {PTEXT} JOIN (SELECT doc_id, family FROM documents_md) USING (doc_id) GROUP BY family")
_PRI = "CASE engine WHEN 'paddle' THEN 1 WHEN 'mineru' THEN 2 ELSE 3 END"
_q("s_src_pick", lambda s, d: _docs(s, d).filter("family is not null").withColumn("pri", F.expr(_PRI)).groupBy(F.trim("volume").alias("volume"), "family").agg(F.min_by("doc_id", F.struct("pri", "doc_id")).alias("picked"), F.count("*").alias("candidates")),
   f"SELECT trim(volume) AS volume, family, arg_min(doc_id, {_PRI} || doc_id) AS picked, count(*) AS candidates FROM documents_md WHERE family IS NOT NULL GROUP BY ALL")
_DONE = lambda s, d: table(s, d, "run_metadata").filter("char_count is not null").select("doc_id").distinct()
_q("j_semi", lambda s, d: _docs(s, d).join(_DONE(s, d), "doc_id", "left_semi").select("doc_id"), "SELECT doc_id FROM documents_md WHERE doc_id IN (SELECT doc_id FROM run_metadata WHERE char_count IS NOT NULL)")
_q("j_anti", lambda s, d: _docs(s, d).join(_DONE(s, d), "doc_id", "left_anti").select("doc_id"), "SELECT doc_id FROM documents_md WHERE doc_id NOT IN (SELECT doc_id FROM run_metadata WHERE char_count IS NOT NULL)")
_q("u_except", lambda s, d: _docs(s, d).select("doc_id").subtract(table(s, d, "figures").select("doc_id")), "SELECT doc_id FROM documents_md EXCEPT SELECT doc_id FROM figures")
_q("u_setfilt", lambda s, d: table(s, d, "figures").join(_docs(s, d).filter("engine = 'mineru'").select("doc_id"), "doc_id", "left_semi").select("fig_id"), "SELECT fig_id FROM figures WHERE doc_id IN (SELECT doc_id FROM documents_md WHERE engine = 'mineru')")
_q("u_all", lambda s, d: table(s, d, "figures").filter("label = 'image'").select("fig_id", F.lit(1).alias("part")).unionByName(table(s, d, "figures").filter("label = 'chart'").select("fig_id", F.lit(2).alias("part"))), "SELECT fig_id, 1 AS part FROM figures WHERE label = 'image' UNION ALL SELECT fig_id, 2 FROM figures WHERE label = 'chart'")
_q("a_batch", lambda s, d: _docs(s, d).join(table(s, d, "run_metadata").groupBy("doc_id").agg(F.count_if(F.col("char_count").isNull()).alias("bad"), F.count_if(F.col("char_count").isNotNull()).alias("good")), "doc_id", "left").select("engine", F.when(F.col("good").isNull(), "no_source").when(F.col("good") > 1, "skipped_done").when(F.col("good") == 1, "processed").otherwise("failed").alias("status")).groupBy("engine", "status").agg(F.count("*").alias("n")),
   "SELECT engine, CASE WHEN good IS NULL THEN 'no_source' WHEN good > 1 THEN 'skipped_done' WHEN good = 1 THEN 'processed' ELSE 'failed' END AS status, count(*) AS n FROM documents_md LEFT JOIN (SELECT doc_id, count_if(char_count IS NOT NULL) AS good FROM run_metadata GROUP BY doc_id) USING (doc_id) GROUP BY ALL")
_q("w_inrange", lambda s, d: table(s, d, "run_metadata").filter(S.label_key(F.col("vol_label"))[0] >= 30).select("vol_label").distinct(), "SELECT DISTINCT vol_label FROM run_metadata WHERE coalesce(TRY_CAST(nullif(regexp_extract(vol_label, '^([0-9]+)(?:bis)?$', 1), '') AS BIGINT), 1000000000) >= 30")
_q("f_empty", lambda s, d: lines(s, d).filter(F.trim("line") != "").groupBy("doc_id").agg(F.count("*").alias("n")), f"SELECT doc_id, count(*) AS n FROM {LINES} WHERE trim(line, ' ') <> '' GROUP BY doc_id")
_q("o_limit", lambda s, d: paged(s, d).filter("page between 1 and 20").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("page").alias("last_page")), f"SELECT doc_id, count(*) AS n, max(page) AS last_page FROM {PAGED} WHERE page BETWEEN 1 AND 20 GROUP BY doc_id")
