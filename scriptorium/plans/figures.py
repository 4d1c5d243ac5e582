"""Queries over figures, captions and laid-out pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V
from scriptorium.operators import figures as G
from scriptorium.operators import layout as L
from scriptorium.plans.base import Query, sql_values, table, values

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _q(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql:
        SQL[name] = sql


_figs = lambda s, d: table(s, d, "figures")
_PL = "upper(nullif(regexp_extract(caption, '(?i)\\bPL\\.?\\s*([IVXLC]+)\\b', 1), ''))"
_plate = lambda: F.upper(F.nullif(F.regexp_extract("caption", V.PLATE, 1), F.lit("")))
_REFS = [("psidium:guajava", "II"), ("eugenia:whytei", "XII"), ("syzygium:x", "XXXVII"), ("none:none", "DL")]
_RS = "species string, plate string"
_q("w_keepfirst", lambda s, d: _figs(s, d).withColumn("plate", _plate()).filter("plate is not null").withColumn("r", F.row_number().over(Window.partitionBy("family", "plate").orderBy("fig_id"))).filter("r = 1").select("family", "plate", "fig_id"), f"SELECT family, plate, min(fig_id) AS fig_id FROM (SELECT *, {_PL} AS plate FROM figures) WHERE plate IS NOT NULL GROUP BY family, plate")
_q("w_keeplast", lambda s, d: _figs(s, d).withColumn("plate", _plate()).filter("plate is not null").groupBy("plate").agg(F.max("fig_id").alias("fig_id")), f"SELECT plate, max(fig_id) AS fig_id FROM (SELECT *, {_PL} AS plate FROM figures) WHERE plate IS NOT NULL GROUP BY plate")
_q("j_plate", lambda s, d: values(s, _RS, _REFS).join(QUERIES["w_keeplast"](s, d), "plate").select("species", "plate", "fig_id"), f"SELECT species, plate, max(fig_id) AS fig_id FROM (SELECT *, {_PL} AS plate FROM figures) JOIN {sql_values(_RS, _REFS)} USING (plate) GROUP BY ALL")
_BIN = "\\b([A-Z][a-z]+)\\s+([A-Za-z][a-z]{2,})\\b"
_bin = lambda s, d: _figs(s, d).filter(F.col("caption").rlike(r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b")).groupBy(F.lower(F.concat(F.regexp_extract("caption", r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b", 1), F.lit(":"), F.regexp_extract("caption", r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b", 2))).alias("species")).agg(F.min_by("filename", "fig_id").alias("path"))
_BINSQL = f"(SELECT lower(concat(regexp_extract(caption, '{_BIN}', 1), ':', regexp_extract(caption, '{_BIN}', 2))) AS species, arg_min(filename, fig_id) AS path FROM figures WHERE regexp_matches(caption, '{_BIN}') GROUP BY 1)"
_high = lambda s, d: _figs(s, d).filter("label = 'chart'").groupBy(F.lower(F.concat(F.regexp_extract("caption", r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b", 1), F.lit(":"), F.regexp_extract("caption", r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b", 2))).alias("species")).agg(F.concat(F.lit("hi/"), F.max_by("filename", "fig_id")).alias("path")).filter("species <> ':'")
_HIGHSQL = f"(SELECT lower(concat(regexp_extract(caption, '{_BIN}', 1), ':', regexp_extract(caption, '{_BIN}', 2))) AS species, concat('hi/', arg_max(filename, fig_id)) AS path FROM figures WHERE label = 'chart' AND regexp_matches(caption, '{_BIN}') GROUP BY 1)"
for _n in ("j_overlay", "u_overlay"):
    _q(_n, lambda s, d: G.overlaid(_bin(s, d), _high(s, d), "species"), f"SELECT coalesce(h.species, l.species) AS species, coalesce(h.path, l.path) AS path FROM {_BINSQL} l FULL JOIN {_HIGHSQL} h ON h.species = l.species")
_q("w_ordinal", lambda s, d: _figs(s, d).select("fig_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "fig_idx", "fig_id")) - 1).alias("running")), "SELECT fig_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, fig_idx, fig_id) - 1 AS INTEGER) AS running FROM figures")
_caps = lambda s, d: _figs(s, d).filter("fig_id % 3 = 0").select("doc_id", F.col("page").alias("cap_idx")).distinct()
_pics = lambda s, d: _figs(s, d).filter("fig_id % 3 <> 0").select("doc_id", F.col("page").alias("fig_idx")).distinct()
for _n in ("j_nearest", "o_top1"):
    _q(_n, lambda s, d: G.nearest(_caps(s, d), _pics(s, d), ["doc_id"]),
       "SELECT c.doc_id, c.cap_idx, arg_min(f.fig_idx, abs(f.fig_idx - c.cap_idx) * 100000 + f.fig_idx) AS fig_pos FROM (SELECT DISTINCT doc_id, page AS cap_idx FROM figures WHERE fig_id % 3 = 0) c LEFT JOIN (SELECT DISTINCT doc_id, page AS fig_idx FROM figures WHERE fig_id % 3 <> 0) f USING (doc_id) GROUP BY ALL")
_q("j_nearest_pages", lambda s, d: G.nearest(_figs(s, d).filter("caption <> '' and caption <> '(no caption)'").select("doc_id", "page", F.col("fig_idx").alias("cap_idx")).distinct(), _figs(s, d).filter("filename is not null").select("doc_id", "page", "fig_idx").distinct(), ["doc_id", "page"]),
   "SELECT c.doc_id, c.page, c.cap_idx, arg_min(f.fig_idx, abs(f.fig_idx - c.cap_idx) * 100000 + f.fig_idx) AS fig_pos FROM (SELECT DISTINCT doc_id, page, fig_idx AS cap_idx FROM figures WHERE caption <> '' AND caption <> '(no caption)') c LEFT JOIN (SELECT DISTINCT doc_id, page, fig_idx FROM figures WHERE filename IS NOT NULL) f ON f.doc_id = c.doc_id AND f.page = c.page GROUP BY ALL")
_q("j_zip", lambda s, d: G.zipped(_figs(s, d).select("doc_id", "page", F.col("fig_idx").alias("fig_ord"), F.col("filename").alias("figure")), _figs(s, d).filter("caption is not null and caption <> '' and caption <> '(no caption)'").select("doc_id", "page", F.col("fig_id").alias("cap_ord"), F.md5("caption").alias("caption")), ["doc_id", "page"]),
   "WITH f AS (SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY fig_idx) AS rn, filename AS figure FROM figures), c AS (SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY fig_id) AS rn, md5(caption) AS caption FROM figures WHERE caption IS NOT NULL AND caption <> '' AND caption <> '(no caption)') SELECT doc_id, page, CAST(rn AS INTEGER) AS rn, figure, coalesce(caption, '(no caption)') AS caption FROM f FULL JOIN c USING (doc_id, page, rn)")
_q("j_pagecap", lambda s, d: _figs(s, d).select("doc_id", "page").distinct().join(_figs(s, d).filter(S.is_caption(F.coalesce("caption", F.lit("")))).groupBy("doc_id", "page").agg(F.count("*").alias("n_captions")), ["doc_id", "page"], "left").na.fill(0), "SELECT doc_id, page, count_if(regexp_matches(coalesce(caption, ''), '(?i)^(Figure|Fig\\.|Planche|Pl\\.|Tableau|Tab\\.)\\s*[0-9]+[A-Za-z]?\\s*[.:]')) AS n_captions FROM figures GROUP BY ALL")
_q("f_nocap", lambda s, d: _figs(s, d).join(QUERIES["j_pagecap"](s, d), ["doc_id", "page"]).join(table(s, d, "documents_md").select("doc_id", F.length("text").alias("n")), "doc_id").filter("not (n >= 500 and n_captions = 0)").select("fig_id"),
   "SELECT fig_id FROM figures JOIN (SELECT doc_id, page, count_if(regexp_matches(coalesce(caption, ''), '(?i)^(Figure|Fig\\.|Planche|Pl\\.|Tableau|Tab\\.)\\s*[0-9]+[A-Za-z]?\\s*[.:]')) AS nc FROM figures GROUP BY ALL) USING (doc_id, page) JOIN (SELECT doc_id, length(text) AS n FROM documents_md) USING (doc_id) WHERE NOT (n >= 500 AND nc = 0)")
_q("a_capcat", lambda s, d: _figs(s, d).filter("caption is not null").groupBy("doc_id", "page").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fig_id", "caption"))), lambda x: x["caption"]), "\n")).alias("captions")), "SELECT doc_id, page, md5(string_agg(caption, chr(10) ORDER BY fig_id)) AS captions FROM figures WHERE caption IS NOT NULL GROUP BY ALL")
_q("a_distinct", lambda s, d: _bin(s, d).select(F.split("species", ":")[1].alias("epithet")).distinct(), f"SELECT DISTINCT split_part(species, ':', 2) AS epithet FROM {_BINSQL}")
_q("k_figmd", lambda s, d: _figs(s, d).select("doc_id", "fig_idx", "fig_id", F.format_string("## Figure %d (page %d)\n\n![](figures/%s)\n\n*Caption:* %s\n", "fig_idx", "page", F.coalesce("filename", F.lit("")), F.coalesce(F.nullif("caption", F.lit("")), F.lit("(no caption)"))).alias("md")).groupBy("doc_id").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fig_idx", "fig_id", "md"))), lambda x: x["md"]), "\n---\n")).alias("md")),
   "SELECT doc_id, md5(string_agg(concat('## Figure ', fig_idx, ' (page ', page, ')', chr(10), chr(10), '![](figures/', coalesce(filename, ''), ')', chr(10), chr(10), '*Caption:* ', coalesce(nullif(caption, ''), '(no caption)'), chr(10)), chr(10) || '---' || chr(10) ORDER BY fig_idx, fig_id)) AS md FROM figures GROUP BY doc_id")
_MD = [("d1", "## Figure 1\n![](figures/fig_001.png)\n*Caption:* PL. I. — Eugenia Whytei : De la plante, Psidium guajava\n---\n![x](figures/fig_002_p0003.png)\n*Caption:* (no caption)\n---\nno image\n---\n![](figures/fig_3.png)"), ("d2", "nothing here")]
_DS = "doc_id string, text string"
_q("g_figblock", lambda s, d: G.figure_blocks(values(s, _DS, _MD)).withColumn("species", F.array_join("species", ",")), "SELECT a AS doc_id, CAST(b AS INTEGER) AS block_no, c AS path, e AS caption, f AS plate, g AS species FROM (VALUES ('d1', 0, 'fig_001.png', 'PL. I. — Eugenia Whytei : De la plante, Psidium guajava', 'I', 'eugenia:whytei,psidium:guajava'), ('d1', 1, 'fig_002_p0003.png', '', NULL, ''), ('d1', 3, 'fig_3.png', '', NULL, '')) v(a, b, c, e, f, g)")
_TX = [("d1", "### 1. Eugenia Whytei Sprague (PL. XII)\nvoir Psidium guajava L. (Pl. II) et Eugenia whytei (PL. IX)\n"), ("d2", "none")]
_q("g_refs", lambda s, d: G.plate_references(values(s, _DS, _TX)), "SELECT a AS doc_id, b AS species, c AS plate FROM (VALUES ('d1', 'eugenia:whytei', 'XII'), ('d1', 'voir:psidium', 'II'), ('d1', 'et:eugenia', 'IX')) v(a, b, c)")
_FZ = [("staudtii",), ("guajavva",), ("zzz",), ("gillettii",)]
_EP = [("staudti",), ("guajava",), ("gilletii",), ("other",)]
_q("j_fuzzy", lambda s, d: G.similar_names(values(s, "query string", _FZ), values(s, "name string", _EP)), "SELECT a AS query, b AS match, c AS ratio FROM (VALUES ('staudtii', 'staudti', 0.933333::DOUBLE), ('guajavva', 'guajava', 0.933333::DOUBLE), ('gillettii', 'gilletii', 0.941176::DOUBLE)) v(a, b, c)")
_q("f_cutoff", lambda s, d: QUERIES["j_fuzzy"](s, d).filter(F.col("ratio") >= V.CUTOFF), SQL["j_fuzzy"])


def _epithets(s: SparkSession, d: str) -> DataFrame:
    """Every epithet as typed on the pages against all others, by similarity."""
    epithets = table(s, d, "wiki_species").select(S.figure_epithet(F.col("name")).alias("name")).filter("name is not null").distinct()
    return G.similar_names(epithets.select(F.col("name").alias("query")), epithets, others=True)


_q("j_fuzzy_pages", _epithets)
_TM = [("Eugenia", "3. Eugenia whytei"), (None, "Psidium guajava"), ("Syzygium", "Syzygium gillettii."), ("X", "Psidium"), ("Eugenia", "E. zzzz")]
_FG = [("eugenia", "whytei", 1, "f1"), ("psidium", "guajava", 2, "f2"), ("myrtus", "whytei", 3, "f3"), ("syzygium", "gilletii", 4, "f4")]
_q("j_figure", lambda s, d: G.found_for(values(s, "key_genus string, terminal_name string", _TM), values(s, "genus string, epithet string, ord int, path string", _FG)),
   "SELECT a AS key_genus, b AS terminal_name, c AS path, e AS match_level FROM (VALUES ('Eugenia', '3. Eugenia whytei', 'f1', 'exact'), (NULL, 'Psidium guajava', 'f2', 'epithet'), ('Syzygium', 'Syzygium gillettii.', 'f4', 'similar'), ('X', 'Psidium', NULL, NULL), ('Eugenia', 'E. zzzz', NULL, NULL)) v(a, b, c, e)")
_q("j_map", lambda s, d: _figs(s, d).select(F.coalesce("label", F.lit("none")).alias("hash")).distinct().join(values(s, "hash string, name string", [("image", "fig_image"), ("chart", "fig_chart")]), "hash", "left").select("hash", F.coalesce("name", "hash").alias("name")), "SELECT DISTINCT coalesce(label, 'none') AS hash, CASE label WHEN 'image' THEN 'fig_image' WHEN 'chart' THEN 'fig_chart' ELSE coalesce(label, 'none') END AS name FROM figures")
_q("j_batchzip", lambda s, d: _batch(s, d), "SELECT doc_id, fig_idx, fig_id, md5(coalesce(caption, '')) AS result FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY fig_id) AS k FROM figures)")


def _batch(s: SparkSession, d: str) -> DataFrame:
    """Pages and engine results put together again by their place in the batch; a count that differs is an error."""
    w = Window.partitionBy("doc_id").orderBy("fig_id")
    pages = _figs(s, d).withColumn("k", F.row_number().over(w))
    results = pages.select("doc_id", "k", F.md5(F.coalesce("caption", F.lit(""))).alias("result"))
    joined = pages.join(results, ["doc_id", "k"], "full_outer")
    return joined.select("doc_id", "fig_idx", F.when(F.col("fig_id").isNull() | F.col("result").isNull(), F.raise_error(F.lit("results and pages differ in number"))).otherwise(F.col("fig_id")).cast("long").alias("fig_id"), "result")


_PX = [("a", 200, 149, "x1"), ("b", 150, 150, "x2"), ("c", 300, 400, "x3"), ("d", 300, 400, "x3")]
_PXS = "img string, w int, h int, xref string"
_q("f_minpx", lambda s, d: values(s, _PXS, _PX).filter((F.col("w") >= V.MIN_FIG_PX) & (F.col("h") >= V.MIN_FIG_PX)).select("img"), f"SELECT img FROM {sql_values(_PXS, _PX)} WHERE w >= 150 AND h >= 150")
_q("g_img", lambda s, d: _images(s), f"SELECT img, CAST(row_number() OVER (ORDER BY img) - 1 AS INTEGER) AS fig_num FROM (SELECT min(img) AS img FROM {sql_values(_PXS, _PX)} WHERE w >= 150 AND h >= 150 GROUP BY xref)")


def _images(s: SparkSession) -> DataFrame:
    kept = values(s, _PXS, _PX).filter((F.col("w") >= V.MIN_FIG_PX) & (F.col("h") >= V.MIN_FIG_PX)).withColumn("page", F.lit(1)).groupBy("page", "xref").agg(F.min("img").alias("img"))
    return kept.select("img", (F.row_number().over(Window.partitionBy("page").orderBy("img")) - 1).alias("fig_num"))


_q("f_label", lambda s, d: _blocks(s).filter(F.col("label").isin(V.TEXT_LABELS + list(V.HEADING_PREFIX) + ["table"] + V.FIGURE_LABELS)).select("page_num", "block_idx"), "SELECT CAST(a AS INTEGER) AS page_num, CAST(b AS INTEGER) AS block_idx FROM (VALUES (0, 0), (0, 2), (0, 4), (0, 5), (1, 1), (1, 2)) v(a, b)")
_BL = [(0, 0, "doc_title", "ANNONACEAE"), (0, 1, "header", "FLORE"), (0, 2, "text", "Garcinia kola Heckel"), (0, 3, "figure_title", "Fig. 1"), (0, 4, "image", ""), (0, 5, "text", "  "), (1, 0, "number", "12"), (1, 1, "chart", ""), (1, 2, "paragraph_title", "Habitat"), (1, 3, "mystery", "x")]


def _blocks(s: SparkSession) -> DataFrame:
    return values(s, "page_num int, block_idx int, label string, content string", _BL)


_q("g_blockmd", lambda s, d: L.block_markdown(_blocks(s)), "SELECT CAST(a AS INTEGER) AS page_num, CAST(b AS INTEGER) AS block_idx, c AS md, CAST(e AS INTEGER) AS fig_no FROM (VALUES (0, 0, '# ANNONACEAE', NULL), (0, 2, '### Garcinia kola Heckel', NULL), (0, 4, '[Figure 0 (p.1) — see figures.md]', 0), (1, 1, '[Figure 1 (p.2) — see figures.md]', 1), (1, 2, '### Habitat', NULL)) v(a, b, c, e)")
_STRIP = [("d", i, t) for i, t in enumerate(["text", "![](images/a.png)", "", "![](images/b.png)", "", "PL.1.- Eugenia", "", "![](images/c.png)", "more", "Planche 2. lost", "end"], 1)]
_LSS = "doc_id string, line_no int, line string"
_CAPM = r"(?i)^(?:PL\.?\s*[0-9]*[．・·.]?[\s—–-]|(?:Planche|Figure|Fig\.)\s+[0-9]+\s*\.)"


def _stripped(lines: DataFrame) -> DataFrame:
    """Runs of images and blanks that end at a caption become one placeholder; images without one stay, captions without images vanish."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    img, cap, blank = F.col("line").rlike(r"^!\[\]\(images/"), F.col("line").rlike(_CAPM), F.trim("line") == ""
    kinds = lines.withColumn("kind", F.when(img, "img").when(cap, "cap").when(blank, "blank").otherwise("text"))
    runs = kinds.withColumn("brk", F.coalesce((F.lag("kind").over(w).isin("text", "cap")), F.lit(True)) | (F.col("kind") == "text")).withColumn("run", F.sum(F.col("brk").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "run").agg(F.min("line_no").alias("line_no"), F.count_if(F.col("kind") == "img").alias("imgs"), F.max(F.when(F.col("kind") == "cap", F.col("line"))).alias("caption"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))


def _strip(s: SparkSession, d: str) -> DataFrame:
    runs = _stripped(values(s, _LSS, _STRIP))
    no = F.sum(((F.col("imgs") > 0) & F.col("caption").isNotNull()).cast("int")).over(Window.partitionBy("doc_id").orderBy("run").rowsBetween(Window.unboundedPreceding, 0))
    held = runs.withColumn("no", no)
    text = F.when((F.col("imgs") > 0) & F.col("caption").isNotNull(), F.format_string("[Figure %d — see figures.md]", "no")).otherwise(F.array_join(F.transform(F.filter("ls", lambda x: ~x["line"].rlike(_CAPM)), lambda x: x["line"]), "\n"))
    return held.select("run", text.alias("md")).filter("md <> ''")


_q("g_stripfig", _strip, "SELECT CAST(a AS BIGINT) AS run, b AS md FROM (VALUES (1, 'text'), (2, '[Figure 1 — see figures.md]'), (3, concat(chr(10), '![](images/c.png)')), (4, 'more'), (6, 'end')) v(a, b)")
_q("g_figmd", lambda s, d: _stripped(values(s, _LSS, _STRIP)).filter("imgs > 0 and caption is not null").select(F.row_number().over(Window.partitionBy("doc_id").orderBy("run")).alias("fig_no"), "imgs", "caption"), "SELECT 1::INTEGER AS fig_no, 2::BIGINT AS imgs, 'PL.1.- Eugenia' AS caption")

_IT = "page int, ord int, text string, x double, y double, size double"
ITEMS = [
    (1, 1, "FLORE", 10.0, 10.0, 9.0), (1, 2, "Clé", 10.0, 100.0, 11.0), (1, 3, "des genres", 50.0, 101.0, 11.0), (1, 4, "BiBliographie", 10.0, 120.0, 11.0), (1, 5, "large title", 10.0, 140.0, 19.0), (1, 6, "Fig. 3. leaf", 10.0, 160.0, 9.0),
    (1, 7, "– and fruit", 10.0, 165.0, 9.0), (1, 8, "Garcinia kola Heckel", 10.0, 180.0, 11.0), (1, 9, "b", 60.0, 200.0, 11.0), (1, 10, "a", 10.0, 200.0, 11.0), (1, 11, "foot", 10.0, 790.0, 11.0), (2, 1, "x", 1.0, 100.0, 9.5), (2, 2, "y", 1.0, 200.0, 11.0),
]
_items = lambda s: values(s, _IT, ITEMS)
VL = f"(SELECT page, CAST(round_even(y / 2.5, 0) AS INTEGER) AS band, string_agg(trim(text), ' ' ORDER BY x, ord) FILTER (WHERE trim(text) <> '') AS line, max(size) AS size, avg(y) AS mean_y FROM {sql_values(_IT, ITEMS)} GROUP BY page, band)"
for _n in ("a_vline", "o_visual"):
    _q(_n, lambda s, d: L.visual_lines(_items(s), "page").select("page", "band", "line"), f"SELECT page, band, line FROM {VL}")
_q("a_maxfs", lambda s, d: L.visual_lines(_items(s), "page").select("page", "band", "size"), f"SELECT page, band, size FROM {VL}")
_q("a_avgy", lambda s, d: L.visual_lines(_items(s), "page").select("page", "band", "mean_y"), f"SELECT page, band, mean_y FROM {VL}")
_q("f_runhdr_y", lambda s, d: L.visual_lines(_items(s), "page").filter(~L.is_margin(F.col("mean_y"), F.lit(800.0))).select("page", "band"), f"SELECT page, band FROM {VL} WHERE NOT (mean_y < 800 * 0.08 OR mean_y > 800 * 0.95)")
_q("a_mode", lambda s, d: L.body_size(_items(s), "page"), f"SELECT page, arg_max(size, n * 1000 - first) AS body FROM (SELECT page, size, count(*) AS n, min(ord) AS first FROM {sql_values(_IT, ITEMS)} GROUP BY page, size) GROUP BY page")
for _n in ("g_pagemd", "w_capstate"):
    _q(_n, lambda s, d: L.page_markdown(_items(s), _items(s).select("page").distinct().withColumn("height", F.lit(800.0))),
       "SELECT CAST(a AS INTEGER) AS page, CAST(b AS INTEGER) AS band, c AS kind, e AS md FROM (VALUES (1, 40, 'text', '### Clé des genres'), (1, 48, 'text', 'Bibliographie'), (1, 56, 'text', '## large title'), (1, 64, 'caption', 'Fig. 3. leaf – and fruit'), (1, 72, 'text', '### Garcinia kola Heckel'), (1, 80, 'text', 'a b'), (2, 40, 'text', 'x'), (2, 80, 'text', '### y')) v(a, b, c, e)")
