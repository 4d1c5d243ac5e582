"""Queries of the scalar functions and predicates, over real columns where the data has what they read, with literal edge cases beside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V
from scriptorium.operators.lineage import spread
from scriptorium.plans.base import LINES, Query, fold_sql, lines, mapped, sql_values, table, values

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _strings(rows: list[str]) -> tuple[Query, str]:
    data = [(r,) for r in rows]
    return (lambda spark, _: values(spark, "x string", data)), sql_values("x string", data)


def _with(rows: list[str], real: Query, real_sql: str) -> tuple[Query, str]:
    """Literal rows and a column of a table."""
    lit, lit_sql = _strings(rows)
    return (lambda s, d: lit(s, d).unionByName(real(s, d).select("x"))), f"(SELECT x FROM {lit_sql} UNION ALL SELECT x FROM ({real_sql}))"


def _add(name: str, source: tuple[Query, str], out, sql: str) -> None:  # noqa: ANN001
    QUERIES[name] = mapped(source[0], out)
    SQL[name] = f"SELECT input, {sql} AS output FROM (SELECT DISTINCT x AS input FROM {source[1]})"


def _list(words: list[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


heads = (lambda s, d: lines(s, d).filter(F.col("line").rlike("^#{1,6} ")).select(F.regexp_replace("line", "^#{1,6}\\s+", "").alias("x"))), f"SELECT regexp_replace(line, '^#{{1,6}}\\s+', '') AS x FROM {LINES} WHERE regexp_matches(line, '^#{{1,6}} ')"
names = (lambda s, d: table(s, d, "wiki_species").select(F.col("name").alias("x"))), "SELECT name AS x FROM wiki_species"
captions = (lambda s, d: table(s, d, "figures").select(F.col("caption").alias("x")).filter("x is not null")), "SELECT caption AS x FROM figures WHERE caption IS NOT NULL"
families = (lambda s, d: table(s, d, "documents_md").select(F.col("family").alias("x")).unionByName(table(s, d, "run_metadata").select(F.col("family").alias("x"))).filter("x is not null")), "SELECT family AS x FROM documents_md WHERE family IS NOT NULL UNION ALL SELECT family FROM run_metadata WHERE family IS NOT NULL"
doc_ids = (lambda s, d: table(s, d, "documents_md").select(F.col("doc_id").alias("x"))), "SELECT doc_id AS x FROM documents_md"
every_line = (lambda s, d: lines(s, d).select(F.col("line").alias("x"))), f"SELECT line AS x FROM {LINES}"

_add("p_letters", _with(["MYRT ACEAE", "Été 12", ""], *names), S.letters, "lower(regexp_replace(input, '[^A-Za-z]+', '', 'g'))")
_add("p_famnorm", _with(["myrtaceaelinn", "myr", "annonaceaeaceae"], lambda s, d: heads[0](s, d).select(S.letters(F.col("x")).alias("x")), f"SELECT lower(regexp_replace(x, '[^A-Za-z]+', '', 'g')) AS x FROM ({heads[1]})"), S.family_front,
     "CASE WHEN regexp_matches(input, '^[a-z]{4,30}(aceae|eaceae)') THEN concat(upper(substr(regexp_extract(input, '^([a-z]{4,30}(?:aceae|eaceae))', 1), 1, 1)), substr(regexp_extract(input, '^([a-z]{4,30}(?:aceae|eaceae))', 1), 2)) END")
_add("p_accent", _with(["THYMÉLÉACÉES", "œuvre", "ANNONACĒAE", "ŠAPOTACÉES", "Ebe\u0301nace\u0301es", "a\u00a0b² ½…"], *every_line), S.accents_folded, fold_sql("input"))

_NAME = "trim(regexp_replace(input, '\\s*\\(.*', ''))"
_FAM = ["ŠAPOTACĒES", "Ebe\u0301nace\u0301es", "ANNONACEES", "RUBIACEAE", "THYMÉLÉACÉES", "EBENACEES (Juss.)", "LEGUMINOSAE", "Palmae", "MYRTACÉES"]
_up = f"upper({fold_sql(_NAME)})"
_low = f"regexp_replace({_up}, '(?i)C[EÉ][AEÉ][ES]S?$', 'ceae')"
_nm = "trim(regexp_replace(input, '\\s*\\(.*', ''))"
_add("p_family", _with(_FAM, *families), S.family_name, f"CASE WHEN upper({_nm}) IN {_list(V.NOM_CONS)} THEN concat(upper({_nm}[1]), lower({_nm}[2:])) ELSE concat(upper(({_low})[1]), lower(({_low})[2:])) END")
_lowm = f"regexp_replace(upper({_nm}), '(?i)C[EÉ][AEÉ][ES]S?$', 'ceae')"
_add("p_family_m", _with(_FAM, *families), lambda x: S.family_name(x, scanned=False), f"concat(upper(({_lowm})[1]), lower(({_lowm})[2:]))")
_add("p_stem", _with(["EBENAC", "EBENACE", "EBENACEE", "EBENACÉE", "ABCAC", "EBENACEAE"], *heads), S.stem_repaired,
     "CASE WHEN regexp_matches(input, '^[A-ZÀ-Ý]{4,}AC$') THEN concat(input, 'EAE') WHEN regexp_matches(input, '^[A-ZÀ-Ý]{4,}ACE$') THEN concat(input, 'AE') WHEN regexp_matches(input, '^[A-ZÀ-Ý]{4,}(ACEE|ACÉE)$') THEN concat(input, 'S') END")
_plates = (lambda s, d: captions[0](s, d).select(F.regexp_extract("x", V.PLATE, 1).alias("x")).filter("x <> ''")), f"SELECT regexp_extract(x, '(?i)\\bPL\\.?\\s*([IVXLC]+)\\b', 1) AS x FROM ({captions[1]}) WHERE regexp_matches(x, '(?i)\\bPL\\.?\\s*[IVXLC]+\\b')"
_v = "list_transform(string_split(upper(input), ''), lambda c: CASE c WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 ELSE 0 END)"
_add("p_roman", _with(["XIV", "IX", "IIII", "A", "xc"], *_plates), S.roman, f"CAST(list_sum(list_transform(range(1, len({_v}) + 1), lambda i: CASE WHEN coalesce({_v}[i + 1], 0) > {_v}[i] THEN -{_v}[i] ELSE {_v}[i] END)) AS INTEGER)")
_add("p_termname", _with(["cotyledons fused..... 3. Eugenia.", "arbuste ou arbre..... 3", "young twigs quadrangular. Ps. Friedrichstahlianum.", "no taxon here 12", "a .. b .... 2'. Garcinia kola.", "leaves opposite..... Syzygium  gillettii . "], *every_line), S.terminal_name,
     "CASE WHEN regexp_matches(input, '\\.{2,}\\s*.+?\\.?\\s*$') THEN trim(regexp_replace(rtrim(trim(regexp_extract(input, '\\.{2,}\\s*(.+?)\\.?\\s*$', 1)), '.'), '^[0-9]+[''\"]?\\.\\s+', '')) WHEN regexp_matches(input, '[A-Z][a-z]*\\.?\\s+[A-Z]?[a-z]+[a-z.]*\\.?\\s*$') THEN rtrim(trim(regexp_extract(input, '([A-Z][a-z]*\\.?\\s+[A-Z]?[a-z]+[a-z.]*)\\.?\\s*$', 1)), '.') ELSE trim(input) END")

_RANK = ["MYRTACÉES", "INDEX DES MYRTACÉES", "MYRTACEAE Juss.", "1. PSIDIUM L.", "TAXA NOUVEAUX", "EUGENIA GABON", "1. Psidium cattleanum Sabine", "Psidium cattleanum Sabine", "IV. Xylopia aethiopica", "Eugenia sp. A", "a) var. guineense Keay", "CLÉ DES ESPÈCES", "GENRE Aub."]
_g = f"^(?:[0-9]+\\.\\s+)?([{V.UC}]{{3,}})\\s+([A-Z]\\S*)(?:\\s+.*)?$"
_rank_sql = (
    "CASE WHEN regexp_matches(trim(input), '^[a-z]\\)\\s+(var\\.|subsp\\.|ssp\\.|f\\.|fo\\.|forma)\\s') THEN 'infraspecific' "
    f"WHEN regexp_matches(trim(input), '^[{V.UC}]+(ACÉES|ACEAE|ACEES)$') THEN 'family' "
    f"WHEN regexp_matches(trim(input), '{_g}') AND upper(regexp_extract(trim(input), '{_g}', 1)) NOT IN {_list(V.STRUCTURAL)} AND (regexp_matches(regexp_extract(trim(input), '{_g}', 2), '\\p{{Ll}}') OR (length(regexp_extract(trim(input), '{_g}', 2)) <= 4 AND regexp_extract(trim(input), '{_g}', 2) LIKE '%.')) THEN 'genus' "
    f"WHEN regexp_matches(trim(input), '^([0-9]+|[IVX]{{1,4}})\\.\\s+[{V.UC}][{V.LC}]{{2,}}\\s+([{V.UC}]?[{V.LC}][{V.LC}-]+|sp\\.)') OR regexp_matches(trim(input), '^[{V.UC}][{V.LC}]{{2,}}\\s+sp\\.') THEN 'species' END"
)
_add("p_rank", _with(_RANK, *heads), S.rank, _rank_sql)
_add("p_author", _with(["L.", "DC.", "Gaertner", "GABON", "Oliv.", "X", ""], lambda s, d: table(s, d, "wiki_species").select(F.col("authority").alias("x")).filter("x is not null"), "SELECT authority AS x FROM wiki_species WHERE authority IS NOT NULL"), S.like_author, "((length(input) <= 4 AND input LIKE '%.') OR regexp_matches(input, '\\p{Ll}'))")
_add("p_structkw", _with(["Clé", "FLORE", "Psidium", "espèce"], lambda s, d: heads[0](s, d).select(F.element_at(F.split("x", " "), 1).alias("x")), f"SELECT string_split(x, ' ')[1] AS x FROM ({heads[1]})"), S.structural, f"upper(input) IN {_list(V.STRUCTURAL)}")
_LEVEL = ["ANNONACEAE", "LEGUMINOSAE", "MATÉRIEL ÉTUDIÉ", "Garcinia kola Heckel", "Garcinia", "Feuilles", "Le Gabon", "Xylopia aethiopica var. grandiflora Engl.", "Xylopia aethiopica var.grandiflora", "", "two\nlines", "Garcinia."]
_w1 = "regexp_extract(trim(input), '^(\\S+)', 1)"
_add("p_taxlevel", _with(_LEVEL, lambda s, d: heads[0](s, d).unionByName(names[0](s, d)), f"SELECT x FROM ({heads[1]}) UNION ALL SELECT x FROM ({names[1]})"), S.taxon_level,
     f"CASE WHEN trim(input) = '' OR contains(trim(input), chr(10)) THEN NULL WHEN regexp_matches({_w1}, '^[A-ZÀ-Ý]{{3,}}(CEAE|CÉES|CEES|ACEAE|ACÉES|ACEES|EAE)$') OR {_w1} IN {_list(V.NOM_CONS)} THEN '# ' "
     "WHEN regexp_matches(trim(input), '\\b(var\\.|subsp\\.|ssp\\.|f\\.|cv\\.)[A-Za-zÀ-ÿ0-9_]') AND regexp_matches(trim(input), '^[A-Z][a-z]{2,}') THEN '#### ' "
     f"WHEN regexp_matches(trim(input), '^[A-Z][a-z]{{2,30}}\\s+[a-z]{{3,30}}(-[a-z]+)?([\\s,(]|$)') AND regexp_extract(trim(input), '^([A-Z][a-z]{{2,30}})', 1) NOT IN {_list(V.NON_GENUS)} THEN '### ' "
     f"WHEN NOT regexp_matches(trim(input), '\\s') AND regexp_matches(trim(input), '^[A-Z][a-z]{{3,24}}\\.?$') AND rtrim(trim(input), '.') NOT IN {_list(V.NON_GENUS)} THEN '## ' END")
_add("p_slug", _with(["Foo – Bar (1998)", "Été", "---", "a__b"], *names), S.slug, "coalesce(nullif(regexp_replace(regexp_replace(lower(input), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'article')")
_add("p_truncref", _with(["6. E. obanensis.", "2. S. Gilletii.", "3. Ovary glabrous", "9. Ps. Friedrichstahlianum.", "E. obanensis", "4. E. " + "a" * 60], *every_line), S.truncated_reference,
     "(regexp_matches(input, '^[0-9]{1,2}(''|\"|[’′])*\\.\\s') AND regexp_matches(trim(regexp_replace(input, '^[0-9]{1,2}(''|\"|[’′])*\\.\\s', '')), '^[A-Z][a-z]*\\.\\s+[A-Z]?[a-z]') AND length(trim(regexp_replace(input, '^[0-9]{1,2}(''|\"|[’′])*\\.\\s', ''))) <= 50)")
_q = "[''\"’′]*"
_fix = "regexp_replace(input, '[．・·]', '.', 'g')"
for _start in ("[0-9]{1,2}", "[Il][0-9o]", "[Il]"):
    _fix = f"regexp_replace(regexp_replace({_fix}, '^({_start}{_q})\\.(\\S)', '\\1. \\2'), '^({_start}{_q})\\.$', '\\1. ')"
_add("p_ocrfix", _with(["I.Text", "Io. Text", "I2'.Text", "9.Text", "II. Text", "12.", "l'. leaves", "3．Text", "I. a"], *every_line), S.couplet_digits,
     f"CASE WHEN regexp_matches({_fix}, '^[Il][0-9o]{_q}\\.\\s') THEN concat('1', CASE WHEN ({_fix})[2] = 'o' THEN '0' ELSE ({_fix})[2] END, regexp_replace(({_fix})[3:], '^({_q})\\.\\s', '\\1. ')) WHEN regexp_matches({_fix}, '^[Il]{_q}\\.\\s') THEN concat('1', ({_fix})[2:]) ELSE {_fix} END")
_add("p_figref", _with(["see [Figure 3 (p.4)] and [Figure 12 (p.9)], [Figure 3 (p.4)]", "none"], lambda s, d: table(s, d, "documents_md").select(F.col("text").alias("x")).filter("x is not null"), "SELECT text AS x FROM documents_md WHERE text IS NOT NULL"), lambda x: F.array_join(S.figure_ids(x), ","),
     "array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(input, '\\[Figure ([0-9]+) \\(p\\.[0-9]+\\)', 1), lambda v: CAST(v AS INTEGER)))), ',')")
for _n in ("p_figref",):
    QUERIES[_n] = (lambda q: lambda s, d: q(s, d).select(F.md5("input").alias("input"), "output"))(QUERIES[_n])
    SQL[_n] = SQL[_n].replace("SELECT input,", "SELECT md5(input) AS input,", 1)
_add("p_mixed", _with(["BiBliographie du GaBon", "ABCd normal Words", "McDonald LeTestui x", "aBCD EsPèce"], *every_line), S.mixed_case,
     "array_to_string(list_transform(regexp_extract_all(input, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+'), lambda t: CASE WHEN regexp_matches(t, '^[A-Z][a-z]+[A-Z][A-Za-z]{2,}$') THEN concat(t[1], lower(t[2:])) ELSE t END), '')")
_add("p_caption", _with(["![](figures/fig_1.png)\n*Caption:* PL. I. — Eugenia x\n", "*Caption:* (no caption)", "nothing", "*Caption:*   spaced  "], *captions), S.caption_of,
     "CASE WHEN contains(trim(regexp_extract(input, '\\*Caption:\\*\\s*(.+)', 1)), '(no caption') THEN '' ELSE trim(regexp_extract(input, '\\*Caption:\\*\\s*(.+)', 1)) END")
_add("p_figname_key", _with(["3. Eugenia whytei", "IV. Syzygium gillettii.", "Eugenia", "2'. Psidium Guajava."], *names), S.figure_epithet,
     "CASE WHEN len(string_split_regex(trim(regexp_replace(input, '^([0-9]+|[IVX]+)[''\"]?\\.\\s+', '')), '\\s+')) >= 2 THEN lower(rtrim(string_split_regex(trim(regexp_replace(input, '^([0-9]+|[IVX]+)[''\"]?\\.\\s+', '')), '\\s+')[-1], '.')) END")
_add("p_iscap", _with(["Fig. 3. leaf", "Planche 12a: x", "Figure 3(D)", "Pl. 4."], *captions), S.is_caption, "regexp_matches(input, '(?i)^(Figure|Fig\\.|Planche|Pl\\.|Tableau|Tab\\.)\\s*[0-9]+[A-Za-z]?\\s*[.:]')")
_add("f_species", _with(["Garcinia kola Heckel", "Garcinia kola (Heckel) Engl.", "Garcinia kola Heckel (1898)", "Garcinia kola Heckel similis", "Xylopia aethiopica var. grandiflora Engl."], *every_line), S.is_species_heading,
     "(regexp_matches(input, '^[A-Z][a-z]{3,}\\s+[a-z]{4,}[a-z-]*(\\s+(subsp|var|f)\\.\\s+[a-z]{3,})?\\s+[A-Z(]') AND NOT regexp_matches(input, '\\b(1[6-9][0-9]{2}|20[0-9]{2})\\b') AND NOT regexp_matches(input, '(?i)\\b(similis|affinis|differt|distincta|separatur)\\b'))")
_add("f_keyhead", _with(["### KEY TO SPECIES", "# Clé des genres", "## CLES", "# CLEFS DES", "KEY", "#### clé"], *every_line), lambda x: x.rlike(V.KEY_HEADING), "regexp_matches(input, '(?i)^#{1,6}\\s+(KEY(\\s|[^A-Za-zÀ-ÿ0-9_]|$)|CL[EÉé]S?([^A-Za-zÀ-ÿ0-9_]|$))')")
_add("f_skipword", _with(["De", "Garcinia"], lambda s, d: captions[0](s, d).select(F.explode(F.regexp_extract_all("x", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("x")), f"SELECT unnest(regexp_extract_all(x, '[A-Z][a-z]+')) AS x FROM ({captions[1]})"), lambda x: ~x.isin(V.SKIP_WORDS), f"input NOT IN {_list(V.SKIP_WORDS)}")
_add("f_nongenus", _with(["La", "Garcinia", "Feuilles"], lambda s, d: heads[0](s, d).select(F.element_at(F.split("x", " "), 1).alias("x")), f"SELECT string_split(x, ' ')[1] AS x FROM ({heads[1]})"), lambda x: ~x.isin(V.NON_GENUS), f"input NOT IN {_list(V.NON_GENUS)}")
_add("f_blank", _with(["", "  ", "---", "<!-- page 3 -->", "x"], *every_line), lambda x: (F.trim(x) != "") & (F.trim(x) != "---") & ~F.trim(x).startswith("<!-- page"), "(trim(input) <> '' AND trim(input) <> '---' AND NOT starts_with(trim(input), '<!-- page'))")
_add("p_leaders", _with(["a .. b", "a . b"], *every_line), lambda x: x.rlike(V.LEADERS), "regexp_matches(input, '\\.{2,}')")
_add("p_srctype", _with(["Buxaceae_vol57_paddle", "vol57_marker", "x"], *doc_ids), lambda x: F.when(x.contains("_paddle"), "paddle").otherwise("marker"), "CASE WHEN contains(input, '_paddle') THEN 'paddle' ELSE 'marker' END")
_add("p_mask", _strings(["<< /ImageMask true >>", "<< /ImageMask false >>"]), lambda x: x.contains("/ImageMask true"), "contains(input, '/ImageMask true')")
_add("p_ext", _with(["a.JPG", "b.tiff", "c"], lambda s, d: table(s, d, "figures").select(F.col("filename").alias("x")).filter("x is not null"), "SELECT filename AS x FROM figures WHERE filename IS NOT NULL"), lambda x: F.when(F.lower(F.regexp_extract(x, r"\.([A-Za-z0-9]+)$", 1)).isin("png", "jpg", "jpeg"), "kept").otherwise("png"), "CASE WHEN lower(regexp_extract(input, '\\.([A-Za-z0-9]+)$', 1)) IN ('png', 'jpg', 'jpeg') THEN 'kept' ELSE 'png' END")


def _rows(name: str, run: Query, sql: str) -> None:
    QUERIES[name] = run
    SQL[name] = sql


_BINOM = "\\b([A-Z][a-z]+)\\s+([A-Za-z][a-z]{2,})\\b"
_rows("p_binom",
      lambda s, d: table(s, d, "figures").select("fig_id", F.posexplode(F.arrays_zip(F.regexp_extract_all("caption", F.lit(r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b"), F.lit(1)).alias("g"), F.regexp_extract_all("caption", F.lit(r"\b([A-Z][a-z]+)\s+([A-Za-z][a-z]{2,})\b"), F.lit(2)).alias("e"))).alias("k", "b"))
      .filter(F.col("k") == 0).select("fig_id", F.lower(F.concat("b.g", F.lit(":"), "b.e")).alias("first_key")),
      f"SELECT fig_id, lower(concat(regexp_extract(caption, '{_BINOM}', 1), ':', regexp_extract(caption, '{_BINOM}', 2))) AS first_key FROM figures WHERE regexp_matches(caption, '{_BINOM}')")
_rows("p_plate", lambda s, d: table(s, d, "figures").filter(F.col("caption").rlike(V.PLATE)).select("fig_id", F.upper(F.regexp_extract("caption", V.PLATE, 1)).alias("plate")),
      "SELECT fig_id, upper(regexp_extract(caption, '(?i)\\bPL\\.?\\s*([IVXLC]+)\\b', 1)) AS plate FROM figures WHERE regexp_matches(caption, '(?i)\\bPL\\.?\\s*[IVXLC]+\\b')")
_rows("p_heading", lambda s, d: lines(s, d).withColumns({"level": S.heading(F.col("line"))[0], "head": S.heading(F.col("line"))[1]}).filter("level is not null").select("doc_id", "line_no", "level", "head"),
      f"SELECT doc_id, line_no, CAST(length(regexp_extract(line, '^(#+)', 1)) AS INTEGER) AS level, trim(regexp_replace(line, '^#+\\s+', '')) AS head FROM {LINES} WHERE regexp_matches(line, '^#{{1,6}}\\s+')")
_rows("p_relevel", lambda s, d: lines(s, d).withColumn("h", S.heading(F.col("line"))[1]).withColumn("lv", S.rank_level(S.rank(F.col("h")))).filter("lv is not null").select("doc_id", "line_no", F.concat(F.expr("repeat('#', lv)"), F.lit(" "), "h").alias("relevelled")),
      f"SELECT doc_id, line_no, concat(repeat('#', CASE r WHEN 'family' THEN 2 WHEN 'genus' THEN 3 WHEN 'species' THEN 4 ELSE 5 END), ' ', input) AS relevelled FROM (SELECT *, {_rank_sql} AS r FROM (SELECT doc_id, line_no, trim(regexp_replace(line, '^#+\\s+', '')) AS input FROM {LINES} WHERE regexp_matches(line, '^#{{1,6}}\\s+'))) WHERE r IS NOT NULL")
_rows("p_pageno", lambda s, d: lines(s, d).withColumn("page", S.page_number(F.col("line"))).filter("page is not null").select("doc_id", "line_no", "page"),
      f"SELECT doc_id, line_no, CAST(regexp_extract(line, '<!--\\s*page\\s+([0-9]+)\\s*-->', 1) AS INTEGER) AS page FROM {LINES} WHERE regexp_matches(line, '<!--\\s*page\\s+[0-9]+\\s*-->')")
_rows("p_fmttime", lambda s, d: table(s, d, "run_metadata").select(F.col("elapsed_seconds").alias("seconds")).unionByName(values(s, "seconds double", [(59.0,), (3600.0,), (3725.9,), (0.4,)])).filter("seconds is not null").distinct().select("seconds", S.duration(F.col("seconds")).alias("shown")),
      "SELECT seconds, CASE WHEN floor(seconds) >= 3600 THEN printf('%dh %02dm', CAST(floor(seconds) AS BIGINT) // 3600, CAST(floor(seconds) AS BIGINT) % 3600 // 60) ELSE printf('%dm %02ds', CAST(floor(seconds) AS BIGINT) // 60, CAST(floor(seconds) AS BIGINT) % 60) END AS shown FROM (SELECT DISTINCT seconds FROM (SELECT elapsed_seconds AS seconds FROM run_metadata UNION ALL SELECT unnest([59.0, 3600.0, 3725.9, 0.4]::DOUBLE[])) WHERE seconds IS NOT NULL)")
_rows("p_roundup", lambda s, d: table(s, d, "run_metadata").filter("char_count is not null").select("char_count").distinct().select("char_count", S.rounded_up(F.col("char_count")).alias("rounded")),
      "SELECT DISTINCT char_count, CAST(ceil(char_count / 32.0) * 32 AS BIGINT) AS rounded FROM run_metadata WHERE char_count IS NOT NULL")
_rows("p_figname", lambda s, d: table(s, d, "figures").select("fig_id", S.figure_file(F.col("fig_idx"), F.col("page")).alias("name")), "SELECT fig_id, printf('fig_%03d_p%04d.png', fig_idx, page) AS name FROM figures")
_rows("p_figph", lambda s, d: table(s, d, "figures").select("fig_id", S.placeholder(F.col("fig_idx"), F.col("page")).alias("shown")), "SELECT fig_id, printf('[Figure %d (p.%d) — see figures.md]', fig_idx, page) AS shown FROM figures")
_rows("p_linestr", lambda s, d: table(s, d, "wiki_species").filter("distribution is not null").select("page_id", S.joined(F.col("distribution")).alias("joined")), "SELECT page_id, array_to_string(list_filter(list_transform(distribution, lambda t: trim(t)), lambda t: t <> ''), ' ') AS joined FROM wiki_species WHERE distribution IS NOT NULL")
_rows("p_plaintext", lambda s, d: table(s, d, "documents_md").filter("text is not null").select("doc_id", F.md5(S.joined(F.split("text", "\n"))).alias("plain")), "SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda t: trim(t, ' ')), lambda t: t <> ''), ' ')) AS plain FROM documents_md WHERE text IS NOT NULL")
_LABELS = [("5",), ("5bis",), ("01",), ("11",), ("x",)]
_rows("p_label_key", lambda s, d: _labels(s, d).select("label", *[c.alias(n) for c, n in zip(S.label_key(F.col("label")), ("num", "is_bis"))]),
      f"SELECT label, coalesce(TRY_CAST(nullif(regexp_extract(label, '^([0-9]+)(?:bis)?$', 1), '') AS BIGINT), 1000000000) AS num, label LIKE '%bis' AS is_bis FROM (SELECT DISTINCT volume AS label FROM documents_md WHERE volume IS NOT NULL UNION SELECT label FROM {sql_values('label string', _LABELS)})")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents_md").filter("volume is not null").select(F.col("volume").alias("label")).union(values(spark, "label string", _LABELS)).distinct()


_rows("o_label", lambda s, d: _ordered_labels(s, d), f"SELECT label, row_number() OVER (ORDER BY coalesce(TRY_CAST(nullif(regexp_extract(label, '^([0-9]+)(?:bis)?$', 1), '') AS BIGINT), 1000000000), label LIKE '%bis', label) AS pos FROM (SELECT DISTINCT trim(volume) AS label FROM documents_md WHERE volume IS NOT NULL UNION SELECT label FROM {sql_values('label string', _LABELS)})")


def _ordered_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    # the list of volumes of a series, some dozens: a global order is a single small task
    return _labels(spark, sf_dir).select(F.trim("label").alias("label")).distinct().select("label", F.row_number().over(Window.orderBy(*S.label_key(F.col("label")))).cast("long").alias("pos"))


def _label_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "run_metadata").filter("vol_label is not null").select("vol_label").distinct()
    raw = table(spark, sf_dir, "documents_md").filter("volume is not null").select(F.col("volume").alias("label")).distinct()
    tries = raw.select("label", F.explode(F.array(F.struct(F.lit(1).alias("k"), F.col("label").alias("vol_label")), F.struct(F.lit(2).alias("k"), F.lpad(F.trim("label"), 2, "0").alias("vol_label")), F.struct(F.lit(3).alias("k"), F.regexp_replace(F.trim("label"), "^0+", "").alias("vol_label")))).alias("t"))
    hit = tries.select("label", "t.k", "t.vol_label").join(known, "vol_label").groupBy("label").agg(F.min_by("vol_label", "k").alias("resolved"))
    return raw.join(hit, "label", "left").select("label", "resolved")


_rows("p_label_norm", _label_norm, "WITH k AS (SELECT DISTINCT vol_label AS v FROM run_metadata WHERE vol_label IS NOT NULL), r AS (SELECT DISTINCT volume AS label FROM documents_md WHERE volume IS NOT NULL) SELECT label, coalesce((SELECT v FROM k WHERE v = label), (SELECT v FROM k WHERE v = CASE WHEN length(trim(label)) > 2 THEN left(trim(label), 2) ELSE lpad(trim(label), 2, '0') END), (SELECT v FROM k WHERE v = ltrim(trim(label), '0'))) AS resolved FROM r")
_KEYID = [("KEY TO GENERA", "Myrtaceae", None), ("KEY TO SPECIES", "Myrtaceae", "Psidium"), ("Clé des espèces du Gabon", None, None), ("genera key", None, None)]
_KEYID_S = "heading string, family string, genus string"


def _key_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, _KEYID_S, _KEYID).unionByName(table(spark, sf_dir, "key_index").select(F.col("name").alias("heading"), "family", "genus")).distinct()
    ident, shown, own = S.key_id(F.col("heading"), F.col("family"), F.col("genus"))
    return rows.select("heading", "family", "genus", ident.alias("key_id"), shown.alias("display"), own.alias("own_genus"))


_ws = "regexp_replace(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}_]+', '_', 'g'), '^_+|_+$', '', 'g')"
_kid = f"CASE WHEN contains(upper(heading), 'GENERA') AND family IS NOT NULL THEN concat('genera_', {_ws.format('family')}) WHEN genus IS NOT NULL THEN concat('species_', lower(genus)) ELSE {_ws.format('heading')} END"
_rows("p_keyid", _key_id, f"SELECT heading, family, genus, {_kid} AS key_id, CASE WHEN contains(upper(heading), 'GENERA') AND family IS NOT NULL THEN concat('Key to ', family, ' Genera') WHEN genus IS NOT NULL THEN concat('Key to ', genus) ELSE heading END AS display, CASE WHEN starts_with({_kid}, 'species_') THEN substr({_kid}, 9) END AS own_genus FROM (SELECT DISTINCT heading, family, genus FROM (SELECT * FROM {sql_values(_KEYID_S, _KEYID)} UNION ALL SELECT name, family, genus FROM key_index))")
_COUP = [("9. Leaves opposite",), ("9'. Leaves alternate",), ("5''. text",), ("5\". text",), ("123. no",), ("7.no",), ("8’. curly",)]
_rows("p_couplet", lambda s, d: values(s, "line string", _COUP).unionByName(lines(s, d).select("line")).distinct().withColumns(dict(zip(("num", "prime", "rest"), S.couplet(F.col("line"))))).filter("num is not null"),
      f"SELECT line, CAST(regexp_extract(line, '^([0-9]{{1,2}})', 1) AS INTEGER) AS num, regexp_extract(line, '^[0-9]{{1,2}}((?:''|\"|[’′])*)\\.\\s', 1) AS prime, regexp_replace(line, '^[0-9]{{1,2}}(''|\"|[’′])*\\.\\s', '') AS rest FROM (SELECT DISTINCT line FROM (SELECT line FROM {sql_values('line string', _COUP)} UNION ALL SELECT line FROM {LINES})) WHERE regexp_matches(line, '^[0-9]{{1,2}}(''|\"|[’′])*\\.\\s')")
_DASH = [("1. - a",), ("- b",), ("12. - c d",), ("-e",), ("1. f",)]
_rows("p_dash", lambda s, d: values(s, "line string", _DASH).select("line", F.when(F.col("line").rlike(V.DASH_COUPLET), F.regexp_extract("line", V.DASH_COUPLET, 1).cast("int")).alias("num"), F.col("line").rlike(V.BARE_DASH).alias("bare")),
      f"SELECT line, TRY_CAST(nullif(regexp_extract(line, '^([0-9]{{1,2}})\\.\\s+-\\s+', 1), '') AS INTEGER) AS num, regexp_matches(line, '^-\\s+') AS bare FROM {sql_values('line string', _DASH)}")
_NODEKEY_SQL = "SELECT DISTINCT choice_prime, concat(ord, coalesce(choice_prime, '')) AS node_key FROM nav_events"
_rows("p_nodekey", lambda s, d: table(s, d, "nav_events").select("choice_prime", F.concat(F.col("ord").cast("string"), F.coalesce("choice_prime", F.lit(""))).alias("node_key")).distinct(), _NODEKEY_SQL)
_NUM = [("3",), ("12",), ("Eugenia",), ("3a",), ("",)]
_rows("p_numterm", lambda s, d: values(s, "name string", _NUM).select("name", F.when(F.col("name").rlike("^[0-9]+$"), F.col("name").cast("int")).alias("leads_to"), (~F.col("name").rlike("^[0-9]+$")).alias("is_terminal")),
      f"SELECT name, CASE WHEN regexp_matches(name, '^[0-9]+$') THEN TRY_CAST(name AS INTEGER) END AS leads_to, NOT regexp_matches(name, '^[0-9]+$') AS is_terminal FROM {sql_values('name string', _NUM)}")
_CTX = [("# 1. PSIDIUM L.",), ("## MYRTACEAE",), ("### Myrtaceae Juss.",), ("# 12. EU L.",), ("##### RUBIACEAE",)]
_rows("p_keyctxre", lambda s, d: values(s, "head string", _CTX).unionByName(lines(s, d).filter(F.col("line").startswith("#")).select(F.col("line").alias("head"))).distinct().select("head", F.initcap(F.lower(F.nullif(F.regexp_extract("head", r"^#{1,6}\s+[0-9]+\.\s+([A-Z]{2,})\b", 1), F.lit("")))).alias("genus"), F.initcap(F.lower(F.nullif(F.regexp_extract("head", r"(?i)^#{1,4}\s+([A-Z]{4,}(?:ACEAE|EACEAE))", 1), F.lit("")))).alias("family")),
      f"WITH h AS (SELECT head, nullif(regexp_extract(head, '^#{{1,6}}\\s+[0-9]+\\.\\s+([A-Z]{{2,}})\\b', 1), '') AS g, nullif(regexp_extract(head, '(?i)^#{{1,4}}\\s+([A-Z]{{4,}}(?:ACEAE|EACEAE))', 1), '') AS f FROM (SELECT DISTINCT head FROM (SELECT head FROM {sql_values('head string', _CTX)} UNION ALL SELECT line FROM {LINES} WHERE starts_with(line, '#')))) SELECT head, concat(g[1], lower(g[2:])) AS genus, concat(f[1], lower(f[2:])) AS family FROM (SELECT head, g, upper(f) AS f FROM h)")
SQL["p_keyctxre"] = SQL["p_keyctxre"].replace("concat(g[1], lower(g[2:]))", "g[1] || lower(g[2:])").replace("concat(f[1], lower(f[2:]))", "f[1] || lower(f[2:])")
_LAB = [("doc_title", "ANNONACEAE"), ("paragraph_title", "Habitat"), ("text", "Garcinia kola Heckel"), ("text", "plain words here"), ("header", "X")]


def _headpref(x: Column, label: Column) -> Column:
    own = F.lit(None).cast("string")
    for k, p in V.HEADING_PREFIX.items():
        own = F.when(label == k, p).otherwise(own)
    return F.coalesce(S.taxon_level(x), own)


_rows("p_headpref", lambda s, d: values(s, "label string, content string", _LAB).select("label", "content", _headpref(F.col("content"), F.col("label")).alias("prefix")),
      f"SELECT label, content, CASE content WHEN 'ANNONACEAE' THEN '# ' WHEN 'Garcinia kola Heckel' THEN '### ' ELSE CASE WHEN content = 'Habitat' THEN '### ' END END AS prefix FROM {sql_values('label string, content string', _LAB)}")
_FONT = [(11.0, 11.0, "body"), (18.7, 11.0, "big"), (12.65, 11.0, "mid"), (12.6, 11.0, "near")]
_rows("p_fonthead", lambda s, d: values(s, "size double, body double, text string", _FONT).select("size", "text", S.font_heading(F.col("size"), F.col("body"), F.col("text")).alias("md")),
      f"SELECT size, text, concat(CASE WHEN size >= body * 1.7 THEN '## ' WHEN size >= body * 1.15 THEN '### ' ELSE '' END, text) AS md FROM {sql_values('size double, body double, text string', _FONT)}")
_rows("p_dirname", lambda s, d: table(s, d, "documents_md").select("doc_id", *[F.regexp_extract("doc_id", "^([^/]+)_vol([^_]+)_([a-z]+)", k).alias(n) for k, n in ((1, "fam"), (2, "vol"), (3, "eng"))]),
      "SELECT doc_id, regexp_extract(doc_id, '^([^/]+)_vol([^_]+)_([a-z]+)', 1) AS fam, regexp_extract(doc_id, '^([^/]+)_vol([^_]+)_([a-z]+)', 2) AS vol, regexp_extract(doc_id, '^([^/]+)_vol([^_]+)_([a-z]+)', 3) AS eng FROM documents_md")
_LINKS = [("A:k1, B : k2,bad,C:k:3",), ("",), ("X:y",)]
_rows("p_links", lambda s, d: values(s, "spec string", _LINKS).select("spec", F.explode(F.filter(F.split("spec", ","), lambda t: t.contains(":"))).alias("t")).select("spec", F.trim(F.regexp_extract("t", "^([^:]*):", 1)).alias("genus"), F.trim(F.regexp_extract("t", "^[^:]*:(.*)$", 1)).alias("key_id")),
      f"SELECT spec, trim(split_part(t, ':', 1)) AS genus, trim(substr(t, position(':' IN t) + 1)) AS key_id FROM (SELECT spec, unnest(string_split(spec, ',')) AS t FROM {sql_values('spec string', _LINKS)}) WHERE contains(t, ':')")
_AREA = [(0.0, 0.0, 100.0, 65.0, 100.0, 100.0, 500), (0.0, 0.0, 100.0, 64.0, 100.0, 100.0, 900), (10.0, 10.0, 90.0, 100.0, 100.0, 100.0, 499), (0.0, 0.0, 100.0, 100.0, 100.0, 100.0, 2000)]
_AREA_S = "x0 double, y0 double, x1 double, y1 double, w double, h double, chars int"
_rows("p_area", lambda s, d: values(s, _AREA_S, _AREA).withColumn("background", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (F.col("w") * F.col("h")) >= V.PAGE_AREA) & (F.col("chars") >= V.PAGE_CHARS)), f"SELECT *, (x1 - x0) * (y1 - y0) / (w * h) >= 0.65 AND chars >= 500 AS background FROM {sql_values(_AREA_S, _AREA)}")
_rows("f_bg", lambda s, d: QUERIES["p_area"](s, d).filter(~F.col("background")).drop("background"), f"SELECT * FROM {sql_values(_AREA_S, _AREA)} WHERE NOT ((x1 - x0) * (y1 - y0) / (w * h) >= 0.65 AND chars >= 500)")
_IMG = [("d1", "a ![](images/h1.png) b ![](images/h9.png)"), ("d2", "none"), ("d3", "![](images/h2.jpg)")]
_MAP = [("h1.png", "fig_001.png"), ("h2.jpg", "fig_002.jpg")]
_map_sql = sql_values("hash string, name string", _MAP)


def _imgref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References rewritten by one pass of the map over each text (the map of a document's images is small)."""
    names_of = F.lit(None)
    table_of = values(spark, "hash string, name string", _MAP).agg(F.map_from_entries(F.collect_list(F.struct("hash", "name"))).alias("m"))
    del names_of
    docs = values(spark, "doc_id string, text string", _IMG)
    return docs.crossJoin(F.broadcast(table_of)).select("doc_id", F.aggregate(F.map_entries("m"), F.col("text"), lambda acc, e: F.replace(acc, F.concat(F.lit("![](images/"), e["key"], F.lit(")")), F.concat(F.lit("![](figures/"), e["value"], F.lit(")")))).alias("t")).select("doc_id", F.replace("t", F.lit("![](images/"), F.lit("![](figures/")).alias("text"))


_rows("p_imgref", _imgref, f"SELECT doc_id, replace(replace(replace(text, '![](images/h1.png)', '![](figures/fig_001.png)'), '![](images/h2.jpg)', '![](figures/fig_002.jpg)'), '![](images/', '![](figures/') AS text FROM {sql_values('doc_id string, text string', _IMG)}")
_rows("p_prompt", lambda s, d: table(s, d, "bilingual_md").select("pair_id", F.md5(F.concat(F.lit("Translate into English; output only the translation.\n\n"), "text")).alias("request")), "SELECT pair_id, md5(concat('Translate into English; output only the translation.', chr(10), chr(10), text)) AS request FROM bilingual_md WHERE text IS NOT NULL")
_rows("p_garbage", lambda s, d: spread(table(s, d, "documents").select("doc_id", "text"), "doc_id").select("doc_id", S.garbage_score(F.col("text")).alias("score")),
      "WITH t AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\\s+'), lambda t: t <> '') AS ts FROM documents) SELECT doc_id, CAST(CASE WHEN len(ts) < 20 THEN 0 ELSE 3 * len(list_filter(ts, lambda t: len(list_filter(regexp_extract_all(t, '[\\p{L}\\p{N}_]{6,}'), lambda w: regexp_matches(w, '[A-Za-z]') AND regexp_matches(w, '[0-9]'))) > 0)) + 2 * len(list_filter(ts, lambda t: len(list_filter(regexp_extract_all(t, '[\\p{L}\\p{N}_]+'), lambda w: regexp_matches(w, '^[A-Za-z]{2,}[A-Z][A-Za-z]{2,}$'))) > 0 AND regexp_matches(t, '\\p{Ll}') AND NOT regexp_matches(t, '^\\p{Lu}[^\\p{Lu}]*$'))) + 2 * len(list_filter(ts, lambda t: len(list_filter(regexp_extract_all(t, '[\\p{L}\\p{N}_]+'), lambda w: regexp_matches(w, '^\\p{L}*[a-zà-ÿ][À-Ý][a-zà-ÿ]+$'))) > 0)) + 2 * len(list_filter(ts, lambda t: regexp_matches(t, '^[%&$#/][A-Za-z0-9]{6,}$'))) + 2 * len(regexp_extract_all(text, '[¶§¦]')) END AS INTEGER) AS score FROM t")
_rows("p_breadcrumb", lambda s, d: table(s, d, "nav_events").filter("event_id is not null").dropDuplicates(["event_id"]).groupBy("session_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "event_id", "choice_prime"))), lambda e: F.concat(e["ord"].cast("string"), F.coalesce(e["choice_prime"], F.lit("")))), " → ").alias("path")),
      "SELECT session_key, string_agg(concat(ord, coalesce(choice_prime, '')), ' → ' ORDER BY ord, event_id) AS path FROM (SELECT DISTINCT event_id, session_key, ord, choice_prime FROM nav_events) GROUP BY session_key")
QUERIES["p_bread"], SQL["p_bread"] = QUERIES.pop("p_breadcrumb"), SQL.pop("p_breadcrumb")
