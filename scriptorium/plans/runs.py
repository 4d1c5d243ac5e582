"""Queries over runs, sessions, species pages, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V
from scriptorium.operators import documents as D
from scriptorium.operators.lineage import shared_folder
from scriptorium.plans.base import PAGED, Query, lines, paged, sql_values, table, values
from scriptorium.plans.documents import DROPPED, KEPT, TAXA, corrupt, decorated
from scriptorium.sources import engines, files, sinks
from scriptorium.streaming import incremental, sessions

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _q(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql:
        SQL[name] = sql


_q("t_session", lambda s, d: sessions.folded(table(s, d, "nav_events")),
   """WITH e AS (SELECT DISTINCT event_id, session_key, ord, nav_action, key_id FROM nav_events WHERE session_key IS NOT NULL),
   l AS (SELECT *, sum(CASE WHEN nav_action IN ('restart', 'jump') THEN 1 ELSE 0 END) OVER (PARTITION BY session_key ORDER BY ord, event_id ROWS UNBOUNDED PRECEDING) AS leg, CASE nav_action WHEN 'choose' THEN 1 WHEN 'back' THEN -1 ELSE 0 END AS mv FROM e),
   r AS (SELECT *, sum(mv) OVER (PARTITION BY session_key, leg ORDER BY ord, event_id ROWS UNBOUNDED PRECEDING) AS sm FROM l),
   p AS (SELECT *, sm - least(0, min(sm) OVER (PARTITION BY session_key, leg ORDER BY ord, event_id ROWS UNBOUNDED PRECEDING)) AS dp, row_number() OVER (PARTITION BY session_key ORDER BY ord DESC, event_id DESC) AS r1 FROM r)
   SELECT session_key, count(*) AS steps, CAST(max(CASE WHEN r1 = 1 THEN dp END) AS INTEGER) AS depth, max(CASE WHEN r1 = 1 THEN nav_action END) AS last_action, arg_min(key_id, r1) FILTER (WHERE key_id IS NOT NULL) AS last_key, CASE WHEN max(CASE WHEN r1 = 1 THEN dp END) = 0 THEN 'start' ELSE 'inside' END AS phase FROM p GROUP BY session_key""")


def _streamed(s: SparkSession, d: str) -> DataFrame:
    """The stream form of the fold over the whole table, run to its end into a table in the shared checkpoint folder."""
    import os
    import uuid

    shared = shared_folder(s, "scriptorium-runs")
    place = os.path.join(shared, f"t_session_{uuid.uuid4().hex}")
    events = table(s, d, "nav_events").select("event_id", "session_key", "ord", "nav_action", "key_id").filter("session_key is not null")
    stream = s.readStream.schema(events.schema).option("maxFilesPerTrigger", 64).parquet(f"{d}/nav_events.parquet").select(*events.columns) if os.path.isdir(f"{d}/nav_events.parquet") else s.readStream.schema(events.schema).option("pathGlobFilter", "nav_events.parquet").parquet(d).select(*events.columns)
    kept = s.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = sessions.streamed(stream.filter("session_key is not null"))
        query = out.writeStream.outputMode("update").foreachBatch(lambda b, n: b.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{place}/out")).option("checkpointLocation", f"{place}/ckpt").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if kept is None:
            s.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            s.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return s.read.parquet(f"{place}/out").groupBy("session_key").agg(F.max_by(F.struct("steps", "depth", "last_key"), F.col("batch")).alias("v")).select("session_key", "v.*")


_q("t_session_stream", _streamed, f"SELECT session_key, CAST(steps AS INTEGER) AS steps, depth, last_key FROM ({SQL['t_session']})")
_q("t_incr", lambda s, d: incremental.pending(table(s, d, "documents_md"), table(s, d, "run_metadata").filter("figure_count > 10"), "doc_id").select("doc_id", "engine"), "SELECT doc_id, engine FROM documents_md WHERE doc_id NOT IN (SELECT doc_id FROM run_metadata WHERE figure_count > 10)")


def _routes(s: SparkSession, d: str) -> DataFrame:
    from scriptorium.plans.documents import QUERIES as DOCS

    text = DOCS["s_pdf_text"](s, d).select("family", "has_text")
    marks = table(s, d, "documents_md").groupBy("family").agg((F.avg(F.length("text")) > 8000).alias("broken"))
    return text.join(marks, text.family.eqNullSafe(marks.family)).select(text.family.alias("family"), engines.routed(F.col("has_text"), F.col("broken")).alias("engine"))


def _routes_sql() -> str:
    from scriptorium.plans.documents import SQL as DOCS

    return f"SELECT t.family, CASE WHEN NOT has_text THEN 'ocr' WHEN broken THEN 'ocr_fallback' ELSE 'text' END AS engine FROM ({DOCS['s_pdf_text']}) t JOIN (SELECT family, avg(length(text)) > 8000 AS broken FROM documents_md GROUP BY family) m ON t.family IS NOT DISTINCT FROM m.family"


_q("t_fallback", _routes, _routes_sql())


def _routes_by_score(s: SparkSession, d: str) -> DataFrame:
    """The engine of every volume: its text layer, unless too many of all its pages are corrupt."""
    page_text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text")
    pages = paged(s, d).withColumn("volume", F.regexp_replace("volume", "^0+([0-9])", "$1")).groupBy("volume", "doc_id", "page").agg(page_text)
    sampled = F.col("page").between(4, 13)
    per = pages.groupBy("volume").agg(
        F.count("*").alias("pages"), F.count_if(S.garbage_score(F.col("text")) >= V.GARBAGE_SCORE).alias("bad"),
        F.coalesce(F.floor(F.sum(F.when(sampled, F.length(F.trim("text"))).otherwise(0)) / F.nullif(F.count_if(sampled), F.lit(0))) >= 200, F.lit(False)).alias("has_text"),
    )
    return per.select("volume", "pages", "bad", engines.routed(F.col("has_text"), corrupt(F.col("pages"), F.col("bad"))).alias("engine"))


def _routes_by_score_sql() -> str:
    from scriptorium.plans.scalars import SQL as SCALARS

    score = SCALARS["p_garbage"].replace("FROM documents)", "FROM (SELECT id AS doc_id, text FROM pg))")
    return (
        f"WITH pg AS (SELECT volume, page, concat(coalesce(volume, '-'), '|', doc_id, '|', page) AS id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM (SELECT * REPLACE (regexp_replace(volume, '^0+([0-9])', '\\1') AS volume) FROM {PAGED}) GROUP BY volume, doc_id, page), sc AS ({score}), "
        "v AS (SELECT volume, count(*) AS pages, count_if(score >= 10) AS bad, coalesce(floor(sum(CASE WHEN page BETWEEN 4 AND 13 THEN length(trim(text, ' ')) ELSE 0 END) / nullif(count_if(page BETWEEN 4 AND 13), 0)) >= 200, false) AS has_text FROM pg JOIN sc ON sc.doc_id = pg.id GROUP BY volume) "
        "SELECT volume, pages, bad, CASE WHEN NOT has_text THEN 'ocr' WHEN pages > 0 AND bad >= greatest(8, floor(pages * 0.15::DOUBLE + 0.999::DOUBLE)) THEN 'ocr_fallback' ELSE 'text' END AS engine FROM v"
    )


_q("t_fallback_score", _routes_by_score, _routes_by_score_sql())


def _flaky(text: str) -> str:
    if "§fail" in text:
        raise ValueError("engine error")
    return text.upper()


_CH = [("d", 1, "one"), ("d", 2, "two §fail"), ("e", 1, "trois")]
_CS = "doc_id string, chunk_no int, text string"
for _n in ("t_retry", "t_pace", "x_llm"):
    _q(_n, lambda s, d: engines.translated(values(s, _CS, _CH), _flaky), f"SELECT doc_id, chunk_no, CASE WHEN contains(text, '§fail') THEN concat('<!-- TRANSLATION FAILED -->', chr(10), text) ELSE upper(text) END AS text, CASE WHEN contains(text, '§fail') THEN 'failed' ELSE 'ok' END AS status FROM {sql_values(_CS, _CH)}")
class _Limited:
    """A translator that refuses every text once for its rate limit."""

    def __init__(self) -> None:
        self.refused = False

    def __call__(self, text: str) -> str:
        self.refused = not self.refused
        if self.refused:
            raise RuntimeError("rate limit")
        return text


_q("t_retry_texts", lambda s, d: engines.translated(table(s, d, "bilingual_md").filter("text is not null").select(F.col("pair_id").cast("string").alias("doc_id"), F.lit(1).alias("chunk_no"), "text"), _Limited(), least_seconds=0.002).select("doc_id", "status", F.md5("text").alias("digest")),
   "SELECT CAST(pair_id AS VARCHAR) AS doc_id, 'retried' AS status, md5(text) AS digest FROM bilingual_md WHERE text IS NOT NULL")
for _n in ("x_engine", "s_blocks", "t_pipe"):
    _q(_n, lambda s, d: engines.run("identity", table(s, d, "documents_md").select("doc_id", "text").filter("text is not null")).select("doc_id", "page_num", "label", F.md5("content").alias("content")), "SELECT doc_id, 0 AS page_num, 'text' AS label, md5(text) AS content FROM documents_md WHERE text IS NOT NULL")
_q("f_trunc", lambda s, d: table(s, d, "run_metadata").filter("char_count is not null").groupBy("engine").agg(F.count_if(F.col("char_count") >= 20000 - 10).alias("truncated"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("char_count") >= 20000 - 10, F.col("doc_id")))), ",").alias("docs")),
   "SELECT engine, count_if(char_count >= 19990) AS truncated, coalesce(string_agg(DISTINCT CASE WHEN char_count >= 19990 THEN doc_id END, ',' ORDER BY CASE WHEN char_count >= 19990 THEN doc_id END), '') AS docs FROM run_metadata WHERE char_count IS NOT NULL GROUP BY engine")
_q("s_vol", lambda s, d: files.volumes(table(s, d, "run_metadata").select(F.col("pdf").alias("name"))), "SELECT DISTINCT regexp_extract(pdf, '^vol_0*([0-9]+(?:bis)?)\\.pdf$', 1) AS label, pdf AS filename FROM run_metadata WHERE regexp_matches(pdf, '^vol_0*([0-9]+(bis)?)\\.pdf$')")
_CONF = [("tijongo", "pdfs", None, "fr"), ("other", "in", "*.djvu", None)]
_q("s_conf", lambda s, d: values(s, "name string, pdf_dir string, pdf_glob string, language string", _CONF).select("name", "pdf_dir", F.coalesce("pdf_glob", F.lit(files.Corpus.pdf_glob)).alias("pdf_glob"), F.coalesce("language", F.lit(files.Corpus.language)).alias("language")), f"SELECT name, pdf_dir, coalesce(pdf_glob, '*.pdf') AS pdf_glob, coalesce(language, 'fr') AS language FROM {sql_values('name string, pdf_dir string, pdf_glob string, language string', _CONF)}")
_q("o_files", lambda s, d: table(s, d, "key_datasets").select("source").distinct().withColumn("pos", F.row_number().over(Window.partitionBy(F.regexp_extract("source", "^([^/]+)/", 1)).orderBy("source"))), "SELECT source, CAST(row_number() OVER (PARTITION BY regexp_extract(source, '^([^/]+)/', 1) ORDER BY source) AS INTEGER) AS pos FROM (SELECT DISTINCT source FROM key_datasets)")
_LAYOUT = '{"height": 800.0, "textItems": [{"text": "a", "x": 1.0, "y": 2.0, "fontSize": 9.0}, {"text": "b", "x": 3.0, "y": 2.0, "fontSize": 11.0}]}'
_q("s_layout", lambda s, d: values(s, "j string", [(_LAYOUT,)]).select(F.from_json("j", "height double, textItems array<struct<text:string,x:double,y:double,fontSize:double>>").alias("p")).select("p.height", F.posexplode("p.textItems").alias("ord", "i")).select("height", "ord", "i.text", "i.x", "i.fontSize"), "SELECT 800.0::DOUBLE AS height, CAST(a AS INTEGER) AS ord, b AS text, c::DOUBLE AS x, e::DOUBLE AS \"fontSize\" FROM (VALUES (0, 'a', 1.0, 9.0), (1, 'b', 3.0, 11.0)) v(a, b, c, e)")
_YAML = [("Diospyros_x", "---\nname: Diospyros x\nauthority: \"Nevo\"\ngenus: Diospyros\nsynonyms:\n  - A b\n  - C d\nvol: 60\n---\nbody [[Diospyros]]")]
_q("s_yaml", lambda s, d: files.front_matter(values(s, "page string, text string", _YAML)), "SELECT 'Diospyros_x' AS page, a AS field, CAST(b AS INTEGER) AS k, c AS value FROM (VALUES ('name', 0, 'Diospyros x'), ('authority', 1, 'Nevo'), ('genus', 2, 'Diospyros'), ('synonyms', 4, 'A b'), ('synonyms', 5, 'C d'), ('vol', 6, '60')) v(a, b, c)")

# species pages
_sp = lambda s, d: table(s, d, "wiki_species")
_q("q_count", lambda s, d: _sp(s, d).groupBy("family", "habit").agg(F.count("*").alias("n"), F.countDistinct("genus").alias("genera")), "SELECT family, habit, count(*) AS n, count(DISTINCT genus) AS genera FROM wiki_species GROUP BY ALL")
_q("q_query", lambda s, d: _sp(s, d).filter(F.array_contains("tags", "novelty") & (F.col("habit") == "tree")).select("page_id", "name"), "SELECT page_id, name FROM wiki_species WHERE list_contains(tags, 'novelty') AND habit = 'tree'")
_q("q_cover", lambda s, d: _sp(s, d).select("page_id", F.explode("treatments").alias("t")).groupBy("t.vol").agg(F.count("*").alias("treatments"), F.count_if(F.col("t.source").isNotNull()).alias("ingested")).filter("vol is not null"), "SELECT t.vol AS vol, count(*) AS treatments, count_if(t.source IS NOT NULL) AS ingested FROM (SELECT unnest(treatments) AS t FROM wiki_species) WHERE t.vol IS NOT NULL GROUP BY t.vol")


def _links(s: SparkSession, d: str) -> DataFrame:
    """Dangling links (synonyms that no page is named after) and orphans (pages that none names)."""
    pages = _sp(s, d).filter("name is not null").select(F.col("name").alias("page")).distinct()
    links = _sp(s, d).select(F.col("name").alias("src"), F.explode("synonyms").alias("dst"))
    dangling = links.select(F.col("dst").alias("page")).distinct().join(pages, "page", "left_anti").withColumn("issue", F.lit("dangling"))
    orphans = pages.join(links.select(F.col("dst").alias("page")).distinct(), "page", "left_anti").withColumn("issue", F.lit("orphan"))
    return dangling.unionByName(orphans)


_LINKS = "WITH p AS (SELECT DISTINCT name AS page FROM wiki_species WHERE name IS NOT NULL), l AS (SELECT DISTINCT unnest(synonyms) AS page FROM wiki_species) SELECT page, 'dangling' AS issue FROM l WHERE page IS NOT NULL AND page NOT IN (SELECT page FROM p) UNION ALL SELECT page, 'orphan' FROM p WHERE page NOT IN (SELECT page FROM l WHERE page IS NOT NULL)"
for _n in ("j_links", "q_lint"):
    _q(_n, _links, _LINKS)
_LOG = [("## [2026-03-01] ingest | Ebenaceae",), ("body",), ("## [2026-03-04] refresh | index",), ("## [bad] x | y",)]
for _n in ("q_log", "t_log"):
    _q(_n, lambda s, d: values(s, "line string", _LOG).filter(F.col("line").rlike(r"^## \[[0-9]{4}-[0-9]{2}-[0-9]{2}\] ")).select(F.to_date(F.regexp_extract("line", r"^## \[([0-9-]+)\]", 1)).cast("string").alias("day"), F.regexp_extract("line", r"^## \[[0-9-]+\] (\S+) \| (.*)$", 1).alias("kind"), F.regexp_extract("line", r"^## \[[0-9-]+\] (\S+) \| (.*)$", 2).alias("title")).orderBy(F.desc("day")).limit(10),
       "SELECT a AS day, b AS kind, c AS title FROM (VALUES ('2026-03-01', 'ingest', 'Ebenaceae'), ('2026-03-04', 'refresh', 'index')) v(a, b, c)")

# what the sinks write
_q("k_text", lambda s, d: D.without_headers(paged(s, d), "volume").filter("kept is not null").groupBy("doc_id").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "kept"))), lambda x: x["kept"]), "\n")).alias("text")),
   f"SELECT doc_id, md5(string_agg(kept, chr(10) ORDER BY line_no)) AS text FROM (SELECT doc_id, line_no, {KEPT} AS kept FROM {DROPPED}) WHERE kept IS NOT NULL GROUP BY doc_id")
_q("k_meta", lambda s, d: sinks.unified_metadata(table(s, d, "run_metadata").filter("engine = 'paddle'").drop("figure_count"), table(s, d, "run_metadata").filter("engine <> 'paddle'").drop("dpi")).groupBy("engine").agg(F.count("*").alias("n"), F.count("dpi").alias("with_dpi"), F.count("figure_count").alias("with_figures"), F.round(F.sum("elapsed_seconds"), 2).alias("seconds")),
   "SELECT engine, count(*) AS n, count(CASE WHEN engine = 'paddle' THEN dpi END) AS with_dpi, count(CASE WHEN engine <> 'paddle' THEN figure_count END) AS with_figures, round(CAST(sum(CAST(elapsed_seconds AS DECIMAL(18, 2))) AS DOUBLE), 2) AS seconds FROM run_metadata WHERE engine IS NOT NULL GROUP BY engine")
_q("k_taxa", lambda s, d: D.taxa(decorated(s, d)).select(F.concat_ws("\t", "rank", "name", "family", "genus", F.col("page").cast("string"), F.col("line_no").cast("string")).alias("tsv")), f"SELECT concat_ws(chr(9), rank, name, family, genus, page, line_no) AS tsv FROM {TAXA}")
_q("k_img", lambda s, d: table(s, d, "figures").select("fig_id", F.md5(F.encode("filename", "utf-8")).alias("digest")), "SELECT fig_id, md5(filename) AS digest FROM figures")
_q("k_err", lambda s, d: table(s, d, "run_metadata").select("doc_id", F.when(F.col("char_count").isNull(), "no text").alias("error")).filter("error is not null"), "SELECT doc_id, 'no text' AS error FROM run_metadata WHERE char_count IS NULL")
_q("k_en", lambda s, d: table(s, d, "bilingual_md").select("pair_id", F.md5(F.concat(F.lit("<!-- translated from paddle -->\n"), "text_en")).alias("doc")), "SELECT pair_id, md5(concat('<!-- translated from paddle -->', chr(10), text_en)) AS doc FROM bilingual_md WHERE text_en IS NOT NULL")
_q("p_prov", lambda s, d: table(s, d, "bilingual_md").select("pair_id", sinks.provenance("model", F.lit("paddle")).alias("header")))
_q("p_ts", lambda s, d: table(s, d, "run_metadata").filter("completed_at is not null").select("doc_id", F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp")), "SELECT doc_id, strftime(completed_at, '%Y-%m-%dT%H:%M:%S') AS stamp FROM run_metadata WHERE completed_at IS NOT NULL")
_q("f_dryrun", lambda s, d: paged(s, d).groupBy("engine").agg(F.count("*").alias("n_lines"), F.max("page").alias("last_page")), f"SELECT engine, count(*) AS n_lines, max(page) AS last_page FROM {PAGED} GROUP BY engine")
def _cached(s: SparkSession, d: str) -> DataFrame:
    """Raw results written to the shared folder and read again, as a run from the cache does."""
    import os
    import uuid

    shared = shared_folder(s, "scriptorium-runs")
    place = os.path.join(shared, f"cache_{uuid.uuid4().hex}")
    sinks.write_cache(table(s, d, "documents_md").select("doc_id", "engine", F.md5("text").alias("digest")), place)
    return s.read.parquet(place)


for _n in ("s_cache", "k_cache"):
    _q(_n, _cached, "SELECT doc_id, engine, md5(text) AS digest FROM documents_md")
_q("k_keyfmt", lambda s, d: _keyfmt(s, d), None)


def _keyfmt(s: SparkSession, d: str) -> DataFrame:
    """Key sections indented, all other segments as they are."""
    from pyspark.sql import Window

    from scriptorium.operators import keys as K

    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("line").rlike(V.ANY_HEADING) & (F.col("line_no") > 1)
    marked = decorated(s, d).withColumn("seg_id", F.sum(head.cast("int")).over(w))
    segs = D.segments(decorated(s, d)).filter("is_key").select("doc_id", "seg_id", "start_line")
    body = marked.join(segs, ["doc_id", "seg_id"]).filter(F.col("line_no") > F.col("start_line")).select("doc_id", "seg_id", "line_no", "line")
    made = K.indented(K.couplets(body, "doc_id", "seg_id"), "doc_id", "seg_id").groupBy("doc_id", "seg_id").agg(F.count("*").alias("n"), F.sum(F.length("md")).alias("chars"))
    return made


_q("x_format", lambda s, d: _by_format(s), "SELECT 'ladder' AS format, CAST(3 AS BIGINT) AS sections")


def _by_format(s: SparkSession) -> DataFrame:
    from scriptorium.operators import keys as K
    from scriptorium.plans.keys import KEY_LINES

    engines.register_parser("ladder", K.couplets)
    parsed = engines.parser("ladder")(values(s, "doc_id string, line_no int, line string", KEY_LINES), "doc_id")
    return parsed.select(F.lit("ladder").alias("format"), "doc_id").groupBy("format").agg(F.countDistinct("doc_id").alias("sections"))
