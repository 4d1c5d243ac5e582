"""Queries over identification keys and their navigation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import vocab as V
from scriptorium.operators import keys as K
from scriptorium.operators import nested
from scriptorium.plans import training
from scriptorium.plans.base import LINES, Query, lines, sql_values, table, values
from scriptorium.plans.documents import SEGS, decorated

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _q(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql:
        SQL[name] = sql


_LS = "doc_id string, line_no int, line string"
KEY_LINES = [
    *[("a", i, x) for i, x in enumerate(["1. Leaves opposite", "   petiole long", "1'. Leaves alternate..... 2. Eugenia.", "", "2. Petals free", "", "3. E. obanensis.", "2'. Petals fused..... Syzygium", "some text", "", "<!-- page 3 -->", "3. Fruit red", "3'. Fruit blue .. 7"], 1)],
    *[("b", i, x) for i, x in enumerate(["1. - a x", "- b y ..... Garcinia kola", "- c ..... Xylopia - d ..... Annona"], 1)],
    *[("c", i, x) for i, x in enumerate(["I. Tree tall", "I'. Tree small .... Psidium guajava", "Io. Bark smooth..... Ps. Friedrichstahlianum."], 1)],
]
# Expected results of the fixture, derived by hand.
STATEMENTS = [
    ("a", 1, 1, "", "Leaves opposite petiole long", False), ("a", 2, 1, "'", "Leaves alternate..... 2. Eugenia.", True), ("a", 3, -1, "", "", True), ("a", 4, 2, "", "Petals free 3. E. obanensis.", True),
    ("a", 5, 2, "'", "Petals fused..... Syzygium some text", True), ("a", 6, -1, "", "", True), ("a", 7, -1, "", "<!-- page 3 -->", True), ("a", 8, 3, "", "Fruit red", False), ("a", 9, 3, "'", "Fruit blue .. 7", True),
    ("b", 1, 1, "", "a x", False), ("b", 2, 1, "'", "b y ..... Garcinia kola", True), ("b", 3, 1, "''", "c ..... Xylopia", True), ("b", 4, 1, "'''", "d ..... Annona", True),
    ("c", 1, 1, "", "Tree tall", False), ("c", 2, 1, "'", "Tree small .... Psidium guajava", True), ("c", 3, 10, "", "Bark smooth..... Ps. Friedrichstahlianum.", True),
]
_SS = "doc_id string, ord int, num int, prime string, text string, is_terminal boolean"
_key_lines = lambda s: values(s, _LS, KEY_LINES)
_q("g_couplet", lambda s, d: K.couplets(_key_lines(s), "doc_id"), f"SELECT * FROM {sql_values(_SS, STATEMENTS)}")
_q("g_runon", lambda s, d: K.split_run_ons(values(s, _LS, [("a", 1, "- c ..... X - d .. Y - e"), ("a", 2, "no - leaders"), ("a", 3, "p .. q")])).select("line_no", "sub_no", "line"),
   "SELECT CAST(a AS INTEGER) AS line_no, CAST(b AS INTEGER) AS sub_no, c AS line FROM (VALUES (1, 0, '- c ..... X'), (1, 1, '- d .. Y'), (1, 2, '- e'), (2, 0, 'no - leaders'), (3, 0, 'p .. q')) v(a, b, c)")
_DF = [("x", i, t) for i, t in enumerate(["1. - a", "- b", "- c", "- d", "- e", "2. - f", "plain", "- g"], 1)]
_q("w_dashfill", lambda s, d: K.dashes_to_primes(values(s, _LS, _DF).withColumn("sub_no", F.lit(0)), "doc_id").select("line_no", "line"),
   f"SELECT line_no, CASE WHEN n IS NOT NULL THEN regexp_replace(line, '^([0-9]+)\\.\\s+-\\s+', '\\1. ') WHEN bare THEN concat(num, repeat('''', CAST(least(alt, 3) AS INTEGER)), '. ', line[3:]) ELSE line END AS line FROM (SELECT *, sum(CASE WHEN bare THEN 1 ELSE 0 END) OVER (PARTITION BY blk ORDER BY line_no) AS alt FROM (SELECT *, last_value(n IGNORE NULLS) OVER (ORDER BY line_no) AS num, count(n) OVER (ORDER BY line_no) AS blk FROM (SELECT *, nullif(regexp_extract(line, '^([0-9]+)\\.\\s+-\\s+', 1), '') AS n, starts_with(line, '- ') AS bare FROM {sql_values(_LS, _DF)})))")
_IND = [("k", i, n, p, f"t{i}", t) for i, (n, p, t) in enumerate([(1, "", False), (2, "", True), (2, "'", False), (3, "", True), (3, "'", True), (1, "'", True)], 1)]
_q("g_indent", lambda s, d: K.indented(values(s, _SS, _IND), "doc_id").select("ord", "depth", "md"),
   "SELECT CAST(a AS INTEGER) AS ord, CAST(b AS INTEGER) AS depth, c AS md FROM (VALUES (1, 0, '- 1\\. t1'), (2, 1, '  - 2\\. t2'), (3, 1, '  - 2''\\. t3'), (4, 2, '    - 3\\. t4'), (5, 2, '    - 3''\\. t5'), (6, 0, '- 1''\\. t6')) v(a, b, c)")
_q("g_reformat", lambda s, d: K.indented(K.couplets(_key_lines(s), "doc_id"), "doc_id").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "md"))), lambda x: x["md"]), "\n").alias("md")),
   "SELECT doc_id, md FROM (VALUES ('a', concat_ws(chr(10), '- 1\\. Leaves opposite petiole long', '- 1''\\. Leaves alternate..... 2. Eugenia.', '- 2\\. Petals free 3. E. obanensis.', '- 2''\\. Petals fused..... Syzygium some text', '- 3\\. Fruit red', '- 3''\\. Fruit blue .. 7')), ('b', concat_ws(chr(10), '- 1\\. a x', '- 1''\\. b y ..... Garcinia kola', '- 1''''\\. c ..... Xylopia', '- 1''''''\\. d ..... Annona')), ('c', concat_ws(chr(10), '- 1\\. Tree tall', '- 1''\\. Tree small .... Psidium guajava', '- 10\\. Bark smooth..... Ps. Friedrichstahlianum.'))) v(doc_id, md)")
_NODES = [
    ("a", 1, "1", 1, "", False, None, 2), ("a", 2, "1'", 1, "'", True, "Eugenia", None), ("a", 4, "2", 2, "", True, "E. obanensis", None), ("a", 5, "2'", 2, "'", True, "Syzygium some text", None), ("a", 8, "3", 3, "", False, None, None), ("a", 9, "3'", 3, "'", False, None, 7),
    ("b", 1, "1", 1, "", False, None, None), ("b", 2, "1'", 1, "'", True, "Garcinia kola", None), ("b", 3, "1''", 1, "''", True, "Xylopia", None), ("b", 4, "1'''", 1, "'''", True, "Annona", None),
    ("c", 1, "1", 1, "", False, None, 10), ("c", 2, "1'", 1, "'", True, "Psidium guajava", None), ("c", 3, "10", 10, "", True, "Ps. Friedrichstahlianum", None),
]
_q("g_keys", lambda s, d: K.nodes(K.couplets(_key_lines(s), "doc_id"), "doc_id").drop("text"), f"SELECT * FROM {sql_values('doc_id string, ord int, node_key string, num int, prime string, is_terminal boolean, terminal_name string, leads_to int', _NODES)}")


def _section_lines(s: SparkSession, d: str) -> DataFrame:
    """Statements put into the bodies of the extracts: every fourth line becomes one, some with dotted leaders."""
    ls = lines(s, d)
    n, prime = (F.col("line_no") / 8).cast("int") % 40 + 1, F.when(F.col("line_no") % 8 == 4, "'").otherwise("")
    led = F.when(F.col("line_no") % 3 == 0, F.concat(F.lit(" ..... "), F.regexp_extract("doc_id", "^([A-Za-z]+)", 1))).otherwise("")
    return ls.select("doc_id", "line_no", F.when((F.col("line_no") % 4 == 0) & (F.col("line") != ""), F.concat(n.cast("string"), prime, F.lit(". "), "line", led)).otherwise(F.col("line")).alias("line"))


_q("g_couplet_texts", lambda s, d: K.couplets(_section_lines(s, d), "doc_id").groupBy("doc_id").agg(F.count_if(F.col("num") >= 0).alias("statements"), F.count_if(F.col("is_terminal") & (F.col("num") >= 0)).alias("terminals"), F.sum(F.length("text")).alias("chars")))
_q("g_indent_texts", lambda s, d: K.indented(K.couplets(_section_lines(s, d), "doc_id"), "doc_id").groupBy("doc_id").agg(F.max("depth").alias("deepest"), F.count("*").alias("n")))
_q("w_lookahead", lambda s, d: lines(s, d).withColumn("nxt", F.last(F.when(F.trim("line") != "", F.col("line")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1))).groupBy("doc_id").agg(F.count("nxt").alias("n"), F.sum(F.length("nxt")).alias("chars")),
   f"SELECT doc_id, count(nxt) AS n, CAST(sum(length(nxt)) AS BIGINT) AS chars FROM (SELECT doc_id, first_value(CASE WHEN trim(line, ' ') <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM {LINES}) GROUP BY doc_id")
_JN = [("k", i, n, p) for i, (n, p) in enumerate([(1, ""), (2, ""), (2, "'"), (1, "'"), (3, "")], 1)]
_q("j_next", lambda s, d: values(s, "key_id string, ord int, num int, prime string", _JN).withColumn("next", F.last(F.when(F.col("prime") == "", F.col("num")), ignorenulls=True).over(Window.partitionBy("key_id").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1))),
   f"SELECT *, first_value(CASE WHEN prime = '' THEN num END IGNORE NULLS) OVER (PARTITION BY key_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM {sql_values('key_id string, ord int, num int, prime string', _JN)}")
_q("w_keyctx", lambda s, d: _key_context(s, d),
   f"SELECT doc_id, CAST(seg_id AS BIGINT) AS seg_id, fam, gen FROM (SELECT *, last_value(CASE WHEN f <> '' THEN f END IGNORE NULLS) OVER w AS fam, last_value(CASE WHEN g <> '' THEN g WHEN f <> '' THEN '' END IGNORE NULLS) OVER w AS gen FROM (SELECT *, f0[1] || lower(f0[2:]) AS f, g0[1] || lower(g0[2:]) AS g FROM (SELECT doc_id, seg_id, upper(regexp_extract(translate(arg_min(line, line_no), 'É', 'E'), '(?i)^#{{1,4}}\\s+([A-Z]{{4,}}(?:ACEAE|ACEES))', 1)) AS f0, regexp_extract(arg_min(line, line_no), '^#{{1,6}}\\s+[0-9]+\\.\\s+([A-Z]{{2,}})\\b', 1) AS g0 FROM {SEGS} GROUP BY doc_id, seg_id)) WINDOW w AS (PARTITION BY doc_id ORDER BY seg_id ROWS UNBOUNDED PRECEDING))")


def _key_context(s: SparkSession, d: str) -> DataFrame:
    """Family and genus in force in each segment; a family heading clears the genus."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    head = F.col("line").rlike(V.ANY_HEADING) & (F.col("line_no") > 1)
    segs = decorated(s, d).withColumn("seg_id", F.sum(head.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("doc_id", "seg_id").agg(F.min_by("line", "line_no").alias("head"))
    f = F.initcap(F.lower(F.regexp_extract(F.translate("head", "É", "E"), r"(?i)^#{1,4}\s+([A-Z]{4,}(?:ACEAE|ACEES))", 1)))
    g = F.initcap(F.lower(F.regexp_extract("head", r"^#{1,6}\s+[0-9]+\.\s+([A-Z]{2,})\b", 1)))
    x = Window.partitionBy("doc_id").orderBy("seg_id").rowsBetween(Window.unboundedPreceding, 0)
    return segs.withColumn("f", f).withColumn("g", g).select("doc_id", "seg_id", F.last(F.nullif("f", F.lit("")), ignorenulls=True).over(x).alias("fam"), F.last(F.when(F.col("g") != "", F.col("g")).when(F.col("f") != "", F.lit("")), ignorenulls=True).over(x).alias("gen"))


_q("a_start", lambda s, d: table(s, d, "nav_events").groupBy("key_id").agg(F.coalesce(F.min(F.when(F.coalesce("choice_prime", F.lit("")) == "", F.col("ord"))), F.lit(1)).alias("start")), "SELECT key_id, coalesce(min(CASE WHEN coalesce(choice_prime, '') = '' THEN ord END), 1) AS start FROM nav_events GROUP BY key_id")
_q("j_genuslink", lambda s, d: table(s, d, "nav_events").filter("key_id is not null").groupBy("key_id").agg(F.count("*").alias("n")).join(table(s, d, "key_index").select("key_id", "display", "genus"), "key_id", "left"), "SELECT key_id, n, display, genus FROM (SELECT key_id, count(*) AS n FROM nav_events WHERE key_id IS NOT NULL GROUP BY key_id) LEFT JOIN key_index USING (key_id)")
_q("p_display", lambda s, d: table(s, d, "key_index").groupBy("display").agg(F.max("key_id").alias("key_id")), "SELECT display, max(key_id) AS key_id FROM key_index GROUP BY display")
_q("f_family", lambda s, d: table(s, d, "key_index").filter(F.lower(F.coalesce("family", F.lit(""))) == "guganaceae").select("key_id"), "SELECT key_id FROM key_index WHERE lower(coalesce(family, '')) = 'guganaceae'")
_q("o_firstkey", lambda s, d: table(s, d, "key_index").groupBy("family").agg(F.min_by("key_id", F.struct(F.col("genus").isNotNull(), F.col("key_id"))).alias("default_key")), "SELECT family, arg_min(key_id, CASE WHEN genus IS NULL THEN '0' ELSE '1' END || key_id) AS default_key FROM key_index GROUP BY family")

_GS = "key_id string, node_key string, num int, prime string, is_terminal boolean, terminal_name string, leads_to int"
GRAPH = [
    ("k", "1", 1, "", False, None, 2), ("k", "1'", 1, "'", False, None, 4), ("k", "2", 2, "", True, "Eugenia", None), ("k", "2'", 2, "'", False, None, 3), ("k", "3", 3, "", True, "Psidium", None), ("k", "3'", 3, "'", False, None, 1),
    ("k", "4", 4, "", False, None, None), ("k", "6", 6, "", True, "Lost", None), ("m", "1", 1, "", True, "Annona", None), ("m", "1'", 1, "'", True, "Xylopia", None),
]


def _graph(s: SparkSession, d: str) -> DataFrame:
    """The nodes of all key files as graphs, one for each key, and those of the fixture; of nodes of one key that share node_key the first by what they hold."""
    t = nested.key_tables(table(s, d, "key_datasets"))["nodes"].filter(F.size("lineage") > 0)
    held = t.select(
        F.concat_ws("|", F.col("rec_id").cast("string"), F.col("lineage")[0]).alias("key_id"), F.col("own_key").alias("node_key"), F.col("num").cast("int").alias("num"), F.coalesce("prime", F.lit("")).alias("prime"),
        F.col("is_terminal").cast("boolean").alias("is_terminal"), "terminal_name", F.col("leads_to").cast("int").alias("leads_to"),
    ).filter("node_key <> '' and num is not null")
    one = held.groupBy("key_id", "node_key").agg(*[F.max(c).alias(c) for c in ("num", "prime", "is_terminal", "terminal_name", "leads_to")])
    return values(s, _GS, GRAPH).unionByName(one)


#: The same in SQL.
_NS = f"""
    WITH RECURSIVE {training.KEYS},
    ns AS (
        SELECT dataset_id, k AS key, m.k AS own, m.v AS v FROM (SELECT dataset_id, k, unnest({training.members("(v->'nodes')", 'node_key')}) AS m FROM ks) WHERE json_type(m.v) = 'OBJECT'
        UNION ALL
        SELECT dataset_id, key, m.k, m.v FROM (SELECT dataset_id, key, unnest({training.members("(v->'children')", 'node_key')}) AS m FROM ns) WHERE json_type(m.v) = 'OBJECT')"""
_GRAPH = f"""(
    SELECT * FROM {sql_values(_GS, GRAPH)}
    UNION ALL SELECT * FROM ({_NS}
    SELECT concat(dataset_id, '|', key) AS key_id, own AS node_key, max(CAST(v->>'num' AS INTEGER)) AS num, max(coalesce(v->>'prime', '')) AS prime,
           max(CAST(v->>'is_terminal' AS BOOLEAN)) AS is_terminal, max(v->>'terminal_name') AS terminal_name, max(CAST(v->>'leads_to' AS INTEGER)) AS leads_to
    FROM ns WHERE own <> '' AND v->>'num' IS NOT NULL GROUP BY ALL))"""
_q("j_alts", lambda s, d: _graph(s, d).alias("a").join(_graph(s, d).alias("b"), F.expr("a.key_id = b.key_id and a.leads_to = b.num")).select(F.col("a.key_id").alias("key_id"), F.col("a.node_key").alias("node_key"), F.col("b.node_key").alias("alternative")),
   f"WITH g AS (SELECT * FROM {_GRAPH}) SELECT a.key_id, a.node_key, b.node_key AS alternative FROM g a JOIN g b ON a.key_id = b.key_id AND a.leads_to = b.num")
_q("o_alts", lambda s, d: _graph(s, d).select("key_id", "node_key", F.row_number().over(Window.partitionBy("key_id", "num").orderBy(F.length("prime"), "prime", "node_key")).alias("pos")), f"SELECT key_id, node_key, CAST(row_number() OVER (PARTITION BY key_id, num ORDER BY length(prime), prime, node_key) AS INTEGER) AS pos FROM {_GRAPH}")
_q("f_alts", lambda s, d: _graph(s, d).groupBy("key_id", "num").agg(F.count("*").alias("n")).filter("n < 2"), f"SELECT key_id, num, count(*) AS n FROM {_GRAPH} GROUP BY ALL HAVING count(*) < 2")
_q("f_minkeys", lambda s, d: K.couplets(_key_lines(s), "doc_id").groupBy("doc_id").agg(F.count_if(F.col("num") >= 0).alias("n")).filter("n > 0"), f"SELECT doc_id, count_if(num >= 0) AS n FROM {sql_values(_SS, STATEMENTS)} GROUP BY doc_id HAVING count_if(num >= 0) > 0")
_q("j_traverse", lambda s, d: K.reached(_graph(s, d), values(s, "key_id string, num int", [("k", 1), ("m", 1)])).join(_graph(s, d), ["key_id", "num"]).select("key_id", "node_key", "depth", "terminal_name", (~F.col("is_terminal") & F.col("leads_to").isNull()).alias("dead_end")),
   f"WITH RECURSIVE g AS (SELECT * FROM {_GRAPH}), r AS (SELECT 'k' AS key_id, 1 AS num, 0 AS depth UNION SELECT 'm', 1, 0 UNION SELECT r.key_id, g.leads_to, r.depth + 1 FROM r JOIN g ON g.key_id = r.key_id AND g.num = r.num WHERE g.leads_to IS NOT NULL AND r.depth < 8), m AS (SELECT key_id, num, min(depth) AS depth FROM r GROUP BY ALL) SELECT m.key_id, g.node_key, m.depth, g.terminal_name, NOT g.is_terminal AND g.leads_to IS NULL AS dead_end FROM m JOIN g ON g.key_id = m.key_id AND g.num = m.num")


def _walk_files(s: SparkSession, d: str) -> DataFrame:
    """Reach of every key of the key files, from its first number: nodes at any depth, numbers, numbers reached, deepest step.

    A node leads to the number it names and to the nodes nested in it, which
    take the place of a number.  A key without nodes has none and reaches none.
    """
    from scriptorium.operators.lineage import cut

    t = nested.key_tables(table(s, d, "key_datasets"))
    key = lambda own: F.concat_ws("|", F.col("rec_id").cast("string"), own).alias("key_id")
    nodes = cut(t["nodes"].filter(F.size("lineage") > 0).select("rec_id", "row_id", "parent_id", key(F.col("lineage")[0]), F.col("num").cast("int").alias("num"), F.col("leads_to").cast("int").alias("leads_to")))
    inner = nodes.select("rec_id", F.col("parent_id").alias("row_id"), F.col("num").alias("leads_to"))
    graph = nodes.select("key_id", "num", "leads_to").unionByName(nodes.drop("leads_to").join(inner, ["rec_id", "row_id"]).select("key_id", "num", "leads_to"))
    counted = nodes.groupBy("key_id").agg(F.count("*").alias("nodes"), F.countDistinct("num").alias("numbers"), F.min("num").alias("num"))
    seen = K.reached(graph, counted.filter("num is not null").select("key_id", "num"))
    reach = seen.groupBy("key_id").agg(F.count("*").alias("reached"), F.max("depth").alias("deepest"))
    return t["keys"].select(key(F.col("own_key"))).distinct().join(counted.drop("num"), "key_id", "left").join(reach, "key_id", "left").na.fill(0, ["nodes", "numbers", "reached"])


#: The nodes of key files in SQL, at any depth, with the number of the node that holds each; what follows reads them as ns.
_WALK = f"""
    WITH RECURSIVE {training.KEYS},
    ns AS (
        SELECT dataset_id, k AS key, CAST(NULL AS INTEGER) AS held_by, CAST(m.v->>'num' AS INTEGER) AS num, m.v AS v
        FROM (SELECT dataset_id, k, unnest({training.members("(v->'nodes')", 'node_key')}) AS m FROM ks) WHERE json_type(m.v) = 'OBJECT'
        UNION ALL
        SELECT dataset_id, key, num, CAST(m.v->>'num' AS INTEGER), m.v
        FROM (SELECT dataset_id, key, num, unnest({training.members("(v->'children')", 'node_key')}) AS m FROM ns) WHERE json_type(m.v) = 'OBJECT'),
    g AS (
        SELECT dataset_id, key, num, CAST(v->>'leads_to' AS INTEGER) AS leads_to FROM ns WHERE v->>'leads_to' IS NOT NULL AND num IS NOT NULL
        UNION SELECT dataset_id, key, held_by, num FROM ns WHERE held_by IS NOT NULL AND num IS NOT NULL),
    c AS (SELECT dataset_id, key, count(*) AS nodes, count(DISTINCT num) AS numbers, min(num) AS num FROM ns GROUP BY ALL),
    r AS (
        SELECT dataset_id, key, num, 0 AS depth FROM c WHERE num IS NOT NULL
        UNION SELECT r.dataset_id, r.key, g.leads_to, r.depth + 1 FROM r JOIN g ON g.dataset_id = r.dataset_id AND g.key = r.key AND g.num = r.num
              JOIN c ON c.dataset_id = r.dataset_id AND c.key = r.key WHERE r.depth <= c.numbers),
    d AS (SELECT dataset_id, key, count(*) AS reached, max(depth) AS deepest FROM (SELECT dataset_id, key, num, min(depth) AS depth FROM r GROUP BY ALL) GROUP BY ALL)
    SELECT concat(x.dataset_id, '|', x.k) AS key_id, coalesce(nodes, 0) AS nodes, coalesce(numbers, 0) AS numbers, coalesce(reached, 0) AS reached, deepest
    FROM (SELECT DISTINCT dataset_id, k FROM ks) x LEFT JOIN c ON c.dataset_id = x.dataset_id AND c.key = x.k LEFT JOIN d ON d.dataset_id = x.dataset_id AND d.key = x.k"""
_q("j_traverse_files", _walk_files, _WALK)
_PS = "key_id string, node_key string, field string, value string, is_null boolean"
_PATCH = [("k", "2'", "is_terminal", "true", False), ("k", "2'", "terminal_name", "Psidium", False), ("k", "2'", "leads_to", None, True), ("k", "4", "leads_to", "6", False), ("k", "99", "leads_to", "1", False), ("zz", "1", "terminal_name", "X", False)]
_pt = lambda s: values(s, _PS, _PATCH)
_q("j_patch", lambda s, d: K.patched(_graph(s, d).select("key_id", "node_key", "is_terminal", "terminal_name", "leads_to"), _pt(s)),
   f"WITH p AS (SELECT * FROM {sql_values(_PS, _PATCH)}) SELECT key_id, node_key, coalesce((SELECT value = 'true' FROM p WHERE p.key_id = g.key_id AND p.node_key = g.node_key AND field = 'is_terminal'), is_terminal) AS is_terminal, coalesce((SELECT value FROM p WHERE p.key_id = g.key_id AND p.node_key = g.node_key AND field = 'terminal_name'), terminal_name) AS terminal_name, CASE WHEN EXISTS (FROM p WHERE p.key_id = g.key_id AND p.node_key = g.node_key AND field = 'leads_to') THEN (SELECT CAST(value AS INTEGER) FROM p WHERE p.key_id = g.key_id AND p.node_key = g.node_key AND field = 'leads_to') ELSE leads_to END AS leads_to FROM {_GRAPH} g")
_q("f_restrict", lambda s, d: _pt(s).select("key_id", "node_key").distinct().join(_graph(s, d), ["key_id", "node_key"], "left_anti"), f"SELECT DISTINCT key_id, node_key FROM {sql_values(_PS, _PATCH)} p WHERE NOT EXISTS (FROM {_GRAPH} g WHERE g.key_id = p.key_id AND g.node_key = p.node_key)")
_q("s_patch", lambda s, d: _from_json(s), "SELECT a AS key_id, b AS node_key, c AS field, d AS value FROM (VALUES ('genera_x', '2', 'terminal_name', 'Psidium'), ('genera_x', '2', 'leads_to', NULL), ('genera_x', '3', 'is_terminal', 'true')) v(a, b, c, d)")


def _from_json(s: SparkSession) -> DataFrame:
    doc = values(s, "j string", [('{"genera_x": {"2": {"terminal_name": "Psidium", "leads_to": null}, "3": {"is_terminal": "true"}}}',)])
    parsed = doc.select(F.from_json("j", "map<string,map<string,map<string,string>>>").alias("m"))
    return parsed.select(F.explode("m").alias("key_id", "ns")).select("key_id", F.explode("ns").alias("node_key", "fs")).select("key_id", "node_key", F.explode("fs").alias("field", "value"))


#: Key files in SQL: the object that holds the parts, whether wrapped or not; null for text that is no JSON.
_OBJ = "(SELECT dataset_id, source, coalesce(j->'data', j) AS o FROM (SELECT dataset_id, source, CAST(payload AS JSON) AS j FROM key_datasets WHERE payload IS NOT NULL AND json_valid(payload)))"


def _members(part: str, key: str) -> str:
    """Members of a container as (dataset_id, k, v), whether it is an object or an array whose entries name their key."""
    c = f"CASE WHEN json_type(o->'{part}') = 'VARCHAR' THEN CAST(o->>'{part}' AS JSON) ELSE o->'{part}' END"
    return (
        f"(SELECT dataset_id, k, json_extract(c, '$.\"' || k || '\"') AS v FROM (SELECT dataset_id, c, unnest(json_keys(c)) AS k FROM (SELECT dataset_id, {c} AS c FROM {_OBJ}) WHERE json_type(c) = 'OBJECT') "
        f"UNION ALL SELECT dataset_id, v->>'{key}' AS k, v FROM (SELECT dataset_id, unnest(from_json(c, '[\"JSON\"]')) AS v FROM (SELECT dataset_id, {c} AS c FROM {_OBJ}) WHERE json_type(c) = 'ARRAY') WHERE json_type(v) = 'OBJECT')"
    )


_q("s_keys", lambda s, d: nested.key_tables(table(s, d, "key_datasets"))["figures"].select(F.col("rec_id").alias("dataset_id"), F.split("own_key", ":", 2)[0].alias("genus"), F.split("own_key", ":", 2)[1].alias("epithet"), "path").distinct(),
   f"SELECT DISTINCT dataset_id, split_part(k, ':', 1) AS genus, split_part(k, ':', 2) AS epithet, v->>'path' AS path FROM {_members('figures', 'slug')} WHERE v IS NOT NULL AND json_type(v) = 'OBJECT'")
_q("s_datasets", lambda s, d: table(s, d, "key_datasets").join(nested.key_tables(table(s, d, "key_datasets"))["datasets"].select(F.col("rec_id").alias("dataset_id"), F.col("`meta.title`").alias("t")), "dataset_id", "left").select("dataset_id", F.coalesce("t", F.regexp_extract("source", r"([^/]+)/[^/]*$", 1)).alias("title")),
   f"SELECT d.dataset_id, coalesce(o->'meta'->>'title', regexp_extract(d.source, '([^/]+)/[^/]*$', 1)) AS title FROM key_datasets d LEFT JOIN {_OBJ} x ON d.dataset_id = x.dataset_id")
_q("a_keystats", lambda s, d: _key_stats(s, d), f"SELECT dataset_id, count(DISTINCT k) AS n_keys FROM {_members('keys', 'id')} WHERE json_type(v) = 'OBJECT' GROUP BY dataset_id")


def _key_stats(s: SparkSession, d: str) -> DataFrame:
    return nested.key_tables(table(s, d, "key_datasets"))["keys"].groupBy(F.col("rec_id").alias("dataset_id")).agg(F.countDistinct("own_key").alias("n_keys"))


_q("a_mapagg", lambda s, d: _graph(s, d).groupBy("key_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("node_key", F.coalesce("terminal_name", F.lit("-")).alias("v")))))).alias("nodes")),
   f"SELECT key_id, concat('{{', string_agg(concat('\"', node_key, '\":\"', coalesce(terminal_name, '-'), '\"'), ',' ORDER BY node_key), '}}') AS nodes FROM {_GRAPH} GROUP BY key_id")
_q("k_keys", lambda s, d: _graph(s, d).groupBy("key_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list("node_key")).alias("nodes"), F.min("num").alias("start"))).alias("doc")), f"SELECT key_id, concat('{{\"nodes\":[', string_agg(concat('\"', node_key, '\"'), ',' ORDER BY node_key), '],\"start\":', min(num), '}}') AS doc FROM {_GRAPH} GROUP BY key_id")
