"""Properties of the engine's own operators on small inputs and edge cases."""

import random
import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.operators import documents as D
from scriptorium.operators import figures as G
from scriptorium.operators import keys as K
from scriptorium.plans.figures import QUERIES as FIGURES
from scriptorium.plans.keys import QUERIES
from scriptorium.plans.runs import QUERIES as RUNS
from scriptorium.sources import engines, files, sinks
from scriptorium.streaming import incremental, sessions


def test_chunks_join_to_the_text(spark):
    texts = [("a", "aaaa\n\nbb\n\ncccccccccccccc\n\nd"), ("b", ""), ("c", None), ("d", "x" * 50)]
    df = spark.createDataFrame(texts, "doc_id string, text string")
    got = D.packed_paragraphs(df, 12).orderBy("doc_id", "chunk_no").collect()
    assert [r.text for r in got if r.doc_id == "a"] == ["aaaa\n\nbb", "cccccccccccccc", "d"]
    for doc, text in texts:
        if text is not None:
            assert "\n\n".join(r.text for r in got if r.doc_id == doc) == text


def test_lines_at_every_terminator(spark):
    df = spark.createDataFrame([("a", "1\r\n2\r3 4\n"), ("b", ""), ("c", None)], "doc_id string, text string")
    assert [(r.doc_id, r.line) for r in D.split_lines(df).orderBy("doc_id", "line_no").collect()] == [("a", "1"), ("a", "2"), ("a", "3"), ("a", "4")]


def test_segments_tile_and_first_line_is_no_key(spark):
    rows = [("d", i, t) for i, t in enumerate(["# KEY TO X", "1. a", "# B", "x", "## Clé", "y"], 1)]
    segs = D.segments(spark.createDataFrame(rows, "doc_id string, line_no int, line string")).orderBy("seg_id").collect()
    assert [(s.start_line, s.end_line, s.is_key) for s in segs] == [(1, 3, False), (3, 5, False), (5, 7, True)]


def test_as_of_covers_every_page_once(spark):
    pages = spark.createDataFrame([("v", p) for p in range(1, 7)] + [("w", 1)], "vol string, page int")
    starts = spark.createDataFrame([("v", 3, "A"), ("v", 5, "B")], "vol string, start int, fam string")
    got = {(r.vol, r.page): r.fam for r in D.as_of(pages, starts, "vol", "page", "start", "fam").collect()}
    assert [got["v", p] for p in range(1, 7)] == list("AAAABB") and got["w", 1] is None and len(got) == 7


def test_nearest_ties_go_low(spark):
    caps = spark.createDataFrame([(1, 3), (1, 9), (2, 1)], "page int, cap_idx int")
    figs = spark.createDataFrame([(1, 1), (1, 5)], "page int, fig_idx int")
    assert {(r.page, r.cap_idx): r.fig_pos for r in G.nearest(caps, figs, ["page"]).collect()} == {(1, 3): 1, (1, 9): 5, (2, 1): None}


def test_similar_names_against_brute_force(spark):
    import difflib

    import random

    rng = random.Random(5)
    long = ["".join(rng.choice("abcde") for _ in range(rng.randint(12, 34))) for _ in range(40)]

    def typo(w):
        for _ in range(rng.randint(1, 4)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcde") + w[i:], w[:i] + rng.choice("abcde") + w[i + 1 :]])
        return w

    names = ["staudti", "guajava", "gilletii", "gillettii", "whytei", "whyteii", "ab", "x", *long]
    queries = ["staudtii", "guajavva", "gilletti", "abc", "", "whytei", *map(typo, long)]
    df = G.similar_names(spark.createDataFrame([(q,) for q in queries], "query string"), spark.createDataFrame([(n,) for n in names], "name string"))
    want = {}
    for q in queries:
        best = max(((difflib.SequenceMatcher(None, n, q).ratio(), n) for n in names), default=None)
        if q and best and best[0] >= 0.88:
            want[q] = best[1]
    assert {r.query: r.match for r in df.collect()} == want


def test_epithets_of_every_page_meet(spark, tmp_path):
    pages = [(1, "Eugenia whytei"), (3, "Myrtus whyteii"), (5, "Psidium whytei"), (2, "Psidium guajava"), (4, "Myrtus guajavva"), (6, "Garcinia kola")]
    spark.createDataFrame(pages, "page_id long, name string").write.parquet(str(tmp_path / "wiki_species.parquet"))
    got = {r.query: r.match for r in FIGURES["j_fuzzy_pages"](spark, str(tmp_path)).collect()}
    assert got == {"whytei": "whyteii", "whyteii": "whytei", "guajava": "guajavva", "guajavva": "guajava"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.booleans(), st.booleans()), min_size=1, max_size=12))
def test_depth_is_never_negative(spark, items):
    rows = [("k", i, n, "'" if p else "", "t", t) for i, (n, p, t) in enumerate(items, 1)]
    got = K.indented(spark.createDataFrame(rows, "k string, ord int, num int, prime string, text string, is_terminal boolean"), "k").collect()
    stack, want = [], []
    for _, _, n, p, _, t in rows:
        if not p:
            while stack and abs(stack[-1]) >= n:
                stack.pop()
            want.append(len(stack))
            stack.append(n)
        else:
            at = [i for i, x in enumerate(stack) if abs(x) == n]
            stack = stack[: at[-1]] if at else stack
            want.append(len(stack))
            if not t:
                stack.append(-n)
    assert [r.depth for r in sorted(got, key=lambda r: r.ord)] == want


def test_reach_ends_on_cycles(spark):
    graph = spark.createDataFrame([("k", 1, 2), ("k", 2, 3), ("k", 3, 1), ("k", 4, None)], "key_id string, num int, leads_to int")
    got = K.reached(graph, spark.createDataFrame([("k", 1)], "key_id string, num int")).collect()
    assert sorted((r.num, r.depth) for r in got) == [(1, 0), (2, 1), (3, 2)]


def test_reach_has_no_bound(spark):
    graph = spark.createDataFrame([("k", i, i + 1) for i in range(1, 66)], "key_id string, num int, leads_to int").coalesce(1)
    got = K.reached(graph, spark.createDataFrame([("k", 1)], "key_id string, num int").coalesce(1)).collect()
    assert sorted((r.num, r.depth) for r in got) == [(i, i - 1) for i in range(1, 67)]


def test_reach_of_nested_nodes(spark, tmp_path):
    import json

    leaf = {"prime": "", "is_terminal": True, "terminal_name": "x"}
    tree = {"1": {"num": 1, "children": {"2": {"num": 2, "children": [{"node_key": "3", "num": 3, "leads_to": 5}]}, "2'": {"num": 2, **leaf}}}, "1'": {"num": 1, "leads_to": 4}, "4": {"num": 4, **leaf}, "5": {"num": 5, **leaf}, "7": {"num": 7, **leaf}}
    doc = json.dumps({"keys": {"a": {"nodes": tree}, "b": {"nodes": {"2": {"num": 2, **leaf}}}, "c": {"nodes": {}}}})
    spark.createDataFrame([(1, "s", doc)], "dataset_id long, source string, payload string").write.parquet(str(tmp_path / "key_datasets.parquet"))
    got = {r.key_id: tuple(r[c] for c in ("nodes", "numbers", "reached", "deepest")) for r in QUERIES["j_traverse_files"](spark, str(tmp_path)).collect()}
    assert got == {"1|a": (8, 6, 5, 3), "1|b": (1, 1, 1, 0), "1|c": (0, 0, 0, None)}


def test_corrupt_volumes_go_to_recognition(spark, tmp_path):
    def text(line, n):
        return "\n".join(f"<!-- page {p} -->\n{line}" for p in range(1, n + 1))

    docs = [("a", "1", "F", "e", text("fe3ui11es ova1es " * 15, 12)), ("a2", "01", "F", "e", text("x " * 200, 2)), ("b", "2", "F", "e", text("feuilles ovales " * 50, 14)), ("c", "3", "F", "e", text("x", 14))]
    spark.createDataFrame(docs, "doc_id string, volume string, family string, engine string, text string").write.parquet(str(tmp_path / "documents_md.parquet"))
    assert len(docs[0][4]) < 8000 < len(docs[2][4])
    assert {r.volume: r.engine for r in RUNS["t_fallback_score"](spark, str(tmp_path)).collect()} == {"1": "ocr_fallback", "2": "text", "3": "ocr"}


def test_calls_are_tried_again_and_paced(spark, data):
    import time

    got = RUNS["t_retry_texts"](spark, data).collect()
    assert got and {r.status for r in got} == {"retried"}
    texts = spark.createDataFrame([("d", i, "x") for i in range(5)], "doc_id string, chunk_no int, text string").coalesce(1)
    began = time.monotonic()
    assert len(engines.translated(texts, lambda t: t, least_seconds=0.5).collect()) == 5
    assert time.monotonic() - began >= 2.0


def test_running_mean_in_slices(spark):
    df = spark.createDataFrame([("g", i, float(i)) for i in range(1, 9)] + [("h", 1, 4.0)], "g string, i int, v double")
    got = {(r.g, r.i): r.m for r in D.running_mean(df, "g", F.floor(F.col("i") / 3), ["i"], "v", "m").collect()}
    assert got["g", 8] == 4.5 and got["g", 1] == 1.0 and got["h", 1] == 4.0


def test_pending_and_ingest(spark, tmp_path):
    work = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    done = spark.createDataFrame([("a",), ("a",)], "k string")
    assert {r.k for r in incremental.pending(work, done, "k").collect()} == {"b", None}
    assert incremental.pending(work, done, "k", force=True).count() == 3
    src = str(tmp_path / "in")
    for k, mode in ((1, "overwrite"), (2, "append")):
        spark.range(k).write.mode(mode).parquet(src)
        incremental.ingest(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), "id long")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_session_fold(spark):
    rows = [(1, "s", 1, "back", "k"), (2, "s", 2, "choose", "k"), (2, "s", 2, "choose", "k"), (3, "s", 3, "choose", None), (4, "s", 4, "back", "k"), (5, "t", 1, "choose", "k"), (6, "t", 2, "restart", "k")]
    got = {r.session_key: (r.steps, r.depth, r.phase) for r in sessions.folded(spark.createDataFrame(rows, "event_id long, session_key string, ord int, nav_action string, key_id string")).collect()}
    assert got == {"s": (4, 1, "inside"), "t": (2, 0, "start")}


def test_sinks_and_config(spark, tmp_path):
    docs = spark.createDataFrame([("d", "1", "F", "x")], "doc_id string, volume string, family string, text string")
    sinks.write_documents(docs, str(tmp_path / "docs"))
    assert (tmp_path / "docs/_complete/_SUCCESS").exists() and spark.read.parquet(str(tmp_path / "docs")).count() == 1
    bad = spark.createDataFrame([("a", None), ("b", "broken")], "k string, error string")
    assert [r.k for r in sinks.write_failures(bad, str(tmp_path / "err")).collect()] == ["a"]
    (tmp_path / "c.toml").write_text('[corpus]\npdf_dir = "pdf"\noutput_dir = "/out"\nvol_pattern = "x"\n')
    corpus = files.load_corpus(str(tmp_path / "c.toml"))
    assert corpus.pdf_dir == str(tmp_path / "pdf") and corpus.output_dir == "/out" and corpus.pdf_glob == "*.pdf"
    (tmp_path / "A_vol01_paddle").mkdir()
    (tmp_path / "A_vol01_paddle/text.md").write_text("x\ny\n")
    assert [tuple(r) for r in files.read_texts(spark, f"{tmp_path}/*/text.md").select(*files.directory_parts(), "text").collect()] == [("A", "01", "paddle", "x\ny\n")]


def section_oracle(lines):
    """Statements of a section, told from a string that has a letter for the kind of each line."""
    ref = re.compile(r"^[0-9]{1,2}(?:'|\"|[’′])*\.\s")

    def short(x):
        return ref.match(x) and len(ref.sub("", x).strip()) <= 50 and re.match(r"[A-Z][a-z]*\.\s+[A-Z]?[a-z]", ref.sub("", x).strip())

    def letter(x):
        if not x:
            return "b"
        if re.match(r"#{1,6}\s", x) or x.startswith("<!--"):
            return "c"
        return ("f" if short(x) else "s") if ref.match(x) else "r" if re.match(r"[0-9]+['\"]*\.\s+[A-Z]", x.strip()) and not ref.match(x.strip()) or short(x.strip()) else "t"

    lines = [x.rstrip() for x in lines]
    code, out, at = "".join(map(letter, lines)), [], 0
    while at < len(lines):
        m = re.compile("[sf][trf]*").match(code, at)
        if not m:
            if lines[at] or out:
                out.append((-1, "", lines[at], True))
            at += 1
            continue
        num, prime = re.match(r"([0-9]+)([^.]*)", lines[at]).groups()
        text = " ".join([ref.sub("", lines[at]), *(x.strip() for x in lines[at + 1 : m.end()])])
        behind = None if ".." in text else re.compile("b*[rf]").match(code, m.end())
        at = behind.end() if behind else m.end()
        out.append((int(num), prime, f"{text.rstrip()} {lines[at - 1].strip()}" if behind else text, behind is not None or ".." in text))
    return out


def test_statements_of_random_sections(spark):
    rng = random.Random(7)
    kinds = ["1. Leaves opposite", "2'. Petals fused ..... Syzygium", "3. E. obanensis.", "3'. Fruit red", "   12. Eugenia sp", "104. Eugenia", "going on", "  indented more ", "", "   ", "## Heading", "<!-- page 3 -->", "6'. S. Whytei.", "4. Trees .. 7"]
    sections = {f"d{k}": [rng.choice(kinds) for _ in range(rng.randint(1, 12))] for k in range(600)}
    rows = [(d, i, x) for d, ls in sections.items() for i, x in enumerate(ls, 1)]
    got = {}
    for r in K.couplets(spark.createDataFrame(rows, "doc_id string, line_no int, line string"), "doc_id").orderBy("doc_id", "ord").collect():
        got.setdefault(r.doc_id, []).append((r.num, r.prime, r.text, r.is_terminal))
    for d, ls in sections.items():
        assert got.get(d, []) == section_oracle(ls), ls


def test_run_on_lines_are_cut_to_the_end(spark):
    line = "- a .... X" + " - b .... Y" * 9
    df = spark.createDataFrame([("d", 1, line)], "doc_id string, line_no int, line string")
    assert K.split_run_ons(df).count() == 10 and K.split_run_ons(df, passes=5).count() == 6


def test_whole_and_cut_off_family_heads_keep_their_first(spark):
    heads = {"# LEGUMINOSAE": "first", "## EBENACE": "repair", "# MYRTACEAE": "first", "# R. LETOUZEY": "drop"}
    rows = [("d", "v1", 2 * p + k, x, p) for p in range(1, 9) for k, x in enumerate([*list(heads)[p % 4 :], *list(heads)[: p % 4], "text"])]
    rows = [(d, v, i, x, p) for i, (d, v, _, x, p) in enumerate(rows)] + [("e", "v2", 1, "# LEGUMINOSAE", 1), ("f", None, 1, "# LEGUMINOSAE", 1)]
    out = D.without_headers(spark.createDataFrame(rows, "doc_id string, volume string, line_no int, line string, page int"), "volume").collect()
    done = {}
    for r in out:
        done.setdefault((r.volume, r.line), []).append((r.action, r.kept))
    for head, first in heads.items():
        actions = [a for a, _ in done["v1", head]]
        assert sorted(actions) == sorted([first, *["drop"] * 7])
    assert ("repair", "## EBENACEAE") in done["v1", "## EBENACE"]
    assert done["v2", "# LEGUMINOSAE"] == done[None, "# LEGUMINOSAE"] == [("keep", "# LEGUMINOSAE")]
    assert {a for a, _ in done["v1", "text"]} == {"keep"}


def test_folding_is_compatibility_decomposition_without_marks(spark):
    bare = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    texts = ["ANNONACĒAE", "ŠAPOTACÉES", "Ebénacées", "a b", "ﬁn ½ … ①", "", *("".join(map(chr, range(a, a + 32))) for a in range(0x20, 0x3400, 32))]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select("x", S.accents_folded(F.col("x")).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(t, bare(t)) for t in texts]
