import random

from pyspark.sql import functions as F

from scriptorium.llm import scan_noise as S

BODY = [
    "Les feuilles sont glabres et luisantes sur les rameaux.", "Le fruit est charnu et la graine est petite.", "Les étamines sont dressées dans la corolle intérieure.",
    "La plante est connue de Pogi-Sud et de Lapebena depuis longtemps dans la région.", "Les poils sont à la fois sous- et sus-foliaires dans la région.", "La corolle est verdâtre et le calice est strié.",
]


def corpus(extra):
    pages = []
    for k in range(12):
        pages.append("\n".join(["<!-- page 1 -->", "FLORE DE TIJONGO", "## GUGANACÉES", "", *BODY, "", "---", "", "<!-- page 2 -->", f"FLORE DE TIJONGO {k + 2}", *BODY, f"— {k} —"]))
    return [("text", f"d{k}", p) for k, p in enumerate(pages)] + extra


def find(spark, extra, schema="src string, rec_id string, text string"):
    rows = S.found(spark.createDataFrame(corpus(extra), schema)).collect()
    return {(r.line_no, r.defect) for r in rows if r.rec_id == "x"}


def test_hyphens(spark):
    text = "\n".join(["Les feuil-", "les sont glabres et la co¬", "rolle est verdâtre ; de Pogi-", "Sud et de Lapebena depuis long", "temps. Les poils sont à la fois sous- et sus-", "foliaires. Le fru- it est petit et la gra­ine aussi. Les ra -", "meaux."])
    got = find(spark, [("text", "x", text)])
    assert {(1, "hyphen"), (2, "hyphen"), (4, "hyphen"), (6, "hyphen")} <= got
    assert (3, "hyphen") not in got and (5, "hyphen") not in got


def test_misread(spark):
    text = "\n".join(["Les feui1les sont glabrcs et luis;antes.", "Le f r u i t est charnu.", "La graine est petite.", "Les rameaux de Zubogrix sont dressés."])
    got = find(spark, [("text", "x", text)])
    assert {(1, "misread"), (2, "misread")} <= got and not any(n in (3, 4) for n, _ in got)


def test_page_edges(spark):
    text = "\n".join(["<!-- page 7 -->", "FL0RE DE TIJONGO 7", "## GUGANACÉES", "Le fruit est charnu.", "3", "4.", "7'.", "La graine est petite.", "[7]", "", "---", "", "<!-- page 8 -->", "8", "Le calice est strié.", "xii"])
    assert find(spark, [("text", "x", text)]) == {(2, "header"), (9, "pageno"), (14, "pageno"), (16, "pageno")}


def test_caption_edges(spark):
    other = [("caption", f"y{k}", f"Fig. {k}. Guganus abruii : 1, fruit.\nGUGANACÉES {k}") for k in range(3)]
    got = find(spark, [("caption", "x", "Fig. 3. Guganus abruii : 1, feuil-\nle glabre.\nGUGANACÉES 12\n14"), *other])
    assert got == {(1, "hyphen"), (3, "header"), (4, "pageno")}


def test_capitals_that_stand_once_are_no_head(spark):
    text = "<!-- page 1 -->\nAVERTISSEMENT AU LECTEUR\nLe fruit est charnu."
    assert find(spark, [("text", "x", text)]) == set()


def test_a_head_not_in_capitals_recurs_at_the_edges_of_its_record(spark):
    text = "\n---\n".join(f"<!-- page {k} -->\nCatalogue du jardin {k}\nLe fruit est charnu." for k in range(1, 6))
    assert find(spark, [("text", "x", text)]) == {(2 + 4 * k, "header") for k in range(5)}


def test_counts_do_not_rise_with_the_corpus(spark):
    """Heads and words that a small corpus supports are found among a hundred times as many other records."""
    rng = random.Random(4)
    other = [("text", f"z{k}", "\n".join(" ".join(rng.choice(["plore", "vendit", "osmane", "kelt", "brunel", "taxin"]) for _ in range(9)) for _ in range(6))) for k in range(1200)]
    text = "<!-- page 7 -->\nFL0RE DE TIJONGO 7\nLes feui1les sont glabrcs."
    assert find(spark, [("text", "x", text), *other]) == {(2, "header"), (3, "misread")}


def test_planted_noise(spark):
    """Recall and precision on noise planted with other words than those of the test tables."""
    rng = random.Random(9)
    words = ["".join(rng.choice("bdlmnprst") + rng.choice("aeiou") for _ in range(rng.randint(3, 4))) for _ in range(150)]
    truth, records = set(), []
    for d in range(150):
        lines = []
        for n in range(1, 12):
            ws = [rng.choice(words) for _ in range(9)]
            r = rng.random()
            if r < 0.15:
                k = rng.randrange(1, 8)
                w = ws[k]
                at = rng.randrange(1, len(w) - 1)
                bad = w[:at] + {"o": "0", "l": "1", "s": "5", "e": "c", "a": "@", "i": "!"}.get(w[at], w[at] + ";") + w[at + 1 :]
                ws[k] = bad
                truth.add((f"d{d}", n, "misread"))
            elif r < 0.3:
                at = rng.randrange(2, len(ws[4]) - 1)
                ws[4] = ws[4][:at] + rng.choice(["- ", "\u00ad", "¬"]) + ws[4][at:]
                truth.add((f"d{d}", n, "hyphen"))
            lines.append(" ".join(ws) + ".")
        records.append(("text", f"d{d}", "\n".join(lines)))
    rows = S.found(spark.createDataFrame(records, "src string, rec_id string, text string")).collect()
    got = {(r.rec_id, r.line_no, r.defect) for r in rows}
    assert len(got & truth) >= 0.9 * len(truth) and len(got & truth) >= 0.9 * len(got)


def test_nulls_empties_copies_and_clashing_columns(spark):
    schema = "src string, rec_id string, text string, kind string, defects string, n long, a string"
    rows = [(*r, "k", "d", 1, "a") for r in corpus([("text", None, "x"), ("text", "e", ""), ("text", "n", None), ("text", "x", "Les feuil-\nles sont glabres."), ("text", "x", "Les feuil-\nles sont glabres.")])]
    df = spark.createDataFrame(rows, schema)
    assert S.found(df).filter("rec_id = 'x'").count() == 1
    assert S.reflow(df).filter("rec_id in ('e', 'n')").count() == 0
    assert S.reflow(df).filter("rec_id = 'x'").select("text").collect()[0].text == "Les feuilles sont glabres."


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "src string, rec_id string, text string")
    assert S.found(empty).count() == 0 and S.reflow(empty).count() == 0
    long = " ".join(BODY * 3000)
    got = S.reflow(spark.createDataFrame(corpus([("text", "x", long)]), "src string, rec_id string, text string")).filter("rec_id = 'x'")
    assert got.agg(F.sum(F.length("text"))).first()[0] == len(long)


def test_reflow_goes_on_over_pages(spark):
    text = "\n".join(["<!-- page 1 -->", "FLORE DE TIJONGO", "Les étamines sont dressées dans la co-", "", "---", "", "<!-- page 2 -->", "FLORE DE TIJONGO", "rolle intérieure.", "", "Le fruit est charnu."])
    rows = S.reflow(spark.createDataFrame(corpus([("text", "x", text)]), "src string, rec_id string, text string")).filter("rec_id = 'x'").orderBy("para_no").collect()
    assert [r.text for r in rows] == ["Les étamines sont dressées dans la corolle intérieure.", "Le fruit est charnu."]


def test_reflow_keeps_hyphens_that_belong(spark):
    text = "La plante est connue de Pogi-\nSud ; les poils sont à la fois sous-\net sus-\nfoliaires dans la région."
    rows = S.reflow(spark.createDataFrame(corpus([("text", "x", text)]), "src string, rec_id string, text string")).filter("rec_id = 'x'").collect()
    assert [r.text for r in rows] == ["La plante est connue de Pogi-Sud ; les poils sont à la fois sous- et sus-foliaires dans la région."]


def test_a_lexicon_too_large_to_broadcast_gives_the_same(spark):
    noisy = [
        "Les feuil-\nles sont glabrcs et luis;antes.\nLe f r u i t est charnu et la co¬\nrolle verdatre, long", "temps connue de Pogi-\nSud. Le fru- it est petit, les pcils sus-\nfoliaires.",
        "<!-- page 7 -->\nFL0RE DE TIJONGO 7\nLe ca1ice est str1é et la p1ante ra meaux.\n— 8 —\n<!-- page 8 -->\nFLORE DE T1JONGO\nGUGANACEES\nL'étaminc est drcssée.", "", None,
    ]
    rows = corpus([("text", f"x{i}", t) for i, t in enumerate(noisy)] + [("caption", "y", "Fig. 3. Guganus abruii : 1, feuil-\nle glabre.\nGUGANACÉES 12\n14")])
    df = spark.createDataFrame(rows, "src string, rec_id string, text string")
    want, got = (sorted(map(str, S.read_lines(df, n).collect())) for n in (S.LEXICON_ROWS, 10))
    assert len({r.defect for r in S.found(df).collect()}) == 4 and got == want
