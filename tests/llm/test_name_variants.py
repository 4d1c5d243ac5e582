from hypothesis import given
from hypothesis import strategies as st

from scriptorium.llm import name_variants as N

PAGE = "page_id long, name string, authority string, genus string, family string, vernacular array<string>, ent string, id long, node string"
FIG = "fig_id long, caption string, id long, credit string, ent string"


def species(spark, rows):
    df = spark.createDataFrame([(*r, "e", 1, "n") for r in rows], PAGE)
    return {(r.id_a, r.id_b) for r in N.pairs_within(N.species_entities(df), "species").collect()}


def collectors(spark, rows):
    df = spark.createDataFrame([(i, c, 1, "x", "e") for i, c in rows], FIG)
    return {(r.id_a, r.id_b) for r in N.pairs_within(N.collector_entities(df), "collector").collect()}


@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_edits_against_the_definition(a, b):
    from functools import cache

    @cache
    def d(i, j):
        if not i or not j:
            return i + j
        out = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            out = min(out, d(i - 2, j - 2) + 1)
        return out

    assert N.edits(a, b, 2) == min(d(len(a), len(b)), 3)


def test_neighbours_against_brute_force(spark):
    import itertools
    import random

    rng = random.Random(3)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(4, 12))) for _ in range(150)}
    got = {(r.a, r.b): r.dist for r in N.near_tokens(spark.createDataFrame([(w,) for w in words], "token string")).collect()}
    want = {}
    for a, b in itertools.combinations(sorted(words), 2):
        least = min(len(a), len(b))
        d = N.edits(a, b, 2)
        if least >= 3 and d <= (2 if least >= 10 else 1):
            want[a, b] = d
    assert got == want


def test_species(spark):
    rows = [
        (1, "Bregrostemma rulablamoosa", "Nevo", "Bregrostemma", "Civranaceae", ["ojublo"]), (2, "B. rulablamoosa", None, "Bregrostemma", None, None), (3, "Bregrostemma rulablamoosus", "Nevo", None, "Civranaceae", []),
        (4, "Bregrostemmarulablamoosa", "Nevo", "Bregrostemma", "Civranaceae", []), (5, "Bregrostemma rullablamoosa Nevo", None, None, None, []), (6, "rulablamoosa (Bregrostemma)", "Nevo", "Bregrostemma", None, []),
        (7, "OJUBLO", "Nevo", "Bregrostemma", "Civranaceae", []), (8, "Bregrostemma rulablamoensis", "Padi", "Bregrostemma", "Civranaceae", []), (9, "Conilus rulablamoosa", "Tobu", "Conilus", "Conilaceae", []),
        (10, None, None, None, None, None), (11, "", None, None, None, []), (1, "Bregrostemma rulablamoosa", "Nevo", "Bregrostemma", "Civranaceae", ["ojublo"]),
    ]
    same = range(1, 8)
    assert species(spark, rows) == {(a, b) for a in same for b in same if a < b}


def test_collectors(spark):
    say = "Fig. 1 – Guganus abruii Nevo : 1, feuille (× 2). Réc. : {}, n° 12."
    one = ["Frédéric Lusugrivu", "F. Lusugrivu", "Frédo Lusugrivu", "Lusugrivu, F.", "F.E. Lusugrivu", "FREDERIC LUSUGRIVU", "Frédéric Lusugrivi", "Mme F. Lusugrivu", "Lusugri., Frédéric"]
    two = ["Institut de recherches de Brutricutrun", "Inst. Rech. Brutricutrun", "I.R. Brutricutrun", "Brutricutrun, Institut de recherches"]
    rest = ["W. Lusugrivu", "Mission botanique de Brutricutrun"]
    rows = [(i, say.format(n)) for i, n in enumerate(one + two + rest, 1)] + [(90, None), (91, "(no caption)"), (92, "")]
    a, b = range(1, len(one) + 1), range(len(one) + 1, len(one) + len(two) + 1)
    assert collectors(spark, rows) == {(x, y) for g in (a, b) for x in g for y in g if x < y}


def test_credit_forms():
    for text in ("Fig. 1. G. x (A. Bodu 12) : 1, fleur.", "PL. I. — G. x : 1, fleur (× 2). — 1-3, A. Bodu 12.", "G. x : 1. (d'après A. Bodu 12)", "G. x : 1. Réc. : A. Bodu, n° 12."):
        assert N.credit(text) == "A. Bodu"


def test_empty(spark):
    assert species(spark, []) == set() and collectors(spark, []) == set()


def test_chains_of_any_length_reach_their_top(spark):
    names = [f"n{k:03d}" for k in range(90)]
    nodes = spark.createDataFrame([(x, 1) for x in names], "node string, n long")
    edges = spark.createDataFrame(list(zip(names, names[1:])), "a string, b string")
    hubs = {r.node: r.hub for r in N.hubs(nodes, edges).collect()}
    assert set(hubs.values()) == {"n088"}


@given(st.lists(st.lists(st.sampled_from([0.0, 0.1, 0.2, 0.5, float("inf")]), min_size=5, max_size=5), min_size=1, max_size=5))
def test_assignment_against_brute_force(cost):
    import itertools

    want = min(sum(cost[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(5), len(cost)))
    got = N.least_assignment(cost)
    assert got == want or abs(got - want) < 1e-9


def test_names_of_many_tokens_are_read_to_the_end():
    a = ("anne", "berthe", "claire", "diane", "eve")
    assert N.assignment(a, (*a[:4], "zoe")) == float("inf")
    assert N.assignment(("zoe",), ("anne", "berthe", "claire", "diane", "eve", "fanny", "zoe")) < 1


def test_long_credits_and_genera_are_read(spark):
    long = "Marie Anne Berthe Claire Diane Eve Fanny Georgette Henriette Ida Jeanne Karine de Lusugrivuplatrodendromaxi"
    assert N.credit(f"Fig. 1. G. x (d'après {long} 12)") == long
    genus = "Bregrostemmatoplachyphyllodendron"
    rows = [(1, f"{genus} rula", "Nevo", None, None, []), (2, f"{genus}rula", "Nevo", None, None, [])]
    assert species(spark, rows) == {(1, 2)}


def test_short_tokens_need_more_than_an_edit(spark):
    rows = [(k, "Guganus rufa", "Nevo", "Guganus", None, []) for k in range(6)] + [(10, "Guganus ruta", "Nevo", "Guganus", None, []), (11, "Guganus rusa", "Padi", "Guganus", None, [])]
    got = species(spark, rows)
    assert (0, 10) in got and (0, 11) not in got


def test_large_entities_are_listed_in_blocks(spark):
    import itertools

    N.BLOCK, old = 7, N.BLOCK
    try:
        df = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 100), ("b", 101)], "ent string, id long")
        got = sorted((r.id_a, r.id_b) for r in N.pairs_within(df, "x").collect())
    finally:
        N.BLOCK = old
    assert got == sorted([*itertools.combinations(range(40), 2), (100, 101)])
