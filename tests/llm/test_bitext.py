import itertools
import random
import time

import pytest

from scriptorium.llm import bitext as B

FR = ["Les feuilles sont glabres et épaisses ; on y mesure {0}–{1} mm de longueur.", "Le type, conservé à HBM, a été récolté en {2} par A. Bodu{3}.", "Des abeilles visitent les fleurs vers {4} heures."]
EN = ["The leaves are glabrous and thick; length {0} to {1} mm.", "Type: A. Bodu{3}, {2}, deposited in HBM.", "Bees visit the flowers around {4}:00."]


def corpus():
    out = []
    for k in range(30):
        v = (k + 2, k + 9, 1900 + k, "abcdef"[k % 6], k % 12 + 1)
        out.append((k, "# Titre\n" + "\n".join(x.format(*v) for x in FR), "# Title\n\n" + "\n".join(EN[i].format(*v) for i in (0, 2, 1))))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(*r, "f", 3) for r in rows], "pair_id long, text string, text_en string, f string, n long")
    got = {}
    for r in B.aligned(df).collect():
        got.setdefault(r.pair_id, set()).add((r.fr_line, r.en_line))
    return got


def test_reordered_lines(spark):
    got = run(spark, corpus())
    assert all(got[k] == {(2, 3), (3, 5), (4, 4)} for k in range(30))


def test_merge_split_omission_and_edges(spark):
    v = (50, 61, 1955, "z", 7)
    merged = (100, FR[0].format(*v) + "\n" + FR[1].format(*v), EN[0].format(*v)[:-1] + "; " + EN[1].format(*v))
    split = (101, FR[0].format(*v), "Leaves glabrous, thick.\nLength 50 to 61 mm.")
    omitted = (102, "\n".join(x.format(*v) for x in FR), EN[2].format(*v))
    edges = [(103, None, "x"), (104, "", ""), (105, "# a", "# b"), (None, "a", "b"), (106, "mot", "word")]
    got = run(spark, corpus() + [merged, split, omitted, *edges, merged])
    assert got[100] == {(1, 1), (2, 1)} and got[101] == {(1, 1), (1, 2)} and got[102] == {(3, 1)}
    assert not {103, 104, 105} & set(got)


def test_empty(spark):
    assert run(spark, []) == {}


def test_long_documents(spark):
    v = [(k, k + 3, 1000 + k, "q", k % 12 + 1) for k in range(150)]
    long = (200, "\n".join(FR[1].format(*x) for x in v), "\n".join(EN[1].format(*x) for x in v))
    assert run(spark, corpus() + [long])[200] == {(i, i) for i in range(1, 151)}


def test_a_lexicon_too_large_to_broadcast_gives_the_same(spark):
    df = spark.createDataFrame(corpus(), "pair_id long, text string, text_en string")
    assert sorted(map(tuple, B.aligned(df, lexicon_rows=0).collect())) == sorted(map(tuple, B.aligned(df).collect()))


def test_chain_is_the_best_one():
    rng = random.Random(1)
    for _ in range(200):
        pairs = [(rng.randint(0, 6), rng.randint(0, 6), rng.random()) for _ in range(8)]
        best = max(sum(p[2] for p in c) for n in range(9) for c in itertools.combinations(sorted(pairs), n) if all(a[1] < b[1] and a[0] < b[0] for a, b in zip(c, c[1:])))
        weight = {}
        for i, j, w in pairs:
            weight[i, j] = max(w, weight.get((i, j), 0))
        got = B.chain(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        assert abs(sum(weight[p] for p in got) - best) < 1e-9


def noisy(seed: int, n: int = 60) -> tuple[list[tuple], set[tuple]]:
    """Planted pairs: invented sentences word for word in another invented language, some left out, added, merged or moved."""
    rng = random.Random(seed)
    name = lambda a, b: "".join(rng.choice(a) + rng.choice(b) for _ in range(3))
    words = [(name("bdgkt", "aeo"), name("flmnrs", "iuy")) for _ in range(120)]
    rows, truth = [], set()
    for pid in range(n):
        fr, en = ["# x"], ["# y", ""]
        for _ in range(rng.randint(8, 25)):
            some = rng.sample(words, 6)
            shared = [str(rng.randint(100, 999))] if rng.random() < 0.5 else [name("PKT", "ou").capitalize()] if rng.random() < 0.5 else []
            f, e = " ".join([w for w, _ in some] + shared), " ".join([w for _, w in reversed(some)] + shared)
            r = rng.random()
            if r < 0.08:
                fr.append(f"{f}.")
            elif r < 0.16:
                en.append(f"{e}.")
            elif r < 0.24 and len(fr) > 2:
                fr[-1] += f" {f.capitalize()}."
                en.append(f"{e}.")
                truth.add((pid, len(fr), len(en)))
            else:
                fr.append(f"{f}.")
                en.append(f"{e}.")
                truth.add((pid, len(fr), len(en)))
        rows.append((pid, "\n".join(fr), "\n".join(en)))
    return rows, truth


@pytest.mark.parametrize("seed", [3, 4])
def test_planted_pairs_of_invented_languages(spark, seed):
    rows, truth = noisy(seed)
    got = {(p, *x) for p, xs in run(spark, rows).items() for x in xs}
    assert len(got & truth) >= 0.9 * len(truth) and len(got & truth) >= 0.9 * len(got)


def test_very_long_pair_takes_no_square_time():
    rng = random.Random(5)
    lines = [" ".join(f"w{rng.randint(0, 3000):x}q" for _ in range(8)) + f" {rng.randint(1, 99999)}" for _ in range(8000)]
    fr = B.clauses("\n".join(lines))
    began = time.perf_counter()
    links, m = B.align(fr, fr, B.Scorer())
    assert len(links) >= 0.99 * len(fr) and time.perf_counter() - began < 60


def unlinked(n):
    """Documents of four clauses that nothing ties together."""
    return [(k, "\n".join(f"mul{x} tor{x}" for x in "abcd"), "\n".join(f"gek{x} fos{x}" for x in "abcd")) for k in range(n)]


def test_clauses_left_over_are_all_trained_on(spark):
    lexicon, _ = B.train(spark.createDataFrame(unlinked(12), "pair_id long, text string, text_en string"))
    assert {(r.f, r.e) for r in lexicon.collect()} == {(f + x, e + y) for f in ("mul", "tor") for e in ("gek", "fos") for x in "abcd" for y in "abcd"}


def test_words_of_large_gaps_are_counted_the_same_in_spark(spark):
    rows = unlinked(12) + noisy(5, 20)[0] + corpus()
    df = spark.createDataFrame(rows, "pair_id long, text string, text_en string")
    want, got = (sorted(map(tuple, B.train(df, n)[0].collect())) for n in (B.BAG_PAIRS, 20))
    assert want and got == want
