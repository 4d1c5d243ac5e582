import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.llm import mixing as M
from scriptorium.llm import packing as P

DOC = "doc_id long, text string, source string, bin string, shard long, slice long, capacity int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "b", 1, 2, 3) for i, t, s in rows], DOC)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 8))
def test_best_fit_is_valid(sizes, most):
    bins = P.best_fit(np.array(sizes, dtype=np.int64), 50, max_docs=most)
    for b in set(bins.tolist()):
        inside = [s for s, x in zip(sizes, bins) if x == b]
        assert sum(inside) <= 50 and len(inside) <= most and sum(s * s for s in inside) <= 2500


def test_every_constraint_binds(spark):
    rows = [(i, "x" * (19 + i % 7), "s") for i in range(200)]
    windows = spark.createDataFrame([("a", 100)], "window_name string, capacity_tokens int")
    few = P.pack(docs(spark, rows), windows, max_docs=2).groupBy("bin_id").count()
    assert few.agg(F.max("count")).first()[0] == 2 and few.count() == 100
    cheap = P.pack(docs(spark, rows), windows, cost_share=0.1).groupBy("bin_id").agg(F.sum(F.pow("n_tokens", F.lit(2))).alias("cost"), F.count("*").alias("n"))
    assert cheap.filter("cost > 1000 and n > 1").count() == 0 and cheap.agg(F.sum("n")).first()[0] == 200


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_best_fit_is_near_the_bound(sizes):
    assert len(set(P.best_fit(np.array(sizes, dtype=np.int64), 50, max_docs=50).tolist())) <= -(-sum(sizes) // 50) * 11 / 9 + 1


def test_pack(spark):
    rows = [(i, "x" * (i * 37 % 90), "s") for i in range(300)] + [(900, "é" * 260, "s"), (901, None, "s"), (902, "", "s"), (None, "x", "s"), (5, "x" * (5 * 37 % 90), "s")]
    windows = spark.createDataFrame([("a", 100), ("b", 256), ("a", 100)], "window_name string, capacity_tokens int")
    packed = P.pack(docs(spark, rows), windows, max_docs=1000).cache()
    assert packed.groupBy("window_name", "bin_id").agg(F.sum("n_tokens").alias("t")).join(windows.distinct(), "window_name").filter("t > capacity_tokens").count() == 0
    sizes = {i: len(t.encode()) + 1 for i, t, _ in rows if i is not None and t is not None}
    for w in "ab":
        mine = packed.filter(F.col("window_name") == w).groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()
        assert {r.doc_id: r.t for r in mine} == sizes
        assert all(r.n == 1 for r in mine if sizes[r.doc_id] <= (100 if w == "a" else 256))
    assert all(r.fill > 0.95 for r in P.fill_report(packed, windows).collect())
    assert P.pack(docs(spark, []), windows).count() == 0 and P.pack(docs(spark, rows), windows.limit(0)).count() == 0


def test_mix_reaches_targets(spark):
    rows = [(i, "x" * 99, "big" if i % 3 else "small") for i in range(3000)] + [(9000, "x" * 99, "rare"), (9001, None, "big"), (9002, "y", None), (9003, "z", "unlisted"), (1, "x" * 99, "big")]
    goal = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("rare", 0.1, 5), ("gone", 0.2, 2), (None, 0.3, 1)], "source string, target_share double, max_repeats int")
    mixed = M.mix(docs(spark, rows), goal).cache()
    total = mixed.agg(F.sum("n_tokens")).first()[0]
    assert abs(total - (3001 * 100 + 2)) <= 50
    got = {r.source: r for r in M.shares(mixed, goal).collect()}
    assert got["rare"].records == 5 and got["gone"].tokens == 0
    assert abs(got["big"].actual_share / got["small"].actual_share - 0.5 / 0.4) < 0.01
    assert mixed.groupBy("doc_id", "repeat_no").count().filter("count > 1").count() == 0
    assert mixed.filter("source = 'small'").agg(F.max("repeat_no")).first()[0] <= 3


def test_mix_in_slices_is_the_plain_order(spark, monkeypatch):
    monkeypatch.setattr(M, "SLICE_ROWS", 7)
    rows = [(i, "x" * (i % 40), "ab"[i % 2]) for i in range(200)]
    goal = spark.createDataFrame([("a", 0.7, 3), ("b", 0.3, 3)], "source string, target_share double, max_repeats int")
    mixed = sorted(M.mix(docs(spark, rows), goal).collect(), key=lambda r: (r.source, r.finish_time))
    for s, w in (("a", 0.7), ("b", 0.3)):
        mine = [r for r in mixed if r.source == s]
        run = 0
        for r in mine:
            run += r.n_tokens
            assert abs(r.finish_time - run / w) < 1e-6


def test_mix_empty(spark):
    goal = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert M.mix(docs(spark, []), goal).count() == 0 and M.mix(docs(spark, [(1, "x", "a")]), goal.limit(0)).count() == 0


def test_binding_constraints_need_no_square_time():
    import time

    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 4000, 30_000)
    began = time.perf_counter()
    bins = P.best_fit(sizes, 4096, max_docs=6, max_cost=0.4 * 4096**2)
    assert time.perf_counter() - began < 20
    cost, count, tokens = (np.zeros(bins.max() + 1) for _ in range(3))
    np.add.at(cost, bins, sizes.astype(float) ** 2)
    np.add.at(count, bins, 1)
    np.add.at(tokens, bins, sizes)
    assert tokens.max() <= 4096 and count.max() <= 6 and ((cost <= 0.4 * 4096**2) | (count == 1)).all()


def test_default_limits_bind_and_costly_items_stand_alone(spark):
    windows = spark.createDataFrame([("a", 1024)], "window_name string, capacity_tokens int")
    rows = [(i, "x" * 9, "s") for i in range(100)] + [(1000, "x" * 1017, "s"), (1001, "x" * 2047, "s")]
    packed = P.pack(docs(spark, rows), windows)
    bins = {r.bin_id: r.n for r in packed.groupBy("bin_id").agg(F.count("*").alias("n")).collect()}
    assert max(bins.values()) == 16 and bins["c-1000-1"] == 1 and bins["f-1001-1"] == bins["f-1001-2"] == 1
    checked = P.validity(packed, docs(spark, rows), windows).first()
    assert (checked.docs, checked.broken_bins, checked.broken_docs) == (102, 0, 0)


def test_validity_sees_what_is_broken(spark):
    windows = spark.createDataFrame([("a", 128)], "window_name string, capacity_tokens int")
    wrong = spark.createDataFrame([("a", "b1", 1, 1, 0, 60), ("a", "b1", 2, 1, 0, 60), ("a", "b1", 3, 1, 0, 20)], "window_name string, bin_id string, doc_id long, piece_no int, tok_start long, n_tokens long")
    got = P.validity(wrong, docs(spark, [(1, "x" * 59, "s"), (2, "x" * 59, "s"), (3, "x" * 30, "s")]), windows).first()
    assert got.broken_bins == 1 and got.broken_docs == 1


def test_the_edge_of_a_mix_is_refined(spark):
    rows = [("s", i, 1, 10, 1.0 + i * 1e-9) for i in range(500)] + [("t", i, 1, 10, 50.0 + i) for i in range(50)]
    timed = spark.createDataFrame(rows, "source string, doc_id long, repeat_no int, n_tokens long, finish_time double")
    got = [r.doc_id for r in M.cut_off(timed, 3005, 100.0, edge_rows=20).collect()]
    assert got == list(range(301)) or got == list(range(300))
    assert M.cut_off(timed, 10**9, 100.0).count() == 550


def plain_best_fit(sizes, capacity, max_docs, max_cost):
    """Best-fit that scores every container for every item."""
    w, out, left = P.WEIGHTS / np.array([capacity, max_docs, max_cost]) ** 2, {}, []
    for k in np.argsort(-sizes, kind="stable").tolist():
        s, c = int(sizes[k]), float(sizes[k]) ** 2
        fits = []
        for b, (t, d, q) in enumerate(left):
            if t >= s and d >= 1 and q >= c:
                x, y, z = (t - s) / capacity, (d - 1) / max_docs, (q - c) / max_cost
                fits.append((float(w[0]) * s * t + (float(w[1]) * d + float(w[2]) * c * q), x * x + y * y + z * z, t, b))
        if not fits:
            left.append((capacity, max_docs, max_cost))
        b = out[k] = min(fits)[3] if fits else len(left) - 1
        t, d, q = left[b]
        left[b] = (t - s, d - 1, q - c)
    return [out[k] for k in range(len(sizes))]


def test_best_fit_scores_every_container():
    rng = np.random.default_rng(6)
    for capacity, n, top, max_docs, share in ((1000, 900, 300, 5, 0.98), (1000, 900, 30, 20, 0.98), (4096, 1500, 2500, 64, 0.4), (600, 700, 600, 3, 0.5), (100, 1200, 4, 40, 0.98)):
        sizes = rng.integers(1, top, n)
        sizes[rng.random(n) < 0.5] = rng.integers(1, max(2, top // 8))
        want = plain_best_fit(sizes, capacity, max_docs, share * capacity**2)
        assert P.best_fit(sizes, capacity, max_docs, share * capacity**2).tolist() == want
