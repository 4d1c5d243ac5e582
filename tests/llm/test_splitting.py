import re

from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import splitting as S


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.! \n", max_size=300), st.integers(1, 40))
def test_stretches_cover_the_text(text, room):
    out = S.bisect(text, room)
    assert "".join(text[a:b] for a, b, _ in out) == text
    assert all(b - a <= room for a, b, _ in out) and all(x[1] == y[0] for x, y in zip(out, out[1:]))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.! \n", min_size=1, max_size=300), st.integers(3, 40))
def test_level_is_the_coarsest_that_fits(text, room):
    levels = [x[2] for x in S.bisect(text, room) if x[2] >= 0]
    paragraphs = [p.strip() for p in re.split(r"\n(?:[^\S\n]*\n)+", text)]
    sentences = [s.strip() for p in paragraphs for s in re.split(r"(?<=[.!?])\s+", p)]
    fits = lambda units: max(map(len, units)) <= room
    want = 0 if fits(paragraphs) else 1 if fits(sentences) else 2 if fits(text.split() or [""]) else 3
    if len(text.strip()) > room:
        assert max(levels) == want


def test_pieces(spark):
    docs = [("a", "e", "x" * 25), ("b", "e", None), ("c", "e", ""), ("d", None, "y" * 99), ("f", "e", "one two. three four.\n\nfive six seven"), (None, "e", "z")]
    df = spark.createDataFrame([(*d, 1, "t", 2) for d in docs], "doc_id string, engine string, text string, start int, cut_level string, max_chars int")
    limits = spark.createDataFrame([("e", 12, 3), ("e", 12, 3)], "engine string, max_chars int, overlap_chars int")
    rows = S.pieces(df, limits).orderBy("doc_id", "piece_no").collect()
    of = lambda k: [r for r in rows if r.doc_id == k]
    assert not of("b") and [r.text for r in of("c")] == [""] and len(of("d")) == 1
    for k in "af":
        text = dict((d[0], d[2]) for d in docs)[k]
        assert all(len(r.text) <= 12 for r in of(k))
        assert "".join(text[r.body_start : r.end] for r in of(k)) == text
        assert all(y.text.startswith(x.text[-min(3, len(x.text)) :]) for x, y in zip(of(k), of(k)[1:]))
    assert S.pieces(df.limit(0), limits).count() == 0


def test_very_long_text(spark):
    text = "word " * 200_000
    df = spark.createDataFrame([("a", "e", text)], "doc_id string, engine string, text string")
    limits = spark.createDataFrame([("e", 1000, 50)], "engine string, max_chars int, overlap_chars int")
    assert S.pieces(df, limits).agg({"end": "max"}).first()[0] == len(text)


def test_no_tiny_pieces_where_a_unit_must_be_broken_anyway():
    from scriptorium.llm import splitting as P

    text = "A heading.\n\n" + "One sentence of some words stands here. " * 130
    cut = P.bisect(text, 4800)
    assert len(cut) == 2 and min(e - s for s, e, _ in cut) > 1000 and "".join(text[s:e] for s, e, _ in cut) == text
    fits = "a" * 90 + "\n\n" + "b" * 900 + "\n\n" + "c" * 20
    assert [x[2] for x in P.bisect(fits, 1000)] == [0, -1] or all(x[2] in (0, -1) for x in P.bisect(fits, 1000))
