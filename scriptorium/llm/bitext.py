"""Problem 5: sentence alignment in bilingual documents.

Method: numbers, names, cognates and known renderings that two clauses share
make anchors, found through an inverted index of the words of either side; the
increasing subsequence of anchors of the greatest weight is the backbone of a
document pair; the gaps between its links are aligned by local dynamic
programming over one-to-one, one-to-two and two-to-one links and omissions;
what was moved out of order is linked afterwards by what it shares.

No table of all clauses by all clauses is filled: only pairs that share a word
are scored, and a word that stands in so many clauses that it would make more
than COMMON pairs speaks in the gaps only, which are scored anew by themselves.

Two passes.  The first links by anchors alone and counts which words are left
over in linked clauses together; from these counts a lexicon is trained.  The
second links by anchors and lexicon.  All clauses left over in one gap, or in
linked lines, are counted together, however many; the more pairs they make, the
less each counts.  A document pair is read by one task.  The
lexicon is broadcast while it has at most LEXICON_ROWS entries; a larger one is
joined with the words of each document pair, with the same result.  The shares
of frequent words are broadcast; a word below FREQUENT of all words has the
weight of a rare one whether it is known or not, which bounds their number.

Lines hold one or more sentences, and sentences one or more clauses; clauses
are the unit of alignment, pairs of lines the result.  Null, empty or heading
lines are never paired; a null text gives no rows, a repeated pair its rows once.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.lineage import cut, spread

#: Times that two words must be left over together, and how strongly, to render each other.
MIN_COUNT, MIN_DICE, MIN_SHARE = 3, 0.12, 0.5
#: Entries up to which the lexicon is broadcast.
LEXICON_ROWS = 400_000
#: Weight of a rare word, and the share of all words from which a word weighs less.
RARE, FREQUENT = 2.2, 6e-6
#: Least score of a link inside a gap, of one out of order, of an anchor, and of a second clause that joins a link.
IN_GAP, MOVED, ANCHOR, SECOND = 0.30, 0.42, 0.50, 0.62
#: The same before a lexicon is trained, and the least score of a link that it is trained on; score of a pair that shares a word found once on either side.
FIRST_IN_GAP, FIRST_MOVED, FIRST_ANCHOR, FIRM, UNIQUE = 0.25, 0.30, 0.22, 0.16, 0.32
#: Pairs of clauses that one word may make outside a gap; pairs of clauses without link up to which they count in full in training, beyond that as so large a share of their pairs.
COMMON, NEAR = 400, 9
#: Parts of one count in training; pairs of words of clauses without link up to which a task counts them itself.
UNIT, BAG_PAIRS = 1_000_000_000, 100_000

# Number words of both languages.
NUMBER_WORDS = {
    "un": "1", "une": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "six": "6", "sept": "7", "huit": "8", "neuf": "9", "dix": "10", "onze": "11", "douze": "12",
    "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12",
}
# Words that carry no content, of either language.
EMPTY = frozenset(
    "le la les l de des du d un une et en est sont a au aux par sur dans qui se on y elle il ses sa son ce cette ne n pas que qu nous "
    "the of and in is are an to by on at it its with for from this that was has as or be which who not".split()
)
CLAUSE = re.compile(r"\s*;\s*|,\s+(?:and|et)\s+|(?<=[^\W\d_]{2}|\d\d|.\)|.%|.\")[.!?]\s+(?=[A-ZÀ-Þ«\"\d(])")
TOKEN = re.compile(r"\d+|[^\W\d_]+(?:-[^\W\d_]+)*")

#: A clause: number of its line, its different words, its figures.
Clause = tuple[int, tuple[str, ...], frozenset[str]]
_folded: dict[str, str] = {}


def fold(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(ch))


def word(token: str) -> str:
    """A token as it is compared, empty for one without content."""
    low = fold(token)
    low = NUMBER_WORDS.get(low, low)
    if low.isdigit():
        low = low.lstrip("0") or "0"
    low = "" if low in EMPTY else low
    if len(_folded) > 300_000:
        _folded.clear()
    _folded[token] = low
    return low


def clauses(text: str) -> list[Clause]:
    """The clauses of the lines that may be paired."""
    out = []
    known = _folded.get
    for no, line in enumerate(text.split("\n"), 1):
        bare = line.strip()
        if not bare or bare[0] == "#":
            continue
        for clause in CLAUSE.split(bare):
            ws: dict[str, None] = {}
            figures = []
            for t in TOKEN.findall(clause):
                w = known(t)
                if w is None:
                    w = word(t)
                if w:
                    ws[w] = None
                    if "0" <= t[0] <= "9":
                        figures.append(w)
            if ws:
                out.append((no, tuple(ws), frozenset(figures)))
    return out


def cognate(a: str, b: str) -> float:
    """How alike two words of different languages look, from 0 to 1."""
    if a == b:
        return 1.0
    if a[0] != b[0] or min(len(a), len(b)) < 4 or a.isdigit() or b.isdigit():
        return 0.0
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    most = max(len(a), len(b))
    return min(1.0, n / most * 1.2) if n >= 4 or n >= 0.6 * most else 0.0


class Scorer:
    """Scores clause pairs by what they share: equal words, cognates and, once trained, renderings."""

    def __init__(self, lexicon: dict[str, list[tuple[str, float]]] | None = None, share: dict[str, float] | None = None) -> None:
        self.partners = lexicon or {}
        self.trained = lexicon is not None
        self.weights = {w: min(RARE, max(0.25, log(0.2 / s) / 4)) for w, s in (share or {}).items()}
        self.cognates: dict[tuple[str, str], float] = {}

    def alike(self, a: str, b: str) -> float:
        key = (a, b)
        s = self.cognates.get(key)
        if s is None:
            if len(self.cognates) > 500_000:
                self.cognates.clear()
            s = self.cognates[key] = cognate(a, b)
        return s

    def offers(self, fp: dict[str, list[int]], ep: dict[str, list[int]]) -> list[tuple[str, str, float]]:
        """(f, e, how well one renders the other) of the words of two sides."""
        heads: dict[str, list[str]] = defaultdict(list)
        for e in ep:
            heads[e[:3]].append(e)
        out = []
        for f in fp:
            best: dict[str, float] = {}
            for e, s in self.partners.get(f, ()):
                if e in ep:
                    best[e] = s
            for e in heads.get(f[:3], ()):
                s = self.alike(f, e)
                if s and s > best.get(e, 0.0):
                    best[e] = s
            out += [(f, e, s) for e, s in best.items()]
        return out

    def scores(self, fr: list[Clause], en: list[Clause], common: int | None = COMMON) -> tuple[dict[tuple[int, int], float], bool]:
        """The score of each pair of clauses that shares a word, and whether no word was left aside as too common."""
        fp: dict[str, list[int]] = {}
        ep: dict[str, list[int]] = {}
        for i, c in enumerate(fr):
            for w in c[1]:
                fp.setdefault(w, []).append(i)
        for j, c in enumerate(en):
            for w in c[1]:
                ep.setdefault(w, []).append(j)
        weight = self.weights.get
        # a word that many clauses of the document hold tells them apart less
        wf = {w: weight(w, RARE) / len(at) ** 0.5 for w, at in fp.items()}
        we = {w: weight(w, RARE) / len(at) ** 0.5 for w, at in ep.items()}
        best_f: dict[str, dict[int, float]] = {}
        best_e: dict[str, dict[int, float]] = {}
        whole = True
        for f, e, s in self.offers(fp, ep):
            i_at, j_at = fp[f], ep[e]
            if common is not None and len(i_at) * len(j_at) > common:
                whole = False
                continue
            to = best_f.setdefault(f, {})
            for j in j_at:
                if s > to.get(j, 0.0):
                    to[j] = s
            to = best_e.setdefault(e, {})
            for i in i_at:
                if s > to.get(i, 0.0):
                    to[i] = s
        a: dict[tuple[int, int], float] = defaultdict(float)
        b: dict[tuple[int, int], float] = defaultdict(float)
        for f, to in best_f.items():
            w = wf[f]
            for j, s in to.items():
                for i in fp[f]:
                    a[i, j] += w * s
        for e, to in best_e.items():
            w = we[e]
            for i, s in to.items():
                for j in ep[e]:
                    b[i, j] += w * s
        sum_f = [sum(map(wf.__getitem__, c[1])) for c in fr]
        sum_e = [sum(map(we.__getitem__, c[1])) for c in en]
        out = {}
        for (i, j), x in a.items():
            x /= sum_f[i]
            y = b.get((i, j), 0.0) / sum_e[j]
            size = min(len(fr[i][1]), len(en[j][1]), 3) / 3
            m = 0.3 * (x + y) + 0.4 * size * (x if x > y else y)
            p, q = fr[i][2], en[j][2]
            if p or q:  # figures that differ, or that only one side has, speak against a pair
                m *= (1.0 if p & q else 0.55) if p and q else 0.8
            out[i, j] = m
        if not self.trained:  # before anything is learned, one word that stands once on either side is an anchor by itself
            for f, at in fp.items():
                if len(at) == 1 and len(f) > 2 and len(ep.get(f, ())) == 1:
                    key = (at[0], ep[f][0])
                    out[key] = max(out.get(key, 0.0), UNIQUE)
        return out, whole


def chain(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """The increasing subsequence of pairs (i, j, weight) of the greatest total weight, in O(n log n)."""
    if len(pairs) < 2:
        return [p[:2] for p in pairs]
    pairs = sorted(pairs, key=lambda p: (p[0], -p[1]))
    # a staircase: places j ascending with the greatest total of a chain that ends there or before
    ends: list[int] = []
    totals: list[tuple[float, int]] = []
    back = []
    for k, (_, j, w) in enumerate(pairs):
        at = bisect_left(ends, j)
        total, before = totals[at - 1] if at else (0.0, -1)
        total += w
        back.append(before)
        if at < len(ends) and ends[at] == j and totals[at][0] >= total:
            continue
        stop = at
        while stop < len(ends) and totals[stop][0] <= total:
            stop += 1
        ends[at:stop] = [j]
        totals[at:stop] = [(total, k)]
    k = max(totals)[1] if totals else -1
    out = []
    while k >= 0:
        out.append(pairs[k][:2])
        k = back[k]
    return out[::-1]


def placed(m: dict[tuple[int, int], float], fr: list[Clause], en: list[Clause]) -> dict[tuple[int, int], float]:
    """Scores with regard to place: pairs near the diagonal, and pairs of lines that hold a good pair, before others."""
    n, k = len(fr), len(en)
    line: dict[tuple[int, int], float] = {}
    for (i, j), x in m.items():
        key = (fr[i][0], en[j][0])
        if x > line.get(key, 0.0):
            line[key] = x
    return {(i, j): x - 0.06 * abs(i / n - j / k) + (0.12 * line[fr[i][0], en[j][0]] if x > 0.2 else 0.0) for (i, j), x in m.items()}


def align(fr: list[Clause], en: list[Clause], scorer: Scorer, anchor: float = ANCHOR, in_gap: float = IN_GAP, moved: float = MOVED) -> tuple[list[tuple[int, int]], dict[tuple[int, int], float]]:
    """Links between clauses, and the scores of pairs."""
    if not fr or not en:
        return [], {}
    m, whole = scorer.scores(fr, en)
    s = placed(m, fr, en)
    top_i: dict[int, tuple[float, int]] = {}
    top_j: dict[int, tuple[float, int]] = {}
    for (i, j), x in s.items():
        if i not in top_i or x > top_i[i][0]:
            top_i[i] = (x, j)
        if j not in top_j or x > top_j[j][0]:
            top_j[j] = (x, i)
    links = chain([(i, j, x) for i, (x, j) in top_i.items() if top_j[j][1] == i and m[i, j] >= anchor])
    edges = [(-1, -1), *links, (len(fr), len(en))]
    if whole:
        by_gap: dict[int, list[tuple[int, int, float]]] = {}
        starts_i, starts_j = [e[0] for e in edges], [e[1] for e in edges]
        for (i, j), x in s.items():
            if x > in_gap:
                g = bisect_left(starts_i, i)
                if starts_i[g] != i and starts_j[g - 1] < j < starts_j[g]:
                    by_gap.setdefault(g, []).append((i, j, x - in_gap))
        for some in by_gap.values():
            links = links + chain(some)
    else:
        for (i0, j0), (i1, j1) in zip(edges, edges[1:]):
            if i1 - i0 > 1 and j1 - j0 > 1:
                own, _ = scorer.scores(fr[i0 + 1 : i1], en[j0 + 1 : j1], None)
                inner = placed(own, fr[i0 + 1 : i1], en[j0 + 1 : j1])
                links = links + [(i0 + 1 + i, j0 + 1 + j) for i, j in chain([(i, j, x - in_gap) for (i, j), x in inner.items() if x > in_gap])]
                for (i, j), x in inner.items():
                    at = (i0 + 1 + i, j0 + 1 + j)
                    s[at], m[at] = max(x, s.get(at, 0.0)), max(own[i, j], m.get(at, 0.0))
    # a gap link that both ends could better make elsewhere gives way to one out of order
    strength = {p: s[p] for p in links}
    by_i, by_j = {i: (i, j) for i, j in links}, {j: (i, j) for i, j in links}
    free = sorted(((s[p], *p) for p, x in m.items() if x >= moved and not (p[0] in by_i and p[1] in by_j)), reverse=True)
    for v, i, j in free:
        a, b = by_i.get(i), by_j.get(j)
        if (a is None or strength[a] + 0.15 < v) and (b is None or strength[b] + 0.15 < v):
            for x in (a, b):
                if x is not None and x in strength:
                    del strength[x]
                    by_i.pop(x[0], None)
                    by_j.pop(x[1], None)
            strength[i, j] = v
            by_i[i] = by_j[j] = (i, j)
    return sorted(strength), m


def lines_of(fr: list[Clause], en: list[Clause], links: list[tuple[int, int]], m: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """The pairs of lines of links; a clause without a link joins the link of its neighbour where it renders the same clause well."""
    li, lj = dict(links), {j: i for i, j in links}
    more = []
    for i, j in links:
        for d in (-1, 1):
            if i + d not in li and m.get((i + d, j), 0.0) >= SECOND:
                more.append((i + d, j))
            if j + d not in lj and m.get((i, j + d), 0.0) >= SECOND:
                more.append((i, j + d))
    return sorted({(fr[i][0], en[j][0]) for i, j in [*links, *more]})


def left_over(fr: list[Clause], en: list[Clause], links: list[tuple[int, int]]) -> list[tuple[list[int], list[int]]]:
    """Clauses without a link that probably render one another, for training: all of a pair if they are few, else those of each gap and of linked lines, however many."""
    li, lj = {i for i, _ in links}, {j for _, j in links}
    free_i, free_j = [i for i in range(len(fr)) if i not in li], [j for j in range(len(en)) if j not in lj]
    if len(free_i) * len(free_j) <= NEAR:
        return [(free_i, free_j)] if free_i and free_j else []
    places: dict[object, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
    ends_i, ends_j = zip(*chain([(i, j, 1.0) for i, j in links])) if links else ((), ())
    for side, free, ends in ((0, free_i, ends_i), (1, free_j, ends_j)):
        for x in free:
            places[bisect_left(ends, x)][side].append(x)
    lines = {(fr[i][0], en[j][0]) for i, j in links}
    by_f, by_e = defaultdict(list), defaultdict(list)
    for i in free_i:
        by_f[fr[i][0]].append(i)
    for j in free_j:
        by_e[en[j][0]].append(j)
    bags = [*places.values(), *((by_f[f], by_e[e]) for f, e in lines if f in by_f and e in by_e)]
    return [(i, j) for i, j in bags if i and j]


def count_batches(batches: Iterator[pd.DataFrame], bag_pairs: int = BAG_PAIRS) -> Iterator[pd.DataFrame]:
    """(kind, f, e, n): w words of either language; of the clauses linked by anchors or left over, F and E the words that nothing explains, p their pairs, in parts of UNIT.

    The pairs of clauses whose words make more than bag_pairs are not counted here: B has the words of either side.
    """
    scorer = Scorer()
    seen: dict[str, Counter] = {k: Counter() for k in "wFEp"}
    parts: dict[str, Counter] = {k: Counter() for k in "FEpB"}
    for pdf in batches:
        for text, text_en in zip(pdf["text"], pdf["text_en"]):
            fr, en = clauses(text), clauses(text_en)
            for c in (*fr, *en):
                seen["w"].update(c[1])
            links, m = align(fr, en, scorer, FIRST_ANCHOR, FIRST_IN_GAP, FIRST_MOVED)
            firm = [p for p in links if m[p] >= FIRM]
            for at_f, at_e in [([i], [j]) for i, j in firm] + left_over(fr, en, links):
                ws = dict.fromkeys(w for i in at_f for w in fr[i][1])
                vs = dict.fromkeys(w for j in at_e for w in en[j][1])
                e_heads: dict[str, list[str]] = {}
                for v in vs:
                    e_heads.setdefault(v[:3], []).append(v)
                shown = set()
                f = []
                for w in ws:
                    hit = [v for v in e_heads.get(w[:3], ()) if scorer.alike(w, v)]
                    if hit:
                        shown.update(hit)
                    else:
                        f.append(w)
                e = [v for v in vs if v not in shown]
                n = len(at_f) * len(at_e)
                here = len(f) * len(e) <= bag_pairs
                if n <= NEAR and here:
                    seen["F"].update(f)
                    seen["E"].update(e)
                    seen["p"].update((x, y) for x in f for y in e)
                else:
                    part = max(1, UNIT * NEAR // max(n, NEAR))
                    for x in f:
                        parts["F"][x] += part
                    for y in e:
                        parts["E"][y] += part
                    if here:
                        for key in ((x, y) for x in f for y in e):
                            parts["p"][key] += part
                    else:
                        parts["B"]["\n".join(f), "\n".join(e)] += part
                if sum(map(len, seen.values())) + sum(map(len, parts.values())) > 500_000:
                    yield from _frames(seen, UNIT)
                    yield from _frames(parts, 1)
    yield from _frames(seen, UNIT)
    yield from _frames(parts, 1)


def _frames(seen: dict[str, Counter], unit: int) -> Iterator[pd.DataFrame]:
    for kind, counts in seen.items():
        if not counts:
            continue
        keys = list(counts)
        pairs = kind in "pB"
        times = 1 if kind == "w" else unit
        yield pd.DataFrame({"kind": kind, "f": [k[0] for k in keys] if pairs else keys, "e": [k[1] for k in keys] if pairs else "", "n": [n * times for n in counts.values()]})
        counts.clear()


def train(pairs: DataFrame, bag_pairs: int = BAG_PAIRS) -> tuple[DataFrame, dict[str, float]]:
    """The lexicon (f, e, score) of all document pairs as linked by anchors, and the shares of frequent words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from count_batches(batches, bag_pairs)

    every = pairs.select("text", "text_en").mapInPandas(run, "kind string, f string, e string, n long").groupBy("kind", "f", "e").agg(F.sum("n").alias("n"))
    counts = cut(every.filter(F.col("n") >= F.when(F.col("kind") == "w", MIN_COUNT).when(F.col("kind") == "B", 1).otherwise(MIN_COUNT * UNIT)))
    nf = counts.filter("kind = 'F'").select("f", (F.col("n") / UNIT).alias("nf"))
    ne = counts.filter("kind = 'E'").select(F.col("f").alias("e"), (F.col("n") / UNIT).alias("ne"))
    both = counts.filter("kind = 'p'").select("f", "e", "n")
    bags = counts.filter("kind = 'B'").select(F.monotonically_increasing_id().alias("bag"), "f", "e", "n")
    if not bags.isEmpty():
        # a pair counts no more often than either of its words, so words that do not count often enough make none
        fs = bags.select("bag", "n", F.explode(F.split("f", "\n")).alias("f")).join(nf.select("f"), "f")
        es = bags.select("bag", F.explode(F.split("e", "\n")).alias("e")).join(ne.select("e"), "e")
        more = fs.join(es, "bag").groupBy("f", "e").agg(F.sum("n").alias("n"))
        both = every.filter("kind = 'p'").select("f", "e", "n").unionByName(more.select("f", "e", "n")).groupBy("f", "e").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT * UNIT)
    both = both.withColumn("n", F.col("n") / UNIT).join(nf, "f").join(ne, "e")
    dice = 2 * F.col("n") / (F.col("nf") + F.col("ne"))
    lexicon = both.filter((dice >= MIN_DICE) | (F.col("n") / F.least("nf", "ne") >= MIN_SHARE)).select("f", "e", F.when(dice >= 0.2, F.least(F.lit(1.0), 0.35 + dice)).otherwise(0.3).alias("score"))
    words = counts.filter("kind = 'w'")
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= FREQUENT * total).select("f", "n").collect()  # at most 1 / FREQUENT words, whatever the input
    return lexicon, {r.f: 5 * r.n / total for r in frequent}


ALIGNED = "pair_id long, fr_line int, en_line int"


def _read(rows: Iterator[tuple], scorer: Scorer) -> pd.DataFrame:
    out = []
    for pid, text, text_en in rows:
        fr, en = clauses(text), clauses(text_en)
        links, m = align(fr, en, scorer)
        out += [(pid, f, e) for f, e in lines_of(fr, en, links, m)]
    return pd.DataFrame(out, columns=["pair_id", "fr_line", "en_line"])


def aligned(pairs: DataFrame, lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """(pair_id, fr_line, en_line) of document pairs (pair_id, text, text_en)."""
    pairs = pairs.filter("pair_id is not null and text is not null and text_en is not null").select(F.col("pair_id").cast("long").alias("pair_id"), "text", "text_en")
    pairs = spread(pairs, "pair_id")
    lexicon, share = train(pairs)
    lexicon = cut(lexicon)
    spark = pairs.sparkSession
    if lexicon.limit(lexicon_rows + 1).count() <= lexicon_rows:
        table = defaultdict(list)
        for r in lexicon.collect():
            table[r.f].append((r.e, r.score))
        known = spark.sparkContext.broadcast((dict(table), share))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = Scorer(*known.value)
            for pdf in batches:
                yield _read(zip(pdf["pair_id"], pdf["text"], pdf["text_en"]), scorer)

        return pairs.mapInPandas(run, ALIGNED).distinct()
    return joined(pairs, lexicon, share).distinct()


def joined(pairs: DataFrame, lexicon: DataFrame, share: dict[str, float]) -> DataFrame:
    """As aligned, by a lexicon too large to broadcast: each document pair gets the entries whose words it holds on both sides."""
    pairs = cut(pairs.withColumn("row", F.monotonically_increasing_id()))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r, w, side) for r, *texts in zip(pdf["row"], pdf["text"], pdf["text_en"]) for side, t in zip("fe", texts) for w in {w for c in clauses(t) for w in c[1]}]
            yield pd.DataFrame(rows, columns=["row", "w", "side"])

    held = pairs.mapInPandas(words, "row long, w string, side string")
    fs, es = held.filter("side = 'f'").select("row", F.col("w").alias("f")), held.filter("side = 'e'").select("row", F.col("w").alias("e"))
    own = fs.join(lexicon, "f").join(es, ["row", "e"]).groupBy("row").agg(F.collect_list(F.struct("f", "e", "score")).alias("entries"))
    known = pairs.sparkSession.sparkContext.broadcast(share)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for pid, text, text_en, entries in zip(pdf["pair_id"], pdf["text"], pdf["text_en"], pdf["entries"]):
                table = defaultdict(list)
                for x in entries if entries is not None else ():
                    table[x["f"]].append((x["e"], x["score"]))
                yield _read([(pid, text, text_en)], Scorer(dict(table), known.value))

    return pairs.join(own, "row", "left").select("pair_id", "text", "text_en", "entries").mapInPandas(run, ALIGNED)
