"""Problem 4: variant spellings of names typed by people.

Method: an index of symmetric deletions over the distinct name tokens finds the
tokens a small edit away (two tokens meet where deleting a character from one
or both gives the same string); names are compared token by token under the
cheapest assignment, which permits initials, abbreviations and nicknames.

Everything is done over distinct spellings, so copies cost nothing; a deletion
key of length n is shared by at most about 30 (n + 1) tokens, which bounds the
pairs that one key can give whatever the size of the input.

Species: entity = genus and epithet.  Collectors: entity = surname with its
particle and a given name, or the kind of institution and its place.  Null or
empty names give no rows, nor do captions without a credit; repeated rows with
one id count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.operators.lineage import WAVES, cut

#: Letters from which a pair of near tokens stands for itself; a shorter pair needs one of at most this share of the other's copies.
LONG, RARE_SHORT = 5, 0.2
#: Ids of one entity in a block when its pairs are listed.
BLOCK = 2000

# Given names with their usual short forms.
SHORT_FORMS = {
    "alexandre": "alex sandro sacha", "bernadette": "berna dedette", "catherine": "cathy kate cath katia", "dominique": "domi mino",
    "elisabeth": "babeth lise lisbeth elise beth", "frederic": "fred fredo freddy", "georges": "geo jojo", "hendrik": "henk rik hendrick",
    "ignace": "iggy nacio", "joseph": "jo jojo jef joe", "marguerite": "magui margot maggie", "nicolas": "nico colas nick", "philippe": "phil filou",
    "robert": "bob rob robby", "suzanne": "suzy suzon suzette", "theodore": "theo doro ted", "ursule": "ursa sula", "veronique": "vero nikki",
    "william": "bill will willy", "zacharie": "zac zach", "antoine": "tony toine", "francois": "fanfan", "henri": "riri", "jacques": "jacquot jack",
    "louis": "loulou", "michel": "michou mick", "charles": "charlot charlie", "edouard": "ed doudou", "eugene": "gene",
}
# Particles of surnames, titles before names, words of institutions with their kind.
PARTICLES = frozenset("de van le la du des der den von di da ten".split())
TITLES = frozenset("dr mme mlle abbe mission prof pere frere soeur capt cdt m".split())
INSTITUTIONS = {"institut": "ir", "inst": "ir", "station": "sf", "stat": "sf", "jardin": "je", "jard": "je", "miss": "mb"}
INSTITUTION_WORDS = frozenset("institut inst recherches rech mission miss botanique bot station stat forestiere forest jardin jard dessais essais ess d".split())
# Adjective endings of epithets by gender, each with the one that stands for all.
GENDERS = (("ianum", "iana"), ("ianus", "iana"), ("atum", "ata"), ("atus", "ata"), ("osum", "osa"), ("osus", "osa"), ("iflorum", "iflora"), ("iflorus", "iflora"), ("ifolium", "ifolia"), ("ifolius", "ifolia"), ("ense", "ensis"), ("anum", "ana"), ("anus", "ana"))
# The ways in which a legend credits a collector.
CREDITS = (
    re.compile(r"Réc\.\s*:\s*([^:;()×]{2,}?),\s*n°\s*\d+"),
    re.compile(r"\(d[’']après\s+([^:;()×]{2,}?),?\s+(?:n°\s*)?\d+\s*\)"),
    re.compile(r"—\s*\d+-\d+,\s*([^:;()×]{2,}?)\s+(?:n°\s*)?\d+\s*\."),
    re.compile(r"\(([^:;()×]{2,}?),?\s*(?:n°\s*)?\d+\s*\)\s*:"),
)


def fold(text: str) -> str:
    """Lower case without accents."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(ch))


def edits(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two strings; most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def deletions(token: str, depth: int) -> set[str]:
    """A token and what is left of it without up to so many characters."""
    kept = {token}
    level = {token}
    for _ in range(depth):
        level = {t[:i] + t[i + 1 :] for t in level for i in range(len(t))}
        kept |= level
    return kept


def near_tokens(tokens: DataFrame, long_from: int = 10, short_from: int = 3) -> DataFrame:
    """(a, b, dist), a < b, of the distinct tokens (column token) a small edit apart.

    One edit for tokens of short_from letters on, two where both have long_from.
    Pairs of tokens under LONG letters say little by themselves; who uses them
    must know more (see told_apart, and the use of authors among epithets).
    """

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, t) for t in pdf["token"] if len(t) >= short_from for k in deletions(t, 2 if len(t) >= long_from else 1)]
            for at in range(0, max(len(rows), 1), 100_000):
                yield pd.DataFrame(rows[at : at + 100_000], columns=["k", "token"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for a, b in zip(pdf["a"], pdf["b"]):
                d = edits(a, b, 2)
                if d <= (2 if min(len(a), len(b)) >= long_from else 1):
                    rows.append((a, b, d))
            yield pd.DataFrame(rows, columns=["a", "b", "dist"])

    parts = WAVES * tokens.sparkSession.sparkContext.defaultParallelism
    # dealt out before they are multiplied, so that no task gets the index of all
    keys = tokens.select("token").filter("token is not null").repartition(parts, "token").distinct().mapInPandas(index, "k string, token string")
    pairs = keys.alias("x").join(keys.alias("y"), F.expr("x.k = y.k and x.token < y.token")).select(F.col("x.token").alias("a"), F.col("y.token").alias("b")).distinct()
    return pairs.mapInPandas(verify, "a string, b string, dist int")


def told_apart(near: DataFrame, tokens: DataFrame) -> DataFrame:
    """Near tokens (a, b) of tokens (token, n) without short pairs of which none is rare beside the other."""
    n = lambda c: tokens.select(F.col("token").alias(c), F.col("n").alias(f"n_{c}"))
    sized = near.join(n("a"), "a").join(n("b"), "b")
    short = F.least(F.length("a"), F.length("b")) < LONG
    return sized.filter(~short | (F.least("n_a", "n_b") <= RARE_SHORT * F.greatest("n_a", "n_b")) & (F.substring("a", 1, 1) == F.substring("b", 1, 1))).select("a", "b", "dist")


def hubs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, hub): each node with the centre of the star it stands in.

    nodes: (node, n), n its copies; edges: (a, b).  A node hangs under the
    neighbour with most neighbours, then most copies, if that goes before it
    itself; a spelling thus falls to the form that its variants have in common.
    Pointers are doubled until none moves, so chains of any length reach their top.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = cut(both)
    degree = both.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("deg"))
    ranked = cut(nodes.join(degree, "node").select("node", F.struct("deg", "n", "node").alias("r")))
    best = both.join(ranked.select(F.col("node").alias("b"), F.col("r").alias("rb")), "b").groupBy(F.col("a").alias("node")).agg(F.max("rb").alias("rb"))
    up = cut(ranked.join(best, "node").select("node", F.when(F.col("rb") > F.col("r"), F.col("rb.node")).otherwise(F.col("node")).alias("hub")))
    while True:
        once = up.join(up.select(F.col("node").alias("hub"), F.col("hub").alias("h1")), "hub").select("node", "h1")
        twice = once.join(up.select(F.col("node").alias("h1"), F.col("hub").alias("h2")), "h1")
        up = cut(twice.select("node", F.col("h2").alias("hub"), (F.col("h1") != F.col("h2")).alias("moved")))
        moved = up.filter("moved").limit(1).count()
        up = up.select("node", "hub")
        if not moved:
            break
    return nodes.join(up, "node", "left").select("node", F.coalesce("hub", "node").alias("hub"))


def canonical(tokens: DataFrame, near: DataFrame) -> DataFrame:
    """(token, canon): each token (columns token, n) with the form it is a variant of."""
    return hubs(tokens.withColumnRenamed("token", "node"), told_apart(near, tokens)).select(F.col("node").alias("token"), F.col("hub").alias("canon"))


# --- species -----------------------------------------------------------------


def parse_species(name: str | None, genus: str | None) -> tuple[str, str, str] | None:
    """(genus as typed, epithet of one gender, '') of a latin name, or ('', '', word) of another single word."""
    text = fold(name or "").replace("_", " ")
    text = re.sub(r"(?<![a-z])(?:cf|aff|sp|nov)\.\s*", " ", text)
    swapped = re.match(r"^\s*([a-z-]{4,})\s*(?:,\s*([a-z]+\.?)|\(\s*([a-z]+\.?)\s*\))\s*$", text)
    words = re.findall(r"[a-z-]+\.?", text)
    if swapped:
        words = [swapped.group(2) or swapped.group(3), swapped.group(1)]
    if not words:
        return None
    if len(words) == 1:
        own, word = fold(genus or ""), words[0].rstrip(".")
        if own and len(word) > len(own) + 3 and edits(word[: len(own)], own, 1) <= 1:
            cuts = [c for c in (len(own), len(own) - 1, len(own) + 1) if word[:c] == own or edits(word[:c], own, 1) <= 1]
            return word[: cuts[0]], one_gender(word[cuts[0] :]), ""
        return "", "", word
    return words[0], one_gender(words[1].rstrip(".")), ""


def one_gender(epithet: str) -> str:
    for ending, stands in GENDERS:
        if epithet.endswith(ending) and len(epithet) > len(ending) + 2:
            return epithet[: -len(ending)] + stands
    return epithet


def _agree(a: str, b: str) -> Column:
    return F.col(a).isNull() | F.col(b).isNull() | (F.col(a) == F.col(b))


def species_entities(pages: DataFrame) -> DataFrame:
    """(id, ent) of pages (page_id, name, authority, genus, family, vernacular)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, name, auth, genus, fam, vern in zip(pdf["page_id"], pdf["name"], pdf["authority"], pdf["genus"], pdf["family"], pdf["vernacular"]):
                p = parse_species(name, genus)
                if p is None:
                    continue
                common = sorted({fold(v) for v in (vern if vern is not None else ()) if v})
                rows.append((i, p[0].rstrip(".") or None, p[0].endswith(".") or 0 < len(p[0]) < 3, p[1] or None, p[2] or None, fold(genus) if genus else None, fold(auth) if auth else None, fold(fam) if fam else None, common))
            yield pd.DataFrame(rows, columns=["id", "gtok", "abbr", "epi", "word", "gcol", "auth", "fam", "common"])

    cols = "id long, gtok string, abbr boolean, epi string, word string, gcol string, auth string, fam string, common array<string>"
    parsed = pages.filter("page_id is not null").select("page_id", "name", "authority", "genus", "family", "vernacular").mapInPandas(parse, cols)
    parsed = cut(parsed)
    typed = parsed.filter("gtok is not null and not abbr").select(F.col("gtok").alias("token")).unionAll(parsed.filter("gcol is not null").select(F.col("gcol").alias("token")))
    genera = cut(typed.groupBy("token").agg(F.count("*").alias("n")))
    canon = cut(canonical(genera, near_tokens(genera, long_from=99)))
    prefixes = F.transform(F.sequence(F.lit(4), F.length("word") - 4), lambda n: F.substring("word", F.lit(1), n))
    glued = (
        parsed.filter("word is not null and gcol is null and length(word) >= 9")
        .select("id", "word", F.explode(prefixes).alias("token"))
        .join(canon, "token")
        .groupBy("id")
        .agg(F.max_by(F.struct("token", "canon"), F.length("token")).alias("g"), F.first("word").alias("w"))
        .select("id", F.col("g.canon").alias("gglued"), F.expr("substring(w, length(g.token) + 1)").alias("eglued"))
    )
    one = F.col("eglued")
    for ending, stands in GENDERS:
        one = F.when(F.col("eglued").endswith(ending) & (F.length("eglued") > len(ending) + 2), F.concat(F.expr(f"left(eglued, length(eglued) - {len(ending)})"), F.lit(stands))).otherwise(one)
    glued = glued.withColumn("eglued", one)
    named = (
        parsed.join(canon.select(F.col("token").alias("gcol"), F.col("canon").alias("c1")), "gcol", "left")
        .join(canon.select(F.col("token").alias("gtok"), F.col("canon").alias("c2")), "gtok", "left")
        .join(glued, "id", "left")
        .select(
            "id", "auth", "fam", "common",
            F.coalesce("epi", "eglued").alias("epi"),
            F.when(F.col("eglued").isNull(), F.col("word")).alias("word"),
            F.coalesce("c1", "gglued", F.when(~F.col("abbr"), F.col("c2"))).alias("g"),
            F.when(F.col("c1").isNull() & F.col("abbr"), F.col("gtok")).alias("abbr"),
        )
    )
    named = cut(named)
    latin = named.filter("epi is not null").withColumn("node", F.when(F.col("g").isNotNull(), F.concat_ws("|", F.lit("g"), "g", "epi")).otherwise(F.concat_ws("|", F.lit("a"), F.coalesce("abbr", F.lit("")), F.coalesce("fam", F.lit("-")), F.coalesce("auth", F.lit("-")), "epi")))
    nodes = cut(latin.groupBy("node", "g", "epi").agg(F.first("abbr").alias("abbr"), F.max("fam").alias("fam"), F.max("auth").alias("auth"), F.count("*").alias("n")))
    pairs = cut(near_tokens(nodes.select(F.col("epi").alias("token"))))
    same = nodes.select(F.col("epi").alias("a"), F.col("epi").alias("b"), F.lit(0).alias("dist")).distinct()
    near = pairs.unionByName(same).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "dist"))
    x = nodes.select(*[F.col(c).alias(f"x_{c}") for c in nodes.columns])
    y = nodes.select(*[F.col(c).alias(f"y_{c}") for c in nodes.columns])
    both = x.join(near, x.x_epi == near.a).join(y, F.col("b") == F.col("y_epi")).filter("x_node <> y_node")
    tail = F.expr("right(x_epi, 3) = right(y_epi, 3)")
    both = cut(both)
    long = (F.col("dist") == 0) | (F.least(F.length("x_epi"), F.length("y_epi")) >= LONG) | (F.col("x_auth") == F.col("y_auth"))  # short epithets need the author
    both = both.filter(long)
    full = both.filter((F.col("x_g") == F.col("y_g")) & ((F.col("dist") <= 1) | tail))
    short = both.filter(F.col("x_g").isNull() & (F.col("dist") <= 1) & _agree("x_fam", "y_fam") & _agree("x_auth", "y_auth"))
    fits = F.when(F.col("y_g").isNotNull(), F.col("x_abbr").isNull() | F.expr("startswith(y_g, x_abbr)")).otherwise(F.col("x_abbr").eqNullSafe(F.col("y_abbr")))
    order = Window.partitionBy("x_node").orderBy(F.col("y_g").isNull(), "dist", F.desc("y_n"), "y_node")
    short = short.filter(fits).withColumn("r", F.row_number().over(order)).filter("r = 1")
    links = full.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).union(short.select("x_node", "y_node"))
    latin = cut(latin.join(hubs(nodes.select("node", "n"), links), "node").withColumnRenamed("hub", "ent"))
    offered = latin.select("ent", "g", "fam", "auth", F.explode("common").alias("word")).groupBy("ent", "word").agg(F.max("g").alias("og"), F.max("fam").alias("ofam"), F.max("auth").alias("oauth"), F.count("*").alias("n"))
    single = named.filter("epi is null and word is not null")
    best = Window.partitionBy("id").orderBy((F.col("og") == F.col("g")).desc_nulls_last(), (F.col("oauth") == F.col("auth")).desc_nulls_last(), F.desc("n"), "ent")
    matched = single.join(offered, "word").filter(_agree("g", "og") & _agree("fam", "ofam") & _agree("auth", "oauth")).withColumn("r", F.row_number().over(best)).filter("r = 1").select("id", F.col("ent").alias("vent"))
    alone = single.join(matched, "id", "left").select("id", F.coalesce("vent", F.concat_ws("|", F.lit("w"), "word", F.coalesce("g", F.lit("")))).alias("ent"))
    return latin.select("id", "ent").unionByName(alone).distinct()


# --- collectors --------------------------------------------------------------


def credit(caption: str | None) -> str | None:
    """The collector as a legend names them, or None."""
    if not caption:
        return None
    text = re.sub(r"(?<=\w)[-¬­]\s*\n\s*", "", caption.replace("­", ""))
    text = re.sub(r"\s+", " ", text)
    for pattern in CREDITS:
        m = None
        for m in pattern.finditer(text):
            pass
        if m and re.search(r"[^\W\d_]{2}", m.group(1)):
            return m.group(1).strip(" ,;")
    return None


def parse_collector(text: str) -> tuple[str, str, tuple[str, ...], str, bool]:
    """(particle, surname, given names and initials, kind of institution, surname abbreviated) of a credit."""
    text = re.sub(r"\b(de|van|Le|De|Van|le)(?=[A-ZÀ-Þ][a-zà-ÿ])", r"\1 ", text)
    text = re.sub(r"\.(?=\S)", ". ", text.replace("’", "'").replace("d'", "d "))
    left, _, right = fold(text).partition(",")
    last = left.split() if right else []
    first = right.split() if right else left.split()
    raw = [*first, *last]
    shouted = text.upper() == text

    def bare(token: str) -> str:
        return re.sub(r"[^a-z-]", "", token)

    plain = [bare(t) for t in raw]
    kind = ""
    if plain and (plain[0] in INSTITUTIONS or (plain[0] == "mission" and len(plain) > 1 and plain[1] in ("botanique", "bot"))):
        kind = INSTITUTIONS.get(plain[0], "mb")
        name = [t for t in plain if t and t not in INSTITUTION_WORDS and t not in PARTICLES]
        return "", name[-1] if name else plain[-1], (), kind, False
    titled = False
    while len(raw) > 1 and plain[0] in TITLES and not (plain[0] == "m" and raw[0] == "m."):
        raw, plain, titled = raw[1:], plain[1:], True
    if len(raw) > 2 and plain[:2] == ["r", "p"]:
        raw, plain, titled = raw[2:], plain[2:], True
    if not right and len(raw) > 1 and len(plain[-1]) == 1 and len(plain[0]) > 1:
        cut = len(raw)
        while cut > 1 and len(plain[cut - 1]) == 1:
            cut -= 1
        raw, plain = raw[cut:] + raw[:cut], plain[cut:] + plain[:cut]
    surname, abbreviated = plain[-1] if plain else "", bool(raw) and raw[-1].endswith(".") and len(plain[-1]) > 1 and not shouted
    rest = plain[:-1]
    particle = ""
    if rest and rest[-1] in PARTICLES:
        particle = rest[-1]
        rest = rest[:-1]
    return particle, surname, tuple(t for t in rest if t), "", abbreviated


NICKNAMES: dict[str, set[str]] = defaultdict(set)
for _full, _short in SHORT_FORMS.items():
    for _s in _short.split():
        NICKNAMES[_s].add(_full)


def initials(token: str) -> set[str]:
    """The letters that a given name, or what it may be short for, begins with."""
    return {token[0], *(f[0] for f in NICKNAMES.get(token, ()))}


def token_cost(a: str, b: str) -> float:
    """What it costs to take one name token for another; inf if they can't be one."""
    if a == b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        one, other = (a, b) if len(a) == 1 else (b, a)
        return 0.2 if other[0] == one or any(f[0] == one for f in NICKNAMES.get(other, ())) else float("inf")
    fa, fb = NICKNAMES.get(a, {a}) | {a}, NICKNAMES.get(b, {b}) | {b}
    if fa & fb:
        return 0.1
    if min(len(a), len(b)) >= 3 and (a.startswith(b) or b.startswith(a)):
        return 0.3
    return 0.5 if min(len(a), len(b)) >= 5 and edits(a, b, 1) <= 1 else float("inf")


def assignment(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """The least cost of giving each token of the shorter name its own token of the longer; inf if impossible."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.05
    cost = [[token_cost(x, y) for y in b] for x in a]
    cost[0] = [c + 0.01 * (j > 0) for j, c in enumerate(cost[0])]
    return least_assignment(cost)


def least_assignment(cost: list[list[float]]) -> float:
    """The least sum of one entry of each row, no two in a column (rows <= columns); inf where every choice meets an inf.

    Rows are added one by one, each along a shortest augmenting path over
    reduced costs, so the work is at most rows x rows x columns.
    """
    inf = float("inf")
    n, m = len(cost), len(cost[0])
    if n == 1:
        return min(cost[0])
    of_row, of_col = [0.0] * n, [0.0] * m
    owner: list[int | None] = [None] * m
    for first in range(n):
        reach, came, done = [inf] * m, [-1] * m, [False] * m
        row, base, last = first, 0.0, -1
        while True:
            for j in range(m):
                if not done[j] and base + cost[row][j] - of_row[row] - of_col[j] < reach[j]:
                    reach[j], came[j] = base + cost[row][j] - of_row[row] - of_col[j], last
            open_ = [j for j in range(m) if not done[j] and reach[j] < inf]
            if not open_:
                return inf
            last = min(open_, key=reach.__getitem__)
            base = reach[last]
            done[last] = True
            if owner[last] is None:
                break
            row = owner[last]
        of_row[first] += base
        for j in range(m):
            if done[j] and j != last:
                of_row[owner[j]] += base - reach[j]
                of_col[j] -= base - reach[j]
        while last >= 0:
            before = came[last]
            owner[last] = owner[before] if before >= 0 else first
            last = before
    return sum(cost[i][j] for j, i in enumerate(owner) if i is not None)


def resolve(forms: list[tuple[str, tuple[str, ...], str, int]]) -> dict[str, str]:
    """Of the spellings (credit, given, kind, n) under one surname, each with the entity it belongs to."""
    out: dict[str, str] = {}
    kinds = Counter()
    people: dict[str, list] = {}
    for text, given, kind, n in forms:
        if kind:
            out[text] = f"i:{kind}"
            kinds[kind] += n
    rest = [f for f in forms if not f[2]]

    def rank(f: tuple) -> tuple:
        given = f[1]
        full = bool(given) and len(given[0]) > 1
        return (not given, not full or given[0] in NICKNAMES, not full, -f[3], f[0])

    loose = []
    by_initial: dict[str, dict[str, None]] = defaultdict(dict)  # people by the initials that one of their names may have
    for text, given, _, n in sorted(rest, key=rank):
        if len(given) == 2 and "".join(given) in kinds:
            out[text] = f"i:{''.join(given)}"
            continue
        if not given:
            loose.append(text)
            continue
        near = dict.fromkeys(key for t in given for x in initials(t) for key in by_initial[x])
        best = min(((assignment(given, g), -people[key][1], key) for key in near for g in people[key][0]), default=None)
        if best and best[0] < float("inf"):
            key = best[2]
            people[key][1] += n
            if given not in people[key][0] and len(given[0]) > 1:
                people[key][0].append(given)
        else:
            key = f"p:{' '.join(given)}"
            people[key] = [[given], n]
        for t in given:
            for x in initials(t):
                by_initial[x][key] = None
        out[text] = key
    top = max(people.items(), key=lambda kv: (kv[1][1], kv[0]))[0] if people else None
    for text in loose:
        out[text] = top or (f"i:{kinds.most_common(1)[0][0]}" if kinds else "p:")
    return out


def collector_entities(figures: DataFrame) -> DataFrame:
    """(id, ent) of figures (fig_id, caption)."""

    def credits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, c) for i, t in zip(pdf["fig_id"], pdf["caption"]) if (c := credit(t))]
            yield pd.DataFrame(rows, columns=["id", "credit"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, n in zip(pdf["credit"], pdf["n"]):
                particle, surname, given, kind, short = parse_collector(text)
                if surname:
                    rows.append((text, n, f"{particle} {surname}".strip(), " ".join(given), kind, short, particle))
            yield pd.DataFrame(rows, columns=["credit", "n", "token", "given", "kind", "short", "particle"])

    named = figures.filter("fig_id is not null").select("fig_id", "caption").mapInPandas(credits, "id long, credit string").distinct()
    named = cut(named)
    forms = named.groupBy("credit").agg(F.count("*").alias("n")).mapInPandas(parse, "credit string, n long, token string, given string, kind string, short boolean, particle string")
    forms = cut(forms)
    whole = forms.filter(~F.col("short")).groupBy("token").agg(F.sum("n").alias("n"))
    whole = cut(whole)
    canon = cut(canonical(whole, near_tokens(whole, long_from=99)))
    # an abbreviated surname stands for the surname that begins so, of the same initial where several do
    givens = forms.filter(~F.col("short")).join(canon, "token").groupBy("canon", F.substring("given", 1, 1).alias("initial")).agg(F.sum("n").alias("m"))
    starts = canon.select("canon").distinct().select("canon", F.explode(F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.length("canon"))), lambda n: F.substring("canon", F.lit(1), n))).alias("token"))
    best = Window.partitionBy("credit").orderBy(F.desc(F.coalesce("m", F.lit(0))), "canon")
    short = (
        forms.filter("short")
        .withColumn("initial", F.substring("given", 1, 1))
        .join(starts, "token")
        .join(givens, ["canon", "initial"], "left")
        .withColumn("r", F.row_number().over(best))
        .filter("r = 1")
        .select("credit", "canon")
    )
    placed = forms.join(short, "credit", "left").withColumnRenamed("canon", "c1").join(canon, "token", "left").withColumn("canon", F.when(F.col("short"), F.coalesce("c1", "token")).otherwise(F.coalesce("canon", "token")))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, ways in zip(pdf["canon"], pdf["ways"]):
                merged = resolve([(f"{w['given']}\u0001{w['kind']}", tuple(w["given"].split()), w["kind"], int(w["n"])) for w in ways])
                rows += [(way, f"{name}|{e}", name) for way, e in merged.items()]
            yield pd.DataFrame(rows, columns=["way", "ent", "canon"])

    placed = cut(placed)
    # one entry per distinct (given, kind) under a surname: a group is as large as the ways to write given names
    spelt = placed.groupBy("canon", "given", "kind").agg(F.sum("n").alias("n"))
    grouped = spelt.groupBy("canon").agg(F.collect_list(F.struct("given", "kind", "n")).alias("ways"))
    decided = grouped.mapInPandas(decide, "way string, ent string, canon string")
    ents = placed.withColumn("way", F.concat_ws("\u0001", "given", "kind")).join(decided, ["canon", "way"]).select("credit", "ent")
    return named.join(ents, "credit").select("id", "ent")


def pairs_within(entities: DataFrame, kind: str) -> DataFrame:
    """(kind, id_a, id_b), id_a < id_b, of the ids of one entity, as the result is defined.

    An entity of many ids falls into blocks by a hash; each block meets each, so
    that no task lists all pairs of a large one.
    """
    blocks = entities.groupBy("ent").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sized = entities.select("ent", "id").join(blocks, "ent")
    a = sized.select("ent", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("p"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"))
    b = sized.select("ent", F.col("id").alias("id_b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("p"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("q"))
    return a.join(b, ["ent", "p", "q"]).filter("id_a < id_b").select(F.lit(kind).alias("kind"), "id_a", "id_b").distinct()


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of species pages and of captions that name the same species or collector."""
    pages = spark.read.parquet(f"{sf_dir}/wiki_species.parquet")
    figures = spark.read.parquet(f"{sf_dir}/figures.parquet")
    return pairs_within(species_entities(pages), "species").unionByName(pairs_within(collector_entities(figures), "collector"))
