"""Problem 1: noise in text from scanned pages.

Method: words are grouped by the skeleton that is left when confusable glyphs
are folded together; in each group the frequent forms are the ordinary words
and a rare form is a misreading of one that its neighbours support.  Digits of
lines at page edges are masked, so that running heads fall together whatever
page number they carry.  The repaired lines are reflowed by SQL windows.

Two passes: ``statistics`` counts words, word pairs and masked page-edge lines
over all records (each task adds up its own counts first), and ``detect`` reads
each record once more against those that stand MIN_COUNT times, however many
records there are.  They are broadcast: in a group of forms of one skeleton only
those count that are not rare beside the commonest, so more text adds names and
pairs but hardly ordinary words.  If there are more than LEXICON_ROWS entries,
nothing is broadcast: each record is joined with the entries that it asks for,
until it asks for none that it was not given, with the same result.

Null, empty or blank texts give no rows.  A repeated record gives its rows once.
"""

from __future__ import annotations

import itertools
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.operators.lineage import cut, spread

#: Times that a word or pair, a masked page-edge line, and a word of such lines must be counted; entries up to which they are broadcast.
MIN_COUNT, MIN_LINES, MIN_HEAD_WORDS, LEXICON_ROWS = 4, 2, 3, 2_000_000
#: Pages of one record at whose edge a line not in capitals must stand to be a running head.
OWN_HEADS = 3
#: Share of the letters of a head that must stand in words that recur in heads.
HEAD_SHARE = 0.4
#: Within a skeleton group, a form below this share of the commonest is a misreading.
VARIANT_SHARE = 0.06
#: An epithet makes up less than this share of all words.
NAME_SHARE = 3e-4

# Glyphs that recognisers confuse, each with the one that stands for its class.
CLASSES = {
    "0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "I": "i", "5": "s", "8": "b", "6": "b", "9": "q", "g": "q",
    "@": "a", "4": "a", "3": "e", "c": "e", "é": "e", "è": "e", "ê": "e", "ë": "e", "â": "a", "à": "a", "î": "i",
    "ï": "i", "ô": "o", "û": "u", "ù": "u", "ç": "e", "f": "t", "h": "b", "v": "u", "7": "t", "2": "z", "j": "i",
}
# Glyph sequences read for one glyph, or the reverse.
SEQUENCES = (("rn", "m"), ("nn", "m"), ("vv", "w"), ("ii", "u"), ("li", "u"), ("cl", "d"), ("iii", "m"), ("lll", "m"), ("ri", "n"))
# Single glyphs, each with what it may be read as.
SWAPS = (("e", "c"), ("c", "e"), ("f", "t"), ("t", "f"), ("g", "q"), ("q", "g"), ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"), ("o", "c"), ("c", "o"), ("n", "ii"), ("u", "ii"), ("ii", "n"), ("m", "rn"), ("rn", "m"), ("in", "m"), ("h", "li"), ("d", "cl"), ("ri", "n"), ("i", "l"), ("l", "i"), ("é", "e"), ("è", "e"), ("é", "6"), ("a", "o"), ("v", "y"))
# Figures, each with the letters it may be read for.
DRAWN = {"0": "o", "1": "li", "2": "z", "3": "e", "4": "a", "5": "s", "6": "éb", "7": "t", "8": "b", "9": "gq"}
# Characters that may show a broken word, and those never part of a word.
BREAKS = "\u00ad¬‐‑-"
BREAKS_OR_NONE = tuple(BREAKS)
FOREIGN = ";|_@~^*°•·.,:!`´'’\"\\/<>=+#§$%&{}¦¨"
# Elided French words.
ELIDED = frozenset("l d n s c j m t qu jusqu lorsqu puisqu quelqu".split())

FRAGMENT = re.compile(r"([^\s«»()\[\]\"“”]+)")
TRIM = " \t,.;:!?()[]{}«»\"“”'’…*_`|–—" + BREAKS
LOWER = re.compile(r"[a-zß-öø-ÿœæ]")
UPPER4 = re.compile(r"[A-ZÀ-ÖØ-ÞŒ0-9]{4,}")
MARKER = re.compile(r"^\s*<!--.*-->\s*$")
SENTENCE = re.compile(r"[.;:,]\s*$")
RULE = re.compile(r"^\s*(?:-{3,}|\*{3,}|_{3,})\s*$")
PLACEHOLDER = re.compile(r"^\s*\[?Figure \d+.*see figures\.md\]?\s*$")
NUMBER = r"(?:[0-9lIOo](?: ?[0-9lIOoSB])*|[ivxlc]+)"
DECORATED = re.compile(rf"^(?:[-–—]\s*{NUMBER}\s*[-–—]|[-–—]\s*{NUMBER}|{NUMBER}\s*[-–—]|\[\s*{NUMBER}\s*\]|p\.\s*{NUMBER})$")
BARE = re.compile(rf"^(?:[0-9lIOo](?: ?[0-9lIOoSB])*|[ivxlc]+)$")
FIGURE_LINE = re.compile(r"^\s*\d+(?:\.|['’]+\.?)?\s*$")
INITIALS = re.compile(r"^(?:[A-ZÀ-Þ]\.-?)+[A-ZÀ-Þ]?$")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_] ){2,}[^\W\d_](?!\w)")
PAGE_EDGE = re.compile(rf"^{NUMBER}\s+|\s+{NUMBER}$")
FIRST_WORD = re.compile(r"[^\W_]+(?:[;|_@'’.][^\W_]+)?")
HALF = re.compile(rf"([^\W_](?:[^\s{BREAKS}]*[^\W_])?) ?[{BREAKS}]$")
INLINE_BREAK = re.compile(rf"(?<![^\W\d_])([^\W\d_]++)(?: ?[{BREAKS}] +| [{BREAKS}] ?|[­¬]|[-‐‑])([^\W\d_]++)")


def skeleton(word: str) -> str:
    """What is left of a word when confusable glyphs are one and foreign characters are gone."""
    word = "".join(ch for ch in word.lower() if ch not in FOREIGN or ch in "|@!")
    for many, one in SEQUENCES:
        word = word.replace(many, one)
    return "".join(CLASSES.get(ch, ch) for ch in word if ch not in "!|") if not word.isdigit() else word


def masked(line: str) -> str:
    """A page-edge line without page number, markup and confusable glyphs."""
    bare = line.strip().lstrip("#").strip()
    for _ in range(2):
        bare = PAGE_EDGE.sub("", bare).strip()
    return skeleton(re.sub(r"\d", "9", bare.replace(" ", "")).lower().translate(str.maketrans("9", "o")))


def head_words(line: str) -> list[str]:
    """The skeletons of the longer words of a page-edge line, without a page number grown onto one; capitals C and G, E and F are one."""
    bare = (re.sub(r"\d+$|^\d+", "", w) for w in re.findall(r"[^\W_]{4,}", line))
    return ["".join(CLASSES.get(ch, ch) for ch in w.lower().replace("f", "e")).replace("q", "e").rstrip("s") for w in bare if len(w) > 3]


def is_capitals(line: str) -> bool:
    """Whether a line has the shape of a running head: capitals, apart from a page number."""
    bare = line.strip()
    if bare.startswith("#") and not re.match(r"^###+ ", bare):
        return False
    bare = bare.lstrip("#").strip()
    for _ in range(2):
        bare = PAGE_EDGE.sub("", bare).strip()
    letters = [ch for ch in bare if ch.isalpha()]
    low = sum(ch.islower() and ch not in "l" for ch in letters)
    return len(letters) >= 5 and low <= max(0, len(letters) // 12) and bool(UPPER4.search(bare)) and not bare.endswith((").", ";"))


def shape(line: str) -> str:
    """What a line is, as far as the line alone tells."""
    bare = line.strip()
    if not bare:
        return "blank"
    if bare[0] not in "<-*_[F":
        return "text"
    if MARKER.match(line) or RULE.match(line):
        return "mark"
    if PLACEHOLDER.match(line):
        return "figure"
    return "text"


class Heads:
    """The masked forms of page-edge lines that recur in a corpus, and the words that recur in such lines."""

    def __init__(self, lines: frozenset[str] = frozenset(), words: frozenset[str] = frozenset()) -> None:
        self.lines, self.words = lines, words

    def holds(self, line: str) -> bool:
        """Whether a line recurs as a whole, or so much of the length of its longer words is that of words that recur in heads."""
        if masked(line) in self.lines:
            return True
        ws = head_words(line)
        return sum(len(w) for w in ws if w in self.words) >= HEAD_SHARE * max(1, sum(map(len, ws))) if ws else False


def kinds(lines: list[str], heads: Heads | None) -> list[str]:
    """The kind of each line: blank, mark, figure, heading, header, pageno or body.

    heads: what recurs at page edges; None while it is being counted.  A page
    edge is a line that only blank lines, page numbers or other running heads
    part from a page marker or an end of the record.  A line in capitals at a
    page edge is a running head if it recurs in the corpus; any other one if its
    masked form stands at an edge of at least OWN_HEADS pages of the record, and
    of a third of all.
    """
    out = [shape(x) for x in lines]
    n = len(lines)
    recurring: frozenset[str] = frozenset()
    if heads is not None:
        pages = 1 + sum(MARKER.match(x) is not None for x in lines)
        if pages >= OWN_HEADS:
            edges = Counter(masked(x) for x in page_edges(lines, out) if not x.lstrip().startswith("#") and not SENTENCE.search(x))
            recurring = frozenset(m for m, k in edges.items() if k >= max(OWN_HEADS, pages / 3) and len(m) >= 8)

    def number(i: int) -> bool:
        bare = lines[i].strip().lstrip("#").strip()
        if DECORATED.match(bare):
            return True
        if not BARE.match(bare):
            return False
        near = [lines[j] for j in (i - 1, i + 1) if 0 <= j < n]
        return not any(FIGURE_LINE.match(x) and x.strip() for x in near)

    for step in (1, -1):
        at_edge = True
        for i in range(n) if step == 1 else range(n - 1, -1, -1):
            kind = out[i]
            if kind == "mark":
                at_edge = True
            elif kind == "blank" or not at_edge:
                continue
            elif kind == "text" and number(i):
                out[i] = "pageno"
            elif kind == "text" and (is_capitals(lines[i]) and (heads is None or heads.holds(lines[i])) or recurring and masked(lines[i]) in recurring):
                out[i] = "header"
            elif kind not in ("pageno", "header"):
                at_edge = False
    return ["heading" if k == "text" and x.lstrip().startswith("#") else "body" if k == "text" else k for k, x in zip(out, lines)]


def page_edges(lines: list[str], shapes: list[str]) -> list[str]:
    """The first and the last line of text of each page."""
    out = []
    page: list[int] = []
    for i, k in enumerate([*shapes, "mark"]):
        if k == "mark":
            out += [lines[x] for x in {*page[:1], *page[-1:]}]
            page = []
        elif k == "text":
            page.append(i)
    return out


def parts(word: str) -> list[str]:
    """A word without an elided one before it: l'ensemble gives ensemble."""
    head, _, tail = word.replace("’", "'").partition("'")
    return [tail] if tail and head.lower() in ELIDED else [word]


def last_word(text: str) -> str:
    """The last word of some text, or an empty one."""
    bare = text.rstrip().rpartition(" ")[2].strip(TRIM)
    return parts(bare)[0] if bare else ""


class Counts:
    """What is counted over records: neighbours within lines as they are written, and page-edge lines in capitals.

    Pieces between blanks are counted raw; what they are is told once for each
    different pair when the counts are given out.
    """

    def __init__(self) -> None:
        self.inner: Counter = Counter()  # (before, piece): the piece stands inside a line, so that it is no half of a broken word
        self.edge: Counter = Counter()  # (piece, last piece of a line)
        self.heads: Counter = Counter()

    def __len__(self) -> int:
        return len(self.inner) + len(self.edge)

    def add(self, src: str, text: str) -> None:
        lines = text.split("\n")
        for line, kind in zip(lines, kinds(lines, None)):
            if kind == "body":
                pieces = line.split()
                if len(pieces) > 3 and src == "text":
                    self.inner.update(zip(pieces, pieces[1:-1]))
                    self.edge[pieces[-2], pieces[-1]] += 1
                else:
                    self.inner.update(zip(["", *pieces], pieces))
            elif kind == "header":
                self.heads["h", masked(line)] += 1
                self.heads.update(("k", w) for w in set(head_words(line)))

    def told(self) -> Counter:
        """Counts by (kind, a, b): u words, n words after a capitalised word, b pairs, h masked lines and k words of heads."""
        out: Counter = Counter()
        known: dict[str, tuple[str, str, bool]] = {"": ("", "", False)}

        def tell(piece: str) -> tuple[str, str, bool]:
            """The word in a piece, the same without an elided one, and whether the piece ends a clause."""
            bare = piece.strip(TRIM)
            kept = known[piece] = (bare, parts(bare)[0] if bare else "", piece[-1] in ",;:.)")
            return kept

        for counts, inside in ((self.inner, True), (self.edge, False)):
            for (x, y), n in counts.items():
                a, b = known.get(x) or tell(x), known.get(y) or tell(y)
                w = b[1]
                if x and y in BREAKS and a[1] and a[1][0].islower():
                    out["u", a[1], ""] -= n  # half of a word, with a hyphen by itself behind it
                if inside and w and y[-1] not in BREAKS and x[-1:] not in BREAKS_OR_NONE:
                    first = w[0]
                    if first.islower():
                        out["n" if a[0][:1].isupper() and not a[2] else "u", w, ""] += n
                    elif first.isupper():
                        out["u", w, ""] += n
                if a[1] and w and a[1][0].isalpha() and w[0].isalpha():
                    out["b", a[1].lower(), w.lower()] += n
        for (kind, x), n in self.heads.items():
            out[kind, x, ""] += n
        return out


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = Counts()
    for pdf in batches:
        for src, text in zip(pdf["src"], pdf["text"]):
            seen.add(src, text)
            if len(seen) > 400_000:
                yield _frame(seen.told())
                seen = Counts()
    yield _frame(seen.told())


def _frame(seen: Counter) -> pd.DataFrame:
    return pd.DataFrame([(k, a, b, n) for (k, a, b), n in seen.items()], columns=["kind", "a", "b", "n"])


def usable(records: DataFrame) -> DataFrame:
    """Records (src, rec_id, text) that have a key and a text."""
    return records.select(F.coalesce("src", F.lit("text")).alias("src"), F.col("rec_id").cast("string").alias("rec_id"), "text").filter(F.col("rec_id").isNotNull() & (F.trim("text") != ""))


def statistics(records: DataFrame) -> DataFrame:
    """(kind, a, b, n): u words, n words after a capitalised word, b pairs, h masked page-edge lines."""
    counts = spread(usable(records), "src", "rec_id").select("src", "text").mapInPandas(_count_batches, "kind string, a string, b string, n long")
    return counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def near_forms(word: str) -> Iterator[str]:
    """What a word is without one character, or with one confusable glyph read otherwise."""
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
    for right, wrong in SWAPS:
        at = word.find(wrong)
        while at >= 0:
            yield word[:at] + right + word[at + len(wrong) :]
            at = word.find(wrong, at + 1)


def is_plain(word: str) -> bool:
    """Whether a word has the shape of an ordinary one."""
    return word[0].islower() and all(ch.isalpha() or ch == "-" for ch in word)


class Lexicon:
    """The frequent words by skeleton, the pairs that support them and the running heads."""

    def __init__(self, rows: list[tuple[str, str, str, int]]) -> None:
        uni: Counter = Counter()
        named: Counter = Counter()
        self.pairs = set()
        lines, head = set(), set()
        for kind, a, b, n in rows:
            if kind == "b":
                self.pairs.add((a, b))
            elif kind == "h":
                lines.add(a)
            elif kind == "k":
                head.add(a)
            elif kind == "n":
                named[a] += n
            else:
                uni[a] += n
        self.heads = Heads(frozenset(lines), frozenset(head))
        self.all = Counter({w: uni[w] + named[w] for w in {*uni, *named}})
        total = sum(self.all.values())
        groups: dict[str, list[str]] = {}
        self.ordinary = set()
        self.counts = self.all
        for w, n in self.all.items():
            if not is_plain(w) or self.is_name(w, n, named[w], total):
                continue
            groups.setdefault(skeleton(w), []).append(w)
        self.by_skeleton: dict[str, list[str]] = {}
        for key, forms in groups.items():
            most = max(self.all[w] for w in forms)
            kept = [w for w in forms if self.all[w] >= VARIANT_SHARE * most]
            self.by_skeleton[key] = sorted(kept, key=lambda w: (-self.all[w], w))
            self.ordinary.update(kept)
        top: dict[str, int] = {}
        for w, n in self.all.items():
            key = skeleton(w)
            top[key] = max(n, top.get(key, 0))

        def misread(w: str) -> bool:
            n = self.all[w]
            return n < VARIANT_SHARE * top[skeleton(w)] or any(self.all[v] > 50 * n for v in self.near(w.lower()) if len(v) > 3)

        self.names = {w for w in self.all if (w[0].isupper() or w in named and self.is_name(w, self.all[w], named[w], total)) and not misread(w)}
        rare = set()
        for w in self.ordinary:
            for v in self.near(w):
                if v != w and self.all[w] < 0.02 * self.all[v] and len(w) > 3 and self.all[v] > 60:
                    rare.add(w)
                    break
        self.ordinary -= rare
        self.cached: dict[str, tuple[tuple[str, bool], ...]] = {}
        self.clean: set[str] = set()

    @staticmethod
    def is_name(word: str, n: int, after_capital: int, total: int) -> bool:
        """A word that stands nearly always right behind a capitalised one is an epithet, unless it is too common to be one."""
        return after_capital > 0.8 * n and n < NAME_SHARE * total

    def is_clean(self, frag: str) -> bool:
        """Whether a piece between blanks can hold no defect, whatever stands beside it."""
        if frag in self.clean:
            return True
        word = frag.strip(TRIM)
        core = parts(word)[0] if word else ""
        if frag[-1] in BREAKS or (len(frag) == 1 and (frag.isalpha() or frag in BREAKS)) or "«" in frag:
            return False
        if not word or word.isdigit() or (not any(x in core for x in BREAKS) and (core in self.ordinary or core.lower() in self.ordinary or core in self.names and core.isalpha())):
            if len(self.clean) > 300_000:
                self.clean.clear()
            self.clean.add(frag)
            return True
        return False

    def near(self, word: str) -> Iterator[str]:
        """Ordinary words one foreign character or one confusable glyph away."""
        for form in near_forms(word):
            if form in self.ordinary:
                yield form

    def known(self, word: str) -> bool:
        return word in self.ordinary or word.lower() in self.ordinary

    def supported(self, before: str, word: str, after: str) -> bool:
        return (before.lower(), word) in self.pairs or (word, after.lower()) in self.pairs

    def candidates(self, word: str) -> tuple[tuple[str, bool], ...]:
        """Ordinary words that a word may misread, each with whether its neighbours must support it."""
        kept = self.cached.get(word)
        if kept is None:
            if len(self.cached) > 300_000:
                self.cached.clear()
            kept = self.cached[word] = tuple(dict.fromkeys(self._candidates(word)))
        return kept

    def _candidates(self, word: str) -> Iterator[tuple[str, bool]]:
        low = word.lower()
        if low in self.ordinary or not low or INITIALS.match(word):
            return
        letters = sum(ch.isalpha() for ch in low)
        odd = any(ch.isdigit() or ch in FOREIGN for ch in low)
        if letters < 2 or (len(low) <= 3 and not odd) or (word in self.names and not odd):
            return
        if odd:
            slots = [DRAWN.get(ch, ch) for ch in low]
            if sum(len(x) > 1 or ch.isdigit() for x, ch in zip(slots, low)) <= 4:
                yield from ((form, False) for form in map("".join, itertools.product(*slots)) if form != low and form in self.ordinary)
            for drawn in ("l", "i"):
                form = low.replace("|", drawn).replace("!", drawn)
                if form != low and form in self.ordinary:
                    yield form, False
            clean = "".join(ch for ch in low if ch not in FOREIGN)
            if clean in self.ordinary and len(clean) > 2 and clean != low and (len(clean) > 3 or word[0].islower()):
                yield clean, False
        for form in self.by_skeleton.get(skeleton(word), ()):
            if form != low and (odd or self.all[low] < VARIANT_SHARE * self.all[form]):
                yield form, not odd and len(form) <= 5
        if word[0].islower() or odd:
            for form in self.near(low):
                if len(form) > 3 and self.all[low] < VARIANT_SHARE * self.all[form]:
                    yield form, True

    def repair(self, word: str, before: str, after: str) -> str | None:
        """The ordinary word that a word misreads, or None if it is no misreading."""
        found = self.candidates(word)
        if not found:
            return None
        if before[:1].isupper() and word[0].islower() and word.isalpha() and not self.known(before):
            return None
        return next((form for form, must in found if not must or self.supported(before, form, after)), None)

    def split(self, a: str, b: str) -> bool:
        """Whether a blank parts a and b wrongly: together they are an ordinary word, apart they are not both."""
        both = (a + b).lower()
        return both in self.ordinary and len(both) > 4 and not (self.known(a) and self.known(b)) and a not in self.names

    def joins(self, a: str, b: str, shown: bool) -> bool:
        """Whether a and b are halves of one word, so that no hyphen belongs between them."""
        low, joined, tied = (a + b).lower(), a + b, f"{a}-{b}".lower()
        if b[:1].isupper() and a[-1:].islower():
            return False
        one = max(self.all[low], self.all[joined])
        two = max(self.all[tied], self.all[f"{a}-{b}"])
        if one or two:
            return one > two
        if (a.lower(), b.lower()) in self.pairs and self.known(b):
            return False
        if not shown:
            return False
        fixed = self.repair(low, "", "")
        return fixed is not None or not (self.known(a) and self.known(b))


class Part:
    """What one of the tables of a lexicon holds for a record, by (kind, a, b); what is asked besides is noted in missing and taken for absent."""

    def __init__(self, given: dict[tuple, dict | None], missing: list[tuple], kind: str, of: Callable[[dict], object]) -> None:
        self.given, self.missing, self.kind, self.of = given, missing, kind, of

    def get(self, key: str | tuple[str, str], absent: object = None) -> object:
        at = (self.kind, *key) if isinstance(key, tuple) else (self.kind, key, "")
        if at not in self.given:
            self.missing.append(at)
            return absent
        entry = self.given[at]
        return absent if entry is None else self.of(entry)

    def __contains__(self, key: str | tuple[str, str]) -> bool:
        return bool(self.get(key))

    def __getitem__(self, key: str) -> object:
        return self.get(key, 0)


class Asked(Lexicon):
    """The entries of a lexicon that were given to one record, and what it asks besides.

    A record that asks for nothing besides is read as by the whole lexicon.
    """

    def __init__(self, given: dict[tuple, dict | None]) -> None:
        self.given = given
        self.missing: list[tuple] = []

        def part(kind: str, of: Callable[[dict], object]) -> Part:
            return Part(given, self.missing, kind, of)

        self.all, self.ordinary, self.names = part("w", lambda x: x["n"]), part("w", lambda x: x["ordinary"]), part("w", lambda x: x["name"])
        self.by_skeleton = part("s", lambda x: [f["w"] for f in sorted(x["forms"], key=lambda f: (-f["n"], f["w"]))])
        self.pairs = part("b", lambda x: True)
        self.heads = Heads(part("h", lambda x: True), part("k", lambda x: True))
        self.cached, self.clean = {}, set()

    def is_clean(self, frag: str) -> bool:
        """As in a lexicon; a piece of which that is not known yet is let be, so that nothing is asked in vain."""
        before = len(self.missing)
        return super().is_clean(frag) or len(self.missing) > before


class Reading(Asked):
    """As Asked, for a record: what a word may misread is asked as a whole, so that it is looked for once for each different word."""

    def candidates(self, word: str) -> tuple[tuple[str, bool], ...]:
        return tuple((form, must) for form, must in Part(self.given, self.missing, "c", lambda x: x).get(word, ()))


def read(text: str, lex: Lexicon) -> list[tuple[int, str, str, set[str], bool]]:
    """Of each line: number, kind, repaired text, defects, and whether the next body line is to be joined without space."""
    lines = text.split("\n")
    ks = kinds(lines, lex.heads)
    body = [i for i, k in enumerate(ks) if k == "body"]
    following = {i: j for i, j in zip(body, body[1:])}
    fixed = list(lines)
    defects: list[set[str]] = [set() for _ in lines]
    close = [False] * len(lines)
    skip_first: set[int] = set()
    clean, breaking = lex.clean, set(BREAKS)
    for i, k in enumerate(ks):
        if k in ("header", "pageno"):
            defects[i].add(k)
    for i in body:
        line = fixed[i]
        bare = line.rstrip()
        j = following.get(i)
        nxt = lines[j].lstrip() if j is not None else ""
        last = bare[-1:]
        broken = HALF.search(bare, bare.rstrip(BREAKS + " ").rfind(" ") + 1) if last and last in BREAKS else None
        first = FIRST_WORD.match(nxt) if broken or last.isalpha() and nxt[:1].islower() else None
        end_half = ""
        if broken and first and broken.group(1)[-1].isalpha() and nxt[0].isalpha():
            a, b = broken.group(1).split("-")[-1], first.group()
            a = parts(a)[0]
            if lex.joins(a, b, True) and not (lex.known(b) and lex.all[(a + b).lower()] == 0 and lex.known(a)):
                defects[i].add("hyphen")
                close[i] = True
                skip_first.add(j)
                end_half = a + b
            elif b[0].isupper() or lex.all[f"{a}-{b}"] or lex.all[f"{a}-{b}".lower()]:
                close[i] = True  # the hyphen belongs to the word, the line end does not
        elif first and not broken:
            a = parts(re.split(r"[\s«(]", bare.rpartition(" ")[2])[-1].split("-")[-1])[0]
            b = first.group()
            if a and not (lex.known(a) and lex.known(b)) and (a + b).lower() in lex.ordinary and lex.all[(a + b).lower()] > 3 * lex.all.get(f"{a}-{b}".lower(), 0):
                if not lex.known(a) or (a.lower(), b.lower()) not in lex.pairs:
                    defects[i].add("hyphen")
                    close[i] = True
                    skip_first.add(j)
                    end_half = a + b

        def inline(m: re.Match) -> str:
            a, b = m.group(1), m.group(2)
            sep = m.group()[len(a) : len(m.group()) - len(b)]
            tight = sep in ("-", "‐", "‑")
            one, two = lex.all[(a + b).lower()], lex.all[f"{a}-{b}".lower()]
            if tight:
                yes = (a + b).lower() in lex.ordinary and one > 10 * two
            elif sep == "-" + " " * (len(sep) - 1) and len(sep) > 1 or sep.strip() == "-":
                yes = lex.joins(a, b, True) and ((a + b).lower() in lex.ordinary or not lex.known(b) and not (lex.known(a) and len(a) > 3))
            else:
                yes = lex.joins(a, b, True)
            if yes:
                defects[i].add("hyphen")
                return a + b
            return m.group()

        tail = broken.start() if broken else len(bare)
        split = line.split()
        if not end_half and (clean.issuperset(split) or all(map(lex.is_clean, split))):
            continue
        head = line[:tail] if end_half else line
        if not breaking.isdisjoint(head):
            once = INLINE_BREAK.sub(inline, head)
            head = INLINE_BREAK.sub(inline, once) if once != head else head

        def together(m: re.Match) -> str:
            joined = m.group().replace(" ", "")
            for start in range(0, 2):
                if joined[start:].lower() in lex.ordinary and len(joined) > 2:
                    defects[i].add("misread")
                    return m.group()[: 2 * start] + joined[start:]
            return m.group()

        single = list(map(len, split)).count(1)
        if single > 1 or single and "(" in line:
            head = SPACED.sub(together, head)
        pieces = FRAGMENT.split(head)  # gaps at even places, words with their punctuation at odd ones
        fresh = [t for t in range(1, len(pieces), 2) if pieces[t] not in clean]
        read_as = pieces[:] if fresh else pieces
        quoted = list(itertools.accumulate(g.count("«") - g.count("»") for g in pieces[::2])) if fresh and "«" in head else None
        for t in fresh:
            frag = pieces[t]
            if lex.is_clean(frag) or (t == 1 and i in skip_first):
                continue
            if quoted and quoted[t // 2] > 0:
                continue
            word = frag.strip(TRIM)
            if not word:
                continue
            core = parts(word)[0]
            before = last_word(pieces[t - 2]) if t > 1 else ""
            after = last_word(pieces[t + 2]) if t + 2 < len(pieces) else ""
            new = None
            if core == "-" or not core:
                pass
            elif after and pieces[t + 1] == " " and frag[-1:].isalpha() and core[0].islower() and lex.split(core, after):
                defects[i].add("misread")
            elif before and pieces[t - 1] == " " and frag[:1].isalpha() and before[0].islower() and lex.split(before, core):
                defects[i].add("misread")
            elif core[0].islower() or not core[0].isalpha() or t == 1 or (pieces[t - 2] + pieces[t - 1]).rstrip()[-1:] in (".", "", ":", ";"):
                new = lex.repair(core, before, after)
                if new is not None and core.count("-") == 1 and all(lex.known(x) for x in core.split("-")):
                    new = None
            if new is not None:
                defects[i].add("misread")
                new = new[0].upper() + new[1:] if core[0].isupper() else new
                read_as[t] = frag.replace(core, new, 1)
        rebuilt = "".join(read_as)
        if end_half:
            rest = line[tail:].rstrip()
            rebuilt += rest.rstrip(BREAKS + " ") if broken else rest
            low = end_half.lower()
            fix = None if low in lex.ordinary else lex.repair(end_half, last_word(head), "")
            if fix:
                half = parts(broken.group(1).split("-")[-1])[0] if broken else ""
                defects[i if not low.startswith(half.lower()) or fix[: len(half)] != half.lower() else j].add("misread")
        fixed[i] = rebuilt
    return [(i + 1, ks[i], fixed[i], defects[i], close[i]) for i in range(len(lines))]


def counted(records: DataFrame) -> DataFrame:
    """The entries of all records that were counted often enough: kind, a, b, n."""
    least = F.when(F.col("kind") == "h", MIN_LINES).when(F.col("kind") == "k", MIN_HEAD_WORDS).otherwise(MIN_COUNT)
    return cut(statistics(records).filter(F.col("n") >= least))


def lexicon(records: DataFrame) -> Lexicon:
    """The lexicon of all records."""
    return Lexicon([tuple(r) for r in counted(records).collect()])


def scanned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, rec_id, text) of the project's scanned texts and captions."""
    docs = spark.read.parquet(f"{sf_dir}/documents_md.parquet").select(F.lit("text").alias("src"), F.col("doc_id").cast("string").alias("rec_id"), "text")
    figs = spark.read.parquet(f"{sf_dir}/figures.parquet").select(F.lit("caption").alias("src"), F.col("fig_id").cast("string").alias("rec_id"), F.col("caption").alias("text"))
    return docs.unionByName(figs).filter(F.col("rec_id").isNotNull() & (F.trim("text") != "") & (F.col("text") != "(no caption)"))


LINE = "src string, rec_id string, line_no int, kind string, repaired string, defects array<string>, closes boolean"


def read_lines(records: DataFrame, lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """Every line of every record: src, rec_id, line_no, kind, repaired, defects, closes (the next body line continues its last word)."""
    counts = counted(records)
    if counts.limit(lexicon_rows + 1).count() > lexicon_rows:
        return joined(records, entries(counts))
    lex = records.sparkSession.sparkContext.broadcast(Lexicon([tuple(r) for r in counts.collect()]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = lex.value
        for pdf in batches:
            rows = [
                (src, rec, n, kind, fixed, sorted(bad), close)
                for src, rec, text in zip(pdf["src"], pdf["rec_id"], pdf["text"])
                for n, kind, fixed, bad, close in read(text, own)
            ]
            for at in range(0, max(1, len(rows)), 20_000):
                yield pd.DataFrame(rows[at : at + 20_000], columns=["src", "rec_id", "line_no", "kind", "repaired", "defects", "closes"])

    return spread(usable(records), "src", "rec_id").mapInPandas(run, LINE)


def entries(counts: DataFrame) -> DataFrame:
    """What a Lexicon of these counts holds, as a table (kind, a, b, entry): w words and s skeletons with what they are; b, h and k as counted."""
    named = F.col("kind") == "n"
    words = counts.filter(F.col("kind").isin("u", "n")).groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n"), F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"))
    total = words.agg(F.sum("n")).first()[0] or 0

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for w, n, k in zip(pdf["w"].tolist(), pdf["n"].tolist(), pdf["named"].tolist()):
                name = Lexicon.is_name(w, n, k, total)
                rows.append((w, n, skeleton(w), is_plain(w) and not name, w[0].isupper() or k > 0 and name))
            yield pd.DataFrame(rows, columns=["w", "n", "skeleton", "plain", "name"])

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(w, n, form, low) for w, n, kept in zip(pdf["w"], pdf["n"], pdf["kept"]) for low in ((True, False) if kept else (True,)) for form in dict.fromkeys(near_forms(w.lower() if low else w))]
            yield pd.DataFrame(rows, columns=["w", "n", "form", "low"])

    told = cut(words.mapInPandas(tell, "w string, n long, skeleton string, plain boolean, name boolean"))
    groups = told.groupBy("skeleton").agg(F.max("n").alias("top"), F.max(F.when(F.col("plain"), F.col("n"))).alias("most"))
    told = cut(told.join(groups, "skeleton").withColumn("kept", F.col("plain") & (F.col("n") >= VARIANT_SHARE * F.col("most"))))
    ordinary = told.filter("kept").select(F.col("w").alias("form"), F.col("n").alias("m"))
    n, m, low = F.col("n"), F.col("m"), F.col("low")
    near = told.select("w", "n", "kept").mapInPandas(forms, "w string, n long, form string, low boolean").join(ordinary, "form")
    near = near.groupBy("w").agg(F.max(low & (F.length("form") > 3) & (m > 50 * n)).alias("lesser"), F.max(~low & (F.col("form") != F.col("w")) & (n < 0.02 * m) & (F.length("w") > 3) & (m > 60)).alias("rare"))
    no = F.lit(False)
    misread = (n < VARIANT_SHARE * F.col("top")) | F.coalesce("lesser", no)
    whole = told.join(near, "w", "left").select(F.lit("w").alias("kind"), F.col("w").alias("a"), F.lit("").alias("b"), F.to_json(F.struct("n", (F.col("kept") & ~F.coalesce("rare", no)).alias("ordinary"), (F.col("name") & ~misread).alias("name"))).alias("entry"))
    alike = told.filter("kept").groupBy("skeleton").agg(F.collect_list(F.struct("n", "w")).alias("forms")).select(F.lit("s"), "skeleton", F.lit(""), F.to_json(F.struct("forms")))
    return cut(whole.union(alike).union(counts.filter(F.col("kind").isin("b", "h", "k")).select("kind", "a", "b", F.lit("{}"))))


def _read_record(given: dict[tuple, dict | None], src: str, rec: str, text: str) -> tuple[list[tuple], list[tuple]]:
    lex = Reading(given)
    lines = read(text, lex)
    return lex.missing, [(src, rec, n, kind, fixed, sorted(bad), close) for n, kind, fixed, bad, close in lines]


def _read_word(given: dict[tuple, dict | None], word: str) -> tuple[list[tuple], list[tuple]]:
    lex = Asked(given)
    forms = lex.candidates(word)
    return lex.missing, [(word, json.dumps(forms))]


def joined(records: DataFrame, table: DataFrame) -> DataFrame:
    """As read_lines, by a lexicon too large to broadcast."""

    def candidates(asked: DataFrame) -> DataFrame:
        words = asked.filter("kind = 'c'").select("a").distinct()
        return _answered(words, table, _read_word, "a string, entry string").select(F.lit("c").alias("kind"), "a", F.lit("").alias("b"), "entry")

    return _answered(spread(usable(records), "src", "rec_id"), table, _read_record, LINE, candidates)


def _answered(rows: DataFrame, table: DataFrame, work: Callable, schema: str, further: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What work gives for each row, by the entries (kind, a, b, entry) of a table that it asks for.

    work: gives, by what is known, what it asks besides, and its result.  It is
    done again and again, each time with the entries that it asked for before,
    until it asks for no other.  Only entries that are there are handed to a
    row; what it asked before is found by asking once more.
    further: gives the entries of what is asked that stand in no table.
    """
    held, cols = rows.columns, [x.split()[0] for x in schema.split(", ")]

    def at_step(step: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def frame(out: list[tuple]) -> pd.DataFrame:
            made = pd.DataFrame(out, columns=["row", "ask", "x", "y", *cols])
            return made.astype({"line_no": "Int32"}) if "line_no" in cols else made

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out: list[tuple] = []
                for row, entries_, *values in zip(pdf["row"], pdf["given"], *[pdf[c] for c in held]):
                    there = {(kind, a, b): json.loads(entry) for kind, a, b, entry in json.loads(entries_ or "[]")}
                    known: dict[tuple, dict | None] = {}
                    for _ in range(step + 1):
                        missing, result = work(known, *values)
                        if not missing:
                            out += [(row, None, None, None, *r) for r in result]
                            break
                        fresh = dict.fromkeys(missing)
                        known.update((at, there.get(at)) for at in fresh)
                    else:
                        out += [(row, *at, *[None] * len(cols)) for at in fresh]
                    if len(out) > 20_000:
                        yield frame(out)
                        out = []
                yield frame(out)

        return run

    todo = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    given = todo.select("row", F.lit("").alias("kind"), F.lit("").alias("a"), F.lit("").alias("b"), F.lit("").alias("entry")).limit(0)
    done: list[DataFrame] = []
    while True:
        handed = given.groupBy("row").agg(F.to_json(F.collect_list(F.array("kind", "a", "b", "entry"))).alias("given"))
        out = cut(todo.join(handed, "row", "left").select("row", "given", *held).mapInPandas(at_step(len(done)), f"row long, ask string, x string, y string, {schema}"))
        done.append(out.filter("ask is null").select(cols))
        asked = out.filter("ask is not null").select("row", F.col("ask").alias("kind"), F.col("x").alias("a"), F.col("y").alias("b"))
        if asked.isEmpty():
            break
        open_ = asked.select("row").distinct()
        there = asked.join(table, ["kind", "a", "b"])
        if further is not None:
            there = there.unionByName(asked.join(further(asked), ["kind", "a", "b"]))
        given = cut(given.join(open_, "row", "left_semi").unionByName(there.select("row", "kind", "a", "b", "entry")))
        todo = cut(todo.join(open_, "row", "left_semi"))
    whole = done[0]
    for some in done[1:]:
        whole = whole.union(some)
    return whole


def found(records: DataFrame, lexicon_rows: int = LEXICON_ROWS) -> DataFrame:
    """One row per line and defect: src, rec_id, line_no, defect."""
    lines = read_lines(records, lexicon_rows)
    return lines.select("src", "rec_id", "line_no", F.explode("defects").alias("defect")).distinct()


def reflow(records: DataFrame) -> DataFrame:
    """Continuous paragraphs of each record, in order: src, rec_id, para_no, text.

    Running heads, printed page numbers and page marks vanish; a paragraph goes
    on over them.  Headings and figure placeholders stand alone.
    """
    lines = read_lines(records).repartition("src", "rec_id").dropDuplicates(["src", "rec_id", "line_no"])  # one shuffle, which serves the windows too
    order = Window.partitionBy("src", "rec_id").orderBy("line_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    blank = F.col("kind") == "blank"
    dropped = F.col("kind").isin("header", "pageno", "mark")
    kept = lines.withColumn("page_gap", F.lag(dropped).over(order) | F.lead(dropped).over(order) | (blank & (F.lag("kind", 2).over(order) == "mark") | (F.lead("kind", 2).over(order) == "mark")))
    kept = kept.filter(~dropped & ~(blank & F.coalesce("page_gap", F.lit(False))))
    ended = F.lag("repaired").over(order).rlike(r"[.!?»)]\s*$") | F.lag("repaired").over(order).isNull()
    start = (
        F.col("kind").isin("heading", "figure")
        | F.lag("kind").over(order).isin("heading", "figure", "blank")
        | (blank & ended)
    )
    para = kept.withColumn("para_no", F.sum(F.coalesce(start, F.lit(True)).cast("int")).over(upto)).filter(~blank & (F.trim("repaired") != ""))
    piece = F.concat(F.trim("repaired"), F.when(F.col("closes"), "").otherwise(" "))
    whole = para.groupBy("src", "rec_id", "para_no").agg(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("t")))).alias("ps"))
    again = Window.partitionBy("src", "rec_id").orderBy("para_no")
    return whole.select("src", "rec_id", F.row_number().over(again).alias("para_no"), F.trim(F.array_join(F.col("ps.t"), "")).alias("text"))
