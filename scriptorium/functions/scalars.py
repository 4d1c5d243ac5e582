"""Scalar functions on columns: text repair, names, ranks, headings.

All are built-in expressions, so they stay inside generated code.  A null gives
a null unless a function says otherwise; none depends on other rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions import vocab as V


def accents_folded(x: Column) -> Column:
    """Text under compatibility decomposition, without combining marks; Hangul stays as it is."""
    several = F.from_json(F.lit(json.dumps(V.MANY)), "map<string,string>")
    spelt = F.concat_ws("", F.transform(F.split(x, ""), lambda ch: F.coalesce(F.try_element_at(several, ch), ch)))
    # characters that stand for several are rare: only a text that holds one is taken apart
    whole = F.when(x.rlike(f"[{V.MANY_CLASS}]"), spelt).otherwise(x)
    return F.translate(whole, *V.ACCENTS)


def letters(x: Column) -> Column:
    """Lower-case ASCII letters only; accented letters vanish."""
    return F.lower(F.regexp_replace(x, "[^A-Za-z]+", ""))


def family_front(x: Column) -> Column:
    """The family name a letters-only string begins with, or null."""
    return F.initcap(F.nullif(F.regexp_extract(x, "^([a-z]{4,30}(?:aceae|eaceae))", 1), F.lit("")))


def family_name(raw: Column, scanned: bool = True) -> Column:
    """Latin family name of a French or Latin one; scanned: fold accents and keep the conserved names."""
    name = F.trim(F.regexp_replace(raw, r"(?s)\s*\(.*", ""))
    up = F.upper(accents_folded(name)) if scanned else F.upper(name)
    low = F.regexp_replace(up, "(?i)C[EÉ][AEÉ][ES]S?$", "ceae")
    out = F.concat(F.upper(F.substring(low, 1, 1)), F.lower(F.substring(low, 2, 1_000_000)))
    if scanned:
        kept = F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substring(name, 2, 1_000_000)))
        out = F.when(F.upper(name).isin(V.NOM_CONS), kept).otherwise(out)
    return out


def stem_repaired(x: Column) -> Column:
    """A truncated family stem in capitals made whole, or null."""
    up = "[A-ZÀ-Ý]"
    return (
        F.when(x.rlike(f"^{up}{{4,}}AC$"), F.concat(x, F.lit("EAE")))
        .when(x.rlike(f"^{up}{{4,}}ACE$"), F.concat(x, F.lit("AE")))
        .when(x.rlike(f"^{up}{{4,}}ACEE$"), F.concat(x, F.lit("S")))
        .when(x.rlike(f"^{up}{{4,}}ACÉE$"), F.concat(x, F.lit("S")))
    )


def roman(x: Column) -> Column:
    """The number a roman numeral stands for; other characters count nothing."""
    value = F.create_map(*[F.lit(v) for pair in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}.items() for v in pair])
    digits = F.transform(F.split(F.upper(x), ""), lambda ch: F.coalesce(value[ch], F.lit(0)))
    rest = F.concat(F.slice(digits, 2, F.greatest(F.size(digits), F.lit(1))), F.array(F.lit(0)))
    return F.aggregate(F.zip_with(digits, rest, lambda a, b: F.when(b > a, -a).otherwise(a)), F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))


def terminal_name(text: Column) -> Column:
    """The taxon at the end of a key statement: after dotted leaders, else the last binomial, else all of it."""
    led = F.regexp_extract(text, r"\.{2,}\s*(.+?)\.?\s*$", 1)
    led = F.trim(F.regexp_replace(F.rtrim(F.trim(led), F.lit(".")), r"^[0-9]+['\"]?\.\s+", ""))
    pair = F.regexp_extract(text, r"([A-Z][a-z]*\.?\s+[A-Z]?[a-z]+[a-z.]*)\.?\s*$", 1)
    return F.when(text.rlike(r"\.{2,}\s*.+?\.?\s*$"), led).when(pair != "", F.rtrim(F.trim(pair), F.lit("."))).otherwise(F.trim(text))


def like_author(token: Column) -> Column:
    """A short abbreviation with a full stop, or a word with a small letter."""
    return ((F.length(token) <= 4) & token.endswith(".")) | token.rlike(r"\p{Ll}")


def structural(word: Column) -> Column:
    return F.upper(word).isin(V.STRUCTURAL)


def rank(text: Column) -> Column:
    """infraspecific, family, genus or species if a heading names a taxon, else null; the first that fits, in this order."""
    t = F.trim(text)
    genus = rf"^(?:[0-9]+\.\s+)?([{V.UC}]{{3,}})\s+([A-Z]\S*)(?:\s+.*)?$"
    word, author = F.regexp_extract(t, genus, 1), F.regexp_extract(t, genus, 2)
    numbered = rf"^(?:[0-9]+|[IVX]{{1,4}})\.\s+[{V.UC}][{V.LC}]{{2,}}\s+(?:[{V.UC}]?[{V.LC}][{V.LC}-]+|sp\.)"
    return (
        F.when(t.rlike(r"^[a-z]\)\s+(?:var\.|subsp\.|ssp\.|f\.|fo\.|forma)\s"), "infraspecific")
        .when(t.rlike(rf"^[{V.UC}]+(?:ACÉES|ACEAE|ACEES)$"), "family")
        .when(t.rlike(genus) & ~structural(word) & like_author(author), "genus")
        .when(t.rlike(numbered), "species")
        .when(t.rlike(rf"^[{V.UC}][{V.LC}]{{2,}}\s+sp\."), "species")
    )


def rank_level(r: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, level in V.RANK_LEVEL.items():
        out = F.when(r == name, level).otherwise(out)
    return out


def taxon_level(text: Column, strict_rank: bool = True) -> Column:
    """Heading prefix of a text block that names a taxon, else null; strict_rank: a rank must touch the next word."""
    s = F.trim(text)
    first = F.element_at(F.split(s, r"\s+"), 1)
    words = F.size(F.split(s, r"\s+"))
    family = first.rlike("^[A-ZÀ-Ý]{3,}(?:CEAE|CÉES|CEES|ACEAE|ACÉES|ACEES|EAE)$") | first.isin(V.NOM_CONS)
    after = r"(?=[A-Za-zÀ-ÿ0-9_])" if strict_rank else ""
    below = s.rlike(rf"\b(?:var\.|subsp\.|ssp\.|f\.|cv\.){after}") & s.rlike("^[A-Z][a-z]{2,}")
    pair = r"^([A-Z][a-z]{2,30})\s+[a-z]{3,30}(?:-[a-z]+)?(?:[\s,(]|$)"
    bare = F.rtrim(first, F.lit("."))
    return (
        F.when((s == "") | s.contains("\n"), None)
        .when(family, "# ")
        .when(below, "#### ")
        .when(s.rlike(pair) & ~F.regexp_extract(s, pair, 1).isin(V.NON_GENUS), "### ")
        .when((words == 1) & first.rlike(r"^[A-Z][a-z]{3,24}\.?$") & ~bare.isin(V.NON_GENUS), "## ")
    )


def label_key(label: Column) -> tuple[Column, Column, Column]:
    """Sort columns of a volume label: its number (unreadable last), whether it is a 'bis', the label."""
    n = F.regexp_extract(label, r"^([0-9]+)(?:bis)?$", 1)
    return F.coalesce(F.nullif(n, F.lit("")).cast("long"), F.lit(1_000_000_000).cast("long")), label.endswith("bis"), label


def slug(x: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("article"))


def word_slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_]+", "_"), "^_+|_+$", "")


def key_id(heading: Column, family: Column, genus: Column) -> tuple[Column, Column, Column]:
    """Id, display text and genus of a key, from its heading and the taxa above it."""
    of_genera = F.upper(heading).contains("GENERA") & family.isNotNull()
    ident = F.when(of_genera, F.concat(F.lit("genera_"), word_slug(family))).when(genus.isNotNull(), F.concat(F.lit("species_"), F.lower(genus))).otherwise(word_slug(heading))
    shown = F.when(of_genera, F.concat(F.lit("Key to "), family, F.lit(" Genera"))).when(genus.isNotNull(), F.concat(F.lit("Key to "), genus)).otherwise(heading)
    own = F.when(ident.startswith("species_"), F.substring(ident, 9, 1_000_000))
    return ident, shown, own


def duration(seconds: Column) -> Column:
    """H h MM m from an hour on, else M m SS s; fractions are cut off."""
    s = F.floor(seconds).cast("long")
    return F.when(s >= 3600, F.format_string("%dh %02dm", (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"))).otherwise(F.format_string("%dm %02ds", (s / 60).cast("long"), s % 60))


def couplet(line: Column) -> tuple[Column, Column, Column]:
    """Number, prime marks and text of a line that starts a key statement; nulls if it does not."""
    is_start = line.rlike(V.COUPLET)
    return (
        F.when(is_start, F.regexp_extract(line, V.COUPLET, 1).cast("int")),
        F.when(is_start, F.regexp_extract(line, V.COUPLET, 2)),
        F.when(is_start, F.regexp_replace(line, V.COUPLET, "")),
    )


def truncated_reference(line: Column) -> Column:
    """A statement that is a bare abbreviated species name whose dotted leaders were lost."""
    rest = F.trim(F.regexp_replace(line, V.COUPLET, ""))
    return line.rlike(V.COUPLET) & rest.rlike(r"^[A-Z][a-z]*\.\s+[A-Z]?[a-z]") & (F.length(rest) <= 50)


def couplet_digits(line: Column) -> Column:
    """Misread digits and full stops at the start of a key statement put right."""
    quotes = "['\"’′]*"
    x = F.regexp_replace(line, "[．・·]", ".")
    for start in (r"[0-9]{1,2}", r"[Il][0-9o]", r"[Il]"):
        x = F.regexp_replace(x, rf"^({start}{quotes})\.(?!\s)", "$1. ")
    two = rf"^[Il]([0-9o])({quotes})\.\s"
    one = rf"^[Il]({quotes})\.\s"
    second = F.when(F.regexp_extract(x, two, 1) == "o", "0").otherwise(F.regexp_extract(x, two, 1))
    return F.when(x.rlike(two), F.concat(F.lit("1"), second, F.regexp_extract(x, two, 2), F.lit(". "), F.regexp_replace(x, two, ""))).when(x.rlike(one), F.concat(F.lit("1"), F.substring(x, 2, 1_000_000))).otherwise(x)


def heading(line: Column) -> tuple[Column, Column]:
    """Level and text of a markdown heading; nulls for other lines."""
    is_head = line.rlike(V.HEADING)
    return F.when(is_head, F.length(F.regexp_extract(line, V.HEADING, 1))), F.when(is_head, F.trim(F.regexp_extract(line, V.HEADING, 2)))


def page_number(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, V.PAGE, 1), F.lit("")).cast("int")


def figure_ids(text: Column) -> Column:
    """Distinct ids of the figures a text refers to, ascending."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\[Figure ([0-9]+) \(p\.[0-9]+\)"), F.lit(1)), lambda x: x.cast("int"))))


def mixed_case(text: Column) -> Column:
    """Words with a capital inside, as broken fonts give them, in title case."""
    pieces = F.split(text, r"(?<=[\p{L}\p{N}_])(?=[^\p{L}\p{N}_])|(?<=[^\p{L}\p{N}_])(?=[\p{L}\p{N}_])")
    return F.array_join(F.transform(pieces, lambda t: F.when(t.rlike("^[A-Z][a-z]+[A-Z][A-Za-z]{2,}$"), F.concat(F.substring(t, 1, 1), F.lower(F.substring(t, 2, 1_000_000)))).otherwise(t)), "")


def joined(items: Column) -> Column:
    """Trimmed items that are not empty, joined by one blank."""
    return F.array_join(F.filter(F.transform(items, lambda t: F.trim(t)), lambda t: t != ""), " ")


def garbage_score(text: Column) -> Column:
    """How broken the text of a page looks; 0 below 20 tokens.

    Each kind of broken token has a sign that one pass over the text finds; only
    a text that holds the sign is cut into tokens for it.
    """
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")

    def many(sign: str, condition) -> Column:  # noqa: ANN001
        return F.when(text.rlike(sign), F.size(F.filter(tokens, condition))).otherwise(0)

    word, no_digit = r"[\p{L}\p{N}_]", r"[\p{L}\p{N}_&&[^0-9]]"
    digit_sign = rf"{no_digit}[0-9]|[0-9]{no_digit}"
    digit = many(digit_sign, lambda t: t.rlike(digit_sign) & t.rlike(rf"(?<!{word})(?={word}*[A-Za-z])(?={word}*[0-9]){word}{{6,}}(?!{word})"))
    upper = many("[A-Za-z]{2}[A-Z][A-Za-z]{2}", lambda t: t.rlike(rf"(?<!{word})[A-Za-z]{{2,}}[A-Z][A-Za-z]{{2,}}(?!{word})") & t.rlike(r"\p{Ll}") & ~t.rlike(r"^\p{Lu}[^\p{Lu}]*$"))
    accented = many("[a-zà-ÿ][À-Ý][a-zà-ÿ]", lambda t: t.rlike(rf"(?<!{word})\p{{L}}*[a-zà-ÿ][À-Ý][a-zà-ÿ]+(?!{word})"))
    prefixed = many("[%&$#/][A-Za-z0-9]{6}", lambda t: t.rlike(r"^[%&$#/][A-Za-z0-9]{6,}$"))
    symbols = F.regexp_count(text, F.lit("[¶§¦]"))
    score = 3 * digit + 2 * upper + 2 * accented + 2 * prefixed + 2 * symbols
    return F.when(text.isNull() | (score == 0), 0).when(F.size(tokens) < 20, 0).otherwise(score).cast("int")


def rounded_up(x: Column, step: int = 32) -> Column:
    return (F.ceil(x / F.lit(float(step))) * step).cast("long")


def figure_epithet(name: Column) -> Column:
    """Epithet to look a figure up by, or null for a bare genus."""
    bare = F.trim(F.regexp_replace(name, r"^(?:[0-9]+|[IVX]+)['\"]?\.\s+", ""))
    parts = F.split(bare, r"\s+")
    return F.when(F.size(parts) >= 2, F.lower(F.rtrim(F.element_at(parts, -1), F.lit("."))))


def caption_of(block: Column) -> Column:
    """Caption of a figure block; empty if there is none."""
    c = F.trim(F.regexp_extract(block, r"\*Caption:\*\s*(.+)", 1))
    return F.when(c.contains("(no caption"), "").otherwise(c)


def is_caption(line: Column) -> Column:
    return line.rlike(V.CAPTION_LINE)


def is_species_heading(line: Column) -> Column:
    return line.rlike(V.SPECIES_HEAD) & ~line.rlike(V.YEAR) & ~line.rlike(V.LATIN_DIAGNOSIS)


def font_heading(size: Column, body: Column, text: Column) -> Column:
    return F.concat(F.when(size >= body * V.HEAD_BIG, "## ").when(size >= body * V.HEAD_SMALL, "### ").otherwise(""), text)


def figure_file(idx: Column, page: Column) -> Column:
    return F.format_string("fig_%03d_p%04d.png", idx, page)


def placeholder(number: Column, page: Column) -> Column:
    return F.format_string("[Figure %d (p.%d) — see figures.md]", number, page)
