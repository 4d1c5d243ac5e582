"""Problem 8: keyword-stuffed and link-list pages.

Method: the blocks of a page (paragraphs, runs of short ones taken together) get
the share of their commonest word, the share of content words that repeat, the
share of repeated n-grams and of repeated lines, the share of link text, the
density of separators and the share of function words.  Which words are function
words, how many of them sentences hold and how much sentences repeat themselves
is learned for each language from its own pages; a block that goes far beyond
that is stuffed.  A list, which holds no function words either way, is spam if it
draws on a small stock of words: either it repeats them more than sentences do,
or they are words that the corpus holds mainly in blocks of that kind.  A page is
spam if more than half of its characters stand in spam blocks.

Honest lists (checklists, indices, keys, bibliographies, specimens, measures)
lack function words too, but their words differ from item to item, or figures
stand between them and no word is common.

Two passes over the texts: one counts in how many pages a word stands, one
measures the blocks.  All that follows reads the measures only, which are a few
numbers for each block and the words of lists.  What reaches the driver is
bounded by shares: function words (at least FUNCTION_PAGES of the pages of a
language), limits (a row for each language) and the stock of spam (words of at
least STOCK_PAGES of the pages with spam).

Null or blank texts and pages without id are no spam; repeated rows of one page
count once.  A page without language, or in one of fewer than LEARN_PAGES pages,
takes the language whose function words it holds most; if it holds hardly any,
its own words of up to SHORT letters stand for them and the limits of all
languages together hold.  Languages written without blanks are not covered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.lineage import cut, spread

#: Share of a page's characters above which it is spam.
PAGE_SHARE = 0.5
#: Function words: at most so many letters, in at least this share of the pages of a language that has so many pages.
FUNCTION_LETTERS, FUNCTION_PAGES, LEARN_PAGES = 4, 0.12, 50
#: Where no language fits: longest word that counts as function word; share of function words from which a language fits.
SHORT, FITS = 3, 0.12
#: Words below which a block cannot be judged by how much it repeats; content words in a stretch over which that is measured.
LEAST_WORDS, STRETCH = 20, 40
#: Sentences hold at least this share of the median of function words of their language.
PROSE = 0.5
#: A limit lies so many times as far above the median of sentences as their 0.9 quantile does, and at least at the floor.
REACH = {"top": 4.0, "rep": 3.0, "gram": 4.0, "lines": 4.0, "list": 1.0}
FLOOR = {"top": 0.10, "rep": 0.42, "gram": 0.45, "lines": 0.5, "list": 0.12}
#: Share of link text, of separators to words, and of numbers to words, beyond which a list is one of links, of labels, of figures.
LINKS, SEPARATORS, FIGURES = 0.5, 0.25, 0.22
#: The commonest words of a list are its columns: so many are left aside when its stock of words is measured, so many in one of figures.
COLUMNS, COLUMNS_OF_FIGURES = 2, 5
#: A word of the stock: in this share of the pages with spam, and with this share of its pages among them; share of a list's words in the stock.
STOCK_PAGES, STOCK_OWN, STOCK_SHARE = 0.002, 0.25, 0.35
#: Words of lists are kept for the stock up to this share of function words.
LISTED = 0.35

WORD = re.compile(r"[^\W\d_]+|\d+")
PARAGRAPH = re.compile(r"\n\s*\n")
DOTTED = re.compile(r"\.[a-z]")
LINK = re.compile(r"\[[^\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)\S+|(?<![\w.@])[a-z0-9][a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?:/\S*)?(?!\w)")
SEPARATOR = re.compile(r"[>›»→|;•·#/★=]")
#: Single letters are no words of a language's stock.
SINGLE = {chr(c) for c in range(0x61, 0x250) if chr(c).islower()}
DIGITS = {ord(d): None for d in "0123456789"}
MEASURES = ("n", "function", "figures", "rep", "rest", "top", "gram", "lines", "link", "separators")
BLOCK = "doc_id long, block_no int, lang string, chars long, " + ", ".join(f"{m} double" for m in MEASURES) + ", words string"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, word, n): the number of pages that hold a word; of all pages under an empty word."""
    seen: dict[str, Counter] = {}
    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            own = seen.setdefault(lang or "", Counter())
            own.update(set(words_of(text)))
            own[""] += 1
        if sum(map(len, seen.values())) > 400_000:
            yield from _vocabulary(seen)
            seen = {}
    yield from _vocabulary(seen)


def _vocabulary(seen: dict[str, Counter]) -> Iterator[pd.DataFrame]:
    for lang, own in seen.items():
        yield pd.DataFrame({"lang": lang, "word": list(own), "n": list(own.values())})


def function_words(vocabulary: DataFrame) -> dict[str, frozenset[str]]:
    """The function words of each language with enough pages, learned from a vocabulary (lang, word, n).

    A page holds some hundred different words, so at most a few thousand words of
    a language can stand in FUNCTION_PAGES of its pages.
    """
    pages = vocabulary.filter((F.col("word") == "") & (F.col("lang") != "") & (F.col("n") >= LEARN_PAGES)).select("lang", F.col("n").alias("pages"))
    common = vocabulary.filter((F.length("word").between(1, FUNCTION_LETTERS)) & ~F.col("word").rlike(r"^\d")).join(pages, "lang").filter(F.col("n") >= FUNCTION_PAGES * F.col("pages"))
    out: dict[str, set[str]] = {r.lang: set() for r in pages.collect()}
    for r in common.select("lang", "word").collect():
        out[r.lang].add(r.word)
    return {lang: frozenset(ws | SINGLE) for lang, ws in out.items()}


def language(words: list[str], lang: str | None, known: dict[str, frozenset[str]]) -> str:
    """The language of a page: its own if it was learned, else that whose function words it holds most; '' if it holds hardly any."""
    if lang in known:
        return lang
    best = max(sorted(known), key=lambda k: sum(map(known[k].__contains__, words)), default="")
    return best if best and sum(map(known[best].__contains__, words)) >= FITS * len(words) else ""


def repeated(words: list[str]) -> float:
    """The share of words that stood before in the same stretch, so that it does not grow with the length of a text."""
    if not words:
        return 0.0
    size = -(-len(words) // max(1, round(len(words) / STRETCH)))
    cuts = range(0, len(words), size)
    return sum(1 - len(set(words[i : i + size])) / len(words[i : i + size]) for i in cuts) / len(cuts)


def measure(block: str, function: frozenset[str] | None) -> tuple[dict[str, float], list[str]]:
    """The measures of a block, and its content words.  function: None where no language fits."""
    links = 0
    plain = block
    if "://" in block or "](" in block or DOTTED.search(block):
        plain, links = LINK.subn(" ", block)
        links = len(block) - len(plain) + links if links else 0
    words = words_of(plain)
    n = len(words)
    letters = [w for w in words if w >= "a"]
    figures = n - len(letters)
    content = [w for w in letters if len(w) > SHORT] if function is None else [w for w in letters if w not in function]
    out = dict.fromkeys(MEASURES, 0.0)
    out.update(n=n, function=(n - figures - len(content)) / max(1, n - figures), figures=figures / max(1, n), link=links / max(1, len(block)))
    if n and out["function"] < LISTED:
        out["separators"] = len(SEPARATOR.findall(plain)) / n
    if n >= LEAST_WORDS and content:
        out["rep"] = repeated(content)
        if out["rep"]:
            counts = Counter(content)
            out["top"] = max(counts.values()) / n
            columns = set()
            for _ in range(min(len(counts), COLUMNS if out["figures"] < FIGURES else COLUMNS_OF_FIGURES)):
                w = max(counts, key=counts.__getitem__)
                columns.add(w)
                counts[w] = 0
            out["rest"] = repeated([w for w in content if w not in columns])
            if out["top"] >= FLOOR["top"]:  # else no n-gram can be common
                seen = Counter(zip(words, words[1:], words[2:], words[3:]))
                out["gram"] = sum(v for v in seen.values() if v > 2) / (n - 3)
        if plain.count("\n") > 2:
            lines = [x for x in plain.translate(DIGITS).split("\n") if x.strip()]
            out["lines"] = 1 - len(set(lines)) / max(1, len(lines)) if len(lines) > 3 else 0.0
    return out, content


def blocks(text: str, function: frozenset[str] | None) -> list[tuple[int, dict[str, float], list[str]]]:
    """(characters, measures, content words) of the blocks of a page; short paragraphs without function words go together."""
    out = []
    run: list[str] = []

    def close() -> None:
        if run:
            whole = "\n\n".join(run)
            out.append((sum(map(len, run)), *measure(whole, function)))
            run.clear()

    for p in PARAGRAPH.split(text):
        if not p.strip():
            continue
        m, content = measure(p, function)
        if m["n"] < LEAST_WORDS and m["function"] < LISTED:
            run.append(p)
            continue
        close()
        out.append((len(p), m, content))
    close()
    return out


def measured(pages: DataFrame, known: dict[str, frozenset[str]]) -> DataFrame:
    """The blocks (BLOCK) of pages (doc_id, text, lang); words only of those with few function words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in BLOCK.split(", ")]
        for pdf in batches:
            rows = []
            for i, text, lang in zip(pdf["doc_id"], pdf["text"], pdf["lang"]):
                own = lang if lang in known else language(words_of(text), lang, known)
                for k, (chars, m, content) in enumerate(blocks(text, known.get(own))):
                    rows.append((i, k, own, chars, *m.values(), " ".join(content) if m["function"] < LISTED else None))
            yield pd.DataFrame(rows, columns=names)

    return pages.mapInPandas(run, BLOCK)


def limits(measures: DataFrame) -> DataFrame:
    """A row for each language, '' for all together: lang, prose and the limits of REACH, from blocks that read like sentences."""
    long = measures.filter(F.col("n") >= LEAST_WORDS)
    every = long.unionByName(long.filter("lang <> ''").withColumn("lang", F.lit("")))
    middle = every.groupBy("lang").agg((PROSE * F.percentile_approx("function", 0.5)).alias("prose"))
    prose = every.join(F.broadcast(middle), "lang").filter(F.col("function") >= F.col("prose"))  # a row for each language

    def limit(name: str, source: str) -> Column:
        q = F.percentile_approx(source, [0.5, 0.9])
        return F.greatest(F.lit(FLOOR[name]), q[0] + REACH[name] * (q[1] - q[0])).alias(f"most_{name}")

    return prose.groupBy("lang").agg(F.first("prose").alias("prose"), *[limit(k, "rest" if k == "list" else k) for k in REACH])


def reasons() -> Column:
    """Why a block, joined with the limits of its language, is spam by its own measures."""
    c = F.col
    listed, long = c("function") < c("prose"), c("n") >= LEAST_WORDS
    why = {
        "links": c("link") >= LINKS,
        "words": ~listed & long & (c("top") >= c("most_top")) & (c("rep") >= c("most_rep")),
        "grams": ~listed & long & (c("gram") >= c("most_gram")) & (c("top") >= c("most_top")),
        "lines": long & (c("lines") >= c("most_lines")) & (listed | (c("rep") >= c("most_rep"))),
        "stock": listed & long & (c("rest") >= c("most_list")),
        "labels": listed & long & (c("separators") >= SEPARATORS) & (c("rest") >= 0.75 * c("most_list")) & (c("figures") < FIGURES),
    }
    return F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in why.items()]), lambda x: x.isNotNull())


def stock_of(flagged: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word): the words that lists of spam draw on, from flagged blocks (doc_id, words)."""
    held = flagged.filter("words is not null").select("doc_id", F.explode(F.split("words", " ")).alias("word")).filter("word <> ''").distinct()
    pages = flagged.agg(F.countDistinct("doc_id").alias("pages"))
    spam = held.groupBy("word").agg(F.count("*").alias("k"))
    total = vocabulary.groupBy("word").agg(F.sum("n").alias("total"))
    common = spam.crossJoin(F.broadcast(pages)).filter((F.col("k") >= 3) & (F.col("k") >= STOCK_PAGES * F.col("pages")))  # one row of totals
    return common.join(total, "word").filter(F.col("k") >= STOCK_OWN * F.col("total")).select("word")


def judged(pages: DataFrame) -> DataFrame:
    """(doc_id, chars, why): the blocks of pages (doc_id, text, lang) and why they are spam, if they are."""
    pages = pages.filter(F.col("doc_id").isNotNull() & (F.trim("text") != "")).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    pages = spread(pages, "doc_id")
    vocabulary = cut(pages.select("text", "lang").mapInPandas(count_batches, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    measures = cut(measured(pages, function_words(vocabulary)).distinct().withColumn("block", F.monotonically_increasing_id()))
    spark = pages.sparkSession
    limit = limits(measures).collect()  # a row for each language that was learned, and one for all
    names = ["lang", "prose", *(f"most_{k}" for k in REACH)]
    if all(r.lang for r in limit):  # nothing reads like sentences
        limit.append(("", PROSE * LISTED, *FLOOR.values()))
    own = [r[0] for r in limit]
    table = F.broadcast(spark.createDataFrame(limit, ", ".join([f"{names[0]} string", *(f"{x} double" for x in names[1:])])))
    told = measures.withColumn("lang", F.when(F.col("lang").isin(own), F.col("lang")).otherwise("")).join(table, "lang")
    told = told.select("doc_id", "block", "chars", "words", (F.col("function") < F.col("prose")).alias("listed"), reasons().alias("why"))
    stock = stock_of(told.filter(F.size("why") > 0).select("doc_id", "words"), vocabulary)
    unsure = told.filter((F.size("why") == 0) & F.col("listed") & F.col("words").isNotNull()).select("block", F.explode(F.split("words", " ")).alias("word"))
    words = spark.createDataFrame([(r.word, 1) for r in stock.collect()], "word string, hit int")  # bounded by STOCK_PAGES
    drawn = unsure.join(F.broadcast(words), "word", "left").groupBy("block").agg((F.count("hit") / F.count("*")).alias("share")).filter(F.col("share") >= STOCK_SHARE)
    return told.join(drawn, "block", "left").select("doc_id", "chars", F.when(F.col("share").isNotNull(), F.array(F.lit("keywords"))).otherwise(F.col("why")).alias("why"))


def scored(pages: DataFrame) -> DataFrame:
    """(doc_id, n_chars, spam_share, reasons) of pages (doc_id, text, lang)."""
    bad = F.size("why") > 0
    return judged(pages).groupBy("doc_id").agg(
        F.sum("chars").alias("n_chars"), (F.sum(F.when(bad, F.col("chars")).otherwise(0)) / F.sum("chars")).alias("spam_share"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("why")))).alias("reasons")
    )


def found(pages: DataFrame) -> DataFrame:
    """(doc_id) of the spam pages."""
    return scored(pages).filter(F.col("spam_share") > PAGE_SHARE).select("doc_id")
