import random

import pytest

from scriptorium.llm import spam as S

GLUE = {
    "en": "the of and in is are an to by on at it its with for from this that was has".split(),
    "fr": "le la les de des du un une et en est sont au aux par sur dans qui que se".split(),
    "de": "der die das und in den von mit ist ein im auf als an es aus bei nach wird zu".split(),
    "es": "de la que el en y a los del se las por un para con una su al lo como".split(),
}
HOUSE = "Our house is in the mountains and the house of my brother is by the river, but this house was the first house that we had, and it has been our house for years since the old house of our parents fell down."
WALD = "Der Wald liegt hinter dem Dorf, und wer durch den Wald geht, hört am Abend die Vögel. Im Wald stehen alte Buchen, deren Laub den Boden bedeckt, und ein Bach fließt langsam durch das enge Tal nach Osten."


def word(rng: random.Random) -> str:
    return "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(3, 5)))


def corpus(seed: int) -> tuple[list[tuple], set[int]]:
    """Planted pages of four languages: sentences, honest lists and spam of several kinds."""
    rng = random.Random(seed)
    rows, spam = [], set()
    for lang, glue in GLUE.items():
        stock, nouns = [word(rng) + " " + word(rng) for _ in range(15)], [word(rng) for _ in range(400)]

        def sentences(n: int) -> str:
            return " ".join(" ".join(rng.choice(glue) if rng.random() < 0.5 else rng.choice(nouns) for _ in range(rng.randint(8, 15))).capitalize() + "." for _ in range(n))

        for k in range(150):
            doc = len(rows)
            if k % 10 == 0:
                spam.add(doc)
                kind, some = k // 10 % 5, rng.sample(stock, 4)
                text = [
                    lambda: "\n".join(" > ".join(rng.sample(stock, 3)) for _ in range(14)),
                    lambda: " ".join(f"#{rng.choice(stock).replace(' ', '')}" for _ in range(40)),
                    lambda: "\n".join(f"[{rng.choice(stock)}](https://{word(rng)}.{word(rng)}/{i})" for i in range(9)),
                    lambda: " ".join(f"{glue[0]} {some[0]} {glue[1]} {glue[2]} {some[0]} {glue[3]} {glue[4]} {some[0]} {glue[5]} {rng.choice(nouns)}." for _ in range(6)),
                    lambda: "\n\n".join(f"{rng.choice(stock)} {rng.choice(stock)}" for _ in range(16)),
                ][kind]()
                if k % 20 == 0:
                    text = sentences(1) + "\n\n" + text
            elif k % 10 == 1:
                text = "\n".join(f"{word(rng).capitalize()} {word(rng)} {word(rng).capitalize()}" for _ in range(20))
            elif k % 10 == 2:
                text = "\n".join(f"{word(rng).capitalize()} {word(rng)} | {nouns[0]} {rng.randint(1, 40)}-{rng.randint(41, 90)} | {rng.randint(1, 400)}" for _ in range(20))
            else:
                text = "\n\n".join(sentences(rng.randint(3, 6)) for _ in range(3)) + (f"\n\n{rng.choice(stock)} > {rng.choice(stock)}" if k % 10 == 3 else "")
            rows.append((doc, text, lang if rng.random() < 0.9 else None))
    return rows, spam


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_pages_of_four_languages(spark, seed):
    rows, spam = corpus(seed)
    extra = [(5000, HOUSE, "en"), (5001, WALD, "de"), (5002, WALD, None), (5003, None, "fr"), (5004, "", "fr"), (None, rows[0][1], "fr"), (0, rows[0][1], "en")]
    df = spark.createDataFrame([(*r, 1, "r") for r in rows + extra], "doc_id long, text string, lang string, n long, reasons string")
    got = [r.doc_id for r in S.found(df).collect()]
    assert len(got) == len(set(got)) and not set(got) & {5000, 5001, 5002, 5003, 5004}
    assert len(spam & set(got)) >= 0.9 * len(spam) and len(spam & set(got)) >= 0.9 * len(got)


def test_languages_never_learned_keep_their_sentences(spark):
    df = spark.createDataFrame([(1, WALD, "de"), (2, WALD, None), (3, HOUSE, "xx")], "doc_id long, text string, lang string")
    assert S.found(df).count() == 0
    assert S.found(df.limit(0)).count() == 0


def test_very_long_page():
    page = "\n\n".join(f"{HOUSE} {i}" for i in range(3000))
    assert len(S.blocks(page, frozenset(GLUE["en"]))) == 3000


def test_short_paragraphs_of_a_page_are_judged_together():
    page = "\n\n".join(["tulip sale", "sale bulbs", "bulbs tulip"] * 10)
    (chars, m, content), = S.blocks(page, frozenset(GLUE["en"]))
    assert m["n"] == 60 and m["rep"] > 0.8 and len(content) == 60 and chars > 200


def test_links_of_any_domain():
    assert S.measure("tulipa.beispiel/rot/1 siehe www.garten.xyz und [a](b)", None)[0]["link"] > 0.7
    assert S.measure("Der Satz endet hier.Der andere beginnt. Vgl. S. 3.5 usw.", None)[0]["link"] == 0
