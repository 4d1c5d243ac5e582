"""Fixed values that results depend on: word lists, limits and patterns of the documents' own conventions."""

import unicodedata

# Labels of layout blocks.
TEXT_LABELS = "text ocr vertical_text abstract reference content reference_content footnote aside_text".split()
HEADING_PREFIX = {"doc_title": "# ", "abstract_title": "## ", "content_title": "## ", "paragraph_title": "### "}
FIGURE_LABELS = ["image", "chart"]
IGNORE_LABELS = ["header", "footer", "header_image", "footer_image", "number"]

# Capitalised French words that are no genus.
NON_GENUS = (
    "La Le Les Des Du Une Un Au Aux Ce Cet Cette Ces Mon Ton Son Nos Vos Leur Leurs Par Sur Sous Dans Pour Avec Sans Entre Mais Donc Lors Vers Chez Dès "
    "Il Elle Ils Elles On Nous Vous Feuilles Fleurs Fruits Tiges Racines Graines Arbuste Arbre Liane Herbe Plante Tige Feuille Fleur Fruit Graine Bois Ecorce Rameau "
    "Fig Pl Tab Obs Loc Alt Syn Type Note Voir Ref Sect Gen Var Distribution Habitat Ecologie Remarques Description Iconographie Bibliographie Noms Usages"
).split()
# Family names kept by convention.
NOM_CONS = "LEGUMINOSAE COMPOSITAE UMBELLIFERAE CRUCIFERAE LABIATAE GRAMINEAE PALMAE GUTTIFERAE".split()
# First words of headings that name no taxon.
STRUCTURAL = "CLÉ CLE FLORE GABON TAXA SOMMAIRE INDEX PUBLIÉE PUBLIEE RÉPARTITION REPARTITION EXEMPLAIRES MATÉRIEL MATERIEL NOTES NOM NOMS POUR PAR VOLUME TOME GENRE ESPÈCE ESPECE".split()
# Words that begin no binomial in captions.
SKIP_WORDS = "De Le La Les Du Des Et Par En Un Sur Avec Dans Pour".split()
# Accented letters and what they fold to.
#: Letters of one character under compatibility decomposition without marks, with that character, and the marks, which vanish; by rule, for all but Hangul.
_SINGLE, _MARKS, MANY = {}, [], {}
for _c in map(chr, [*range(0xA0, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x10000)]):
    _bare = "".join(ch for ch in unicodedata.normalize("NFKD", _c) if not unicodedata.combining(ch))
    if _bare == "":
        _MARKS.append(_c)
    elif _bare != _c and len(_bare) == 1:
        _SINGLE[_c] = _bare
    elif _bare != _c:
        MANY[_c] = _bare
#: The characters of MANY as the inside of a character class.
_at = sorted(map(ord, MANY))
_ends = [[a, b] for a, b in zip([x for x in _at if x - 1 not in set(_at)], [x for x in _at if x + 1 not in set(_at)])]
MANY_CLASS = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ends)
ACCENTS = ("".join([*_SINGLE, *_MARKS]), "".join(_SINGLE.values()))
# Capitals and small letters of French names.
UC, LC = "A-ZÀÂÆÇÉÈÊËÎÏÔŒÙÛÜŸ", "a-zàâæçéèêëîïôœùûüÿ"
# Levels of ranks.
RANK_LEVEL = {"family": 2, "genus": 3, "species": 4, "infraspecific": 5}
# Thresholds.
MIN_FIG_PX, PAGE_AREA, PAGE_CHARS = 150, 0.65, 500
TOP_FRACTION, BOTTOM_FRACTION = 0.08, 0.95
GARBAGE_SCORE, GARBAGE_PAGES, GARBAGE_FRACTION = 10, 8, 0.15
CHUNK_CHARS, CUTOFF, Y_STEP = 5000, 0.88, 2.5
HEAD_BIG, HEAD_SMALL = 1.7, 1.15
# Patterns of the markup and of names (Java syntax; explicit classes instead of \w where accents occur).
PAGE = r"<!--\s*page\s+([0-9]+)\s*-->"
HEADING = r"^(#{1,6})\s+(.*)$"
ANY_HEADING = r"^#{1,6}\s"
KEY_HEADING = r"(?i)^#{1,6}\s+(?:KEY\b|CL[EÉé]S?(?![A-Za-zÀ-ÿ0-9_]))"
KEY_LINE = r"(?i)^(?:KEY\b|CL[EÉé]S?(?![A-Za-zÀ-ÿ0-9_]))"
COUPLET = r"^([0-9]{1,2})((?:'|\"|[’′])*)\.\s"
DASH_COUPLET = r"^([0-9]{1,2})\.\s+-\s+"
BARE_DASH = r"^-\s+"
LEADERS = r"\.{2,}"
CAPITAL_HEADING = r"^(#{1,6})\s+([A-ZÀ-Ý]{4,})\s*$"
WHOLE_FAMILY = r"^[A-ZÀ-Ý]{3,}(?:CEAE|CÉES|CEES|EAE)$"
SPECIES_REFERENCE = r"^[0-9]+['\"]*\.\s+[A-Z]"
SPECIES_HEAD = r"^[A-Z][a-z]{3,}\s+[a-z]{4,}[a-z-]*(?:\s+(?:subsp|var|f)\.\s+[a-z]{3,})?\s+[A-Z(]"
YEAR = r"\b(?:1[6-9][0-9]{2}|20[0-9]{2})\b"
LATIN_DIAGNOSIS = r"(?i)\b(?:similis|affinis|differt|distincta|separatur)\b"
CAPTION_LINE = r"(?i)^(?:Figure|Fig\.|Planche|Pl\.|Tableau|Tab\.)\s*[0-9]+[A-Za-z]?\s*[.:]"
PLATE = r"(?i)\bPL\.?\s*([IVXLC]+)\b"
