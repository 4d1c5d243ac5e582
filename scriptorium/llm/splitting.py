"""Problem 2: splitting oversized items at natural boundaries.

Method: recursive bisection.  A stretch longer than the limit less the overlap
is cut at the strongest boundary near its middle (paragraph, else sentence, else
word, else anywhere), and both halves are treated alike; then each piece gets the
last overlap_chars characters before it.  Near is within NEAR of the length of
the stretch from its middle; where all units of a level would fit, no weaker
boundary is needed, and the one nearest the middle is taken wherever it stands.

Texts are read whole, each by one task; nothing is shuffled.  Limits come from
a table of a few rows, which is broadcast (its size is that of the list of
engines).  Null texts give no pieces, empty ones a single empty piece; texts
without a limit for their engine are one piece.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How far from the middle of a stretch, as a share of its length, a cut may stand where some unit must be broken anyway.
NEAR = 0.25
PARAGRAPH = re.compile(r"\n(?:[^\S\n]*\n)+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
WORD = re.compile(r"\s+")
LEVELS = ("paragraph", "sentence", "word", "hard")


def boundaries(text: str) -> list[list[tuple[int, int]]]:
    """The gaps (start, end) between paragraphs, sentences and words."""
    return [[m.span() for m in p.finditer(text)] for p in (PARAGRAPH, SENTENCE, WORD)]


def bisect(text: str, room: int) -> list[tuple[int, int, int]]:
    """(start, end, level) of consecutive stretches that cover the text, each of at most room characters.

    level: of the cut at its end (0 paragraph to 3 hard, -1 at the end of the
    text or where only blanks were parted off).  Blanks at a cut stay with the
    stretch before it as far as there is room.
    """
    gaps = [(g, [s for s, _ in g]) for g in boundaries(text)]
    out: list[tuple[int, int, int]] = []
    stack = [(0, len(text), -1)]
    while stack:
        start, end, level = stack.pop()
        if end - start <= room:
            out.append((start, end, level))
            continue
        body = text[start:end]
        first = start + len(body) - len(body.lstrip())
        last = start + len(body.rstrip())
        if last - first <= room:  # only blanks around it are too many
            if not body.strip():
                at = start + room
            else:
                at = max(last, min(end, start + room)) if last - start <= room else first
            stack.append((at, end, level))
            stack.append((start, at, -1))
            continue
        middle = (first + last) // 2
        cut = None
        for rank, (spans, starts) in enumerate(gaps):
            lo, hi = bisect_right(starts, first), bisect_left(starts, last)
            k = bisect_left(starts, middle, lo, hi)
            while lo < hi and spans[hi - 1][1] >= last:
                hi -= 1
            if lo == hi:
                continue
            near = min((spans[i] for i in (k - 1, min(k, hi - 1)) if lo <= i < hi), key=lambda s: (abs((s[0] + s[1]) / 2 - middle), s))
            ends, begins = [*starts[lo:hi], last], [first, *(spans[i][1] for i in range(lo, hi))]
            if abs((near[0] + near[1]) / 2 - middle) <= NEAR * (last - first) or all(e - b <= room for b, e in zip(begins, ends)):
                cut = (near[1], rank)
                break
        if cut is None:
            cut = (middle, 3)
        stack.append((cut[0], end, level))
        stack.append((start, cut[0], cut[1]))
    return out


def pieces(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """(doc_id, piece_no, start, body_start, end, cut_level, text) of docs (doc_id, engine, text).

    A piece is text[start:end]; text[start:body_start] repeats the end of the
    piece before it.  limits: (engine, max_chars, overlap_chars).
    """
    small = limits.groupBy("engine").agg(F.min("max_chars").alias("max_chars"), F.min("overlap_chars").alias("overlap_chars"))
    sized = docs.filter("doc_id is not null and text is not null").select("doc_id", "engine", "text").join(F.broadcast(small), "engine", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["doc_id", "piece_no", "start", "body_start", "end", "cut_level", "text"]
        for pdf in batches:
            rows = []
            for i, text, most, overlap in zip(pdf["doc_id"], pdf["text"], pdf["max_chars"], pdf["overlap_chars"]):
                if pd.isna(most) or len(text) <= most:
                    rows.append((i, 1, 0, 0, len(text), None, text))
                    continue
                overlap = 0 if pd.isna(overlap) else min(int(overlap), int(most) - 1)
                for k, (start, end, level) in enumerate(bisect(text, max(1, int(most) - overlap)), 1):
                    at = max(0, start - overlap)
                    rows.append((i, k, at, start, end, LEVELS[level] if level >= 0 else None, text[at:end]))
                if len(rows) > 2000:
                    yield pd.DataFrame(rows, columns=cols)
                    rows = []
            yield pd.DataFrame(rows, columns=cols)

    return sized.mapInPandas(run, "doc_id string, piece_no int, start int, body_start int, end int, cut_level string, text string")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, cut_level) of the extracts over their limit: the weakest boundary that the bisection had to cut at."""
    docs = spark.read.parquet(f"{sf_dir}/documents_md.parquet")
    limits = spark.read.parquet(f"{sf_dir}/chunk_limits.parquet")
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("cut_level"))
    cut = pieces(docs, limits).filter("cut_level is not null").groupBy("doc_id").agg(F.max(rank).alias("r"))
    return cut.select("doc_id", F.element_at(F.array(*map(F.lit, LEVELS)), F.col("r").cast("int")).alias("cut_level"))
