"""Plug-in points for what runs outside the engine: recognition, layout, translation.

Each engine is a function over an iterator of pandas batches, so a model is
loaded once by task and batches are read ahead lazily.  None is part of this
package; the registry holds them by name, and routing is a column.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = "doc_id string, page_num int, block_idx int, label string, content string"
Engine = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
_ENGINES: dict[str, Engine] = {}
_PARSERS: dict[str, Callable] = {}


def register(name: str, engine: Engine) -> None:
    _ENGINES[name] = engine


def register_parser(name: str, parser: Callable) -> None:
    """A parser of one key format: lines and group columns to statements."""
    _PARSERS[name] = parser


def parser(name: str) -> Callable:
    return _PARSERS[name]


def run(name: str, pages: DataFrame, schema: str = BLOCKS) -> DataFrame:
    """Pages through an engine; an unknown name is an error before any work starts."""
    return pages.mapInPandas(_ENGINES[name], schema)


def routed(has_text: Column, broken: Column) -> Column:
    """The engine for a document: text layer if there is one that is not broken, else recognition."""
    return F.when(~F.coalesce(has_text, F.lit(False)), "ocr").when(F.coalesce(broken, F.lit(False)), "ocr_fallback").otherwise("text")


def translated(texts: DataFrame, call: Callable[[str], str], least_seconds: float = 0.0) -> DataFrame:
    """(doc_id, chunk_no, text, status): chunks through a translator, paced and tried again once; failures keep the text with a marker."""
    from scriptorium.streaming.incremental import with_retry

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step, last = with_retry(call), 0.0
        for pdf in batches:
            rows = []
            for doc, no, text in zip(pdf["doc_id"], pdf["chunk_no"], pdf["text"]):
                time.sleep(max(0.0, last + least_seconds - time.monotonic()))
                last = time.monotonic()
                rows.append((doc, no, *step(text)))
            yield pd.DataFrame(rows, columns=["doc_id", "chunk_no", "text", "status"])

    return texts.select("doc_id", "chunk_no", "text").mapInPandas(go, "doc_id string, chunk_no int, text string, status string")


def _identity(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(page_num=0, block_idx=0, label="text", content=pdf["text"])[["doc_id", "page_num", "block_idx", "label", "content"]]


register("identity", _identity)


def _absent(name: str, package: str) -> Engine:
    """An engine that needs a package of its own: it says so when it is run without one registered in its place."""

    def engine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raise ImportError(f"engine {name} needs {package}; register an implementation under its name")
        yield from batches

    return engine


for _name, _package in (("render", "a PDF rasteriser"), ("layout", "a layout parser"), ("pipeline", "a document pipeline"), ("converter", "a document converter"), ("diffusion", "a diffusion model"), ("vision", "a vision model")):
    register(_name, _absent(_name, _package))
