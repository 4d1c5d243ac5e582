"""Problem 6: filling fixed-capacity containers with items.

Method: vector best-fit.  An item has three sizes (tokens, one document, and an
attention cost that grows with the square of its tokens), a container a residual
of each; an item goes to the open container that it fits in every constraint and
for which the weighted dot product of item and residual is least (the tightest
fit), ties going to the smaller norm of what is left.  Both further constraints
bind: a container takes one document for each DOC_TOKENS of its capacity, and an
item that alone exceeds the cost stands alone and is marked.

Items are spread over shards of a bounded number of tokens by a hash of their
id, so that no source, length or copy heats a shard, and each shard is packed
by one task with items in falling order of size.  What is left in containers
filled to less than REPACK is packed once more across shards, so the waste of
many half-filled last containers does not grow with the number of shards.

Sizes are tokens of a byte-level tokenizer: one for each UTF-8 byte and an end
token.  An item over the capacity alone is split into full containers and a
rest, which is packed as an item.  A null text is no item; an empty one has one
token.  Repeated rows of one doc_id are one item.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from heapq import heappop, heappush
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.lineage import cut

#: Tokens in a shard, in containers; fill below which a container is opened again.
SHARD_CONTAINERS, REPACK = 3000, 0.985
#: A container takes a document for each so many tokens of its capacity, and an attention cost of this share of the square of its capacity.
DOC_TOKENS, COST_SHARE = 64, 0.98
#: Containers that are scored for an item one by one, from the tightest in tokens on; if the best may still be behind them, all are scored together.
LOOK = 16
#: Weights of tokens, documents and attention cost in the dot product.
WEIGHTS = np.array([1.0, 0.02, 0.1])


def tokens(text: str) -> Column:
    """Tokens of a text column under the byte-level tokenizer."""
    return (F.octet_length(F.col(text)) + 1).cast("long")


def best_fit(sizes: np.ndarray, capacity: int, max_docs: int | None = None, max_cost: float | None = None) -> np.ndarray:
    """The container number of each item, all sizes at most the capacity.

    Items come in falling order of size.  Of all open containers that fit in
    every constraint, the one with the least weighted dot product of item and
    residual takes the item, ties going to the least norm of what is left, then
    to the tightest.  They are kept by residual tokens and scored from the
    tightest on until the least that any behind could score is more than the
    best; where LOOK scores do not settle it, one pass over arrays scores all.
    A container whose residual cost is too low for the items now coming is laid
    aside until they are small enough, and one that can take no item at all is
    closed, so that no search passes over it twice.  An item whose own cost
    exceeds the limit gets a container for itself.
    """
    max_cost = float(capacity) ** 2 if max_cost is None else float(max_cost)
    max_docs = max(1, capacity // DOC_TOKENS) if max_docs is None else max_docs
    w_tokens, w_docs, w_cost = WEIGHTS[0] / capacity**2, WEIGHTS[1] / max_docs**2, WEIGHTS[2] / max_cost**2
    order = np.argsort(-sizes, kind="stable")
    least = int(sizes.min()) if len(sizes) else 0
    out = np.empty(len(sizes), dtype=np.int64)
    residual: list[tuple[int, int, float]] = []  # tokens, documents, cost
    open_: list[tuple[int, int]] = []  # (residual tokens, container), ascending
    aside: list[tuple[float, int]] = []  # (-residual cost, container), a heap
    # residuals once more, by container; those of closed ones are -1
    all_tokens, all_docs, all_costs = (np.full(len(sizes), -1.0) for _ in range(3))

    def best_of_all(size: int, cost: float) -> int:
        """The place in open_ of the best container for an item that fits into one."""
        n = len(residual)
        at = np.flatnonzero((all_tokens[:n] >= size) & (all_costs[:n] >= cost))
        dots = w_tokens * size * all_tokens[at] + (w_docs * all_docs[at] + w_cost * cost * all_costs[at])
        at = at[dots == dots.min()]
        x, y, z = (all_tokens[at] - size) / capacity, (all_docs[at] - 1) / max_docs, (all_costs[at] - cost) / max_cost
        norms = x * x + y * y + z * z
        at = at[norms == norms.min()]
        b = int(at[all_tokens[at].argmin()])
        return bisect_left(open_, (residual[b][0], b))

    for k, size in zip(order.tolist(), sizes[order].tolist()):
        cost = float(size) ** 2
        while aside and -aside[0][0] >= cost:
            b = heappop(aside)[1]
            insort(open_, (residual[b][0], b))
        i, best, score, looked = bisect_left(open_, (size, -1)), None, None, 0
        further = w_docs + w_cost * cost * cost  # what documents and cost add at least
        while i < len(open_):
            b = open_[i][1]
            tokens_, docs_, cost_ = residual[b]
            if cost_ < cost:
                del open_[i]
                heappush(aside, (-cost_, b))
                continue
            dot = w_tokens * size * tokens_
            if score is not None and dot + further > score[0]:
                break
            if looked == LOOK:
                best = best_of_all(size, cost)
                break
            dot += w_docs * docs_ + w_cost * cost * cost_
            x, y, z = (tokens_ - size) / capacity, (docs_ - 1) / max_docs, (cost_ - cost) / max_cost
            norm = x * x + y * y + z * z
            if score is None or (dot, norm) < score:
                score, best = (dot, norm), i
            i, looked = i + 1, looked + 1
        if best is None:
            b = len(residual)
            residual.append((capacity, max_docs, max_cost))
        else:
            b = open_.pop(best)[1]
        tokens_, docs_, cost_ = residual[b]
        residual[b] = left = (tokens_ - size, docs_ - 1, cost_ - cost)
        out[k] = b
        if left[0] >= least and left[1] >= 1 and left[2] >= float(least) ** 2:
            insort(open_, (left[0], b))
            all_tokens[b], all_docs[b], all_costs[b] = left
        else:
            all_tokens[b] = -1.0
    return out


def _pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    pdf["bin"] = best_fit(pdf["n_tokens"].to_numpy(), int(pdf["capacity"].iloc[0]), int(pdf["max_docs"].iloc[0]), pdf["max_cost"].iloc[0])
    return pdf


ITEM = "window_name string, capacity long, max_docs long, max_cost double, shard long, doc_id long, piece_no int, tok_start long, n_tokens long"


def items(docs: DataFrame, windows: DataFrame, max_docs: int | None = None, cost_share: float = COST_SHARE) -> DataFrame:
    """An item for each document and container size; a document over the capacity gives one for each part of it."""
    sized = docs.filter("doc_id is not null and text is not null").select("doc_id", tokens("text").alias("total")).groupBy("doc_id").agg(F.max("total").alias("total"))
    small = windows.filter("capacity_tokens > 0").select("window_name", F.col("capacity_tokens").cast("long").alias("capacity")).distinct()
    both = sized.join(F.broadcast(small))  # a few container sizes, by definition of the table
    parts = both.select("window_name", "capacity", "doc_id", "total", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.col("capacity"))).alias("k", "tok_start"))
    return parts.select(
        "window_name", "capacity", (F.greatest(F.lit(1), F.floor(F.col("capacity") / DOC_TOKENS)) if max_docs is None else F.lit(max_docs)).cast("long").alias("max_docs"), (F.col("capacity").cast("double") ** 2 * cost_share).alias("max_cost"),
        "doc_id", (F.col("k") + 1).cast("int").alias("piece_no"), "tok_start", F.least("capacity", F.col("total") - F.col("tok_start")).alias("n_tokens"),
    )


def _shards(df: DataFrame, salt: str, containers: int = SHARD_CONTAINERS) -> DataFrame:
    """Items with a shard of about so many containers' tokens, by a hash of the item."""
    whole = df.groupBy("window_name").agg((F.sum("n_tokens") / F.first("capacity") / containers).alias("x")).select("window_name", F.greatest(F.lit(1), F.ceil("x")).cast("long").alias("n_shards"))
    return df.join(F.broadcast(whole), "window_name").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(salt)), F.col("n_shards"))).drop("n_shards")


def pack(docs: DataFrame, windows: DataFrame, max_docs: int | None = None, cost_share: float = COST_SHARE) -> DataFrame:
    """(window_name, bin_id, doc_id, piece_no, tok_start, n_tokens): every item in one container.

    bin_id begins with f for a full part of a split document, with c for an item
    that alone exceeds the attention cost and has a container for itself, with a
    or b for containers of the first and the second packing.
    """
    every = items(docs, windows, max_docs, cost_share)
    full = every.filter("n_tokens = capacity").withColumn("bin_id", F.concat_ws("-", F.lit("f"), "doc_id", "piece_no"))
    costly = (F.col("n_tokens") < F.col("capacity")) & (F.col("n_tokens").cast("double") * F.col("n_tokens") > F.col("max_cost"))
    lone = every.filter(costly).withColumn("bin_id", F.concat_ws("-", F.lit("c"), "doc_id", "piece_no"))
    first = _shards(every.filter((F.col("n_tokens") < F.col("capacity")) & ~costly), "one")
    names = [x.split()[0] for x in ITEM.split(", ")]
    one = cut(first.select(*names).groupBy("window_name", "shard").applyInPandas(_pack_shard, f"{ITEM}, bin long"))
    fill = one.groupBy("window_name", "shard", "bin").agg((F.sum("n_tokens") / F.first("capacity")).alias("fill"))
    judged = one.join(fill, ["window_name", "shard", "bin"])
    kept = judged.filter(F.col("fill") >= REPACK).withColumn("bin_id", F.concat_ws("-", F.lit("a"), "shard", "bin"))
    loose = _shards(judged.filter(F.col("fill") < REPACK).drop("fill", "bin", "shard"), "two").select(*names)
    two = loose.groupBy("window_name", "shard").applyInPandas(_pack_shard, f"{ITEM}, bin long").withColumn("bin_id", F.concat_ws("-", F.lit("b"), "shard", "bin"))
    cols = ["window_name", "bin_id", "doc_id", "piece_no", "tok_start", "n_tokens"]
    return full.select(cols).unionByName(lone.select(cols)).unionByName(kept.select(cols)).unionByName(two.select(cols))


def validity(packed: DataFrame, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Of each container size: window_name, docs and tokens placed, containers over a constraint, documents not placed once and whole, and whether at most 2 % more containers are used than tokens need."""
    small = windows.select("window_name", F.col("capacity_tokens").cast("long").alias("capacity")).distinct()
    bins = packed.groupBy("window_name", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.sum(F.col("n_tokens").cast("double") * F.col("n_tokens")).alias("cost")).join(F.broadcast(small), "window_name")
    over = (F.col("t") > F.col("capacity")) | (F.col("n") > F.greatest(F.lit(1), F.floor(F.col("capacity") / DOC_TOKENS))) | (F.col("n") > 1) & (F.col("cost") > COST_SHARE * F.col("capacity").cast("double") * F.col("capacity"))
    of_bins = bins.groupBy("window_name", "capacity").agg(F.count_if(over).alias("broken_bins"), F.count("*").alias("bins"), F.sum("t").alias("tokens"))
    placed = packed.groupBy("window_name", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.countDistinct("tok_start").alias("starts"))
    sizes = docs.filter("doc_id is not null and text is not null").groupBy("doc_id").agg(F.max(tokens("text")).alias("total"))
    whole = placed.join(sizes, "doc_id", "left").join(F.broadcast(small), "window_name")
    wrong = F.col("total").isNull() | (F.col("t") != F.col("total")) | (F.col("n") != F.col("starts")) | (F.col("n") != F.ceil(F.col("total") / F.col("capacity")))
    of_docs = whole.groupBy("window_name").agg(F.count("*").alias("docs"), F.count_if(F.coalesce(wrong, F.lit(True))).alias("broken_docs"))
    return of_bins.join(of_docs, "window_name").select("window_name", "docs", "tokens", "broken_bins", "broken_docs", (F.col("bins") <= 1.02 * F.ceil(F.col("tokens") / F.col("capacity")) + 2).alias("well_filled"))


def fill_report(packed: DataFrame, windows: DataFrame) -> DataFrame:
    """Containers and fill of each size: window_name, capacity, bins, items, tokens, fill, least_bins (a bound below for any packing)."""
    used = packed.groupBy("window_name").agg(F.countDistinct("bin_id").alias("bins"), F.count("*").alias("items"), F.sum("n_tokens").alias("tokens"))
    small = windows.select("window_name", F.col("capacity_tokens").cast("long").alias("capacity")).distinct()
    return used.join(F.broadcast(small), "window_name").select(
        "window_name", "capacity", "bins", "items", "tokens", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity")).alias("least_bins")
    )
