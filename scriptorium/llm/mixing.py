"""Problem 7: mixing sources to target weights.

Method: weighted fair queueing.  The documents of a source are shuffled by a
hash, once for each round of repetition; a copy's virtual finish time is the
running number of its source's tokens up to and with it, divided by the
source's target weight.  All copies are put in one order by finish time and cut
off where the total reaches the budget.  A source that has used up its rounds
leaves its share to the others in proportion, as fair queueing does.

A running sum over a source that holds a third of all rows must not be one task:
copies fall into slices by the hash, sums of slices are added up first, and only
inside a slice is there a running sum.  The global order is cut the same way,
over slices of finish time.  How many rounds of a source the cut can reach is
computed from one row for each source beforehand, so no copy beyond it is made.

Sizes are tokens of the byte-level tokenizer.  Null texts and documents of
sources without a target take no part, nor do targets that are null or not
positive; repeated rows of one doc_id are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.packing import tokens
from scriptorium.operators.lineage import cut

#: Rows of a slice, and of the part of the order in which the cut falls; parts of an order that is cut.
SLICE_ROWS, PARTS = 20_000, 1024


def water_level(sources: list[tuple[str, float, int, int]], budget: float) -> float:
    """The virtual time at which sources (name, weight, tokens, most repeats) together reach the budget, or the last at which any still runs."""
    ends = sorted((w and t * r / w, w, t * r) for _, w, t, r in sources if w > 0 and t > 0 and r > 0)
    used = 0.0
    rate = sum(w for _, w, _ in ends)
    for end, w, cap in ends:
        if used + rate * end >= budget:
            return (budget - used) / rate
        used += cap
        rate -= w
    return ends[-1][0] if ends else 0.0


def mix(docs: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 7) -> DataFrame:
    """(source, doc_id, repeat_no, n_tokens, finish_time) of a mix of budget tokens (the size of docs if None)."""
    sized = docs.filter("doc_id is not null and text is not null and source is not null").select("doc_id", "source", tokens("text").alias("n_tokens"))
    sized = sized.groupBy("doc_id").agg(F.max_by(F.struct("source", "n_tokens"), F.struct("n_tokens", "source")).alias("d")).select("doc_id", "d.source", "d.n_tokens")
    goal = targets.filter("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("weight"), F.max("max_repeats").cast("int").alias("most"))
    sums = sized.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    total = budget if budget is not None else sized.agg(F.sum("n_tokens")).first()[0] or 0
    named = sums.join(goal, "source").collect()  # one row for each source of the table of targets at most
    level = water_level([(r.source, r.weight, r.t, r.most) for r in named], total)
    # the cut falls within the longest document of every source of the level
    plan = [(r.source, float(r.weight), min(r.most, int(level * r.weight // r.t) + 2), max(1, -(-int(r.n) // SLICE_ROWS))) for r in named]
    spark = docs.sparkSession
    schema = "source string, weight double, rounds int, slices long"
    rounds = spark.createDataFrame(plan, schema)
    copies = sized.join(F.broadcast(rounds), "source").withColumn("repeat_no", F.explode(F.sequence(F.lit(1), F.col("rounds"))))
    copies = copies.withColumn("key", F.xxhash64("doc_id", "repeat_no", F.lit(seed))).withColumn("slice", F.floor((F.col("key").cast("double") / F.lit(2.0**64) + 0.5) * F.col("slices")).cast("long"))
    slice_sums = copies.groupBy("source", "repeat_no", "slice").agg(F.sum("n_tokens").alias("s"))
    before = Window.partitionBy("source").orderBy("repeat_no", "slice").rowsBetween(Window.unboundedPreceding, -1)
    slice_sums = slice_sums.withColumn("before", F.coalesce(F.sum("s").over(before), F.lit(0))).drop("s")
    inside = Window.partitionBy("source", "repeat_no", "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    timed = copies.join(slice_sums, ["source", "repeat_no", "slice"]).withColumn("finish_time", (F.col("before") + F.sum("n_tokens").over(inside)) / F.col("weight"))
    return cut_off(timed.select("source", "doc_id", "repeat_no", "n_tokens", "finish_time"), total, level)


def cut_off(timed: DataFrame, budget: int, level: float, edge_rows: int = SLICE_ROWS) -> DataFrame:
    """In order, the rows first by (finish_time, source, doc_id, repeat_no) whose tokens together come nearest to the budget.

    Time is cut into PARTS; the sums of parts tell which one the budget falls
    into, and that one is cut again until it holds at most edge_rows rows or
    cannot be parted.  Only its rows are summed one by one.
    """
    timed = cut(timed)
    start, step, used = 0.0, max(level, 1e-9) / PARTS, 0
    inside, whole = F.lit(True), F.lit(False)
    while True:
        part = F.greatest(F.lit(0), F.least(F.floor((F.col("finish_time") - F.lit(start)) / F.lit(step)), F.lit(4 * PARTS))).cast("long")
        sums = timed.filter(inside).groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("s"), F.count("*").alias("n"), F.min("finish_time").alias("first"), F.max("finish_time").alias("last")).orderBy("part").collect()  # at most 4 * PARTS + 1 rows
        edge = None
        for r in sums:
            if used + r.s > budget:
                edge = r
                break
            used += r.s
        if edge is None:
            whole = whole | inside
            rest = timed.limit(0)
            break
        whole, inside = whole | inside & (part < edge.part), inside & (part == edge.part)
        if edge.n <= edge_rows or edge.first == edge.last or (edge.last - edge.first) / PARTS <= 4e-16 * edge.last:
            order = Window.partitionBy(F.lit(0)).orderBy("finish_time", "source", "doc_id", "repeat_no").rowsBetween(Window.unboundedPreceding, 0)  # the rows of one edge part
            rest = timed.filter(inside).withColumn("upto", F.lit(used) + F.sum("n_tokens").over(order)).filter(F.col("upto") - F.col("n_tokens") / 2 <= budget)
            break
        start, step = edge.first, (edge.last - edge.first) / PARTS
    names = ["source", "doc_id", "repeat_no", "n_tokens", "finish_time"]
    return timed.filter(whole).select(names).unionByName(rest.select(names)).orderBy("finish_time", "source", "doc_id", "repeat_no")  # a range sort: the mix is read in this order


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each target: source, target_share, actual_share, tokens, records, most_repeats."""
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("records"), F.max("repeat_no").alias("most_repeats"))
    every = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share")).join(used, "source", "left").na.fill(0, ["tokens", "records", "most_repeats"])
    whole = used.agg(F.sum("tokens").alias("total"))
    return every.crossJoin(F.broadcast(whole)).select(  # one row
        "source", "target_share", F.round(F.col("tokens") / F.col("total"), 9).alias("actual_share"), "tokens", "records", "most_repeats"
    )


def validity(mixed: DataFrame, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each target source: source, target_share, whether no document stands more often than allowed, and whether the share is reached as nearly as the caps of all sources allow; in each row, whether the whole has the size of docs."""
    copies = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("k")).groupBy("source").agg(F.max("k").alias("k"))
    sized = docs.filter("doc_id is not null and text is not null and source is not null").select("doc_id", "source", tokens("text").alias("n")).groupBy("doc_id").agg(F.max_by("source", "n").alias("source"), F.max("n").alias("n"))
    goal = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("most"))
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("t"))
    supply = sized.groupBy("source").agg(F.sum("n").alias("supply"), F.max("n").alias("longest"))
    every = goal.join(used, "source", "left").join(supply, "source", "left").join(copies, "source", "left").na.fill(0, ["t", "supply", "longest", "k"])
    whole = mixed.agg(F.sum("n_tokens").alias("total")).crossJoin(F.broadcast(sized.agg(F.sum("n").alias("budget"), F.max("n").alias("slack"))))  # one row
    # a source that is not used up has the same tokens for each weight as any other, to within a document
    rates = every.filter("t < supply * most and target_share > 0").agg(F.max(F.col("t") / F.col("target_share")).alias("rate"))
    near = F.when(F.col("t") >= F.col("supply") * F.col("most"), F.col("t") <= F.col("rate") * F.col("target_share") + F.col("slack")).otherwise(F.col("t") >= F.col("rate") * F.col("target_share") - F.col("slack") * F.greatest(F.lit(1.0), F.col("target_share") * 40))
    return every.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(rates)).select(  # one row each
        "source", "target_share", (F.col("k") <= F.col("most")).alias("repeats_ok"), F.coalesce(near, F.lit(True)).alias("share_ok"), (F.abs(F.col("total") - F.col("budget")) <= F.col("slack")).alias("size_ok")
    )
