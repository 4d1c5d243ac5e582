"""Operators on identification keys: statements, nesting, decision graphs.

Statements of one key are bounded by the key, so ordered folds run inside a row
or a window by key, and so do walks of its graph; keys spread over the cluster.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import scalars as S
from scriptorium.functions import vocab as V

LED = re.compile(V.LEADERS)
DASH = r"\s+-\s+"


def split_run_ons(lines: DataFrame, passes: int | None = None) -> DataFrame:
    """Lines (doc_id, line_no, line) cut where ' - ' follows dotted leaders, up to so many times if a number is given; sub_no counts the parts from 0."""
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.col("line").alias("rest"))

    def step(acc: Column, _: Column) -> Column:
        rest = acc["rest"]
        lead = F.instr(rest, "..")
        tail = F.substring(rest, lead, F.length(rest))
        cut = F.regexp_instr(tail, F.lit(DASH))
        hit = (lead > 0) & (cut > 0)
        before = F.substring(rest, F.lit(1), lead + cut - 2)
        after = F.regexp_replace(F.substring(tail, cut, F.length(tail)), "^\\s+-\\s+", "- ")
        return F.struct(F.when(hit, F.concat(acc["out"], F.array(before))).otherwise(acc["out"]).alias("out"), F.when(hit, after).otherwise(rest).alias("rest"))

    # a line holds at most as many cuts as dashes with blanks around
    turns = F.greatest(F.lit(1), F.size(F.split("line", DASH)) - 1) if passes is None else F.lit(passes)
    folded = F.aggregate(F.sequence(F.lit(1), turns), empty, step, lambda acc: F.concat(acc["out"], F.array(acc["rest"])))
    parts = F.when(F.col("line").contains("..") & F.col("line").contains("-"), folded).otherwise(F.array("line"))
    return lines.select(*[c for c in lines.columns if c != "line"], F.posexplode(parts).alias("sub_no", "line"))


def dashes_to_primes(lines: DataFrame, *group: str) -> DataFrame:
    """Lines in which 'N. - text' and the bare '- text' after it become statements with prime marks, at most three.

    Only groups that hold a numbered dash line are changed; lines are ordered by
    line_no and sub_no.
    """
    w = Window.partitionBy(*group).orderBy("line_no", "sub_no")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    num = F.when(F.col("line").rlike(V.DASH_COUPLET), F.regexp_extract("line", V.DASH_COUPLET, 1).cast("int"))
    bare = F.col("line").rlike(V.BARE_DASH)
    marked = lines.withColumn("dash_", num).withColumn("num_", F.last("dash_", ignorenulls=True).over(upto)).withColumn("block_", F.count("dash_").over(upto))
    inner = Window.partitionBy(*group, "block_").orderBy("line_no", "sub_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("alt_", F.sum((bare & F.col("dash_").isNull()).cast("int")).over(inner))
    text = (
        F.when(F.col("dash_").isNotNull(), F.concat(F.col("dash_").cast("string"), F.lit(". "), F.regexp_replace("line", V.DASH_COUPLET, "")))
        .when(bare & F.col("num_").isNotNull(), F.concat(F.col("num_").cast("string"), F.expr("repeat(\"'\", cast(least(alt_, 3) as int))"), F.lit(". "), F.regexp_replace("line", V.BARE_DASH, "")))
        .otherwise(F.col("line"))
    )
    return marked.withColumn("line", text).drop("dash_", "num_", "block_", "alt_")


def couplets(lines: DataFrame, *group: str) -> DataFrame:
    """Statements of key sections: group columns, ord, num (-1 for a line passed through), prime, text, is_terminal.

    Digits are put right, run-on lines split and dashes replaced; lines that go
    on join the statement before them until a blank line, heading, comment or
    new statement; a statement ends in a taxon if it has dotted leaders, or if
    the next line that is not blank after it is a species reference, which then
    belongs to it.  What a line is is told by expressions; the fold over the
    lines of a section, which one row holds, keeps no more than the statement
    that is open.
    """
    fixed = split_run_ons(lines.withColumn("line", S.couplet_digits(F.col("line"))))
    fixed = dashes_to_primes(fixed, *group).withColumn("line", F.regexp_replace("line", r"\s+$", ""))
    line, bare = F.col("line"), F.regexp_replace("line", r"^\s+", "")
    num, prime, rest = S.couplet(line)
    kind = (
        F.when(line == "", BLANK)
        .when(line.rlike(V.ANY_HEADING) | line.startswith("<!--"), STOP)
        .when(line.rlike(V.COUPLET), F.when(S.truncated_reference(line), SOFT).otherwise(START))
        .otherwise(PLAIN)
    )
    names = S.truncated_reference(bare) | bare.rlike(V.SPECIES_REFERENCE) & ~bare.rlike(V.COUPLET)
    told = fixed.withColumn("x_", F.struct("line_no", "sub_no", "line", kind.alias("kind"), names.alias("names"), num.alias("num"), prime.alias("prime"), rest.alias("rest")))
    sections = told.groupBy(*group).agg(F.array_sort(F.collect_list("x_")).alias("ls"))
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sections.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(*own, k, *st) for *own, ls in pdf.itertuples(index=False, name=None) for k, st in enumerate(statements(ls), 1)]
            yield pd.DataFrame(rows, columns=[*group, "ord", "num", "prime", "text", "is_terminal"])

    return sections.mapInPandas(run, f"{keys}, ord int, num int, prime string, text string, is_terminal boolean")


#: What a line of a key section is: blank, heading or comment, start of a statement, a start that is a truncated reference, any other.
BLANK, STOP, START, SOFT, PLAIN = range(5)


def statements(lines: Iterable[dict]) -> list[tuple[int, str, str, bool]]:
    """(num, prime, text, is_terminal) of the statements and passed lines of a section."""
    out: list[tuple[int, str, str, bool]] = []
    head, parts, held = None, [], []  # the open statement, its text, blank lines behind it

    def close(reference: str | None = None) -> None:
        nonlocal head
        text = " ".join(parts)
        terminal = reference is not None or LED.search(text) is not None
        out.append((head["num"], head["prime"], f"{text.rstrip()} {reference}" if reference is not None else text, terminal))
        out.extend([(-1, "", "", True)] * (len(held) if reference is None else 0))
        head = None
        held.clear()

    for x in lines:
        kind = x["kind"]
        if head is not None:
            if not held and kind in (PLAIN, SOFT):
                parts.append(x["line"].strip())
                continue
            if LED.search(" ".join(parts)):
                close()
            elif kind == BLANK:
                held.append(x)
                continue
            elif x["names"]:
                close(x["line"].strip())
                continue
            else:
                close()
        if kind in (START, SOFT):
            head, parts = x, [x["rest"]]
        elif kind != BLANK or out:
            out.append((-1, "", x["line"], True))
    if head is not None:
        close()
    return out


def indented(statements: DataFrame, *group: str) -> DataFrame:
    """(group, ord, depth, md): statements as a nested list.  A stack of open numbers is folded over the statements of a key, which one row holds."""
    rows = statements.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("ord", "num", "prime", "text", "is_terminal"))).alias("cs"))
    empty = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast("array<struct<ord:int,depth:int,md:string>>").alias("out"))

    def last_index(stack: Column, test) -> Column:  # noqa: ANN001
        """The last position at which a test holds, 0 if nowhere."""
        return F.coalesce(F.array_max(F.transform(stack, lambda x, i: F.when(test(x), i + 1))), F.lit(0))

    def step(acc: Column, c: Column) -> Column:
        stack = acc["stack"]
        prime = c["prime"] != ""
        below = last_index(stack, lambda x: F.abs(x) < c["num"])
        same = last_index(stack, lambda x: F.abs(x) == c["num"])
        kept = F.when(~prime, F.slice(stack, 1, below)).otherwise(F.when(same > 0, F.slice(stack, 1, F.greatest(same - 1, F.lit(0)))).otherwise(stack))
        depth = F.size(kept)
        pushed = F.when(~prime, F.concat(kept, F.array(c["num"]))).when(~c["is_terminal"], F.concat(kept, F.array(-c["num"]))).otherwise(kept)
        text = F.concat(F.repeat(F.lit("  "), depth), F.lit("- "), c["num"].cast("string"), c["prime"], F.lit("\\. "), c["text"])
        passed = c["num"] < 0
        t = F.trim(c["text"])
        lost = passed & ((t == "") | (t == "---") | t.startswith("<!-- page"))
        row = F.array(F.struct(c["ord"].alias("ord"), F.when(passed, -1).otherwise(depth).alias("depth"), F.when(passed, c["text"]).otherwise(text).alias("md")))
        return F.struct(F.when(passed, stack).otherwise(pushed).alias("stack"), F.when(lost, acc["out"]).otherwise(F.concat(acc["out"], row)).alias("out"))

    folded = rows.select(*group, F.explode(F.aggregate("cs", empty, step, lambda acc: acc["out"])).alias("r"))
    return folded.select(*group, "r.ord", "r.depth", "r.md")


def nodes(statements: DataFrame, *group: str) -> DataFrame:
    """Decision nodes of statements: node_key, num, prime, text, is_terminal, terminal_name, leads_to; the first of a repeated key stays.

    A statement that ends in a bare number points there; one that ends in no
    taxon points to the number of the next statement without prime marks.
    """
    named = statements.filter("num >= 0").withColumn("name_", F.when(F.col("is_terminal"), S.terminal_name(F.col("text"))))
    ref = F.col("name_").rlike("^[0-9]+$")
    back = Window.partitionBy(*group).orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col("prime") == "", F.col("num")), ignorenulls=True).over(back)
    out = named.withColumn("next_", following).withColumn("ref_", F.coalesce(ref, F.lit(False)))
    out = out.select(
        *group, "ord", F.concat(F.col("num").cast("string"), "prime").alias("node_key"), "num", "prime", "text",
        (F.col("is_terminal") & ~F.col("ref_")).alias("is_terminal"), F.when(F.col("is_terminal") & ~F.col("ref_"), F.col("name_")).alias("terminal_name"),
        F.when(F.col("ref_"), F.col("name_").cast("int")).when(~F.col("is_terminal"), F.col("next_")).alias("leads_to"),
    )
    return out.withColumn("r_", F.row_number().over(Window.partitionBy(*group, "node_key").orderBy("ord"))).filter("r_ = 1").drop("r_")


def patched(base: DataFrame, patches: DataFrame) -> DataFrame:
    """Nodes (key_id, node_key, is_terminal, terminal_name, leads_to) with patches (key_id, node_key, field, value, is_null) laid over; a null that is given overrides, a field that is not given stays."""
    wide = patches.groupBy("key_id", "node_key").agg(
        *[F.max(F.when(F.col("field") == f, F.struct(F.lit(True).alias("given"), F.when(~F.col("is_null"), F.col("value")).alias("v")))).alias(f"p_{f}") for f in ("is_terminal", "terminal_name", "leads_to")]
    )
    joined = base.join(wide, ["key_id", "node_key"], "left")

    def field(name: str, kind: str) -> Column:
        return F.when(F.col(f"p_{name}.given"), F.col(f"p_{name}.v").cast(kind)).otherwise(F.col(name)).alias(name)

    return joined.select("key_id", "node_key", field("is_terminal", "boolean"), field("terminal_name", "string"), field("leads_to", "int"))


def reached(graph: DataFrame, starts: DataFrame) -> DataFrame:
    """(key_id, num, depth): statements that can be reached from the starts (key_id, num), with the least number of steps.

    A graph is that of one key, which one row holds: all graphs are walked side
    by side, breadth first, until no statement is new, so cycles end and there
    is no bound to the depth.
    """
    edges = graph.filter("leads_to is not null and num is not null").groupBy("key_id").agg(F.collect_set(F.struct("num", "leads_to")).alias("es"))
    begun = starts.filter("num is not null").groupBy("key_id").agg(F.collect_set("num").alias("ss"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, begin, es in zip(pdf["key_id"], pdf["ss"], pdf["es"]):
                out: dict[int, list[int]] = {}
                for e in es if es is not None else ():
                    out.setdefault(e["num"], []).append(e["leads_to"])
                depth = dict.fromkeys(map(int, begin), 0)
                front = list(depth)
                for at in front:  # grows while it is read
                    for to in out.get(at, ()):
                        if to not in depth:
                            depth[to] = depth[at] + 1
                            front.append(to)
                rows += [(key, num, d) for num, d in depth.items()]
            yield pd.DataFrame(rows, columns=["key_id", "num", "depth"])

    return begun.join(edges, "key_id", "left").select("key_id", "ss", "es").mapInPandas(walk, "key_id string, num int, depth int")
