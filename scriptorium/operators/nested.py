"""Problem 3: deeply nested semi-structured records into related flat tables.

Method: each record is parsed as a stream of members, with a stack of its own
instead of a tree, into path-value-ordinal triples.  A path's nearest repeated
ancestor (an element of an array, or an entry of an object that serves as a map)
names the group it belongs to; a group is one row of the table of its ancestors'
path, with a link to the row it hangs under, and pivoting a table takes fields
out of the group's triples.  A group is complete when its record is, so nothing
is shuffled.

Which objects are maps is not given but learned, by the name under which they
stand: their members are objects that look alike, or are many under ever other
names.  It is learned on all records, in a pass of its own whose counts are added
up and judged by name; only names of containers reach the driver.

A record is held by one task until its end, for a cut-off one must give nothing.
Null, blank or malformed records give no rows, nor do null entries; strings that
hold JSON where other records have a container are read as one.  Members that
repeat a name are entries of their own in a map; in a struct the last one holds.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Different members counted in a task before they are given out.
COUNTED = 400_000
#: An object is a map if so large a share of its members hold the commonest field of all, or if no member stands in so large a share of its instances.
ALIKE, RECURRING = 0.8, 0.5

_WS = r"[ \t\n\r]*"
_STRING = r'"[^"\\\x00-\x1f]*(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*)*"'
_SCALAR = rf"(?:{_STRING}|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)"
_VALUE = rf"(?:([{{\[])|({_SCALAR}){_WS}([,}}\]])){_WS}"
OPEN = re.compile(rf"{_WS}([{{\[]){_WS}")
MEMBER = re.compile(rf"({_STRING}){_WS}:{_WS}{_VALUE}")
ELEMENT = re.compile(_VALUE)
STRUCT, MAP, ARRAY = 0, 1, 2


def unquote(token: str) -> str:
    """The text of a JSON string; halves of a surrogate pair that stand alone are replaced."""
    if "\\" not in token:
        return token[1:-1]
    text = json.loads(token)
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if "\\u" in token else text


class Groups:
    """The rows of one record as they are read: (table, label, ordinal, parent row, fields)."""

    def __init__(self, maps: frozenset[str], containers: frozenset[str], wanted: frozenset[str] | None = None) -> None:
        self.maps, self.containers, self.wanted = maps, containers, wanted
        self.rows: list[tuple[str, str, int, int, dict[str, str]]] = []

    def row(self, table: str, label: str, ordinal: int, parent: int) -> int:
        self.rows.append((table, label, ordinal, parent, {}))
        return len(self.rows) - 1

    def field(self, row: int, path: str, value: str) -> None:
        if self.wanted is None or path in self.wanted or path.rpartition(".")[2] in self.wanted:
            self.rows[row][4][path] = value


# A frame: kind, row, path in the row, table, name, next ordinal.
def read(text: str, groups: Groups, start: tuple | None = None) -> bool:
    """Put the groups of a text into groups; False if it is no JSON.

    start: the frame in which the text stands, where it is a string within a record.
    """
    m = OPEN.match(text)
    if not m:
        return False
    maps, rows, wanted, containers = groups.maps, groups.rows, groups.wanted, groups.containers
    stack: list[tuple] = []
    if start:
        kind, row, path, table, name = start
        if m.group(1) == "[":
            kind, path, table = ARRAY, "", path if not table else f"{table}.{path}"
        elif name in maps:
            kind, path, table = MAP, "", path if not table else f"{table}.{path}"
    else:
        kind, row, path, table, name = (ARRAY if m.group(1) == "[" else MAP if "" in maps else STRUCT), groups.row("", "", 0, -1), "", "", ""
        if kind != STRUCT:
            table = "items"
    at, n, ordinal = m.end(), len(text), 0
    closer = "]" if m.group(1) == "[" else "}"
    if text[at : at + 1] == closer:
        return not text[at + 1 :].strip(" \t\n\r")
    while True:
        if kind == ARRAY:
            m = ELEMENT.match(text, at)
            if not m:
                return False
            opened, scalar, after = m.groups()
            label = field = ""
        else:
            m = MEMBER.match(text, at)
            if not m:
                return False
            field, opened, scalar, after = m.groups()
            label = field = unquote(field)
        at = m.end()
        if opened:
            closer = "]" if opened == "[" else "}"
            if kind == STRUCT:
                inner_row, inner_name, inner_path = row, field, f"{path}.{field}" if path else field
            else:
                inner_row, inner_name, inner_path = groups.row(table, label, ordinal, row), f"{name}/*" if kind == MAP else f"{name}/[]", ""
            if opened == "[" or inner_name in maps:
                inner = (ARRAY if opened == "[" else MAP, inner_row, "", f"{table}.{inner_path}" if table and inner_path else inner_path or f"{table}[]", inner_name)
            else:
                inner = (STRUCT, inner_row, inner_path, table, inner_name)
            if text[at : at + 1] != closer:
                stack.append((kind, row, path, table, name, ordinal))
                (kind, row, path, table, name), ordinal = inner, 0
                continue
            at += 1
            while at < n and text[at] in " \t\n\r":
                at += 1
            after = text[at : at + 1]
            at += 1
        elif scalar != "null":
            quoted = scalar[0] == '"'
            if kind == STRUCT:
                full = f"{path}.{field}" if path else field
                if quoted and field in containers and scalar[1:].lstrip()[:1] in ("{", "["):
                    value = unquote(scalar)
                    kept = len(rows)
                    if not read(value, groups, (STRUCT, row, full, table, field)):
                        del rows[kept:]
                        groups.field(row, full, value)
                elif wanted is None or field in wanted or full in wanted:
                    rows[row][4][full] = unquote(scalar) if quoted else scalar
            else:
                groups.field(groups.row(table, label, ordinal, row), "value", unquote(scalar) if quoted else scalar)
        ordinal += 1
        # what comes behind the value: the next member, or ends of containers
        while after != ",":
            if after != ("]" if kind == ARRAY else "}"):
                return False
            if not stack:
                return not text[at:].strip(" \t\n\r")
            kind, row, path, table, name, ordinal = stack.pop()
            ordinal += 1
            while at < n and text[at] in " \t\n\r":
                at += 1
            after = text[at : at + 1]
            at += 1
        while at < n and text[at] in " \t\n\r":
            at += 1


OwnKey = Callable[[str, str, int, dict[str, str]], str]
ROWS = "rec_id long, tab string, name string, row_id int, parent_id int, ordinal int, label string, own_key string, lineage array<string>, fields map<string,string>"
_ARROW = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.string())]


def by_label(name: str, label: str, ordinal: int, fields: dict[str, str]) -> str:
    """The key of a row where nothing else is known: its name in a map, its number in an array."""
    return label or str(ordinal)


def grouped(rec: int, text: str | None, maps: frozenset[str], containers: frozenset[str], own_key: OwnKey = by_label, wanted: frozenset[str] | None = None) -> list[tuple]:
    """The rows (ROWS) of one record; none for one that is no JSON, or holds neither object nor array."""
    if not text:
        return []
    groups = Groups(maps, containers, wanted)
    if not read(text, groups):
        return []
    own: list[str] = []
    around: list[list[str]] = []
    out = []
    for k, (table, label, ordinal, parent, fields) in enumerate(groups.rows):
        name = table.rpartition(".")[2]
        own.append(own_key(name, label, ordinal, fields) if k else "")
        around.append([*around[parent], own[parent]] if parent > 0 else [])
        out.append((rec, table, name, k, parent, ordinal, label, own[k], around[k], list(fields.items())))
    return out


# --- which names hold maps ---------------------------------------------------


class _Members(list):
    """An object with all its members, those of one name too."""

    __slots__ = ()


class _Seen:
    """What is counted of the objects that stand under one name."""

    __slots__ = ("instances", "objects", "others", "arrays", "members", "fields")

    def __init__(self) -> None:
        self.instances = self.objects = self.others = self.arrays = 0
        self.members: dict[str, int] = {}
        self.fields: dict[str, int] = {}

    def add(self, pairs: _Members) -> int:
        """Count an object; gives how many members and fields were not there before."""
        self.instances += 1
        members, fields = self.members, self.fields
        before = len(members) + len(fields)
        for k, v in pairs:
            members[k] = members.get(k, 0) + 1
            if v.__class__ is _Members:
                self.objects += 1
                for f, _ in v:
                    fields[f] = fields.get(f, 0) + 1
            elif v is not None:
                self.others += 1
        return len(members) + len(fields) - before

    def rows(self, name: str) -> list[tuple]:
        single = (("instance", self.instances), ("object", self.objects), ("other", self.others), ("array", self.arrays))
        return [(name, k, "", n) for k, n in single if n] + [(name, "member", k, n) for k, n in self.members.items()] + [(name, "field", k, n) for k, n in self.fields.items()]


def _no_constant(token: str) -> None:
    raise ValueError(token)


_decode = json.JSONDecoder(object_pairs_hook=_Members, parse_constant=_no_constant).decode


def parsed(text: str) -> object:
    """The value of a JSON text; None if it is none."""
    try:
        return _decode(text)
    except ValueError:
        return None
    except RecursionError:
        return _deep(text)


def _deep(text: str) -> list | None:
    """As parsed, for a text nested too deep for a parser that calls itself; numbers stay text."""
    m = OPEN.match(text)
    if not m:
        return None
    whole = here = _Members() if m.group(1) == "{" else []
    stack: list[list] = []
    at, opened, n = m.end(), True, len(text)
    while True:
        closer = "}" if here.__class__ is _Members else "]"
        if opened and text[at : at + 1] == closer:
            after, at = closer, at + 1
        else:
            m = (MEMBER if closer == "}" else ELEMENT).match(text, at)
            if not m:
                return None
            *field, opened, scalar, after = m.groups()
            at = m.end()
            value = (_Members() if opened == "{" else []) if opened else None if scalar == "null" else unquote(scalar) if scalar[0] == '"' else scalar
            here.append((unquote(field[0]), value) if field else value)
            if opened:
                stack.append(here)
                here = value
                continue
        while after != ",":
            if after != ("}" if here.__class__ is _Members else "]"):
                return None
            if not stack:
                return whole if not text[at:].strip(" \t\n\r") else None
            here = stack.pop()
            while at < n and text[at] in " \t\n\r":
                at += 1
            after = text[at : at + 1]
            at += 1
        opened = None
        while at < n and text[at] in " \t\n\r":
            at += 1


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(name, kind, member, n) of the objects of records, by the name under which they stand."""
    seen: dict[str, _Seen] = defaultdict(_Seen)

    def look(value: object) -> int:
        """Count a record; gives how many members and fields were not there before."""
        fresh, stack = 0, [(value, "")]
        while stack:
            value, name = stack.pop()
            if value.__class__ is str:
                value = parsed(value)
            if value.__class__ is _Members:
                fresh += seen[name].add(value)
                entry = f"{name}/*"
                for k, v in value:
                    if v.__class__ is _Members:
                        fresh += seen[entry].add(v)  # as what the entries of a map count, should this be one
                        stack.append((v, k))
                    elif v.__class__ is list or v.__class__ is str and v.lstrip()[:1] in ("{", "["):
                        stack.append((v, k))
            elif value.__class__ is list:
                if "/" not in name:
                    seen[name].arrays += 1
                stack += [(v, f"{name}/[]") for v in value if isinstance(v, list)]
        return fresh

    def out() -> pd.DataFrame:
        rows = [r for name, s in seen.items() for r in s.rows(name)]
        seen.clear()
        return pd.DataFrame([(_whole(name), kind, _whole(k), n) for name, kind, k, n in rows], columns=["name", "kind", "member", "n"])

    fresh = 0
    for pdf in batches:
        for text in pdf["doc"]:
            fresh += look(parsed(text))
            if fresh > COUNTED:
                yield out()
                fresh = 0
    yield out()


def _whole(text: str) -> str:
    """A name as unquote gives it."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def learned(records: DataFrame, id_col: str, json_col: str) -> tuple[frozenset[str], frozenset[str]]:
    """(names of maps, names of containers), learned on all records."""
    whole = records.filter(F.col(id_col).isNotNull() & F.col(json_col).isNotNull()).select(F.col(json_col).alias("doc"))
    counts = whole.mapInPandas(_count, "name string, kind string, member string, n long").groupBy("name", "kind", "member").agg(F.sum("n").alias("n"))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("n"))
    single = [F.coalesce(F.sum(of(k)), F.lit(0)).alias(k) for k in ("instance", "object", "other")]
    judged = counts.groupBy("name").agg(*single, F.count(of("member")).alias("members"), F.coalesce(F.max(of("member")), F.lit(0)).alias("most"), F.coalesce(F.max(of("field")), F.lit(0)).alias("alike"))
    told = judged.select("name", is_map().alias("map")).filter(F.col("map") | ~F.contains("name", F.lit("/"))).collect()  # the names of containers
    maps = {r.name for r in told if r.map}
    return frozenset(k for k in maps if not k.endswith("/*") or k[:-2] in maps), frozenset(r.name for r in told if "/" not in r.name)


def is_map() -> Column:
    """Whether objects of these counts are maps: see ALIKE, RECURRING."""
    several = (F.col("instance") > 0) & (F.col("members") > 1)
    alike = (F.col("object") > 0) & (F.col("other") == 0)
    changing = (F.col("instance") > 1) & (F.col("object") == 0) & (F.col("most") < RECURRING * F.col("instance"))
    return several & F.when(alike, F.col("alike") >= ALIKE * F.col("object")).otherwise(changing)


# --- tables ------------------------------------------------------------------


def flatten(records: DataFrame, id_col: str, json_col: str, own_key: OwnKey = by_label, wanted: frozenset[str] | None = None, roles: tuple[frozenset[str], frozenset[str]] | None = None) -> DataFrame:
    """The rows (ROWS) of all records; that of the record itself has an empty table name.

    tab: path of the containers a row stands in, name: the last of them; label:
    its name in a map; lineage: the keys of the rows around it, outermost first;
    fields: its triples by path.  wanted: names of the fields that are needed.
    roles: (maps, containers) where they are known, else they are learned.
    """
    maps, containers = roles or learned(records, id_col, json_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ROWS.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for rec, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += grouped(rec, text.as_py(), maps, containers, own_key, wanted)
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names)

    whole = records.filter(F.col(id_col).isNotNull() & F.col(json_col).isNotNull()).select(F.col(id_col).cast("long").alias("rec"), F.col(json_col).alias("doc"))
    return whole.mapInArrow(run, ROWS)


def triples(flat: DataFrame) -> DataFrame:
    """(rec_id, tab, row_id, ordinal, path, value): the single triples of all groups."""
    return flat.select("rec_id", "tab", "row_id", "ordinal", F.explode("fields").alias("path", "value"))


def table(flat: DataFrame, names: tuple[str, ...], fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """The groups of tables of these names, pivoted: rec_id, row_id, parent_id, ordinal, lineage, own_key and fields, each the first of some paths that is there."""
    picks: list[Column] = [F.coalesce(*[F.element_at("fields", p) for p in paths]).alias(f) for f, paths in fields.items()]
    return flat.filter(F.col("name").isin(*names)).select("rec_id", "row_id", "parent_id", "ordinal", "lineage", "own_key", *picks)


# --- key files ---------------------------------------------------------------


def key_of(name: str, label: str, ordinal: int, fields: dict[str, str]) -> str:
    """The key of a row of a key file: its name in a map, else the field that holds it."""
    if label:
        return label
    if name in ("nodes", "children"):
        return fields.get("node_key") or fields.get("num", "") + fields.get("prime", "")
    return fields.get({"keys": "id", "figures": "slug", "genus_links": "genus"}.get(name, ""), "")


def _same(*names: str) -> dict[str, tuple[str, ...]]:
    return {n: (n,) for n in names}


def key_tables(records: DataFrame, id_col: str = "dataset_id", json_col: str = "payload") -> dict[str, DataFrame]:
    """The flat tables of key files: datasets, keys, nodes, figures, genus_links."""
    flat = flatten(records, id_col, json_col, key_of)
    return {
        "datasets": table(flat, ("",), {f: (f, f"data.{f}") for f in ("default_key", "meta.title", "meta.family", "meta.generated_at")}),
        "keys": table(flat, ("keys",), _same("display", "name", "start", "genus", "family")),
        "nodes": table(flat, ("nodes", "children"), _same("num", "prime", "text", "is_terminal", "terminal_name", "leads_to", "notes.by")),
        "figures": table(flat, ("figures",), {"path": ("path", "value"), "caption": ("caption",)}),
        "genus_links": table(flat, ("genus_links",), {"key": ("key", "value")}),
    }


def key_links(records: DataFrame, id_col: str = "dataset_id", json_col: str = "payload") -> DataFrame:
    """(dataset_id, kind, parent_key, child_key), distinct: every record of the key files tied to its parent."""
    wanted = frozenset({"default_key", "key", "value", "id", "slug", "genus", "node_key", "num", "prime"})
    flat = flatten(records, id_col, json_col, key_of, wanted)
    name, own = F.col("name"), F.nullif("own_key", F.lit(""))
    field = lambda f: F.element_at("fields", f)
    tagged = flat.filter(name.isin("", "keys", "nodes", "children", "figures", "genus_links")).select(
        F.col("rec_id").alias("dataset_id"),
        F.when(name == "keys", "key").when(name.isin("nodes", "children"), "node").when(name == "figures", "figure").when(name == "genus_links", "genus_link").otherwise("default_key").alias("kind"),
        F.when(name.isin("nodes", "children"), F.array_join("lineage", "/")).when(name == "genus_links", F.coalesce(field("key"), field("value"))).otherwise("").alias("parent_key"),
        F.when(name == "", F.coalesce(field("default_key"), field("data.default_key"))).otherwise(own).alias("child_key"),
    )
    return tagged.filter("parent_key is not null and child_key is not null").distinct()
