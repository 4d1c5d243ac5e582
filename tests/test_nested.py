import json
import random

from pyspark.sql import functions as F

from scriptorium.operators import nested

SCHEMA = "dataset_id long, payload string, rec string, tab string, doc string"


def links(spark, payloads):
    rows = [(i, p, "x", "y", "z") for i, p in payloads]
    return sorted(tuple(r) for r in nested.key_links(spark.createDataFrame(rows, SCHEMA)).collect())


def test_shapes_give_the_same(spark):
    others = [(10 + i, json.dumps({"genus_links": {f"G{i}": "k", f"H{i}": "m"}, "figures": {f"a{i}:b": {"path": "p"}, f"c{i}:d": {"path": "q"}}, "keys": {f"k{i}": {"nodes": {"1": {"num": 1}, "2": {"num": 2}}}, "m": {"nodes": {}}}})) for i in range(5)]
    mapped = {"default_key": "k1", "genus_links": {"G": "k2", "H": None}, "figures": {"a:b": {"path": "p"}, "c:d": None}, "keys": {"k1": {"nodes": {"1": {"num": 1}, "1'": None}}}}
    listed = {"data": {"default_key": "k1", "genus_links": [{"genus": "G", "key": "k2"}, {"genus": "H", "key": None}], "figures": [{"slug": "a:b"}, None], "keys": json.dumps([{"id": "k1", "nodes": [{"node_key": "1"}, None]}])}}
    want = [("default_key", "", "k1"), ("figure", "", "a:b"), ("genus_link", "k2", "G"), ("key", "", "k1"), ("node", "k1", "1")]
    assert [r[1:] for r in links(spark, [(1, json.dumps(mapped)), *others]) if r[0] == 1] == want
    assert [r[1:] for r in links(spark, [(1, json.dumps(listed)), *others]) if r[0] == 1] == want


def test_children_carry_their_lineage(spark):
    deep = {"keys": [{"nodes": [{"node_key": "1", "children": [{"node_key": "2", "children": [{"num": 3, "prime": "'", "children": None}]}]}], "id": "k"}]}
    got = [r[1:] for r in links(spark, [(1, json.dumps(deep))])]
    assert got == [("key", "", "k"), ("node", "k", "1"), ("node", "k/1", "2"), ("node", "k/1/2", "3'")]


def test_nothing_from_bad_records(spark):
    bad = [(1, None), (2, ""), (3, '{"keys": {"k": '), (4, "7"), (5, '{"default_key": NaN}'), (6, "{}"), (None, '{"default_key": "k"}')]
    assert links(spark, bad) == []


def test_repeated_rows_once_and_empty_table(spark):
    doc = json.dumps({"keys": [{"id": "k"}]})
    assert links(spark, [(1, doc), (1, doc)]) == [(1, "key", "", "k")]
    assert links(spark, []) == []


def test_long_record(spark):
    doc = json.dumps({"keys": {f"k{i}": {"nodes": {str(j): {"text": "x" * 200} for j in range(20)}} for i in range(300)}})
    assert len(links(spark, [(1, doc)])) == 300 + 6000


def test_tables_keep_parents(spark):
    doc = json.dumps({"default_key": "k", "meta": {"title": "T"}, "keys": {"k": {"start": 1, "nodes": {"1": {"num": 1, "notes": {"by": "A"}}, "2": {"num": 2}}}, "l": {"start": 1, "nodes": None}}})
    tables = nested.key_tables(spark.createDataFrame([(1, doc, "", "", "")], SCHEMA))
    key, node = tables["keys"].orderBy("row_id").first(), tables["nodes"].orderBy("row_id").first()
    assert node.parent_id == key.row_id and node.lineage == ["k"] and node["notes.by"] == "A"
    assert tables["datasets"].first()["meta.title"] == "T"


def test_against_brute_force(spark, data):
    df = spark.read.parquet(f"{data}/key_datasets.parquet")

    def walk(payload):
        try:
            doc = json.loads(payload)
        except (TypeError, ValueError):
            return
        doc = doc.get("data", doc)
        members = lambda c, key: (c.items() if isinstance(c, dict) else [(x.get(key), x) for x in c or [] if x])
        if doc.get("default_key") is not None:
            yield "default_key", "", doc["default_key"]
        for g, k in members(doc.get("genus_links"), "genus"):
            k = k.get("key") if isinstance(k, dict) else k
            if k is not None:
                yield "genus_link", k, g
        for s, f in members(doc.get("figures"), "slug"):
            if f is not None:
                yield "figure", "", s
        keys = doc.get("keys")
        stack = [("", k, v) for k, v in members(json.loads(keys) if isinstance(keys, str) else keys, "id") if v is not None]
        yield from (("key", "", k) for _, k, _ in stack)
        stack = [(k, n, v) for _, k, key in stack for n, v in members(key.get("nodes"), "node_key") if v is not None]
        while stack:
            parent, n, v = stack.pop()
            yield "node", parent, n
            stack += [(f"{parent}/{n}", m, w) for m, w in members(v.get("children"), "node_key") if w is not None]

    want = {(r.dataset_id, *t) for r in df.collect() for t in walk(r.payload)}
    assert {tuple(r) for r in nested.key_links(df).collect()} == want


ROLES = (frozenset({"crew", "prices"}), frozenset({"crew", "prices", "log", "ship"}))


def rows_of(doc, roles=ROLES):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    return [(t, k, parent, label, dict(f)) for _, t, _, k, parent, _, label, _, _, f in nested.grouped(1, text, *roles)]


def test_unknown_schema_is_learned(spark):
    rng = random.Random(1)
    docs = []
    for i in range(40):
        crew = {f"p{rng.randint(0, 10**6)}": {"age": rng.randint(20, 60), "ports": [{"at": "x", "days": d, "tags": ["a", "b"]} for d in range(2)]} for _ in range(3)}
        docs.append((i, json.dumps({"ship": {"name": f"s{i}", "built": {"year": 1900 + i, "yard": "y"}}, "crew": crew, "prices": {f"c{rng.randint(0, 10**6)}": 1.5 for _ in range(4)}, "log": [[1, 2], [3]]}), "", "", ""))
    df = spark.createDataFrame(docs, SCHEMA)
    maps, containers = nested.learned(df, "dataset_id", "payload")
    assert maps == {"crew", "prices"} and {"ship", "built", "crew", "prices", "log", "ports", "tags"} <= containers
    flat = nested.flatten(df, "dataset_id", "payload")
    got = {r.tab: r.n for r in flat.groupBy("tab").agg(F.count("*").alias("n")).collect()}
    assert got == {"": 40, "crew": 120, "crew.ports": 240, "crew.ports.tags": 480, "prices": 160, "log": 80, "log[]": 120}
    first = flat.filter("tab = '' and rec_id = 0").first()
    assert first.fields == {"ship.name": "s0", "ship.built.year": "1900", "ship.built.yard": "y"}
    assert nested.triples(flat.filter("tab = 'prices'")).count() == 160


def test_lists_inside_collections_stay():
    rows = rows_of({"crew": {"a": {"ports": [{"tags": ["x", None, "y"]}], "n": 1}}})
    assert rows == [("", 0, -1, "", {}), ("crew", 1, 0, "a", {"n": "1"}), ("crew.ports", 2, 1, "", {}), ("crew.ports.tags", 3, 2, "", {"value": "x"}), ("crew.ports.tags", 4, 2, "", {"value": "y"})]


def test_members_of_one_name_are_entries_of_their_own():
    rows = rows_of('{"crew": {"a": {"n": 1}, "a": {"n": 2}}, "x": 1, "x": 2}')
    assert [r[4] for r in rows] == [{"x": "2"}, {"n": "1"}, {"n": "2"}]


def test_deep_records_and_strings_that_hold_json():
    deep = '{"a":' * 5000 + "1" + "}" * 5000
    assert list(rows_of(deep)[0][4].values()) == ["1"]
    assert rows_of({"ship": json.dumps({"crew": {"a": {"n": 1}}}), "note": "{not json"})[1:] == [("ship.crew", 1, 0, "a", {"n": "1"})]
    assert rows_of({"ship": "{broken"}) == [("", 0, -1, "", {"ship": "{broken"})]


def plain_json(rng, depth=0):
    r = rng.random()
    if depth > 3 or r < 0.4:
        return rng.choice([None, True, False, 0, -1.5e10, "", "é\n\"x", "\ud83d\ude00", 12345678901234567890])
    if r < 0.7:
        return [plain_json(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["a", "crew", "x y", "\t"]): plain_json(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def test_reads_what_a_parser_reads():
    rng = random.Random(2)
    for _ in range(3000):
        doc = plain_json(rng)
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        if rng.random() < 0.5 and text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "x", ",", "}", "]", '"', "\\", "0"]) + text[at + rng.randint(0, 1) :]
        try:
            want = isinstance(json.loads(text, parse_constant=lambda x: 1 / 0), (dict, list))
        except (ValueError, ZeroDivisionError):
            want = False
        groups = nested.Groups(*ROLES)
        assert nested.read(text, groups) == want, text

        def leaves(v):
            return sum(map(leaves, v.values() if isinstance(v, dict) else v)) if isinstance(v, (dict, list)) else v is not None

        if want and rng.random() < 1 and "crew" not in text:
            assert sum(len(r[4]) for r in groups.rows) == leaves(json.loads(text))


def test_maps_are_learned_on_all_records(spark):
    rng = random.Random(4)
    docs = [json.dumps({"no": i, "ship": {"name": f"s{i}"}}) for i in range(3000)] + [json.dumps({"no": i, "rare": {f"k{rng.randint(0, 10**6)}": {"at": i, "n": 1} for _ in range(3)}}) for i in range(2)]
    df = spark.createDataFrame([(i, d, "", "", "") for i, d in enumerate(docs)], SCHEMA)
    maps, containers = nested.learned(df, "dataset_id", "payload")
    assert maps == {"rare"} and {"ship", "rare"} <= containers
    assert nested.flatten(df, "dataset_id", "payload").filter("tab = 'rare'").count() == 6


def test_maps_are_learned_on_records_too_deep_for_a_parser_that_calls_itself(spark):
    deep = '{"no": 1, "deep": ' + '{"a": ' * 60_000 + "1" + "}" * 60_000 + ', "crew": {"p1": {"age": 1}, "p2": {"age": 2}}}'
    df = spark.createDataFrame([(1, deep, "", "", ""), (2, '{"b": {"\\ud800": 1, "c": [NaN]}}', "", "", ""), (3, '{"\\ud800": {}}', "", "", "")], SCHEMA)
    maps, containers = nested.learned(df, "dataset_id", "payload")
    assert maps == {"crew"} and "b" not in containers
