import json
import random

from conftest import values

from strandworks.operators.nested import _steps, flat_tables, items, latest_delivery, leaf_paths, path_triples, pivot_table, record_triples, unread
from strandworks.plans.nested_plans import QUERIES

PARTS = {"a.windows": {"territory", "offers"}, "a.windows.offers": {"kind"}}


def found(table, *texts):
    rows = table([(str(i), t, "x") for i, t in enumerate(texts)], "id string, json string, record_id string")
    return values(items(path_triples(rows, "id", "json", PARTS)), "record_id", "node", "pos", "parent_pos")


def test_lists_single_items_and_members(table):
    listed = {"a": {"windows": [{"territory": "DE", "offers": [{"kind": "x"}, None, {"kind": "y"}]}, None, {"offers": {"kind": "z"}}]}}
    single = {"a": {"windows": {"territory": "FR", "offers": [{"kind": "x"}]}}}
    keyed = {"a": {"windows": {"DE": {"offers": [{"kind": "x"}]}, "FR": None, "IN": {}}}}
    assert found(table, json.dumps(listed)) == [("0", "a.windows", "0", ""), ("0", "a.windows", "2", ""), ("0", "a.windows.offers", "0.0", "0"), ("0", "a.windows.offers", "0.2", "0"), ("0", "a.windows.offers", "2.0", "2")]
    assert found(table, json.dumps(single)) == [("0", "a.windows", "0", ""), ("0", "a.windows.offers", "0.0", "0")]
    assert found(table, json.dumps(keyed)) == [("0", "a.windows", "DE", ""), ("0", "a.windows", "IN", ""), ("0", "a.windows.offers", "DE.0", "DE")]


def test_what_has_no_triples(table):
    texts = [None, "", "{", "[1]", '"x"', "null", "{}", '{"a": null}', '{"a": {"windows": []}}', '{"a": {"windows": {}}}', '{"a": NaN}', '{"a": 1,}', '{"a": 1} x', '"{"', "[" * 50]
    assert found(table, *texts) == []
    rows = table([(f"{i:02}", t) for i, t in enumerate(texts)], "id string, json string")
    assert values(unread(path_triples(rows, "id", "json", PARTS)), "reason", "record_id") == [("blank", "01"), *[("no JSON", x) for x in ("02", "04", "10", "11", "12", "13")], *[("no object", x) for x in ("03", "05", "14")], ("null", "00")]


def test_records_held_in_strings_repeated_members_and_half_characters(table):
    inner = json.dumps({"a": {"windows": [{"territory": "DE"}, {"territory": "F\"R"}]}})
    assert found(table, json.dumps(inner), json.dumps(json.dumps(inner))) == [(str(i), "a.windows", str(k), "") for i in range(2) for k in range(2)]
    twice = '{"a": {"windows": [{"territory": "X"}]}, "a": {"windows": {"DE": {"offers": [{"kind": "k"}]}, "DE": {}}, "s": "\\ud800x"}}'
    triples = path_triples(table([("r", twice)], "id string, json string"), "id", "json", PARTS)
    assert values(triples, "node", "pos", "path", "value") == [("", "", "", None), ("", "", "a.s", "?x"), ("a.windows", "DE", "", None)]


def test_any_text_is_read_as_the_json_reader_does():
    rng = random.Random(3)

    def made(depth=0):
        r = rng.random()
        if depth and (depth > 4 or r < 0.4):
            return rng.choice([1, -2.5, 1e10, True, None, 'a"b\\é\n', "", 0])
        if depth and r < 0.7:
            return [made(depth + 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("abcdef"): made(depth + 1) for _ in range(rng.randint(0, 3))}

    for _ in range(3000):
        text = json.dumps(made(), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        if rng.random() < 0.6:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(["", ",", "}", '"', "x", "]", "1", "{", ":", "\\"]) + text[k + rng.randint(0, 1) :]
        try:
            wanted = isinstance(json.loads(text), dict)
        except ValueError:
            wanted = False
        try:
            read = bool(record_triples(text, _steps(PARTS)))
        except ValueError:
            read = False
        assert read == wanted, text


def test_deep_nesting_and_long_text(table):
    deep = '{"a":' * 100_000 + "1" + "}" * 100_000
    long = json.dumps({"a": {"windows": [{"territory": "x" * 200_000}]}})
    assert found(table, deep, long) == [("1", "a.windows", "0", "")]
    leaf = path_triples(table([("r", deep)], "id string, json string"), "id", "json", PARTS).where("path <> ''").first()
    assert (leaf["kind"], leaf["value"], len(leaf["path"])) == ("number", "1", 199_999)


def test_pivot_keeps_every_leaf(table):
    text = json.dumps({"a": {"windows": [{"territory": "DE", "n": 1.5, "tags": ["p", "q"], "deep": {"x": True, "y": None}}, {"offers": []}]}})
    triples = path_triples(table([("r", text)], "id string, json string"), "id", "json", PARTS)
    flat = {r["pos"]: r for r in pivot_table(triples, "a.windows", ["territory", "deep.x"]).collect()}
    assert flat["0"]["territory"] == "DE" and flat["0"]["deep_x"] == "true"
    assert flat["0"]["rest"] == {"n": "1.5", "tags[0]": "p", "tags[1]": "q", "deep.y": None}
    assert flat["1"]["territory"] is None and flat["1"]["rest"] == {}
    assert ("a.windows", "territory", 1, 1) in values(leaf_paths(triples))


def test_the_records_own_level_and_aliases(spark, table, tmp_path):
    texts = {"a": {"title": "x;y=z", "availability": {"live": True, "windows": [{"territory": "DE"}]}, "metadata": {"catalogue": {"season": 3}, "tags": {"mood": "calm", "x_1": None}}}, "b": {}, "c": {"quality": {"tiers": []}}}
    rows = [(k, json.dumps(v), 1) for k, v in texts.items()] + [("d", "[1]", 1)]
    table(rows, "id string, json string, at int").selectExpr("id", "json", "timestamp_seconds(at) AS ingested_at").write.parquet(f"{tmp_path}/media_assets.parquet")
    team = "array<struct<id: string, name: string, aliases: array<string>>>"
    markets = [("in", ([("t1", "Falcons", ["falcons", None, "ff"]), ("t2", "Lancers", None)],)), ("de", (None,)), ("fr", ([("t1", None, [])],))]
    table(markets, f"market string, entities struct<team: {team}>").write.parquet(f"{tmp_path}/entities_v1.parquet")
    asset = {r["record_id"]: r.asDict() for r in QUERIES["p1_assets"](spark, str(tmp_path)).collect()}
    assert sorted(asset) == ["a", "b", "c"]
    assert (asset["a"]["availability_live"], asset["a"]["metadata_catalogue_season"], asset["a"]["metadata_tags_mood"], asset["b"]["availability_live"]) == ("true", "3", "calm", None)
    assert json.loads(asset["a"]["rest"]) == {"title": "x;y=z", "metadata.tags.x_1": None} and json.loads(asset["b"]["rest"]) == {}
    assert values(QUERIES["p1_team_aliases"](spark, str(tmp_path)), "market", "pos", "parent_pos", "alias") == [("in", "0.0", "0", "falcons"), ("in", "0.2", "0", "ff")]
    assert values(QUERIES["p1_teams"](spark, str(tmp_path)), "market", "pos", "id", "name") == [("fr", "0", "t1", None), ("in", "0", "t1", "Falcons"), ("in", "1", "t2", "Lancers")]
    assert {("entities.team.aliases", "", 2, 2), ("entities.team", "name", 3, 2), ("", "title", 1, 1)} <= set(values(QUERIES["p1_leaf_paths"](spark, str(tmp_path))))


def test_found_items_are_the_rows_of_the_flat_tables(spark, table, tmp_path):
    asset = {"availability": {"windows": {"DE": {"offers": [{"kind": "x"}, None, {}]}, "FR": {}}}, "quality": {"tiers": {"label": "sd", "renditions": []}}, "metadata": {"credits": [None, {"name": "N"}]}}
    table([("a", json.dumps(asset), 1), ("b", "{", 1)], "id string, json string, at int").selectExpr("id", "json", "timestamp_seconds(at) AS ingested_at").write.parquet(f"{tmp_path}/media_assets.parquet")
    markets = [("in", ([("t1", "F", ["x", None, "y"])],)), ("in", ([("t1", "F", ["z"])],)), ("de", (None,))]  # a market in two vocabulary rows
    table(markets, "market string, entities struct<team: array<struct<id: string, name: string, aliases: array<string>>>>").write.parquet(f"{tmp_path}/entities_v1.parquet")
    found = QUERIES["p1_found"](spark, str(tmp_path))
    wanted = [("a", "credit", "1"), ("a", "offer", "DE.0"), ("a", "offer", "DE.2"), ("a", "tier", "0"), ("a", "window", "DE"), ("a", "window", "FR"), ("in", "team_alias", "0.0"), ("in", "team_alias", "0.0"), ("in", "team_alias", "0.2")]
    assert values(found, "parent_id", "child", "pos") == wanted
    grouped = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [node" in line]
    assert len(grouped) == 1, "the items come from triples grouped by their nearest repeated ancestor"
    triples = path_triples(table([("r", json.dumps(asset))], "id string, json string"), "id", "json", {"availability.windows": set(), "availability.windows.offers": {"kind"}})
    flat = flat_tables(triples, ["kind"])
    for node in ("", "availability.windows", "availability.windows.offers"):
        assert values(flat.where(f"node = '{node}'").drop("node", "n_given").withColumn("rest", flat["rest"].cast("string"))) == values(pivot_table(triples, node, ["kind"]).selectExpr("record_id", "pos", "parent_pos", "kind", "CAST(rest AS string) rest"))
    assert values(flat, "node", "pos", "kind", "n_given") == [("", "", None, 1), ("availability.windows", "DE", None, 1), ("availability.windows", "FR", None, 1), ("availability.windows.offers", "DE.0", "x", 1), ("availability.windows.offers", "DE.2", None, 1)]


def test_latest_delivery_counts_once(table):
    rows = table([("a", 1, "old"), ("a", 2, "new"), ("a", None, "undated"), (None, 3, "lost"), ("b", None, "only")], "id string, at int, json string").selectExpr("id", "timestamp_seconds(at) AS at", "json")
    assert values(latest_delivery(rows, "id", "at", "json")) == [("a", "new"), ("b", "only")]


def test_empty_table(table):
    empty = table([], "id string, json string")
    assert path_triples(empty, "id", "json", PARTS).count() == 0 and unread(path_triples(empty, "id", "json", PARTS)).count() == 0
