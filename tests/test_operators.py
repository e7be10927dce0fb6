import hashlib
import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from strandworks.functions import records, text
from strandworks.operators import catalog, decide, evaluate, generate, media, profile, ranking, rules, search, toolcalls, violations


def test_text_forms(table):
    rows = table([(" A  B\t", "Aaj_Tak.in!", "0.10.2", None), (None, "", "x", "a/b c")], "a string, b string, c string, d string")
    got = rows.select(text.collapse(F.col("a")), text.token(F.col("b")), text.stable_id(F.lit("p"), F.col("b")), text.token_estimate(F.col("a")), text.semver(F.col("c")), text.safe_segment(F.col("d"))).collect()
    assert tuple(got[0])[:4] == ("a b", "aaj_tak.in", "p_aaj_tak_in", 2) and tuple(got[0][4]) == (0, 10, 2)
    assert tuple(got[1])[:4] == (None, "unknown", "p_unknown", 0) and got[1][4] is None and got[1][5] == "a_b_c"


def test_both_term_extractions_differ(table):
    row = table([("The pop-rock Hindi_films",)], "t string").select(text.index_terms(F.col("t")), text.query_terms(F.col("t"))).first()
    assert row[0] == ["the", "poprock", "hindi", "films"] and row[1] == ["pop", "rock", "hi", "movies"]


def test_global_rank_with_ties_and_groups(spark, table):
    rows = [(i % 3 == 0, 7 if i % 2 else i, i) for i in range(200)]
    got = values(ranking.global_rank(table(rows, "g boolean, v int, id int"), ["v", "id"], ["g"]))
    for g in (True, False):
        own = sorted((v, i) for h, v, i in rows if h == g)
        assert sorted((r, v, i) for h, v, i, r in got if h == g) == [(r, v, i) for r, (v, i) in enumerate(own)]
    assert ranking.global_rank(table([], "v int, id int"), ["v", "id"]).count() == 0


def test_order_statistics_are_exact(table):
    rows = table([("a", v) for v in [5, 1, None, 9, 9, 2]] + [("b", 4)], "g string, v int")
    got = values(ranking.order_statistics(rows, "v", ["g"], {"p95": profile.p95_index(), "first": F.lit(0)}))
    assert got == [("a", 5, 9, 1), ("b", 1, 4, 4)]


def test_split_sizes_and_determinism(table):
    rows = table([(i,) for i in range(20)], "id int")
    one = values(ranking.hashed_split(rows, "id", 3, 0.8, 0.1))
    assert one == values(ranking.hashed_split(rows.repartition(5), "id", 3, 0.8, 0.1))
    assert sorted(s for _, s in one) == ["test"] * 2 + ["train"] * 16 + ["validation"] * 2


def test_profile_of_three_rows_with_a_duplicate(table):
    got = profile.profile(table([("x y",), (" X  y",), ("z",), (None,)], "t string"), "t").first().asDict()
    assert (got["total"], got["valid"], got["invalid"], got["duplicates"], got["schema_validity"], got["tokens_max"]) == (4, 3, 1, 1, 0.75, 2)
    empty = profile.profile(table([], "t string"), "t").first().asDict()
    assert empty["total"] == 0 and empty["schema_validity"] == 0.0 and empty["tokens_p95"] is None


def test_leakage_states_the_first_exact_text_only(table):
    train = table([(1, "A b"), (2, "a  b"), (3, None)], "id int, t string")
    asked = table([(1, "A b"), (2, "a  b"), (3, "c"), (4, None)], "id int, t string")
    assert values(profile.leakage(train, asked, "id", "t")) == [(1, 2, 3)]


ASSETS = [
    ("iptv_news", "Harbour News", "iptv", "live_channel", ["hi"], ["news"], "u1", {"country": "IN", "availability": '{"live":true}', "quality": '{"resolution":"hd"}'}),
    ("iptv_films", "Lagoon Movies", "iptv", "live_channel", ["mr"], ["movies"], "u2", {"live": "false"}),
    ("iptv_delhi", "Delhi Report", "iptv", "video", ["hi"], ["news"], "u3", {}),
    ("iptv_mute", "Harbour Mute", "iptv", "video", ["hi"], ["news"], "  ", {}),
    ("iptv_null", None, None, None, None, None, "u5", None),
]
SCHEMA = "id string, title string, provider string, type string, languages array<string>, genres array<string>, stream_uri string, metadata map<string,string>"


def test_search_scores_constraints_and_quirks(table):
    assets = table(ASSETS, SCHEMA)
    best = search.search(assets, "Play Harbour News", {"genre": "news", "language": "hi"}).collect()
    assert [r["id"] for r in best] == ["iptv_news", "iptv_delhi"] and [round(r["score"], 2) for r in best] == [14.05, 7.55]
    assert best[0]["explanation"] == "matched term 'harbour'; matched term 'news'; matched genre=news; matched language=hi"
    floor = search.search(assets, "zzz", {}, 10).collect()
    assert [r["score"] for r in floor] == [0.05] * 4 and "iptv_mute" not in [r["id"] for r in floor]
    # "hindi" means "hi", which Delhi's title contains
    assert {r["id"]: round(r["score"], 2) for r in search.search(assets, "hindi", {}).collect()}["iptv_delhi"] == 4.05
    # availability says live, so asking for live=false finds it too
    assert [r["id"] for r in search.search(assets, "", {"live": "false"}).collect()] == ["iptv_news", "iptv_films"]
    assert search.search(assets, "", {"audience": "kids"}).count() == 0
    assert search.resume(assets).first()["id"] == "iptv_films" and search.play(assets, item_id="iptv_delhi").first()["id"] == "iptv_delhi"
    assert search.resolve(assets, "iptv_mute").count() == 0 and search.history(assets).count() == 0


def test_commands(table):
    rows = table([(1, "a"), (5, "b"), (None, "c")], "n int, s string")
    keep = lambda *f: [r["s"] for r in rows.where(search.compile_command(list(f))).orderBy("s").collect()]
    assert keep(("n", "range", (1, 4))) == ["a"] and keep(("n", "neq", 1)) == ["b"] and keep(("s", "in", ("a", "c"))) == ["a", "c"] and keep() == ["a", "b", "c"]
    with pytest.raises(ValueError):
        search.compile_command([("n", "like", 1)])


def test_violations_collect_and_fail_fast(table):
    rows = table([("e1", " ", "verified"), ("e1", "n", "odd"), (None, "n", None)], "id string, name string, status string")
    found = violations.together(violations.rows_failing(rows, "id", violations.filled("id", "name") | violations.one_of("status", catalog.STATUSES)), violations.repeated(rows, ["id"], "unique"))
    assert values(found, "check", "row_key") == [("id is filled", None), ("name is filled", "e1"), ("status is known", "e1"), ("status is known", None), ("unique", "e1")]
    with pytest.raises(violations.ViolationError):
        violations.fail_fast(found)
    violations.fail_fast(found.limit(0))
    parents = table([("p",)], "id string")
    assert values(violations.unknown_references(table([(1, "p"), (2, "q"), (3, None)], "k int, ref string"), "k", "ref", parents, "id"), "row_key") == [("2",)]


def test_locations(table):
    rows = table([("a/b.py", 1, 2), ("/a", 1, 2), ("a/../b", 1, 2), ("a\\b", 1, 2), ("a", 0, 2), ("a", 3, 2), (None, 1, 1)], "path string, s int, e int").withColumn("i", F.monotonically_increasing_id())
    bad = violations.rows_failing(rows, "path", violations.safe_location("path", "s", "e"))
    assert [r["check"] for r in bad.collect()].count("path is relative") == 4 and bad.count() == 6


def test_tool_calls(table):
    rows = table([(" <open_route>{target:home, now,title:T}</open_route> ",), ("<a>{}</a>",), ("<a>{x:1}</b>",), (None,), ("<f>{query:a,query:b:c}</f>",)], "t string")
    got = [r[0] for r in rows.select(records.tool_call(F.col("t"))).collect()]
    assert got[0]["tool"] == "open_route" and got[0]["args"] == {"target": "home, now", "title": "T"}
    assert got[1]["args"] == {} and got[2] is None and got[3] is None and got[4]["args"] == {"query": "b:c"}


@pytest.mark.parametrize(("said", "found"), [('x {"a": "}\\"{"} y {', '{"a": "}\\"{"}'), ("none", None), ("{", None), (None, None), ('{"a":{"b":1}}', '{"a":{"b":1}}')])
def test_first_json_object(said, found):
    assert records.first_json_object(said) == found


def action(**changes):
    import json

    base = {"abstain": False, "answer": None, "citations": [], "entities": [{"type": "t", "query": "q"}], "evidence_policy": {"p": True}, "intent": "metadata_lookup", "reason": None, "relationship_types": ["OWNED_BY"], "requires_live_data": False, "schema_version": "1.0", "tool_call": None}
    return json.dumps(base | changes)


def test_contract_metrics_and_labels(table):
    live = {"intent": "live_data_lookup", "requires_live_data": True, "tool_call": {"tool": "t1", "arguments": {}, "purpose": "p", "mode": "read_only"}}
    grounded = {"intent": "grounded_answer", "answer": "yes", "citations": ["E1"]}
    pairs = [
        (1, action(), action(relationship_types=["OWNED_BY", "OWNED_BY"])),
        (2, action(**grounded), action(**grounded | {"citations": []})),
        (3, action(**live), action(**live | {"tool_call": {"tool": "evil", "arguments": {}, "purpose": "p", "mode": "read_only"}})),
        (4, action(), "{broken"), (5, action(), None),
    ]
    rows = evaluate.compared(table(pairs, "id int, e string, p string"), "e", "p", ["t1"], ["p"])
    got = evaluate.action_metrics(rows).first().asDict()
    assert (got["schema_valid_rate"], got["intent_accuracy"], got["relationship_exact_accuracy"]) == (0.4, 0.6, 0.6)
    assert (got["tool_call_accuracy"], got["citation_coverage"], got["unsupported_claim_rate"], got["unsafe_action_rate"]) == (0.0, 0.0, 0.2, 0.2)
    labels = {r["id"]: r["labels"] for r in evaluate.error_labels(rows).collect()}
    assert labels[4] == labels[5] == ["parse_error", "schema_invalid", "exact_action_mismatch"]
    assert labels[3] == ["tool_call_mismatch", "unsafe_tool", "exact_action_mismatch"]
    assert {r["label"]: r["n"] for r in evaluate.label_counts(rows).collect()}["parse_error"] == 2
    empty = evaluate.action_metrics(rows.limit(0)).first()
    assert empty["n"] == 0 and empty["tool_call_accuracy"] == 0.0


def test_gates_need_checks(table):
    metrics = table([(0.9, 0.1)], "good double, bad double")
    checked = evaluate.gates(metrics, [("good", ">=", 0.9), ("bad", "<=", 0.05), ("none", ">=", 0.0)])
    assert {r["metric"]: r["passed"] for r in checked.collect()} == {"good": True, "bad": False, "none": False}
    assert not evaluate.all_passed(checked.limit(0)).first()["passed"]


def test_routing_and_plan(table):
    results = table([("a", 0.4, "accepted"), ("b", 0.6, "accepted"), ("c", 0.9, "rejected"), ("d", None, "accepted"), ("e", 0.6, "accepted")], "question_id string, confidence double, status string")
    policies = table([("a", 0.2, "desk"), ("b", 0.7, "desk"), ("z", 0.1, "x")], "question_id string, threshold double, target string")
    got = {r["question_id"]: (r["threshold"], r["route"], r["target"]) for r in decide.route(results, policies).collect()}
    assert got == {"a": (0.5, "escalate", "desk"), "b": (0.7, "escalate", "desk"), "c": (0.5, "escalate", "intent_model"), "d": (0.5, "escalate", "intent_model"), "e": (0.5, "execute", None)}


def test_playlist_and_assets(table):
    listing = '#EXTM3U\n#EXTINF:-1 tvg-id="A.in" tvg-country="IN" tvg-language="English" group-title="Movies",Lagoon Marathi\nhttp://x/hd.m3u8\n#EXTINF:-1,One\n#EXTINF:-1,Two\n\n#EXTINF:-1 tvg-id="T"\n#NOTE\n'
    got = media.playlist_channels(table([("p", listing), ("q", None), ("r", "")], "path string, value string"))
    assert [(r["name"], r["stream_url"]) for r in got.orderBy("index").collect()] == [("Lagoon Marathi", "http://x/hd.m3u8"), ("One", ""), ("T", "")]
    asset = media.project_assets(got.where("index = 1"), "iptv", "1").first()
    assert (asset["id"], asset["language"], asset["region"], asset["resolution"], asset["genres"], asset["playable"]) == ("iptv_a_in", ["english", "mr"], "maharashtra", "hd", ["movies"], True)


def test_rules_and_generators(table, spark):
    rows = table([("Sports in HD only",), ("Tuesday news",), ("resume yesterday",), (None,)], "u string")
    got = [r[0] for r in rows.select(rules.parse_intent(F.col("u"))).collect()]
    assert got[0]["intent"] == "search" and got[0]["constraints"] == {"genre": "sports", "quality": "hd"}
    assert got[1]["constraints"] == {"genre": "news", "live": "true", "quality": "sd"} and got[2]["intent"] == "resume" and got[3]["intent"] == "recommend"
    assert rows.select(rules.parse_intent(F.lit("zzz"), service=True)).first()[0]["missing_fields"] == ["query"]
    one = generate.from_templates(spark, 30, 1, ["a {x}", "b {x} {y}"], {"x": ["1", "2"], "y": ["3"]})
    assert values(one) == values(generate.from_templates(spark, 30, 1, ["a {x}", "b {x} {y}"], {"x": ["1", "2"], "y": ["3"]}))
    queries = table([("q1",), ("q2",)], "q string")
    assert values(generate.with_prefixes(queries, "q", ["", "hey "], table([("q1",)], "instruction string"))) == [("hey q1",), ("hey q2",), ("q2",)]


def test_balanced_quota_and_threshold(table):
    rows = table([(i, "ab"[i % 2]) for i in range(20)] + [(50, None)], "id int, f string")
    got = [(r["f"], r["rank"]) for r in ranking.balanced(rows, "f", "id", ["a", "b"], 5).orderBy("rank", "turn").collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2), ("b", 2), ("a", 3)]
    scored = table([("g", 0.9, True), ("g", 0.8, True), ("g", 0.7, False), ("g", 0.6, True)], "g string, s double, ok boolean")
    assert values(decide.threshold_at_precision(scored, "g", "s", "ok", 0.7)) == [("g", 0.6, 0.75, 1.0)]
    assert math.isclose(0.75, 0.75)


def test_tool_calls_by_their_rules(spark, table):
    said = [
        ("<open_route>{target:Home}</open_route>", "<open_route>{target: home }</open_route>"), ("<open_route>{target:a}</open_route>", None), ("I cannot.", "No."), ("I cannot.", "<open_route>{}</open_route>"),
        ("<query_lifetrack_status>{query:my steps today}</query_lifetrack_status>", "<query_lifetrack_status>{query:steps}</query_lifetrack_status>"), ("<query_lifetrack_status>{query:x}</query_lifetrack_status>", "<query_lifetrack_status>{}</query_lifetrack_status>"),
        ("<schedule_notification>{title:T,message:M,hour:7,minute:5,repeat_daily:True}</schedule_notification>", "<schedule_notification>{message:M,title:T,hour:07,minute:05,repeat_daily:true}</schedule_notification>"),
        ("<read_calendar_events>{date:2024-01-02}</read_calendar_events>", "<read_calendar_events>{date:2024-01-02,end_date:x}</read_calendar_events>"), ("<no_such_tool>{}</no_such_tool>", "<no_such_tool>{}</no_such_tool>"), ("<get_current_date_time>{}</get_current_date_time>", "<get_current_date_time>{query:x}</get_current_date_time>"),
    ]
    rows = toolcalls.compared(table([(i, *x) for i, x in enumerate(said)], "i int, expected string, tool_said string"), "expected", "tool_said")
    assert [tuple(r)[3:] for r in rows.orderBy("i").collect()] == [
        (True, "open_route", True, True, False, False), (True, "open_route", False, False, False, True), (False, None, False, False, False, True), (False, None, False, False, False, False),
        (True, "query_lifetrack_status", True, True, False, False), (True, "query_lifetrack_status", True, False, False, False), (True, "schedule_notification", True, True, True, False),
        (True, "read_calendar_events", True, True, False, False), (True, "no_such_tool", True, False, True, False), (True, "get_current_date_time", True, True, False, False)]
    none = toolcalls.tool_metrics(rows.limit(0)).first()
    assert (none["tool_name_accuracy"], none["refusal_accuracy"], none["failures"]) == (1.0, 1.0, 0) and toolcalls.capabilities(spark).count() == 4


def test_the_last_prediction_of_an_input_counts(table):
    rows = table([(1, "a"), (2, "a"), (3, None)], "i int, input string")
    predictions = table([(1, "a", "old"), (2, "a", "new"), (3, None, "of null"), (4, "z", "spare")], "at int, input string, out string")
    assert values(toolcalls.last_predictions(rows, predictions, "input", "at", "out"), "i", "predicted") == [(1, "new"), (2, "new"), (3, "of null")]
    with pytest.raises(ValueError, match="missing for 1"):
        toolcalls.last_predictions(rows, predictions.where("at < 3"), "input", "at", "out")


def test_ids_of_datasets(table):
    config = {"train_ratio": 0.8, "seed": 42}
    assert profile.dataset_id("s", "t", config) == hashlib.sha256(b's::t::{"seed": 42, "train_ratio": 0.8}').hexdigest()[:16] != profile.dataset_id("s", "t", config | {"seed": 1})
    rows = table([(1, "a"), (2, None), (2, None)], "i int, t string")
    assert profile.content_hash(rows) == profile.content_hash(rows.orderBy(F.desc("i"))) != profile.content_hash(rows.distinct()) and len(profile.content_hash(rows.limit(0))) == 64
