"""Problems 2, 3 and 5 against brute force on small tables, and on what is null, empty, repeated, very long or oddly named."""

import itertools
import json
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandworks.llm import form_copies, lookalikes, normal, winnow

LONG = "lorem ipsum dolor " * 20_000


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_one_form():
    assert normal.canonical("Ｋａｖｅｒｉ Сооkіng​ ") == "kaveri cooking" == normal.canonical("Kaveri\xa0Cooking")
    assert normal.look("Café ﬁn\xad") == "Café fin" and normal.look("CAFE") != normal.look("Cafe") and normal.look("Café") != normal.look("Cafe")
    assert normal.canonical("Straße") == normal.canonical("STRASSE") and normal.look("​ ﻿") == "" and normal.look("a‐b") == "a-b"
    assert normal.words("Don't-stop, Ünder_score!") == "don t stop ünder score" and normal.words("हिन्दी में।") == "हिन्दी में"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_forms_are_stable(text):
    assert normal.look(normal.look(text)) == normal.look(text)
    assert normal.canonical(normal.canonical(text)) == normal.canonical(text)


def test_one_form_for_capitals_and_small_letters(spark):
    wide = normal.unicode_lookalikes(spark)
    for like in (normal.BASIC, wide):
        for word in ("МОСКВА", "ΑΘΗΝΑ", "КИНО ТВ", "ԵՐԵՎԱՆ", "ЁЖ ЙОД", "Ѳита ѵ", "STRASSE", "ΝΊΚΗ"):
            assert normal.canonical(word, like) == normal.canonical(word.lower(), like) == normal.canonical(normal.canonical(word, like), like)
        letters = [chr(c) for low, high in ((0x370, 0x590), (0x1C80, 0x1C90), (0x2C80, 0x2D00), (0xA640, 0xA6A0)) for c in range(low, high)]
        assert [c for c in letters if normal.canonical(c.upper(), like) != normal.canonical(c.lower(), like)] == []
    assert normal.look("ӀӏԌ", wide) == "Iiԍ".replace("ԍ", "G") and normal.canonical("СОР", wide) == "cop" and len(wide.as_is) > 150


def test_lookalikes_equal_brute_force(spark):
    rng = random.Random(3)
    swaps = {"a": "аａ", "e": "е", "o": "οо", " ": "\xa0 ", "m": "ｍ"}
    names = ["some lone area", "Some lone area", "some lone arena", "omen", "mae", ""]
    rows = [(f"r{i}", "".join(rng.choice([c, *swaps.get(c, "")]) if rng.random() < 0.3 else c for c in rng.choice(names)), False) for i in range(120)]
    rows += [(f"c{i}", t, True) for i, t in enumerate(["оmen", "omen", "unique"])] + rows[:5] + [(None, "omen", False), ("nul", None, False)]
    df = spark.createDataFrame(rows, "record string, text string, anchor boolean").selectExpr("*", "'x' AS canonical", "1 AS look")
    by = defaultdict(set)
    for r, t, a in rows:
        if r is not None and t is not None and normal.look(t):
            by[normal.look(t)].add((r, t, a))
    wanted = set()
    for group in by.values():
        anchored = any(a for _, _, a in group)
        for (r, t, a), (s, u, b) in itertools.combinations(sorted(group), 2):
            if r != s and t != u and (a != b if anchored else True):
                wanted.add((min(r, s), max(r, s)))
    assert values(lookalikes.lookalike_pairs(df)) == sorted(wanted, key=repr) and wanted
    assert lookalikes.lookalike_pairs(df.limit(0)).count() == 0


def test_letters_of_all_scripts_nul_and_null_anchors(spark):
    # of one skeleton in Unicode's confusables, though not of an ASCII letter, or of a script without letter case
    same = [("кино", "κинο"), ("Лук", "Λук"), ("фон", "φон"), ("Ӕon", "Æon"), ("әlma", "əlma"), ("ɑlpha", "alpha"), ("tᴏp", "top"), ("カボ", "力ボ"), ("ヘルプ", "へルプ"), ("ביס", "ביo"), ("Om\x08en", "Omen")]
    rows = [(f"{'ab'[k]}{i:02}", t, None if i % 2 else False) for i, pair in enumerate(same) for k, t in enumerate(pair)]
    # must stay apart: accents, letter case, digits, visible punctuation, and letters that one script tells apart
    rows += [(f"z{i:02}", t, None) for i, t in enumerate(["Cafe", "Café", "căn", "cǎn", "ѣ", "Ѣ", "Θ", "θ", "3", "З", "O1", "Ol", "OI", "it's", "it’s", "a-b", "a–b", "ดาว", "ตาว", "คาว", "پر", "ثر", "kız", "kiz", "ור", "ןר", "土", "士"])]
    df = spark.createDataFrame(rows, "record string, text string, anchor boolean").coalesce(1)
    assert values(lookalikes.lookalike_pairs(df)) == [(f"a{i:02}", f"b{i:02}") for i in range(len(same))]
    nul = [("a", "sound\x00s", False), ("b", "sound", False), ("c", "sоund", False), ("d", "sound\x00t", False), ("e", "sоund\x00x", False)]
    assert values(lookalikes.lookalike_pairs(spark.createDataFrame(nul, "record string, text string, anchor boolean").coalesce(1))) == [("b", "c")]
    wide = normal.unicode_lookalikes(spark)
    letters = {chr(c) for c in [*wide.as_is, *wide.folded]} | {*map(str, wide.as_is.values())}
    assert [c for c in letters if normal.look(normal.look(c, wide), wide) != normal.look(c, wide)] == []
    assert [c for c in letters if normal.canonical(normal.canonical(c, wide), wide) != normal.canonical(c, wide)] == []


def test_copies_equal_brute_force(spark):
    rng = random.Random(4)

    def vary(text):
        text = rng.choice([text, text.upper(), text.title(), f"**({text})**", f"  {text}\n\n", text.replace(" ", rng.choice(["  ", "\t", "\xa0"]))])
        return text if rng.random() < 0.5 else text.replace(".", "!").replace(",", rng.choice([" ;", ""]))

    def fields(policy):
        lines = [f"Policy: up to {policy} minutes.", "Question: Can I, please?", "Placed: Friday 12:05"]
        rng.shuffle(lines)
        return vary("\n".join(lines))

    def record(k):
        members = list({"intent": "play", "n": 0.5 + k, "tags": ["a", "b"], "c": {"x": None, "y": True}}.items())
        rng.shuffle(members)
        return json.dumps(dict(members), indent=rng.choice([None, 1]))

    made = [("t", k) for k in range(4)] + [("f", k) for k in range(4)] + [("j", k) for k in range(4)] + [("n", 0), ("e", 0)]
    rows, group = [], {}
    for i in range(150):
        kind, k = made[0] if i % 3 == 0 else rng.choice(made)  # one record holds a third of all rows
        given_ = {"t": lambda: vary(f"Order {k}, one tea."), "f": lambda: fields(k), "j": lambda: "x", "n": lambda: None, "e": lambda: rng.choice(["", " ", "..."])}[kind]()
        rows.append((i, given_, record(k) if kind == "j" else vary(f"Answer {k}."), "clash", 7))
        group[i] = (kind, k)
    rows += [(200, LONG, "x", "clash", 7), (201, LONG.upper() + "!", "X", "clash", 7), (202, LONG + "y", "x", "clash", 7)]
    group |= {200: ("L", 0), 201: ("L", 0), 202: ("M", 0)}
    df = spark.createDataFrame(rows, "row_id long, input string, output string, h1 string, copy_id int")
    first, wanted = {}, []
    for i in sorted(group):
        if group[i] in first:
            wanted.append((first[group[i]], i))
        first.setdefault(group[i], i)
    assert values(form_copies.form_copies(df, "row_id", "input", "output")) == sorted(wanted, key=repr)
    assert values(form_copies.form_copies(df.unionByName(df), "row_id", "input", "output")) == sorted(wanted, key=repr)
    counts = values(form_copies.copy_counts(df, "row_id", "input", "output"))
    assert counts == sorted(((first[g], n) for g, n in Counter(group.values()).items()), key=repr)
    assert form_copies.form_copies(df.limit(0), "row_id", "input", "output").count() == 0


def test_fields_are_a_multiset():
    a = form_copies.fields("i", '{"A b": [1, {"c": "X."}], "d": null}')
    b = form_copies.fields("i", '{"d":null,"ab":[1,{"C":"x"}]}')
    assert Counter(a) == Counter(b) and form_copies.fingerprint(a) == form_copies.fingerprint(b)
    assert form_copies.fields("i", '{"a": 1.5}') != form_copies.fields("i", '{"a": 15}')
    assert form_copies.fingerprint(form_copies.fields("i", "x") * 2) != form_copies.fingerprint(form_copies.fields("i", "x"))
    assert form_copies.fields("i", None) != form_copies.fields("i", "")


def test_winnowing_guarantee():
    rng = random.Random(1)
    for _ in range(50):
        common = "".join(rng.choice("abcdefgh") for _ in range(winnow.WINDOW + winnow.GRAM - 1))
        a = "".join(rng.choice("stuv") for _ in range(40)) + common + "".join(rng.choice("stuv") for _ in range(9))
        b = "".join(rng.choice("wxyz") for _ in range(7)) + common + "".join(rng.choice("wxyz") for _ in range(60))
        assert {h for h, _ in winnow.fingerprints(a)} & {h for h, _ in winnow.fingerprints(b)}
    assert winnow.fingerprints("") == [] and len(winnow.fingerprints("ab")) == 1
    assert winnow.facts_key('{"a": ["X", 1], "b": null}') == winnow.facts_key('{"a":[1,"x "]}') != winnow.facts_key('{"a":[2,"x"]}')


def test_overlaps_across_splits(spark):
    rng = random.Random(2)
    nouns = ["ledger", "harbour", "orchard", "quarry", "meadow", "lantern", "bridge", "market", "window", "garden"]
    base = [" ".join(f"{rng.choice(nouns)} {rng.choice(nouns)} number {rng.randint(100, 999)}" for _ in range(8)) for _ in range(25)]

    def edit(text):
        w = text.split()
        at = rng.randrange(len(w))
        w[at] = rng.choice([w[at][:-1], w[at] + "e", w[at].upper()])
        w = w[12:] + w[:12] if rng.random() < 0.3 else w
        return " ".join(w) + rng.choice(["", " thanks", "!"])

    rows, key = [], {}
    for i in range(160):
        k = 0 if i % 3 == 0 else rng.randrange(25)
        fact = rng.choice([json.dumps({"e": k, "x": None}), json.dumps({"e": k})]) if rng.random() < 0.9 else json.dumps({"e": -k - 1})
        rows.append((i, rng.choice(["train", "train", "test", "validation"]), edit(base[k]) if rng.random() < 0.6 else base[k], fact, 1))
        key[i] = (k, json.loads(fact)["e"])
    rows += [(500, "train", None, "{}", 1), (501, "test", None, "{}", 1), (502, "train", "", "{}", 1), (503, None, base[1], None, 1), (504, "train", LONG, "{}", 1), (505, "test", LONG + " end", "{}", 1), (506, "train", "ab", "{}", 1), (507, "test", "AB!", "{}", 1)]
    df = spark.createDataFrame(rows, "id long, split string, text string, facts string, words int")
    wanted = {(a, b) for a in key for b in key if key[a] == key[b] and rows[a][1] == "train" and rows[b][1] != "train"} | {(504, 505), (506, 507)}
    got = winnow.cross_split_overlaps(df, "id", "split", "text", "facts")
    assert {(r["train_id"], r["eval_id"]) for r in got.collect()} == wanted
    assert winnow.cross_split_overlaps(df.limit(0), "id", "split", "text", "facts").count() == 0


@pytest.mark.parametrize("text", ["", "a", "x" * 5000])
def test_coverage_of_itself(text):
    seeds = [(p, p) for _, p in winnow.fingerprints(text)]
    if text:
        assert min(winnow.coverage(text, text, seeds)) == 1.0
