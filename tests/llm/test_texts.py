"""Problems 4, 6, 8, 9 and 10 on small tables made for them."""

import itertools
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandworks.llm import abuse, aliases, defects, mixing, packing, tokens

LONG = "word " * 50_000


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


POLICY = "Answer the customer question using the policy."
CASES = [
    (POLICY, "Question: can I cancel order 7?", None, "empty"), (POLICY, "Question: can I?", " ​\n", "empty"), (POLICY, "q", "N/A", "empty"), (POLICY, "q", "...", "empty"), (POLICY, "q", "{}", "empty"),
    ("Which are missing? Write None if nothing is missing.", "Note 7.", "None", None), ("Extract the number.", "Order 7.", "None", "empty"), ("Extract the number.", "Order 7.", "7", None), ("Is it due? Answer yes or no.", "x", "No", None),
    (POLICY, "Question: can I cancel?", "Input: Question: can I cancel?", "copy"), (POLICY, "Question: can I cancel?", POLICY.upper(), "copy"), (POLICY, "can I?", f"{POLICY}\ncan I?", "copy"), (POLICY, "can I cancel", "Q: can I cancel A:", "copy"),
    ("Repeat the text exactly as given.", "Table 7.", "Table 7.", None), ("Repeat the text exactly as given.", "Table 7.", "Repeat the text exactly as given.", "copy"),
    (POLICY, "q", "I'm sorry, but I can't help with that.", "refusal"), (POLICY, "q", "As an AI model I am unable to respond.", "refusal"), ("Beantworte die Frage höflich.", "q", "Das kann ich leider nicht beantworten.", "refusal"),
    ("Write a polite refusal to the supplier.", "x asks to prepay.", "I'm sorry, but we cannot prepay order 7 by Friday.", None), (POLICY, "q", "Sorry, preparation has started, so the kitchen cannot take order 7 back.", None),
    (POLICY, "Can I cancel it?", "La commande a été déplacée au mardi parce que le thé était épuisé.", "language"), ("Translate the message into French.", "The order is ready.", "La commande est prête pour vous.", None),
    ("Translate the message into French.", "The order is ready for you.", "Die Bestellung ist für Sie bereit und das ist gut.", "language"), ("Translate into JSON.", "play", '{"a": {"b": 1', "truncated"), ("Translate into JSON.", "play", '{"a": [1]}', None),
]


def test_each_kind_of_defect(spark):
    tea = ["green tea", "iced latte", "lemon tart", "apple cake"]
    whole = [("Confirm the order.", f"Order {i} for {tea[i % 4]}", f"Your {tea[i % 4]} of order {i} will be ready on Monday. Keep the number {i} at the counter.", None) for i in range(40)]
    cut = [("Confirm the order.", f"Order {90 + i}", t, "truncated") for i, t in enumerate(["Your green tea of order 90 will be", "Your lemon tart of order 91 will be rea", "Your apple cake of order 92 will be ready on Monday. Keep the", "Your iced latte of…"])]
    bare = [("Confirm the order.", "Order 95", "Your green tea of order 95 will be ready on Monday. Keep the number 95 at the counter", None)]
    rows = [(i, a, b, c, d) for i, (a, b, c, d) in enumerate(CASES + whole + cut + bare)]
    rows += [(900, None, None, None, "empty"), (901, None, None, "Fine, that is all.", None), (902, POLICY, LONG, LONG, "copy"), (903, POLICY, "q", LONG + "end.", None)]
    df = spark.createDataFrame([(i, a, b, c, "en" if a and "Beant" not in a else None, "words") for i, a, b, c, _ in rows], "row_id long, instruction string, input string, output string, lang string, defect string")
    got = dict(values(defects.defective_pairs(df, "row_id", "instruction", "input", "output", "lang")))
    assert got == {i: d for i, *_, d in rows if d}
    assert defects.defective_pairs(df.limit(0), "row_id", "instruction", "input", "output", "lang").count() == 0


def test_truncation_shows_without_twins_of_the_instruction(spark):
    dish = ["green tea", "iced latte", "lemon tart", "apple cake"]
    whole = [f"Your {dish[i % 4]} will be ready on Monday at noon. Please keep number {i} at hand at the counter." for i in range(60)]
    names = ["Norway", "the river Lune", "Ready on Monday", "Green tea", "Nor"] * 4
    cut = ["Your green tea will be ready on Monday at noon. Please keep number 7 at hand at the cou", "Your lemon tart will be ready on Monday at noon. Please keep number 8", "Your iced latte will be ready on Mon"]
    rows = [(i, f"Answer request {i}, {'abcdefghij'[i % 10]}{i}.", "x", t, "en", t in cut) for i, t in enumerate(whole + names + cut)]
    df = spark.createDataFrame(rows, "row_id long, instruction string, input string, output string, lang string, bad boolean")
    got = values(defects.defective_pairs(df, "row_id", "instruction", "input", "output", "lang"))
    assert got == [(i, "truncated") for i, *_, bad in rows if bad]


def test_shortened_texts_equal_brute_force(spark):
    rng = random.Random(6)
    texts = list({"".join(rng.choice("ab ") for _ in range(rng.randint(1, 9))).strip() for _ in range(300)} - {""})
    df = spark.createDataFrame([(t,) for t in texts + texts[:50]], "text string")
    wanted = {t for t in texts if any(u.startswith(t) and u != t for u in texts)}
    assert {r["text"] for r in defects.shortened(df).collect()} == wanted and defects.shortened(df.limit(0)).count() == 0


def test_length_limits_show_as_spikes(spark):
    rows = [(100,)] * 40 + [(s,) for s in range(80, 120)] + [(50,)] * 3
    assert values(defects.length_spikes(spark.createDataFrame(rows, "size int"))) == [(100,)]


def test_languages():
    said = {"en": "the order will be ready for you on Monday", "de": "die Bestellung ist am Montag für Sie bereit", "fr": "votre commande sera prête dans une heure", "es": "su pedido está listo para usted en el mostrador", "hi": "आपका ऑर्डर तैयार है"}
    assert {defects.language_of(t): lang for lang, t in said.items()} == {lang: lang for lang in said}
    assert defects.language_of("aapka order taiyar hai aur wo counter par mil jayega") == "hi" and defects.language_of("10000343") is None


def test_values_are_mapped_or_reported(spark):
    reference = [("c", "fraud:waiver", "fraud_waiver"), ("c", "fraud:waiver", "waiver for fraud"), ("c", "fraud:waiver", "LDVB9"), ("c", "lending:refund", "Lending refund service"), ("c", "lending:sampling", "Lending sampling service"), ("c", "none", None), ("c", "blank", " "), ("d", "kaveri", "Κaveri Cooking"), ("d", "ostrava", "Ostrava Movies")]
    typed = {
        "FRAUD  waivr": "fraud:waiver", "our Waiver/For/Fraud (old)": "fraud:waiver", "ldvb9.": "fraud:waiver", "LDVB8": "none", "lendingrefund svc": "lending:refund", "lendnig refudn": "lending:refund", "Lending Taxidermy Service": "none",
        "lending": "none", "viticulture waiver": "none", "???": "none", "": "none", None: "none", "lending service": "none", LONG: "none",
    }
    rows = [(i, "c", v) for i, v in enumerate(typed)] + [(100, "d", "Kaνeri Сooking TV"), (101, "d", "POLTAVA MOVIES"), (102, "d", "ostrava moveis hd"), (103, "x", "fraud waiver"), (104, None, "fraud waiver")] + [(200 + i, "c", "Fraud waiver") for i in range(30)]
    df = spark.createDataFrame(rows, "entry_id long, list string, entered string").selectExpr("*", "1 AS value", "2 AS entity")
    got = dict(values(aliases.map_values(df, spark.createDataFrame(reference, "list string, entity string, name string")), "entry_id", "entity_id"))
    assert [got[i] for i in range(len(typed))] == list(typed.values())
    assert (got[100], got[101], got[102], got[103], got[104]) == ("kaveri", "none", "ostrava", "none", "none") and all(got[200 + i] == "fraud:waiver" for i in range(30))
    assert aliases.map_values(df.limit(0), spark.createDataFrame(reference, "list string, entity string, name string")).count() == 0


@pytest.mark.parametrize("index_rows", [0, 500_000])
def test_no_candidate_is_lost_against_brute_force(spark, monkeypatch, index_rows):
    monkeypatch.setattr(aliases, "INDEX_ROWS", index_rows)
    rng = random.Random(14)
    words = ["fraud", "waiver", "lending", "refund", "sampling", "service", "rule", "payroll", "expiry", "archive"]
    forms = sorted({" ".join(rng.sample(words, rng.randint(1, 3))) for _ in range(60)})
    typed = sorted({"".join(c for c in rng.choice(forms) if rng.random() > 0.1) for _ in range(120)} - {""})
    forms_df = spark.createDataFrame([("c", f"e{i}", f) for i, f in enumerate(forms)], "list string, entity string, form string")
    got = defaultdict(dict)
    for r in aliases.candidates(spark.createDataFrame([("c", v) for v in typed], "list string, value string"), forms_df).collect():
        got[r["value"]][r["form"]] = r["cosine"]
    df, dv = (Counter(g for t in texts for g in aliases.grams(t)) for texts in (forms, typed))
    weight = lambda g: min(np.log(1 + len(forms) / max(1, df[g])), np.log(1 + len(typed) / max(1, dv[g])))
    unit = lambda t: {g: weight(g) / np.sqrt(sum(weight(x) ** 2 for x in aliases.grams(t))) for g in aliases.grams(t)}
    listed = {f: unit(f) for f in forms}
    for v in typed:
        own = unit(v)
        cosines = sorted(((sum(w * u.get(g, 0) for g, w in own.items()), f) for f, u in listed.items()), reverse=True)
        best = cosines[0][0]
        for c, f in cosines:
            if c >= max(aliases.COSINE, best - aliases.MARGIN) + 1e-9:
                assert abs(got[v][f] - c) < 1e-9


def test_words_typed_as_one_in_any_order():
    known = frozenset()
    assert aliases.check("expirypayrolllendingarchivefraud", "archive expiry for fraud lending payroll", known) == 0
    assert aliases.check("payrolexpiri archivefraudlending", "archive expiry fraud lending payroll", known) is not None
    assert aliases.check("poltava movies", "ostrava movies", known) is None and aliases.check("ostravatv movies", "ostrava movies", known) is not None


def test_edit_distance_counts_transpositions():
    assert aliases.edits("movies", "mvoies", 2) == 1 and aliases.edits("abc", "abcd", 2) == 1 and aliases.edits("abc", "xyz", 2) == 3 and aliases.edits("", "ab", 1) == 2


def optimum(sizes, capacity):
    """Least containers by trying all: for a handful of items."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in sorted({b for b in bins if b + sizes[i] <= capacity}):
            left = list(bins)
            left.remove(k)
            place(i + 1, [*left, k + sizes[i]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_reduction_keeps_an_optimum_and_plans_are_tight():
    rng = random.Random(8)
    for _ in range(120):
        capacity = rng.randint(5, 20)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        fixed, rest = packing.reduce_dominated(Counter(sizes), capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        assert sum(fixed.values()) + (optimum(sorted(left, reverse=True), capacity) if left else 0) == optimum(sizes, capacity)
        planned = packing.plan(Counter(sizes), capacity)
        used = Counter()
        for pattern, many in planned:
            assert sum(w * n for w, n in pattern) <= capacity
            for w, n in pattern:
                used[w] += n * many
        assert used == Counter(sizes) and sum(n for _, n in planned) <= optimum(sizes, capacity) * 11 / 9 + 1
    assert packing.plan({}, 5) == []


def test_every_token_once_and_nothing_over_capacity(spark):
    rng = random.Random(9)
    rows = [(i, 7 if i % 3 == 0 else rng.choice([0, 1, 3, 20, 45, 64, 65, 130, 200])) for i in range(400)] + [(999, None)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long").selectExpr("*", "1 AS width", "2 AS size")
    for separator in (0, 2):
        got = packing.pack(df, "doc_id", "tokens", 64, separator).collect()
        spans, held = defaultdict(list), defaultdict(list)
        for r in got:
            spans[r["doc_id"]].append((r["start"], r["size"]))
            held[r["container"]].append((r["position"], r["size"]))
        for doc, n in rows:
            at = 0
            for start, size in sorted(spans[doc]):
                assert start == at and (size == 64 or start + size == n)
                at += size
            assert at == (n or 0) and (len(spans[doc]) <= 1 or n > 64)
        assert sorted(held) == list(range(len(held)))
        for items in held.values():
            assert sorted(p for p, _ in items) == list(range(len(items))) and sum(s for _, s in items) + separator * (len(items) - 1) <= 64
        report = packing.fill_report(packing.pack(df, "doc_id", "tokens", 64, separator), 64, separator).first()
        assert report["n_containers"] == len(held) and report["n_containers"] <= report["least_containers"] * 11 / 9 + 1
    assert packing.pack(df.limit(0), "doc_id", "tokens", 64).count() == 0


@pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER), reason="no tokenizer")
def test_token_counts(spark):
    texts = ["a b c", "", None, "a b c", "<|endoftext|> is text", LONG]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(tokens.token_count(tokens.F.col("t"))).collect()]
    assert got[0] == got[3] == 3 and got[1] == got[2] == 0 and got[4] > 3 and got[5] == tokens.count_tokens([LONG])[0]


def test_mix_reaches_targets_within_caps(spark):
    rng = random.Random(10)
    topic = {"a": "film actor scene", "b": "code class method", "c": "recipe oven flour"}
    rows = [(i, s, f"{topic[s]} {rng.choice(topic[s].split())} {i}", rng.randint(20, 200)) for i, s in enumerate(rng.choices("aaaaaabbbc", k=1500))]
    rows += [(9000, None, "film", 50), (9001, "zzz", "film", 50), (9002, "a", None, 0), (9003, "a", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, tokens long").selectExpr("*", "1 AS rate", "2 AS own")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.3, 2), ("c", 0.4, 2)], "source string, target_share double, max_repeats int")
    got = mixing.mix(df, targets)
    report = {r["source"]: r for r in mixing.share_report(got, df, targets).collect()}
    total = sum(t or 0 for *_, t in rows)
    most_c = 2 * sum(t for _, s, _, t in rows if s == "c")
    assert abs(sum(r["n_tokens"] for r in report.values() if r["source"]) - total) < 0.02 * total
    assert report["c"]["n_tokens"] == most_c and not report["c"]["can_be_met"] and report["a"]["can_be_met"]
    assert abs(report["a"]["reached_share"] - report["b"]["reached_share"]) < 0.01 and report["a"]["most_copies"] <= 1 and report["b"]["most_copies"] <= 2
    assert abs(sum(r["expected_share"] for r in report.values() if r["source"]) - 1) < 0.02
    columns = ["doc_id", "source", "tokens", "copies"]
    assert values(got, *columns) == values(mixing.mix(df.repartition(7), targets), *columns)
    assert mixing.mix(df.limit(0), targets).count() == 0 and mixing.mix(df, targets.limit(0)).count() == 0


def test_gradient_fits_expected_totals(spark):
    rng = np.random.default_rng(15)
    p = rng.dirichlet([0.3, 0.3, 0.3], 3000)
    rows = [(int(i), int(t), [float(v) for v in x]) for i, (t, x) in enumerate(zip(rng.integers(5, 500, len(p)), p))]
    df = spark.createDataFrame(rows, "i long, _tokens long, _p array<double>").selectExpr("*", "2 AS cap", "1.0D AS rate")
    tokens_ = np.array([r[1] for r in rows])
    goal = np.array([1.5, 0.6, 0.9]) * (p * tokens_[:, None]).sum(0)
    got = mixing.fit_rates(df, [mixing.F.col("_p")[k] for k in range(3)], goal).orderBy("i").select("rate").toPandas()["rate"].to_numpy()
    reached = (p * (got * tokens_)[:, None]).sum(0)
    assert np.abs(reached / goal - 1).max() <= mixing.NEAR and got.min() >= 0 and got.max() <= 2


def test_classifier_tells_topics_apart():
    rng = random.Random(11)
    topic = {"film": "scene actor camera plot cast", "code": "class method loop return type"}
    made = [(" ".join(rng.choices(topic[s].split() + ["the", "of", "and"], k=12)), s) for s in rng.choices(["film", "code"], k=400)]
    model = mixing.Membership([t for t, _ in made[:200]], [s for _, s in made[:200]])
    hits = sum(model.names[int(np.argmax(model.posteriors(t)))] == s for t, s in made[200:])
    assert hits >= 195 and abs(model.posteriors(None).sum() - 1) < 1e-5


CLEAN = ["the harbour ending left me smiling", "picture is fine in hd but the ads are too much", "my kids watched the lantern three times", "moderators removed posts that contained insults", "the master copy replaced the slave replica", "a stupidly brave dog called bastard sword", "he was killed in the last scene of the film"]
BAD = ["shut up you worthless {}", "nobody wants you here you {}", "all {} people should be thrown out", "i will break your legs you {}"]
WHO = ["idiot", "moron", "parasite", "loser"]


def disguised(text, rng):
    kind = rng.randrange(5)
    if kind == 0:
        return text.upper()
    if kind == 1:
        return " ".join(w.replace("o", "0").replace("e", "3") if rng.random() < 0.5 else w for w in text.split())
    if kind == 2:
        return " ".join(".".join(w) if len(w) > 3 and rng.random() < 0.4 else w for w in text.split())
    if kind == 3:
        return " ".join(w[:2] + "​" + w[2:] for w in text.split())
    return text


def test_machine_finds_held_out_abuse_in_disguise(spark):
    rng = random.Random(12)

    def document(bad):
        parts = [rng.choice(CLEAN) for _ in range(rng.randint(1, 5))]
        if bad:
            parts.insert(rng.randrange(len(parts) + 1), disguised(rng.choice(BAD).format(rng.choice(WHO)), rng))
        return ". ".join(parts) + "."

    truth = [rng.random() < 0.25 for _ in range(1200)]
    rows = [(i, document(t)) for i, t in enumerate(truth)] + [(5000, None), (5001, ""), (5002, "!!!"), (5003, LONG)]
    labels = [(i, int(t if rng.random() > 0.04 else not t), "x") for i, t in enumerate(truth[:800]) for _ in range(rng.choice([1, 1, 2]))] + [(None, 1, "x"), (3, None, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS _y")
    scored = abuse.abuse_scores(documents, spark.createDataFrame(labels, "doc_id long, abusive int, text string"))
    got = {r["doc_id"]: r for r in scored.collect()}
    held = [(got[i]["flagged"], truth[i]) for i in range(800, 1200)]
    hit, said, there = sum(f and t for f, t in held), sum(f for f, _ in held), sum(t for _, t in held)
    assert hit / said > 0.9 and hit / there > 0.9
    assert got[5000]["score"] == got[5001]["score"] == got[5002]["score"] == 0.0 and not got[5003]["flagged"]
    assert len(got) == len(rows) and abuse.abuse_scores(documents.limit(0), spark.createDataFrame(labels, "doc_id long, abusive int, text string")).count() == 0


def test_few_or_one_sided_labels(spark):
    documents = spark.createDataFrame([(1, "you idiot"), (2, "a fine day"), (3, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(2, 0)], [(1, 1), (2, 0)]):
        scored = {r["doc_id"]: r for r in abuse.abuse_scores(documents, spark.createDataFrame(labels, "doc_id long, abusive int")).collect()}
        assert len(scored) == 3 and not scored[3]["flagged"]
    assert scored[1]["flagged"] and not scored[2]["flagged"]


def test_a_sentence_of_one_word_is_a_window(spark):
    rng = random.Random(13)
    names = ["Maeve", "Updated", "Decision", "Hello"]

    def document(bad):
        said = [rng.choice(CLEAN) for _ in range(rng.randint(1, 4))] + [rng.choice(names)]
        rng.shuffle(said)
        if bad:
            said.insert(rng.randrange(len(said) + 1), rng.choice(["Bastard!", "Wanker", "You bastard", "total wanker you are"]))
        return ". ".join(said) + "."

    truth = [rng.random() < 0.3 for _ in range(600)]
    rows = [(i, document(t)) for i, t in enumerate(truth)] + [(9001, "What a lovely match today. Bastard!"), (9002, "What a lovely match today. Maeve!")]
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(truth[:300])], "doc_id long, abusive int")
    got = {r["doc_id"]: r["flagged"] for r in abuse.abuse_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert got[9001] and not got[9002] and sum(got[i] == truth[i] for i in range(300, 600)) >= 295


def test_windows_of_a_batch_are_those_of_its_texts():
    words = [a + b for a in "abcdefgh" for b in "mnrst"]
    ids, at = abuse.encode_all([[words, ["one"]], [], [words[:8]]])
    starts = [range(i, min(i + abuse.WINDOW, 40)) for i in (0, 7, 14, 21, 28)]
    assert at.tolist() == [0] * 6 + [2] and [int((row > 0).sum()) for row in ids] == [2 * len(r) - 1 for r in starts] + [1, 15]
    alone = np.concatenate([abuse.encode_all([[words, ["one"]]])[0], abuse.encode_all([[words[:8]]])[0]])
    assert (ids == alone).all() and abuse.encode_all([])[0].shape == (0, abuse.TERMS)


def test_spellings_are_read():
    masks = abuse.Masks(Counter({"worthless": 5, "stop": 3, "step": 9, "putting": 4, "them": 9, "you": 9, "shut": 4}), Counter({("", "stop"): 3, ("stop", "putting"): 3}))
    assert masks.read(["s**p", "p**ting", "t**m"])[:2] == ["stop", "putting"]
    assert masks.read(abuse.tokens("s h u t y o u")[0]) == ["shut", "you"]
    assert masks.read(abuse.tokens(" ".join("shutyou" * 20))[0]) == ["shut", "you"] * 20
    assert abuse._word("idiooot") == abuse._word("1d10t") == "idiot" and abuse._word("2024") == "0"
    assert list(itertools.chain(*abuse.tokens("I can't s.t.a.n.d the h.o.u.s.e"))) == ["i", "can't", "stand" + abuse.JOINED, "the", "house" + abuse.JOINED]
