import random

from conftest import values
from pyspark.sql import functions as F

from strandworks.operators import orphans
from strandworks.operators.orphans import OrphanStore, replay, snapshot

LIVES = "kind string, key string, born int, died int, seen_at int, arrived int"
REFS = "kind string, key string, at int, table_name string, row_key string, field_name string, arrived int"


def stamped(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.timestamp_seconds(c))
    return df


def brute(lives, refs):
    last = {}
    for kind, key, born, died, seen, _ in lives:
        at = (-1 if seen is None else seen, -1 if died is None else died)
        if (kind, key, born) not in last or at > last[kind, key, born][0]:
            last[kind, key, born] = (at, died)
    by = {}
    for (kind, key, born), (_, died) in last.items():
        by.setdefault((kind, key), []).append((born, died))
    out = []
    for kind, key, at, name, row, field, _ in refs:
        if key is None:
            continue
        own = by.get((kind, key))
        if own is None:
            out.append((name, row, field, "missing"))
        elif at is None or any((b is None or b <= at) and (d is None or at < d) for b, d in own):
            continue
        else:
            out.append((name, row, field, "late" if all(b is not None and b > at for b, _ in own) else "deleted"))
    return sorted(out, key=repr)


def test_any_batches_end_where_brute_force_does(table):
    rng = random.Random(5)
    keys = [f"k{i}" for i in range(12)]
    lives = [(rng.choice("ab"), rng.choice(keys), rng.choice([None, *range(0, 60, 7)]), rng.choice([None, None, *range(0, 90, 5)]), rng.choice([None, *range(20)]), rng.randint(0, 100)) for _ in range(70)]
    lives += lives[:10]
    hot = [("a", "k1", rng.randint(0, 99), "t", f"h{i}", "f", rng.randint(0, 100)) for i in range(150)]
    refs = hot + [(rng.choice("ab"), rng.choice([None, "gone", *keys]), rng.choice([None, *range(100)]), "t", f"r{i}", "f", rng.choice([None, *range(100)])) for i in range(250)]
    left = stamped(table(lives, LIVES), "born", "died", "seen_at", "arrived")
    right = stamped(table(refs, REFS), "at", "arrived")
    wanted = brute(lives, refs)
    for cuts in ([], [50], [20, 40, 80]):
        moments = [r[0] for r in stamped(table([(c,) for c in cuts], "c int"), "c").orderBy("c").collect()]
        states = replay(left, right, "arrived", moments)
        assert values(states[-1], "table_name", "row_key", "field_name", "reason") == wanted
        assert sum(r["n_dangling"] for r in snapshot(states[-1]).collect()) == len(wanted)


def test_parents_resolve_and_deletions_reopen(table):
    refs = stamped(table([("n", "x", 50, "t", "1", "f", 1)], REFS), "at", "arrived")
    lives = stamped(table([("n", "x", 10, None, 1, 20), ("n", "x", 10, 40, 2, 30)], LIVES), "born", "died", "seen_at", "arrived")
    cuts = [r[0] for r in stamped(table([(15,), (25,)], "c int"), "c").orderBy("c").collect()]
    reasons = [[r["reason"] for r in s.collect()] for s in replay(lives, refs, "arrived", cuts)]
    assert reasons == [["missing"], [], ["deleted"]]


def test_empty_tables(table):
    states = replay(stamped(table([], LIVES), "born", "died", "seen_at", "arrived"), stamped(table([], REFS), "at", "arrived"), "arrived", [])
    assert states[-1].count() == 0


def test_a_store_goes_on_where_it_was_and_touches_few_buckets(spark, table, tmp_path):
    path = f"file://{tmp_path}/state"
    lives = lambda *rows: stamped(table(list(rows), LIVES), "born", "died", "seen_at", "arrived")
    refs = lambda *rows: stamped(table(list(rows), REFS), "at", "arrived")
    store = OrphanStore(spark, path, buckets=64)
    store.advance(lives(*[("n", f"k{i}", 10, None, 1, 0) for i in range(200)]), refs(*[("n", f"k{i}", i, "t", str(i), "f", 0) for i in range(300)]))
    assert store.pending().count() == 110
    again = OrphanStore(spark, path)
    again.advance(lives(("n", "k250", 0, None, 2, 0), ("n", "k50", 10, 20, 2, 0)), refs(("n", "k5", 50, "t", "x", "f", 0), ("n", None, 50, "t", "y", "f", 0)))
    assert sorted(set(values(again.pending(), "row_key", "reason")) ^ set(values(store.pending(), "row_key", "reason"))) == [("250", "missing"), ("50", "deleted")]
    assert len(again._buckets("pending", 2)) <= 3 and len(again._buckets("lives", 2)) <= 2
    again.advance(lives(), refs())
    assert again.version == 3 and again.pending().count() == 110


def test_a_parent_of_many_lives_takes_several_rows(table, monkeypatch):
    monkeypatch.setattr(orphans, "CHUNK", 4)
    rng = random.Random(6)
    lives = [("a", "hot", b, rng.choice([None] * (b == 190) + [b + rng.randint(1, 9)]), 1, 1) for b in range(3, 200, 11)] + [("a", "born", None, 40, 1, 1), ("a", "born", 60, 70, 1, 1)]
    refs = [("a", rng.choice(["hot", "hot", "born", "gone"]), rng.choice([None, *range(230)]), "t", str(i), "f", 1) for i in range(400)]
    got = replay(stamped(table(lives, LIVES), "born", "died", "seen_at", "arrived"), stamped(table(refs, REFS), "at", "arrived"), "arrived", [])
    assert values(got[-1], "table_name", "row_key", "field_name", "reason") == brute(lives, refs)
