import json
import zipfile

import pytest
from conftest import values
from pyspark.sql import functions as F

from strandworks.api import Engine
from strandworks.operators import domain, pack
from strandworks.sources import files, sinks
from strandworks.streaming import queries as streams


def test_json_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n  \nnot json\n[1]\n')
    assert [r["valid"] for r in files.json_lines(spark, str(path)).orderBy("pos").collect()] == [True, False, True]
    with pytest.raises(files.MalformedLine, match="row 2"):
        files.strict_json_lines(spark, str(path))


def test_training_files(spark, tmp_path):
    rows = [{"instruction": "i", "input": "", "output": "o,\"x\"\ny"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "a.csv").write_text('instruction,output\ni,"o,""x""\ny"\n')
    assert values(files.training_file(spark, str(tmp_path / "a.json"))) == [("i", "", 'o,"x"\ny')]
    assert values(files.training_file(spark, str(tmp_path / "a.csv"))) == [("i", None, 'o,"x"\ny')]
    sinks.alpaca_to_lines(files.training_file(spark, str(tmp_path / "a.csv")), str(tmp_path / "lines.jsonl"))
    assert files.json_lines(spark, str(tmp_path / "lines.jsonl")).where("valid").count() == 1
    with pytest.raises(ValueError):
        files.training_file(spark, "x.txt")


def test_experiments_and_archives(spark, tmp_path):
    for name, text in (("e2", '{"id": 2}'), ("e1", '{"id": 1}'), ("bad", "{")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "manifest.json").write_text(text)
    assert [r["id"] for r in files.experiments(spark, str(tmp_path)).collect()] == ["e1", "e2"]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("b.txt", "hello")
        z.writestr("a.bin", b"\xff\xfe\x00")
    got = files.archive_entries(spark, str(tmp_path / "a.zip")).orderBy("entry").collect()
    assert [(r["entry"], r["size"], r["text"]) for r in got] == [("a.bin", 3, None), ("b.txt", 5, "hello")]
    assert pack.job_bundle(spark, str(tmp_path / "a.zip")).count() == 1


def test_config_keys_are_known(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"data": {"path": "x"}, "odd": 1}))
    with pytest.raises(ValueError, match="odd"):
        files.load_config(str(path), {"data": {"path"}})


def test_pack_round_trip_and_damage(spark, tmp_path):
    channels = tmp_path / "c.json"
    channels.write_text(json.dumps({"channels": [{"id": "AajTak.in", "name": "Harbour News", "streamUrl": "http://x/1", "category": "news", "country": "IN", "languages": ["hi"]}, {"id": "b", "name": "Lagoon Movies", "category": "movies"}]}))
    engine, archive = Engine(spark), str(tmp_path / "p.zip")
    assets = engine.compile_channels(str(channels), "iptv")
    manifest = engine.compile_pack(assets, archive, str(tmp_path / "w"), "tv", "0.9.0", "iptv")
    assert (manifest["asset_count"], manifest["playable_count"]) == (2, 1) and engine.validate_pack(archive, str(tmp_path / "v")) == []
    manager = engine.packs(str(tmp_path / "home"))
    manager.install(archive)
    engine.compile_pack(assets, str(tmp_path / "q.zip"), str(tmp_path / "w"), "tv", "0.10.0", "iptv")
    manager.install(str(tmp_path / "q.zip"), activate=False)
    assert manager.versions("tv") == ["0.9.0", "0.10.0"] and manager.active("tv") == "0.9.0" and manager.assets("tv").count() == 2
    manager.remove("tv", "0.9.0")
    assert manager.active("tv") is None
    with zipfile.ZipFile(archive, "a") as z:
        z.writestr("extra.txt", "x")
    assert engine.validate_pack(archive, str(tmp_path / "v")) == ["checksum differs"]
    with pytest.raises(ValueError, match="checksum"):
        manager.install(archive)
    with pytest.raises(ValueError, match="at least one"):
        engine.compile_pack(assets.limit(0), archive, str(tmp_path / "w"), "tv", "1.0.0", "iptv")
    assert engine.validate_pack(str(channels), str(tmp_path / "v"))[0].startswith("no archive")


def test_inspect_and_prepare(spark, tmp_path):
    rows = [{"input": f"row {i}"} for i in range(20)]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, rows + rows[:3])) + "\nbroken\n")
    (tmp_path / "e.jsonl").write_text(json.dumps(rows[0]) + "\n" + json.dumps({"input": "new"}) + "\n")
    engine = Engine(spark)
    got = engine.inspect(str(tmp_path / "t.jsonl"), str(tmp_path / "e.jsonl")).first()
    assert (got["total"], got["valid"], got["duplicates"], got["normalised_leaks"]) == (24, 23, 3, 1)
    assert values(engine.prepare(str(tmp_path / "t.jsonl"), str(tmp_path / "out"))) == [("test", 2), ("train", 16), ("validation", 2)]
    assert files.split_tables(spark, str(tmp_path / "out"))["train"].count() == 16
    with pytest.raises(ValueError, match="evaluation"):
        engine.prepare(str(tmp_path / "t.jsonl"), str(tmp_path / "o2"), evaluation=str(tmp_path / "e.jsonl"))
    left = engine.prepare(str(tmp_path / "t.jsonl"), str(tmp_path / "o3"), evaluation=str(tmp_path / "e.jsonl"), policy="remove_from_train")
    assert sum(r["n"] for r in left.collect()) == 19


def test_domains(tmp_path):
    good = {"domain": "food", "entities": {"dish": {"attributes": {"name": {"type": "string", "required": True}, "tags": {"type": "array", "items": "integer"}, "when": "date"}, "relationships": {"served_by": "place"}}, "place": {}}, "decisions": {"d": {"kind": "boolean"}}, "policies": ["b", "a", "b"]}
    ir = domain.build_ir(good)
    assert domain.verify(ir) == [] and ir["policies"] == ["a", "b"]
    schema = domain.spark_schema(ir["entities"][0])
    assert schema.simpleString() == "struct<name:string,tags:array<bigint>,when:string>" and schema["when"].metadata == {"declared": "date"} and not schema["name"].nullable
    bad = {"entities": {"a": {"relationships": {"r": "nowhere"}}}, "decisions": {"d": {"threshold": True, "kind": "choice"}, "e": {"id": "d", "kind": "odd"}}}
    assert len(domain.verify(domain.build_ir(bad))) == 6
    with pytest.raises(domain.DomainError):
        domain.compile_domain(bad, str(tmp_path))
    assert domain.compile_domain(good, str(tmp_path))["files"] == ["domain.json", "schemas/dish.json", "schemas/place.json"]


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"utterance": "play aaj tak"}\n{"utterance": "put on news"}\n{"utterance": "zzz"}\n')
    utterances = spark.readStream.schema("utterance string").json(str(source))
    for _ in range(2):  # the second run finds nothing new
        streams.log_failed_queries(utterances, str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination()
    assert values(spark.read.json(str(tmp_path / "log")), "utterance") == [("put on news",), ("zzz",)]
    events = tmp_path / "events"
    events.mkdir()
    (events / "1.json").write_text("\n".join(json.dumps({"ts": f"2024-01-01T{h:02}:30:00Z", "event_type": "a", "user_id": 1, "value": 1.0}) for h in (0, 0, 5, 9)))
    stream = spark.readStream.schema("ts timestamp, event_type string, user_id long, value double").json(str(events))
    for df, n in ((streams.windowed_counts(stream), 2), (streams.sessions(stream), 2)):
        query = df.writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table("w").count() >= n
    parsed = Engine(spark).parse_intent(spark.createDataFrame([("zzz",)], "utterance string"))
    Engine(spark).log_failed_queries(parsed.select("utterance", "confidence", "clarification_required"), str(tmp_path / "batch"))
    assert spark.read.json(str(tmp_path / "batch")).count() == 1 and parsed.select(F.col("tool")).first()[0] == "media.clarify"
