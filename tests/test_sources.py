"""Readers, quarantine, incremental and streaming loads, sinks."""

import json
import os

import pytest
from pyspark.errors import AnalysisException

from chunkwright.options import Options
from chunkwright.sources import chunks, incremental, sinks
from chunkwright.streaming.ingest import stream_ingest

LINES = {
    '{"doc_id":"d","chunk_id":"c","chunk":"x","embedding":[1,2.5]}': (None, "x", [1.0, 2.5]),
    '{"doc_id":"d","chunk_id":"c","embedding":[1,2]}': (None, "", [1.0, 2.0]),
    '{"doc_id":"d","chunk_id":"c","chunk_text":"y","chunk":"z","content_vector":[3]}': (None, "y", [3.0]),
    '{"doc_id":"d","chunk_id":"c","chunk_text":null,"chunk":"y","content_vector":[1,2]}': ("chunk_text is null",),
    '{"doc_id":"d","chunk_id":"c","embedding":null,"content_vector":[1,2]}': ("no embedding",),
    '{"doc_id":"d","chunk_id":"c","chunk":"x"}': ("no embedding",),
    '{"doc_id":"d","chunk_id":"c","embedding":["0.5","x"]}': ("embedding holds a value that is no number",),
    '{"doc_id":"d","chunk_id":"c","embedding":["0.5","1"]}': (None, "", [0.5, 1.0]),
    '{"doc_id":"d","chunk_id":"c","embedding":[1,null]}': ("embedding holds a value that is no number",),
    '{"doc_id":"d","chunk_id":"c","embedding":"x"}': ("embedding is not an array of numbers",),
    '{"chunk_id":"c","embedding":[1,2]}': ("no doc_id",),
    '{"doc_id":"d","embedding":[1,2]}': ("no chunk_id",),
    "not json": ("not JSON",),
    "": ("not JSON",),
    "[1,2]": ("not an object",),
    '{"doc_id":"d","chunk_id":"c","embedding":[1]} trailing': ("not JSON",),
    '{"doc_id":"d","chunk_id":"c","embedding":[1]}]': ("not JSON",),
    '{"doc_id":"d","chunk_id":"c","embedding":[1]},{}': ("not JSON",),
}


def chunk(doc, number, text="some words that are long enough", vector=(1.0, 0.0)):
    return {"doc_id": doc, "chunk_id": number, "chunk": text, "embedding": list(vector)}


def write(path, *objects):
    path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects))


def test_parse_rules(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    got = {r["value"]: r for r in chunks.parse_chunks(df).collect()}
    for line, (error, *fields) in LINES.items():
        assert got[line]["error"] == error, line
        if error is None:
            assert [got[line]["chunk_text"], got[line]["embedding"]] == fields, line


def test_paths_order_and_quarantine(spark, tmp_path):
    folder, single = tmp_path / "in", tmp_path / "last.jsonl"
    (folder / "deep").mkdir(parents=True)
    write(folder / "b.jsonl", chunk("d2", "c1"), "broken", chunk("d1", "c1"))
    write(folder / "a.json", json.dumps(chunk("d3", "c1"), indent=1))
    write(folder / "deep" / "z.jsonl", chunk("d9", "c9"))
    write(folder / "notes.txt", "ignored")
    write(single, chunk("d0", "c0"), chunk("d1", "c1", text="second of its key"))
    write(tmp_path / "x.csv", "ignored")
    loaded, bad = chunks.load_chunks(spark, [str(folder), str(single), str(tmp_path / "x.csv")])
    rows = loaded.orderBy("ord").collect()
    assert [r["doc_id"] for r in rows] == ["d3", "d2", "d1", "d0"]
    assert sorted(r["error"] for r in bad.collect()) == ["not JSON", "repeated key"]


def test_object_store_is_recursive(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    write(tmp_path / "a" / "b" / "1.json", chunk("d1", "c1"))
    write(tmp_path / "2.json", chunk("d2", "c1"))
    write(tmp_path / "3.json", "{")
    loaded, bad = chunks.load_chunks(spark, [str(tmp_path)], "object_store_chunks")
    assert sorted(r["doc_id"] for r in loaded.collect()) == ["d1", "d2"]
    assert bad.count() == 1


def test_input_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        chunks.load_chunks(spark, ["x"], "documents")
    with pytest.raises(ValueError):
        chunks.load_chunks(spark, ["x"], "tables")
    with pytest.raises((FileNotFoundError, AnalysisException)):
        chunks.load_chunks(spark, [str(tmp_path / "missing.jsonl")])


def test_widths(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "embedding array<double>")
    with pytest.raises(ValueError, match="inconsistent"):
        chunks.check_dims(df)
    with pytest.raises(ValueError, match="expected 3"):
        chunks.check_dims(df.limit(1), 3)
    assert chunks.check_dims(df.limit(1), 2) == 2


def test_incremental_sees_new_changed_and_deleted_files(spark, tmp_path):
    folder, state = tmp_path / "in put", str(tmp_path / "state")
    folder.mkdir()
    write(folder / "a.jsonl", chunk("d1", "c1"), "broken")
    write(folder / "b.json", chunk("d2", "c1"))

    def load(version):
        rows = incremental.incremental_load(spark, str(folder), state, version).filter("error IS NULL")
        return sorted((r["doc_id"], r["chunk_text"]) for r in rows.collect())

    def parsed(version):
        path = f"{state}/parsed/batch={version}"
        return spark.read.parquet(path).count() if os.path.exists(path) else 0

    words = "some words that are long enough"
    assert load(0) == [("d1", words), ("d2", words)]
    write(folder / "b.json", chunk("d2", "c1", text="changed text"))
    write(folder / "c.jsonl", chunk("d3", "c1"))
    assert load(1) == [("d1", words), ("d2", "changed text"), ("d3", words)]
    assert load(1) == [("d1", words), ("d2", "changed text"), ("d3", words)]
    assert parsed(1) == 2
    os.remove(folder / "a.jsonl")
    assert load(2) == [("d2", "changed text"), ("d3", words)]
    assert parsed(2) == 0


def test_stream_reads_every_file_once(spark, tmp_path):
    folder, out, seen = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "seen")
    folder.mkdir()

    def ingest():
        stream_ingest(spark, str(folder), out, seen, Options()).awaitTermination()
        return sorted(r["doc_id"] for r in spark.read.parquet(f"{out}/chunks").collect())

    write(folder / "a.jsonl", chunk("d1", "c1"), "broken", chunk("d2", "c1", text="too short"))
    assert ingest() == ["d1"]
    assert ingest() == ["d1"]
    write(folder / "b.jsonl", chunk("d3", "c1"))
    assert ingest() == ["d1", "d3"]
    assert spark.read.parquet(f"{out}/quarantine").count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("d", "c", "t", None), ("e", "c", "t", "why")],
                                 "doc_id string, chunk_id string, chunk_text string, reject_reason string")
    assert not sinks.write_rejected(rows, None)
    assert not sinks.write_rejected(rows.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert sinks.write_rejected(rows, str(tmp_path / "some"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "some")).collect()]
    assert sorted(x["reject_reason"] for x in lines) == ["Unknown", "why"]
    sinks.write_ground_truth(rows, str(tmp_path / "truth"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "truth")).collect()]
    assert {"doc_id": "d", "chunk_id": "c", "chunk_text": "t", "reject_reason": None} in lines


def test_a_file_rewritten_during_a_load_is_read_again(spark, tmp_path, monkeypatch):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    file = folder / "a.jsonl"

    def write(text, age):
        file.write_text(json.dumps({"doc_id": "d", "chunk_id": "c", "chunk": text, "embedding": [1.0]}) + "\n")
        os.utime(file, (1_700_000_000 + age, 1_700_000_000 + age))

    write("old text", 0)
    settle, calls = incremental.settle, []

    def settle_then_rewrite(df):
        done = settle(df)
        if not calls:  # right after the listing
            write("the new text", 60)
        calls.append(1)
        return done

    monkeypatch.setattr(incremental, "settle", settle_then_rewrite)
    incremental.incremental_load(spark, str(folder), state, 0)
    monkeypatch.undo()
    found = incremental.incremental_load(spark, str(folder), state, 1).collect()
    assert [r["chunk_text"] for r in found] == ["the new text"]
    manifest = spark.read.parquet(f"{state}/manifest/version=1").collect()
    assert [r["batch"] for r in manifest] == [1]


def test_missing_vectors_have_no_width(spark):
    rows = [("d", "c1", [1.0, 2.0]), ("d", "c2", None)]
    table = spark.createDataFrame(rows, "doc_id string, chunk_id string, embedding array<double>")
    assert chunks.check_dims(table, 2) == 2
