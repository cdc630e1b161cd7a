"""Keys that arrive again, batches that run again, and numbers without a sort."""

import json
import os

from chunkwright.options import Options
from chunkwright.session import fresh_dir
from chunkwright.sources import chunks as sources
from chunkwright.streaming.upsert import history, read_upserts, stream_upsert, upsert

OPTIONS = Options(min_tokens=1, max_tokens=5)


def line(key, text, vector=(1.0, 2.0)):
    return json.dumps({"doc_id": "d", "chunk_id": key, "chunk_text": text, "embedding": list(vector)})


def batch(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def table(spark, out):
    return sorted((r.chunk_id, r.chunk_text) for r in read_upserts(spark, out).collect())


def test_a_key_that_comes_again_stays_once(spark):
    out = fresh_dir(spark, "upserts")
    upsert(batch(spark, line("a", "one"), line("b", "two"), "{broken"), 0, out, OPTIONS, 4)
    upsert(batch(spark, line("c", "three"), line("c", "third"), line("x", "far too long for the limit of it")), 1, out, OPTIONS, 4)
    upsert(batch(spark, line("a", "one again")), 2, out, OPTIONS, 4)
    want = [("a", "one again"), ("b", "two"), ("c", "three")]
    assert table(spark, out) == want
    upsert(batch(spark, line("a", "one again")), 2, out, OPTIONS, 4)  # the last batch once more
    assert table(spark, out) == want
    upsert(batch(spark, "{broken"), 3, out, OPTIONS, 4)  # nothing to bring in
    assert table(spark, out) == want
    told = {(r.chunk_id, r.batch): r.replaced for r in history(spark, out).collect()}
    assert set(told) == {("a", 0), ("b", 0), ("c", 1), ("a", 2)}
    assert told[("a", 2)] is not None and all(v is None for k, v in told.items() if k != ("a", 2))


def test_only_touched_buckets_are_rewritten(spark):
    out = fresh_dir(spark, "upserts")
    upsert(batch(spark, *[line(f"k{i}", f"text {i}") for i in range(60)]), 0, out, OPTIONS, 16)
    upsert(batch(spark, line("k7", "new")), 1, out, OPTIONS, 16)
    root = out.removeprefix("file:")
    first, second = (sorted(d for d in os.listdir(f"{root}/chunks/batch={n}") if d.startswith("bucket=")) for n in (0, 1))
    assert len(first) > 10 and len(second) == 1
    assert len(table(spark, out)) == 60 and ("k7", "new") in table(spark, out)


def test_files_as_a_stream(spark, tmp_path):
    folder, out, seen = tmp_path / "in", fresh_dir(spark, "upserts"), fresh_dir(spark, "progress")
    folder.mkdir()
    for number, lines in enumerate(([line("a", "one"), line("b", "two")], [line("b", "second")])):
        (folder / f"{number}.jsonl").write_text("\n".join(lines) + "\n")
        stream_upsert(spark, str(folder), out, seen, OPTIONS, buckets=4).awaitTermination()
    stream_upsert(spark, str(folder), out, seen, OPTIONS, buckets=4).awaitTermination()  # no new file
    assert table(spark, out) == [("a", "one"), ("b", "second")]


def test_lines_are_numbered_in_input_order_without_a_sort_of_texts(spark, tmp_path):
    wanted = []
    for name in ("b", "a"):  # paths in the order given, files of a path by name
        for part in range(3):
            path = tmp_path / name / f"p{part}.jsonl"
            path.parent.mkdir(exist_ok=True)
            keys = [f"{name}{part}-{i:04d}" for i in range(400)]
            path.write_text("".join(line(k, "some text") + ("\n\n" if i % 50 == 0 else "\n") for i, k in enumerate(keys)))
            wanted += keys
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # several splits a file
    try:
        parsed = sources.scan_paths(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
        numbered = sources.number_lines(parsed)
        got = [r.chunk_id for r in numbered.filter("chunk_id IS NOT NULL").orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == wanted
    assert numbered.select("ord").distinct().count() == numbered.count()
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan
