"""Stages that are read again, and those that are not."""

from dataclasses import replace

from chunkwright.options import Options
from chunkwright.plans import reuse, testset
from chunkwright.session import fresh_dir
from test_golden_sets import chunks


def test_only_what_changed_runs_again(spark, monkeypatch):
    df, _, _ = chunks(spark)
    options, store = Options(min_tokens=1), fresh_dir(spark, "stages")
    ran = []
    for name in ("annotate", "select_bundles", "build_requests"):
        plain = getattr(testset, name)
        monkeypatch.setattr(testset, name, lambda *a, n=name, f=plain: ran.append(n) or f(*a))

    def run(df, options):
        ran.clear()
        stages = reuse.Stages(spark, store, reuse.snapshot(df))
        result = testset.build_testset(df, options, stages=stages)
        return sorted((r.bundle_id, r.query_type, r.query) for r in result.evaluated.collect())

    first = run(df, options)
    assert ran == ["annotate", "select_bundles", "build_requests"] and first
    assert run(df.repartition(7), options) == first and ran == []
    assert run(df, replace(options, temperature=0.9)) == first and ran == ["build_requests"]
    run(df, replace(options, num_distractors=2))
    assert ran == ["select_bundles", "build_requests"]
    run(df, replace(options, max_tokens=300))
    assert ran == ["annotate", "select_bundles", "build_requests"]
    run(df.filter("ord > 3"), options)
    assert ran == ["annotate", "select_bundles", "build_requests"]


def test_a_stage_that_broke_off_is_not_taken(spark):
    store = fresh_dir(spark, "stages")
    first = reuse.Stages(spark, store, "s")
    assert first.keep("a", (1,), lambda: spark.range(3)).count() == 3 and not first.reused["a"]

    def broken():
        raise RuntimeError("lost")

    try:
        first.keep("b", (), broken)
    except RuntimeError:
        pass
    second = reuse.Stages(spark, store, "s")
    assert second.has("a", (1,)) and not second.has("a", (2,))
    second.keep("a", (1,), broken)
    assert second.reused["a"]
    assert second.keep("b", (), lambda: spark.range(2)).count() == 2 and not second.reused["b"]


def test_a_snapshot_is_of_rows_not_of_their_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "ord bigint, t string")
    assert reuse.snapshot(a) == reuse.snapshot(a.repartition(3).select("t", "ord"))
    assert reuse.snapshot(a) != reuse.snapshot(a.distinct()) and reuse.snapshot(a) != reuse.snapshot(a.limit(0))
