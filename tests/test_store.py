"""The stored panel: merges, reruns, late batches, refused batches; arrivals that repeat."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from epitide.operators import merge, repair
from epitide.sources import bucketed, panel
from epitide.streaming import incremental

SCHEMA = "entity string, date date, value double, cases double"


def rows(spark, *cells):
    return spark.createDataFrame([(e, dt.date.fromisoformat(d), v, c) for e, d, v, c in cells], SCHEMA)


def store(spark, path):
    return panel.Panel(str(path), rows(spark).schema, ("entity", "date"), ("value", "cases"), F.date_format("date", "yyyy-MM"))


def held(spark, kept, version=None):
    return {(r.entity, str(r.date)): (r.value, r.cases) for r in kept.read(spark, version).collect()}


def test_merges_touch_their_partitions_only(spark, tmp_path):
    kept = store(spark, tmp_path / "p")
    assert kept.read(spark).count() == 0 and kept.history(spark).count() == 0
    first = kept.merge(rows(spark, ("a", "2020-01-01", 1.0, None), ("a", "2020-02-01", 2.0, 5.0)), "one")
    assert (first.version, first.parts) == (1, ("2020-01", "2020-02"))
    late = kept.merge(rows(spark, ("a", "2020-01-01", None, 7.0), ("b", "2020-01-09", 3.0, None)), "two")
    assert (late.version, late.parts) == (2, ("2020-01",))
    assert held(spark, kept) == {("a", "2020-01-01"): (1.0, 7.0), ("b", "2020-01-09"): (3.0, None), ("a", "2020-02-01"): (2.0, 5.0)}
    assert held(spark, kept, 1) == {("a", "2020-01-01"): (1.0, None), ("a", "2020-02-01"): (2.0, 5.0)}
    assert {(r.version, r.part, r.written) for r in kept.history(spark).collect()} == {(1, "2020-01", 1), (1, "2020-02", 1), (2, "2020-01", 2), (2, "2020-02", 1)}
    again = kept.merge(rows(spark, ("a", "2020-01-01", 99.0, 99.0)), "one")
    assert (again.version, again.parts) == (2, ()) and held(spark, kept)["a", "2020-01-01"] == (1.0, 7.0)
    nothing = kept.merge(rows(spark), "none")
    assert (nothing.version, nothing.parts) == (3, ()) and len(held(spark, kept)) == 3
    assert kept.read(spark, parts=["2020-02"]).count() == 1


def test_a_merge_reads_only_what_it_rewrites(spark, tmp_path):
    kept = store(spark, tmp_path / "p")
    kept.merge(rows(spark, *[("a", f"2020-{m:02d}-01", 1.0, 1.0) for m in range(1, 13)]), "year")
    written = kept._state(spark)[1]
    old = kept._read(spark, {"2020-03": written["2020-03"]})
    assert len(old.inputFiles()) == 1 and "part=2020-03" in old.inputFiles()[0]


def test_refused_batches_leave_the_store(spark, tmp_path):
    kept = store(spark, tmp_path / "p")
    checks = {"falls": panel.continuous("value"), "once": panel.single_rows(), "sum": panel.reconciled(F.col("cases"), F.col("value"), 0.5, 1.5)}
    kept.merge(rows(spark, ("a", "2020-01-01", 4.0, 4.0)), "one", checks)
    before, versions = held(spark, kept), kept.history(spark).count()
    for name, bad, broken in [
            ("low", [("a", "2020-01-01", 3.0, 3.0)], ["falls"]), ("twice", [("b", "2020-01-01", 3.0, 3.0)] * 2, ["once"]),
            ("ratio", [("b", "2020-01-01", 3.0, 9.0)], ["sum"]), ("all", [("a", "2020-01-01", 3.0, 9.0)] * 2, ["falls", "once", "sum"])]:
        with pytest.raises(panel.Refused) as refused:
            kept.merge(rows(spark, *bad), name, checks)
        assert refused.value.broken == broken
        assert held(spark, kept) == before and kept.history(spark).count() == versions
    done = kept.merge(rows(spark, ("a", "2020-01-01", 5.0, 5.0)), "low", checks)  # refused names may come again, corrected
    assert done.version == 2 and done.metrics == {"falls": 0, "once": 0, "sum": 1.0}


def test_a_good_batch_is_merged_in_one_pass(spark, tmp_path):
    """One read of the batch finds its partitions, one writes it; checks cost none."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    batch = rows(spark, *[("a", f"2020-01-{d:02d}", 1.0, 1.0) for d in range(1, 11)]).mapInArrow(count, SCHEMA)
    kept = store(spark, tmp_path / "p")
    kept.merge(batch, "one", {"once": panel.single_rows(), "bounds": panel.none_of(F.col("value") < 0)})
    assert seen.value == 20


def test_stated_partitions_save_a_read(spark, tmp_path):
    kept = store(spark, tmp_path / "p")
    batch = rows(spark, ("a", "2020-01-01", 1.0, 1.0), ("a", "2020-02-01", 2.0, 2.0))
    with pytest.raises(Exception, match="another partition than stated: 2020-02"):
        kept.merge(batch, "one", parts=["2020-01"])
    assert kept.read(spark).count() == 0
    assert kept.merge(batch, "one", parts=["2020-02", "2020-01"]).parts == ("2020-01", "2020-02") and len(held(spark, kept)) == 2


def test_repeated_rows_are_dropped_before_they_are_merged(spark, tmp_path):
    schema = "id long, at timestamp, entity string, date date, value double, cases double"
    t = dt.datetime(2020, 1, 1)
    kept, source = store(spark, tmp_path / "p"), str(tmp_path / "in")
    for k in range(3):
        cells = [(i, t, f"e{i}", dt.date(2020, 1, 1 + k), float(i), 1.0) for i in (10 * k, 10 * k, 10 * k + 1)] + [(0, t, "again", dt.date(2020, 5, 1), 9.0, 9.0)] * (k > 0)
        df = spark.createDataFrame(cells, schema)
        df.coalesce(1).write.mode("append").parquet(source)
        done = incremental.merge_new_files(spark, source, kept, str(tmp_path / "c"), {"once": panel.single_rows()}, schema=df.schema,
                                           identity=["id"], event_time="at", delay="5 days")
        assert [d.metrics for d in done if d.parts] == [{"once": 0}]
    assert len(held(spark, kept)) == 6 and not any(e == "again" for e, _ in held(spark, kept))


def test_odd_partitions_are_refused(spark, tmp_path):
    kept = store(spark, tmp_path / "p")
    with pytest.raises(ValueError, match="plain names"):
        kept.merge(spark.createDataFrame([("a", None, 1.0, 1.0)], SCHEMA), "null")


def test_stream_merges_shuffled_batches_to_one_result(spark, tmp_path):
    r = random.Random(3)
    cells = [(f"e{k % 4}", f"2020-{k % 6 + 1:02d}-{k % 27 + 1:02d}", float(k), float(k % 5)) for k in range(160)]
    whole = {}
    for e, d, v, c in cells:
        low = whole.get((e, d))
        whole[e, d] = (v, c) if low is None else (min(v, low[0]), min(c, low[1]))
    results = []
    for order in range(2):
        kept, source = store(spark, tmp_path / f"p{order}"), str(tmp_path / f"in{order}")
        keys = sorted(whole)
        r.shuffle(keys)
        for part in (keys[::3], keys[1::3], keys[2::3]):
            rows(spark, *[(*k, *whole[k]) for k in part]).coalesce(1).write.mode("append").parquet(source)
            done = incremental.merge_new_files(spark, source, kept, str(tmp_path / f"c{order}"))
            assert len(done) == 1 and set(done[0].parts) == {d[:7] for _, d in part}
            assert incremental.merge_new_files(spark, source, kept, str(tmp_path / f"c{order}")) == []
        results.append(held(spark, kept))
    assert results[0] == results[1] == whole


def test_repeated_arrivals_are_dropped_within_the_watermark(spark, tmp_path):
    schema = "id long, at timestamp, n int"
    t = dt.datetime(2020, 1, 1)
    batches = [[(1, t, 1), (2, t + dt.timedelta(days=1), 1), (1, t, 1)], [(2, t + dt.timedelta(days=1), 1), (3, t + dt.timedelta(days=2), 1)], [(1, t, 1), (4, t + dt.timedelta(days=40), 1)]]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in batches:
        df = spark.createDataFrame(batch, schema)
        df.coalesce(1).write.mode("append").parquet(source)
        incremental.load_new_files(spark, source, df.schema, out, str(tmp_path / "c"), identity=["id"], event_time="at", delay="10 days")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]


def physical(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_merges_by_known_levels_stay_in_hash_aggregation(spark):
    base = spark.range(100).select((F.col("id") % 7).alias("entity"), F.rand().alias("value"))
    for df in (merge.priority_merge(merge.stack_sources(*[base] * 6), ["entity"]),
               merge.priority_merge(base.withColumn("prio", F.col("entity") % 3), ["entity"], levels={1: "x", 2: "y"}, provenance="source")):
        plan = physical(df)
        assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2 and plan.count("Exchange hashpartitioning") == 1


def test_levels_and_structs_agree(spark):
    r = random.Random(5)
    cells = [(r.randrange(6), r.choice([None, 0, 1, 2, 7]), r.choice([None, 1.0, 2.0, 3.0])) for _ in range(200)]
    df = spark.createDataFrame(cells, "entity int, prio int, value double")
    by_struct = {x.entity: x.value for x in merge.priority_merge(df, ["entity"]).collect()}
    assert by_struct == {x.entity: x.value for x in merge.priority_merge(df, ["entity"], levels=(0, 1, 2, 7)).collect()}
    named = {x.entity: (x.value, x.value_source) for x in merge.priority_merge(df, ["entity"], provenance="source", levels={0: "z", 1: "o", 2: "t"}).collect()}
    for e, (value, source) in named.items():
        best = min(((p, v) for k, p, v in cells if k == e and v is not None and p in (0, 1, 2)), default=None)
        assert best is None or (value, source) == (best[1], "zot"[best[0]])


def test_merges_and_repairs_of_buckets_move_the_batch_only(spark):
    cells = [(f"e{k % 9}", dt.date(2020, 1, 1) + dt.timedelta(k // 9), float(k)) for k in range(270)]
    days = spark.createDataFrame(cells, "entity string, date date, value double")
    first = spark.table(bucketed.write_buckets(days, ["entity"], "date", 6))
    batch = spark.createDataFrame([("e1", dt.date(2020, 1, 2), 0.5), ("new", dt.date(2020, 1, 2), 1.0), ("e2", dt.date(2020, 1, 1), None)], days.schema)
    merged = bucketed.merge_batch(first, batch, ["entity"], "date", ["value"], 6)
    plan = physical(merged)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortAggregate" not in plan
    table = bucketed.write_buckets(merged, ["entity"], "date", 6)
    want = {(e, d): v for e, d, v in cells} | {("e1", dt.date(2020, 1, 2)): 0.5, ("new", dt.date(2020, 1, 2)): 1.0}
    assert {(r.entity, r.date): r.value for r in spark.table(table).collect()} == want
    assert "Exchange" not in physical(repair.cumulative_to_daily(spark.table(table), ["entity"]))
    nulls = spark.createDataFrame([(None, dt.date(2020, 1, 1), 1.0)], days.schema)
    assert spark.table(bucketed.write_buckets(nulls, ["entity"], "date", 6)).count() == 1
