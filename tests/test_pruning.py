"""Events pruned before the shuffle, stored by patient, and rows built in
pieces."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import aggregate_events, calculate_index_dates, filter_events, sparse_rows
from cohortlens.operators.cohort import prune_events
from cohortlens.operators.joins import key_filter
from cohortlens.plans.sample_build import build_samples, build_samples_colocated, colocated_counts
from cohortlens.sources.event_table import write_event_table
from helpers import rows


def _inputs(spark, n=20_000):
    ev = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, F.lit(0)).when(F.col("id") % 101 == 1, F.lit(None)).otherwise(F.col("id") % 997 + 1).cast("long").alias("patientid"),
        F.concat(F.lit("DIAG"), (F.col("id") % 41).cast("string")).alias("eventid"),
        F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") % 3000).cast("int")).alias("etimestamp"), F.lit(1.0).alias("value"))
    mo = spark.range(0, 998, 3).select(
        F.col("id").alias("patientid"), F.date_add(F.lit("2004-06-01").cast("date"), (F.col("id") % 40).cast("int")).alias("mtimestamp"),
        F.when(F.col("id") % 5 == 0, 0).when(F.col("id") % 7 != 0, 1).alias("label"))
    return ev, mo


def _plain(ev, idx, days=2000):
    return (ev.join(idx, "patientid").where(F.col("etimestamp").between(F.date_sub("index_date", days), F.col("index_date")))
            .select("patientid", "eventid", "etimestamp", "value"))


def test_bounds_reach_the_scan_and_fewer_rows_the_shuffle(spark, tmp_path):
    ev, mo = _inputs(spark)
    ev.write.parquet(str(tmp_path / "ev"))
    ev = spark.read.parquet(str(tmp_path / "ev"))
    idx = calculate_index_dates(ev, mo).where("patientid % 50 = 3").checkpoint()
    pruned = prune_events(ev, idx, 100)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(etimestamp" in plan and "LessThanOrEqual(etimestamp" in plan
    assert "SortMergeJoin" not in plan  # the filter is broadcast: no shuffle of events
    lo = idx.agg(F.date_sub(F.min("index_date"), 100)).first()[0]
    kept, own = pruned.count(), ev.join(idx.select("patientid").distinct(), "patientid", "left_semi").where(F.col("etimestamp") >= F.lit(lo)).count()
    assert own <= kept < 0.1 * ev.count()
    assert rows(filter_events(ev, idx, 100)) == rows(_plain(ev, idx, 100))


def test_window_join_equals_plain_join(spark):
    ev, mo = _inputs(spark)
    idx = calculate_index_dates(ev, mo)
    want = rows(_plain(ev, idx))
    assert rows(filter_events(ev, idx)) == want
    assert rows(filter_events(ev, idx, hot_rows=900, patients=False)) == want
    assert filter_events(ev, idx.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None)], "patientid long, index_date date")
    assert filter_events(ev, none).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_key_filter_keeps_every_key_of_the_side(spark, kind):
    data = spark.range(50_000).select(F.col("id").cast(kind).alias("k"))
    side = spark.range(0, 50_000, 25).select(F.col("id").cast(kind).alias("k"))
    kept = key_filter(data, side, "k")
    assert kept.join(side, "k", "left_semi").count() == 2000
    assert kept.count() < 2000 + 0.03 * 48_000
    assert key_filter(data, side, "k", max_bytes=10).count() == 50_000  # beyond the bound all rows stay
    assert key_filter(data.unionByName(spark.createDataFrame([(None,)], f"k {kind}")), side, "k").where("k is null").count() == 0
    assert key_filter(data, side.limit(0), "k").count() == 0


def _nodes(plan):
    """(depth, name) of a physical plan's nodes, parents first."""
    out = []

    def walk(node, above):
        out.append((node.nodeName(), above))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), [*above, node.nodeName()])

    walk(plan, [])
    return out


def test_bucketed_events_are_not_exchanged(spark, tmp_path):
    ev, mo = _inputs(spark)
    table = write_event_table(ev, str(tmp_path / "t"), buckets=4, hot_rows=2000)
    assert table.hot.select("patientid").distinct().count() == 2  # patient 0 and nobody
    assert table.cold.count() + table.hot.count() == ev.count()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = colocated_counts(table, mo, hot_rows=2000)
        cold = [above for name, above in _nodes(counts._jdf.queryExecution().executedPlan()) if name.startswith("Scan parquet") and table.name in name]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert cold
    for above in cold:  # from the scan up: aggregated before any exchange
        nearest = next((x for x in reversed(above) if x in ("Exchange", "BroadcastExchange") or "Aggregate" in x), "")
        assert "Exchange" not in nearest
    event_rows = [above for above in cold if "ShuffledHashJoin" in above or "SortMergeJoin" in above]
    assert event_rows and any(not any(x == "Exchange" for x in above) for above in event_rows)
    assert rows(counts) == rows(aggregate_events(filter_events(ev, calculate_index_dates(ev, mo))))
    a, b = build_samples_colocated(table, mo, hot_rows=2000, cache=False), build_samples(ev, mo, cache=False)
    assert rows(a["samples"]) == rows(b["samples"])
    table.drop()


def test_rows_in_pieces_equal_rows_at_once(spark):
    data = spark.range(30_000).select((F.col("id") % 3).alias("patientid"), F.floor(F.col("id") / 3).alias("event_index"),
                                      (F.lit(0.001) + F.col("id") % 999 / 1000).alias("normalized_feature_value"))
    whole = rows(sparse_rows(data, n_codes=10_000))
    assert rows(sparse_rows(data, piece_codes=64)) == whole
    assert len(whole[0][1]) == 10_000 and [int(t.split(":")[0]) for t in whole[0][1]] == list(range(10_000))


def test_a_patient_with_millions_of_codes_is_gathered_in_pieces(spark):
    n = 5_000_000
    data = spark.range(n).select(F.lit(1).alias("patientid"), F.col("id").alias("event_index"), F.lit(0.5).alias("normalized_feature_value"))
    built = sparse_rows(data)
    first = data.groupBy(F.floor(F.col("event_index") / (1 << 16))).count().agg(F.max("count")).first()[0]
    assert first == 1 << 16  # what one step gathers at most
    row = built.select(F.size("sparse_feature").alias("n"), F.element_at("sparse_feature", -1).alias("last")).first()
    assert (row.n, row.last) == (n, f"{n - 1}:0.500")


def test_index_dates_as_strings(spark):
    ev = spark.createDataFrame([(1, "DIAG1", "2000-01-01", 1.0), (1, "DIAG1", "1990-01-01", 1.0)], "patientid long, eventid string, etimestamp string, value double")
    idx = spark.createDataFrame([(1, "2000-02-01")], "patientid long, index_date string")
    assert rows(filter_events(ev, idx)) == [(1, "DIAG1", dt.date(2000, 1, 1), 1.0)]


def test_buckets_follow_the_events(spark, tmp_path, monkeypatch):
    from cohortlens.sources import event_table
    ev, mo = _inputs(spark)
    monkeypatch.setattr(event_table, "BUCKET_ROWS", 1000)
    table = write_event_table(ev, str(tmp_path / "t"), buckets=4, hot_rows=2000)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe extended {table.name}").collect()}
    assert described["Num Buckets"] == "20"
    assert rows(colocated_counts(table, mo, hot_rows=2000)) == rows(aggregate_events(filter_events(ev, calculate_index_dates(ev, mo))))


def test_uncached_samples_count_the_events_once(spark):
    """Index dates, hot patients and the window join each read the events; the
    code table and the rows read the written counts."""
    ev, mo = _inputs(spark, 5000)
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = ev.mapInArrow(run, ev.schema)
    got = build_samples(counted, mo, cache=False)["samples"].collect()
    assert seen.value == 3 * 5000
    assert sorted(map(tuple, got), key=repr) == rows(build_samples(ev, mo)["samples"])


def test_counts_need_no_exchange_after_the_window_join(spark):
    ev, mo = _inputs(spark)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    idx = calculate_index_dates(ev, mo).checkpoint()
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = aggregate_events(filter_events(ev, idx, patients=False))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") <= 2
    assert "Exchange hashpartitioning(patientid" in plan and ", eventid" not in plan[plan.index("Exchange"):].split("\n")[0]
