"""Quality checks, the gate, layer properties and physical-plan shapes."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import SF_SMALL, bronze_df, raw_row

from pyspark.sql import functions as F

from innkeep.operators import gold, quality as Q, rollups as R
from innkeep.operators.silver import build_silver
from innkeep.plans import datasets as D


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_checks_return_violating_rows(spark):
    rows = [raw_row(), raw_row(hotel="Resort", adr="-2.00", arrival_date_day_of_month="2"), raw_row(adr="NA", arrival_date_day_of_month="3")]
    silver = build_silver(bronze_df(spark, rows))
    acc = Q.accepted_values(silver, Q.ACCEPTED_VALUES, "silver").collect()
    assert [(r.column_name, r.value, r.occurrences) for r in acc] == [("hotel_type", "Resort", 1)]
    neg = Q.non_negative(silver, "adr").collect()
    assert [(str(r.invalid_value), r.occurrences) for r in neg] == [("-2.00", 1)]
    nn = Q.not_null(silver, ["adr", "hotel_type"], "silver", "_row_hash").collect()
    assert [r.column_name for r in nn] == ["adr"]
    assert Q.volume(silver, 3).count() == 0 and Q.volume(silver, 4).first().row_count == 3


def test_value_set_reports_missing_and_unexpected(spark):
    raw = bronze_df(spark, [raw_row(hotel="Hotel"), raw_row(hotel="Resort")])
    got = {(r.column_name, r.value, r.problem) for r in Q.value_set(raw, {"hotel": ["Hotel", "Apartment"]}).collect()}
    assert got == {("hotel", "Resort", "unexpected"), ("hotel", "Apartment", "missing")}


def test_gate_raises_on_violations(spark):
    silver = build_silver(bronze_df(spark, [raw_row(adr="-1.00")]))
    report = Q.report({"neg": Q.non_negative(silver, "adr"), "vol": Q.volume(silver, 1)})
    with pytest.raises(Q.QualityGateError, match="neg=1"):
        Q.gate(report)
    Q.gate(Q.report({"vol": Q.volume(silver, 1)}))


def test_layer_properties_on_driver_tables(spark):
    silver = D.silver(spark, SF_SMALL)
    landing = D.landing(spark, SF_SMALL)
    assert silver.count() == landing.select("_row_hash").distinct().count()
    pc = gold.popular_countries(silver).agg(F.sum("booking_share_pct")).first()[0]
    assert abs(float(pc) - 100.0) < 0.05 * 30
    mom = gold.mom_growth(silver)
    chk = mom.agg(F.sum("total_booking_amount"), F.sum(F.col("completed_bookings") + F.col("canceled_bookings")), F.sum("total_bookings")).first()
    s = silver.where(F.col("year_month").isNotNull()).agg(F.sum("revenue")).first()[0]
    assert chk[0] == s and chk[1] == chk[2]


def test_dedup_plan_limits_before_shuffle_and_prunes(spark):
    df = gold.country_stats(D.silver(spark, SF_SMALL))
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    scan = [ln for ln in df._jdf.queryExecution().sparkPlan().toString().split("\n") if "FileScan parquet" in ln]
    assert scan and "reservation_status_date" not in scan[0]


def test_filter_reaches_parquet_scan(spark):
    df = R.BookingFilter(types=["Hotel"], years=[1995], status="Completed").apply(D.silver_table(spark, SF_SMALL))
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(arrival_date_year" in text and "(arrival_date_year#" in text
    pushed = [line for line in text.split("\n") if "PushedFilters" in line]
    assert any("EqualTo(is_canceled,0)" in p and "EqualTo(hotel_type,Hotel)" in p for p in pushed)


def test_aggregations_are_partial_then_final(spark):
    df = gold.monthly_revenue(D.silver_table(spark, SF_SMALL))
    text = df._jdf.queryExecution().sparkPlan().toString()
    assert text.count("HashAggregate") >= 2


def test_global_rank_has_no_unpartitioned_sort_of_rows(spark):
    stats = gold.country_stats(D.silver_table(spark, SF_SMALL))
    ranked = gold.popular_countries(D.silver_table(spark, SF_SMALL))
    assert ranked.count() == stats.count()
    plan = ranked._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line and "], []," in line.replace("[], [", "], [], [")]
    # the only unpartitioned window runs over the histogram of counts, never over the ranked rows
    assert not any("country" in w for w in windows)


def test_hot_fingerprint_dedups_to_one_row(spark):
    from conftest import raw_df

    from innkeep.operators.bronze import new_rows, with_lineage

    hot = raw_df(spark, [raw_row()])
    copies = hot.select("*", F.explode(F.array_repeat(F.lit(1), 30_000)).alias("_k")).drop("_k").repartition(8)
    others = raw_df(spark, [raw_row(arrival_date_day_of_month=str(d)) for d in range(2, 22)])
    batch = with_lineage(copies.unionByName(others), "hot.csv", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    silver = build_silver(batch)
    assert silver.count() == 21
    fresh = new_rows(batch, with_lineage(others, "old.csv"))
    assert fresh.count() == 1


def test_unique_bronze_cleans_without_row_shuffle(spark):
    from conftest import raw_df

    from innkeep.operators.bronze import with_lineage

    rows = [raw_row(arrival_date_day_of_month=str(d)) for d in range(1, 29)]
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    unique = with_lineage(raw_df(spark, rows).repartition(4), "a.csv", stamp)
    auto = build_silver(unique)
    assert "hashpartitioning" not in plan_text(auto) and "Window" not in plan_text(auto)
    forced = build_silver(unique, dedup=True)
    assert "hashpartitioning(_row_hash" in plan_text(forced)
    assert sorted(map(tuple, auto.collect())) == sorted(map(tuple, forced.collect()))
    repeated = build_silver(unique.unionByName(unique))
    assert "Window" in plan_text(repeated) and repeated.count() == 28


def test_has_repeated(spark):
    from innkeep.operators.silver import has_repeated

    df = spark.createDataFrame([("a",), ("b",), ("c",)], "_row_hash string")
    assert not has_repeated(df)
    assert not has_repeated(df.where("false"))
    assert has_repeated(df.unionByName(df.where("_row_hash = 'b'")))


def test_value_set_two_columns_and_null(spark):
    df = spark.createDataFrame(
        [("Hotel", "0"), ("Hotel", None), ("Hotel", "1"), ("Hotel", "1")], "hotel string, is_canceled string"
    )
    got = {(r.column_name, r.value, r.problem) for r in Q.value_set(df, Q.RAW_VALUE_SETS).collect()}
    assert got == {("hotel", "Apartment", "missing"), ("is_canceled", None, "unexpected")}


def test_checkpoint_folder_comes_from_the_session(spark):
    from innkeep.session import checkpoint_dir

    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert spark.sparkContext.master.startswith("local")


def test_fixture_rebalances_only_few_split_scans(spark):
    from innkeep.sources.fixture import raw_reservations_from
    from innkeep.sources.tables import read_table

    orders, customer, nation = (read_table(spark, SF_SMALL, t) for t in ("orders", "customer", "nation"))
    few = raw_reservations_from(orders.coalesce(1), customer, nation)
    many = raw_reservations_from(orders.repartition(2 * spark.sparkContext.defaultParallelism), customer, nation)
    assert "RebalancePartitions" in few._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert few.count() == many.count()


def test_dataset_checks_same_with_shared_profile(spark):
    from conftest import raw_df

    rows = [raw_row(country=c, is_canceled=k, adr=a) for c, k, a in [("PRT", "1", "-1.00"), ("NULL", "0", "5.00"), ("ESP", "1", "NA")]]
    raw = raw_df(spark, rows)
    shared = Q.raw_profile(raw).checkpoint(eager=True)
    for check, kwargs in [(Q.rate_bounds, {}), (Q.diversity, {}), (Q.negative_share, {})]:
        alone = [tuple(r) for r in check(raw, **kwargs).collect()]
        assert alone == [tuple(r) for r in check(raw, profile=shared, **kwargs).collect()]
    (p,) = shared.collect()
    assert (p.total_rows, p.canceled_rows, p.distinct_countries, p.negative_rows) == (3, 2, 2, 1)


def test_numeric_summary_scans_once_and_reuses_the_histogram_shuffle(spark):
    df = R.numeric_summary(R.BookingFilter().apply(D.silver(spark, SF_SMALL)))
    df.collect()
    text = plan_text(df)
    final = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0] if "== Final Plan ==" in text else text
    assert "ReusedExchange" in final
    # one scan of the cleaned layer's source feeds every quartile branch
    assert final.count("Scan parquet") == 1


def test_unique_fingerprint_matches_plain_unique(spark):
    import hashlib

    hashes = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)]
    cases = [
        hashes,  # all unique
        hashes + hashes[:3] + hashes[:1],  # repeats, one value three times
        hashes + ["not-hex", "not-hex", "zz", None, None],  # non-hex repeats, NULLs ignored
    ]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "_row_hash string")
        want = sorted(tuple(r) for r in Q.unique(df, "_row_hash", "t").collect())
        got = sorted(tuple(r) for r in Q.unique_fingerprint(df, "_row_hash", "t").collect())
        assert got == want
    assert len(want) == 1 and want[0][2] == "not-hex"


def test_compiled_checks_count_like_the_single_ones(spark):
    from innkeep.operators import check_compiler as C
    from innkeep.plans.catalog import DECLARED_CHECKS

    rows = [
        raw_row(hotel=h, adr=a, is_canceled=c, country=k, company=str(i % 3))
        for i, (h, a, c, k) in enumerate([("Resort", "-1.00", "0", "PRT"), ("Hotel", "NA", "2", "NULL"), ("Resort", "NA", "3", "ESP"), ("Hotel", "-2.00", "1", "ESP"), ("Hotel", "-2.00", "1", "ESP")])
    ]
    raw = bronze_df(spark, rows + rows[:2]).withColumn("_row_hash", F.when(F.col("company") == "2", F.upper("_row_hash")).otherwise(F.col("_row_hash")))
    silver = build_silver(bronze_df(spark, rows), strict=False, dedup=False)
    countries = spark.createDataFrame([("PRT", 1, None), ("PRT", 2, 1), (None, None, 1), (None, 1, 1)], "country string, total_bookings long, popularity_rank long")
    mom = spark.createDataFrame([(None, None), ("Hotel", None)], "hotel_type string, year_month string")
    got = {r.check_name: (r.violations, r.passed) for r in C.report({"landing": raw, "silver": silver, "countries": countries, "mom": mom}, DECLARED_CHECKS).collect()}
    single = {
        "dq_unique": Q.unique_fingerprint(silver, "_row_hash", "s").count() + Q.unique(countries, "country", "c").count(),
        "dq_not_null": Q.not_null(silver, Q.SILVER_NOT_NULL, "s", "_row_hash").count() + Q.not_null(countries, Q.COUNTRIES_NOT_NULL, "c", "country").count() + Q.not_null(mom, Q.MOM_NOT_NULL, "m", "hotel_type").count(),
        "dq_accepted_values": Q.accepted_values(silver, Q.ACCEPTED_VALUES, "s").count(),
        "dq_value_set": Q.value_set(raw, Q.RAW_VALUE_SETS).count(),
        "dq_non_negative": Q.non_negative(silver, "adr").count(),
        "dq_volume": Q.volume(silver).count(),
        "dq_rate_bounds": Q.rate_bounds(raw).count(),
        "dq_diversity": Q.diversity(raw).count(),
        "dq_negative_share": Q.negative_share(raw).count(),
        "dq_hash_format": Q.hash_format(raw).count(),
    }
    assert {k: v for k, (v, _) in got.items()} == single
    assert all(single[k] > 0 for k in single if k not in ("dq_rate_bounds",)) and all(p == (v == 0) for v, p in got.values())
    two = C.report({"c": countries}, [C.Check("a", "c", "unique", ("country", "total_bookings")), C.Check("b", "c", "unique", ("popularity_rank",))])
    assert {r.check_name: r.violations for r in two.collect()} == {"a": 2, "b": 1}
    for wrong in (C.Check("x", "c", "no such kind"), C.Check("x", "nowhere", "min_rows", (), 1)):
        with pytest.raises(ValueError):
            C.report({"c": countries}, [C.Check("a", "c", "not_null", ("country",)), wrong])


def test_checks_of_no_rows(spark):
    from innkeep.operators import check_compiler as C
    from innkeep.plans.catalog import DECLARED_CHECKS

    raw = bronze_df(spark, [raw_row()]).limit(0)
    got = {r.check_name: r.violations for r in C.report({"landing": raw}, [c for c in DECLARED_CHECKS if c.table == "landing"]).collect()}
    assert got == {"dq_value_set": 4, "dq_rate_bounds": 0, "dq_diversity": 1, "dq_negative_share": 0, "dq_hash_format": 0}


def test_report_reads_silver_twice_at_most(spark):
    from innkeep.plans.catalog import QUERIES

    plan = plan_text(QUERIES["dq_report"](spark, SF_SMALL))
    reads = [line for line in plan.splitlines() if line.startswith("Location:")]
    silver = {f for f in D.silver_table(spark, SF_SMALL).inputFiles()}
    folder = next(iter(silver)).split("/data/")[0].removeprefix("file:").lstrip("/")
    assert sum(folder in line for line in reads) <= 1  # and once for the grouped pass, which runs while the report is built
    assert sum("Scan parquet" in line and "(" in line and line.startswith("(") for line in plan.splitlines()) <= 6


def test_rank_of_any_column_needs_no_single_task(spark):
    from innkeep.operators.ranking import rank_by

    rows = [(i, None if i % 11 == 0 else (i * 37 % 1000) / 4, f"n{i % 300}" if i % 7 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v double, s string")
    df.createOrReplaceTempView("to_rank")
    expected = spark.sql("SELECT id, rank() OVER (ORDER BY v DESC NULLS LAST) AS a, rank() OVER (ORDER BY s NULLS LAST) AS b FROM to_rank")
    got = rank_by(rank_by(df, "v", "a"), "s", "b", descending=False)
    assert sorted(map(tuple, got.select("id", "a", "b").collect())) == sorted(map(tuple, expected.collect()))
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    assert rank_by(df.limit(0), "v", "a").count() == 0
