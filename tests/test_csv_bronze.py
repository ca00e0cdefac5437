"""CSV extracts into bronze: quoting, column matching, malformed rows, idempotent loads."""

from __future__ import annotations

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import SF_SMALL, raw_row

from innkeep.operators.bronze import VolumeCheckError, load_csv, read_bronze
from pyspark.sql import functions as F

from innkeep.schema import RAW_COLUMNS
from innkeep.sources import csv_records as records
from innkeep.sources.csv_source import check_columns, read_csv, scan_expected, schema_reports


def write(path, rows, columns=RAW_COLUMNS, extra=None):
    cols = list(columns) + (list(extra) if extra else [])
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(cols)
        for r in rows:
            w.writerow([r.get(c, "") for c in cols])
    return str(path)


def scan(spark, path):
    return scan_expected(spark, path).collect()


def test_quotes_commas_and_newlines_roundtrip(spark, tmp_path):
    rows = [raw_row(company='Acme, "Hotels"\nLtd', customer_type="Group")]
    (r,) = scan(spark, write(tmp_path / "a.csv", rows))
    assert r.company == 'Acme, "Hotels"\nLtd' and r.customer_type == "Group"


def test_reordered_and_extra_columns_match_by_name(spark, tmp_path):
    rows = [raw_row(hotel="Apartment", adr="55.50")]
    path = write(tmp_path / "b.csv", rows, columns=list(reversed(RAW_COLUMNS)), extra=["note"])
    (r,) = scan(spark, path)
    assert r.hotel == "Apartment" and r.adr == "55.50"
    assert "note" not in r.asDict()


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "c.csv", [raw_row()], columns=[c for c in RAW_COLUMNS if c != "adr"])
    with pytest.raises(ValueError, match="adr"):
        scan(spark, path)
    rep = check_columns([c for c in RAW_COLUMNS if c != "adr"] + ["x"])
    assert rep.missing == ("adr",) and rep.extra == ("x",)


def test_blank_field_reads_as_empty_text(spark, tmp_path):
    (r,) = scan(spark, write(tmp_path / "d.csv", [raw_row(country="")]))
    assert r.country == ""


def test_short_and_long_rows_are_flagged(spark, tmp_path):
    path = tmp_path / "e.csv"
    good = raw_row()
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(RAW_COLUMNS)
        w.writerow([good[c] for c in RAW_COLUMNS])
        w.writerow([good[c] for c in RAW_COLUMNS][:20])
        w.writerow([good[c] for c in RAW_COLUMNS] + ["surplus"])
    rows = scan(spark, str(path))
    assert len(rows) == 3
    assert [r._malformed for r in rows] == [False, True, True]


def test_load_twice_is_idempotent_and_overlap_inserts_only_new(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    a = [raw_row(arrival_date_day_of_month=str(d)) for d in (1, 2, 3)]
    b = [raw_row(arrival_date_day_of_month=str(d)) for d in (3, 4)]
    path_a = write(tmp_path / "a.csv", a + a[:1])
    path_b = write(tmp_path / "b.csv", b, columns=list(reversed(RAW_COLUMNS)))

    m1 = load_csv(spark, path_a, bronze, min_rows=1).metrics.first()
    assert (m1.rows_read, m1.inserted, m1.duplicates, m1.total) == (4, 3, 1, 3)
    m2 = load_csv(spark, path_a, bronze, min_rows=1).metrics.first()
    assert (m2.inserted, m2.total) == (0, 3)
    res = load_csv(spark, path_b, bronze, min_rows=1)
    m3 = res.metrics.first()
    assert (m3.inserted, m3.total) == (1, 4)
    stored = read_bronze(spark, bronze)
    assert stored.count() == 4 and stored.select("_row_hash").distinct().count() == 4
    (new,) = res.inserted.collect()
    assert new.arrival_date_day_of_month == "4" and new._source_file == "b.csv"


def test_volume_gate_publishes_nothing(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    path = write(tmp_path / "a.csv", [raw_row()])
    with pytest.raises(VolumeCheckError):
        load_csv(spark, path, bronze, min_rows=10)
    with pytest.raises(Exception):
        read_bronze(spark, bronze).count()


@pytest.fixture(params=[None, "256b"])
def split(request, spark):
    """The session's split size: the default, and one that cuts every file."""
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    if request.param:
        spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, old)


def python_rows(*paths):
    """What Python's csv reader gives, by name, in the raw columns' order."""
    out = []
    for path in paths:
        with open(path, newline="", encoding="utf-8") as f:
            out += [tuple(r[c] for c in RAW_COLUMNS) for r in csv.DictReader(f)]
    return sorted(out)


def spark_rows(df):
    return sorted(tuple(r) for r in df.select(*RAW_COLUMNS).collect())


def test_folder_of_different_headers_is_read_by_name(spark, tmp_path, split):
    folder = tmp_path / "mixed"
    folder.mkdir()
    paths = [
        write(folder / "span.csv", [raw_row(company='Acme\n"Two"'), raw_row(arrival_date_day_of_month="2")]),
        write(folder / "flat.csv", [raw_row(company='Quoted ""x"", y'), raw_row(adr="7.00")]),
        write(folder / "back.csv", [raw_row(hotel="Apartment", arrival_date_day_of_month="9")], columns=list(reversed(RAW_COLUMNS))),
        write(folder / "more.csv", [raw_row(country="ESP")], columns=list(reversed(RAW_COLUMNS)), extra=["note"]),
        write(folder / "b[1].csv", [raw_row(country="FRA")]),
    ]
    df = scan_expected(spark, str(folder))
    assert spark_rows(df) == python_rows(*paths)
    assert not any(r._malformed for r in df.collect())
    (back,) = df.where("_file_name = 'back.csv'").collect()
    assert (back.hotel, back.arrival_date_day_of_month) == ("Apartment", "9")
    reports = schema_reports(spark, str(folder))
    assert [r.missing for r in reports] == [()] * len(reports) and {x for r in reports for x in r.extra} == {"note"}


def test_file_with_glob_characters_loads(spark, tmp_path):
    path = write(tmp_path / "b[1].csv", [raw_row(country="FRA")])
    assert [r.country for r in scan(spark, path)] == ["FRA"]


def test_one_file_without_a_column_is_named(spark, tmp_path):
    folder = tmp_path / "lacking"
    folder.mkdir()
    write(folder / "a.csv", [raw_row()])
    write(folder / "short.csv", [raw_row()], columns=[c for c in RAW_COLUMNS if c != "hotel"])
    with pytest.raises(ValueError, match=r"short.csv lacks the columns \['hotel'\]"):
        scan(spark, str(folder))


def test_parse_depends_on_the_text_not_on_its_size(spark, tmp_path, split):
    path = tmp_path / "quotes.csv"
    row = [raw_row()[c] for c in RAW_COLUMNS]
    first, second = ['5" bed', *row[1:31]], [*row[1:31], '6" x']
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(",".join(RAW_COLUMNS) + "\n" + ",".join(first) + ',"open\nend"\n' + 'a"b,' + ",".join(second) + "\n")
    df = scan_expected(spark, str(path))
    assert spark_rows(df) == python_rows(path) and df.count() == 2


def test_empty_folder_and_header_only_file(spark, tmp_path):
    assert scan(spark, write(tmp_path / "h.csv", [])) == []
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert scan(spark, str(tmp_path / "none")) == []


def test_inferred_types(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "t.csv", [raw_row(), raw_row(adr="7.25")]), infer_types=True)
    kinds = dict(df.dtypes)
    assert (kinds["adr"], kinds["adults"], kinds["hotel"]) == ("double", "int", "string")
    assert sorted(r.adr for r in df.collect()) == [7.25, 100.0]


def test_inferred_types_do_not_depend_on_the_order_of_files(spark, tmp_path):
    values = {"a": ["1", "2"], "b": ["3000000000", ""], "c": ["x", "4"], "d": ["1.5", "2e3"], "e": ["12345678901234567890123", "1"]}
    for order in ("abcde", "ecbda", "dab", "ea"):
        folder = tmp_path / order
        folder.mkdir()
        for k, name in enumerate(order):
            (folder / f"{k}.csv").write_text("n,day,flag,at,none\n" + "".join(f"{v},2020-01-0{k + 1},true,2020-01-01 10:00:0{k},\n" for v in values[name]))
        kinds = dict(read_csv(spark, str(folder), infer_types=True).dtypes)
        assert kinds["n"] == ("string" if "c" in order else "double" if "d" in order else "decimal(38,0)")
        assert (kinds["day"], kinds["flag"], kinds["at"], kinds["none"]) == ("date", "boolean", "timestamp", "string")
    mixed = tmp_path / "mixed-days"
    mixed.mkdir()
    (mixed / "a.csv").write_text("v,w\n2020-01-01,2020-01-01\n")
    (mixed / "b.csv").write_text("v,w\n2020-01-01 01:02:03,7\n")
    assert dict(read_csv(spark, str(mixed), infer_types=True).dtypes) == {"v": "timestamp", "w": "string", "_file_name": "string"}
    assert sorted(str(r.v) for r in read_csv(spark, str(mixed), infer_types=True).collect()) == ["2020-01-01 00:00:00", "2020-01-01 01:02:03"]


def test_load_of_a_mixed_folder(spark, tmp_path):
    folder = tmp_path / "load"
    folder.mkdir()
    paths = [
        write(folder / "a.csv", [raw_row(), raw_row(adr="1.00")]),
        write(folder / "b.csv", [raw_row(adr="2.00")], columns=list(reversed(RAW_COLUMNS))),
        write(folder / "c.csv", [raw_row(adr="3.00"), raw_row()], columns=RAW_COLUMNS[7:] + RAW_COLUMNS[:7], extra=["x"]),
    ]
    bronze = str(tmp_path / "bronze")
    m = load_csv(spark, str(folder), bronze, min_rows=1).metrics.first()
    assert (m.rows_read, m.inserted, m.malformed) == (5, 4, 0)
    assert spark_rows(read_bronze(spark, bronze)) == sorted(set(python_rows(*paths)))


def test_unreadable_bronze_is_an_error(spark, tmp_path):
    bronze = tmp_path / "broken"
    bronze.mkdir()
    (bronze / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|schema"):
        load_csv(spark, write(tmp_path / "a.csv", [raw_row()]), str(bronze), min_rows=1)


def test_whole_records_are_read_once_and_split(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "big.csv", [raw_row(arrival_date_day_of_month=str(1 + i % 28), adr=f"{i}.00", company='a "b", c') for i in range(3000)])
    monkeypatch.setattr(records, "spanning_records", lambda *a: pytest.fail("read again"))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        assert records.lines(spark, [path]).rdd.getNumPartitions() > 4
        rows = scan_expected(spark, path).select("adr", "company", "_malformed").collect()
        assert len(rows) == 3000 and not any(r._malformed for r in rows) and {r.company for r in rows} == {'a "b", c'}
    finally:
        spark.conf.set(key, old)


def test_one_spanning_record_does_not_stop_the_split(spark, tmp_path):
    rows = [raw_row(arrival_date_day_of_month=str(1 + i % 28), adr=f"{i}.00") for i in range(3000)]
    rows[1500]["company"] = 'x"\n' * 30_000 + "end"  # over two splits
    path = write(tmp_path / "span.csv", rows)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "32768")
    try:
        found = scan_expected(spark, path)
        assert spark_rows(found) == python_rows(path)
        read = records.spanning_records(spark, [path])
        by_task = [r["count"] for r in read.groupBy("block").count().collect()]
        assert len(by_task) > 10 and sum(by_task) == 3001 and max(by_task) < 600
    finally:
        spark.conf.set(key, old)


_CSV_TEXT = st.text(alphabet=st.sampled_from(list('ab,,""\n\n\r')), max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_CSV_TEXT, min_size=1, max_size=4))
def test_any_text_is_read_like_pythons_reader(spark, tmp_path_factory, texts):
    folder = tmp_path_factory.mktemp("text")
    expected = []
    for k, text in enumerate(texts):
        if text.count('"') % 2:
            text += '"'
        # the file is cut into splits of a few bytes
        text = "x" + str(k) + "\n" + text + "\n"
        (folder / f"f{k}.csv").write_bytes(text.encode())
        expected += [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "8b")
    try:
        found = [r["fields"] for r in records.spanning_records(spark, [str(folder)]).collect()]
        assert sorted(found) == sorted(expected)
        plain = records.lines(spark, [str(folder)]).where(~records.is_blank(F.col("line")))
        whole = [r["f"] for r in plain.where(records.is_whole(F.col("line"))).select(records.fields_of(F.col("line")).alias("f"), "line").collect()]
        again = [list(csv.reader([r["line"]]))[0] for r in plain.where(records.is_whole(F.col("line"))).collect()]
        assert sorted(whole) == sorted(again)
    finally:
        spark.conf.set(key, old)


def test_new_rows_plan_and_hot_fingerprint(spark):
    """One fingerprint in half the batch, no broadcast: reduced before the exchange, anti join on the same partitioning."""
    from conftest import bronze_df
    from pyspark.sql import functions as F

    from innkeep.operators.bronze import new_rows

    stored = bronze_df(spark, [raw_row(arrival_date_day_of_month=str(d)) for d in range(1, 11)])
    hot = bronze_df(spark, [raw_row(arrival_date_day_of_month="12")], source="b.csv")
    hot = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("col").repartition(4)
    batch = hot.unionByName(bronze_df(spark, [raw_row(arrival_date_day_of_month=str(d)) for d in (5, 5, 11)], source="b.csv"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = new_rows(batch, stored)
        days = sorted(r.arrival_date_day_of_month for r in fresh.collect())
        plan = fresh._jdf.queryExecution().sparkPlan().toString()
        executed = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert days == ["11", "12"]
    assert plan.index("LeftAnti") < plan.index("Window ")  # the window is below the join
    first = executed[: executed.index("Initial Plan")] if "Initial Plan" in executed else executed
    assert first.count("hashpartitioning(_row_hash") == 2  # the batch once, the stored keys once
    below = first[first.index("Exchange hashpartitioning(_row_hash") :]
    assert "WindowGroupLimit" in below


_FIELD = st.text(alphabet=st.sampled_from(list('ab ,"\n\r')), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_FIELD, min_size=3, max_size=3), min_size=1, max_size=6), st.integers(0, 5))
def test_auto_mode_equals_multiline_on_random_fields(spark, tmp_path_factory, files, cut):
    folder = tmp_path_factory.mktemp("prop")
    # two files: rows before and after ``cut``; fields land in company/agent/board
    for i, part in enumerate((files[:cut], files[cut:])):
        rows = [raw_row(company=a, agent=b, board=c) for a, b, c in part]
        write(folder / f"p{i}.csv", rows)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "512b")  # every file is checked; clean ones are split
    try:
        def rows(mode):
            df = scan_expected(spark, str(folder), mode)
            return sorted(tuple(r) for r in df.select(*RAW_COLUMNS, "_file_name", "_malformed").collect())

        assert rows("auto") == rows(True)
    finally:
        spark.conf.set(key, old)


def test_auto_mode_reads_gzip_whole(spark, tmp_path):
    import gzip

    plain = write(tmp_path / "z.csv", [raw_row(company="One\nTwo"), raw_row(arrival_date_day_of_month="3")])
    folder = tmp_path / "gz"
    folder.mkdir()
    with open(plain, "rb") as src, gzip.open(folder / "z.csv.gz", "wb") as dst:
        dst.write(src.read())
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256b")
    try:
        rows = scan_expected(spark, str(folder)).select("company", "_malformed").collect()
    finally:
        spark.conf.set(key, old)
    assert sorted((r.company, r._malformed) for r in rows) == sorted([("One\nTwo", False), (raw_row()["company"], False)])


def test_load_removes_its_staged_scan_and_refuses_other_paths(spark, tmp_path):
    import glob
    import os

    from innkeep.session import checkpoint_dir, remove_staged

    staging = os.path.join(checkpoint_dir(spark), "staging")
    listed = lambda: set(glob.glob(os.path.join(staging, "bronze-*-*")) + glob.glob(os.path.join(staging, "bronze-new*")))
    before = listed()
    bronze = str(tmp_path / "bronze-rm")
    res = load_csv(spark, write(tmp_path / "r.csv", [raw_row(), raw_row(arrival_date_day_of_month="2")]), bronze, min_rows=1)
    assert listed() == before
    with pytest.raises(VolumeCheckError):
        load_csv(spark, write(tmp_path / "r2.csv", [raw_row()]), str(tmp_path / "gated"), min_rows=10)
    assert listed() == before
    assert res.inserted.count() == 2 and read_bronze(spark, bronze).count() == 2
    with pytest.raises(ValueError):
        remove_staged(spark, bronze)
    assert read_bronze(spark, bronze).count() == 2


def test_faulty_extract_is_written_by_many_tasks(spark, monkeypatch):
    import glob

    from innkeep.plans import datasets

    rows = datasets.faulty(spark, SF_SMALL)
    monkeypatch.setattr(datasets, "_STAGED", {})
    monkeypatch.setattr(datasets, "faulty", lambda *a: rows.repartition(5))
    path = datasets.faulty_csv(spark, SF_SMALL)
    files = [open(f).read().splitlines() for f in glob.glob(f"{path.removeprefix('file:')}/part-*")]
    files = [f for f in files if f]
    assert all(f.count(",".join(RAW_COLUMNS)) == 1 and f[0] == ",".join(RAW_COLUMNS) for f in files)
    assert sum(len(f) > 1 for f in files) == 5
    assert sum(len(f) - 1 for f in files) == rows.count()
