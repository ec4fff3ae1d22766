import pytest
from pyspark.sql import functions as F

from tenura.functions import yes_no
from tenura.operators import integrity, profile
from tenura.plans import prepare
from tenura.sources import tables


def test_other_text_becomes_null(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (None,)], "a STRING")
    assert [r[0] for r in df.select(yes_no("a")).collect()] == [True, False, None, None]


def test_target_keeps_rows_without_a_reason(spark):
    status = spark.createDataFrame(
        [("1", "Stayed", None, None), ("2", "Churned", "Other", "Deceased"),
         ("3", "Churned", "Other", "Moved")],
        "customer_id STRING, customer_status STRING, churn_category STRING, churn_reason STRING",
    )
    rows = {r.customer_id: r.is_voluntary_churn for r in prepare.target(status).collect()}
    assert rows == {"1": False, "3": True}


def test_null_addon_makes_the_count_null(spark):
    flags = ", ".join(f"{c} BOOLEAN" for c in prepare.ADDON_COLUMNS)
    df = spark.createDataFrame(
        [(True, *[True] * 8, "Month-to-Month", 72), (True, None, *[False] * 7, "One Year", 1),
         (True, *[False] * 8, "Two Year", 71), (False, None, *[False] * 7, "Two Year", 71)],
        f"internet_service BOOLEAN, {flags}, contract STRING, tenure_in_months INT",
    )
    rows = prepare.add_features(df).collect()
    assert [r.num_addon_services for r in rows] == [8, None, 0, None]
    assert [r.internet_without_security for r in rows] == [False, None, True, False]
    assert [r.no_addons_despite_internet for r in rows] == [False, None, True, False]
    assert [r.is_month_to_month for r in rows] == [True, False, False, False]
    assert [r.is_tenure_censored for r in rows] == [True, False, False, False]


def test_no_forbidden_column_in_the_view():
    assert not set(prepare.VIEW_COLUMNS) & set(prepare.FORBIDDEN_COLUMNS)
    assert len(prepare.VIEW_COLUMNS) == 43


def test_bad_value_and_wrong_header_are_errors(spark, tmp_path):
    schema = tables.source_schema("population")
    good = tmp_path / "good.csv"
    good.write_text("ID,Zip Code,Population\n1,00001,10\n2,00002,\n")
    rows = tables.scan_csv(spark, str(good), schema).collect()
    assert [(r.ID, r["Zip Code"], r.Population) for r in rows] == [(1, "00001", 10), (2, "00002", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text("ID,Zip Code,Population\nx,00001,10\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|FAILED_READ"):
        tables.scan_csv(spark, str(bad), schema).collect()
    other = tmp_path / "other.csv"
    other.write_text("ID,Zip,Population\n1,00001,10\n")
    with pytest.raises(Exception, match="header"):
        tables.scan_csv(spark, str(other), schema).collect()


def test_five_sources_from_csv_to_features(spark, sf_dir, tmp_path):
    from catalog.tables import raw_tables

    raw = raw_tables(spark, sf_dir)
    paths = {}
    for name, df in raw.items():
        paths[name] = str(tmp_path / name)
        df.write.option("header", True).csv(paths[name])
    scanned = tables.scan_sources(spark, paths)
    ours = prepare.feature_table(scanned)
    direct = prepare.feature_table(raw)
    assert ours.count() == direct.count() > 0
    key = ["customer_id", "num_addon_services", "internet_type", "is_voluntary_churn"]
    assert ours.select(key).exceptAll(direct.select(key)).count() == 0


def test_shape_report_of_matching_tables_is_empty(spark):
    df = spark.range(3).toDF("a")
    assert tables.shape_report({"t": df}, {"t": ["a"]}, {"t": 3}).count() == 0


def test_histogram_of_a_constant_has_one_full_bin(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v DOUBLE")
    bins = profile.histogram(df, "v").orderBy("bin").collect()
    assert len(bins) == 30
    assert sum(r.n_rows for r in bins) == 2
    assert (bins[0].lower, round(bins[-1].upper, 9)) == (4.5, 5.5)


def test_hot_key_counts(spark):
    # A third of all rows hold one key.
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1, id) AS k")
    row = integrity.duplicate_keys(df, "k").first()
    assert (row.n_rows, row.n_keys, row.duplicates) == (30_000, 20_001, 9_999)
    lookup = spark.range(15_000).toDF("k")
    lost = integrity.unmatched_rows(df, "k", lookup, "k").first()
    assert lost.unmatched == 10_000 + df.where(F.col("k") >= 15_000).count()


def test_correlation_of_a_constant_is_null(spark):
    df = spark.range(10).selectExpr("id AS a", "-id AS b", "1 AS c")
    rows = {(r.a, r.b): r for r in profile.correlations(df, ["a", "b", "c"]).collect()}
    assert rows[("a", "b")].r == pytest.approx(-1) and rows[("a", "b")].exact
    assert rows[("a", "c")].r is None and not rows[("a", "c")].strong
