import json

from factpanel.operators import audit, quality
from factpanel.plans.checks import panel_check, run_audit, run_checks
from factpanel.sources.tables import FOLDERS, FactTables

SUB = "adsh string, cik string, form string"
NUM = "adsh string, value double"
APPLE, MICROSOFT = "0000320193", "0000789019"


def put(spark, root, period, table, rows, schema):
    path = f"{root}/{period}/parquet/{table}.parquet"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def audited(spark, root):
    rows = run_audit(FactTables(spark, root, layout=FOLDERS)).collect()
    assert len(rows) == 1
    return rows[0], json.loads(rows[0]["known_classification_json"])


def test_without_filings(spark, tmp_path):
    put(spark, str(tmp_path), "2025_1", "num", [("a1", 1.0)], NUM)
    row, classes = audited(spark, str(tmp_path))
    assert (row["sub_exists"], row["num_exists"]) == (False, True)
    assert (row["sub_row_count"], row["num_row_count"]) == (None, 1)
    assert classes["Apple"] == "absent_from_sub"
    assert len(classes) == 9


def test_without_facts(spark, tmp_path):
    put(spark, str(tmp_path), "2025_1", "sub", [("a1", APPLE, "10-Q")], SUB)
    row, classes = audited(spark, str(tmp_path))
    assert (row["sub_exists"], row["num_exists"]) == (True, False)
    assert row["distinct_cik_count_in_num"] is None
    assert classes["Apple"] == "absent_from_num"


def test_other_company_only(spark, tmp_path):
    put(spark, str(tmp_path), "2025_1", "sub", [("a1", MICROSOFT, "10-Q")], SUB)
    put(spark, str(tmp_path), "2025_1", "num", [("a1", 1.0)], NUM)
    _, classes = audited(spark, str(tmp_path))
    assert classes["Apple"] == "absent_from_sub"
    assert classes["Microsoft"] == "usable_numeric_rows_present"


def test_filing_without_facts(spark, tmp_path):
    put(spark, str(tmp_path), "2025_2", "sub", [("a1", APPLE, "10-Q")], SUB)
    put(spark, str(tmp_path), "2025_2", "num", [("other", 1.0)], NUM)
    _, classes = audited(spark, str(tmp_path))
    assert classes["Apple"] == "absent_from_num"


def test_audit_report(spark, tmp_path):
    root = str(tmp_path / "private" / "data-root")
    put(spark, root, "2025_1", "sub", [("a1", APPLE, "10-Q"), ("a2", "789019.0", None)], SUB)
    put(spark, root, "2025_1", "num", [("a1", 100.0), ("a2", None), (None, 3.0)], NUM)
    put(spark, root, "2024_4", "sub", [("a1", APPLE, "10-Q"), ("a3", None, "10-Q")], SUB)
    out = str(tmp_path / "audit")
    rows = {r["quarter"]: r for r in run_audit(FactTables(spark, root, layout=FOLDERS), output_csv=out).collect()}
    now, before = rows["2025_1"], rows["2024_4"]
    assert (now["sub_row_count"], now["num_row_count"]) == (2, 3)
    assert (now["distinct_cik_count_in_sub"], now["distinct_cik_count_in_num"]) == (2, 2)
    assert json.loads(now["form_counts_json"]) == {"10-Q": 1, "<null>": 1}
    assert json.loads(now["known_classification_json"])["Microsoft"] == "present_in_num_but_not_usable"
    assert json.loads(now["known_presence_usable_json"])["Apple"] is True
    # a null company id is not a company
    assert before["distinct_cik_count_in_sub"] == 1
    text = "\n".join(r[0] for r in spark.read.text(out).collect())
    assert "2025_1" in text and "data-root" in text and str(tmp_path) not in text
    assert (now["period_dir"], now["parquet_dir"]) == ("data-root/2025_1", "data-root/2025_1/parquet")


def test_missing_columns(spark):
    period = ", dataset_year int, dataset_quarter int"
    sub = spark.createDataFrame([("a1", APPLE, 2025, 1)], "adsh string, cik string" + period)
    bare = spark.createDataFrame([("a1", 2025, 1)], "adsh string" + period)
    only = {"Apple": APPLE}
    one = lambda s, n: audit.classify_coverage(s, n, only).first()["classification"]
    assert one(sub, bare) == "present_in_num_but_not_usable"
    assert one(bare, bare) == "absent_from_sub"
    assert one(sub, bare.withColumnRenamed("adsh", "x")) == "absent_from_num"


def test_completeness(spark):
    seen = [(2024, 1, t, 10) for t in ("sub", "num", "pre", "tag", "txt")]
    seen += [(2024, 2, "sub", 10), (2024, 2, "num", 0), (2024, 3, "readme", 5)]
    observed = spark.createDataFrame(seen, "dataset_year int, dataset_quarter int, table string, bytes bigint")
    periods = spark.createDataFrame([(2024, 4), (2024, 1)], "dataset_year int, dataset_quarter int")
    got = {r["dataset_quarter"]: r for r in quality.period_completeness(observed, periods=periods, min_bytes=1).collect()}
    state = {q: (r["exists"], r["complete"], r["missing_files"]) for q, r in got.items()}
    assert state == {
        1: (True, True, []), 2: (True, False, ["num", "pre", "tag"]),
        3: (True, False, ["sub", "num", "pre", "tag"]), 4: (False, False, []),
    }


def test_validate_panel(spark):
    df = spark.createDataFrame([(None, -1.0), (1, 2.0)], "cik int, revenue double")
    row = quality.validate_panel(df).first()
    assert row["status"] == "ISSUES" and row["n_rows"] == 2
    assert [e.split(":")[0].split(" ")[0] for e in row["errors"]] == ["Missing", "Some", "Negative"]
    assert "'ttm_net_income'" in row["errors"][0]


def test_integrity(spark):
    period = ", dataset_year int, dataset_quarter int"
    sub = spark.createDataFrame(
        [("1", "x", 2024, 1), ("1", None, 2024, 1), ("2", "y", 2024, 1), (None, "z", 2024, 2)],
        "cik string, name string" + period,
    )
    got = {r["dataset_quarter"]: (r["status"], r["issues"], r["warnings"]) for r in quality.sub_integrity(sub).collect()}
    assert got == {1: ("ISSUES", ["null_name"], ["duplicate_cik (2)"]), 2: ("ISSUES", ["null_cik"], [])}
    num = spark.createDataFrame([(1.0, None, 2024, 1), (None, "d", 2024, 1)], "value double, ddate string" + period)
    row = quality.num_integrity(num).first()
    assert (row["status"], row["null_value_count"], row["null_ddate_count"]) == ("OK", 1, 1)
    row = quality.num_integrity(num.drop("value", "ddate")).first()
    assert (row["status"], row["issues"], row["null_value_count"]) == ("ISSUES", ["missing_value_column"], None)


def test_periods_without_the_table(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, "2024_1", "sub", [("a", "1", "A", "10-K", "20240331")], PANEL_SUB)
    put(spark, root, "2024_1", "num", [("a", "Revenues", "5", "x")], PANEL_NUM)
    put(spark, root, "2024_2", "num", [("b", "Revenues", "5", "x")], PANEL_NUM)
    lines = run_checks(FactTables(spark, root, layout=FOLDERS)).collect()
    state = {(r["check"], r["period"]): r["status"] for r in lines if r["check"] in ("sub", "num")}
    assert state == {("sub", "2024_1"): "OK", ("sub", "2024_2"): "NOT_FOUND", ("num", "2024_1"): "OK", ("num", "2024_2"): "OK"}


def test_undefined_counts_are_missing(spark):
    period = ", dataset_year int, dataset_quarter int"
    bare = spark.createDataFrame([("a1", "10-K", 2025, 1)], "adsh string, form string" + period)
    num = spark.createDataFrame([("a1", 1.0, 2025, 1)], "adsh string, value double" + period)
    row = audit.audit_quarters(bare, num).first()
    assert (row["distinct_cik_count_in_sub"], row["distinct_cik_count_in_num"]) == (None, None)
    sub = spark.createDataFrame([("a1", APPLE, 2025, 1)], "adsh string, cik string" + period)
    row = audit.audit_quarters(sub, num.drop("adsh")).first()
    assert (row["distinct_cik_count_in_sub"], row["distinct_cik_count_in_num"]) == (1, None)


PANEL_SUB = "adsh string, cik string, name string, form string, period string"
PANEL_NUM = "adsh string, tag string, value string, ddate string"


def test_panel_check_states(spark, conf, tmp_path):
    conf(spark__sql__ansi__enabled="true")
    (tmp_path / "empty").mkdir()
    assert panel_check(FactTables(spark, str(tmp_path / "empty"), layout=FOLDERS)).first()["status"] == "NO_DATA"
    root = str(tmp_path / "bad")
    put(spark, root, "2024_1", "sub", [("a", "x1", "A", "10-K", "20240331")], PANEL_SUB)
    put(spark, root, "2024_1", "num", [("a", "Revenues", "5", "x")], PANEL_NUM)
    row = panel_check(FactTables(spark, root, layout=FOLDERS)).first()
    assert row["status"] == "ERROR" and "CAST_INVALID_INPUT" in row["errors"][0]


def test_all_checks(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, "2024_1", "sub", [("a", "1", "A", "10-K", "20240331")], PANEL_SUB)
    put(spark, root, "2024_1", "num", [("a", "Revenues", "-5", "x")], PANEL_NUM)
    (tmp_path / "2024_1" / "parquet" / "pre.parquet").write_bytes(b"broken")
    tables = FactTables(spark, root, layout=FOLDERS)
    got = {}
    for r in run_checks(tables).collect():
        got.setdefault(r["check"], []).append(r)
    assert got["periods"][0]["issues"] == ["tag"]
    assert got["sub"][0]["status"] == "OK"
    assert got["num"][0]["meta"]["null_value_count"] == "0"
    assert got["fundamentals"][0]["status"] == "ISSUES"
    assert got["rows_sub"][0]["meta"] == {"n_rows": "1"}
    assert "pre.parquet" in got["files"][0]["issues"][0]
    assert got["rows_pre"][0]["status"] == "ERROR"
    assert "rows_tag" not in got  # no such table: nothing to count
