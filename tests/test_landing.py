import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from factpanel.operators.screens import revenue_screen
from factpanel.plans import state, updates
from factpanel.plans.fundamentals import fundamentals_panel, numeric_fundamentals, sheet_fundamentals
from factpanel.plans.screening import run_screening_job, run_simple_screener
from factpanel.sources.files import list_files, unreadable_files
from factpanel.sources.landing import land_tables, read_release
from factpanel.sources.sinks import write_csv, write_json, write_parquet
from factpanel.sources.tables import FOLDERS, FactTables
from factpanel.streaming.months import land_new_months


def put(root, folder, table, text):
    path = root / folder / "source" / f"{table}.tsv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("latin-1"))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


TRICKY = (
    "a\tb\tc\n"
    '1\t"say ""hi""\té\nnext"\tx\n'  # quote, tab, Latin-1 letter and line end inside a field
    "2\tshort\n"
    "3\tlong\tx\ty\n"
    "4\tx\ty\t\n"                     # long only by a trailing tab
    "5\t\tNA\n"
    '6\t"tab\tinside"\n'              # short, with a tab that is no separator
    "7\t5\"\tn/a\n"                   # a quote in the middle of a field is text
)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_tricky_tsv(spark, tmp_path, newline):
    put(tmp_path, "2024_1", "sub", TRICKY.replace("\n", newline))
    df = read_release(spark, str(tmp_path), "sub", multi_line=True)
    assert df.columns == ["a", "b", "c", "_rejected", "dataset_year", "dataset_quarter"]
    got = {r["a"]: r for r in df.collect()}
    assert sorted(got) == ["1", "2", "3", "4", "5", "6", "7"]
    assert got["1"]["b"].replace("\r\n", "\n") == 'say "hi"\té\nnext'
    assert got["1"]["c"] == "x"
    assert (got["2"]["b"], got["2"]["c"]) == ("short", None)
    assert (got["5"]["b"], got["5"]["c"]) == (None, None)
    assert (got["6"]["b"], got["6"]["c"]) == ("tab\tinside", None)
    assert (got["7"]["b"], got["7"]["c"]) == ('5"', None)
    assert [a for a, r in sorted(got.items()) if r["_rejected"]] == ["3", "4"]
    assert got["1"]["dataset_year"] == 2024


def test_land(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "landed")
    put(raw, "2024_1", "sub", "adsh\tcik\nx\t1\n")
    put(raw, "2024_2", "sub", "cik\tadsh\textra\n2\ty\tz\n2\ty\tz\tq\n")  # other order, new column
    put(raw, "2024_02", "sub", "adsh\tcik\nm\t9\n")                     # a month, not a quarter
    put(raw, "2024_1", "num", "adsh\ttag\tvalue\nx\tRevenues\t5\n")
    put(raw, "2024_1", "txt", "adsh\nx\n")
    done = {d.table: d for d in land_tables(spark, str(raw), root)}
    assert sorted(done) == ["num", "sub"]
    assert (done["sub"].rows, done["sub"].rejected) == (2, 1)
    tables = FactTables(spark, root)
    cols = ["adsh", "cik", "extra", "dataset_year", "dataset_quarter"]
    assert rows(tables.sub(), *cols) == [("x", "1", None, 2024, 1), ("y", "2", "z", 2024, 2)]
    assert rows(tables.sub("2024_2"), "adsh") == [("y",)]
    assert tables.sub("2024_2") is tables.sub((2024, 2))
    assert rows(FactTables.of_period(spark, root, 2024, 1).sub(), "adsh") == [("x",)]
    with pytest.raises(AnalysisException):
        tables.pre()
    assert tables.find("pre") is None
    assert rows(tables.periods(), "period_key") == [("2024_1",), ("2024_2",)]
    assert rows(FactTables(spark, root, ["2024_2"]).periods(), "period_key") == [("2024_2",)]
    assert [d.table for d in land_tables(spark, str(raw), root, ["txt"], include_txt=True)] == ["txt"]
    # landing one period again replaces it and leaves the others
    put(raw, "2024_1", "sub", "adsh\tcik\nx2\t1\n")
    land_tables(spark, str(raw), root, ["sub"], only=[(2024, 1)])
    assert rows(FactTables(spark, root).sub(), "adsh") == [("x2",), ("y",)]


def test_failing_table_leaves_the_others(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "landed")
    put(raw, "2024_1", "sub", "adsh\tadsh\nx\t1\n")
    put(raw, "2024_1", "num", "adsh\ttag\tvalue\nx\tRevenues\t5\n")
    done = {d.table: d for d in land_tables(spark, str(raw), root)}
    assert "adsh" in done["sub"].error and done["num"].rows == 1
    assert FactTables(spark, root).find("sub") is None


def test_period_pruning(spark, conf, tmp_path):
    conf(spark__sql__maxMetadataStringLength="10000")
    path = str(tmp_path / "sub")
    data = [("a", 2024, 1), ("b", 2024, 2)]
    df = spark.createDataFrame(data, "adsh string, dataset_year int, dataset_quarter int")
    df.write.partitionBy("dataset_year", "dataset_quarter").parquet(path)
    plan = FactTables(spark, str(tmp_path), [(2024, 2)]).sub()._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "2024" in pruned and "dataset_quarter" in pruned


def folder_table(spark, root, period, table, data, schema):
    path = f"{root}/{period}/parquet/{table}.parquet"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(path)


def test_folder_layout(spark, tmp_path):
    root = str(tmp_path)
    folder_table(spark, root, "2024_1", "sub", [("a", "1")], "adsh string, cik string")
    folder_table(spark, root, "2024_2", "sub", [("b", "2", "x")], "adsh string, cik string, more string")
    folder_table(spark, root, "2024_02", "sub", [("m", "3")], "adsh string, cik string")
    tables = FactTables(spark, root, layout=FOLDERS)
    cols = ["adsh", "more", "dataset_year", "dataset_quarter"]
    assert rows(tables.sub(), *cols) == [("a", None, 2024, 1), ("b", "x", 2024, 2)]
    assert rows(tables.sub((2024, 1)), "adsh") == [("a",)]
    assert rows(tables.inventory(), "dataset_year", "dataset_quarter", "table") == [(2024, 1, "sub"), (2024, 2, "sub")]
    with pytest.raises(ValueError):
        FactTables(spark, root, layout="zip")
    given = FactTables(spark, root, layout=FOLDERS, schemas={"sub": "adsh string, more string"})
    assert rows(given.sub(), *cols) == [("a", None, 2024, 1), ("b", "x", 2024, 2)]
    assert given.only(["2024_2"]).sub().count() == 1


def test_unreadable_files(spark, tmp_path):
    good, bad = tmp_path / "good file.parquet", tmp_path / "bad.parquet"
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(str(good))
    bad.write_bytes(b"PAR1 not really PAR1")
    found = unreadable_files(list_files(spark, str(tmp_path))).collect()
    assert len(found) == 1 and found[0]["path"].endswith("/bad.parquet") and found[0]["error"]


def month(raw, folder, number, tables=("sub", "num", "pre", "tag")):
    for t in tables:
        if t == "sub":
            text = f"adsh\tcik\tform\tperiod\nf{number}\t{number}\t10-K\t20240131\nsame\t1\t10-K\t20240131\n"
        elif t == "num":
            text = f"adsh\ttag\tvalue\nf{number}\tRevenues\t{number}\nsame\tRevenues\t1\n"
        else:
            text = f"adsh\nf{number}\n"
        put(raw, folder, t, text)


def test_damage_in_a_later_row_group_is_found(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / "x.parquet"
    pq.write_table(pa.table({"a": list(range(10_000))}), path, row_group_size=1000, use_dictionary=False, compression="NONE")
    group = pq.ParquetFile(path).metadata.row_group(7).column(0)
    data = bytearray(path.read_bytes())
    data[group.data_page_offset : group.data_page_offset + 24] = b"\xff" * 24
    path.write_bytes(bytes(data))
    files = list_files(spark, str(tmp_path))
    assert unreadable_files(files).count() == 1
    assert unreadable_files(files, first_rows=5).count() == 0


def test_paths_are_spread_over_tasks(spark):
    files = spark.range(1000).select(F.concat(F.lit("/nowhere/"), "id").alias("path"))
    tasks = unreadable_files(files).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 1000


@pytest.mark.parametrize(
    ("tables", "state", "line"),
    [
        (["sub", "num", "pre", "tag"], [(2023, 12)], (2024, 1, True, 2024, 1)),
        (["sub", "num", "pre"], [(2023, 12)], (2024, 1, False, 2023, 12)),
        (["sub", "num", "pre", "tag"], [], (2024, 1, True, 2024, 1)),
        (["sub", "num", "pre", "tag"], [(2024, 1)], (2024, 2, False, 2024, 1)),
        ([], [(2023, 12)], (2024, 1, False, 2023, 12)),
    ],
)
def test_state_after_an_update(spark, tables, state, line):
    observed = spark.createDataFrame([(2024, 1, t) for t in tables], "year int, month int, table string")
    stored = spark.createDataFrame(state, "year int, month int")
    assert tuple(updates.advanced(observed, stored).first()) == line


def test_monthly_update(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "landed")
    today = dt.date(2024, 2, 15)
    month(raw, "2024_01", 1, ("sub", "num", "pre"))
    assert not updates.run_monthly_update(spark, str(raw), root, today)  # tag is missing
    assert state.last_month(spark, root) is None
    month(raw, "2024_01", 1)
    assert updates.run_monthly_update(spark, str(raw), root, today)
    assert state.last_month(spark, root) == (2024, 1)
    assert not updates.run_monthly_update(spark, str(raw), root, today)  # February is not there
    month(raw, "2024_02", 2)
    assert updates.run_monthly_update(spark, str(raw), root, today)
    # the quarter holds both months, the filing of both once
    assert rows(FactTables(spark, root).sub("2024_1"), "adsh") == [("f1",), ("f2",), ("same",)]


def test_candidate_month():
    assert updates.candidate_month(None, dt.date(2024, 1, 9)) == (2023, 12)
    assert updates.candidate_month(None, dt.date(2024, 3, 31)) == (2024, 2)
    assert updates.candidate_month((2024, 12)) == (2025, 1)
    assert [updates.quarter_of((2024, m)) for m in (1, 3, 4, 12)] == [(2024, 1), (2024, 1), (2024, 2), (2024, 4)]


def test_pipeline_and_screening_job(spark, tmp_path):
    raw, root, out = tmp_path / "raw", str(tmp_path / "landed"), str(tmp_path / "out")
    put(raw, "2023_4", "sub", "adsh\tcik\tform\tperiod\nq\t1\t10-K\t20231231\n")
    put(raw, "2023_4", "num", "adsh\ttag\tvalue\nq\tRevenues\t7\n")
    month(raw, "2024_01", 1)
    month(raw, "2024_03", 3)
    put(raw, "2024_03", "tag", "adsh\tlater\nf3\tx\n")  # a column that January lacks
    updates.run_pipeline(spark, str(raw), root)
    tables = FactTables(spark, root)
    assert rows(tables.periods(), "period_key") == [("2023_4",), ("2024_1",)]
    assert rows(tables.tag("2024_1"), "adsh", "later") == [("f1", None), ("f3", "x")]
    panel = fundamentals_panel(tables, ["2023_4", "2024_1"])
    got = {r["adsh"]: r for r in panel.collect()}
    assert {k: r["revenue"] for k, r in got.items()} == {"q": 7.0, "f1": 1.0, "f3": 3.0, "same": 1.0}
    assert got["f1"]["cik"] == 1 and got["q"]["ttm_revenue"] == 7.0
    with pytest.raises(ValueError):
        fundamentals_panel(tables, [])
    sheet = sheet_fundamentals(tables, [2023, 2024], [4, 1, 2], n=2)
    assert [r["revenue"] for r in sheet.collect()] == [7.0, 3.0]
    assert numeric_fundamentals(tables, "2024_1").count() == 3

    assert run_screening_job(tables, out) is None  # nothing recorded as landed
    state.record_month(spark, root, (2024, 3))
    path = run_screening_job(tables, out)
    assert path.endswith("fundamentals_screener_2024_03")
    written = spark.read.option("header", "true").csv(path)
    assert [r["adsh"] for r in written.orderBy("revenue").collect()][-1] == "f3"
    assert run_screening_job(tables, out) is None  # screened already
    assert revenue_screen(numeric_fundamentals(tables, "2023_4")).count() == 1


def test_simple_screener_outputs(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "landed")
    put(raw, "2024_1", "sub", "adsh\tcik\tname\tform\tfy\tfp\tperiod\tfiled\na\t1\tA\t10-K\t2024\tFY\t1\t2\n")
    put(raw, "2024_1", "num", "adsh\ttag\tvalue\na\tRevenues\t10\na\tRevenues\t20\na\tNetIncomeLoss\t5\n")
    land_tables(spark, str(raw), root)
    csv, js = str(tmp_path / "csv"), str(tmp_path / "json")
    out = run_simple_screener(FactTables(spark, root), "2024_1", min_revenue=15, output_csv=csv, output_json=js)
    assert rows(out, "adsh", "revenue", "net_margin") == [("a", 20.0, 0.25)]
    assert spark.read.option("header", "true").csv(csv).count() == 1
    record = json.loads(spark.read.text(js).first()[0])
    assert record["revenue"] == 20.0 and record["eps_basic"] is None


def test_sinks(spark, tmp_path):
    df = spark.sql("select 'a \"b\", c' t, array(1, 2) xs, map('k', 1) m")
    write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "c")).first()
    assert tuple(back) == ('a "b", c', "[1,2]", '{"k":1}')
    write_json(df, str(tmp_path / "j"))
    write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).first()["xs"] == [1, 2]


def test_stream_of_months(spark, tmp_path):
    raw, root, mark = tmp_path / "raw", str(tmp_path / "landed"), str(tmp_path / "mark")

    def run():
        query = land_new_months(spark, str(raw), root, mark)
        query.awaitTermination()

    month(raw, "2024_01", 1)
    run()
    assert state.last_month(spark, root) == (2024, 1)
    month(raw, "2024_02", 2, ("sub", "num"))
    with pytest.raises(Exception, match="incomplete"):
        run()
    assert state.last_month(spark, root) == (2024, 1)
    month(raw, "2024_02", 2, ("pre", "tag"))
    run()  # the failed files come again, with the late ones
    assert state.last_month(spark, root) == (2024, 2)
    want = [("f1",), ("f2",), ("same",)]
    assert rows(FactTables(spark, root).sub("2024_1"), "adsh") == want
    run()  # nothing new
    assert rows(FactTables(spark, root).sub("2024_1"), "adsh") == want
