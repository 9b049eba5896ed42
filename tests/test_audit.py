import re

from pyspark.sql import functions as F

from factpanel.operators import audit

PERIOD = "dataset_year int, dataset_quarter int"


def test_lines(spark):
    text = "one\r\ntwo 1234\rthree\x0bfour five 99999\n\n   pad 777777  \n"
    df = spark.createDataFrame([(1, "web", text), (2, "mail", "1234"), (3, "web", None)], "id int, src string, text string")
    found = audit.classify_lines(
        df, "text", ["id"], [("number", r"[0-9]{4,}", ["web"]), ("any", r"(?i)FIVE|four|1234", None)], group="src"
    )
    got = sorted(tuple(r) for r in found.collect())
    assert got == [
        (1, 2, "number", "two 1234"), (1, 4, "any", "four"), (1, 5, "number", "five 99999"),
        (1, 7, "number", "pad 777777"), (2, 1, "any", "1234"),
    ]
    # blank lines are no findings, whatever the pattern matches
    every = audit.classify_lines(df, "text", ["id"], [("all", r"^\s*", None)])
    assert sorted(r["line"] for r in every.where("id = 1").collect()) == [1, 2, 3, 4, 5, 7]
    # the same lines as Python sees them
    assert [i for i, line in enumerate(text.splitlines(), 1) if re.search("[0-9]{4,}", line)] == [2, 5, 7]


def test_filings_without_facts_keeps_null_ids(spark):
    sub = spark.createDataFrame([("a", 2024, 1), ("b", 2024, 1), (None, 2024, 1), (None, 2024, 1), ("a", 2024, 2)], f"adsh string, {PERIOD}")
    num = spark.createDataFrame([("a", 2024, 1)] * 5 + [(None, 2024, 1)], f"adsh string, {PERIOD}")
    got = sorted((str(r[0]), r[2]) for r in audit.filings_without_facts(sub, num).collect())
    assert got == [("None", 1), ("None", 1), ("a", 2), ("b", 1)]


def test_audit_reads_facts_once(spark, tmp_path):
    """Data columns of the facts are scanned once; row counts need none of them."""
    cols = f"adsh string, value string, note string, {PERIOD}"
    path = str(tmp_path / "num")
    spark.createDataFrame([("a", "1", "n", 2024, 1)], cols).write.partitionBy("dataset_year", "dataset_quarter").parquet(path)
    num = spark.read.parquet(path)
    sub = spark.createDataFrame([("a", "1", "10-K", 2024, 1)], f"adsh string, cik string, form string, {PERIOD}")
    tables = num.select("dataset_year", "dataset_quarter").distinct().withColumn("table", F.lit("num"))
    plan = audit.audit_quarters(sub, num, tables=tables)
    scans = plan._jdf.queryExecution().executedPlan().toString()
    assert scans.count("ReadSchema: struct<adsh:string,value:string>") == 1
    assert "note" not in "".join(re.findall(r"ReadSchema: \S+", scans))
