"""Months that come in several deliveries."""

import pytest

from factpanel.plans import state
from factpanel.sources.tables import FactTables
from factpanel.streaming.months import advance_complete_months

TABLES = {
    "sub": "adsh\tcik\nf{n}\t{n}\nsame\t7\n",
    "num": "adsh\ttag\tvalue\nf{n}\tAssets\t{n}\n",
    "pre": "adsh\tline\nf{n}\t{n}\n",
    "tag": "tag\tversion\nAssets\t\"v\n{n}\"\n",
}


def deliver(raw, folder, n, tables):
    source = raw / folder / "source"
    source.mkdir(parents=True, exist_ok=True)
    for t in tables:
        (source / f"{t}.tsv").write_text(TABLES[t].format(n=n))


def filings(spark, root, period):
    return sorted(r.adsh for r in FactTables(spark, root).sub(period).select("adsh").collect())


@pytest.mark.parametrize("restart", [False, True])
def test_a_month_waits_alone(spark, tmp_path, restart):
    """January waits for two tables over three runs; February goes ahead. With a new checkpoint in
    between, all files are seen anew and the outcome is the same."""
    raw, root, marks = tmp_path / "raw", str(tmp_path / "landed"), [str(tmp_path / "one"), str(tmp_path / "two")]

    def run(mark=marks[0]):
        advance_complete_months(spark, str(raw), root, mark).awaitTermination()

    deliver(raw, "2024_01", 1, ["sub"])
    run()
    assert state.last_month(spark, root) is None
    deliver(raw, "2024_01", 1, ["num"])
    deliver(raw, "2024_02", 2, list(TABLES))
    run()
    assert state.last_month(spark, root) == (2024, 2)
    assert filings(spark, root, "2024_1") == ["f2", "same"]
    deliver(raw, "2024_01", 1, ["pre"])
    run()
    assert filings(spark, root, "2024_1") == ["f2", "same"]
    deliver(raw, "2024_01", 1, ["tag"])
    run(marks[1] if restart else marks[0])
    assert filings(spark, root, "2024_1") == ["f1", "f2", "same"]
    done = {tuple(r) for r in spark.read.parquet(f"{root}/_state/landed").collect()}
    assert done == {(2024, 1), (2024, 2)}
    run()  # with the first checkpoint, nothing that is complete is lost or doubled
    assert filings(spark, root, "2024_1") == ["f1", "f2", "same"]
