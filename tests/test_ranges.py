import io
import random

import pandas as pd
import pytest

from factpanel.sources import ranges
from factpanel.sources.landing import land_tables, read_release, read_tsv


def slowly(data, state):
    """The state behind data, byte by byte."""
    for c in data:
        if state == ranges.QUOTED:
            state = ranges.QUOTE_IN_QUOTED if c == ord('"') else ranges.QUOTED
        elif c == ord('"') and state == ranges.QUOTE_IN_QUOTED:
            state = ranges.QUOTED
        elif c in b"\r\n":
            state = ranges.RECORD_START
        elif c == ord("\t"):
            state = ranges.FIELD_START
        elif c == ord('"') and state in (ranges.RECORD_START, ranges.FIELD_START):
            state = ranges.QUOTED
        else:
            state = ranges.IN_FIELD
    return state


def test_mappings_byte_by_byte_and_joined():
    rng = random.Random(1)
    for _ in range(5000):
        data = bytes(rng.choice(b'\t\n\r"""ab ') for _ in range(rng.randint(0, 14)))
        middle = rng.randint(0, len(data))
        for state in range(5):
            assert ranges.after(data, state) == slowly(data, state)
            assert ranges.after(data[middle:], ranges.after(data[:middle], state)) == slowly(data, state)


def table(rng, rows, newline):
    def field():
        if rng.random() < 0.3:
            return '"' + "".join(rng.choice(["a", '""', "\t", newline, "é", " "]) for _ in range(rng.randint(0, 9))) + '"'
        return rng.choice(["x", '5"', "", "é", "ab c", "NA"])

    lines = ["\t".join([f"r{i}", *[field() for _ in range(rng.choice([2, 2, 2, 1]))]]) for i in range(rows)]
    return ("a\tb\tc" + newline + newline.join(lines) + rng.choice(["", newline, newline * 2])).encode("latin-1")


def by_pandas(data):
    read = pd.read_csv(io.BytesIO(data), sep="\t", encoding="latin1", dtype=str)
    return [tuple(None if pd.isna(v) else v for v in row) for row in read.itertuples(index=False)]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("range_bytes", [64, 501, 1 << 25])
def test_rows_are_those_of_pandas(spark, tmp_path, newline, range_bytes):
    """In ranges down to 64 bytes, with tabs, doubled quotes and line ends in quoted fields."""
    rng = random.Random(range_bytes)
    expected = []
    for i in range(3):
        data = table(rng, rng.choice([0, 1, 60]), newline)
        (tmp_path / f"{i}.tsv").write_bytes(data)
        expected += by_pandas(data)
    paths = [str(tmp_path / f"{i}.tsv") for i in range(3)]
    found = read_tsv(spark, paths, ["a", "b", "c"], range_bytes=range_bytes)
    assert not found.where("_rejected").count()
    assert sorted(map(tuple, found.select("a", "b", "c").collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("name", ["sub", "num", "tag", "txt"])
def test_line_ends_in_any_table(spark, tmp_path, name):
    source = tmp_path / "raw" / "2024_1" / "source"
    source.mkdir(parents=True)
    (source / f"{name}.tsv").write_bytes(b'tag\tversion\tdoc\nA\tv1\t"one\ntwo"\nB\tv1\tplain\n')
    root = str(tmp_path / "landed")
    landed = land_tables(spark, str(tmp_path / "raw"), root, [name], include_txt=True)
    assert [(t.table, t.rows, t.rejected, t.error) for t in landed] == [(name, 2, 0, None)]
    rows = spark.read.parquet(f"{root}/{name}").select("tag", "version", "doc").collect()
    assert sorted(map(tuple, rows)) == [("A", "v1", "one\ntwo"), ("B", "v1", "plain")]


def test_a_record_over_many_ranges_and_many_tasks(spark, tmp_path):
    """A quoted field of many ranges is one record; the ranges of one file are many tasks."""
    source = tmp_path / "2024_1" / "source"
    source.mkdir(parents=True)
    long = "line\n" * 400 + 'x\t""y""\n'
    plain = "".join(f"r{i}\tv{i}\n" for i in range(3000))
    (source / "num.tsv").write_bytes(f'a\tb\nfirst\t"{long}"\n{plain}last\t"open'.encode())
    found = read_release(spark, str(tmp_path), "num", range_bytes=256)
    rows = {r.a: r.b for r in found.collect()}
    assert len(rows) == 3002 and rows["first"] == long.replace('""', '"') and rows["r2999"] == "v2999"
    files = spark.read.format("binaryFile").load(str(source)).selectExpr("path", "length AS bytes")
    per_task = ranges.records(files, 256).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(per_task) > 50 and max(r["count"] for r in per_task) < 500


def test_no_rows(spark, tmp_path):
    for name, data in (("empty", b""), ("header", b"a\tb\tc"), ("blank", b"a\tb\tc\n\n  \n")):
        (tmp_path / name).write_bytes(data)
        assert read_tsv(spark, [str(tmp_path / name)], ["a", "b", "c"]).collect() == []
