"""Raw tab-separated releases to partitioned Parquet."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factpanel.operators.unions import union_by_name
from factpanel.schema import PERIOD_COLS, RELEASE_TABLES
from factpanel.sources.files import header_lines, list_files
from factpanel.sources.ranges import RANGE_BYTES, records

log = logging.getLogger(__name__)

MONTH_COLS = ["year", "month"]

# Texts that mean a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

QUARTER_FOLDER = r"/([0-9]{4})_([1-4])/source/"
MONTH_FOLDER = r"/([0-9]{4})_(0[1-9]|1[0-2])/source/"


@dataclass(frozen=True)
class Landed:
    """Outcome of one table: rows written, rows rejected, or the error."""

    table: str
    rows: int = 0
    rejected: int = 0
    error: str | None = None


def _too_long(raw: Column, width: int) -> Column:
    """More fields than the header has. Tabs inside a quoted field do not count."""
    unquoted = F.regexp_replace(raw, r'(^|\t)"(?:[^"]|"")*"', "$1")
    tabs = F.length(unquoted) - F.length(F.regexp_replace(unquoted, "\t", ""))
    return F.coalesce(tabs >= width, F.lit(False))


def read_tsv(
    spark: SparkSession,
    paths: list[str],
    columns: list[str],
    multi_line: bool | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Rows of tab-separated files that share one header, all columns text.

    Latin-1, quoted fields with doubled quotes, which may hold tabs and line ends. Files are
    read by byte ranges (see :mod:`factpanel.sources.ranges`), so that a large one is many
    tasks. ``multi_line`` chooses Spark's own reader instead, which either cuts at every
    line end (False) or reads a file in one task (True). Short rows are padded with null
    and the texts that mean missing become null. ``_rejected`` marks rows with too many fields.
    """
    fields = [T.StructField(c, T.StringType()) for c in columns]
    schema = T.StructType([*fields, T.StructField("_raw", T.StringType())])
    options = {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
    if multi_line is None:
        files = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"))
        told = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
        parsed = F.from_csv("record", F.lit(told), options | {"multiLine": "true"}).alias("row")
        rows = records(files, range_bytes).select(F.col("path").alias("_path"), parsed).select("_path", "row.*")
    else:
        reader = spark.read.schema(schema).options(**options, header="true", encoding="ISO-8859-1", columnPruning="false")
        rows = reader.option("multiLine", str(multi_line).lower()).csv(paths)
        rows = rows.select(F.col("_metadata.file_path").alias("_path"), *columns, "_raw")
    made = {c: F.when(~F.col(c).isin(MISSING_TEXTS), F.col(c)) for c in columns}
    return rows.select(
        "_path",
        *[made[c].alias(c) for c in columns],
        _too_long(F.col("_raw"), len(columns)).alias("_rejected"),
    )


def _folder_cols(months: bool) -> dict[str, Column]:
    pattern, names = (MONTH_FOLDER, MONTH_COLS) if months else (QUARTER_FOLDER, PERIOD_COLS)
    path = F.col("_path")
    return {n: F.regexp_extract(path, pattern, i + 1).cast("int") for i, n in enumerate(names)}


def read_release(
    spark: SparkSession,
    raw_root: str,
    table: str,
    months: bool = False,
    only: list[tuple[int, int]] | None = None,
    multi_line: bool | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame | None:
    """One table of all release folders ``<raw_root>/Y_P/source/<table>.tsv``.

    Quarter folders are ``Y_Q``, month folders ``Y_MM``. Headers may change from
    release to release: files are grouped by header line (a handful of groups) and
    stacked by column name. None if no folder has the table.
    """
    pattern = MONTH_FOLDER if months else QUARTER_FOLDER
    files = list_files(spark, raw_root, f"{table}.tsv").where(F.col("path").rlike(pattern))
    if only is not None:
        names = [f"/{y}_{p:02d}/" if months else f"/{y}_{p}/" for y, p in only]
        hit = F.lit(False)
        for n in names:
            hit = hit | F.col("path").contains(n)
        files = files.where(hit)
    by_header: dict[str, list[str]] = {}
    # one line per file: bounded by the number of release folders
    for path, header in header_lines(files).collect():
        by_header.setdefault(header, []).append(path)
    if not by_header:
        return None
    parts = []
    for header, paths in sorted(by_header.items()):
        columns = [c.strip('"') for c in header.split("\t")]
        parts.append(read_tsv(spark, sorted(paths), columns, multi_line, range_bytes))
    return union_by_name(*parts).withColumns(_folder_cols(months)).drop("_path")


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that the rows fall in, and no others.

    The rebalance step cuts a big partition into several files and merges small
    ones, so neither one task nor one file holds a whole period.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def month_root(root: str) -> str:
    return f"{root}/months"


def land_tables(
    spark: SparkSession,
    raw_root: str,
    root: str,
    tables: list[str] | None = None,
    include_txt: bool = False,
    months: bool = False,
    only: list[tuple[int, int]] | None = None,
    multi_line: bool | None = None,
) -> list[Landed]:
    """Land every table of the releases: one write job per table over all periods.

    A table without files is skipped, a failing one is reported and the others go
    on. Rows with too many fields are left out and counted in the same pass. The
    large txt table is left out unless asked for.
    """
    by = MONTH_COLS if months else PERIOD_COLS
    target = month_root(root) if months else root
    done = []
    for table in tables or RELEASE_TABLES:
        if table == "txt" and not include_txt:
            continue
        try:
            rows = read_release(spark, raw_root, table, months, only, multi_line)
            if rows is None:
                continue
            seen = Observation()
            counted = rows.observe(
                seen,
                F.count_if(~F.col("_rejected")).alias("rows"),
                F.count_if(F.col("_rejected")).alias("rejected"),
            )
            write_partitioned(counted.where(~F.col("_rejected")).drop("_rejected"), f"{target}/{table}", by)
            counts = seen.get
            done.append(Landed(table, counts["rows"], counts["rejected"]))
        except Exception as error:  # any failure is the finding
            log.warning("table %s was not landed: %s", table, error)
            done.append(Landed(table, error=str(error).splitlines()[0]))
    return done
