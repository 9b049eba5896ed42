"""Landed tables as DataFrames, by name and period."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factpanel.functions.ids import Period, as_period, period_key, period_str
from factpanel.operators.quality import in_periods
from factpanel.schema import PERIOD_COLS, RELEASE_TABLES
from factpanel.sources.files import list_files, tables_by_period

PARTITIONED = "partitioned"
FOLDERS = "folders"


class FactTables:
    """The tables of a landed root.

    ``layout`` is "partitioned" (one dataset per table, partitioned by
    dataset_year and dataset_quarter) or "folders" (``Y_Q/parquet/<table>.parquet``).
    Frames are lazy and remembered per (table, periods); ``persist=True`` also keeps
    the rows in executor memory, spilling to disk, after the first action.

    Columns may differ between periods, so footers are merged by default. On a root
    with very many files, ``schemas`` (table name to schema) saves that pass.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        periods: list[Period | str] | None = None,
        layout: str = PARTITIONED,
        persist: bool = False,
        schemas: dict[str, StructType | str] | None = None,
    ):
        if layout not in (PARTITIONED, FOLDERS):
            raise ValueError(f"unknown layout {layout!r}")
        self.spark = spark
        self.root = str(root).rstrip("/")
        self.layout = layout
        self.persist = persist
        self.schemas = schemas or {}
        self._periods = None if periods is None else [as_period(p) for p in periods]
        self._seen: dict[tuple, DataFrame] = {}

    def table(self, name: str, period: Period | str | None = None) -> DataFrame:
        """One table, of one period or of all periods of this object.

        A table that is not there raises Spark's own path error.
        """
        periods = self._periods if period is None else [as_period(period)]
        key = (name, None if periods is None else tuple(periods))
        if key not in self._seen:
            df = self._read(name, periods)
            self._seen[key] = df.persist() if self.persist else df
        return self._seen[key]

    def find(self, name: str) -> DataFrame | None:
        """The table, or None where no period has it."""
        try:
            return self.table(name)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _read(self, name: str, periods: list[Period] | None) -> DataFrame:
        reader = self.spark.read
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        else:
            reader = reader.option("mergeSchema", "true")
        if self.layout == PARTITIONED:
            df = reader.parquet(f"{self.root}/{name}")
            return df if periods is None else in_periods(df, periods)
        if periods is None:
            paths = [f"{self.root}/[0-9][0-9][0-9][0-9]_[1-4]/parquet/{name}.parquet"]
        else:
            paths = [f"{self.root}/{period_str(p)}/parquet/{name}.parquet" for p in periods]
        df = reader.parquet(*paths)
        found = [F.regexp_extract("_metadata.file_path", r"/([0-9]{4})_([1-4])/parquet/", i) for i in (1, 2)]
        return df.withColumns({c: t.cast("int") for c, t in zip(PERIOD_COLS, found)})

    def sub(self, period: Period | str | None = None) -> DataFrame:
        return self.table("sub", period)

    def num(self, period: Period | str | None = None) -> DataFrame:
        return self.table("num", period)

    def pre(self, period: Period | str | None = None) -> DataFrame:
        return self.table("pre", period)

    def tag(self, period: Period | str | None = None) -> DataFrame:
        return self.table("tag", period)

    def txt(self, period: Period | str | None = None) -> DataFrame:
        return self.table("txt", period)

    def all(self, period: Period | str | None = None) -> tuple[DataFrame, ...]:
        """sub, num, pre, tag and txt."""
        return tuple(self.table(t, period) for t in RELEASE_TABLES)

    def sub_num(self, period: Period | str | None = None) -> tuple[DataFrame, DataFrame]:
        return self.sub(period), self.num(period)

    def only(self, periods: list[Period | str]) -> FactTables:
        """The same root with the periods given."""
        options = {"layout": self.layout, "persist": self.persist, "schemas": self.schemas}
        return FactTables(self.spark, self.root, periods, **options)

    @classmethod
    def of_period(cls, spark: SparkSession, root: str, year: int, quarter: int, **options):
        return cls(spark, root, [(year, quarter)], **options)

    def inventory(self) -> DataFrame:
        """Period, table and bytes of everything that is there, from file names."""
        return tables_by_period(list_files(self.spark, self.root))

    def periods(self) -> DataFrame:
        """Periods there are, with their keys."""
        found = self.inventory().select(*PERIOD_COLS).distinct()
        if self._periods is not None:
            found = in_periods(found, self._periods)
        return found.withColumn("period_key", period_key(*PERIOD_COLS))
