"""Persons export (CSV with a header row, or the first sheet of an .xlsx workbook) -> (org_unit, name_variant, row_pos)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.functions.text import strip_ws
from clipforge.sources.sheets import read_sheet


def read_persons_export(spark: SparkSession, path: str) -> DataFrame:
    """Read an export; every column as string, file order kept in ``row_pos``."""
    if path.endswith(".xlsx"):
        return read_sheet(spark, path)
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumn("row_pos", F.monotonically_increasing_id())


def resolve_layout(df: DataFrame, pos_col: str = "row_pos") -> DataFrame:
    """Pick the unit and name columns of the first known layout.

    Unit: first existing of the three candidates; a null unit is filled from
    ``Alle organisational units`` when that column exists. Name: the known-as
    variant, else ``Name``. Neither present -> ``ValueError``.
    """
    cols = set(df.columns)
    unit_col = next((c for c in C.UNIT_COLUMN_CANDIDATES if c in cols), None)
    name_col = next((c for c in C.NAME_COLUMN_CANDIDATES if c in cols), None)
    if unit_col is None or name_col is None:
        raise ValueError(f"unknown persons export layout; columns found: {df.columns}")
    unit = F.col(f"`{unit_col}`").cast("string")
    if C.UNIT_FILL_COLUMN in cols:
        unit = F.coalesce(unit, F.col(f"`{C.UNIT_FILL_COLUMN}`").cast("string"))
    return df.select(strip_ws(unit).alias("org_unit"),
                     strip_ws(F.col(f"`{name_col}`").cast("string")).alias("name_variant"),
                     F.col(pos_col).alias("row_pos"))
