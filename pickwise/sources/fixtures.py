"""Writers of file fixtures derived from the driver tables, used by the source
and sink query keys: yearly CSV layouts (one year lacking a column, one lacking
the key column), a globbed CSV with malformed lines next to it, and JSON lines
next to a CSV-bodied file.  Everything goes under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.plans.workspace import file_system
from pickwise.sources import views as V

def years(spark: SparkSession, sf: str) -> range:
    """The years of the matches, with an absent year at each end."""
    low, high = V.metadata(spark, sf).agg(F.min("year"), F.max("year")).first()
    return range(low - 1, high + 2)


# Fixed fixture years: the files of these lack a column.
PICKS_YEAR_WITHOUT_ORDER = 1997
TIMINGS_YEAR_WITHOUT_EXTRA = 1996
TIMINGS_YEAR_WITHOUT_KEY = 1998
META_YEAR_WITHOUT_PATCH = 1999


def _with_year(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    return df.join(V.metadata(spark, sf).select("match_id", "year"), "match_id")


def _write_by_year(df: DataFrame, base: str, odd_year: int, drop: list[str]) -> None:
    """Partition folders base/year=YYYY; ``odd_year`` is written without ``drop``."""
    (df.where(F.col("year") != odd_year).write.partitionBy("year").option("header", True).csv(base))
    (
        df.where(F.col("year") == odd_year).drop("year", *drop)
        .write.option("header", True).csv(f"{base}/year={odd_year}")
    )


def write_yearly_files(spark: SparkSession, df: DataFrame, base: str, name: str) -> None:
    """``df`` as the folders base/name_YYYY.csv: one job for all years, whose partition
    folders get the names of the export."""
    root = f"{base}/{name}"
    df.where(F.col("year").isNotNull()).write.partitionBy("year").option("header", True).csv(root)
    fs, where = file_system(spark, root)
    for found in fs.listStatus(where):
        if found.isDirectory():
            year = found.getPath().getName().removeprefix("year=")
            fs.rename(found.getPath(), file_system(spark, f"{root}_{year}.csv")[1])


def write_yearly_picks(spark: SparkSession, sf: str, base: str) -> str:
    pb = _with_year(spark, sf, V.picks_bans(spark, sf))
    _write_by_year(pb, f"{base}/picks_bans", PICKS_YEAR_WITHOUT_ORDER, ["order"])
    return "picks_bans/year={year}"


def write_yearly_timings(spark: SparkSession, sf: str, base: str) -> str:
    dt = _with_year(spark, sf, V.draft_timings(spark, sf))
    root = f"{base}/draft_timings"
    keep = dt.where(F.col("year") != TIMINGS_YEAR_WITHOUT_KEY)
    _write_by_year(keep, root, TIMINGS_YEAR_WITHOUT_EXTRA, ["extra_time"])
    (
        dt.where(F.col("year") == TIMINGS_YEAR_WITHOUT_KEY).drop("year", "match_id")
        .write.option("header", True).csv(f"{root}/year={TIMINGS_YEAR_WITHOUT_KEY}")
    )
    return "draft_timings/year={year}"


def write_yearly_metadata(spark: SparkSession, sf: str, base: str) -> str:
    md = V.metadata(spark, sf).select("match_id", "radiant_win", "patch", "year")
    _write_by_year(md, f"{base}/main_metadata", META_YEAR_WITHOUT_PATCH, ["patch"])
    return "main_metadata/year={year}"


def write_csv_with_malformed(spark: SparkSession, df: DataFrame, base: str, name: str, bad_lines: list[str]) -> str:
    """``df`` as CSV at base/name plus a sibling base/name.bad holding a header
    and malformed lines; returns the glob ``base/name*`` that reads both."""
    df.write.option("header", True).csv(f"{base}/{name}")
    header = ",".join(df.columns)
    spark.createDataFrame([(header,)] + [(b,) for b in bad_lines], "value string").coalesce(1).write.text(f"{base}/{name}.bad")
    return f"{base}/{name}*"


def write_json_with_csv_body(spark: SparkSession, df: DataFrame, base: str, name: str) -> str:
    """``df`` as JSON lines at base/name plus base/name.csvbody holding CSV text;
    returns the glob that reads both."""
    df.write.json(f"{base}/{name}")
    header = ",".join(df.columns)
    lines = [(header,), ("1,20",), ("2,650",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{base}/{name}.csvbody")
    return f"{base}/{name}*"
