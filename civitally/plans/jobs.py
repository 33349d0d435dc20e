"""Command line jobs.

    spark-submit civitally_job.py clean --raw features.csv.gz --out clean/
    spark-submit civitally_job.py marts --clean clean/ --holidays holidays/ --out marts/
    spark-submit civitally_job.py forecast --marts marts/ --out forecast/
    spark-submit civitally_job.py sql --clean clean/ "SELECT ... FROM crimes"
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import answers, cleaning, quality, series as ts
from ..operators.cubes import build_cubes, data_range
from ..session import DATA_TIME_ZONE, cut_lineage, get_spark
from ..sources import readers, writers
from . import forecasting as fc, increments
from .marts import derive_marts, marts

#: Column that holds the line of a row that does not fit the header.
MALFORMED = "_malformed"


def run_clean(spark: SparkSession, raw_path: str, out: str, partitions: int | None = None, multi_line: bool = False):
    """Clean the raw file; its rows are counted while it is staged (one read).

    Malformed lines are left out and counted: a padded or shifted row would be taken for a sound one.
    """
    raw = readers.read_raw(spark, raw_path, partitions=partitions, malformed=MALFORMED, multi_line=multi_line)
    before = Observation("before")
    counted = raw.observe(before, F.count(F.lit(1)).alias("n_rows"), F.count(MALFORMED).alias("malformed"))
    sound = counted.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
    clean = cleaning.clean_incidents(sound, staged=True)
    writers.write_clean(clean, out)
    # From the file footers; an empty table has no file to take the columns from.
    after = spark.read.schema(clean.schema).parquet(out).count()
    width = len(sound.columns)
    return spark.createDataFrame(
        [("before", before.get["n_rows"], width), ("malformed", before.get["malformed"], width),
         ("after", after, len(clean.columns))],
        "stage string, n_rows long, n_columns int")


def run_marts(
    df: DataFrame, holidays: DataFrame, out: str, jdbc: Mapping[str, str] | None = None
) -> None:
    """One scan to the cubes, written to the output; every mart is derived from them.

    With ``jdbc`` options each written mart also replaces its database table.
    """
    spark = df.sparkSession
    build_cubes(df).write.mode("overwrite").partitionBy("cube").parquet(f"{out}/cubes")
    write_marts(spark.read.parquet(f"{out}/cubes"), holidays, out, jdbc)


def refresh_marts(
    spark: SparkSession, clean: str, holidays: DataFrame, out: str, jdbc: Mapping[str, str] | None = None
) -> int:
    """Read the files of the clean table not counted before, merge their cubes, derive the marts anew.

    Returns how many files were read; with none new nothing is written.
    """
    read = increments.refresh_cubes(spark, clean, f"{out}/state")
    if read:
        write_marts(writers.read_published(spark, f"{out}/state", "cubes"), holidays, out, jdbc)
    return read


def write_marts(cubes: DataFrame, holidays: DataFrame, out: str, jdbc: Mapping[str, str] | None = None) -> None:
    spark = cubes.sparkSession
    keys = {name: mart.keys for name, mart in marts().items()}
    for name, mart in derive_marts(cubes, holidays).items():
        writers.write_mart(mart, out, name, keys[name])
        if jdbc:
            writers.write_jdbc(readers.read_mart(spark, out, name), name, jdbc)


def run_forecast(
    trend: DataFrame, by_type: DataFrame, out: str, periods: fc.Periods = fc.Periods(),
    refine: int = 8,
) -> int:
    """Backtest, choose the set-up on the total, forecast every series that it fits, publish all tables."""
    monthly = ts.trend_series(trend, by_type)
    quality.fail_on_gaps(monthly.filter(monthly["series"] == ts.TOTAL))
    candidates = cut_lineage(fc.candidate_series(monthly, periods))
    total = candidates.filter(candidates["series"] == ts.TOTAL)
    setup = cut_lineage(fc.choose_setup(fc.backtest_scores(total, periods, refine)))
    if setup.isEmpty():
        raise ValueError("the total series cannot be fitted from any training start")
    series = cut_lineage(fc.analysed_series(candidates, setup, periods))
    forecast = cut_lineage(fc.forecasts_with_setup(
        series, setup, periods.train_end, periods.horizon, periods, refine=refine))
    analysis = cut_lineage(fc.series_analysis(series, setup, forecast, periods, refine))
    backtest = cut_lineage(fc.backtest_table(series, setup, periods, refine))
    return writers.publish({
        "crime_forecast": fc.forecast_rows(forecast, series, periods),
        "forecast_metrics": fc.forecast_metrics(analysis, setup, periods),
        "skipped_series": fc.skipped_series(candidates, setup, periods),
        "backtest": backtest,
        "interval_coverage": fc.coverage(backtest),
        "type_report": fc.type_report(analysis),
    }, out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="civitally")
    parser.add_argument("--time-zone", default=DATA_TIME_ZONE)
    commands = parser.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean")
    clean.add_argument("--raw", required=True)
    clean.add_argument("--out", required=True)
    clean.add_argument("--partitions", type=int)
    clean.add_argument("--multi-line", action="store_true", help="quoted fields may hold line ends")
    mart = commands.add_parser("marts")
    mart.add_argument("--clean", required=True)
    dates = mart.add_mutually_exclusive_group(required=True)
    dates.add_argument("--holidays", help="parquet folder")
    dates.add_argument("--holidays-jdbc", help="JSON file with url, user, password, driver and dbtable")
    mart.add_argument("--out", required=True)
    mart.add_argument("--jdbc", help="JSON file with url, user, password and driver")
    mart.add_argument("--refresh", action="store_true", help="read only files not counted before")
    forecast = commands.add_parser("forecast")
    forecast.add_argument("--marts", required=True)
    forecast.add_argument("--out", required=True)
    sql = commands.add_parser("sql")
    sql.add_argument("--clean", required=True)
    sql.add_argument("query")
    args = parser.parse_args(argv)

    spark = get_spark(f"civitally-{args.command}", args.time_zone)
    if args.command == "clean":
        run_clean(spark, args.raw, args.out, args.partitions, args.multi_line).show()
        cleaning.quality_report(readers.read_clean(spark, args.out)).show(50, truncate=False)
    elif args.command == "marts":
        jdbc = json.loads(Path(args.jdbc).read_text()) if args.jdbc else None
        if args.holidays:
            holidays = readers.read_holidays(spark, args.holidays)
        else:
            options = json.loads(Path(args.holidays_jdbc).read_text())
            holidays = readers.read_jdbc(spark, options.pop("dbtable"), options)
        if args.refresh:
            print(f"{refresh_marts(spark, args.clean, holidays, args.out, jdbc)} new files")
        else:
            run_marts(readers.read_clean(spark, args.clean), holidays, args.out, jdbc)
            data_range(spark.read.parquet(f"{args.out}/cubes")).show(truncate=False)
    elif args.command == "forecast":
        version = run_forecast(
            readers.read_mart(spark, args.marts, "monthly_trend"),
            readers.read_mart(spark, args.marts, "monthly_trend_by_type"), args.out)
        print(f"published version {version}")
    else:
        cleaning.typed_view(readers.read_clean(spark, args.clean), "crimes")
        answers.ad_hoc(spark, args.query).show(answers.ROW_LIMIT, truncate=False)
