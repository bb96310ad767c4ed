"""Writing the tables of a run, and the job that does it.

    spark-submit --py-files ... surveypulse/plans/report.py FOLDER [SESSION ...] --out PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from surveypulse import SESSION_KEYS
from surveypulse.plans.status import StatusRun


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write one table in a folder per dataset.

    Rows are rebalanced by session first: small partitions are merged into few files and a
    large one is split, so neither many tiny files nor one huge task results.
    """
    if "pos" in df.columns and file_format == "csv":
        df = df.select("*", "pos.*").drop("pos")
    if "first_pos" in df.columns and file_format == "csv":
        df = df.select("*", "first_pos.*").drop("first_pos")
    keys = [k for k in SESSION_KEYS if k in df.columns]
    writer = df.hint("rebalance", *keys).write.mode("overwrite")
    if "dataset" in keys:  # numbers that no log names belong to none
        writer = writer.partitionBy("dataset")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_report(run: StatusRun, out: str, plots: bool = True, file_format: str = "parquet") -> list[str]:
    """Write every table of a run below ``out``; returns their names."""
    tables = run.tables(plots)
    for name, df in tables.items():
        write_table(df, f"{out.rstrip('/')}/{name}", file_format)
    return list(tables)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Sensor status and data quality of logging sessions")
    parser.add_argument("folder", help="data folder, or a glob of several")
    parser.add_argument("sessions", nargs="*", type=int, help="session numbers; all by default")
    parser.add_argument("--out", required=True)
    parser.add_argument("--no-plots", action="store_true")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = parser.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run = StatusRun(spark, args.folder, args.sessions or None)
    write_report(run, args.out, not args.no_plots, args.format)
    run.close()


if __name__ == "__main__":
    main()
