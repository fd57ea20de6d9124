"""Writing results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.alerts import today_anomalies
from tallywatch.operators.reports import result_table_rows, run_summary


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """A folder of CSV files with a header line; one file only on request."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_result_csv(result: DataFrame, group: str, path: str, single_file: bool = False) -> None:
    """The detection result ordered by segment and date."""
    write_csv(result.orderBy(group, "src", "date"), path, single_file)


def write_today_csv(result: DataFrame, group: str, folder: str, name: str, run_date: dt.date) -> str | None:
    """Alerts of the latest day to ``<folder>/anomalies_today_<name>_<run date>``, if there are any."""
    today = today_anomalies(result, group)
    if today.isEmpty():
        return None
    path = f"{folder}/anomalies_today_{name}_{run_date.isoformat()}"
    write_csv(today, path)
    return path


def json_report(result: DataFrame, group: str, stamped_at: dt.datetime, version: str = "V1") -> DataFrame:
    """Lines of text: one metadata record, one summary record, one record per alert.

    JSON lines rather than one document, so that alerts need not fit one row.
    """
    summary = run_summary(result, group)
    metadata = summary.select(F.to_json(F.struct(F.lit("metadata").alias("record"), F.struct(
        F.lit(stamped_at.isoformat()).alias("timestamp"),
        F.lit(version).alias("model_version"),
        "total_records",
        F.col("total_anomalies").alias("anomaly_count"),
        "anomaly_rate",
    ).alias("metadata"))).alias("value"))
    totals = summary.select(
        F.to_json(F.struct(F.lit("summary").alias("record"), F.struct("*").alias("summary"))).alias("value")
    )
    alerts = result.where(F.col("is_anomaly") == 1).select(
        F.to_json(F.struct(F.lit("anomaly").alias("record"), F.struct("*").alias("anomaly"))).alias("value")
    )
    return metadata.unionByName(totals).unionByName(alerts)


def write_json_report(result: DataFrame, group: str, path: str, stamped_at: dt.datetime) -> None:
    json_report(result, group, stamped_at).write.mode("overwrite").text(path)


def write_result_table(result: DataFrame, group: str, url: str, table: str, stamped_at: dt.datetime,
                       properties: dict[str, str] | None = None) -> None:
    """Append the result to a database table."""
    result_table_rows(result, group, stamped_at).write.jdbc(url, table, mode="append", properties=properties)
