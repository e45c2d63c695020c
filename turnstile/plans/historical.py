"""The historical clean-up job: C-25 … C-27 over their inputs, written and verified (K-2, K-9)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.operators import clean
from turnstile.sources import sinks
from turnstile.sources.readers import read_parquet

CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "schedule": clean.clean_historical_schedule,
    "user_snapshot": clean.clean_historical_users,
    "class_attendance": clean.clean_historical_attendance,
}


def clean_historical(spark: SparkSession, inputs: Mapping[str, str], target: str) -> DataFrame:
    """Clean the named inputs into ``<target>/<name>`` and report ``(path, n, ok)`` per output.

    An input that fails does not stop the others, and an empty one is not written: both show up in
    the report as an output that cannot be read.
    """
    for name, path in inputs.items():
        try:
            rows = read_parquet(spark, path)
            if not rows.isEmpty():
                sinks.overwrite(CLEANERS[name](rows), f"{target}/{name}")
        except Exception:
            continue
    return sinks.verify_paths(spark, [f"{target}/{name}" for name in inputs])


OUTCOMES = "name string, path string, outcome string, written bigint, found bigint, ok boolean, message string"


def run_historical(spark: SparkSession, inputs: Mapping[str, str], target: str) -> DataFrame:
    """As :func:`clean_historical`, with the outcome of *this* run for every input.

    ``written`` when the rows counted while writing were found again; ``mismatch`` when they were not; ``empty`` for an
    input without rows; ``failed`` with the cause, for example a name without cleaner or a path that cannot be read.
    What an earlier run left in the target is never counted.
    """
    report = []
    for name, path in inputs.items():
        out = f"{target}/{name}"
        try:
            rows = read_parquet(spark, path)
            if rows.isEmpty():
                report.append((name, out, "empty", 0, None, False, None))
                continue
            if name not in CLEANERS:
                raise ValueError(f"no cleaner for {name}")
            check = sinks.write_checked(CLEANERS[name](rows), out).first()
            outcome = "written" if check["ok"] else "mismatch"
            report.append((name, out, outcome, check["written"], check["found"], check["ok"], None))
        except Exception as error:
            report.append((name, out, "failed", None, None, False, str(error).splitlines()[0]))
    return spark.createDataFrame(report, OUTCOMES)


def all_written(report: DataFrame) -> bool:
    return report.where(~F.col("ok")).isEmpty()
