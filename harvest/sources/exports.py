"""Outputs: the CSV export, per-job outputs, rejected rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from harvest.schemas import EXPORT_COLUMNS
from harvest.sources.scratch import drop_folder

LOAD = "load"
#: Characters that Spark writes as % and two digits in the folder names of a partition column.
_ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace the export under `path` by these rows, as CSV with a header line in every file.

    Files are written in parallel; `files=1` gives the single file of a small export.
    """
    # A fraction of a second is kept where there is one.
    created_at = F.regexp_replace(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0*$", "")
    rows = df.select(*EXPORT_COLUMNS).withColumn("created_at", created_at)
    if files is not None:
        rows = rows.coalesce(files)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_jobs(df: DataFrame, path: str) -> None:
    """One folder per partition label, a large one in several files. Labels that are not among the rows keep their files."""
    rows = df.hint("rebalance", F.col("alphabet_partition"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("alphabet_partition").parquet(path)


def write_bad(bad: DataFrame, path: str, label: str | None = None) -> None:
    """Add rejected rows with their reason, in a folder of their own; a `label` used before replaces its rows."""
    bad.write.mode("overwrite").parquet(_folder(path, label or uuid.uuid4().hex))


def _folder(path: str, label: str) -> str:
    name = "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in label)
    return f"{path}/{LOAD}={name}"


def replace_bad(bad: DataFrame, path: str, labels: Sequence[str]) -> None:
    """Replace the rejected rows of the loads of these labels by `bad`, which must not read them; loads without a row go."""
    rows = bad.hint("rebalance", F.col(LOAD))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path)
    held = {r[0] for r in bad.select(LOAD).distinct().collect()}
    for label in labels:
        if label not in held:
            drop_folder(bad.sparkSession, _folder(path, label))
