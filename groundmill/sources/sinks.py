"""Outputs: Parquet as the dataset proper, and CSV, JSON lines and one JSON record for other tools."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.operators.judging import dataset_rows, rejected_rows, stats


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header, CRLF line ends (inside values too), quotes doubled, booleans as True and False, null as empty."""
    named = {c: F.initcap(F.col(c).cast("string")) for c, kind in rows.dtypes if kind == "boolean"}
    rows.withColumns(named).write.mode("overwrite").csv(path, header=True, lineSep="\r\n", escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_record(row: DataFrame, path: str, extra: dict | None = None) -> dict:
    """One row as a JSON document, in a text file of one part; returned too."""
    record = (extra or {}) | row.first().asDict(recursive=True)
    row.sparkSession.createDataFrame([(json.dumps(record, ensure_ascii=False, indent=2),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return record


def write_outputs(accepted: DataFrame, decided: DataFrame, out_dir: str, run_name: str, meta: dict) -> dict[str, str]:
    """Dataset (Parquet, CSV, JSON lines), rejects (JSON lines) and statistics (JSON); the paths by kind.

    ``accepted`` has the deduplicated pairs, ``decided`` every judged pair. CSV is written only where rows exist.
    """
    rows, rejects = dataset_rows(accepted), rejected_rows(decided)
    paths = {k: f"{out_dir}/{run_name}_{k}" for k in ("dataset.parquet", "dataset.csv", "dataset.jsonl", "rejected.jsonl", "stats.json")}
    rows.write.mode("overwrite").parquet(paths["dataset.parquet"])
    rows = rows.sparkSession.read.parquet(paths["dataset.parquet"])
    if not rows.isEmpty():
        write_csv(rows, paths["dataset.csv"])
    else:
        del paths["dataset.csv"]
    write_jsonl(rows, paths["dataset.jsonl"])
    write_jsonl(rejects, paths["rejected.jsonl"])
    write_record(stats(accepted, rejects), paths["stats.json"], {"source": meta})
    return paths


def write_captures(merged: DataFrame, path: str) -> None:
    """Merged captures as one table of JSON lines instead of a file per chunk."""
    write_jsonl(merged.select("chunk_id", F.struct("qa_pairs").alias("generation"), "verifications"), path)
