"""Batch report runner: every named report, in name order, to timestamped
CSV; a failing report is recorded and the rest still run."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import commit_report, run_stamp

Report = Callable[[SparkSession], DataFrame]


def run_reports(spark: SparkSession, reports: Mapping[str, Report], out_dir: str,
                stamp: str | None = None) -> list[dict]:
    """Run ``reports`` in lexicographic order of their names.

    Each result is written once, all or nothing, and the writing job counts its rows
    (:func:`voltaic.sources.sinks.commit_report`).  Returns one dict per report: name, ok, rows,
    path, error.
    """
    stamp = stamp or run_stamp()
    out = []
    for name in sorted(reports):
        try:
            path, rows = commit_report(reports[name](spark), out_dir, name, stamp)
            out.append({"name": name, "ok": True, "rows": rows, "path": path, "error": None})
        except Exception as e:  # noqa: BLE001 — a failed report must not stop the run
            out.append({"name": name, "ok": False, "rows": None, "path": None,
                        "error": f"{type(e).__name__}: {e}"[:500]})
    return out
