"""The public entry points: a date range, one cell, or both stages."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliozone import schemas
from foliozone.operators import accounting
from foliozone.plans import ingest as ingest_stage
from foliozone.plans import transform as transform_stage
from foliozone.plans.ingest import StageResult
from foliozone.plans.periods import as_date, plan_cells, window_starting_at
from foliozone.session import released
from foliozone.sources.adapter import SourceAdapter
from foliozone.sources.handoff import Capture
from foliozone.sources.zones import BUCKETS, RunLog, Zone


@dataclass(frozen=True)
class Workspace:
    """Two zones and a run log under one root on shared storage."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS  # of the metadata of new zones

    @property
    def landing(self) -> Zone:
        return Zone(self.spark, f"{self.root}/landing", self.buckets)

    @property
    def curated(self) -> Zone:
        return Zone(self.spark, f"{self.root}/curated", self.buckets)

    @property
    def log(self) -> RunLog:
        return RunLog(self.spark, f"{self.root}/runs")


def _logged(
    workspace: Workspace, result: StageResult, stage: str, source: str, start: date, end: date, run_ts: datetime, began: float
) -> StageResult:
    """Store the run's outcomes, summaries, failures and rejects and return them as stored."""
    run_id, stamp = f"{stage}-{uuid.uuid4().hex}", F.lit(run_ts)
    cells = workspace.log.append("cell_summary", run_id, result.cell_summary.withColumn("run_ts", stamp))
    outcomes = result.decided.select(*(part.split()[0] for part in schemas.OUTCOMES.split(", ")))
    outcomes = workspace.log.append("outcomes", run_id, outcomes.withColumn("run_ts", stamp)).drop("run_ts")
    total = accounting.run_summary(cells, stage, source, start, end).withColumn("duration_seconds", F.lit(round(time.monotonic() - began, 3)))
    rejects = result.rejects
    if rejects is not None:
        shaped = rejects.select(*(part.split()[0] for part in schemas.REJECTS.split(", ")))
        rejects = workspace.log.append("rejects", run_id, shaped.withColumn("run_ts", stamp)).drop("run_ts")
    return StageResult(
        outcomes,
        cells.drop("run_ts"),
        workspace.log.append("run_summary", run_id, total.withColumn("run_ts", stamp)).drop("run_ts"),
        workspace.log.append("failures", run_id, result.failures.withColumn("run_ts", stamp)).drop("run_ts"),
        rejects,
    )


def ingest_date_range(
    workspace: Workspace,
    adapter: SourceAdapter,
    capture: Capture,
    start: date | str,
    end: date | str,
    run_ts: datetime,
    size: str = "monthly",
    body_codes: tuple[str, ...] | None = None,
) -> StageResult:
    start, end = as_date(start), as_date(end)
    began = time.monotonic()
    cells = plan_cells(workspace.spark, adapter, start, end, size, body_codes)
    with released(workspace.spark):
        result = ingest_stage.ingest(workspace.landing, capture, cells, adapter, start, end, run_ts)
        return _logged(workspace, result, ingest_stage.STAGE, adapter.name, start, end, run_ts, began)


def transform_date_range(
    workspace: Workspace,
    adapter: SourceAdapter,
    start: date | str,
    end: date | str,
    run_ts: datetime,
    size: str = "monthly",
    body_codes: tuple[str, ...] | None = None,
) -> StageResult:
    start, end = as_date(start), as_date(end)
    began = time.monotonic()
    cells = plan_cells(workspace.spark, adapter, start, end, size, body_codes)
    with released(workspace.spark):
        result = transform_stage.transform(
            workspace.landing, workspace.curated, cells, adapter, start, end, run_ts, size, body_codes
        )
        return _logged(workspace, result, transform_stage.STAGE, adapter.name, start, end, run_ts, began)


def ingest_single_cell(
    workspace: Workspace, adapter: SourceAdapter, capture: Capture, start: date | str, body_code: str, run_ts: datetime, size: str = "monthly"
) -> StageResult:
    first, end = window_starting_at(as_date(start), size)
    return ingest_date_range(workspace, adapter, capture, first, end, run_ts, size, (body_code,))


def transform_single_cell(
    workspace: Workspace, adapter: SourceAdapter, start: date | str, body_code: str, run_ts: datetime, size: str = "monthly"
) -> StageResult:
    first, end = window_starting_at(as_date(start), size)
    return transform_date_range(workspace, adapter, first, end, run_ts, size, (body_code,))


def run(
    workspace: Workspace,
    adapter: SourceAdapter,
    capture: Capture,
    start: date | str,
    end: date | str,
    run_ts: datetime,
    size: str = "monthly",
    body_codes: tuple[str, ...] | None = None,
) -> tuple[StageResult, StageResult, DataFrame]:
    """Both stages in order; the second runs even if the first did not reconcile."""
    first = ingest_date_range(workspace, adapter, capture, start, end, run_ts, size, body_codes)
    second = transform_date_range(workspace, adapter, start, end, run_ts, size, body_codes)
    return first, second, accounting.run_verdict([first.run_summary, second.run_summary])
