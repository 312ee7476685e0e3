"""Writing all routes of a batch, and doing so for every micro-batch of a stream."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.config import PipelineConfig
from millrace.functions.paths import quote
from millrace.operators.project import FieldPlan, as_text, untyped_fields
from millrace.operators.route import is_filter
from millrace.plans.pipeline import CLOCK, CORRUPT, Routed, _plans, route_messages
from millrace.plans.registry import RoutePlan
from millrace.sources.registry import Registry
from millrace.streaming.recovery import SkippedBatch, forget_skipped, record_skipped, skipped_batches
from millrace.streaming.sinks import Sink

log = logging.getLogger("millrace")


@dataclass(frozen=True)
class RouteReport:
    """What became of one route in one batch."""

    batch_id: int | str | None
    route: str
    rows: int
    ok: bool
    error: str | None = None


# Route name in the report of a batch that failed before any route was tried.
ALL_ROUTES = "*"

#: Seconds to wait for the metrics of a job that has ended.
METRIC_SECONDS = 30

Reporter = Callable[[list[RouteReport]], None]


class RouteFailure(RuntimeError):
    """Some routes of a batch failed; the others are written."""

    def __init__(self, reports: Sequence[RouteReport]) -> None:
        self.reports = [r for r in reports if not r.ok]
        super().__init__("; ".join(f"{r.route}: {r.error}" for r in self.reports))


def write_batch(
    df: DataFrame,
    registry: Registry | Sequence[RoutePlan],
    config: PipelineConfig,
    sink: Sink,
    clock: str | None = None,
    batch_id: int | str | None = None,
    replay: bool = False,
    on_report: Reporter | None = None,
) -> list[RouteReport]:
    """Write every route of a batch: one parse, one write per route, which counts its rows.

    Without a ``batch_id`` rows are appended; with one, sinks that can replace
    what the same batch wrote before do so. A route without rows leaves nothing behind,
    unless the batch may be a ``replay`` and has to replace what an earlier try
    left. With ``config.count="first"`` all routes are counted in one job before, and
    those without rows are not tried. Messages that cannot be read go to
    ``config.corrupt_target``, if it is set, and are reported as the route ``_corrupt``.

    Different targets are written at the same time from a few driver threads, once a job of
    its own has parsed what they share; the routes of one target one after the other, since two
    jobs must not commit to one folder at once. A failing route does not stop the others. With
    ``on_error="fail"`` it raises once all of them are done.
    """
    plans = _plans(registry, config)
    if clock is None:
        # One ingest time for all routes, and again if a lost task is rerun.
        now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
        df, clock = df.select("value", now.alias(CLOCK)), CLOCK
    reports: list[RouteReport] = []
    routed = route_messages(df, plans, config, clock, config.untyped == "text")
    if routed is None:
        log.info("batch %s: no message has %s", batch_id, config.payload_column)
    else:
        held = routed.hold()
        try:
            counts = held.counts() if config.count == "first" and routed.plans else None
            log.info("batch %s: %s", batch_id, counts or "counted while written")
            # The time of the query or of the micro-batch is a single day.
            targets: dict[str, list[RoutePlan]] = {}
            tried = [*routed.plans, *([corrupt_plan(config)] if config.corrupt_target else [])]
            for plan in tried:
                targets.setdefault(plan.target.lower(), []).append(plan)

            if counts is None and min(config.route_threads, len(targets)) > 1:
                _fill(held)

            def write_target(same_target: list[RoutePlan]) -> list[RouteReport]:
                return [
                    _write_route(held, plan, counts, sink, batch_id, replay)
                    for plan in same_target
                ]

            write = inheritable_thread_target(df.sparkSession)(write_target)
            with ThreadPoolExecutor(max(1, min(config.route_threads, len(targets)))) as pool:
                done = [r for part in pool.map(write, targets.values()) for r in part]
            order = {plan.route_id: place for place, plan in enumerate(tried)}
            log.info("batch %s: %s", batch_id, {r.route: r.rows for r in done})
            reports = sorted(done, key=lambda report: order[report.route])
        finally:
            held.release()
    if on_report is not None:
        on_report(reports)
    if config.on_error == "fail" and not all(report.ok for report in reports):
        raise RouteFailure(reports)
    return reports


def corrupt_plan(config: PipelineConfig) -> RoutePlan:
    """Where messages that cannot be read are written."""
    db, table = config.corrupt_target.split(".")
    return RoutePlan(CORRUPT, "", "", db, table, (FieldPlan("value", "value", "String"), FieldPlan("reason", "reason", "String")))


def _write_route(
    held: Routed,
    plan: RoutePlan,
    counts: dict[str, int] | None,
    sink: Sink,
    batch_id: int | str | None,
    replay: bool,
) -> RouteReport:
    rows = 0
    try:
        if plan.route_id == CORRUPT:
            out = held.corrupt()
        else:
            out = _stable(held.rows(plan), plan, held.config)
            if counts is not None and is_filter(plan.predicate):
                rows = counts[plan.route_id]
                if not rows and not replay:
                    return RouteReport(batch_id, plan.route_id, 0, True)
        # Rows of a day come together, so that tasks do not write a file per day
        # each; Spark splits a hot day and joins small ones.
        counter = Observation()
        out = out.hint("rebalance", held.config.period_column).observe(counter, F.count(F.lit(1)).alias("rows"))
        sink.write(out, plan, batch_id, replay)
        return RouteReport(batch_id, plan.route_id, _observed(counter, out), True)
    except Exception as problem:
        log.exception("batch %s, route %s failed", batch_id, plan.route_id)
        return RouteReport(batch_id, plan.route_id, rows, False, str(problem))


def _fill(held: Routed) -> None:
    """Parse a kept batch before several targets read it: jobs that begin together would
    each parse what no executor has kept yet. What fails here fails in every route, which reports it."""
    if not held.held or held.staged is not None:
        return
    try:
        held.frame.count()
    except Exception:
        log.debug("batch could not be kept", exc_info=True)


def _observed(counter: Observation, rows: DataFrame) -> int:
    """Rows counted by the job that a sink ran; counted anew if it ran none."""
    found: list[int] = []

    def wait() -> None:
        try:
            found.append(counter.get["rows"])
        except Exception:  # a sink whose first job left the rows out
            log.debug("no metrics", exc_info=True)

    waiting = threading.Thread(target=wait, daemon=True)
    waiting.start()
    waiting.join(METRIC_SECONDS)
    return found[0] if found else rows.count()


def _stable(rows: DataFrame, plan: RoutePlan, config: PipelineConfig) -> DataFrame:
    """Rows whose column types do not depend on what a batch happens to hold."""
    if config.message_schema is not None or config.untyped == "found":
        return rows
    names = untyped_fields(plan.fields, config.extended_types)
    return as_text(rows, [name for name in names if name.lower() != config.event_time_column.lower()])


def run_stream(
    stream: DataFrame,
    registry: Registry | Sequence[RoutePlan],
    config: PipelineConfig,
    sink: Sink,
    checkpoint: str,
    trigger_ms: int | None = None,
    available_now: bool = False,
    on_report: Reporter | None = None,
    name: str | None = None,
    clock: str | None = None,
) -> StreamingQuery:
    """Route a stream of messages with a column ``value``.

    The ingest time is taken in the streaming plan: Spark stores it with the
    offsets of the batch, so a replay sees the same time. ``clock`` names a
    column to use instead, such as the broker's timestamp of a message. Offsets
    are committed only after all routes of a batch are written. With
    ``on_error="skip"`` a batch or route that failed leaves a record beside the
    checkpoint, and ``run_skipped`` runs it again.
    """
    plans = _plans(registry, config)
    time_column = CLOCK if clock is None else clock
    started: list[str] = []
    now = F.current_timestamp() if clock is None else F.col(quote(clock))
    timed = stream.select("value", now.alias(time_column))

    def each_batch(batch: DataFrame, number: int) -> None:
        # The query's id is part of its checkpoint. With it in the name, a stream
        # begun anew does not replace batches of the one before, and streams can
        # share a target.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"{query}_{number}"
        # Only the first batch after a start can have been tried before.
        replay = not started
        try:
            reports = write_batch(batch, plans, config, sink, time_column, batch_id, replay, on_report)
        except Exception as problem:
            if config.on_error == "fail":
                raise
            log.exception("batch %s skipped", batch_id)
            reports = [RouteReport(batch_id, ALL_ROUTES, 0, False, str(problem))]
            if on_report is not None:
                on_report(reports)
        failed = {r.route: r.error or "" for r in reports if not r.ok}
        if failed:
            # Kept with the checkpoint before the offsets are committed.
            record_skipped(batch.sparkSession, checkpoint, number, batch_id, failed)
        if replay:
            started.append(batch_id)

    writer = timed.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_ms is not None:
        writer = writer.trigger(processingTime=f"{trigger_ms} milliseconds")
    return writer.start()


def run_skipped(
    spark: SparkSession,
    checkpoint: str,
    read: Callable[[SkippedBatch], DataFrame],
    registry: Registry | Sequence[RoutePlan],
    config: PipelineConfig,
    sink: Sink,
    on_report: Reporter | None = None,
    clock: str | None = None,
) -> list[RouteReport]:
    """Run the batches and routes again that a stream has skipped, and only those.

    ``read`` gives the messages of a skipped batch, e.g. ``file_batch`` or ``kafka_batch``. They get the ingest
    time they had and are written under the name of their batch, in place of
    what the first try left. A batch all of whose routes are written now loses its
    record; others keep it.
    """
    plans, every = _plans(registry, config), []
    for skipped in skipped_batches(spark, checkpoint):
        chosen = [p for p in plans if ALL_ROUTES in skipped.failed or p.route_id in skipped.failed]
        wanted = replace(config, on_error="skip")
        if CORRUPT not in skipped.failed and ALL_ROUTES not in skipped.failed:
            wanted = replace(wanted, corrupt_target=None)
        messages = read(skipped)
        if clock is None:
            messages = messages.select("value", F.timestamp_millis(F.lit(skipped.time_ms)).alias(CLOCK))
        reports = write_batch(messages, chosen, wanted, sink, clock or CLOCK, skipped.batch_id, True, on_report)
        every += reports
        if all(r.ok for r in reports):
            forget_skipped(spark, checkpoint, skipped)
    return every
