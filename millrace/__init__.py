"""Registry-driven routing of JSON messages to flat tables, on Spark."""

from millrace.config import PipelineConfig
from millrace.operators.project import FieldPlan
from millrace.plans.pipeline import run_batch
from millrace.plans.registry import RoutePlan, compile_routes
from millrace.sources.registry import (
    Registry,
    registry_from_csv,
    registry_from_format,
    registry_from_frames,
    registry_from_tables,
)
from millrace.streaming.runner import RouteReport, run_skipped, run_stream, write_batch
from millrace.streaming.sinks import ConnectorSink, FileSink, TableSink

__all__ = [
    "ConnectorSink",
    "FieldPlan",
    "FileSink",
    "PipelineConfig",
    "Registry",
    "RoutePlan",
    "RouteReport",
    "TableSink",
    "compile_routes",
    "registry_from_csv",
    "registry_from_format",
    "registry_from_frames",
    "registry_from_tables",
    "run_batch",
    "run_skipped",
    "run_stream",
    "write_batch",
]
