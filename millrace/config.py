"""Settings of one routing pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# Output column names and registry status text that existing
# target tables and registries already use.
INGEST_COLUMN = "fecha_hora_kudu"
PERIOD_COLUMN = "periodo"
EVENT_TIME_COLUMN = "fecha_hora_operacion"
PAYLOAD_COLUMN = "jsonPayload"
MESSAGE_VIEW = "DataIN"
ACTIVE_STATUS = "Activo"

#: Name of the column for text past the last chunk of a split.
REST = "{column}_rest"

_CHOICES = {
    "missing": ("null", "omit"),
    "split_layout": ("contiguous", "strided"),
    "on_error": ("fail", "skip"),
    "reuse": ("persist", "stage", "none"),
    "untyped": ("text", "found"),
    "count": ("observe", "first"),
}


@dataclass(frozen=True)
class PipelineConfig:
    """What to route and how to shape it.

    ``message_schema`` is the DDL of a whole message; when it is ``None`` the
    schema is inferred from the data, which costs one extra pass. Its types can then
    differ from batch to batch; ``untyped="text"`` writes columns without a type of
    their own as text, ``"found"`` as they are.
    ``payload_column=None`` routes whole messages instead of one payload column.
    ``count="observe"`` counts the rows of a route while they are written; ``"first"``
    counts all routes in a job of their own, so that routes without rows, if there
    are many of them, cost no write. ``corrupt_target`` names a target ``db.table`` for messages
    that cannot be read.
    """

    identifier: str
    message_schema: str | None = None
    payload_column: str | None = PAYLOAD_COLUMN
    root_arrays: bool = True
    active_only: bool = False

    missing: str = "null"
    extended_types: bool = False
    untyped: str = "text"

    time_zone: str | None = None
    ingest_column: str = INGEST_COLUMN
    event_time_column: str = EVENT_TIME_COLUMN
    period_column: str = PERIOD_COLUMN
    period_source: str | None = None

    split_column: str | None = None
    split_capacity: int | None = None
    split_names: tuple[str, ...] = ()
    split_layout: str = "contiguous"
    split_rest: str | None = REST

    corrupt_target: str | None = None

    on_error: str = "fail"
    count: str = "observe"
    reuse: str = "persist"
    route_threads: int = 4

    def __post_init__(self) -> None:
        for key, allowed in _CHOICES.items():
            if getattr(self, key) not in allowed:
                raise ValueError(f"{key} must be one of {allowed}, not {getattr(self, key)!r}")
        if self.split_column is not None and (not self.split_names or not self.split_capacity):
            raise ValueError("split_column needs split_capacity and split_names")
        if self.split_capacity is not None and self.split_capacity < 2:
            raise ValueError("split_capacity must be 2 or more")
        if self.corrupt_target is not None and self.corrupt_target.count(".") != 1:
            raise ValueError("corrupt_target must be db.table")
        if self.route_threads < 1:
            raise ValueError("route_threads must be positive")
