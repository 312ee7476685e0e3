"""The whole way from message text to one flat DataFrame per route."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, lru_cache, reduce

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import PipelineConfig
from millrace.functions.casts import target_type
from millrace.functions.paths import (
    has_path,
    only_paths,
    parse_path,
    path_column,
    quote,
    with_paths,
    with_text,
)
from millrace.functions.predicates import predicate_paths
from millrace.operators.enrich import enrich
from millrace.operators.envelope import (
    infer_message_schema,
    parse_messages,
    payload_gate,
    split_root_arrays,
    strip_prefix,
)
from millrace.operators.project import FieldPlan, as_text, field_column, present_fields, project_fields
from millrace.operators.route import (
    TAGS,
    RouteIndex,
    count_tagged,
    is_filter,
    keep_matching,
    route_filter,
)
from millrace.operators.split import split_wide
from millrace.plans.registry import RoutePlan, compile_routes
from millrace.sources.registry import Registry
from millrace.sources.storage import scratch_path

CLOCK = "_clock"
#: Column with the text of an unreadable message and the reason.
CORRUPT = "_corrupt"

log = logging.getLogger("millrace")


@dataclass(frozen=True)
class Routed:
    """Messages with the numbers of the routes they match, not yet split up by route.

    ``parsed`` are the messages without these numbers. ``known`` is the schema the messages
    really have; ``frame`` may be widened
    with paths that only the registry mentions. ``errors`` holds routes whose
    predicate cannot be analysed; the other routes go on without them.
    """

    frame: DataFrame
    parsed: DataFrame
    index: RouteIndex
    known: T.StructType
    plans: tuple[RoutePlan, ...]
    config: PipelineConfig
    errors: Mapping[str, str] = field(default_factory=dict)
    held: bool = False
    slots: Mapping[str, str] = field(default_factory=dict)
    staged: str | None = None

    @property
    def filters(self) -> list[RoutePlan]:
        """Routes that are plain filters and can run."""
        return [p for p in self.plans if p.route_id not in self.errors and is_filter(p.predicate)]

    @property
    def selects(self) -> list[RoutePlan]:
        """Routes that are a full SELECT and need whole messages."""
        return [p for p in self.plans if not is_filter(p.predicate)]

    @cached_property
    def _numbers(self) -> dict[str, int]:
        return {name: number for number, name in enumerate(self.index.names)}

    def number(self, plan: RoutePlan) -> int:
        """Number of a filter route in the index."""
        return self._numbers[plan.route_id]

    def hold(self) -> "Routed":
        """Keep what the routes need, so that all of them share one parse.

        That is the route numbers and each wanted path as a flat column, null for
        messages no route wants, so that every route reads its own columns only.
        Whole messages are kept just for full SELECT routes.
        """
        if self.config.reuse == "none":
            return self
        if TAGS not in self.frame.columns:
            return replace(self, frame=self.frame.persist(StorageLevel.MEMORY_AND_DISK), held=True)
        paths = dict.fromkeys(f.path for p in self.filters for f in present_fields(self.known, p.fields))
        slots = {path: f"_slot_{number}" for number, path in enumerate(paths)}
        kept = [c for c in self.frame.columns if self.selects or c in (CLOCK, TAGS, CORRUPT)]
        wanted = F.size(TAGS) > 0
        frame = self.frame.select(
            *[quote(c) for c in kept],
            *[F.when(wanted, path_column(path)).alias(slot) for path, slot in slots.items()],
        )
        staged = None
        if self.config.reuse == "stage":
            staged = scratch_path(frame.sparkSession, "staged")
            frame.write.parquet(staged)
            frame = frame.sparkSession.read.schema(frame.schema).parquet(staged)
        else:
            frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
        return replace(self, frame=frame, held=True, slots=slots, staged=staged)

    def release(self) -> None:
        """Give the kept messages up; a staged table is overwritten with nothing."""
        if self.staged is not None:
            nothing = self.frame.sparkSession.createDataFrame([], self.frame.schema)
            nothing.write.mode("overwrite").parquet(self.staged)
        elif self.held:
            self.frame.unpersist()

    def counts(self) -> dict[str, int]:
        """Rows per filter route and in total, from one job."""
        return {r["route"]: r["rows"] for r in count_tagged(self.frame, self.index.names).collect()}

    def messages(self, plan: RoutePlan) -> DataFrame:
        """Messages of one route, before projection."""
        if plan.route_id in self.errors:
            raise ValueError(self.errors[plan.route_id])
        if not is_filter(plan.predicate):
            own = [c for c in self.frame.columns if c not in (TAGS, CORRUPT) and not c.startswith("_slot_")]
            return route_filter(self.frame.select(*[quote(c) for c in own]), plan.predicate, not self.held)
        if self.held:
            return self.frame.filter(F.array_contains(TAGS, self.number(plan)))
        return route_filter(self.parsed, plan.predicate, parsed=True)

    def corrupt(self) -> DataFrame:
        """``value, reason``, ingest time and day key of the messages that cannot be read.

        They are rows of ``corrupt_target``; the config has to name one.
        """
        columns = [F.col(f"{CORRUPT}.value"), F.col(f"{CORRUPT}.reason")]
        rows = keep_matching(self.frame, F.col(CORRUPT).isNotNull())
        rows = rows.select(*columns, *([CLOCK] if CLOCK in self.frame.columns else []))
        return self._finished(rows, split=False)

    def _fields(self, plan: RoutePlan) -> list[FieldPlan]:
        """Where the fields of a filter route stand in the frame."""
        if not self.held:
            return list(plan.fields)
        return [replace(f, path=self.slots.get(f.path, f.path)) for f in plan.fields]

    def _known(self) -> T.StructType:
        """Schema that decides which fields of filter routes are present."""
        if not self.held:
            return self.known
        return T.StructType([f for f in self.frame.schema.fields if f.name in self.slots.values()])

    def check(self, plan: RoutePlan) -> None:
        """Raise if a route cannot be built."""
        if plan.route_id in self.errors:
            raise ValueError(self.errors[plan.route_id])
        if not is_filter(plan.predicate):
            self.rows(plan)
        elif self.config.missing == "omit" and not present_fields(self._known(), self._fields(plan)):
            raise ValueError(f"no field of structure {plan.structure!r} is present")

    def rows(self, plan: RoutePlan) -> DataFrame:
        """Flat, typed and enriched rows of one route, lazily."""
        messages, fields, known = self.messages(plan), self._fields(plan), self._known()
        if not is_filter(plan.predicate):
            fields, known = plan.fields, T.StructType([f for f in messages.schema.fields if f.name not in (CLOCK, CORRUPT)])
        config = self.config
        if config.missing == "omit" and not present_fields(known, fields):
            raise ValueError(f"no field of structure {plan.structure!r} is present")
        clock = [CLOCK] if CLOCK in messages.columns else []
        flat = project_fields(
            messages, fields, config.missing, clock, extended=config.extended_types, known=known
        )
        return self._finished(flat)

    def _finished(self, flat: DataFrame, split: bool = True) -> DataFrame:
        config = self.config
        flat = enrich(
            flat,
            config.time_zone,
            F.col(CLOCK) if CLOCK in flat.columns else None,
            config.ingest_column,
            config.period_column,
            config.event_time_column,
            config.period_source,
        ).drop(CLOCK)
        if split and config.split_column is not None and has_path(flat.schema, quote(config.split_column)):
            flat = split_wide(
                flat,
                config.split_column,
                config.split_capacity,
                config.split_names,
                config.split_layout,
                config.split_rest,
            )
        return flat

    def together(self, plans: Sequence[RoutePlan], column: str = "route") -> DataFrame:
        """Rows of several routes as one frame with the name of their route.

        Messages are read, parsed and matched once, whatever the number of routes: each
        is repeated for the routes it matches and projected by its route's structure.
        A column that some structures lack is null for them; one that has different
        types in them is text. A full SELECT adds a pass of its own.
        """
        filters = [p for p in plans if is_filter(p.predicate)]
        config, known = self.config, self._known()
        shapes: dict[tuple[FieldPlan, ...], list[int]] = {}
        for plan in filters:
            if plan.route_id in self.errors:
                raise ValueError(self.errors[plan.route_id])
            shapes.setdefault(tuple(self._fields(plan)), []).append(self.number(plan))
        parts = []
        if filters:
            own = F.array(*[F.lit(self.number(p)) for p in filters])
            wanted = F.array_intersect(F.col(TAGS), own) if len(filters) < len(self.index.names) else F.col(TAGS)
            hits = self.frame.withColumn("_route", F.explode_outer(wanted)).filter(F.col("_route").isNotNull())
            ways: dict[str, list[tuple[list[int], Column]]] = {}
            for fields, numbers in shapes.items():
                chosen = fields if config.missing == "null" else present_fields(known, fields)
                if not chosen:
                    raise ValueError(f"no field of the routes {[self.index.names[n] for n in numbers]} is present")
                for f in chosen:
                    value = field_column(known, f, config.extended_types)
                    ways.setdefault(f.name, []).append((numbers, value))
            names = F.array(*[F.lit(name) for name in self.index.names])
            flat = hits.select(
                F.get(names, F.col("_route")).alias(column),
                *[self._merged(hits, name, found, len(shapes)) for name, found in ways.items()],
                *([CLOCK] if CLOCK in hits.columns else []),
            )
            parts.append(self._finished(flat))
        for plan in plans:
            if not is_filter(plan.predicate):
                parts.append(self.rows(plan).withColumn(column, F.lit(plan.route_id)))
        kinds: dict[str, set[T.DataType]] = {}
        for f in (f for part in parts for f in part.schema.fields):
            kinds.setdefault(f.name, set()).add(f.dataType)
        mixed = [name for name, found in kinds.items() if len(found) > 1]
        return reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(part, mixed) if mixed else part for part in parts]
        )

    @staticmethod
    def _merged(hits: DataFrame, name: str, ways: list[tuple[list[int], Column]], shapes: int) -> Column:
        """One column from the structures that have it."""
        if len(ways) == shapes == 1:
            return ways[0][1].alias(name)
        kinds = hits.select(*[value.alias(str(n)) for n, (_, value) in enumerate(ways)]).schema
        if len({f.dataType for f in kinds}) > 1:
            nested = [isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in kinds]
            ways = [(n, F.to_json(v) if deep else v.cast("string")) for (n, v), deep in zip(ways, nested)]
        merged = F.lit(None)
        for numbers, value in reversed(ways):
            merged = F.when(F.col("_route").isin(numbers), value).otherwise(merged)
        return merged.alias(name)


class RoutedFrames(Mapping[str, DataFrame]):
    """One lazy frame per route, made when it is asked for; ``together`` is all of them in one pass.

    If the batch is held, ``release`` gives it up when no frame is needed any more.
    """

    def __init__(self, routed: Routed | None = None, plans: Sequence[RoutePlan] = ()) -> None:
        self._routed, self._plans = routed, {plan.route_id: plan for plan in plans}
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, route: str) -> DataFrame:
        if route not in self._made:
            self._made[route] = self._routed.rows(self._plans[route])
        return self._made[route]

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)

    def __eq__(self, other: object) -> bool:
        return dict(self) == other

    def together(self, column: str = "route") -> DataFrame | None:
        """Rows of all routes with the name of their route; ``None`` if there is no route."""
        return self._routed.together(list(self._plans.values()), column) if self._plans else None

    def corrupt(self) -> DataFrame | None:
        """Messages that cannot be read, if the config has a target for them."""
        return None if self._routed is None or CORRUPT not in self._routed.frame.columns else self._routed.corrupt()

    def release(self) -> None:
        """Give up a held batch."""
        if self._routed is not None:
            self._routed.release()


def route_messages(
    df: DataFrame,
    plans: Sequence[RoutePlan],
    config: PipelineConfig,
    clock: str | None = None,
    untyped_text: bool = False,
) -> Routed | None:
    """Parse and match messages; ``None`` when no message has the payload column.

    ``df`` has the text in ``value``; ``clock`` names a column of ``df`` with the
    ingest time, otherwise the time of the query is used. With ``untyped_text``
    fields without a type of their own, in an inferred schema, are read as text, so that the
    reader writes a value alike whatever else a batch holds, unless a predicate tests them.
    """
    columns = [F.col("value")]
    if clock is not None:
        columns.append(F.col(quote(clock)).alias(CLOCK))
    text = strip_prefix(df.select(*columns))
    if config.root_arrays:
        text = split_root_arrays(text)

    fields = [f.path for plan in plans for f in plan.fields]
    if config.message_schema is not None:
        known = schema = _struct(config.message_schema)
    else:
        known = infer_message_schema(text)
        tested = [path for plan in plans for path in predicate_paths(plan.predicate)]
        if untyped_text and all(is_filter(plan.predicate) for plan in plans):
            free = [f.path for plan in plans for f in plan.fields if target_type(f.type, config.extended_types) is None]
            read = {tuple(step.name.lower() for step in parse_path(path)) for path in tested}
            known = with_text(known, [p for p in free if not _read_with(p, read)])
        schema = with_paths(known, _inside([*fields, *tested], config.payload_column))
    if config.payload_column is not None and config.payload_column not in known.names or not known.fields:
        if config.corrupt_target is None:
            return None
        # no route can run, but what cannot be read is still put out
        frame = parse_messages(text, known, corrupt=CORRUPT)
        return Routed(frame, frame, RouteIndex(()), known, (), config)

    # Parse only what some route reads. A full SELECT may read anything.
    wanted = schema
    if all(is_filter(plan.predicate) for plan in plans):
        tested = [path for plan in plans for path in predicate_paths(plan.predicate, keywords=True)]
        wanted = only_paths(schema, _inside([*fields, *tested], config.payload_column))
    routed = _match(text, wanted, known, plans, config, clock)
    if routed.errors and wanted != schema:
        routed = _match(text, schema, known, plans, config, clock)
    for route, problem in routed.errors.items():
        log.warning("route %s: predicate cannot run: %s", route, problem)
    return routed


def _match(
    text: DataFrame,
    schema: T.StructType,
    known: T.StructType,
    plans: Sequence[RoutePlan],
    config: PipelineConfig,
    clock: str | None,
) -> Routed:
    """Parse with ``schema`` and add the match flags."""
    if config.payload_column is not None:
        known = T.StructType([known[config.payload_column]])
        if config.payload_column not in schema.names:
            schema = known
    corrupt = CORRUPT if config.corrupt_target is not None else None
    frame = parse_messages(text, schema, corrupt=corrupt)
    if config.payload_column is not None:
        keep = [*([CLOCK] if clock is not None else []), *([corrupt] if corrupt else [])]
        frame = payload_gate(frame, config.payload_column, tuple(keep))
    predicates = {plan.route_id: plan.predicate for plan in plans if is_filter(plan.predicate)}
    errors: dict[str, str] = {}
    shape = json.dumps(frame.schema.jsonValue())
    index = _index(tuple(predicates.items()), shape)
    try:
        tagged = index.tag(frame)
    except PySparkException:
        for condition, numbers in index.conditions.items():
            try:
                route_filter(frame, condition)
            except PySparkException as problem:
                for number in numbers:
                    errors[index.names[number]] = str(problem)
                    del predicates[index.names[number]]
        index = _index(tuple(predicates.items()), shape)
        tagged = index.tag(frame)
    return Routed(tagged, frame, index, known, tuple(plans), config, errors)


@lru_cache(maxsize=64)
def _index(predicates: tuple[tuple[str, str], ...], schema: str) -> RouteIndex:
    """The index of a registry for a schema, made once for all batches that have it."""
    return RouteIndex.of(dict(predicates), T.StructType.fromJson(json.loads(schema)))


def _read_with(path: str, tested: set[tuple[str, ...]]) -> bool:
    """Whether a predicate tests a path, something in it, or something around it."""
    names = tuple(step.name.lower() for step in parse_path(path))
    return any(names[: len(t)] == t or t[: len(names)] == names for t in tested)


def _inside(paths: list[str], payload_column: str | None) -> list[str]:
    """Paths that start at the payload column; all of them if there is none."""
    if payload_column is None:
        return paths
    return [p for p in paths if parse_path(p)[0].name.lower() == payload_column.lower()]


def _struct(schema: str) -> T.StructType:
    found = T.DataType.fromDDL(schema)
    return found if isinstance(found, T.StructType) else T.StructType([T.StructField("value", found)])


def run_batch(
    df: DataFrame,
    registry: Registry | Sequence[RoutePlan],
    config: PipelineConfig,
    clock: str | None = None,
    hold: bool = False,
) -> RoutedFrames:
    """One lazy DataFrame per route; nothing runs but schema inference if asked for.

    Each frame reads and parses the messages by itself. ``together()`` of the
    result is all routes in one pass; with ``hold`` all frames share the messages
    that the first of them parses, kept as ``config.reuse`` says until
    ``release()``. A route that cannot be built is an error, or left out with
    ``on_error="skip"``.
    """
    plans = _plans(registry, config)
    routed = route_messages(df, plans, config, clock)
    if routed is None:
        return RoutedFrames()
    if hold:
        routed = routed.hold()
    runnable = []
    for plan in routed.plans:
        try:
            routed.check(plan)
        except (PySparkException, ValueError) as problem:
            if config.on_error == "fail":
                raise
            log.warning("route %s skipped: %s", plan.route_id, problem)
        else:
            runnable.append(plan)
    return RoutedFrames(routed, runnable)


def _plans(
    registry: Registry | Sequence[RoutePlan], config: PipelineConfig
) -> tuple[RoutePlan, ...]:
    if isinstance(registry, Registry):
        return compile_routes(registry, config.identifier, config.active_only, config.on_error == "skip")
    return tuple(registry)
