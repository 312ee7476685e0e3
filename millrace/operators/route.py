"""Routing: which messages match which registry routes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import MESSAGE_VIEW
from millrace.functions.paths import path_column, path_type, quote
from millrace.functions.predicates import (
    condition_text,
    equality,
    leniently,
    pair_form,
    predicate_column,
    select_text,
)
from millrace.sources.sessions import sql_over

#: Column with the numbers of the routes that a message matches.
TAGS = "_routes"

#: Values of one path up to which they are compared one by one, not looked up.
FEW = 8


def route_filter(df: DataFrame, predicate: str, parsed: bool = False) -> DataFrame:
    """Messages that match one registry predicate.

    Spark can push the test down to the files. Pass ``parsed=True`` for columns
    just parsed from JSON, so that the test does not parse the text once more. A
    full SELECT may name the messages several times; each time they are read and
    parsed once, so a caller may want to persist them.
    """
    if _plain(predicate, df.schema):
        named, column = df.alias(MESSAGE_VIEW), predicate_column(predicate, df.schema)
        return keep_matching(named, column) if parsed else named.filter(column)

    def matching(frame: DataFrame) -> DataFrame:
        column = predicate_column(predicate, frame.schema)
        if column is None:
            view = parsed_once(frame) if parsed else frame
            return sql_over(view, select_text(predicate), MESSAGE_VIEW)
        named = frame.alias(MESSAGE_VIEW)
        return keep_matching(named, column) if parsed else named.filter(column)

    return leniently(df, matching)


def _plain(predicate: str, schema: T.StructType) -> bool:
    """Whether a predicate compares text with text only, so that ANSI mode does not matter."""
    if pair_form(predicate) is not None:
        return True
    same = equality(condition_text(predicate) or "")
    return same is not None and isinstance(path_type(schema, same[0]), T.StringType)


def keep_matching(df: DataFrame, condition: Column) -> DataFrame:
    """Filter freshly parsed messages without parsing any of them again.

    Spark moves a plain filter ahead of the parse and then reads the JSON once
    per condition and once more for the rows it keeps. It does not move a filter
    on what ``explode_outer`` puts out.
    """
    hit = F.explode_outer(F.when(condition, F.array(F.lit(True))))
    return df.withColumn("_hit", hit).filter("_hit").drop("_hit")


def parsed_once(df: DataFrame) -> DataFrame:
    """The same rows behind a step that no filter or projection is moved ahead of,
    so that whatever reads several fields reads one parsed message."""
    whole = F.struct(*[F.col(quote(c)) for c in df.columns])
    return df.select(F.inline(F.array(whole)))


def is_filter(predicate: str) -> bool:
    """Whether a predicate is a plain filter, so that all routes share one pass."""
    return pair_form(predicate) is not None or condition_text(predicate) is not None


def match_routes(df: DataFrame, predicates: Mapping[str, str]) -> DataFrame:
    """Add one boolean column per route, all evaluated in one projection.

    A null condition counts as no match. For many routes :func:`tag_matches` is
    the cheaper form.
    """

    def flagged(frame: DataFrame) -> DataFrame:
        schema = frame.schema
        flags = [
            F.coalesce(predicate_column(text, schema).cast("boolean"), F.lit(False)).alias(flag(route))
            for route, text in predicates.items()
        ]
        return frame.alias(MESSAGE_VIEW).select("*", *flags)

    return leniently(df, flagged) if predicates else df


def flag(route: str) -> str:
    """Name of the boolean column of a route."""
    return f"_match_{route}"


def matched(route: str) -> Column:
    return F.col(quote(flag(route)))


def any_match(routes: Sequence[str]) -> Column:
    flags = [F.lit(False), *[matched(route) for route in routes]]
    return F.greatest(*flags) if routes else flags[0]


@dataclass(frozen=True)
class RouteIndex:
    """The predicates of many routes, sorted by what they test.

    ``equal`` has, for each list of paths, the values they are compared with and
    the numbers of the routes that want these values; ``conditions`` has each
    distinct other condition once, with the numbers of its routes. Routes that
    test a path the messages lack are in neither. It depends on the predicates and the
    schema alone, so one index serves all batches of a schema.
    """

    names: tuple[str, ...]
    equal: Mapping[tuple[str, ...], Mapping[tuple[str, ...], tuple[int, ...]]] = field(default_factory=dict)
    conditions: Mapping[str, tuple[int, ...]] = field(default_factory=dict)

    @classmethod
    def of(cls, predicates: Mapping[str, str], schema: T.StructType) -> "RouteIndex":
        equal: dict[tuple[str, ...], dict[tuple[str, ...], list[int]]] = {}
        conditions: dict[str, list[int]] = {}
        kinds: dict[str, T.DataType | None] = {}

        def kind(path: str) -> T.DataType | None:
            if path not in kinds:
                kinds[path] = path_type(schema, path)
            return kinds[path]

        for number, text in enumerate(predicates.values()):
            pairs = pair_form(text)
            if pairs is None:
                condition = condition_text(text)
                same = equality(condition)
                if same is None or not isinstance(kind(same[0]), T.StringType):
                    conditions.setdefault(condition, []).append(number)
                    continue
                pairs = [same]
            wanted = dict(pairs)
            if any(wanted[path] != value or kind(path) is None for path, value in pairs):
                continue  # two values for one path, or a path the messages lack
            paths = tuple(sorted(wanted))
            values = tuple(wanted[path] for path in paths)
            equal.setdefault(paths, {}).setdefault(values, []).append(number)
        frozen = {p: {v: tuple(n) for v, n in by.items()} for p, by in equal.items()}
        return cls(tuple(predicates), frozen, {c: tuple(n) for c, n in conditions.items()})

    def _listed(self, numbers: Sequence[int], named: bool) -> Column:
        """Routes as an array of numbers, or of numbers and names."""
        if not named:
            return _numbers(numbers)
        entries = [F.struct(F.lit(n).alias("number"), F.lit(self.names[n]).alias("name")) for n in numbers]
        return F.array(*entries).cast("array<struct<number: int, name: string>>")

    def tag(self, df: DataFrame, column: str = TAGS, named: bool = False) -> DataFrame:
        """Add the routes that each message matches, in order: their numbers, or ``named`` their names.

        Values of a path are looked up in a table that is as long as the registry
        and is broadcast; a few are compared one by one. No function with a lambda
        is used, since those would parse a message once more for each field they test.
        """
        names, found = list(df.columns), []
        kind = "array<struct<number: int, name: string>>" if named else "array<int>"
        for at, (paths, by_value) in enumerate(self.equal.items()):
            texts = [path_column(path).cast("string") for path in paths]
            if len(by_value) <= FEW:
                for values, numbers in by_value.items():
                    tests = [text == F.lit(value) for text, value in zip(texts, values)]
                    found.append(F.when(reduce(Column.__and__, tests), self._listed(numbers, named)))
                continue
            keys = [f"_key_{at}_{n}" for n in range(len(paths))]
            kinds = ", ".join(f"{key} string" for key in keys)
            entry = (lambda n: (n, self.names[n])) if named else (lambda n: n)
            rows = [(*values, [entry(n) for n in numbers]) for values, numbers in by_value.items()]
            table = df.sparkSession.createDataFrame(rows, f"{kinds}, _found_{at} {kind}")
            df = df.join(F.broadcast(table), [text == F.col(key) for text, key in zip(texts, keys)], "left").drop(*keys)
            found.append(F.col(f"_found_{at}"))

        def tagged(frame: DataFrame) -> DataFrame:
            tests = [F.when(F.expr(text).cast("boolean"), self._listed(n, named)) for text, n in self.conditions.items()]
            lists = [F.coalesce(numbers, self._listed((), named)) for numbers in (*found, *tests)]
            every = F.sort_array(F.concat(*lists)) if lists else self._listed((), named)
            every = every["name"] if named else every
            return frame.alias(MESSAGE_VIEW).select(*[quote(c) for c in names], every.alias(column))

        return leniently(df, tagged) if self.conditions else tagged(df)


def _numbers(numbers: Sequence[int]) -> Column:
    return F.array(*[F.lit(n) for n in numbers]).cast("array<int>")


def tag_matches(df: DataFrame, predicates: Mapping[str, str], column: str = TAGS) -> DataFrame:
    """Add the numbers of the routes each message matches, in the order of ``predicates``."""
    return RouteIndex.of(predicates, df.schema).tag(df, column)


def tag_routes(df: DataFrame, predicates: Mapping[str, str], column: str = "routes") -> DataFrame:
    """Add the array of route names each message matches; no match is an empty array."""
    return RouteIndex.of(predicates, df.schema).tag(df, column, named=True)


def fan_out(df: DataFrame, predicates: Mapping[str, str], column: str = "route") -> DataFrame:
    """One row per message and matching route. See :func:`keep_matching` for the
    outer form."""
    tagged = tag_routes(parsed_once(df), predicates, "_names")
    exploded = tagged.withColumn(column, F.explode_outer("_names")).drop("_names")
    return exploded.filter(F.col(quote(column)).isNotNull())


def unmatched(df: DataFrame, predicates: Mapping[str, str]) -> DataFrame:
    """Messages that match no route."""
    missed = keep_matching(tag_matches(parsed_once(df), predicates), F.size(TAGS) == 0)
    return missed.select(*[quote(c) for c in df.columns])


def count_tagged(df: DataFrame, names: Sequence[str], column: str = TAGS) -> DataFrame:
    """Rows per route, plus ``total`` and ``unmatched``, of messages with a column of
    route numbers. Tasks add up before anything is shuffled, so each sends one
    row per route it met."""
    total, missed = len(names), len(names) + 1
    kinds = F.concat(
        F.col(column), F.when(F.size(column) == 0, _numbers((total, missed))).otherwise(_numbers((total,)))
    )
    counts = df.select(F.explode(kinds).alias("number")).groupBy("number").agg(F.count("*").alias("rows"))
    every = df.sparkSession.createDataFrame(
        list(enumerate([*names, "total", "unmatched"])), "number int, route string"
    )
    return every.join(F.broadcast(counts), "number", "left").select("route", F.coalesce("rows", F.lit(0)).alias("rows"))


def count_matches(df: DataFrame, routes: Sequence[str]) -> DataFrame:
    """Rows per route, plus ``total`` and ``unmatched``, from one aggregate row.

    ``partitions`` is the number of partitions that hold messages.

    ``df`` carries the columns of :func:`match_routes`. Each task sends a single
    row of counters, however many routes there are and however skewed they are.
    """
    flags = [matched(route) for route in routes]
    counted = df.select(*flags, F.spark_partition_id().alias("_part")).agg(
        F.count_if(~any_match(routes)).alias("unmatched"),
        F.count(F.lit(1)).alias("total"),
        (F.coalesce(F.max("_part"), F.lit(-1)) + 1).cast("long").alias("partitions"),
        *[F.count_if(matched(route)).alias(f"route:{route}") for route in routes],
    )
    totals = ("unmatched", "total", "partitions")
    pairs = [*[(name, name) for name in totals], *[(r, f"route:{r}") for r in routes]]
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("route"), F.col(f"`{source}`").alias("rows"))
                    for name, source in pairs
                ]
            )
        )
    )
