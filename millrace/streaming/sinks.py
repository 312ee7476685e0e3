"""Targets of the routes.

``batch_id`` is ``None`` for a batch job that just appends. In a stream it names
the query and the batch, and comes again when a batch is replayed; ``replay`` says
that this may be such a case.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from typing import Protocol
from urllib.parse import quote as urlquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import PERIOD_COLUMN
from millrace.functions.paths import quote
from millrace.operators.project import untyped_fields
from millrace.plans.registry import RoutePlan, target_name
from millrace.sources.shared_files import SharedFiles


class Sink(Protocol):
    """A target. ``write`` runs the rows in one job, which also counts them."""

    def write(
        self, rows: DataFrame, plan: RoutePlan, batch_id: int | str | None, replay: bool = False
    ) -> None: ...


MANIFEST, STAGING = "_manifest", "_staging"
#: Commit records from which on they are read by a Spark job instead of one by one.
MANY_RECORDS = 64


@dataclass(frozen=True)
class FileSink:
    """Files under ``<root>/<db>/<table>``, in one folder per day key, with a record of commits.

    A batch and route first write to a staging folder. Its files then move into the folders of
    their days, and one small record in ``_manifest`` names them; writing that record is the
    commit. ``read`` takes only files that a record names, so what a failed try left behind is
    never seen, and the record of a replayed batch takes the place of the one before, whatever
    days its rows fall on now. Writers share no folder that either of them commits to. A batch
    job without an id gets a new one and so appends.

    ``compact`` rewrites days that get no more rows into fewer files and swaps them in by one
    record, while streams write and others read. ``clean`` removes files that no record names.
    """

    root: str
    format: str = "parquet"
    period_column: str = PERIOD_COLUMN
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, plan: RoutePlan) -> str:
        return f"{self.root}/{plan.db}/{plan.table}"

    def write(
        self, rows: DataFrame, plan: RoutePlan, batch_id: int | str | None, replay: bool = False
    ) -> None:
        if batch_id is None:
            batch_id = f"batch_{uuid.uuid4().hex}"
        spark, table = rows.sparkSession, self.path(plan)
        marked = _marked(rows, plan, batch_id)
        files = SharedFiles(spark, self.root)
        write_id, placed = self._place(marked, plan, files)
        record = {
            "batch_id": str(batch_id),
            "route": plan.route_id,
            "write_id": write_id,
            "files": placed,
            "schema": marked.schema.json(),
        }
        if placed or replay and files.exists(f"{table}/{MANIFEST}"):
            name = f"{urlquote(str(batch_id), safe='')}~{urlquote(plan.route_id, safe='')}"
            self._commit(files, plan, name, record)

    def _place(self, rows: DataFrame, plan: RoutePlan, files: SharedFiles) -> tuple[str, list[str]]:
        """Write rows and move their files into the folders of their days."""
        write_id, table = uuid.uuid4().hex, self.path(plan)
        staging = f"{self.root}/{STAGING}/{write_id}"
        writer = rows.write.format(self.format).options(**self.options)
        writer.partitionBy(self.period_column).save(staging)
        placed = []
        for name in files.names(staging, depth=2):
            day, _, part = name.rpartition("/")
            placed.append(f"{day}/{write_id}-{part}")
            files.move(f"{staging}/{name}", f"{table}/{placed[-1]}")
        files.remove(staging, below=True)
        return write_id, placed

    def _commit(
        self, files: SharedFiles, plan: RoutePlan, name: str, record: Mapping, replace: bool = True
    ) -> None:
        folder = f"{self.path(plan)}/{MANIFEST}"
        files.make_folder(folder)
        files.write(f"{folder}/{name}.json", json.dumps(record), replace)

    def _records(self, spark: SparkSession, plan: RoutePlan) -> "Records":
        files, folder = SharedFiles(spark, self.root), f"{self.path(plan)}/{MANIFEST}"
        names = files.names(folder)
        if len(names) > MANY_RECORDS:
            # a record is one line
            texts = [r[0] for r in spark.read.text([f"{folder}/{name}" for name in names]).collect()]
        else:
            texts = [files.read(f"{folder}/{name}") for name in names]
        return Records.of(map(json.loads, texts))

    def read(
        self, spark: SparkSession, plan: RoutePlan, merge_schema: bool = True
    ) -> DataFrame:
        """All committed rows of a target, with the columns of all its batches.

        The columns are those that the records state, so no file is opened to find
        them. Without ``merge_schema`` they are those of any one batch.
        """
        records = self._records(spark, plan)
        if not records.commits and not records.compactions:
            raise ValueError(f"nothing has been committed to {self.path(plan)}")
        schema = records.schema(merge_schema)
        parts = [self._load(spark, plan, schema, records.live())]
        for compaction in records.compactions:
            kept = self._load(spark, plan, schema, records.still(compaction))
            for batch_id, route in records.superseded(compaction):
                kept = kept.where(~((F.col("batch_id") == batch_id) & (F.col("route") == route)))
            parts.append(kept)
        return reduce(DataFrame.unionByName, [part for part in parts[1:] if part is not None], parts[0])

    def _load(self, spark: SparkSession, plan: RoutePlan, schema: T.StructType, names: Sequence[str]) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options).schema(schema)
        if not names:
            return spark.createDataFrame([], schema)
        table = self.path(plan)
        return reader.option("basePath", table).load([f"{table}/{name}" for name in names])

    def compact(self, spark: SparkSession, plan: RoutePlan, before: int, least_files: int = 2) -> int:
        """Rewrite days with a key less than ``before`` that have ``least_files`` files or more.

        Returns the number of files that were replaced. The newest batch of each stream may
        come again and is left alone. Rows are the same before, during and after: the old files
        stay until ``clean``, and one record swaps the new ones in. If two compactions of a target
        meet, the second fails and changes nothing.
        """
        records = self._records(spark, plan)
        held = records.newest()
        days: dict[str, list[str]] = {}
        batches: dict[tuple[str, str], str] = {}
        for commit in records.commits:
            for name in records.left(commit):
                if (commit["batch_id"], commit["route"]) not in held and self._closed(name, before):
                    days.setdefault(name.partition("/")[0], []).append(name)
        for compaction in records.compactions:
            # what supersedes rows of compacted files is resolved by the next compaction
            for name in records.still(compaction):
                if self._closed(name, before):
                    days.setdefault(name.partition("/")[0], []).append(name)
        chosen = {name for names in days.values() if len(names) >= least_files for name in names}
        if not chosen:
            return 0
        schema = records.schema(True)
        parts = []
        for commit in records.commits:
            names = [name for name in records.left(commit) if name in chosen]
            if names:
                parts += names
                batches[commit["batch_id"], commit["route"]] = commit["write_id"]
        rows = self._load(spark, plan, schema, parts)
        for compaction in records.compactions:
            names = [name for name in records.still(compaction) if name in chosen]
            if names:
                kept, gone = self._load(spark, plan, schema, names), set(records.superseded(compaction))
                for batch_id, route in gone:
                    kept = kept.where(~((F.col("batch_id") == batch_id) & (F.col("route") == route)))
                rows = rows.unionByName(kept)
                for batch_id, route, write_id in compaction["batches"]:
                    if (batch_id, route) not in gone:
                        batches.setdefault((batch_id, route), write_id)
        files = SharedFiles(spark, self.root)
        write_id, placed = self._place(rows.hint("rebalance", self.period_column), plan, files)
        record = {
            "write_id": write_id,
            "files": placed,
            "replaces": sorted(chosen),
            "batches": [[*key, value] for key, value in sorted(batches.items())],
            "schema": schema.json(),
        }
        self._commit(files, plan, f"compaction-{len(records.compactions) + 1:06d}", record, replace=False)
        return len(chosen)

    def _closed(self, name: str, before: int) -> bool:
        day = name.partition("/")[0].partition("=")[2]
        return day.lstrip("-").isdigit() and int(day) < before

    def clean(self, spark: SparkSession, plan: RoutePlan, older_than_hours: float = 24.0) -> int:
        """Remove files that no record names and that are older than any running read or write."""
        records, files, table = self._records(spark, plan), SharedFiles(spark, self.root), self.path(plan)
        named = set(records.live()).union(*[records.still(c) for c in records.compactions])
        latest = time.time() * 1000 - older_than_hours * 3_600_000
        gone = [name for name, _, changed in files.list(table, below=True) if name not in named and changed < latest]
        for name in gone:
            files.remove(f"{table}/{name}")
        return len(gone)


@dataclass(frozen=True)
class Records:
    """What the commit records of a target say."""

    commits: tuple[Mapping, ...]
    compactions: tuple[Mapping, ...]

    @classmethod
    def of(cls, records: Iterable[Mapping]) -> "Records":
        every = list(records)
        return cls(
            tuple(r for r in every if "replaces" not in r), tuple(r for r in every if "replaces" in r)
        )

    @cached_property
    def _replaced(self) -> frozenset[str]:
        return frozenset(name for c in self.compactions for name in c["replaces"])

    def left(self, commit: Mapping) -> list[str]:
        """Files of a commit that no compaction has replaced."""
        return [name for name in commit["files"] if name not in self._replaced]

    def live(self) -> list[str]:
        return [name for commit in self.commits for name in self.left(commit)]

    still = left  # a compaction's own files can be replaced by a later one

    def superseded(self, compaction: Mapping) -> list[tuple[str, str]]:
        """Batches and routes that were written again after a compaction took their rows."""
        now = {(c["batch_id"], c["route"]): c["write_id"] for c in self.commits}
        return [(b, r) for b, r, write_id in compaction["batches"] if now.get((b, r), write_id) != write_id]

    def newest(self) -> set[tuple[str, str]]:
        """The last batch of each stream, by the number at the end of its name."""
        last: dict[str, int] = {}
        numbers = []
        for c in self.commits:
            query, _, number = c["batch_id"].rpartition("_")
            if number.isdigit():
                last[query] = max(last.get(query, 0), int(number))
                numbers.append((query, int(number), (c["batch_id"], c["route"])))
        return {key for query, number, key in numbers if last[query] == number}

    def schema(self, merge: bool) -> T.StructType:
        """Columns of all commits by name; columns of one name must have one type."""
        texts = dict.fromkeys(r["schema"] for r in (*self.commits, *self.compactions))
        fields: dict[str, T.StructField] = {}
        for text in list(texts)[: None if merge else 1]:
            for f in T.StructType.fromJson(json.loads(text)).fields:
                known = fields.setdefault(f.name, T.StructField(f.name, f.dataType))
                if known.dataType != f.dataType:
                    raise ValueError(f"column {f.name} is {known.dataType} in one batch and {f.dataType} in another")
        return T.StructType(list(fields.values()))


def _marked(rows: DataFrame, plan: RoutePlan, batch_id: int | str | None) -> DataFrame:
    name = F.lit(None if batch_id is None else str(batch_id)).cast("string")
    return rows.withColumns({"batch_id": name, "route": F.lit(plan.route_id)})


def _as_stored(rows: DataFrame, stored: T.StructType, plan: RoutePlan) -> DataFrame:
    """Untyped columns cast to the types that the target already has."""
    untyped = {name.lower() for name in untyped_fields(plan.fields)}
    kinds = {f.name.lower(): f.dataType for f in stored.fields if f.name.lower() in untyped}
    casts = {
        f.name: F.col(quote(f.name)).cast(kinds[f.name.lower()])
        for f in rows.schema.fields
        if kinds.get(f.name.lower(), f.dataType) != f.dataType
    }
    return rows.withColumns(casts)


@dataclass(frozen=True)
class TableSink:
    """Catalog tables ``db.table``, partitioned by batch, route and day.

    A streamed batch overwrites its own batch and route partitions as a whole, so
    a replay does not add rows twice. Batch jobs append, with no batch number.
    Columns without a type in the registry take the type the table has; a value
    that it cannot hold is an error, so the batch is not committed without it.
    """

    format: str = "parquet"
    period_column: str = PERIOD_COLUMN

    def name(self, plan: RoutePlan) -> str:
        return f"{quote(plan.db)}.{quote(plan.table)}"

    def write(
        self, rows: DataFrame, plan: RoutePlan, batch_id: int | str | None, replay: bool = False
    ) -> None:
        spark, name = rows.sparkSession, self.name(plan)
        marked = _marked(rows, plan, batch_id)
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(plan.db)}")
            keys = ["batch_id", "route", self.period_column]
            # not from the rows themselves: a sink runs them once, and that job counts them
            empty = spark.createDataFrame([], marked.schema).write.format(self.format).partitionBy(*keys)
            empty.mode("ignore").saveAsTable(name)
        columns = spark.table(name).columns
        if sorted(columns) != sorted(marked.columns):
            raise ValueError(f"{name} has columns {columns}, not {marked.columns}")
        rows, marked = (_as_stored(df, spark.table(name).schema, plan) for df in (rows, marked))
        if batch_id is None:
            marked.select(*[quote(c) for c in columns]).write.insertInto(name)
            return
        own = [quote(c) for c in columns if c not in ("batch_id", "route")]
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION "
            f"(batch_id = '{batch_id}', route = '{plan.route_id}', {quote(self.period_column)}) "
            f"SELECT {', '.join(own)} FROM {{rows}}",
            rows=rows,
        )


@dataclass(frozen=True)
class ConnectorSink:
    """Append through any Spark data source, one target table per route.

    ``table_option`` is the option that names the target and ``pattern`` its
    value. A replayed batch appends again; the target has to merge by key.
    """

    format: str
    table_option: str
    pattern: str = "{db}.{table}"
    options: Mapping[str, str] = field(default_factory=dict)

    def write(
        self, rows: DataFrame, plan: RoutePlan, batch_id: int | str | None, replay: bool = False
    ) -> None:
        target = target_name(plan.db, plan.table, self.pattern)
        writer = rows.write.format(self.format).options(**self.options)
        writer.option(self.table_option, target).mode("append").save()
