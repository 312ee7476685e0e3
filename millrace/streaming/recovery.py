"""Records of the batches that a stream has skipped, kept beside its checkpoint."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.messages import record_messages
from millrace.sources.shared_files import SharedFiles

SKIPPED = "skipped_batches"


@dataclass(frozen=True)
class SkippedBatch:
    """A batch that a stream went on without, or some of its routes.

    ``failed`` has the error of each route, or of ``*`` if no route was tried. ``start`` and ``end`` are the
    offsets of each source, as the checkpoint has them; ``time_ms`` is the batch's ingest time.
    """

    number: int
    batch_id: str
    time_ms: int
    failed: Mapping[str, str]
    start: tuple[str | None, ...]
    end: tuple[str, ...]
    checkpoint: str


def _offsets(files: SharedFiles, checkpoint: str, number: int) -> tuple[int, tuple[str, ...]]:
    """Time and source offsets of a batch: a version, the settings, then a line per source."""
    _, settings, *sources = files.read(f"{checkpoint}/offsets/{number}").splitlines()
    return int(json.loads(settings)["batchTimestampMs"]), tuple(sources)


def record_skipped(
    spark: SparkSession, checkpoint: str, number: int, batch_id: str, failed: Mapping[str, str]
) -> None:
    """Note a batch with its offsets and errors; a later note of it replaces this one."""
    files = SharedFiles(spark, checkpoint)
    time_ms, end = _offsets(files, checkpoint, number)
    start = _offsets(files, checkpoint, number - 1)[1] if number else (None,) * len(end)
    folder = f"{checkpoint}/{SKIPPED}"
    files.make_folder(folder)
    record = {"number": number, "batch_id": batch_id, "time_ms": time_ms, "failed": dict(failed)}
    files.write(f"{folder}/{number}.json", json.dumps(record | {"start": start, "end": end}))


def skipped_batches(spark: SparkSession, checkpoint: str) -> list[SkippedBatch]:
    """The batches that wait to be run again, oldest first."""
    files, folder = SharedFiles(spark, checkpoint), f"{checkpoint}/{SKIPPED}"
    found = [json.loads(files.read(f"{folder}/{name}")) for name, _, _ in files.list(folder)]
    batches = [
        SkippedBatch(**{**r, "start": tuple(r["start"]), "end": tuple(r["end"]), "checkpoint": checkpoint}) for r in found
    ]
    return sorted(batches, key=lambda batch: batch.number)


def forget_skipped(spark: SparkSession, checkpoint: str, batch: SkippedBatch) -> None:
    """Drop the record of a batch that has been written after all."""
    SharedFiles(spark, checkpoint).remove(f"{checkpoint}/{SKIPPED}/{batch.number}.json")


def _source_log(files: SharedFiles, folder: str, entry: int) -> list[dict]:
    """Files that a file source took in one step; some logs hold all steps so far."""
    name = f"{folder}/{entry}"
    text = files.read(name if files.exists(name) else f"{name}.compact")
    found = [json.loads(line) for line in text.splitlines()[1:] if line]
    return [f for f in found if f.get("batchId", entry) == entry]


def file_batch(spark: SparkSession, batch: SkippedBatch, source: int = 0, format: str = "text") -> DataFrame:
    """Messages of a skipped batch of a file stream: the files it took, read again."""
    files = SharedFiles(spark, batch.checkpoint)
    first = json.loads(batch.start[source])["logOffset"] + 1 if batch.start[source] else 0
    last = json.loads(batch.end[source])["logOffset"]
    folder = f"{batch.checkpoint}/sources/{source}"
    paths = [f["path"] for entry in range(first, last + 1) for f in _source_log(files, folder, entry)]
    return spark.read.format(format).load(paths)


def kafka_options_of(spark: SparkSession, batch: SkippedBatch, options: Mapping[str, str], source: int = 0) -> dict[str, str]:
    """Options of a batch read of just the records of a skipped batch."""
    start = batch.start[source]
    if start is None:  # where the stream began is in the log of its source
        text = SharedFiles(spark, batch.checkpoint).read(f"{batch.checkpoint}/sources/{source}/0")
        start = text[text.index("{") :].strip()
    dropped = {"startingoffsets", "maxoffsetspertrigger", "minoffsetspertrigger", "maxtriggerdelay"}
    kept = {k: v for k, v in options.items() if k.lower() not in dropped}
    return kept | {"startingOffsets": start, "endingOffsets": batch.end[source]}


def kafka_batch(spark: SparkSession, batch: SkippedBatch, options: Mapping[str, str], source: int = 0) -> DataFrame:
    """Messages of a skipped batch of a Kafka stream, if the broker still has them."""
    reader = spark.read.format("kafka").options(**kafka_options_of(spark, batch, options, source))
    return record_messages(reader.load(), keep=("timestamp",))
