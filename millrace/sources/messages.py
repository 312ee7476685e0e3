"""Message sources, batch or streaming. All give a STRING column ``value``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    brokers: str,
    topic: str,
    group_id: str | None = None,
    security: str = "PLAINTEXT",
    sasl_mechanism: str | None = None,
    kerberos_service: str = "kafka",
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic.

    Offsets live in the query's checkpoint, never in the consumer group.
    ``min_partitions`` reads a broker partition with several tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.security.protocol": security,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if sasl_mechanism is not None:
        options["kafka.sasl.mechanism"] = sasl_mechanism
        options["kafka.sasl.kerberos.service.name"] = kerberos_service
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(
    spark: SparkSession, options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Messages of a Kafka topic, with the broker's ``timestamp``.

    Needs Spark's Kafka package on the classpath.
    """
    reader = spark.readStream if stream else spark.read
    return record_messages(reader.format("kafka").options(**options).load(), keep=("timestamp",))


def record_messages(
    records: DataFrame, keep: Sequence[str] = (), tombstones: str = "drop"
) -> DataFrame:
    """Messages of broker records (``key, value, topic, partition, offset, timestamp``, ...).

    ``value`` is the record's value as text; ``keep`` names columns to pass on, of which ``key``
    becomes text and ``headers`` a map of texts, the last of a repeated header winning. A record without a value says that its key
    is gone and is no message: ``"drop"`` leaves it out, ``"keep"`` gives it as a null message. A
    value of no bytes is a blank message. Bytes that are no UTF-8 become replacement characters.
    """
    if tombstones not in ("drop", "keep"):
        raise ValueError(f"tombstones must be drop or keep, not {tombstones!r}")
    if tombstones == "drop":
        records = records.where(F.col("value").isNotNull())
    pair = lambda h: F.struct(h["key"], _text(h["value"]))
    last = lambda h, i: ~F.exists(F.slice("headers", i + 2, F.size("headers")), lambda x: x["key"] == h["key"])
    shown = {
        "key": _text(F.col("key")),
        "headers": F.map_from_entries(F.transform(F.filter("headers", last), pair)),
    }
    return records.select(
        _text(F.col("value")).alias("value"),
        *[(shown[c] if c in shown else F.col(c)).alias(c) for c in keep],
    )


def _text(data: Column) -> Column:
    """Bytes as text, with replacement characters for what is no UTF-8."""
    return F.make_valid_utf8(data.cast("string"))


def text_messages(
    spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """One message per line of the text files under a path."""
    if not stream:
        return spark.read.text(path).select("value")
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select("value")


def text_values(
    df: DataFrame, column: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Messages held in a string or binary column of any DataFrame."""
    return df.select(F.col(column).cast("string").alias("value"), *keep)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows out over ``partitions``, by default one per core.

    Parsing is bound by cores, so a backlog that arrives in a handful of files or
    broker partitions is worth one exchange of the raw text. Batch only: a stream from Kafka takes
    ``minPartitions`` instead.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
