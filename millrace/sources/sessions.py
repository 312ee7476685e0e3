"""Work under other settings than those of the caller's session.

A setting holds for all threads of a session, so the caller's are never changed.
What needs another value is analysed or run in a second session on the same
context. Frames go there and back as global temporary views, which all sessions
of a context share; the views live only while a frame is carried over.
"""

from __future__ import annotations

import threading
import uuid
from collections import OrderedDict
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: Settings of the caller that bear on analysis and reading, carried over each time.
CARRIED = (
    "spark.sql.session.timeZone",
    "spark.sql.caseSensitive",
    "spark.sql.timestampType",
    "spark.sql.legacy.timeParserPolicy",
    "spark.sql.columnNameOfCorruptRecord",
    "spark.sql.shuffle.partitions",
)
_KEPT = 16
_LOCK = threading.RLock()
_SESSIONS: OrderedDict[tuple, SparkSession] = OrderedDict()


def _prepared(own: SparkSession, spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    for key in CARRIED:
        value = spark.conf.get(key)
        if own.conf.get(key) != value:
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def _carried(df: DataFrame, session: SparkSession) -> DataFrame:
    """The same frame in another session of its context."""
    name = f"global_temp.carried_{uuid.uuid4().hex}"
    df.createGlobalTempView(name.partition(".")[2])
    try:
        return session.table(name)
    finally:
        # not the catalog's method, which gives up what is persisted of the frame
        session.sql(f"DROP VIEW {name}")


def sql_over(df: DataFrame, text: str, name: str) -> DataFrame:
    """A SELECT over a frame that the text names as ``{name}``; the frame stays persisted."""
    view = f"selected_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        return df.sparkSession.sql(text.format(**{name: view}))
    finally:
        df.sparkSession.sql(f"DROP VIEW {view}")


def _own(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """The second session of a session for these settings; it is made once."""
    key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), *sorted(settings.items()))
    own = _SESSIONS.pop(key, None) or spark.newSession()
    _SESSIONS[key] = own
    while len(_SESSIONS) > _KEPT:
        _SESSIONS.popitem(last=False)
    return _prepared(own, spark, settings)


def analysed_with(
    df: DataFrame, settings: Mapping[str, str], build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What ``build`` makes of ``df``, analysed with ``settings``, in the session of ``df``.

    Only building frames belongs in ``build``, no action. Expressions keep the
    meaning they got there; whatever is added to the result later has that of
    the caller's session.
    """
    spark = df.sparkSession
    with _LOCK:
        return _carried(build(_carried(df, _own(spark, settings))), spark)


def run_with(df: DataFrame, settings: Mapping[str, str]) -> DataFrame:
    """``df`` in a session with ``settings``, for actions."""
    with _LOCK:
        return _carried(df, _own(df.sparkSession, settings))
