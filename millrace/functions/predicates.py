"""Route predicates as held in the registry.

Three text forms are accepted:

* ``SELECT * FROM DataIN WHERE <condition>``, which becomes a filter column;
* ``path&value[&path&value...]``, equality per pair, all pairs AND-ed;
* a bare condition.

Any other ``SELECT`` over ``DataIN`` runs as Spark SQL over the messages.
The condition itself is parsed by Spark; here only ``path[i]`` is rewritten to
``get(path, i)``, because plain indexing raises past the end in ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import MESSAGE_VIEW
from millrace.functions.paths import has_path, parse_path, path_column, quote
from millrace.sources.sessions import analysed_with

_NAME = r"(?:`(?:[^`]|``)+`|[^\W\d]\w*)"
_PATH = rf"{_NAME}(?:\[\d+\])*(?:\.{_NAME}(?:\[\d+\])*)*"
_QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\""
_TOKEN = re.compile(rf"(?P<quoted>{_QUOTED})|(?P<path>(?<![\w.`])({_PATH}))(?P<call>\s*\()?", re.S)
_SELECT_ALL = re.compile(
    rf"^\s*SELECT\s+\*\s+FROM\s+{MESSAGE_VIEW}(?:\s+WHERE\s+(?P<condition>.*?))?\s*;?\s*$", re.I | re.S
)
_MORE_THAN_CONDITION = re.compile(
    r"\b(SELECT|ORDER|GROUP|HAVING|LIMIT|OFFSET|UNION|INTERSECT|EXCEPT|MINUS|WINDOW|SORT|CLUSTER"
    r"|DISTRIBUTE|LATERAL)\b",
    re.I,
)
_VIEW_NAME = re.compile(rf"^`?{MESSAGE_VIEW}`?", re.I)
_VIEW_PREFIX = re.compile(rf"^`?{MESSAGE_VIEW}`?\.", re.I)
_SELECT = re.compile(r"^\s*(?:SELECT|WITH)\b", re.I)
_EQUALITY = re.compile(rf"^\s*(?P<path>{_PATH})\s*=\s*'(?P<text>[^'\\]*)'\s*$")
_PAIR_PATH = re.compile(r"^[^\s&=<>()']+$")

# Words of a condition that are never field names.
_KEYWORDS = frozenset(
    "and or not is null in like rlike ilike between true false case when then else end "
    "select from where with as exists escape distinct on join".split()
)


def pair_form(text: str) -> list[tuple[str, str]] | None:
    """Pairs of a ``path&value`` predicate, or ``None`` if it is not one."""
    parts = text.split("&")
    if _SELECT.match(text) or len(parts) < 2:
        return None
    if len(parts) % 2:
        if _PAIR_PATH.match(parts[0]) and _PAIR_PATH.match(parts[2]) and "." in parts[0]:
            raise ValueError(f"path&value pairs with an odd number of parts: {text!r}")
        return None
    pairs = list(zip(parts[0::2], parts[1::2]))
    return pairs if all(_PAIR_PATH.match(path) for path, _ in pairs) else None


def condition_text(text: str) -> str | None:
    """Filter condition of a predicate; ``None`` when it needs a full ``SELECT``."""
    found = _SELECT_ALL.match(text)
    if found is None:
        return None if _SELECT.match(text) else safe_positions(text)
    condition = found["condition"] or "true"
    if _MORE_THAN_CONDITION.search(re.sub(_QUOTED, "''", condition, flags=re.S)):
        return None
    return safe_positions(condition)


def safe_positions(text: str) -> str:
    """Rewrite ``path[i]`` to ``get(path, i)`` outside quoted text."""

    def rewrite(token: re.Match) -> str:
        if token["path"] is None or "[" not in token["path"]:
            return token[0]
        sql = ""
        for step in parse_path(token["path"]):
            sql = f"{sql}.{quote(step.name)}" if sql else quote(step.name)
            for position in step.positions:
                sql = f"get({sql}, {position})"
        return sql + (token["call"] or "")

    return _TOKEN.sub(rewrite, text)


def select_text(text: str) -> str:
    """A full ``SELECT`` with ``{DataIN}`` for the messages, as ``spark.sql`` takes it."""

    def rewrite(token: re.Match) -> str:
        path = token["path"]
        if path is None or parse_path(path)[0].name.lower() != MESSAGE_VIEW.lower():
            return token[0]
        return f"{{{MESSAGE_VIEW}}}" + _VIEW_NAME.sub("", path) + (token["call"] or "")

    escaped = safe_positions(text).replace("{", "{{").replace("}", "}}")
    return _TOKEN.sub(rewrite, escaped)


def predicate_paths(text: str, keywords: bool = False) -> list[str]:
    """Field paths a predicate may mention, in order, without repeats.

    ``keywords`` keeps SQL words too, which could be field names.
    """
    pairs = pair_form(text)
    if pairs is not None:
        return list(dict.fromkeys(path for path, _ in pairs))
    found = _SELECT_ALL.match(text)
    paths = []
    for token in _TOKEN.finditer(found["condition"] or "" if found else text):
        path = _VIEW_PREFIX.sub("", token["path"] or "")
        if path and not token["call"] and (keywords or path.lower() not in _KEYWORDS):
            paths.append(path)
    return list(dict.fromkeys(paths))


def pair_column(pairs: list[tuple[str, str]], schema: T.StructType) -> Column:
    """Equality per pair, AND-ed. A path the schema lacks matches nothing."""
    matched = F.lit(True)
    for path, value in pairs:
        if has_path(schema, path):
            matched = matched & (path_column(path).cast("string") == F.lit(value))
        else:
            matched = matched & F.lit(False)
    return matched


def predicate_column(text: str, schema: T.StructType) -> Column | None:
    """Filter column of a predicate; ``None`` when it needs a full ``SELECT``."""
    pairs = pair_form(text)
    if pairs is not None:
        return pair_column(pairs, schema)
    condition = condition_text(text)
    return None if condition is None else F.expr(condition)


def leniently(df: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``build`` makes of ``df``, analysed with ANSI mode off.

    So a comparison with unreadable text is null for that message instead of an
    error for the whole batch. The mode of the caller's session never changes.
    """
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") == "false":
        return build(df)
    return analysed_with(df, {"spark.sql.ansi.enabled": "false"}, build)


def equality(condition: str) -> tuple[str, str] | None:
    """Path and text of a condition that is a plain ``path = 'text'``."""
    found = _EQUALITY.match(condition)
    return (_VIEW_PREFIX.sub("", found["path"]), found["text"]) if found else None
