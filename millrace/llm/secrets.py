"""Secret scans by patterns and character Markov models."""

from __future__ import annotations

import json
import math
from collections import Counter
from string import ascii_letters, ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Patterns of the base kinds, the group whose length counts, and its least length.
KINDS = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # runs, of which shorter ones would be dropped
}
#: What must occur in a text for a kind's pattern to match.
HINTS = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{16}"}
#: The kind that the models add, and the strings they judge.
MODEL_KIND, CANDIDATE = "markov", r"[A-Za-z0-9+/_=-]{16,}"
#: Characters of the models: the codes from + to z, which hold all of a candidate's.
FIRST, SYMBOLS = ord("+"), ord("z") - ord("+") + 1
#: Documents that training takes words from at most, those with the smallest hashes of their
#: ids, and these words; generated strings of each sort.
SAMPLE, SAMPLE_WORDS, GENERATED = 4000, 2000, 1500
#: Symbols of random strings, one list for each sort.
ALPHABETS = (
    ascii_letters + digits,
    ascii_letters + digits + "+/",
    ascii_letters + digits + "-_",
    ascii_lowercase + digits,
    ascii_uppercase + digits,
)
#: How times are written in names of files and records.
TIME_FORMS = (
    "yyyy-MM-dd'T'HH-mm-ss",
    "yyyyMMdd'T'HHmmss'Z'",
    "yyyy-MM-dd_HH-mm-ss",
    "yyyy/MM/dd/HHmmss",
    "yyyy-MM-dd'T'HH",
    "yyyyMMdd-HHmmss",
    "'backup'-yyyy-MM-dd-HH-mm",
    "ddMMMyyyy-HHmmss",
)
#: Words that identifiers and paths are made of.
COMMON = tuple(
    """account address admin api archive array backup batch buffer build cache client cluster code
    column config connection content controller count customer data database date default deploy
    detail device document domain driver email engine entry error event example export factory field
    file filter folder format function group handler header history image import index input instance
    item language layer level library list local log manager message method model module name network
    node number object option order output package page parser path payment policy process product
    project query queue record release report request resource response result role route schema
    search server service session setting source status storage stream string system table task
    template test thread time type update upload user value version view window worker""".split()
)
#: Added to every count of a symbol, and weight of symbol frequencies in those of transitions.
SMOOTHING, PRIOR = 0.5, 150.0
#: Least log-likelihood ratio, in nats: of a whole string, and on average of a transition.
LEAST_TOTAL, LEAST_MEAN = 18.0, 0.85
#: Characters of a text that are scanned at a time, first and second cut. Cuts are where no pattern
#: can go on: after a character that none holds, after a colon that follows no keyword, or at a
#: space before a letter or digit that follows no sign or space.
SIZES = (1 << 20, 1 << 13)
_CUT = (
    r"""(?:[^A-Za-z0-9+/_.=\-"'\x20:]|[^\x20:=]\x20(?=[A-Za-z0-9])"""
    r"""|(?<=[A-Za-z0-9])(?<!(?i:password|passwd|secret|token|api_?key)):)"""
)
#: Matches whose lengths are added up one by one.
RUN = 256


def _running(steps: Column) -> Column:
    """Running sums of an array, by runs: the sums of whole runs, then those within a run."""
    add = lambda a, x: a + x
    summed = lambda x, start, n: F.aggregate(F.slice(x, start, n), F.lit(0), add)

    def of_runs(x: Column) -> Column:
        last = F.greatest(F.size(x) - 1, F.lit(0))
        runs = F.transform(F.sequence(F.lit(0), F.floor(last / RUN).cast("int")), lambda r: summed(x, r * RUN + 1, F.lit(RUN)))
        before = F.transform(F.array(runs), lambda t: F.transform(t, lambda _, i: summed(t, F.lit(1), i)))
        return F.get(F.transform(before, lambda t: F.transform(x, lambda _, i: within(x, t, i))), F.lit(0))

    def within(x: Column, before: Column, i: Column) -> Column:
        run = F.floor(i / RUN).cast("int")
        return F.get(before, run) + summed(x, run * RUN + 1, i - run * RUN + 1)

    return F.get(F.transform(F.array(steps), of_runs), F.lit(0))


def _matches(text: Column, kind: str) -> Column:
    """Start, end and string of each match of a base kind, and its secret part."""
    pattern, group, least = KINDS.get(kind, (CANDIDATE, 0, 16))
    found = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("strings"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("secrets"),
    )

    def places(m: Column) -> Column:
        # what stands before each match, and its own length
        steps = F.zip_with(m["gaps"], m["strings"], lambda gap, string: gap + F.length(string))
        ends = _running(F.slice(steps, F.lit(1), F.size(m["strings"])))

        def place(string: Column, i: Column, ends: Column) -> Column:
            end = F.get(ends, i)
            return F.struct(
                F.lit(kind).alias("kind"),
                (end - F.length(string)).cast("long").alias("start"),
                end.cast("long").alias("end"),
                F.get(m["secrets"], i).alias("secret"),
            )

        with_ends = F.transform(F.array(ends), lambda e: F.transform(m["strings"], lambda x, i: place(x, i, e)))
        return F.filter(F.get(with_ends, F.lit(0)), lambda s: F.length(s["secret"]) >= least)

    spans = F.get(F.transform(F.array(found), places), F.lit(0))
    hint = HINTS.get(kind, CANDIDATE)
    return F.when(text.rlike(hint), spans)


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, at, kind, start, end, secret): matches of all kinds, places within a
    piece that begins at ``at``; a row without kind for pieces without any."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    cut = rows.withColumn("at", F.lit(0).cast("long"))
    for size in SIZES:
        pieces = F.when(F.length("text") <= size, F.array("text")).otherwise(
            F.regexp_extract_all("text", F.lit(rf"(?s).{{{size}}}.*?{_CUT}|.+"), F.lit(0))
        )
        cut = cut.withColumn("pieces", pieces).withColumn("sizes", F.transform("pieces", F.length))
        cut = cut.select("row", "id", "at", "sizes", F.posexplode_outer("pieces").alias("n", "text"))
        before = F.aggregate(
            F.slice("sizes", F.lit(1), F.coalesce("n", F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x
        )
        cut = cut.select("row", "id", (F.col("at") + before).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    base = F.concat(*[F.coalesce(_matches(F.col("text"), k), F.array()) for k in KINDS])
    judged = F.coalesce(_matches(F.col("text"), MODEL_KIND), F.array())
    # A match lies in one piece, so overlaps do too. What the models judge is a whole run of their
    # symbols, which holds all of a hex or access span that it meets.
    meets = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])
    listed = "[0-9a-f]{16}|AKIA[A-Z0-9]{14}"
    clear = F.filter(
        F.filter("judged", lambda s: ~s["secret"].rlike(listed)),
        lambda s: ~F.exists(F.filter("base", lambda b: b["kind"] == "assign"), lambda b: meets(s, b)),
    )
    found = cut.select("row", "id", "at", base.alias("base"), judged.alias("judged")).select(
        "row", "id", "at", F.concat("base", clear).alias("found")
    )
    return found.select("row", "id", "at", F.explode_outer("found").alias("s")).select("row", "id", "at", "s.*")


def _transitions(strings: DataFrame) -> DataFrame:
    """(label, a, b, n): how often symbol b follows a in the strings of a label."""
    letters = F.filter(F.split("string", ""), lambda c: c.rlike("^[+-z]$"))
    codes = strings.select("label", F.transform(letters, lambda c: F.ascii(c) - FIRST).alias("codes"))
    pairs = F.arrays_zip(
        F.slice("codes", F.lit(1), F.greatest(F.size("codes") - 1, F.lit(0))).alias("a"),
        F.slice("codes", F.lit(2), F.greatest(F.size("codes") - 1, F.lit(0))).alias("b"),
    )
    return codes.select("label", F.explode_outer(pairs).alias("p")).where("p is not null").groupBy(
        "label", F.col("p.a").alias("a"), F.col("p.b").alias("b")
    ).agg(F.count("*").alias("n"))


def train(strings: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, from (string, label) with label 1 for
    random strings and 0 for ordinary identifiers.

    Each label's Markov model has probabilities of a symbol after another, smoothed
    by those of the symbol alone; the ratio of symbols a, b is entry ``a * SYMBOLS + b``. The table has
    at most two counts for each pair of symbols, so the driver reads it whole.
    """
    counts = {(r["label"], r["a"], r["b"]): r["n"] for r in _transitions(strings).collect()}
    before, after, every = Counter(), Counter(), Counter()
    for (label, a, b), n in counts.items():
        before[label, a] += n
        after[label, b] += n
        every[label] += n

    def log_chance(label: int, a: int, b: int) -> float:
        alone = (after[label, b] + SMOOTHING) / (every[label] + SMOOTHING * SYMBOLS)
        return math.log((counts.get((label, a, b), 0) + PRIOR * alone) / (before[label, a] + PRIOR))

    return [
        round(log_chance(1, a, b) - log_chance(0, a, b), 6) for a in range(SYMBOLS) for b in range(SYMBOLS)
    ]


def random_strings(spark: SparkSession, n: int = GENERATED) -> DataFrame:
    """``n`` random strings, as keys and tokens are written, from hashes of their numbers."""
    sort = F.get(F.array(*[F.lit(a) for a in ALPHABETS]), (F.col("id") % len(ALPHABETS)).cast("int"))
    size = 20 + F.pmod(F.xxhash64("id", F.lit(-1)), F.lit(25))
    place = lambda i: F.pmod(F.xxhash64("id", i), F.length("symbols").cast("long")) + 1
    letters = F.transform(F.sequence(F.lit(1), size.cast("int")), lambda i: F.substr("symbols", place(i).cast("int"), F.lit(1)))
    return spark.range(n).withColumn("symbols", sort).select(F.array_join(letters, "").alias("string"))


def _named(words: Column, number: Column) -> Column:
    """An identifier or path made of some words, in one of six ways, most with a number."""
    camel = F.transform(words, F.initcap)
    ways = [
        F.array_join(words, "_"),
        F.array_join(words, "-"),
        F.concat(F.get(words, F.lit(0)), F.array_join(F.slice(camel, 2, 3), "")),
        F.array_join(camel, ""),
        F.upper(F.array_join(words, "_")),
        F.array_join(words, "/"),
    ]
    ends = [F.lit(""), number, F.concat(F.lit("_"), number), F.concat(F.lit("-v"), number), F.concat(F.lit("/"), number)]
    pick = lambda of, salt: F.get(F.array(*of), F.pmod(F.xxhash64(number, F.lit(salt)), F.lit(len(of))).cast("int"))
    return F.concat(pick(ways, 1), pick(ends, 2))


def ordinary_strings(words: DataFrame, n: int = GENERATED) -> DataFrame:
    """Identifiers and paths of ``words`` (word) and of common ones, UUIDs and times, ``n`` of a sort, and the words."""
    ids = words.sparkSession.range(n)
    common = F.array(*[F.lit(word) for word in COMMON])
    hashed = lambda salt, size: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(size))
    number = F.pmod(F.xxhash64("id"), F.pow(F.lit(10), 1 + hashed(3, 6)).cast("long")).cast("string")
    some = F.slice(F.array(*[F.get(common, hashed(k, len(COMMON)).cast("int")) for k in range(4)]), F.lit(1), (2 + hashed(9, 3)).cast("int"))
    named = ids.select(_named(some, number).alias("string"))
    # words of the texts meet by hash, about three at a time
    groups = words.groupBy(F.pmod(F.xxhash64("word"), F.lit(max(n // 2, 1))).alias("id")).agg(
        F.slice(F.sort_array(F.collect_list("word")), 1, 4).alias("some")
    )
    own = groups.select(_named(F.col("some"), number).alias("string"))
    uuid = F.regexp_replace(F.md5(F.col("id").cast("string")), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    uuids = ids.select(F.when(F.col("id") % 3 == 0, F.upper(uuid)).otherwise(uuid).alias("string"))
    at = F.timestamp_seconds(946684800 + hashed(5, 1_000_000_000))
    forms = [F.when(F.col("id") % len(TIME_FORMS) == k, F.date_format(at, form)) for k, form in enumerate(TIME_FORMS)]
    times = ids.select(F.coalesce(*forms).alias("string"))
    every = words.select(F.col("word").alias("string"))
    for part in (named, own, uuids, times):
        every = every.unionByName(part)
    return every


def labelled_strings(docs: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE) -> DataFrame:
    """(string, label): random strings, and ordinary ones made in part of words of the texts.

    The words are those of 4 to 15 letters, digits and signs in at most ``sample`` documents; longer ones,
    which the models judge, are never taken for ordinary, so that secrets in the
    texts do not unlearn what a secret looks like.
    """
    ids = docs.select(F.col(id_col).alias("chosen")).where("chosen is not null").distinct()
    ids = ids.orderBy(F.xxhash64("chosen"), "chosen").limit(sample)
    # at most so many ids
    chosen = docs.join(F.broadcast(ids), docs[id_col] == ids["chosen"]).select(F.col(text_col).cast("string").alias("text"))
    parts = F.split(F.coalesce("text", F.lit("")), r"[^A-Za-z0-9+/_=-]+")
    words = chosen.select(F.explode_outer(parts).alias("word")).where(F.length("word").between(4, 15)).distinct()
    words = written(words.orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS), "words")
    spark = docs.sparkSession
    return (
        random_strings(spark, len(ALPHABETS) * GENERATED // 2).withColumn("label", F.lit(1))
        .unionByName(ordinary_strings(words).withColumn("label", F.lit(0)))
    )


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: DataFrame | None = None,
    least_total: float = LEAST_TOTAL,
    least_mean: float = LEAST_MEAN,
) -> DataFrame:
    """``doc_id, found`` for every row of ``docs``: all spans, sorted by start.

    ``found`` is an array of (start, rank, end, kind), places in code points, end
    exclusive. Base kinds are matches of fixed patterns, leftmost and not
    overlapping within a kind. Beside them, strings of 16 or more letters, digits
    and signs are judged by two character Markov models, one of random strings
    and one of ordinary identifiers: a string is a secret if its log-likelihood
    ratio reaches ``least_total``, and ``least_mean`` for each transition, it has a
    letter and a digit, and it overlaps no base span. The models are trained from ``labelled`` (string,
    label), or else from random strings and ordinary ones that ``labelled_strings`` makes; secrets in
    the texts have no part in it.

    Texts are scanned in pieces cut where no pattern can go on, in time linear in them, and only
    spans move between tasks. Null text counts as empty and has an empty array; repeated rows and
    null ids are scanned like others; an empty table gives no rows; other
    columns are not read.
    """
    labelled = labelled_strings(docs, id_col, text_col) if labelled is None else labelled
    ratios = F.from_json(F.lit(json.dumps(train(labelled))), "array<double>")
    found = _scanned(docs, id_col, text_col)
    codes = F.transform(F.split("secret", ""), lambda c: F.ascii(c) - FIRST)
    found = found.withColumn("codes", F.when(F.col("kind") == MODEL_KIND, codes)).withColumn(
        "steps",
        F.zip_with(
            F.slice("codes", F.lit(1), F.size("codes") - 1),
            F.slice("codes", F.lit(2), F.size("codes") - 1),
            lambda a, b: (a * SYMBOLS + b).cast("int"),
        ),
    )
    total = F.aggregate("steps", F.lit(0.0), lambda sum, i: sum + F.get(ratios, i))
    random = (total >= least_total) & (total >= least_mean * F.size("steps"))
    rank = sum((F.when(F.col("kind") == k, i) .otherwise(0) for i, k in enumerate((*KINDS, MODEL_KIND))), F.lit(0))
    span = F.struct(
        (F.col("at") + F.col("start")).alias("start"), rank.alias("rank"), (F.col("at") + F.col("end")).alias("end"), "kind"
    )
    mixed = F.col("secret").rlike("[0-9]") & F.col("secret").rlike("[A-Za-z]")
    keep = (F.col("kind") != MODEL_KIND) | (random & mixed)
    spans = found.select("row", "id", F.when(keep, span).alias("span"))
    grouped = spans.groupBy("row", "id").agg(F.sort_array(F.collect_list("span")).alias("found"))
    return grouped.select(F.col("id").alias("doc_id"), "found")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
