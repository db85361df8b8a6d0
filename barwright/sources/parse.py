"""Parsers of text payloads held in table columns: vendor daily-series JSON (S10), a
constituent table in an HTML page (S11), test-run summaries (S13) and error mentions
in logs (A15).  All are built-in string / JSON functions, run per row on executors."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vendor payload's series key and its field names.
SERIES_KEY = "Time Series (Daily)"
VENDOR_FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]

_DAY = T.StructType([T.StructField(f, T.StringType()) for f in VENDOR_FIELDS])
_PAYLOAD = T.StructType([T.StructField(SERIES_KEY, T.MapType(T.StringType(), _DAY)),
                         T.StructField("Note", T.StringType()),
                         T.StructField("Error Message", T.StringType())])


def vendor_series(df: DataFrame, payload: str = "payload", ticker: str = "ticker",
                  days: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Vendor JSON ``{"Time Series (Daily)": {date: {"1. open": ...}}}`` -> bar rows.

    Returns (bars, errors): a payload without the series (a ``Note`` / ``Error Message``
    reply) gives zero bars and an error row with the reason.  ``days`` keeps the last n
    days of each payload, whatever other payloads the ticker has.
    """
    p = df.select(F.col(ticker).alias("ticker"), F.from_json(F.col(payload), _PAYLOAD).alias("p"))
    series = F.col("p").getField(SERIES_KEY)
    errors = p.filter(series.isNull()).select(
        "ticker", F.coalesce(F.col("p.Note"), F.col("p.`Error Message`"), F.lit("no series")).alias("error"))
    found = F.map_entries(series)
    if days is not None:  # the newest days of the payload, by their text (ISO dates)
        found = F.slice(F.reverse(F.array_sort(F.transform(found, lambda e: F.struct(e["key"], e["value"])))), 1, days)
    rows = p.filter(series.isNotNull()).select("ticker", F.explode(found).alias("e")).select("ticker", F.col("e.key").alias("d"),
                                                                                            F.col("e.value").alias("v"))
    bars = rows.select("ticker", F.to_timestamp_ntz(F.col("d")).alias("date"),
                       *[F.col("v").getField(f).cast("double").alias(f.split(". ")[1]) for f in VENDOR_FIELDS[:4]],
                       F.col("v").getField(VENDOR_FIELDS[4]).cast("double").cast("bigint").alias("volume"))
    return bars, errors


def _strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), "&amp;", "&"))


def html_constituents(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """First ``<table class="...wikitable...">`` of each page -> (url, pos, symbol, company).

    The first row is the header and is skipped; a row needs >= 2 cells with both the
    first and second non-empty.  Regular table markup only.
    """
    table = F.regexp_extract(F.col(html), r'(?is)<table[^>]*class="[^"]*wikitable[^"]*"[^>]*>(.*?)</table>', 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    r = pages.select(F.col(url).alias("url"), F.posexplode(rows).alias("pos", "row")).filter(F.col("pos") > 0)
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1)
    c = r.select("url", "pos", cells.alias("cells")).filter(F.size("cells") >= 2)
    out = c.select("url", "pos", _strip_tags(F.col("cells")[0]).alias("symbol"),
                   _strip_tags(F.col("cells")[1]).alias("company"))
    return out.filter((F.length("symbol") > 0) & (F.length("company") > 0))


def parse_test_summary(logs: DataFrame, text: str = "value", order: str | None = None) -> DataFrame:
    """Counts from bare summary texts (no session heading): passed / failed / skipped and failed
    test names; when several are given the last by ``order`` wins.  Logs go by ``test_results``."""
    t = F.col(text)
    num = lambda word: F.coalesce(F.regexp_extract(t, rf"(\d+) {word}", 1).try_cast("long"), F.lit(0))
    p = logs.select(*( [F.col(order)] if order else []),
                    num("passed").alias("passed"), num("failed").alias("failed"),
                    num("skipped").alias("skipped"),
                    F.array_distinct(F.regexp_extract_all(t, F.lit(r"FAILED ([^\s]+)"), 1)).alias("failed_tests"))
    if order:
        p = p.agg(F.max_by(F.struct("passed", "failed", "skipped", "failed_tests"), F.col(order)).alias("s")).select("s.*")
    return p


#: a test session's block in a log: its heading, and the text up to the next heading
SESSION = r"(?s)=+ [^\n]*?test session[^\n]*? in [^\n]*? =+\n(.*?)(?=\n=|\z)"


def test_results(logs: DataFrame, text: str = "value", order: str = "order", modified: str = "modified") -> DataFrame:
    """Result of the last test run from whole log texts (S13, F12), one row: passed, failed, skipped,
    total_tests, failed_tests, last_run.

    Of each log the first session block counts; a log without one changes nothing.  A count that
    a block does not name keeps the value of the logs before it, in the order of ``order``; the
    failed tests and the time are those of the last log with a block."""
    body = F.when(F.regexp_like(text, F.lit(SESSION)), F.regexp_extract(text, SESSION, 1))
    number = lambda word: F.regexp_extract("_b", rf"(\d+) {word}", 1).try_cast("long")
    p = logs.select(F.col(order).alias("_o"), F.col(modified).alias("_m"), body.alias("_b")).where("_b IS NOT NULL").select(
        "_o", "_m", *[number(w).alias(w) for w in ("passed", "failed", "skipped")],
        F.regexp_extract_all("_b", F.lit(r"tests/[^\n]*?\.py::(\S+)"), 1).alias("names"))
    last = lambda c: F.coalesce(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_o"))), F.lit(0))
    return p.agg(*[last(c).alias(c) for c in ("passed", "failed", "skipped")],
                 F.coalesce(F.max_by("names", "_o"), F.array().cast("array<string>")).alias("failed_tests"),
                 F.max_by("_m", "_o").alias("last_run")).withColumn("total_tests", F.col("passed") + F.col("failed") + F.col("skipped"))


#: ends a log in a file that holds many (ASCII record separator), and the line that names its run
LOG_END = "\x1e"
LOG_HEAD = r"\Arun ([^\n]*)\n"


def write_logs(logs: DataFrame, root: str, text: str = "value", run: str = "run") -> None:
    """Whole log texts, many to a file: each begins with a line that names its run and ends in
    ``LOG_END``.  The files are as many as the partitions of ``logs``, not as the runs, so neither
    writing nor listing grows with the number of logs.  No text may hold ``LOG_END``."""
    head = F.concat(F.lit("run "), F.coalesce(F.col(run), F.lit("")), F.lit("\n"))
    body = F.when(F.contains(F.col(text), F.lit(LOG_END)), F.raise_error(F.lit("a log holds its own end mark"))).otherwise(F.col(text))
    logs.select(F.concat(head, F.coalesce(body, F.lit(""))).alias("value")).write.option("lineSep", LOG_END).text(root)


def read_logs(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """Logs of ``write_logs``, one row each: value, path, modified, and ``order``, the run it names."""
    logs = log_files(spark, root, pattern=pattern, end=LOG_END)
    return logs.withColumn("order", F.regexp_extract("value", LOG_HEAD, 1)).withColumn("value", F.regexp_replace("value", LOG_HEAD, ""))


def log_files(spark: SparkSession, root: str, as_of: str | None = None, hours: int = 24, pattern: str = "*.log",
              whole: bool = False, end: str | None = None) -> DataFrame:
    """Lines (or whole texts, or the texts that ``end`` ends) of the log files under ``root`` with
    their path and time.  ``as_of``: only files changed in the ``hours`` before it, chosen while
    listing, so others are not read."""
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if end is not None:
        r = r.option("lineSep", end)
    if as_of is not None:
        since = datetime.datetime.fromisoformat(as_of) - datetime.timedelta(hours=hours)
        r = r.option("timeZone", "UTC").option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    return r.text(root, wholetext=whole).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"))


def recent_errors(spark: SparkSession, root: str, as_of: str, hours: int = 24, pattern: str = "*.log") -> DataFrame:
    """Mentions of 'error' per log file of the last ``hours``."""
    lines = log_files(spark, root, as_of, hours, pattern)
    return lines.groupBy("path").agg(F.sum(error_mentions(lines, "value")).cast("long").alias("errors"))


def error_mentions(df: DataFrame, text: str = "text", word: str = "error") -> Column:
    """Case-insensitive occurrences of ``word`` in a text column."""
    low = F.lower(F.col(text))
    return ((F.length(low) - F.length(F.replace(low, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("long")
