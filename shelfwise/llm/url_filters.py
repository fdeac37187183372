"""URL filters: captures joined with dated list entries as of their fetch date.

A list is a log of dated events: an entry (host, path prefix or whole URL) is added or removed on
a day. ``intervals`` turns the log into validity intervals [from, to); ``match`` finds the entries
that were valid when a capture was fetched; ``verdicts`` folds them: a capture is blocked if a
``block`` entry matches and no ``allow`` entry does.

Entries are keys: ``host:example.org`` (also all hosts below), ``path:example.org/a/b`` (any number of
segments, also everything below; a URL is asked for at the depths that occur in the lists) and ``url:example.org/a/b/c/d`` (that path, any query).

The join is on (key, month): an interval is written once for each month it covers within the
captures' time, so a host with a third of all captures is split by month, and what is left of the
skew is split by adaptive execution.

Nulls: captures with a null or unparsable URL, or no date, match nothing and are kept. Events with
a null field are ignored. Several events of an entry on one day: an addition wins. Repeated
captures are judged one by one. Empty lists: nothing matches. Extra columns are ignored, except
that ``verdicts`` returns all columns of the captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored

#: Depths of the path keys of a URL when no list says which ones occur.
PATH_SEGMENTS = 3
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
FOREVER = "9999-12-31"


def url_keys(url: Column, depths: Column | None = None) -> Column:
    """All keys under which a list may hold the URL: its host and those above, its leading path
    segments (as many as each of ``depths`` says, by default up to PATH_SEGMENTS), its whole path."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))
    path = F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    depths = F.sequence(F.lit(1), F.lit(PATH_SEGMENTS)) if depths is None else depths
    paths = F.transform(F.filter(depths, lambda i: i <= F.size(segments)), lambda i: F.concat(
        F.lit("path:"), host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))
    whole = F.array(F.concat(F.lit("url:"), host, F.lit("/"), F.array_join(segments, "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(hosts, paths, whole)))


def intervals(events: DataFrame) -> DataFrame:
    """(list, effect, key, valid_from, valid_to) from events (list, effect, key, action, day)."""
    days = (events.select("list", "effect", "key", "action", F.col("day").cast("date").alias("day")).dropna()
            .groupBy("list", "effect", "key", "day").agg(F.max(F.col("action") == "add").alias("on")))
    w = Window.partitionBy("list", "effect", "key").orderBy("day")  # one row a day and entry at most
    return (days.withColumn("valid_to", F.coalesce(F.lead("day").over(w), F.lit(FOREVER).cast("date"))).where("on")
            .select("list", "effect", "key", F.col("day").alias("valid_from"), "valid_to"))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def match(captures: DataFrame, valid: DataFrame, url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """(capture, list, effect, key): entries valid at the fetch date of each row of ``captures``,
    which needs a unique ``capture`` column."""
    seen = captures.select("capture", F.col(f"`{url_col}`").alias("url"), F.col(f"`{day_col}`").cast("date").alias("on")).where("url is not null and on is not null")
    span = seen.agg(F.min("on").alias("low"), F.max("on").alias("high"))
    valid = stored(valid.select("list", "effect", "key", "valid_from", "valid_to"), "intervals")
    # one row, with as many numbers as the deepest entry has segments at most
    depths = valid.where(F.col("key").startswith("path:")).agg(F.collect_set(F.length("key") - F.length(F.translate("key", "/", ""))).alias("depths"))
    asked = seen.join(F.broadcast(depths)).select("capture", "on", _month(F.col("on")).alias("month"), F.explode(url_keys(F.col("url"), F.col("depths"))).alias("key"))
    by_month = (valid.join(F.broadcast(span)).where("valid_from <= high and valid_to > low")  # one row
                .select("list", "effect", "key", "valid_from", "valid_to", F.explode(F.sequence(
                    _month(F.greatest("valid_from", "low")), _month(F.least("valid_to", "high")))).alias("month")))
    return (asked.join(by_month, ["key", "month"]).where("valid_from <= on and on < valid_to")
            .select("capture", "list", "effect", "key"))


def verdicts(captures: DataFrame, valid: DataFrame, url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """``captures`` with n_block, n_allow, first_entry (smallest matching block key) and blocked."""
    folded = match(captures, valid, url_col, day_col).groupBy("capture").agg(
        F.count(F.when(F.col("effect") == "block", 1)).alias("n_block"), F.count(F.when(F.col("effect") == "allow", 1)).alias("n_allow"),
        F.min(F.when(F.col("effect") == "block", F.col("key"))).alias("first_entry"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (captures.join(folded, "capture", "left")
            .select(*(F.col(f"`{c}`") for c in captures.columns), zero("n_block"), zero("n_allow"), "first_entry")
            .withColumn("blocked", (F.col("n_block") > 0) & (F.col("n_allow") == 0)))
