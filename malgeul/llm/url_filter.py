"""URL filter lists as temporal joins: dated entries become validity intervals, and every capture is
evaluated against the entries that were active when it was fetched.

An entry's pattern is a host, which covers its subdomains, or a host and the first segments of a
path (``example.org/blog/old``), which covers what lies below on that host.  Of the patterns that cover a URL the longest path is the most specific one, then
shorter paths, the host, and its parent domains upwards; addresses of machines have no parents.  All steps are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from malgeul.llm.common import require

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
#: An IPv6 host in brackets, or an IPv4 host.
ADDRESS = r"^\[|^[0-9.]+$"


def host_of(url: Column) -> Column:
    """The host of an absolute URL, lower-cased, without user, port and final dots; '' where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _SCHEME + r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)", 1)), r"\.+$", "")


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def path_of(url: Column) -> Column:
    """The segments of the path that aren't empty."""
    return _segments(F.regexp_extract(url, _SCHEME + r"[^/?#]*([^?#]*)", 1))


def patterns_of(url: Column) -> Column:
    """The patterns that cover a URL, the most specific first: host with ever fewer segments of the path, host, parent domains."""
    host, none = host_of(url), F.array().cast("array<string>")

    def below(parts: Column) -> Column:
        n = F.size(parts)
        return F.when(n > 0, F.transform(F.sequence(n, F.lit(1), F.lit(-1)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(none)

    def upwards(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))

    # let-bound, so that a URL is split once and not once for each pattern
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    domains = F.when(host.rlike(ADDRESS), F.array(host)).otherwise(let(F.split(host, r"\."), upwards))
    return F.when(host != "", F.concat(let(path_of(url), below), domains)).otherwise(none)


def canonical_pattern(pattern: Column) -> Column:
    """A pattern as ``patterns_of`` has it: hosts have no case, paths do; empty segments don't count."""
    host, path = F.lower(F.regexp_extract(pattern, "^[^/]*", 0)), _segments(F.regexp_extract(pattern, "(?s)/.*", 0))
    return F.when(pattern.isNotNull(), F.array_join(F.concat(F.array(F.regexp_replace(host, r"\.+$", "")), path), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, since, until`` of the times when ``entries(pattern, dated, action, category)`` list a
    pattern under a category: from an ``add`` up to its next entry (null: still listed).

    A ``remove`` with a category ends that one, one without ends all that the pattern has.  Of entries with one date ``add`` holds.  Entries without a pattern or
    date and with another action are ignored, as are repeated ones; a null category of an ``add`` is a category."""
    require(entries, "pattern", "dated", "action", "category")
    known = entries.select(canonical_pattern(F.col("pattern")).alias("pattern"), "dated", "action", "category").filter("pattern is not null and dated is not null and action in ('add', 'remove')")
    of_pattern = known.filter("action = 'add'").select("pattern", "category").distinct()
    general = known.filter("action = 'remove' and category is null").select("pattern", "dated", "action").distinct().join(of_pattern, "pattern")
    each = known.filter("action = 'add' or category is not null").unionByName(general)
    daily = each.groupBy("pattern", "category", "dated").agg(F.bool_or(F.col("action") == "add").alias("listed"))
    after = Window.partitionBy("pattern", "category").orderBy("dated")
    return daily.withColumn("until", F.lead("dated").over(after)).filter("listed").select("pattern", "category", F.col("dated").alias("since"), "until")


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """Each row of ``captures(key, url, fetched)`` with ``blocked`` and the most specific entry active at ``fetched``, of several
    categories the one that sorts first: ``pattern, category, since``.

    Equal captures are looked up once and come back as often as they were given.  A capture without URL,
    host or time is not blocked; other columns are ignored; either table may be empty.
    """
    require(captures, key, "url", "fetched")
    distinct = captures.groupBy(key, "url", "fetched").agg(F.count("*").cast("int").alias("times"))
    looked = distinct.select(key, "url", "fetched", "times", F.posexplode_outer(patterns_of(F.col("url"))).alias("rank", "looked"))
    listed = intervals(entries)
    active = (F.col("looked") == F.col("pattern")) & (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    # a hot host makes the capture side skewed, which adaptive execution splits; a pattern has few intervals
    met = looked.join(listed, active, "left")
    best = F.min(F.when(F.col("pattern").isNotNull(), F.struct("rank", "pattern", "category", "since"))).alias("best")
    told = met.groupBy(key, "url", "fetched", "times").agg(best)
    rows = told.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return rows.select(key, "url", "fetched", F.col("best").isNotNull().alias("blocked"), "best.pattern", "best.category", "best.since")
