"""URL filters from dated lists: a temporal join. Native: DataFrame functions only.

A list entry (scope, pattern, action, listed) says that from then on a pattern is blocked, allowed, or no
longer listed ("remove"). Entries of one pattern become disjoint validity intervals; of entries at the
same instant the strictest counts. A capture (url, fetched) is tried with every pattern that could name it
(its url with and without its query, its path prefixes, its host, the domains above), each against the
interval that was valid when it was fetched; the most specific match decides, and a capture without one is
kept. Fragments, ports and user names are no part of a pattern; an IPv6 host is one in brackets.

The as-of join is an equi-join on scope, pattern, a bucket of BUCKET_DAYS days and a salt (a hash of the
url), with the interval as a residual. The captures' distinct (scope, pattern, bucket, salt), combined
before they are exchanged, meet the list first; what is left of the intervals, once for each bucket and
salt that has captures, meets the captures. So a pattern that names a third of all captures is dealt to
SALTS places in each bucket, a pattern with a long history is not compared with all its captures, and an
entry without a capture goes nowhere. Neither side is broadcast unless Spark finds it small.

Null or unparsable urls and null times match nothing and are kept. Repeated rows are kept and judged
alike. Extra columns of captures are kept, but those named like a column of the result (kept, scope,
pattern, listed, in any case) give way to it, as with `withColumn`. Empty captures or an empty list are
fine. Entries with a null field are ignored. Very long urls have as many prefixes as their path has parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lanes

BUCKET_DAYS = 32
SALTS = 16
#: The more specific, the higher; within a scope the longer pattern.
SCOPES = {"domain": 1, "host": 2, "prefix": 3, "url": 4}
#: Of entries of a pattern at one instant the highest counts.
ACTIONS = {"remove": 0, "allow": 1, "block": 2}
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"
RESULT = ["kept", "scope", "pattern", "listed"]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME + r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    """Without slashes at its end."""
    return F.regexp_replace(F.regexp_extract(url, SCHEME + r"[^/?#]*([^?#]*)", 1), "/+$", "")


def query_of(url: Column) -> Column:
    """With its question mark; empty if there is none."""
    return F.regexp_extract(url, SCHEME + r"[^?#]*(\?[^#]*)", 1)


def patterns_of(url: Column) -> Column:
    """array<struct<scope, pattern>> of all that could name the url."""
    host, path = host_of(url), path_of(url)
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    named = lambda scope, pattern: F.struct(F.lit(scope).alias("scope"), pattern.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: named("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: named("prefix", F.concat(host, F.array_join(F.slice(parts, 1, i), "/"))))
    urls = F.array_distinct(F.array(named("url", F.concat(host, path)), named("url", F.concat(host, path, query_of(url)))))
    return F.when(host != "", F.concat(urls, F.array(named("host", host)), domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """(scope, pattern, action, start, end): when an entry was the valid one; end is null while it still is. Removals leave none."""
    rank = F.create_map(*(F.lit(x) for kv in ACTIONS.items() for x in kv))
    dated = (
        entries.where("scope is not null and pattern is not null and action is not null and listed is not null")
        .groupBy("scope", "pattern", F.col("listed").alias("start"))
        .agg(F.max_by("action", rank[F.col("action")]).alias("action"))
    )
    end = F.lead("start").over(Window.partitionBy("scope", "pattern").orderBy("start"))
    return dated.withColumn("end", end).where(F.col("action") != "remove")


def _bucket(t: Column) -> Column:
    return F.floor(F.datediff(t, F.lit("1970-01-01")) / BUCKET_DAYS).cast("int")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Adds kept, scope, pattern and listed (of the deciding entry, null without one) to the captures; times are dates or timestamps of one kind."""
    keyed = captures.select(F.col(url).alias("url"), F.col(fetched).alias("fetched")).where("url is not null and fetched is not null").distinct()
    # few distinct captures would otherwise be read by one task, which the patterns make many rows of
    keyed = keyed.repartition(lanes(captures.sparkSession), "url", "fetched")
    salt = F.pmod(F.xxhash64("url"), F.lit(SALTS)).alias("salt")
    tried = keyed.select("url", "fetched", _bucket(F.col("fetched")).alias("bucket"), salt, F.explode(patterns_of(F.col("url"))).alias("p"))
    tried = tried.select("p.scope", "p.pattern", "bucket", "salt", "url", "fetched")
    asked = tried.select("scope", "pattern", "bucket", "salt").distinct()
    first, last = _bucket(F.col("start")), _bucket(F.col("end"))
    covering = asked.join(intervals(entries), ["scope", "pattern"]).where((first <= F.col("bucket")) & (last.isNull() | (F.col("bucket") <= last)))
    matched = tried.join(covering, ["scope", "pattern", "bucket", "salt"]).where("start <= fetched and (end is null or fetched < end)")
    order = F.create_map(*(F.lit(x) for kv in SCOPES.items() for x in kv))
    entry = F.struct("action", "scope", "pattern", F.col("start").alias("listed"))
    best = matched.groupBy("url", "fetched").agg(F.max_by(entry, F.struct(order[F.col("scope")].alias("s"), F.length("pattern").alias("n"))).alias("entry"))
    best = best.select(F.col("url").alias("j_url"), F.col("fetched").alias("j_fetched"), "entry")
    names = [c for c in captures.columns if c.lower() not in RESULT]
    taken = captures.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(url).alias("j1"), F.col(fetched).alias("j2"))
    joined = taken.join(best, (F.col("j1") == F.col("j_url")) & (F.col("j2") == F.col("j_fetched")), "left")
    kept = F.coalesce("entry.action", F.lit("allow")) != "block"
    return joined.select("row.*", kept.alias("kept"), "entry.scope", "entry.pattern", "entry.listed")
