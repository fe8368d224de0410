"""URL filters by a temporal list join. DataFrame functions only.

Dated list entries (list, effect, scope, key, action, at) become validity intervals:
for each entry key the adds and removes, in order of time, open and close half-open
intervals [since, until). Every capture is evaluated against the entries active when
it was fetched. A capture has one key for its host, one for each domain above it and
one for each folder of its path; intervals are laid out over those buckets of time that captures have, and an
equality join on (scope, key, bucket) with the time test on top is the as-of join: a
capture meets at most one interval of an entry. A hot host spreads over buckets, and
Spark may split the rest or broadcast the list if it finds it small.

The most specific active key decides (longest key; folder before host before domain);
at equal keys `allow` goes before `block`, then the list first in alphabetical order.
Adds of an active key and removes of an inactive one change nothing; at equal times
removes go first. Captures without a time, or whose URL has no host, match nothing and
are `none`, as are all captures of an empty list. Null keys, times and actions of
entries are ignored. Repeated captures keep one row each; no captures give no rows. A very
long URL has as many keys as folders. Of captures the id, the URL and the time are read,
whatever other columns are named.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOST, DOMAIN, FOLDER = "host", "domain", "folder"
RANK = {FOLDER: 3, HOST: 2, DOMAIN: 1}
BUCKET_DAYS = 30


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port, final dot and leading www., '' if none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.regexp_replace(F.regexp_replace(host, r"\.$", ""), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def bucket_of(at: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(at) / (86400 * days)).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, effect, scope, key, since, until): until is null while an entry stands."""
    known = entries.where("key is not null and at is not null and action in ('add', 'remove')").select("list", "effect", "scope", "key", F.col("at").cast("timestamp").alias("at"), (F.col("action") == "add").cast("int").alias("on"))
    # one state for each time: adds win over removes of the same time
    known = known.groupBy("list", "effect", "scope", "key", "at").agg(F.max("on").alias("on"))
    order = Window.partitionBy("list", "effect", "scope", "key").orderBy("at")
    turns = known.withColumn("was", F.coalesce(F.lag("on").over(order), F.lit(0))).where("`on` <> was")
    return turns.withColumn("until", F.lead("at").over(order)).where("`on` = 1").select("list", "effect", "scope", "key", F.col("at").alias("since"), "until")


def keys_of(host: Column, path: Column) -> Column:
    """All (scope, key) that may name a capture."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    domains = F.when(n < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(labels, i, n), ".")))
    parts = F.split(path, "/", -1)
    ends = F.when(F.size(parts) < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size(parts) - 1))
    folders = F.transform(ends, lambda i: F.concat(host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    pair = lambda scope: lambda k: F.struct(F.lit(scope).alias("scope"), k.alias("key"))
    return F.when(host == "", F.array().cast("array<struct<scope:string,key:string>>")).otherwise(F.array_distinct(F.concat(F.array(pair(HOST)(host)), F.transform(domains, pair(DOMAIN)), F.transform(folders, pair(FOLDER)))))


def laid(active: DataFrame, buckets: list[int], days: int = BUCKET_DAYS) -> DataFrame:
    """Intervals with `bucket`: a row for each of the buckets that an interval meets."""
    begin, end = bucket_of(F.col("since"), days), bucket_of(F.col("until"), days)
    held = F.from_json(F.lit(json.dumps(buckets)), "array<int>")
    return active.withColumn("bucket", F.explode(F.filter(held, lambda b: (b >= begin) & (end.isNull() | (b <= end)))))


def evaluated(captures: DataFrame, entries: DataFrame, id_column: str = "page_id", days: int = BUCKET_DAYS) -> DataFrame:
    """id, url, fetched_at, verdict (allow, block or none), and list, scope, matched_key and
    since of the deciding entry; one row per row of captures."""
    named = [id_column, "url", "fetched_at"]
    rows = captures.select(*named).groupBy(*named).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("bucket", bucket_of(F.col("fetched_at"), days))
    candidates = rows.withColumn("k", F.explode_outer(keys_of(F.coalesce(host_of(F.col("url")), F.lit("")), F.coalesce(path_of(F.col("url")), F.lit("")))))
    candidates = candidates.select(*named, "copies", "bucket", "k.scope", "k.key")
    # intervals are laid over the buckets that captures have: at most one for each bucket of the calendar
    held = rows.where("bucket is not null").agg(F.array_sort(F.collect_set("bucket"))).first()[0]
    active = laid(intervals(entries), held, days)
    active = active.select(F.col("scope").alias("l_scope"), F.col("key").alias("l_key"), F.col("bucket").alias("l_bucket"), "list", "effect", "since", "until")
    c = F.col
    met = candidates.join(
        active,
        (c("scope") == c("l_scope")) & (c("key") == c("l_key")) & (c("bucket") == c("l_bucket")) & (c("fetched_at") >= c("since")) & (c("until").isNull() | (c("fetched_at") < c("until"))),
        "left",
    )
    rank = F.when(c("scope") == FOLDER, RANK[FOLDER]).when(c("scope") == HOST, RANK[HOST]).otherwise(RANK[DOMAIN])
    # the smallest tuple is the most specific entry
    entry = F.struct((-rank).alias("rank"), (-F.length("key")).alias("size"), (c("effect") != "allow").alias("late"), "list", "effect", "scope", "key", "since")
    best = met.groupBy(*named, "copies").agg(F.min(F.when(c("list").isNotNull(), entry)).alias("e"))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1), c("copies").cast("int"))))
    return best.select(*named, F.coalesce("e.effect", F.lit("none")).alias("verdict"), F.col("e.list").alias("list"), F.col("e.scope").alias("scope"), F.col("e.key").alias("matched_key"), F.col("e.since").alias("since"))
