"""URL filters: a temporal join of captures with dated list entries.

Entries (host, day, listed) say that a host enters or leaves a list on a day. The entries of a host
become validity intervals, from a listing to the host's next entry (open where there is none). A
capture is blocked when its host, or a parent domain, was listed on the day it was fetched: the as-of
join is an equi-join on the domain with the day inside the interval. A host's intervals are disjoint,
so a capture meets each of its few domains at most once; hot hosts are split by adaptive execution.

Defined cases: null, blank and hostless URLs and null days are never blocked; of entries of one host
and day the listing one counts; repeated entries count once; an entry without host or day counts for
nothing; repeated captures are judged each; no captures give no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: scheme, optional user, host.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; null where there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), HOST, 1)
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def validity(entries: DataFrame) -> DataFrame:
    """(domain, since, until): half-open intervals in which a domain is listed."""
    known = entries.filter("host IS NOT NULL AND day IS NOT NULL").select(
        F.lower("host").alias("domain"), "day", F.coalesce("listed", F.lit(False)).alias("listed")
    )
    days = known.groupBy("domain", "day").agg(F.max("listed").alias("listed"))
    following = F.lead("day").over(Window.partitionBy("domain").orderBy("day"))
    return days.withColumn("until", following).filter("listed").select(
        "domain", F.col("day").alias("since"), "until"
    )


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, host, day, n_listed (domains listed that day) and blocked, for every capture."""
    held = captures.select(
        F.struct("page_id", "day", host_of(F.col("url")).alias("host")).alias("capture")
    ).groupBy("capture").agg(F.count(F.lit(1)).alias("copies"))
    rows = held.select("capture", "copies", F.explode_outer(domains_of(F.col("capture.host"))).alias("name"))
    inside = (
        (F.col("name") == F.col("domain"))
        & (F.col("capture.day") >= F.col("since"))
        & (F.col("until").isNull() | (F.col("capture.day") < F.col("until")))
    )
    counted = (
        rows.join(validity(entries), inside, "left")
        .groupBy("capture", "copies")
        .agg(F.count("domain").alias("n_listed"))
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return counted.select("capture", "n_listed", each.alias("copy")).select(
        "capture.page_id", "capture.host", "capture.day", "n_listed",
        (F.col("n_listed") > 0).alias("blocked"),
    )
