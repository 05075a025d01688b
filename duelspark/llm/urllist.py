"""URL filter with dated lists: every capture is judged by the entries active when it was fetched.

A list entry adds or removes a host pattern at a time; a pattern matches its host and all hosts
below it. Entries become validity intervals, and captures join the interval that holds their fetch
time. Time is cut into slots of ``slot`` seconds so that no key holds a pattern's whole history: the
state at the start of a slot comes from the last entries of earlier slots (one row per pattern and
slot), inside a slot the entries follow each other, and a capture joins on (pattern, slot) and the
interval. Captures of one host at one time are judged once.

If several patterns match, the longest active one is reported. Entries of one pattern at one time
count as one, an addition before a removal. Edge cases: captures without a host or a time are never
blocked; entries without pattern, time or action are ignored; repeated captures each get a row; empty
tables are accepted; extra columns of both tables are ignored but for the ``keep`` ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/:?#@\[]+)"


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without user names, port and final dots (an IPv6 host keeps its
    brackets); null without one."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", ""), F.lit(""))


def suffixes(name: Column) -> Column:
    """The host and its parent domains of at least two labels."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    return F.when(n < 2, F.array(name)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), ".")))


def slices(entries: DataFrame, wanted: DataFrame, slot: int) -> DataFrame:
    """(pattern, slot, from, to, active, since): validity intervals of every wanted (pattern, slot);
    the first begins with the slot (null ``from``), the last ends with it (null ``to``)."""
    of = (F.unix_timestamp("at") / slot).cast("long")
    marks = entries.withColumn("slot", of)
    last = marks.groupBy("pattern", "slot").agg(F.max_by("active", "at").alias("active"), F.max("at").alias("since"))
    line = last.withColumn("want", F.lit(False)).unionByName(
        wanted.withColumn("active", F.lit(None).cast("boolean")).withColumn("since", F.lit(None).cast("timestamp"))
        .withColumn("want", F.lit(True)))
    line = line.groupBy("pattern", "slot").agg(F.max("active").alias("active"), F.max("since").alias("since"),
                                               F.max("want").alias("want"))
    before = Window.partitionBy("pattern").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    opening = line.withColumn("active", F.last("active", ignorenulls=True).over(before)) \
        .withColumn("since", F.last("since", ignorenulls=True).over(before)).where("want")
    inside = marks.join(wanted, ["pattern", "slot"], "left_semi") \
        .select("pattern", "slot", F.col("at").alias("from"), "active", F.col("at").alias("since"))
    rows = opening.select("pattern", "slot", F.lit(None).cast("timestamp").alias("from"), "active", "since") \
        .unionByName(inside)
    order = Window.partitionBy("pattern", "slot").orderBy(F.col("from").asc_nulls_first())
    return rows.withColumn("to", F.lead("from").over(order)).where("active")


def judge(captures: DataFrame, entries: DataFrame, slot: int = 3600, url: str = "url", at: str = "fetched_at",
          keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Per capture: the ``keep`` columns, host, fetched_at, blocked, pattern, listed_since.
    ``entries``: pattern, at, action ('add' or 'remove')."""
    listed = entries.where(F.col("pattern").isNotNull() & F.col("at").isNotNull()
                           & F.col("action").isin("add", "remove")) \
        .groupBy(F.lower("pattern").alias("pattern"), "at").agg((F.min(F.col("action") == "add")).alias("active"))
    rows = captures.select(*keep, host(F.col(url)).alias("host"), F.col(at).alias("fetched_at"))
    asked = materialize(rows.select("host", "fetched_at").where("host IS NOT NULL AND fetched_at IS NOT NULL").distinct()
                        .withColumn("pattern", F.explode(suffixes(F.col("host"))))
                        .withColumn("slot", (F.unix_timestamp("fetched_at") / slot).cast("long")), "captures")
    valid = slices(listed, asked.select("pattern", "slot").distinct(), slot)
    hit = asked.join(valid, ["pattern", "slot"]).where(
        (F.col("from").isNull() | (F.col("from") <= F.col("fetched_at")))
        & (F.col("to").isNull() | (F.col("to") > F.col("fetched_at"))))
    verdict = hit.groupBy("host", "fetched_at").agg(
        F.max(F.struct(F.length("pattern"), "pattern", "since")).alias("m")) \
        .select("host", "fetched_at", F.col("m.pattern").alias("pattern"), F.col("m.since").alias("listed_since"))
    return rows.join(verdict, ["host", "fetched_at"], "left") \
        .select(*keep, "host", "fetched_at", F.col("pattern").isNotNull().alias("blocked"), "pattern", "listed_since")
