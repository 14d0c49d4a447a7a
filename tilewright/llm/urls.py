"""URL filters by a temporal list join.

A list is a log of dated entries: a domain is added or removed at a time. The log becomes
validity intervals, an entry being valid until the domain's next entry. A capture looks up
its host and every parent domain; an as-of join keeps the intervals that hold at its fetch
time, and of several the most specific domain decides. The join is on the domain, so it is
an equality join with the interval as a condition; a host with a third of all captures
meets a handful of intervals, and the engine splits such partitions at run time.

Cases: a URL without a host (null, empty or malformed) is not blocked and has a null host.
A capture with a null time is not blocked. Entries at the same time for a domain: a removal
wins. Entries with a null domain or time are ignored. Equal captures each give a row. An
empty list blocks nothing; empty captures give no rows. Hosts are compared in lower case
without port, user and a final dot. Extra columns of captures are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    found = F.regexp_replace(found, r"\.$", "")
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """domain, valid_from, valid_to (null: still valid) of a log of (domain, at, action); action: add or remove."""
    log = entries.where(F.col("domain").isNotNull() & F.col("at").isNotNull()).groupBy("domain", "at").agg(F.max((F.col("action") == "remove").cast("int")).alias("gone"))
    order = Window.partitionBy("domain").orderBy("at")
    log = log.withColumn("valid_to", F.lead("at").over(order))
    return log.where("gone = 0").select("domain", F.col("at").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, host, at, blocked, rule (the domain that decided) of captures (page_id, url, at)."""
    rows = captures.select("page_id", host_of(F.col("url")).alias("host"), "at")
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    asked = rows.where("host is not null and at is not null").select("page_id", "host", "at", F.explode(F.array_distinct(domains)).alias("domain"))
    held = asked.join(intervals(entries), "domain").where((F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
    rule = held.groupBy("page_id", "host", "at").agg(F.max(F.struct(F.length("domain"), "domain"))["domain"].alias("rule"))
    rule = rule.select(F.col("page_id").alias("r_id"), F.col("host").alias("r_host"), F.col("at").alias("r_at"), "rule")
    out = rows.join(rule, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("host") == F.col("r_host")) & (F.col("at") == F.col("r_at")), "left")
    return out.select("page_id", "host", "at", F.col("rule").isNotNull().alias("blocked"), "rule")


def capture_times(pages: DataFrame) -> DataFrame:
    """Captures of `pages`, fetched on a day of 2024 given by a digest of the id, as the table has no time."""
    day = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("day:"), F.col("page_id").cast("string"))), 1, 8), 16, 10).cast("bigint"), F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("at"))


def sample_log(captures: DataFrame) -> DataFrame:
    """A list for tables that bring none: of every fourth registered domain and every third host, added and perhaps removed on days of 2024."""
    hosts = captures.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    parts = F.split("host", r"\.")
    domains = hosts.select(F.explode(F.array("host", F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 2), 3), "."))).alias("domain")).distinct()
    code = lambda name, n: F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(name), F.col("domain"))), 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")
    listed = domains.where(code("list:", 3) == 0)
    start = F.lit("2024-01-01").cast("date")
    added = F.date_add(start, code("add:", 300))
    log = F.array(F.struct(added.alias("at"), F.lit("add").alias("action")), F.struct(F.date_add(added, code("remove:", 90) + 1).alias("at"), F.lit("remove").alias("action")),
                  F.struct(F.date_add(added, F.lit(120)).alias("at"), F.when(code("again:", 2) == 0, "add").otherwise("remove").alias("action")))
    return listed.select("domain", F.explode(log).alias("e")).select("domain", "e.at", "e.action")


def op9_url_filters(spark, sf_dir: str) -> DataFrame:
    captures = capture_times(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return filter_captures(captures, sample_log(captures)).withColumn("at", F.col("at").cast("string"))


OP9_SQL = r"""
WITH c AS (
  SELECT page_id, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
         DATE '2024-01-01' + (('0x' || substr(md5('day:' || page_id::VARCHAR), 1, 8))::BIGINT % 366)::INT AS "at"
  FROM pages
), d AS (
  SELECT DISTINCT unnest([host, array_to_string(string_split(host, '.')[greatest(1, len(string_split(host, '.')) - 2):], '.')]) AS domain FROM c WHERE host IS NOT NULL
), a AS (
  SELECT domain, DATE '2024-01-01' + (('0x' || substr(md5('add:' || domain), 1, 8))::BIGINT % 300)::INT AS added,
         (('0x' || substr(md5('remove:' || domain), 1, 8))::BIGINT % 90)::INT + 1 AS days, ('0x' || substr(md5('again:' || domain), 1, 8))::BIGINT % 2 AS again
  FROM d WHERE ('0x' || substr(md5('list:' || domain), 1, 8))::BIGINT % 3 = 0
), l AS (
  SELECT domain, added AS "at", 'add' AS action FROM a UNION ALL SELECT domain, added + days, 'remove' FROM a
  UNION ALL SELECT domain, added + 120, CASE WHEN again = 0 THEN 'add' ELSE 'remove' END FROM a
), i AS (
  SELECT domain, "at" AS valid_from, action, lead("at") OVER (PARTITION BY domain ORDER BY "at") AS valid_to FROM l
), m AS (
  SELECT c.page_id, max(length(i.domain)) AS n FROM c JOIN i ON (c.host = i.domain OR ends_with(c.host, '.' || i.domain))
   AND i.action = 'add' AND i.valid_from <= c."at" AND (i.valid_to IS NULL OR c."at" < i.valid_to) GROUP BY c.page_id
)
SELECT c.page_id, c.host, c."at"::VARCHAR AS "at", m.n IS NOT NULL AS blocked, right(c.host, m.n) AS rule FROM c LEFT JOIN m USING (page_id)
"""
