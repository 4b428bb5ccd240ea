"""URL filtering by dated lists: every capture is judged by the entries active when it was fetched.

List rows (list_name, kind, pattern, action, at) say when a pattern was added to or
removed from a list, ``block`` or ``allow``. They become validity intervals: an addition
holds until the next row of its pattern. An as-of join finds, for each capture and
pattern of its URL, the interval that holds its fetch time. Kinds are

* ``domain``: the host itself or any parent, by whole labels;
* ``prefix``: host and leading path segments, as ``host/a/b``.

The most specific active entry decides: a prefix before a domain, then the longer
pattern, and on equal terms ``allow`` before ``block``. A capture stays unless a block
decides.

A URL has as many patterns as its labels and segments, but none deeper than the deepest
entry of the list. Equal captures are reduced to one before the join and counted. Both
join sides are plain shuffles, so the partition of a very common host can be split.

At one instant a removal counts after an addition; repeated list rows do no harm. Times
are any ordered type; a null time, pattern or action is no entry. A null or relative URL
and a null fetch time match nothing and stay. Hosts compare in lower case without port,
user or final dot; paths as they are, without empty segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.shared import Workspace

_HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#]*@)?([^/?#:@]*)"
_PATH = r"^[^:/?#]+://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """The host in lower case; empty where there is none."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), _HOST, 1), r"\.+$", "")


def segments(url: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, kind, pattern, valid_from and valid_until (null: still active) of every addition."""
    events = (
        entries.where("list_name IS NOT NULL AND kind IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL")
        .where("action IN ('add', 'remove')")
        .groupBy("list_name", "kind", "pattern", "at")
        .agg(F.max(F.col("action") == "remove").alias("removed"))
    )
    later = Window.partitionBy("list_name", "kind", "pattern").orderBy("at")
    return (
        events.withColumn("valid_until", F.lead("at").over(later))
        .where("NOT removed")
        .select("list_name", "kind", "pattern", F.col("at").alias("valid_from"), "valid_until")
    )


def _patterns(url: Column, labels: int, depth: int) -> Column:
    """Array of (kind, pattern) that an entry for the URL can have."""
    names, path = F.split(host(url), r"\."), segments(url)
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(max(labels, 1)))),
        lambda n: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(names, -n, n), ".").alias("pattern")),
    )
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.least(F.size(path), F.lit(depth))), lambda n: n > 0),
        lambda n: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat(host(url), F.lit("/"), F.array_join(F.slice(path, 1, n), "/")).alias("pattern"),
        ),
    )
    return F.when(F.coalesce(host(url), F.lit("")) != "", F.concat(domains, prefixes))


def judge(captures: DataFrame, entries: DataFrame, space: Workspace | None = None) -> DataFrame:
    """page_id, url, fetched_at, kept and the deciding entry of every row of ``captures``."""
    space = space or Workspace(captures.sparkSession, "url-filter")
    active = space.store(intervals(entries), "intervals")
    deepest = active.agg(
        F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)).alias("depth"),
    ).first()
    key = ["page_id", "url", "fetched_at"]
    counted = captures.select(*key).groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    probes = counted.select(
        *key, "times", F.explode_outer(_patterns(F.col("url"), deepest["labels"] or 0, deepest["depth"] or 0)).alias("p")
    ).select(*key, "times", F.col("p.kind").alias("kind"), F.col("p.pattern").alias("pattern"))
    probes = space.store(probes, "probes")
    holds = (F.col("valid_from") <= F.col("fetched_at")) & (
        F.col("valid_until").isNull() | (F.col("fetched_at") < F.col("valid_until"))
    )
    matched = probes.alias("c").join(
        active.alias("e"),
        (F.col("c.kind") == F.col("e.kind")) & (F.col("c.pattern") == F.col("e.pattern")) & holds,
        "left",
    )
    entry = F.when(
        F.col("list_name").isNotNull(),
        F.struct(
            F.col("e.kind").alias("kind"),  # prefix is after domain
            F.length("e.pattern").alias("length"),
            (F.col("list_name") == "allow").alias("allowed"),
            F.col("e.pattern").alias("pattern"),
            "list_name",
            "valid_from",
            "valid_until",
        ),
    )
    best = matched.groupBy(*key).agg(F.max(entry).alias("best"), F.max("times").alias("times"))
    return best.select(
        *key,
        F.explode(F.expr("array_repeat(1, cast(times AS int))")).alias("once"),
        (F.coalesce(F.col("best.list_name"), F.lit("allow")) != "block").alias("kept"),
        *[F.col(f"best.{c}").alias(c) for c in ("list_name", "kind", "pattern", "valid_from", "valid_until")],
    ).drop("once")


# The test tables have neither lists nor fetch times; both are derived from pages.
START, SPAN = 1_704_067_200, 63_072_000


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time, in seconds, spread over two years by id."""
    return pages.select("page_id", "url", (F.lit(START) + F.pmod(F.col("page_id") * 7919, F.lit(SPAN))).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over some of the hosts, their parents and their first path segments."""
    hosts = pages.select(host(F.col("url")).alias("host"), F.get(segments(F.col("url")), 0).alias("segment"))
    hosts = hosts.where("host != ''").distinct()
    labels = F.split("host", r"\.")
    parent = F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(3)), F.least(F.size(labels), F.lit(3))), ".")
    patterns = hosts.select(
        F.explode(
            F.array(
                F.struct(F.lit("domain").alias("kind"), F.col("host").alias("pattern")),
                F.struct(F.lit("domain").alias("kind"), parent.alias("pattern")),
                F.struct(F.lit("prefix").alias("kind"), F.concat("host", F.lit("/"), "segment").alias("pattern")),
            )
        ).alias("p")
    ).select("p.*").where("pattern IS NOT NULL").distinct()
    number = F.conv(F.substring(F.md5(F.concat("kind", F.lit(":"), "pattern")), 1, 8), 16, 10).cast("long")
    drawn = patterns.withColumn("v", number).where("v % 3 = 0").selectExpr(
        "CASE WHEN v % 5 = 0 THEN 'allow' ELSE 'block' END AS list_name",
        "kind",
        "pattern",
        f"{START} + v % {SPAN} AS first",
        f"CASE WHEN v % 2 = 0 THEN {START} + v % {SPAN} + (v div 7) % {SPAN} END AS second",
        f"CASE WHEN v % 6 = 0 THEN {START} + v % {SPAN} + (v div 7) % {SPAN} + (v div 11) % {SPAN} END AS third",
    )
    return drawn.selectExpr(
        "list_name",
        "kind",
        "pattern",
        "inline(array(struct('add' AS action, first AS at), struct('remove' AS action, second AS at), struct('add' AS action, third AS at)))",
    ).where("at IS NOT NULL")


ORACLE = rf"""
WITH p AS (
  SELECT page_id, url, {START} + (page_id * 7919) % {SPAN} AS fetched_at,
         regexp_replace(regexp_extract(lower(url), '{_HOST}', 1), '\.+$', '') AS host,
         list_filter(string_split(regexp_extract(url, '{_PATH}', 1), '/'), lambda s: s != '') AS segments
  FROM pages),
h AS (SELECT DISTINCT host, segments[1] AS segment FROM p WHERE host != ''),
patterns AS (
  SELECT 'domain' AS kind, host AS pattern FROM h
  UNION SELECT 'domain', array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 2, 1), NULL), '.') FROM h
  UNION SELECT 'prefix', host || '/' || segment FROM h WHERE segment IS NOT NULL),
v AS (SELECT *, ('0x' || substr(md5(kind || ':' || pattern), 1, 8))::BIGINT AS v FROM patterns),
d AS (
  SELECT CASE WHEN v % 5 = 0 THEN 'allow' ELSE 'block' END AS list_name, kind, pattern, v,
         {START} + v % {SPAN} AS t1, (v // 7) % {SPAN} AS gap, (v // 11) % {SPAN} AS again
  FROM v WHERE v % 3 = 0),
e AS (
  SELECT list_name, kind, pattern, 'add' AS action, t1 AS moment FROM d
  UNION SELECT list_name, kind, pattern, 'remove', t1 + gap FROM d WHERE v % 2 = 0
  UNION SELECT list_name, kind, pattern, 'add', t1 + gap + again FROM d WHERE v % 6 = 0),
events AS (SELECT list_name, kind, pattern, moment, max(CASE WHEN action = 'remove' THEN 1 ELSE 0 END) AS removed FROM e GROUP BY ALL),
held AS (
  SELECT *, lead(moment) OVER (PARTITION BY list_name, kind, pattern ORDER BY moment) AS valid_until FROM events),
active AS (SELECT list_name, kind, pattern, moment AS valid_from, valid_until FROM held WHERE removed = 0),
matched AS (
  SELECT p.page_id, p.url, p.fetched_at, a.*,
         row_number() OVER (PARTITION BY p.page_id, p.url, p.fetched_at
           ORDER BY a.kind DESC, length(a.pattern) DESC, a.list_name, a.pattern DESC, a.valid_from DESC) AS n
  FROM p JOIN active a ON p.fetched_at >= a.valid_from AND (a.valid_until IS NULL OR p.fetched_at < a.valid_until)
   AND CASE WHEN a.kind = 'domain' THEN p.host = a.pattern OR suffix(p.host, '.' || a.pattern)
            ELSE p.host || '/' || array_to_string(p.segments[1:len(string_split(a.pattern, '/')) - 1], '/') = a.pattern END
  WHERE p.host != '')
SELECT p.page_id, p.url, p.fetched_at, coalesce(m.list_name, 'allow') != 'block' AS kept,
       m.list_name, m.kind, m.pattern, m.valid_from, m.valid_until
FROM p LEFT JOIN matched m ON m.n = 1 AND m.page_id = p.page_id AND m.url = p.url
"""
