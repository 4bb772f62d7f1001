"""URL filters as a sort-merge range join of reversed-host keys.

A rule fits its host, every subdomain of it, and every path that starts with the rule's path.  Written
as ``reversed host / path`` a rule is a prefix, that is, an interval of the sorted keys, and two such intervals
either nest or are disjoint.  A url has one key per parent host (``a.example.net`` has three).  Keys and rules
are sorted together and swept once; the sweep carries the stack of rules open at the last rule, and the rules a
key lies in are the members of that stack that are its prefixes.

Ranges of rules are the unit of distribution.  A range with many keys is swept by several tasks, each with its own
copy of the range's rules; a sweep holds at least four keys per rule, so the copies stay fewer than the keys.

Defined cases: a null url, or one without ``://``, has empty host and path and no rule.  Repeated urls are judged
once.  Rules with a null host or path are ignored; repeated rules count once, and if one rule is given with both
verdicts, ``block`` holds.  Of rules of equal length the one with the longer host wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "[.]", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the rules open at it, outermost first: itself and all rules that are its prefixes."""
    own = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .withColumn("host", F.translate("host", _UPPER, _LOWER))
        .groupBy("host", "path")
        .agg(F.max(F.col("verdict")).alias("verdict"))  # 'block' sorts after 'allow'
        .withColumn("key", _key(_labels(F.col("host")), F.col("path")))
    )
    outer = own.select(
        F.col("key").alias("outer_key"),
        F.struct(
            F.length("key").alias("depth"),
            F.col("key").alias("key"),
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            "verdict",
        ).alias("entry"),
    )
    heads = own.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select(
        "key", F.expr("left(key, n)").alias("outer_key")
    )
    return heads.join(outer, "outer_key").groupBy("key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))


def judge_urls(urls: DataFrame, rules: DataFrame, rules_per_range: int = 100_000, keys_per_sweep: int = 20_000) -> DataFrame:
    """Distinct ``(host, path)`` of ``urls`` with ``rule`` and ``verdict`` of the longest rule that fits, or nulls.

    ``rules`` has host, path and verdict.  ``rules_per_range`` bounds the rules one task sorts.
    """
    stacks = cut_lineage(rule_stacks(rules))
    distinct = urls.select("host", "path").distinct()
    points = distinct.select(
        "host",
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(F.split("host", "[.]", -1))),
                lambda n: _key(F.slice(_labels(F.col("host")), 1, n), F.col("path")),
            )
        ).alias("key"),
    )

    # first key of each range; a range starts at a rule, so nothing is open before it that its stacks do not hold
    total = stacks.count()
    ranges = max(1, -(-total // rules_per_range))
    starts = _range_starts(stacks, total, ranges)
    number = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("key"))) if starts else F.lit(0)
    points = cut_lineage(points.withColumn("range", number).where("range > 0"))

    per_range = points.groupBy("range").agg(F.count("*").alias("keys"))
    held = stacks.withColumn("range", number).groupBy("range").agg(F.count("*").alias("rules"))
    sweeps = per_range.join(held, "range").select(
        "range",
        F.greatest(
            F.lit(1), F.floor(F.col("keys") / F.greatest(F.lit(keys_per_sweep), 4 * F.col("rules"))).cast("int")
        ).alias("sweeps"),
    )
    sweeps = F.broadcast(sweeps)  # one row per range, at most as many as the literals above
    marks = stacks.withColumn("range", number).join(sweeps, "range").select(
        "range",
        F.explode(F.sequence(F.lit(0), F.col("sweeps") - 1)).alias("sweep"),
        "key",
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "stack",
    )
    keyed = points.join(sweeps, "range").select(
        "range",
        F.pmod(F.xxhash64("host", "path"), F.col("sweeps")).cast("int").alias("sweep"),
        "key",
        "host",
        "path",
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    # rules sort before the urls at the same key; a rule has no host
    along = (
        Window.partitionBy("range", "sweep")
        .orderBy("key", F.col("host").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = marks.unionByName(keyed).withColumn("open", F.last("stack", ignorenulls=True).over(along)).where("host IS NOT NULL")
    fitting = F.filter("open", lambda r: F.startswith(F.col("key"), r["key"]))
    best = swept.select("host", "path", F.try_element_at(fitting, F.lit(-1)).alias("best")).where("best IS NOT NULL")
    won = best.groupBy("host", "path").agg(
        F.max_by("best", F.struct(F.length("best.rule"), F.col("best.host_length"))).alias("best")
    )
    return won.select("host", "path", "best.rule", "best.verdict")


def _range_starts(stacks: DataFrame, total: int, ranges: int) -> list[str]:
    """At most ``ranges`` keys that cut the sorted rules into about equal parts."""
    if total == 0:
        return []
    first = stacks.agg(F.min("key")).first()[0]
    if ranges == 1:
        return [first]
    heads = stacks.select(F.col("key")).repartitionByRange(ranges, "key")
    cuts = heads.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    return sorted({first, *(row.key for row in cuts.collect())})  # one row per range


def filter_pages(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", **options) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; urls that no rule fits get ``default``.

    Columns of ``pages`` with one of these names are replaced.
    """
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    judged = judge_urls(parsed, rules, **options)
    return parsed.join(judged, ["host", "path"], "left").select(
        *kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
