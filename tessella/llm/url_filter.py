"""URL rules by sort-merge range joins over canonical keys.

The labels of a host are reversed and closed with a dot, so that a host and
all its subdomains are one interval of keys: ``example.net`` owns all keys that
begin with ``net.example.``; behind the key of a rule's host, the paths that
begin with the rule's path are one interval again. Intervals of either kind
nest or are disjoint. A sweep over rows and starts of rules, sorted together,
therefore needs the last start alone: with the stack of the rules that it lies
in, made beforehand from the rules, it holds every rule that can be open at a
row, the innermost first.

The first sweep gives each row the rules' hosts that it lies under, the second
one, for each of these hosts, the rules whose paths it begins with. Rows and
starts are cut into buckets at the same keys, and every bucket begins with the
last start before it. Equal keys of rows are spread over buckets by a hash
behind them, so a hot host or url is no hot bucket. A row carries the stack of
one rule, never all rules of a host.

Defined results: a url that is null or has no ``://`` has empty host and path
and meets no rule; urls are read whole, however long; the longest rule (host
and path together, then the longer host, then ``block``) wins; rows without a
rule get the default verdict; repeated rows are judged each; rules without
host are ignored, repeated rules count once; hosts and paths of rules may nest
to any depth; an empty table of pages gives an empty result, one of rules the
default; of the table only the id and ``url`` are read, so other columns
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between the key of a host and what follows it.
_MARK = "\x01"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each closed with a dot."""
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def _bucket(key: Column, cuts: list[list[str]]) -> Column:
    """The number of cuts at or below a key, by groups of cuts and then within one group."""
    if not cuts:
        return F.lit(0)
    heads = F.array(*[F.lit(g[0]) for g in cuts])
    group = F.size(F.filter(heads, lambda c: c <= key))
    groups = F.array(*[F.array(*[F.lit(x) for x in g]) for g in cuts])
    inside = F.size(F.filter(F.element_at(groups, F.greatest(group, F.lit(1))), lambda c: c <= key))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * len(cuts[0]) + inside)


def _cuts(keys: DataFrame, buckets: int) -> list[list[str]]:
    """Keys that part the rows into about equal buckets, in groups of about the square root of their number."""
    first = keys.repartitionByRange(buckets, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key"))
    found = sorted({r["key"] for r in first.collect()})[1:]  # as many as there are buckets
    width = max(1, round(len(found) ** 0.5))
    return [found[i : i + width] for i in range(0, len(found), width)]


def _spread(*columns: str) -> Column:
    """A hash that parts equal keys, behind a character that sorts below all others."""
    return F.concat(F.lit("\x00"), F.lpad(F.hex(F.xxhash64(*columns)), 16, "0"))


def _host_stacks(rules: DataFrame) -> DataFrame:
    """key and slot of each host of rules: the hosts of rules that it lies under, itself first."""
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    wide = hosts.select("host", F.explode(above).alias("of")).join(hosts.withColumnRenamed("host", "of"), "of")
    entry = F.struct((-F.length("of")).alias("a"), F.col("of").alias("host"), host_key(F.col("of")).alias("key"))
    return wide.groupBy("host").agg(F.array_sort(F.collect_set(entry)).alias("slot")).select(host_key(F.col("host")).alias("key"), "slot")


def _path_stacks(rules: DataFrame) -> DataFrame:
    """key and slot of each rule: the rules of its host whose paths its own begins with, the longest first."""
    sizes = rules.select("host", F.length("path").alias("n")).distinct()
    wide = rules.select("host", F.col("path").alias("own")).join(sizes, "host").where(F.col("n") <= F.length("own"))
    wide = wide.withColumn("path", F.substring("own", F.lit(1), F.col("n"))).join(rules, ["host", "path"])
    entry = F.struct((-F.col("n")).alias("a"), F.col("path").alias("path"), F.col("verdict").alias("verdict"), F.col("host").alias("host"))
    slots = wide.groupBy("host", "own").agg(F.array_sort(F.collect_set(entry)).alias("slot"))
    return slots.select(F.concat(host_key(F.col("host")), F.lit(_MARK), F.col("own")).alias("key"), "slot")


def _swept(rows: DataFrame, starts: DataFrame, buckets: int) -> DataFrame:
    """rows (key, row) with the slot of the last start (key, slot) at or below their key."""
    spark = rows.sparkSession
    cuts = _cuts(rows.select("key"), buckets)
    placed = starts.select(_bucket(F.col("key"), cuts).alias("bucket"), "key", "slot")
    last = placed.groupBy("bucket").agg(F.max_by("slot", "key").alias("slot"))
    # One row for each bucket.
    every = spark.range(sum(map(len, cuts)) + 1).select(F.col("id").cast("int").alias("bucket")).join(last, "bucket", "left")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    opened = every.select("bucket", F.lit("").alias("key"), F.last("slot", ignorenulls=True).over(before).alias("slot"))
    none = F.lit(None).cast(rows.schema["row"].dataType).alias("row")
    held = placed.unionByName(opened).select("bucket", "key", F.lit(0).alias("asks"), none, "slot")
    asked = rows.select(_bucket(F.col("key"), cuts).alias("bucket"), "key", F.lit(1).alias("asks"), "row", F.lit(None).cast(starts.schema["slot"].dataType).alias("slot"))
    sweep = Window.partitionBy("bucket").orderBy("key", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return asked.unionByName(held).withColumn("slot", F.last("slot", ignorenulls=True).over(sweep)).where("asks = 1").select("key", "row", "slot")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id") -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict."""
    buckets = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = rules.where("host <> ''").select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    first = F.min(F.struct(F.when(F.col("verdict") == "block", 0).otherwise(1).alias("a"), "verdict"))
    owned = scratch.materialize(owned.groupBy("host", "path").agg(first.alias("b")).select("host", "path", F.col("b.verdict").alias("verdict")), "rules")

    host, path = split_url(F.col("url"))
    rows = pages.select(F.monotonically_increasing_id().alias("at"), F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.select(F.concat(host_key(F.col("host")), _spread("at")).alias("key"), F.struct("at", "page_id", "host", "path").alias("row"))
    under = _swept(rows, _host_stacks(owned), buckets)
    under = scratch.materialize(under.select("row", F.filter(F.coalesce("slot", F.array().cast(under.schema["slot"].dataType)), lambda h: F.startswith(F.col("key"), h["key"])).alias("hosts")), "hosts")

    each = under.where("size(hosts) > 0").select(F.col("row").alias("page"), F.size("hosts").alias("n"), F.explode("hosts").alias("of"))
    each = each.select(F.concat(F.col("of.key"), F.lit(_MARK), F.col("page.path"), _spread("page.at")).alias("key"), F.struct("page", "n", F.col("of.host").alias("of")).alias("row"))
    found = _swept(each, _path_stacks(owned), buckets).select("row.page", "row.n", "row.of", "slot")
    # In front of a host's first rule the last start is one of another host.
    found = found.withColumn("fit", F.get(F.filter("slot", lambda r: (r["host"] == F.col("of")) & F.startswith(F.col("page.path"), r["path"])), 0))
    rule = F.concat("of", "fit.path")
    rank = F.struct(F.length(rule).alias("a"), F.length("of").alias("b"), rule.alias("rule"), F.col("fit.verdict").alias("verdict"))
    found = scratch.materialize(found.select("page", "n", F.when(F.col("fit").isNotNull(), rank).alias("best")), "found")
    one = found.where("n = 1").select("page", "best")
    more = found.where("n > 1").groupBy("page").agg(F.max("best").alias("best"))
    none = under.where("size(hosts) = 0").select(F.col("row").alias("page"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    return none.unionByName(one).unionByName(more).select("page.page_id", "page.host", "page.path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
