"""URL rules (host and its subdomains, path prefix) by sorted sweeps over reversed-host keys.

A host's labels are reversed, so that a rule's host and all its subdomains share a prefix, and a prefix
is an interval of the sorted keys. Prefix intervals are nested like brackets. Points and interval ends are
sorted together; the running number of open intervals is the depth, and the rule on level d of the stack
is the last one that opened on level d. The sorted order is cut into ranges, and each range receives
the depth and the stack that the ranges before it leave open, so no task sees more than its range.

Two sweeps are run: one over hosts finds the stack of rule hosts above each url's host; one over
(rule host, path) finds the longest rule path. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import written

_END = "X'FF'"  # above every byte of UTF-8
_SPLIT = "X'00'"


def _bytes(text: Column) -> Column:
    return text.cast("binary")


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a dot: ``a.example.net`` is ``net.example.a.``; an empty host is empty."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def sweep(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """``points`` with ``stack``: the ``name`` of every row of ``intervals`` whose key is a prefix of the point's.

    Both have a binary ``key``; keys of ``intervals`` are unique. The stack runs from the shortest
    key to the longest.
    """
    columns = [c for c in points.columns if c != "key"]
    nothing = F.lit(None).cast(intervals.schema["name"].dataType)
    payload = F.struct(*columns)
    no_payload = F.lit(None).cast(points.select(payload.alias("p")).schema["p"].dataType)
    begins = intervals.select("key", F.lit(0).alias("kind"), F.lit(1).alias("step"), "name", no_payload.alias("p"))
    ends = intervals.select(F.concat("key", F.expr(_END)).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step"), nothing.alias("name"), no_payload.alias("p"))
    middle = points.select("key", F.lit(1).alias("kind"), F.lit(0).alias("step"), nothing.alias("name"), payload.alias("p"))
    events = begins.unionByName(ends).unionByName(middle)
    width = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The hash deals equal keys over several ranges, so that a frequent key is no hot task.
    events = events.withColumn("deal", F.xxhash64("p"))
    ranged = events.repartitionByRange(width, "key", "kind", "deal").withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "sweep")

    # Depth at the start of each range, and depth of every event.
    order = Window.partitionBy("range").orderBy("key", "kind", "deal")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    depth_in = ranged.groupBy("range").agg(F.sum("step").alias("change")).select(
        "range", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth_in")
    )
    deep = ranged.join(F.broadcast(depth_in), "range").withColumn("depth", F.col("depth_in") + F.sum("step").over(order)).drop("depth_in")
    deep = written(deep, "sweep-depth")
    top = deep.agg(F.max("depth")).first()[0] or 0
    if top == 0:
        none = F.array().cast(f"array<{intervals.schema['name'].dataType.simpleString()}>")
        return points.withColumn("stack", none)

    # What each range leaves on each level, carried to the ranges after it.
    opened = [F.when((F.col("kind") == 0) & (F.col("depth") == d), F.col("name")) for d in range(1, top + 1)]
    key = F.when(F.col("kind") == 0, F.col("key"))
    left = deep.where("kind = 0").groupBy("range").agg(
        *[F.max_by(o, F.when(o.isNotNull(), key)).alias(f"left_{d}") for d, o in enumerate(opened, 1)]
    )
    ranges = deep.select("range").distinct().join(F.broadcast(left), "range", "left")
    carried = ranges.select("range", *[F.last(f"left_{d}", True).over(before).alias(f"in_{d}") for d in range(1, top + 1)])
    levels = F.array(*[F.coalesce(F.last(o, True).over(order), F.col(f"in_{d}")) for d, o in enumerate(opened, 1)])
    swept = deep.join(F.broadcast(carried), "range").withColumn("stack", F.slice(levels, 1, F.col("depth")))
    return swept.where("kind = 1").select("key", "p.*", "stack")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict``. The longest fitting rule wins (``rule`` is its host
    and path); of equally long ones the one with the longer host. Of repeated rules for one host and
    path the smallest verdict counts, and nulls in a rule are empty; a rule with an empty host fits all.
    Urls that no rule fits get ``default`` and a null rule. A null url or one without ``://`` has an empty host
    and path. Repeated rows and null ids are judged like others; other columns are not read. Without
    rules everything gets ``default``; an empty table gives no rows.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    urls = pages.select("page_id", rest.alias("rest"))
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    urls = urls.select("page_id", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    # Copies of a url are judged once: what is swept are the different hosts, then (rule host, path).
    clean = rules.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path", "verdict")])
    clean = clean.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    places = urls.select("host", "path").distinct()
    hosts = places.select("host").distinct().withColumn("key", _bytes(host_key(F.col("host"))))
    rule_hosts = clean.select("host").distinct().select(_bytes(host_key(F.col("host"))).alias("key"), F.col("host").alias("name"))
    above = sweep(hosts, rule_hosts).select("host", F.explode("stack").alias("rule_host"))
    joined = places.join(above, "host")
    split = F.expr(_SPLIT)
    pairs = joined.withColumn("key", F.concat(_bytes(F.col("rule_host")), split, _bytes(F.col("path"))))
    rule_keys = clean.select(
        F.concat(_bytes(F.col("host")), split, _bytes(F.col("path"))).alias("key"), F.struct("host", "path", "verdict").alias("name")
    )
    fits = sweep(pairs, rule_keys).where(F.size("stack") > 0).withColumn("best", F.try_element_at("stack", F.lit(-1)))
    size = F.struct(F.length("best.host") + F.length("best.path"), F.length("best.host"))
    chosen = fits.groupBy("host", "path").agg(F.max_by("best", size).alias("best"))
    judged = urls.join(chosen, ["host", "path"], "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.concat("best.host", "best.path").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
