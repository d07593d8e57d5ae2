"""URL filtering by a sort-merge range join with host and path rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gotera.llm.common import LOWER, UPPER, fresh, quoted, shuffle_width

RULES_SCHEMA = "host string, path string, action string"


def host_of(url: Column) -> Column:
    """A-Z lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the top: ``a.example.org`` becomes ``org,example,a,``; a host and its subdomains share a prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(","))


def nested_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules as intervals of the path axis of their host, with the rule that encloses each.

    A path prefix p is the interval [p, p + 0xFF) of UTF-8 bytes (no text holds 0xFF), so intervals of one host are
    nested or apart. The running sum of starts and ends is the depth; the enclosing rule is the last start one level up.
    Where the same host and path is both allowed and blocked, block holds. Rules with a null part are left out.
    """
    whole = (
        rules.select("host", "path", "action").dropna()
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(F.max("action").alias("action"))
        .select(reversed_host(F.col("host")).alias("key"), "host", "path", "action")
    )
    low, high = F.col("path").cast("binary"), F.concat(F.col("path").cast("binary"), F.lit(bytearray(b"\xff")))
    rule = F.struct("host", "path", "action")
    marks = whole.select("key", rule.alias("rule"), F.explode(F.array(
        F.struct(low.alias("at"), F.lit(1).alias("step")), F.struct(high.alias("at"), F.lit(-1).alias("step")))).alias("mark"),
    ).select("key", "rule", "mark.at", "mark.step")
    along = Window.partitionBy("key").orderBy("at", "step")
    deep = marks.withColumn("depth", F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # each start is asked at its own level, and offered as encloser one level below
    levels = deep.where("step = 1").select("key", "rule", "at", F.explode(F.array(
        F.struct(F.col("depth").alias("level"), F.lit(None).cast(whole_type(rule, whole)).alias("offer")),
        F.struct((F.col("depth") + 1).alias("level"), F.col("rule").alias("offer")))).alias("asked")).select("key", "rule", "at", "asked.level", "asked.offer")
    level = Window.partitionBy("key", "level").orderBy("at")
    found = (
        levels.withColumn("outer", F.last("offer", True).over(level.rowsBetween(Window.unboundedPreceding, 0)))
        .where("offer is null").select("key", "rule", "outer")
    )
    return found


def whole_type(column: Column, df: DataFrame) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` (host + path of the longest rule that fits, or null) and ``verdict``.

    A rule fits its host and all subdomains where the url's path starts with the rule's path. Of several fitting rules
    the one of the longest host wins, then the longest path; urls without a rule get ``default``.

    Distinct (host, path) pairs are keyed by each reversed host suffix that can carry a rule (suffixes have at most as
    many labels as the longest rule host). Keys and rule intervals are then merged in one sort by (key, path bytes), and
    the sweep keeps the top of the stack of active rules: a start pushes its rule, an end pops to the enclosing one. A
    key under which a third of all urls fall (a top-level domain) is dealt over salts, to which its rules are copied, so
    no task sweeps a whole key.

    Null urls and urls without ``://`` have an empty host and path and fit no rule. Repeated rows are kept. An empty
    rule table leaves only defaults. Columns of ``df`` named like the four results are replaced.
    """
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c.lower() not in made]
    (best,) = fresh([*kept, *made], "best")
    pages = df.select(*[quoted(c) for c in kept], host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
    stack = nested_rules(rules)
    labels = F.size(F.split("host", r"\."))
    reach = rules.select(labels.alias("n")).agg(F.max("n")).first()[0] or 0
    salts = shuffle_width(df.sparkSession)
    asked = df.select(host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path")).distinct()
    parts = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(reach, 1)))),
                         lambda n: reversed_host(F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")))
    keyed = asked.select("host", "path", F.explode(suffix).alias("key"))
    keyed = keyed.join(stack.select("key").distinct(), "key", "left_semi")
    salt = F.pmod(F.xxhash64("host", "path"), F.lit(salts).cast("bigint"))
    urls = keyed.select("key", salt.alias("salt"), F.col("path").cast("binary").alias("at"), F.lit(1).alias("turn"),
                        F.struct("host", "path").alias("asked"))
    low = F.col("rule.path").cast("binary")
    # an end's value is a struct around a null where no rule encloses it: it empties the stack, a bare null would not
    edges = (
        stack.withColumn("edge", F.explode(F.array(
            F.struct(low.alias("at"), F.col("rule").alias("top")),
            F.struct(F.concat(low, F.lit(bytearray(b"\xff"))).alias("at"), F.col("outer").alias("top")))))
        .select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"), "edge.at",
                F.lit(0).alias("turn"), F.lit(None).cast("struct<host:string,path:string>").alias("asked"),
                F.struct(F.col("edge.top").alias("rule")).alias("top"))
    )
    urls = urls.withColumn("top", F.lit(None).cast(whole_type(F.col("top"), edges)))
    sweep = Window.partitionBy("key", "salt").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = edges.unionByName(urls).withColumn("top", F.last("top", True).over(sweep)).where("asked is not null")
    won = (
        swept.where("top.rule is not null")
        .groupBy("asked.host", "asked.path")
        .agg(F.max_by("top.rule", F.struct(F.length("top.rule.host"), F.length("top.rule.path"))).alias(best))
    )
    rule = quoted(best)
    return pages.join(won, ["host", "path"], "left").select(
        *[quoted(c) for c in kept], "host", "path",
        F.concat(rule["host"], rule["path"]).alias("rule"), F.coalesce(rule["action"], F.lit(default)).alias("verdict"))
