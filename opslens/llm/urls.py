"""URL filter as a sort-merge range join.

Keys: host labels from the right, then the path. A rule covers the keys that start with its own, an interval of the
key order, and intervals of rules nest. One sorted sweep over rules and URLs: the rule that opened last before a key
carries the stack of the rules open at its start, innermost first; the first of them that covers the key decides.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.functions.running import running, sliced
from opslens.llm.common import ascii_lower

#: Between host labels, and between host and path: sorts before all that a URL holds, so that a rule's interval is
#: closed under its subdomains' labels.
LABEL, PATH = "\u0001", "\u0002"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as text. Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: from there up to
    ``? #``. Both are empty for null and where ``://`` is missing."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    whole = F.split(rest, "[?#]", 2)[0]
    slash = F.locate("/", whole)
    host = F.when(slash > 0, F.substring(whole, F.lit(1), slash - 1)).otherwise(whole)
    path = F.when(slash > 0, F.substring(whole, slash, F.length(whole))).otherwise(F.lit(""))
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, LABEL), F.lit(PATH), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Rules with their key, label count and stack: the keys of the rules that cover it, longest first, itself included.

    ``rules``: host, path, verdict. Hosts are lower-cased (A-Z), null is empty; of rules with equal host and path the
    one with the smallest verdict counts. A rule without a host covers nothing and goes.
    """
    clean = rules.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict",
    ).filter("host != ''")
    clean = clean.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    keyed = clean.withColumn("depth", F.size(F.split("host", "\\."))).withColumn("key", _key(_labels(F.col("host")), F.col("path")))
    # Only prefixes that keep the whole host can be rules that cover a key of the same host.
    cut = F.length("key") - F.length("path")
    prefixes = keyed.select("key", F.explode(F.sequence(cut, F.length("key"))).alias("n")).select(
        F.col("key").alias("of"), F.substring("key", F.lit(1), F.col("n")).alias("key"))
    frame = F.struct(F.length("key").alias("n"), "key", "host", "path", "verdict", "depth")
    stack = prefixes.join(keyed, "key").groupBy("of").agg(F.sort_array(F.collect_list(frame), asc=False).alias("stack"))
    return stack.select(F.col("of").alias("key"), "stack")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict (columns of these names are replaced).

    A rule fits its host and all subdomains of it if the path starts with the rule's. Of the fitting rules the one
    with the most host labels, then the longest path, decides. rule is ``host || path`` of that rule, null if none
    fits; the verdict is then ``default``. Null and malformed URLs have an empty host, which no rule fits. Repeated
    rows are judged one by one; an empty table gives an empty result; without rules every verdict is ``default``.
    """
    cols = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = parts(F.col(url))
    base = urls.select(F.struct(*cols, host.alias("host"), path.alias("path")).alias("row"))
    stacks = rule_stacks(rules)
    depths = sorted(r[0] for r in stacks.select(F.explode(F.transform("stack", lambda s: s.depth))).distinct().collect())
    if not depths:
        return base.select("row.*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    known = F.filter(F.array(*(F.lit(d) for d in depths)), lambda d: d <= F.size("labels"))
    # One probe for each host suffix that any rule has; a URL without such a suffix is probed once, in vain.
    probes = base.withColumn("_row", F.monotonically_increasing_id()).withColumn("labels", _labels(F.col("row.host"))).select(
        "row", "_row", F.size(known).alias("asked"),
        F.explode_outer(F.transform(known, lambda d: _key(F.slice(F.col("labels"), 1, d), F.col("row.path")))).alias("key"),
    )
    events = stacks.select("key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("_row"), "stack").unionByName(
        probes.select(F.coalesce("key", F.lit("")).alias("key"), F.lit(1).alias("kind"), "_row", "row", "asked"),
        allowMissingColumns=True)
    swept = running(sliced(events, [], ["key", "kind", "_row"]), [], ["key", "kind", "_row"], last={"open": F.col("stack")})
    covers = F.filter("open", lambda s: F.startswith(F.col("key"), s.key))
    found = swept.filter("kind = 1").withColumn("hit", F.try_element_at(covers, F.lit(1)))
    best = F.max(F.struct(F.col("hit.depth").alias("depth"), F.length("hit.path").alias("n"), F.col("hit.host").alias("host"),
                          F.col("hit.path").alias("path"), F.col("hit.verdict").alias("verdict")))
    single = found.filter("asked <= 1").select("row", "hit")
    many = found.filter("asked > 1").groupBy("_row").agg(F.any_value("row").alias("row"), best.alias("hit"))
    done = single.select("row", "hit.host", "hit.path", "hit.verdict").unionByName(many.select("row", "hit.host", "hit.path", "hit.verdict"))
    return done.select("row.*", F.concat("host", "path").alias("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict"))
