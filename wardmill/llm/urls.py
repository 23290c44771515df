"""Allow and block rules for addresses, by a sorted sweep over reversed hosts.

The canonical key of a host is its labels from last to first, each closed by a separator that sorts
below every letter: ``m.example.net`` is ``net|example|m|``. A rule for a host and its subdomains is
then the interval of keys that start with its own key, and intervals are nested or apart. Addresses
and rule hosts are sorted together; while the sweep moves on, one slot per nesting depth holds the
last rule host of that depth: the stack. A slot counts while the key is inside its interval.

The sweep runs in blocks: ranges of the sorted rows, cut by size and not by host, so a host with a
third of all addresses fills many blocks. A block starts with the rule hosts around its first key.
Only built-in expressions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmill.llm.shared import ascii_lower, stored

SEPARATOR = "\x01"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.concat(F.array_join(labels, SEPARATOR), F.lit(SEPARATOR))


def rule_hosts(rules: DataFrame) -> DataFrame:
    """One row per rule host: its key, depth and paths, the longest first."""
    cut = rules.select("rule", "verdict").distinct().select(
        ascii_lower(F.regexp_extract("rule", r"(?s)^([^/]*)", 1)).alias("rule_host"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("path"), "rule", "verdict",
    ).filter(F.col("rule_host") != "")
    entry = F.struct(
        (-F.char_length("path")).alias("order"), "path", "rule", "verdict",
    )
    return cut.groupBy("rule_host").agg(F.array_sort(F.collect_list(entry)).alias("paths")).select(
        host_key(F.col("rule_host")).alias("key"), F.size(F.split("rule_host", r"\.", -1)).alias("depth"),
        F.struct("rule_host", "paths").alias("entry"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
) -> DataFrame:
    """``id``, ``url``, ``host``, ``path``, ``rule`` and ``verdict`` of each address.

    ``rules`` has rows (rule, verdict); a rule is a host followed by a path. It fits its host and all
    subdomains if the address's path starts with the rule's; of those that fit, the longest text
    wins, then the longer host, then the verdict ``allow``. No rule: null and ``default``.

    * A null address, or one without ``://``, has an empty host and path, and no rule fits it.
    * Repeated rows stay rows; null ids are ids. A rule without a host is ignored. No rules: all
      get the default. No addresses: no rows. Other columns are not read.
    """
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hosts = stored(rule_hosts(rules), "rule-hosts")
    depths = [r["depth"] for r in hosts.select("depth").distinct().orderBy("depth").collect()]
    rows = urls.select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), F.xxhash64("id", "url").alias("tie"),
        F.struct("id", "url", "host", "path").alias("page"), F.lit(None).cast(hosts.schema["entry"].dataType).alias("entry"),
        F.lit(0).alias("depth"),
    )
    page = rows.schema["page"].dataType
    opened = hosts.select(
        "key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"), F.lit(None).cast(page).alias("page"), "entry", "depth"
    )
    ranged = rows.unionByName(opened).repartitionByRange("key", "kind", "tie")
    swept = stored(ranged.withColumn("block", F.spark_partition_id()), "url-blocks")
    # The rule hosts open at the first key of each block: those that are a prefix of it, label by label.
    starts = swept.groupBy("block").agg(F.min("key").alias("start"))
    labels = F.split("start", SEPARATOR, -1)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), SEPARATOR), F.lit(SEPARATOR)),
    )
    around = (
        starts.select("block", F.explode(prefixes).alias("key")).join(opened.drop("block"), "key")
        .select(*[c for c in swept.columns])
    )
    sweep = Window.partitionBy("block").orderBy("key", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0)
    slots = {f"slot{d}": F.last(F.when(F.col("depth") == d, F.col("entry")), ignorenulls=True).over(sweep) for d in depths}
    judged = swept.unionByName(around).withColumns(slots).filter(F.col("kind") == 1)
    fits = [slot_fit(F.col(name)) for name in slots]
    best = F.lit(None).cast("struct<size:int,host:int,allow:boolean,rule:string,verdict:string>")
    if fits:
        best = F.array_max(F.array(*fits))
    out = judged.withColumn("best", best)
    return out.select(
        "page.id", "page.url", "page.host", "page.path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def slot_fit(slot: Column) -> Column:
    """The longest rule of a stack slot that fits the page, or null when the slot was left."""
    host = F.col("page.host")
    inside = (host == slot["rule_host"]) | F.endswith(host, F.concat(F.lit("."), slot["rule_host"]))
    hit = F.get(F.filter(slot["paths"], lambda p: F.startswith(F.col("page.path"), p["path"])), 0)
    found = F.struct(
        F.char_length(hit["rule"]).alias("size"), F.char_length(slot["rule_host"]).alias("host"),
        (hit["verdict"] == "allow").alias("allow"), hit["rule"].alias("rule"), hit["verdict"].alias("verdict"),
    )
    return F.when(inside & hit.isNotNull(), found)
