"""URL filters: rules, and link-graph propagation for what no rule covers.

Trust starts at hosts whose pages an allow rule covers and follows links;
distrust starts at hosts with blocked pages and follows links backwards
(who links to a bad host is suspect).  Both are personalised PageRanks over
the host graph; a host whose distrust exceeds its trust by a threshold is
blocked.

The graph has the links between hosts, and a link each way between a host and
its parent domain, up to the registered name: hosts under one name share
trust and distrust through it, whether or not the parent has pages.

Plan: built-in expressions only.  Links are reduced to host pairs map-side,
so a hot host is one row per task; the graph has one row per host pair.  A
round is one join and one aggregate over it, four rounds are written at a
time, until no score moves.  Rules and verdicts come back to the pages through one table with a
row per host, broadcast only after its rows are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import broadcast_if_small, lookup, written

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffixes(host):
    """The host itself and every parent domain of it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules that fit each host, the longest first (then
    the longer host, then block before allow, then by name)."""
    fit = (hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
           .join(broadcast_if_small(rules), "rule_host")
           .select("host", F.struct(
               (-F.length(F.concat("rule_host", "rule_path"))).alias("a"), (-F.length("rule_host")).alias("b"),
               (F.col("action") != "block").alias("c"), F.concat("rule_host", "rule_path").alias("rule"),
               F.col("rule_path"), F.col("action")).alias("r")))
    return fit.groupBy("host").agg(F.array_sort(F.collect_set("r")).alias("rules"))  # rules on one host's suffixes


def parent_links(hosts: DataFrame) -> DataFrame:
    """(src, dst): one link each way between a host and its parent domain,
    that and its parent, and so on up to the name below the top domain.
    Addresses in numbers have no parents."""
    up = hosts.filter("host <> '' and not host rlike '^[0-9.:]+$'").select(suffixes(F.col("host")).alias("s"))
    both = F.flatten(F.transform(F.sequence(F.lit(1), F.size("s") - 2), lambda i: F.array(
        F.struct(F.get("s", i - 1).alias("src"), F.get("s", i).alias("dst")),
        F.struct(F.get("s", i).alias("src"), F.get("s", i - 1).alias("dst")))))
    return up.filter("size(s) >= 3").select(F.explode(both).alias("e")).select("e.src", "e.dst").distinct()


def link_graph(pages: DataFrame, parents: bool = True) -> DataFrame:
    """(src, dst, n): links between different hosts, from the absolute and
    protocol-relative href attributes of the pages (relative links stay on
    their host), and with ``parents`` those of :func:`parent_links`."""
    target = F.explode(F.regexp_extract_all("html", F.lit("""(?i)\\bhref\\s*=\\s*["']?\\s*([^"'\\s>]+)"""), F.lit(1)))
    found = (pages.select(F.col("host").alias("src"), target.alias("href"))
             .filter("href like '%//%'")
             .withColumn("href", F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href")))
             .select("src", host_of(F.col("href")).alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    if not parents:
        return found
    both = parent_links(pages.select("host").distinct())
    return (found.unionByName(both.select("src", "dst", F.lit(1).cast("long").alias("n")))
            .groupBy("src", "dst").agg(F.sum("n").alias("n")))


def propagate(seeds: DataFrame, graph: DataFrame, damping: float, rounds: int, tolerance: float) -> DataFrame:
    """(host, kind, score): both personalised PageRanks at once.  ``seeds``
    holds (host, kind, seed); kind 0 follows the links, kind 1 goes against
    them.  Ends when no score has moved by ``tolerance`` in four rounds;
    more than ``rounds`` of them are an error."""
    keys = ["host", "kind"]
    steps = (graph.select(F.col("src").alias("host"), F.col("dst").alias("to"), "n", F.lit(0).alias("kind"))
             .unionByName(graph.select(F.col("dst").alias("host"), F.col("src").alias("to"), "n", F.lit(1).alias("kind"))))
    out = written(steps.groupBy(*keys).agg(F.sum("n").alias("all"), F.count("*").alias("links")))
    total = out.agg(F.sum("links")).first()[0] or 0
    steps = written(lookup(steps, out, keys, "links", total).select(*keys, "to", (F.col("n") / F.col("all") * damping).alias("w")))
    base = seeds.select(*keys, (F.col("seed") * (1 - damping)).alias("score"))
    state = written(base)
    for _ in range(0, rounds, 4):  # written, and compared, after every four rounds
        new = state
        for _ in range(4):  # a host's one score meets its links: many links of one host are split by AQE
            moved = new.join(steps, keys).select(F.col("to").alias("host"), "kind", (F.col("score") * F.col("w")).alias("score"))
            new = base.unionByName(moved).groupBy(*keys).agg(F.round(F.sum("score"), 12).alias("score"))
        new = written(new)
        change = (new.withColumnRenamed("score", "s2").join(state, keys, "left")
                  .agg(F.max(F.abs(F.col("s2") - F.coalesce("score", F.lit(0.0))))).first()[0] or 0.0)
        state = new
        if change < tolerance:
            return state
    raise RuntimeError(f"scores still move by {change} after {rounds} rounds")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", damping: float = 0.85, rounds: int = 400, tolerance: float = 1e-4,
                limit: float = 0.5) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every page.

    ``rules`` are ("allow" or "block", "host/path") pairs.  A rule fits its
    host and all subdomains if the url's path starts with the rule's; the
    longest fitting rule decides.  Without one, the host decides: seeds are
    the share of a host's pages that allow (block) rules cover, and a host
    is blocked when its distrust exceeds its trust by more than ``limit``
    times what a wholly blocked host starts with.  Hosts that neither
    reaches are allowed.  Null urls and urls without "://" have an empty
    host and path, no rule, and are allowed.  Null html has no links.
    Repeated pages count as often as they occur; other columns are ignored.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame(
        [(a, *r.split("/", 1)) for a, r in rules] or [("", "", "")], "action string, rule_host string, rule_path string")
    table = table.filter("action <> ''").withColumn("rule_path", F.concat(F.lit("/"), "rule_path"))
    read = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    slim = read.select("id", "host", "path")
    hosts = written(slim.groupBy("host").count())
    fits = host_rules(hosts, table)
    by_host = broadcast_if_small(written(hosts.select("host").join(fits, "host", "left")))
    judged = slim.join(by_host, "host", "left").withColumn(
        "r", F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0)))
    shares = judged.groupBy("host").agg(
        F.avg(F.coalesce((F.col("r.action") == "allow").cast("double"), F.lit(0.0))).alias("a"),
        F.avg(F.coalesce((F.col("r.action") == "block").cast("double"), F.lit(0.0))).alias("b"))
    seeds = written(shares.filter("host <> ''").select(
        "host", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("a").alias("seed")),
                                  F.struct(F.lit(1).alias("kind"), F.col("b").alias("seed")))).alias("s"))
        .select("host", "s.kind", "s.seed").filter("seed > 0"))
    scores = propagate(seeds, written(link_graph(read)), damping, rounds, tolerance)
    host_scores = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"))
    full = broadcast_if_small(written(hosts.select("host").join(fits, "host", "left").join(host_scores, "host", "left")
                                      .fillna(0.0, ["trust", "distrust"])))
    final = slim.join(full, "host", "left").withColumn(
        "r", F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0)))
    own = F.when(F.col("distrust") - F.col("trust") > limit * (1 - damping), "block").otherwise("allow")
    return final.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
                        F.coalesce("r.action", own).alias("verdict"), "trust", "distrust")
