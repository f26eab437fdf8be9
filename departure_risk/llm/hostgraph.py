"""Url verdicts by rules, and by trust and distrust that flow over the links between hosts.

A rule (host, path, verdict) fits urls of its host and all its subdomains whose path starts with the rule's; the longest rule
wins. Urls without a rule get their host's verdict from the link graph:

1. Links in the pages make edges between different hosts, weighted by the number of linking pages.
2. A host's seed is (pages allowed by rules - pages blocked by rules) / pages: trusted if positive, blocked if negative.
3. Trust is a personalised PageRank from the trusted seeds along the links; distrust is one from the blocked seeds against
   them: who links to blocked hosts is distrusted. A linked host divides its distrust among all who link to it, so besides
   these masses there are two means: exposure, over a host's own links, of the distrust they lead to, and standing, over the
   links to a host, of the trust they come from. No number of other linkers makes them smaller. All four share one iteration
   over the host edges until no host changes by more than `tolerance` or after `rounds`.
4. A host is blocked if its distrust exceeds its trust, or its exposure both its standing and its trust, by more than
   `threshold`; the seed's own part is (1 - damping). The means are an addition to the PageRanks (`means` turns them off).

Only columns and SQL functions are used. Pages are read and never shuffled while the hosts are few enough for Spark to
broadcast; edges and ranks are tables of hosts, written each round.

Defined cases: a null url or one without :// has an empty host and path, fits no rule, has no edge and is allowed; null html
has no link; relative links stay on their host and are no edge; hosts that no page is from get ranks too, for what they pass
on; rows that repeat an id get a verdict each; extra columns are ignored; an empty table gives no row.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from departure_risk.session import written_once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
RULE = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A to Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host and rules: those that fit the host, the longest first (ties by code point)."""
    labels = F.split("host", r"\.")
    # no more labels than the longest rule has
    most = rules.agg(F.coalesce(F.max(F.size(labels)), F.lit(1))).first()[0]
    suffix = F.explode(F.transform(F.sequence(F.greatest(F.size(labels) - most + 1, F.lit(1)), F.size(labels)),
                                   lambda i: F.concat_ws(".", F.slice(labels, i, F.lit(most)))))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), "verdict")
    rule = F.struct((-F.length(F.concat("suffix", "rule_path"))).alias("order"), F.concat("suffix", "rule_path").alias("rule"),
                    F.col("rule_path").alias("path"), "verdict")
    return hosts.select("host", suffix.alias("suffix")).join(named, "suffix").groupBy("host").agg(F.sort_array(F.collect_list(rule)).alias("rules"))


def ruled(pages: DataFrame, host_table: DataFrame) -> DataFrame:
    """Pages (with host and path) and the columns of `host_table`, with `found`: the rule that wins, or null."""
    joined = pages.join(host_table, "host", "left")
    return joined.withColumn("found", F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0)))


def link_edges(pages: DataFrame) -> DataFrame:
    """src, dst and weight (pages of src that link to dst), of pages with host and html; no host links to itself."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)
    absolute = F.transform(F.filter(links, lambda x: x.rlike("^([a-zA-Z][a-zA-Z0-9+.-]*:)?//")), lambda x: host_of(F.concat(F.lit("x"), F.regexp_replace(x, "^[^/]*//", "://"))))
    others = F.array_distinct(F.filter(absolute, lambda h: (h != "") & (h != F.col("host"))))
    return pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(others).alias("dst")).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 30, tolerance: float = 1e-6) -> DataFrame:
    """host, trust, distrust, standing and exposure of every host in `seeds` (host, seed from -1 to 1) or `edges` (src, dst, weight).

    trust(v) = (1 - damping) * max(seed, 0) + damping * sum over u linking to v of trust(u) * share of u's links to v;
    distrust(u) = (1 - damping) * max(-seed, 0) + damping * sum over v that u links to of distrust(v) * share of v's links from u;
    standing(v) and exposure(u) are the same with the shares of the other end: of v's links from u, and of u's links to v.
    """
    ranked = ["trust", "distrust", "standing", "exposure"]
    out = edges.groupBy("src").agg(F.sum("weight").alias("sent"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("got"))
    shares = written_once(edges.join(out, "src").join(into, "dst").select(
        "src", "dst", (F.col("weight") / F.col("sent")).alias("forward"), (F.col("weight") / F.col("got")).alias("backward")), "host-edges")
    hosts = shares.select(F.col("src").alias("host")).unionByName(shares.select(F.col("dst").alias("host"))).distinct()
    base = hosts.join(seeds, "host", "full").select("host", F.coalesce("seed", F.lit(0.0)).alias("seed"))
    trusted, blocked = ((1 - damping) * F.greatest(sign * F.col("seed"), F.lit(0.0)) for sign in (1, -1))
    ranks = base = written_once(base.select("host", *[c.alias(n) for n, c in zip(ranked, [trusted, blocked] * 2)]), "host-ranks")
    if not shares.head(1):
        return ranks

    def passed(end: str, other: str, **by: str) -> DataFrame:
        """What the hosts at one end of the edges give to those at the other."""
        return ranks.select(F.col("host").alias(end), *by).join(shares, end).select(F.col(other).alias("host"), *[
            (damping * F.col(n) * F.col(by[n]) if n in by else F.lit(0.0)).alias(n) for n in ranked])

    for _ in range(rounds):
        given = passed("src", "dst", trust="forward", standing="backward")
        back = passed("dst", "src", distrust="backward", exposure="forward")
        new = written_once(base.unionByName(given).unionByName(back).groupBy("host").agg(*[F.sum(n).alias(n) for n in ranked]), "host-ranks")
        old = ranks.select("host", *[F.col(n).alias(f"old_{n}") for n in ranked])
        change = new.join(old, "host").agg(F.max(F.greatest(*[F.abs(F.col(n) - F.col(f"old_{n}")) for n in ranked]))).first()[0]
        ranks = new
        if change < tolerance:
            break
    return ranks


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
           html_col: str = "html", threshold: float = 0.05, means: bool = True, **options) -> DataFrame:
    """page_id, host, path, rule (host and path of the winning rule, or null) and verdict (allow or block), per row.

    means=False: the two PageRanks alone decide.
    """
    spark: SparkSession = pages.sparkSession
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).cast("string").alias("html"))
    narrow = parsed.drop("html")
    of_host = written_once(host_rules(narrow.select("host").distinct(), spark.createDataFrame(rules, RULE)), "host-rules")
    seeds = written_once(ruled(narrow, of_host).groupBy("host").agg(
        F.count_if(F.col("found.verdict") == "allow").alias("allowed"), F.count_if(F.col("found.verdict") == "block").alias("blocked"),
        F.count(F.lit(1)).alias("pages")).select("host", ((F.col("allowed") - F.col("blocked")) / F.col("pages")).alias("seed")), "host-seeds")
    ranks = propagate(seeds, written_once(link_edges(parsed), "host-links"), **options)
    excess = F.col("distrust") - F.col("trust")
    if means:
        excess = F.greatest(excess, F.col("exposure") - F.greatest("trust", "standing"))
    hosts = written_once(seeds.join(ranks, "host", "left").join(of_host, "host", "left").select(
        "host", "rules", (F.coalesce(excess, F.lit(0.0)) > threshold).alias("bad")), "hosts")
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("bad") & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow")))
    return ruled(narrow, hosts).select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))
