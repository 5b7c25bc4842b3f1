"""URL filters with link-graph propagation (operator 5).

Rules judge urls directly: a rule is a domain and a path prefix, it fits the
domain and all its subdomains, the longest fitting rule wins. Urls without a
rule get the verdict of their host. The graph's hosts are those of pages and
those of links, whether they have pages or not. It has an edge for each host
that a page links to, and one in both directions between a host and its
nearest ancestor in the graph. A host's seeds are the shares of its urls that
rules allow and block: of its pages and of the other urls that different hosts
link to, where of a host with pages only links count that a rule fits. A host of
which rules block at least ``threshold``, and more than they allow, is a whole
blocked seed.

Trust is a personalised PageRank from the allowed shares along the edges,
distrust one from the blocked shares against them. Both are set against the
same walk from all hosts alike: of what reaches a host over its links, the
part that comes from allowed (blocked) seeds is what it inherits. So inheritance
is a share, whatever the number of links a host or its neighbours have. A host's
trust is its allowed share, and what it inherits for the urls that no rule
judges; its distrust alike. A host is blocked when its distrust is ``threshold``
at least and more than its trust.

Scores are joined to host edges round by round, each round written to the
shared folder, until no score changes by more than ``tolerance`` of the largest;
damping bounds the rounds that takes. A host's urls are pre-aggregated before any
shuffle, and the edges of a host with very many links are split.

Defined results: a null url or one without ``://`` has empty host and path;
empty hosts take no part in the graph and are allowed; null html has no
links; repeated rows are judged each and count each; linked urls count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.frames import skew_join
from lakeloom.llm.base import lower_ascii, written

#: Verdict and rule (domain and path prefix).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]+)([^?#]*)"
HREF = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""


def parsed(pages: DataFrame, url_col: str) -> list[Column]:
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    # the shortest text before :// comes first, so a second one in the query is not meant
    return [lower_ascii(F.regexp_extract(url, URL, 1)).alias("host"), F.regexp_extract(url, URL, 2).alias("path")]


def _rule_columns(rules) -> tuple[Column, Column]:
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # longer ones are asked first
        domain, slash, path = r.partition("/")
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def ruled(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, ruled); the last two null where no rule fits."""
    rule, verdict = _rule_columns(rules)
    base = pages.select(F.col(id_col).alias("page_id"), *parsed(pages, url_col))
    return base.select("*", rule.alias("rule"), verdict.alias("ruled"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, path), distinct: the urls on other hosts that a host's pages link to."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    own = pages.select(parsed(pages, url_col)[0], F.regexp_extract_all(html, F.lit(HREF), F.lit(1)).alias("links"))
    # a link without a host stays on its own host and is no edge
    target = lambda x: F.struct(lower_ascii(F.regexp_extract(x, LINK, 1)).alias("dst"), F.regexp_extract(x, LINK, 2).alias("path"))
    outside = F.array_distinct(F.filter(F.transform("links", target), lambda x: x["dst"] != ""))
    return own.select(F.col("host").alias("src"), F.explode(outside).alias("to")).select("src", "to.*").where("src <> '' AND src <> dst").distinct()


def host_seeds(base: DataFrame, links: DataFrame, rules=RULES) -> DataFrame:
    """(host, allowed, blocked) of every host of pages (host, path) and links: the shares of its urls that rules allow and block."""
    urls = base.where("host <> ''").select("host", "path", F.lit(1).alias("page")).union(links.select("dst", "path", F.lit(0)))
    urls = urls.groupBy("host", "path").agg(F.sum("page").alias("pages"))  # a linked page is a page
    urls = urls.select("host", "pages", F.greatest("pages", F.lit(1)).alias("n"), _rule_columns(rules)[1].alias("ruled"))
    total = lambda c, v: F.sum(F.when(v, F.col(c)).otherwise(0))
    hosts = urls.groupBy("host").agg(F.sum("pages").alias("pages"), F.sum("n").alias("n"), total("n", F.col("ruled") == "allow").alias("a"), total("n", F.col("ruled") == "block").alias("b"), total("pages", F.col("ruled").isNull()).alias("rest"))
    count = F.when(F.col("pages") > 0, F.col("a") + F.col("b") + F.col("rest")).otherwise(F.col("n"))
    return hosts.select("host", (F.col("a") / count).alias("allowed"), (F.col("b") / count).alias("blocked"))


def host_edges(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst), distinct: links between hosts, and a host and its nearest ancestor in ``hosts`` in both directions."""
    parts = F.split("host", r"\.")
    n = F.size(parts)
    # a domain name has at most 127 labels
    above = F.transform(F.filter(F.sequence(F.lit(2), F.greatest(F.lit(2), n)), lambda i: (i <= n) & (i > n - 127)), lambda i: F.struct(i.alias("skipped"), F.array_join(F.slice(parts, i, n - i + 1), ".").alias("dst")))
    ancestors = hosts.select(F.col("host").alias("src"), F.explode(above).alias("up")).select("src", "up.*").where("dst <> ''")
    found = ancestors.join(hosts.select(F.col("host").alias("dst")), "dst")
    up = found.groupBy("src").agg(F.min(F.struct("skipped", "dst")).alias("up")).select("src", "up.dst")
    return links.select("src", "dst").union(up).union(up.select(F.col("dst"), F.col("src"))).distinct()


def host_scores(hosts: DataFrame, edges: DataFrame, damping: float = 0.7, tolerance: float = 1e-4, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust, trust_share, distrust_share) from (host, allowed, blocked) seeds: both walks' scores in
    units of a seed, and as shares; ``rounds`` instead of the tolerance if given."""
    degree = edges.select(F.col("src").alias("at"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("dst", F.lit(0), F.lit(1))).groupBy("at").agg(F.sum("o").alias("out_n"), F.sum("i").alias("in_n"))
    degree = written(degree, "host-degrees")
    weighted = skew_join(edges, degree.select(F.col("at").alias("_s"), "out_n"), "src", "_s", "inner").drop("_s")
    weighted = written(skew_join(weighted, degree.select(F.col("at").alias("_d"), "in_n"), "dst", "_d", "inner").drop("_d"), "host-edges")
    seeds = written(hosts.select("host", F.col("allowed").alias("t"), F.col("blocked").alias("d"), F.lit(1.0).alias("ta"), F.lit(1.0).alias("da")), "host-seeds")
    scores, names, zero, done = seeds, ("t", "ta", "d", "da"), F.lit(0.0), 0
    while True:
        forward = skew_join(weighted, scores, "src", "host", "inner").select(F.col("dst").alias("to"), *[(F.col(c) / F.col("out_n")).alias(c) for c in ("t", "ta")], zero.alias("d"), zero.alias("da"))
        back = skew_join(weighted, scores, "dst", "host", "inner").select(F.col("src").alias("to"), zero.alias("t"), zero.alias("ta"), *[(F.col(c) / F.col("in_n")).alias(c) for c in ("d", "da")])
        got = forward.union(back).groupBy("to").agg(*[F.sum(c).alias(f"g_{c}") for c in names])
        last = scores.select(F.col("host").alias("_h"), *[F.col(c).alias(f"l_{c}") for c in names])
        step = {c: seeds[c] + F.lit(damping) * F.coalesce(F.col(f"g_{c}"), zero) for c in names}
        joined = seeds.join(got, seeds["host"] == got["to"], "left").join(last, seeds["host"] == last["_h"])
        moved = F.greatest(*[F.abs(step[c] - F.col(f"l_{c}")) for c in names])
        scores = written(joined.select(seeds["host"], *[step[c].alias(c) for c in names], moved.alias("moved")), "host-scores")
        done += 1
        change, most = scores.agg(F.max("moved"), F.max(F.greatest("ta", "da"))).first()
        scores = scores.drop("moved")
        if done == rounds or (rounds is None and (change or 0.0) <= tolerance * (most or 1.0)):
            break
    # of what came over links the part that started at seeds
    own = hosts.select(F.col("host").alias("_h"), "allowed", "blocked", F.greatest(zero, 1 - F.col("allowed") - F.col("blocked")).alias("open"))
    both = scores.join(own, scores["host"] == own["_h"])
    inherits = lambda c, seed: F.when(F.col(f"{c}a") > 1, (F.col(c) - F.col(seed)) / (F.col(f"{c}a") - 1)).otherwise(zero)
    trust, distrust = (F.col(seed) + F.col("open") * inherits(c, seed) for c, seed in (("t", "allowed"), ("d", "blocked")))
    return both.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"), trust.alias("trust_share"), distrust.alias("distrust_share"))


def judge(pages: DataFrame, rules=RULES, damping: float = 0.7, tolerance: float = 1e-4, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per input row."""
    base = ruled(pages, rules, id_col, url_col)
    links = written(host_links(pages, url_col, html_col), "links")
    hosts = written(host_seeds(base, links, rules), "hosts")
    # of a host that is blocked without any link the whole counts, not the share
    whole = (F.col("blocked") >= threshold) & (F.col("blocked") > F.col("allowed"))
    hosts = hosts.select("host", F.when(whole, F.lit(0.0)).otherwise(F.col("allowed")).alias("allowed"), F.when(whole, F.lit(1.0)).otherwise(F.col("blocked")).alias("blocked"))
    scores = host_scores(hosts, written(host_edges(links, hosts), "edges"), damping, tolerance)
    bad = scores.where((F.round("distrust_share", 6) >= threshold) & (F.round("distrust_share", 6) > F.round("trust_share", 6))).select("host", F.lit("block").alias("of_host"))
    joined = skew_join(base, written(bad, "blocked-hosts").withColumnRenamed("host", "_bad"), "host", "_bad", "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", "of_host", F.lit("allow")).alias("verdict"))
