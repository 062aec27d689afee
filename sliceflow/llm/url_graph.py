"""Operator 4: URL filter by rules and link-graph propagation.

Rules judge the urls they fit. For the others, hosts are judged by their
neighbours: personalised PageRank spreads trust from hosts that the rules
allow along links, and distrust from hosts that they block against links (who
links to blocked hosts is distrusted). A host whose distrust reaches a
threshold and exceeds its trust is blocked. All work is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sliceflow.llm.common import discard, spill

#: (verdict, host and path), in any order
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
#: rounds that the DuckDB statement writes out; Spark goes on until nothing moves
ROUNDS = 10
#: at rest: what two rounds add to all trust, and to the distrust of any host
TOLERANCE = 1e-6
#: a host is blocked from this distrust on; 1 is a host of which all urls are blocked
THRESHOLD = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: targets of links with a host of their own
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null and without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else null. A rule fits
    its host and all subdomains, if the path starts with the rule's."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (rule, verdict) if rule is not None else (none, none)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, from rows (host, html).
    Weights of a source add up to 1. Links of a host are counted before the
    shuffle, so a host with a third of all pages is reduced early."""
    link = F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1))
    found = (pages.where("host != '' and html is not null").select(F.col("host").alias("src"), link.alias("url"))
             .select("src", url_host(F.when(F.col("url").startswith("//"), F.concat(F.lit("x:"), "url")).otherwise(F.col("url"))).alias("dst"))
             .where("dst != '' and dst != src").groupBy("src", "dst").agg(F.count("*").cast("double").alias("n")))
    total = found.groupBy("src").agg(F.sum("n").alias("total"))
    return found.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) at rest, and the number of ``rounds`` as an attribute, of
    ``trust = seed + damping * sum of weight * trust of those that link here`` and
    ``distrust = seed + damping * sum of weight * distrust of those linked from here``,
    both divided by what a blocked or trusted host without links has. A
    round is a join on each end and a sum with partial aggregates; every second one is
    written to the shared folder and compared with the one before. Both only grow;
    all trust together and the largest distrust move less by the damping in each round,
    so the rounds end.
    """
    edges = spill(edges, "edges")
    nodes = seeds.select("host", "trust", "distrust").unionByName(
        edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))).unionByName(
        edges.select(F.col("src").alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust")))
    start = spill(nodes.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "seeds")
    now, before = start, None
    now.rounds = rounds = 0
    if edges.isEmpty():
        return now
    while True:
        forth = edges.join(now, edges["src"] == now["host"]).select(F.col("dst").alias("host"), (F.col("weight") * F.col("trust")).alias("trust"), F.lit(0.0).alias("distrust"))
        back = edges.join(now, edges["dst"] == now["host"]).select(F.col("src").alias("host"), F.lit(0.0).alias("trust"), (F.col("weight") * F.col("distrust")).alias("distrust"))
        moved = forth.unionByName(back).select("host", (damping * F.col("trust")).alias("trust"), (damping * F.col("distrust")).alias("distrust"))
        now = start.unionByName(moved).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        rounds += 1
        if rounds % 2:
            continue
        now = spill(now, "ranks")
        now.rounds = rounds
        old = (start if before is None else before).select("host", F.col("trust").alias("_t"), F.col("distrust").alias("_d"))
        more = now.join(old, "host").agg(F.sum(F.abs(F.col("trust") - F.col("_t"))).alias("t"), F.max(F.abs(F.col("distrust") - F.col("_d"))).alias("d")).first()
        if before is not None:
            discard(before)
        before = now
        if more["t"] < tolerance and more["d"] < tolerance:
            return now


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    The seed of a host is the share of its urls that rules allow (trust) and
    block (distrust). Null urls and urls without ``://`` have empty host and
    path; they fit no rule and are allowed. Null html has no links. Repeated
    rows are judged each and count as often; other columns are ignored; an
    empty table gives no rows.
    """
    base = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    base = base.select("page_id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = base.select("page_id", "html", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    share = lambda kind: F.avg(F.when(F.col("by_rule") == kind, 1.0).otherwise(0.0))
    seeds = judged.where("host != ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    rank = propagate(seeds, host_edges(judged.select("host", "html")))
    bad = rank.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select("host", F.lit("block").alias("by_host"))
    return (judged.drop("html").join(bad, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict")))


def op4_url_graph(spark, sf_dir):
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _oracle() -> str:
    """The same in DuckDB; the rounds are written out."""
    fits, verdict = [], []
    for kind, text in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        at, slash, rest = text.partition("/")
        test = f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{slash}{rest}')"
        fits.append(f"WHEN {test} THEN '{text}'")
        verdict.append(f"WHEN {test} THEN '{kind}'")
    host = lambda c: f"coalesce(translate(regexp_extract({c}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')"
    link = r"""(?i)\bhref\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"''<>]+)"""
    out = [f"""WITH base AS (SELECT page_id, html, {host('url')} AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
judged AS (SELECT *, CASE {' '.join(fits)} END AS rule, CASE {' '.join(verdict)} END AS by_rule FROM base),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS url FROM judged WHERE host <> ''),
ends AS (SELECT src, {host("CASE WHEN starts_with(url, '//') THEN 'x:' || url ELSE url END")} AS dst FROM links),
counted AS (SELECT src, dst, count(*)::DOUBLE AS n FROM ends WHERE dst <> '' AND dst <> src GROUP BY ALL),
edges AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS weight FROM counted),
r0 AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
 SELECT host, avg(CASE WHEN by_rule = 'allow' THEN 1.0 ELSE 0.0 END) AS trust, avg(CASE WHEN by_rule = 'block' THEN 1.0 ELSE 0.0 END) AS distrust FROM judged WHERE host <> '' GROUP BY host
 UNION ALL SELECT dst, 0, 0 FROM edges UNION ALL SELECT src, 0, 0 FROM edges) GROUP BY host)"""]
    for i in range(ROUNDS):
        out.append(f"""r{i + 1} AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (SELECT * FROM r0
 UNION ALL SELECT e.dst, {DAMPING} * weight * trust, 0 FROM edges e JOIN r{i} r ON r.host = e.src
 UNION ALL SELECT e.src, 0, {DAMPING} * weight * distrust FROM edges e JOIN r{i} r ON r.host = e.dst) GROUP BY host)""")
    return ",\n".join(out) + f"""
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN r.distrust >= {THRESHOLD} AND r.distrust > r.trust THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN r{ROUNDS} r USING (host)"""


ORACLE = _oracle()
