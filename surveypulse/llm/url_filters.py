"""URL filters: rules first, then trust and distrust spread over the links between hosts.

**Rules.** A rule (verdict, host, path) fits its host and all subdomains where the url's path starts with
the rule's; the longest one decides. The host of a url is what stands between the first ``://`` and the
next ``/``, ``?``, ``#`` or end, A-Z lower-cased; the path goes on to ``?``, ``#`` or the end. A null url or
one without ``://`` has an empty host and path and fits no rule.

**Links.** A host's pages link to other hosts by absolute (``scheme://host``, ``//host``) references in
``href``; links within a host say nothing about it. Edges are counted links between different hosts.

**Propagation.** Pages that a rule allows are seeds of trust at their host, pages that a rule blocks seeds
of distrust, in pages. A host that is only linked to counts as one page, its start page. Personalised
PageRank carries trust from a host to those it links to, and distrust backwards, from a host to those
that link to it, each in proportion to the links; hosts with nowhere to send it keep it. Scores are
rounded to nine decimals each round, and rounds end when none changes, or after ``rounds``.

**Verdict.** A page with a rule has the rule's. Any other page is blocked if distrust less trust of its
host, per page of the host, is at least ``threshold``; a page without a host is allowed.

**Edge cases.** Null html has no links. Repeated pages count again, in scores and in the result. An empty
table gives no rows. Other columns are ignored, whatever their names.

**Scale.** DataFrame functions only. Pages are aggregated to hosts and pairs of hosts before any shuffle;
rounds join these tables only, and each is written, so lineage stays short. Joins broadcast the table of
scores only where its bytes are measured, and spread a hub's edges otherwise. ``rules`` is a short list
that travels in the plan, some thousands at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import written
from surveypulse.operators.joins import join_sized

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING, THRESHOLD, ROUNDS, DIGITS = 0.85, 0.5, 30, 9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""[Hh][Rr][Ee][Ff][\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x00-\x20]+)"""

Rules = Sequence[tuple[str, str, str]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest_first(rules: Rules) -> Rules:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))


def fitting(host: Column, path: Column, rules: Rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, over, below in reversed(_longest_first(rules)):
        fits = ((host == over) | F.endswith(host, F.lit("." + over))) & F.startswith(path, F.lit(below))
        found = F.when(fits, F.struct(F.lit(over + below).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """``source, target, links``: counted references from the pages of one host to another host."""
    host, _ = host_and_path(F.col("url"))
    named = F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))
    links = pages.select(host.alias("source"), F.explode(named).alias("target"))
    links = links.withColumn("target", F.translate("target", UPPER, LOWER))
    return links.where("source <> '' AND source <> target").groupBy("source", "target").agg(F.count("*").alias("links"))


def seeds(pages: DataFrame, edges: DataFrame, rules: Rules = RULES) -> DataFrame:
    """``host, pages, trusted, distrusted``: every host with pages or links, and its seeds in pages."""
    host, path = host_and_path(F.col("url"))
    count = lambda verdict: F.count_if(F.col("fit.verdict") == verdict)
    own = pages.select(host.alias("host"), fitting(host, path, rules).alias("fit")).where("host <> ''")
    sums = [F.count("*").alias("pages"), count("allow").alias("trusted"), count("block").alias("distrusted")]
    own = own.groupBy("host").agg(*sums)
    linked = edges.select(F.col("target").alias("host")).union(edges.select("source")).distinct().join(own, "host", "left_anti")
    return own.union(linked.withColumn("fit", fitting(F.col("host"), F.lit("/"), rules)).groupBy("host").agg(*sums))


def propagated(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host, pages, trust, distrust`` after the rounds; both tables are written ones."""
    out = edges.groupBy(F.col("source").alias("host")).agg(F.sum("links").alias("out"))
    into = edges.groupBy(F.col("target").alias("host")).agg(F.sum("links").alias("into"))
    nodes = written(hosts.join(out, "host", "left").join(into, "host", "left"))
    forth = join_sized(edges.withColumnRenamed("source", "host"), nodes.select("host", "out"), ["host"], "inner", spread=["target"]).select(
        "host", F.col("target").alias("to"), (F.col("links") / F.col("out")).alias("trust_share"), F.lit(0.0).alias("distrust_share"))
    back = join_sized(edges.withColumnRenamed("target", "host"), nodes.select("host", "into"), ["host"], "inner", spread=["source"]).select(
        "host", F.col("source").alias("to"), F.lit(0.0).alias("trust_share"), (F.col("links") / F.col("into")).alias("distrust_share"))
    flows = written(forth.union(back))
    now = nodes.select("*", F.col("trusted").cast("double").alias("trust"), F.col("distrusted").cast("double").alias("distrust"))
    for _ in range(rounds):
        sent = join_sized(flows, now.select("host", "trust", "distrust"), ["host"], "inner", spread=["to"])
        got = sent.groupBy(F.col("to").alias("host")).agg(
            F.sum(F.col("trust") * F.col("trust_share")).alias("got_trust"),
            F.sum(F.col("distrust") * F.col("distrust_share")).alias("got_distrust"))
        # A host with nowhere to send its score keeps it.
        kept = lambda score, ways: F.when(F.col(ways).isNull(), F.col(score)).otherwise(0.0)
        step = lambda seed, got, score, ways: F.round(
            (1 - damping) * F.col(seed) + damping * (F.coalesce(got, F.lit(0.0)) + kept(score, ways)), DIGITS)
        after = written(now.join(got, "host", "left").withColumns({
            "new_trust": step("trusted", "got_trust", "trust", "out"),
            "new_distrust": step("distrusted", "got_distrust", "distrust", "into")}).drop("got_trust", "got_distrust"))
        settled = after.where("new_trust <> trust OR new_distrust <> distrust").isEmpty()
        now = after.drop("trust", "distrust").withColumnsRenamed({"new_trust": "trust", "new_distrust": "distrust"})
        if settled:
            break
    return now.select("host", "pages", "trust", "distrust")


def url_verdicts(pages: DataFrame, rules: Rules = RULES, damping: float = DAMPING, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (page_id, url, html)."""
    edges = written(host_links(pages))
    scores = propagated(written(seeds(pages, edges, rules)), edges, damping, rounds)
    bad = scores.where((F.col("distrust") - F.col("trust")) / F.col("pages") >= threshold).select("host", F.lit(True).alias("bad"))
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), fitting(host, path, rules).alias("fit"))
    by_host = F.when(F.col("bad"), "block").otherwise("allow")
    return join_sized(judged, bad, ["host"], "left", spread=["page_id", "path"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_host).alias("verdict"))


def oracle(rules: Rules = RULES, damping: float = DAMPING, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> str:
    """SQL with one step per round."""
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    fit = lambda host, path: f"""(SELECT max_by({{'rule': r.h || r.p, 'verdict': r.v}}, length(r.h || r.p)) FROM rules r
      WHERE ('.' || {host}) LIKE ('%.' || r.h) AND starts_with({path}, r.p))"""  # noqa: E731
    link = _LINK.replace("'", "''")
    steps = []
    for i in range(rounds):
        side = lambda seed, score, got, ways, i=i: (
            f"round((1 - {damping}) * {seed} + {damping} * (coalesce({got}, 0) + CASE WHEN {ways} IS NULL THEN {score} ELSE 0 END), {DIGITS}) AS {score}")
        steps.append(f"""s{i + 1} AS MATERIALIZED (SELECT s.host, pages, n_out, n_in, good, ill, {side("good", "trust", "gt", "n_out")}, {side("ill", "distrust", "gd", "n_in")}
  FROM s{i} s LEFT JOIN (SELECT e.b AS host, sum(x.trust * n / x.n_out) AS gt FROM e JOIN s{i} x ON x.host = e.a GROUP BY 1) f ON f.host = s.host
  LEFT JOIN (SELECT e.a AS host, sum(x.distrust * n / x.n_in) AS gd FROM e JOIN s{i} x ON x.host = e.b GROUP BY 1) g ON g.host = s.host)""")
    return f"""WITH rules(v, h, p) AS (VALUES {listed}),
u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS MATERIALIZED (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS MATERIALIZED (SELECT page_id, host, path, {fit("host", "path")} AS fit FROM h),
l AS (SELECT host AS a, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS b FROM h WHERE host <> ''),
e AS MATERIALIZED (SELECT a, b, count(*) AS n FROM l WHERE a <> b GROUP BY 1, 2),
o AS (SELECT host, count(*) AS pages, count(*) FILTER (WHERE fit.verdict = 'allow') AS good, count(*) FILTER (WHERE fit.verdict = 'block') AS ill
      FROM j WHERE host <> '' GROUP BY 1),
x AS (SELECT b AS host FROM e WHERE b NOT IN (SELECT host FROM o) GROUP BY 1),
n AS (SELECT * FROM o UNION ALL SELECT host, 1, CASE WHEN fit.verdict = 'allow' THEN 1 ELSE 0 END, CASE WHEN fit.verdict = 'block' THEN 1 ELSE 0 END
      FROM (SELECT host, {fit("host", "'/'")} AS fit FROM x)),
s0 AS MATERIALIZED (SELECT n.host, pages, n_out, n_in, good, ill, good::DOUBLE AS trust, ill::DOUBLE AS distrust FROM n
  LEFT JOIN (SELECT a, sum(n) AS n_out FROM e GROUP BY 1) p ON p.a = n.host LEFT JOIN (SELECT b, sum(n) AS n_in FROM e GROUP BY 1) q ON q.b = n.host),
{", ".join(steps)}
SELECT page_id, j.host, path, fit.rule AS rule,
  coalesce(fit.verdict, CASE WHEN (distrust - trust) / pages >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN s{rounds} s ON s.host = j.host"""
