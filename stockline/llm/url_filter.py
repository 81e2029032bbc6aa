"""Allow and block verdicts for urls: rules first, the link graph for the rest.

Rules name a host and the beginning of a path; a rule fits its host and all
subdomains, and the longest fitting rule decides. For urls without a rule the
verdict is that of their host. Hosts are seeds by the share of their pages that
rules allow (trust) or block (distrust). Trust flows along host edges, distrust
against them, as two personalised PageRank vectors

    score = (1 - damping) * seed + damping * inflow

over edges weighted by the number of links. The same recursion with every host
as a seed gives what a host would receive if all were trusted, or all blocked;
the inflow as a share of that does not shrink when many hosts link to a seed,
as both are divided alike. A host's trust and distrust are that share or the
share of its own pages, whichever is larger, and it is blocked if its distrust
is at least one half and exceeds its trust. Everything is computed together
with joins and grouped sums over one row per linked pair of hosts, so a host
with a third of all pages is one node, its links being counted before any
shuffle of edges.

Defined cases: a null url or one without ``://`` has an empty host and path, no
rule and is allowed; null html has no links; links within a host are no edges;
hosts out of reach of every seed are allowed; repeated pages count each time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stockline.llm.common import stored
from stockline.session import durable

#: (host, path, verdict)
Rule = tuple[str, str, str]
#: Shares of inflow are compared rounded, as the order of a sum differs from run to run.
SHARE_DIGITS = 9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]++)"""


def host_and_path(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with ``host`` and ``path`` of the url; both empty where there is none."""
    at = F.locate("://", F.col(url_col))
    rest = F.when(at > 0, F.col(url_col).substr(at + 3, F.length(url_col))).otherwise("")
    df = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    raw = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    df = df.withColumn("_tail", F.col("_rest").substr(F.length(raw) + 1, F.length("_rest")))
    return (df.withColumn("host", F.translate(raw, _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract("_tail", r"^[^?#]*", 0)).drop("_rest", "_tail"))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule, null where none fits.

    The rules are arguments of the plan, meant for lists that a person keeps.
    """
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in reversed(ordered):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """``(src, dst, links)``: how often pages of one host link to another host."""
    links = pages.select(F.col(host_col).alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(_HREF), F.lit(1))).alias("href"))
    target = F.translate(F.regexp_extract("href", r"^(?:[a-zA-Z]+:)?//([^/?#]*)", 1), _UPPER, _LOWER)
    return (links.select("src", target.alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """``(host, trust, distrust)`` of every seed and every host of an edge, each from 0 to 1.

    ``seeds``: host, trust, distrust, at most one row per host; ``edges``: src,
    dst, links. A host passes its trust on by the share of its links, and its
    distrust by the share of the links that it receives. ``full`` is the score
    with every host as a seed, and the inflow is taken as a share of its inflow.
    ``rounds`` bounds the length of the paths counted; what longer ones add is
    below ``damping ** rounds`` of the seeds' total.
    """
    kinds = F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"))))
    both = edges.select(kinds.alias("e"), "links").select("e.*", "links")
    total = both.groupBy("kind", "a").agg(F.sum("links").alias("total"))
    shares = stored(both.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("links") / F.col("total") * damping).alias("share")), "hostedges")
    own = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, seed)"))
    linked = shares.select("kind", F.explode(F.array("a", "b")).alias("host"), F.lit(0.0).alias("seed"))
    start = stored(own.select("kind", "host", "seed").unionByName(linked).groupBy("kind", "host").agg(F.max("seed").alias("seed"))
                   .select("kind", "host", "seed", (F.col("seed") * (1 - damping)).alias("score"), F.lit(1 - damping).alias("full")), "seeds")
    restart = start.select("kind", "host", "score", "full")
    score = restart
    if not shares.isEmpty():
        for n in range(1, rounds + 1):
            inflow = score.withColumnRenamed("host", "a").join(shares, ["kind", "a"]).select(
                "kind", F.col("b").alias("host"), (F.col("score") * F.col("share")).alias("score"), (F.col("full") * F.col("share")).alias("full"))
            # The last round is the inflow alone: without the restart no rounding of a difference enters the shares.
            score = (inflow if n == rounds else restart.unionByName(inflow)).groupBy("kind", "host").agg(
                F.sum("score").alias("score"), F.sum("full").alias("full"))
            if n % 4 == 0:
                score = durable(score)
        received = score.select("kind", "host", F.round(F.col("score") / F.col("full"), SHARE_DIGITS).alias("received"))
    else:
        received = restart.limit(0).select("kind", "host", F.col("score").alias("received"))
    level = F.greatest("seed", F.coalesce("received", F.lit(0.0)))
    of = lambda kind: F.max(F.when(F.col("kind") == kind, level).otherwise(0.0)).alias(kind)
    return start.join(received, ["kind", "host"], "left").groupBy("host").agg(of("trust"), of("distrust"))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               damping: float = 0.85, rounds: int = 20, block_share: float = 0.5) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of every page.

    ``block_share``: a host is blocked if rules block this share of its pages,
    or if this share of the distrust it could receive over links arrives, and
    its trust is less.
    """
    own = host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")), "_url")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    own = own.withColumn("rule", rule).withColumn("says", says)
    share = lambda says: F.avg((F.coalesce("says", F.lit("")) == says).cast("double"))
    seeds = own.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(seeds, host_edges(own, "host", "_html"), damping, rounds)
    hosts = stored(scores.select("host", "trust", "distrust"), "hosts")
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= block_share)
    verdict = F.coalesce("says", F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow"))
    return own.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def rules_sql(rules: list[Rule]) -> tuple[str, str]:
    """The CASE expressions of ``rule`` and of its verdict over ``host`` and ``path``."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN "
    case = lambda what: "CASE " + " ".join(fits(h, p) + f"'{what(h, p, v)}'" for h, p, v in ordered) + " END"
    return case(lambda h, p, v: h + p), case(lambda h, p, v: v)


def judge_sql(rules: list[Rule], damping: float = 0.85, rounds: int = 20, block_share: float = 0.5) -> str:
    """The verdicts as DuckDB SQL: the rounds are written out one after another."""
    rule, says = rules_sql(rules)
    back = "SELECT s.kind, s.b, r.score * s.share, r.fll * s.share FROM r{} r JOIN shares s ON r.kind = s.kind AND r.host = s.a"
    steps = reduce(lambda sql, n: sql + f""",
r{n} AS MATERIALIZED (SELECT kind, host, sum(score) AS score, sum(fll) AS fll FROM (SELECT kind, host, score, fll FROM r0 UNION ALL
  {back.format(n - 1)}) x GROUP BY 1, 2)""", range(1, rounds), "")
    return rf"""
WITH cut AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw, coalesce(rest, '') AS rest FROM cut),
named AS (SELECT page_id, html, translate(raw, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
judged AS MATERIALIZED (SELECT page_id, html, host, path, {rule} AS rule, {says} AS says FROM named),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*((?:https?:)?//[^"''\s>]+)', 1)) AS href FROM judged),
targets AS (SELECT src, translate(regexp_extract(href, '^(?:[a-zA-Z]+:)?//([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS dst FROM links),
edges AS MATERIALIZED (SELECT src, dst, count(*) AS links FROM targets WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
directed AS (SELECT 'trust' AS kind, src AS a, dst AS b, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
shares AS MATERIALIZED (SELECT kind, a, b, {damping} * links / sum(links) OVER (PARTITION BY kind, a) AS share FROM directed),
seeds AS (SELECT host, avg(CASE WHEN says = 'allow' THEN 1.0 ELSE 0.0 END) AS trust, avg(CASE WHEN says = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
  FROM judged WHERE host <> '' GROUP BY 1),
own AS (SELECT 'trust' AS kind, host, trust AS seed FROM seeds UNION ALL SELECT 'distrust', host, distrust FROM seeds
  UNION ALL SELECT kind, a, 0.0 FROM shares UNION ALL SELECT kind, b, 0.0 FROM shares),
starts AS MATERIALIZED (SELECT kind, host, max(seed) AS seed FROM own GROUP BY 1, 2),
r0 AS MATERIALIZED (SELECT kind, host, seed * (1 - {damping}) AS score, (1 - {damping})::DOUBLE AS fll FROM starts){steps},
inflow AS (SELECT kind, b AS host, round(sum(score) / sum(fll), {SHARE_DIGITS}) AS received FROM ({back.format(rounds - 1)}) x (kind, b, score, fll) GROUP BY 1, 2),
levels AS (SELECT s.kind, s.host, greatest(seed, coalesce(received, 0.0)) AS level FROM starts s LEFT JOIN inflow i ON i.kind = s.kind AND i.host = s.host),
hosts AS (SELECT host, max(CASE WHEN kind = 'trust' THEN level ELSE 0 END) AS trust, max(CASE WHEN kind = 'distrust' THEN level ELSE 0 END) AS distrust
  FROM levels GROUP BY 1)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.says, CASE WHEN h.distrust > h.trust AND h.distrust >= {block_share} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN hosts h ON j.host = h.host"""
