"""URL filters: rules, and for the rest link-graph propagation over hosts.

Rules (a host with all its subdomains, and a path prefix) decide what they fit;
the longest wins. Other urls get the verdict of their host: hosts are nodes,
links between pages and the steps from a subdomain to its parent domain and
back are edges. Trust is a personalised PageRank that starts from each host's
share of all allowed pages and follows edges; distrust starts from its share of
all blocked pages and follows edges backwards, to who links there. A host is
blocked if its distrust exceeds its trust by more than the fraction ``TIE``
(sums of doubles differ between runs by far less).

Host edges are distinct before they are used and every round is one join and
one aggregate of them, so a host that a third of all pages link to is one row
per linking host. A round has a task for every ``RUN`` edges at least, so that
small graphs do not leave thousands of small files. Ranks only grow from round to round; they are checkpointed
every ``CUT`` rounds, and the rounds end when all ranks together (2 at most)
grew by less than ``SETTLED`` since the last checkpoint. What is still to come
is then under a fourth of that. They fail after ``ROUNDS``, which damping rules
out: what comes after k rounds is under 2 * 0.85 ** k.

Hosts to block are joined to the pages by a broadcast if there are at most
``FEW_HOSTS``; more are joined by a shuffle, of which adaptive execution splits
the hosts with very many pages.

Defined results: a null url or one without :// has empty host and path, fits no
rule and gets the verdict of the empty host; null html has no links; repeated
rows count as pages of their own; hosts that nothing reaches are allowed; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared as sh

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DAMPING = 0.85
ROUNDS = 100
CUT = 10
SETTLED = 1e-3
TIE = 1e-6
FEW_HOSTS = 200_000
#: Distrust over trust from which a host is blocked.
RATIO = 1.0
LINK = r"""(?i)(?:href|src)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    body = F.coalesce(url, F.lit(""))
    return sh.lower_ascii(F.regexp_extract(body, r"(?s)\A.*?://([^/?#]*)", 1)), F.regexp_extract(body, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> Column:
    """Struct of the longest rule that fits (as text) and its verdict; nulls if none does."""
    none = F.lit(None).cast("string")
    out = F.struct(none.alias("rule"), none.alias("verdict"))
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _parents(host: Column) -> Column:
    """Pairs of each domain from the host up and the one above it, down to two labels."""
    labels = F.split(host, r"\.")
    from_ = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    steps = F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda i: F.struct(from_(i).alias("a"), from_(i + 1).alias("b")))
    return F.when(F.size(labels) > 2, steps).otherwise(F.array().cast("array<struct<a: string, b: string>>"))


def edges(pages: DataFrame) -> DataFrame:
    """Distinct (a, b) over hosts, from columns host and html."""
    links = pages.select(F.col("host").alias("a"), F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))).alias("b")).select("a", sh.lower_ascii(F.col("b")).alias("b"))
    links = links.where("a <> b and a <> ''").distinct()
    hosts = pages.select("host").union(links.select("b")).distinct()
    up = hosts.select(F.explode(_parents(F.col("host"))).alias("s")).select("s.a", "s.b").distinct()
    return links.union(up).union(up.select("b", "a")).distinct()


def ranks(seeds: DataFrame, graph: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(host, trust, distrust). seeds: (host, allowed, blocked); graph: (a, b)."""
    way = graph.select(F.lit(0).alias("kind"), "a", "b").union(graph.select(F.lit(1), F.col("b"), F.col("a")))
    degree = way.groupBy("kind", "a").agg(F.count("*").alias("degree"))
    way = sh.cut(way.join(degree, ["kind", "a"]).select("kind", "a", "b", (F.lit(damping) / F.col("degree")).alias("share")))
    n = sh.run_count(way.count())
    way = way.coalesce(n)
    start = sh.cut(seeds.select("host", F.stack(F.lit(2), F.lit(0), F.col("allowed"), F.lit(1), F.col("blocked")).alias("kind", "n")).where("n > 0"))
    total = {r.kind: r.n for r in start.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    all_ = F.when(F.col("kind") == 0, F.lit(total.get(0, 1))).otherwise(F.lit(total.get(1, 1)))
    base = sh.cut(start.select("kind", F.col("host").alias("b"), (F.col("n") * F.lit(1 - damping) / all_).alias("r"))).coalesce(n)
    now, mass = base, 0.0
    for _ in range(ROUNDS // CUT):
        for _ in range(CUT):
            moved = way.join(now.select("kind", F.col("b").alias("a"), "r"), ["kind", "a"]).select("kind", "b", (F.col("r") * F.col("share")).alias("r"))
            now = moved.union(base).groupBy("kind", "b").agg(F.sum("r").alias("r")).coalesce(n)
        now = sh.cut(now)
        before, mass = mass, now.agg(F.coalesce(F.sum("r"), F.lit(0.0))).first()[0]
        if mass - before < settled:
            break
    else:
        raise RuntimeError(f"ranks did not settle in {ROUNDS} rounds")
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("r"))), F.lit(0.0))
    return now.groupBy(F.col("b").alias("host")).agg(pick(0).alias("trust"), pick(1).alias("distrust"))


def judge(df: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``df``."""
    host, path = host_and_path(F.col(url))
    own = df.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    own = own.withColumn("of", rule_of(F.col("host"), F.col("path"), rules))
    count = lambda v: F.count_if(F.col("of.verdict") == v)
    seeds = own.groupBy("host").agg(count("allow").alias("allowed"), count("block").alias("blocked"))
    found = ranks(seeds, edges(own))
    bad = sh.cut(found.where(F.col("distrust") > F.col("trust") * F.lit(RATIO * (1 + TIE))).select(F.col("host").alias("__bad")))
    out = own.drop("html").join(F.broadcast(bad) if bad.count() <= FEW_HOSTS else bad, own.host == bad["__bad"], "left")
    verdict = F.coalesce("of.verdict", F.when(F.col("__bad").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("of.rule").alias("rule"), verdict.alias("verdict"))


def op3_url_trust(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``pages``."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = LINK.replace("'", "''")
    cases = {k: " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{out}'" for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])) for out in [h + p if k == "rule" else v]) for k in ("rule", "verdict")}
    return rf"""
WITH RECURSIVE p AS (SELECT page_id, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, coalesce(html, '') AS html FROM pages),
o AS (SELECT page_id, host, path, html, CASE {cases['rule']} END AS rule, CASE {cases['verdict']} END AS verdict FROM p),
l AS (SELECT DISTINCT a, b FROM (SELECT host AS a, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS b FROM o) WHERE a <> b AND a <> ''),
h AS (SELECT host FROM o UNION SELECT b FROM l),
u AS (SELECT DISTINCT array_to_string(x[i:], '.') AS a, array_to_string(x[i + 1:], '.') AS b FROM (SELECT string_split(host, '.') AS x, unnest(range(1, len(string_split(host, '.')) - 1)) AS i FROM h)),
e AS (SELECT a, b FROM l UNION SELECT a, b FROM u UNION SELECT b, a FROM u),
y AS (SELECT 0 AS kind, a, b FROM e UNION ALL SELECT 1, b, a FROM e),
w AS MATERIALIZED (SELECT kind, a, b, {DAMPING}::DOUBLE / count(*) OVER (PARTITION BY kind, a) AS share FROM y),
s AS (SELECT 0 AS kind, host AS b, count(*) FILTER (WHERE verdict = 'allow') AS n FROM o GROUP BY host UNION ALL SELECT 1, host, count(*) FILTER (WHERE verdict = 'block') FROM o GROUP BY host),
r0 AS MATERIALIZED (SELECT kind, b, n * (1 - {DAMPING}::DOUBLE) / sum(n) OVER (PARTITION BY kind) AS r FROM s WHERE n > 0),
r AS (SELECT 0 AS k, kind, b, r FROM r0 UNION ALL
      SELECT min(k), kind, b, sum(r) FROM (SELECT r.k + 1 AS k, w.kind, w.b, r.r * w.share AS r FROM r JOIN w ON w.kind = r.kind AND w.a = r.b WHERE r.k < {ROUNDS}
                                           UNION ALL SELECT t.k, r0.* FROM r0, (SELECT min(k) + 1 AS k FROM r) t WHERE t.k <= {ROUNDS}) GROUP BY kind, b),
f AS (SELECT b AS host, coalesce(sum(r) FILTER (WHERE kind = 0), 0) AS trust, coalesce(sum(r) FILTER (WHERE kind = 1), 0) AS distrust FROM r WHERE k = {ROUNDS} GROUP BY b),
bad AS (SELECT host FROM f WHERE distrust > trust * {RATIO * (1 + TIE)}::DOUBLE)
SELECT page_id, o.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM o LEFT JOIN bad ON o.host = bad.host
"""


SQL = _sql()
