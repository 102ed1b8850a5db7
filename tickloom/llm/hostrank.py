"""URL filter: rules for hosts and paths, and trust propagated over the link graph where no rule fits.

Trust spreads from hosts whose pages an allow rule fits, along links (personalised PageRank); distrust spreads from hosts
whose pages a block rule fits, against the links, to those that link to them. Seeds are weighted by their pages. An edge
is all links of one host to another, from the absolute references in the pages' text; a host and its parent domain, where
that is a host of a page too, are linked both ways with the weight of one link. A host whose distrust is at least
`THRESHOLD` of its trust and distrust is blocked, any other is allowed.

Everything is DataFrame operations. Links are summed to one row for each pair of hosts before any join, so a host with a
third of all pages is one row in each round, and scores are cut by checkpoints. After k rounds no more than 0.85^k of the mass
is unsettled: rounds go on until that is below `TOLERANCE` and no host is reached any more that had no score before; a graph
that isn't settled after `MOST_ROUNDS` raises.

Defined results: a null url, or one without ://, has an empty host and path, fits no rule, is no part of the graph and
is allowed; a null text has no links; repeated rows and null ids are judged like others and count as pages of their own;
hosts without any score are allowed; an empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import checkpointed, shared_folder

# Verdict, host and path of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

DAMPING = 0.85
#: Share of the seeds' mass that may be unsettled.
TOLERANCE = 1e-4
MOST_ROUNDS = 10_000
#: Rounds between checkpoints.
STEPS = 8
THRESHOLD = 0.5
#: Distrust that falls short of the threshold by so small a share, as by rounding, reaches it.
TIE = 1e-9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)href\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _ordered(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """The longest first; of equal ones a block."""
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))


def _by_rule(rules: Sequence[tuple[str, str, str]], value) -> Column:
    chosen = F.lit(None).cast("string")
    for rule in reversed(_ordered(rules)):
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        chosen = F.when(fits, F.lit(value(rule))).otherwise(chosen)
    return chosen


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and the rule's verdict."""
    cut = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    return cut.withColumns({"rule": _by_rule(rules, lambda r: r[1] + r[2]), "verdict": _by_rule(rules, lambda r: r[0])})


def _graph(ruled: DataFrame, html: str) -> tuple[DataFrame, DataFrame]:
    """(host, allowed, blocked) page counts, and (src, dst, n) links between different hosts."""
    some = ruled.where("host <> ''")
    hosts = some.groupBy("host").agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"))
    hosts = checkpointed(hosts)
    found = some.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), 1)).alias("dst"))
    links = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    above = hosts.select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("up")).where("instr(host, '.') > 0")
    parents = above.join(hosts.select(F.col("host").alias("up")), "up").select("host", "up", F.lit(1).cast("long").alias("n"))
    both = parents.select(F.col("host").alias("src"), F.col("up").alias("dst"), "n").union(parents.select("up", "host", "n"))
    return hosts, links.union(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder, whose size Spark knows when it plans a join."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scores(ruled: DataFrame, html: str = "html", tolerance: float = TOLERANCE, damping: float = DAMPING, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(host, trust, distrust) of all hosts that have any."""
    hosts, links = _graph(ruled, html)
    links = checkpointed(links)
    # Both directions in one table: trust (t) goes along a link, distrust (d) against it.
    along = links.select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "n")
    against = links.select(F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "n")
    ways = along.union(against)
    total = ways.groupBy("kind", "a").agg(F.sum("n").alias("total"))
    ways = _stored(ways.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("total")).alias("share")), "ways")
    seeds = hosts.select("host", F.explode(F.create_map(F.lit("t"), F.col("allowed"), F.lit("d"), F.col("blocked"))).alias("kind", "n")).where("n > 0")
    sums = seeds.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = _stored(seeds.join(sums, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("score")), "seeds")
    back = seeds.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"))
    settled = math.ceil(math.log(tolerance) / math.log(damping))
    current, step, reached = seeds, 0, -1
    while True:
        for _ in range(STEPS):
            sent = current.withColumnRenamed("host", "a").join(ways, ["kind", "a"]).select("kind", F.col("b").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"))
            current = sent.union(back).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        step += STEPS
        current = checkpointed(current)
        before, reached = reached, current.count()
        if step >= settled and before == reached:
            break
        if step >= most_rounds:
            raise RuntimeError(f"ranks did not settle in {step} rounds")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return current.groupBy("host").agg(of("t").alias("trust"), of("d").alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """`pages` with host, path, rule and verdict."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    ruled = with_rules(pages.select(*dict.fromkeys([*kept, url, html])), rules, url)
    blocked = scores(ruled.select("host", F.col(html).alias("html"), "verdict")).where(F.col("distrust") * (1 + TIE) >= threshold * (F.col("trust") + F.col("distrust")))
    blocked = blocked.select("host", F.lit("block").alias("by_host")).alias("found")
    judged = ruled.alias("page").join(blocked, F.col("page.host") == F.col("found.host"), "left")
    verdict = F.coalesce(F.col("page.verdict"), F.col("found.by_host"), F.lit("allow")).alias("verdict")
    return judged.select(*[F.col(f"page.`{c}`") for c in [*kept, "host", "path", "rule"]], verdict)


def report(pages: DataFrame) -> DataFrame:
    """The registered query's rows."""
    return judge(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def oracle(rounds: int = 200) -> str:
    """The same rows in DuckDB's SQL, with more rounds than the tolerance needs."""
    case = lambda value: "CASE " + " ".join(f"WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}') THEN '{value(r)}'" for r in _ordered(RULES)) + " END"
    return f"""
    WITH RECURSIVE c AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    r AS (SELECT *, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS verdict FROM c),
    h AS (SELECT host, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked FROM r WHERE host <> '' GROUP BY host),
    l AS (SELECT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?(?:https?:)?//([^/?#"''\\s>]+)', 1)), '{UPPER}', '{LOWER}') AS dst
        FROM r WHERE host <> '') WHERE src <> dst),
    p AS (SELECT a.host AS src, b.host AS dst FROM h a JOIN h b ON instr(a.host, '.') > 0 AND substr(a.host, instr(a.host, '.') + 1) = b.host),
    e AS (SELECT src, dst, count(*) AS n FROM (SELECT * FROM l UNION ALL SELECT src, dst FROM p UNION ALL SELECT dst, src FROM p) GROUP BY ALL),
    d AS (SELECT 't' AS kind, src AS a, dst AS b, n FROM e UNION ALL SELECT 'd', dst, src, n FROM e),
    w AS MATERIALIZED (SELECT kind, a, b, n / sum(n) OVER (PARTITION BY kind, a) AS share FROM d),
    s0 AS MATERIALIZED (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS score FROM (SELECT 't' AS kind, host, allowed AS n FROM h UNION ALL SELECT 'd', host, blocked FROM h) WHERE n > 0),
    s AS (SELECT 0 AS i, kind, host, score FROM s0 UNION ALL
        SELECT i + 1, kind, host, sum(score) FROM (SELECT i, w.kind, w.b AS host, score * share * {DAMPING} AS score FROM s JOIN w ON w.kind = s.kind AND w.a = s.host
            UNION ALL SELECT i, s0.kind, s0.host, s0.score * {1 - DAMPING} FROM s0 JOIN (SELECT DISTINCT i FROM s) ON true) WHERE i < {rounds} GROUP BY i, kind, host),
    f AS (SELECT host, coalesce(sum(score) FILTER (kind = 't'), 0) AS t, coalesce(sum(score) FILTER (kind = 'd'), 0) AS d FROM s WHERE i = {rounds} GROUP BY host)
    SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.verdict, CASE WHEN f.d * (1 + {TIE}) >= {THRESHOLD} * (f.t + f.d) THEN 'block' END, 'allow') AS verdict
    FROM r LEFT JOIN f USING (host)"""
