"""Allow and block rules for URLs, with trust and distrust over the link graph of hosts.

A page that a rule fits gets the rule's verdict. The others go by their host. Hosts at least half of whose
pages the rules allow are trusted seeds, those at least half of whose pages they block are
blocked seeds. Trust starts at the trusted seeds and follows the links between hosts
(personalised PageRank); distrust starts at the blocked seeds and follows them backwards,
since a host that links to blocked ones is suspect. A host is blocked if distrust is more than
its share of both.

Ranks are whole numbers out of ``SCALE`` and every step rounds down, so sums don't depend on
their order: reruns and other engines find the same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.session import materialize

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
SCALE = 10**12
# Of 100: what a step follows along links; the rest goes back to the seeds.
FOLLOW = 85
TURNS = 20
# Of 100: a host with more distrust than this in trust and distrust is blocked.
THRESHOLD = 50
# Of 100: the share of a host's pages that the rules must decide alike to make it a seed.
SEED = 50

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# The host of links that name one; others stay on their own host.
LINK_PATTERN = r"""(?i)<a(?:rea)?[\x20\x09-\x0D](?:[^>]*?[\x20\x09-\x0D"'])?href[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\x20\x09-\x0D"'<>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the path, A-Z in lower case; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PATTERN, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits, else null; of equally long ones that of the longer host."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1])):
        name, slash, rest = rule.partition("/")
        here = (host == name) | F.endswith(host, F.lit("." + name))
        fits.append(F.when(here & F.startswith(path, F.lit(slash + rest)), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: int = THRESHOLD, turns: int = TURNS,
          id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row.

    A null URL or one without ``://`` has an empty host and path, fits no rule, has no ranks
    and is allowed, as is every host that neither trust nor distrust reaches. Null and empty
    pages link to nothing. Rows that repeat are judged each and count as pages each; null ids stay
    null; an empty table gives no rows. ``rules`` is a list for one plan: some hundreds at most.
    """
    url = F.col(f"`{url_column}`").cast("string")
    read = pages.select(F.col(f"`{id_column}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        linked_hosts(F.col(f"`{html_column}`").cast("string")).alias("links"))
    read = materialize(read.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)), "pages")
    ruling = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(verdict)) for verdict, rule in rules], F.lit(None).cast("string"))
    seeds = seed_hosts(read.select("host", ruling.alias("verdict")))
    found = ranks(host_moves(read), seeds, turns)
    judged = found.groupBy("host").pivot("kind", ["trust", "distrust"]).agg(F.sum("rank"))
    trust, distrust = (F.coalesce(k, F.lit(0)).alias(k) for k in ("trust", "distrust"))
    # Hosts whose links bring them nothing have no row; a host may have a third of all pages, so
    # the join is one that can be split there.
    joined = read.select("page_id", "host", "path", "rule").join(judged, "host", "left")
    blocked = 100 * F.coalesce("distrust", F.lit(0)) > threshold * (F.coalesce("trust", F.lit(0)) + F.coalesce("distrust", F.lit(0)))
    verdict = F.coalesce(ruling, F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust, distrust)


def linked_hosts(html: Column) -> Column:
    """The distinct hosts that the page's links name."""
    found = F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(1))
    return F.array_distinct(F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER)))


def seed_hosts(pages: DataFrame) -> DataFrame:
    """(kind, host, seed) from rows (host, verdict or null): each kind's seeds share SCALE equally."""
    per = pages.filter("host != ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust"))
    chosen = F.when(100 * F.col("distrust") >= SEED * F.col("n"), F.lit("distrust")).when(100 * F.col("trust") >= SEED * F.col("n"), F.lit("trust"))
    named = materialize(per.select(chosen.alias("kind"), "host").filter("kind IS NOT NULL"), "seeds")
    counts = named.groupBy("kind").count()
    return named.join(F.broadcast(counts), "kind").select("kind", "host", F.expr(f"{SCALE}L div count").alias("seed"))


def host_moves(pages: DataFrame) -> DataFrame:
    """(kind, from, to, share, whole) from rows (host, links): each link between two hosts forwards
    for trust, backwards for distrust, weighted by the pages that have it."""
    edges = (pages.filter("host != ''").select("host", F.explode("links").alias("other")).filter("host != other")
             .groupBy("host", "other").agg(F.count("*").alias("share")))
    edges = materialize(edges, "host-links")
    moves = edges.select(F.lit("trust").alias("kind"), F.col("host").alias("from"), F.col("other").alias("to"), "share").union(
        edges.select(F.lit("distrust"), "other", "host", "share"))
    whole = moves.groupBy("kind", "from").agg(F.sum("share").alias("whole"))
    return materialize(moves.join(whole, ["kind", "from"]), "moves")


def ranks(moves: DataFrame, seeds: DataFrame, turns: int = TURNS) -> DataFrame:
    """(kind, host, rank) after ``turns`` steps, or earlier if a step changes nothing. What
    arrives at a host without links to follow ends there."""
    seeds = materialize(seeds, "seed-ranks")
    back = seeds.select("kind", "host", F.expr(f"seed * {100 - FOLLOW} div 100").alias("rank"))
    now, state = seeds.withColumnRenamed("seed", "rank"), None
    for _ in range(turns):
        # Wide enough for a rank times the pages of a corpus.
        part = F.expr(f"(CAST({FOLLOW} AS DECIMAL(3,0)) * CAST(rank AS DECIMAL(13,0)) * CAST(share AS DECIMAL(15,0))) div (100 * CAST(whole AS DECIMAL(15,0)))")
        flow = moves.join(now.withColumnRenamed("host", "from"), ["kind", "from"]).select("kind", F.col("to").alias("host"), part.alias("rank"))
        now = materialize(flow.union(back).groupBy("kind", "host").agg(F.sum("rank").alias("rank")).filter("rank > 0"), "ranks")
        before, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("kind", "host", "rank").cast("decimal(38,0)"))).first()
        if state == before:
            break
    return now


def _sql() -> str:
    """The same for DuckDB over ``pages``, with the defaults; a step of the ranks is a table each."""
    order = sorted(RULES, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1]))
    fits = "".join(f" WHEN (host = '{r.partition('/')[0]}' OR suffix(host, '.{r.partition('/')[0]}'))"
                   f" AND prefix(path, '/{r.partition('/')[2]}') THEN '{r}'" for _, r in order)
    ruling = "CASE rule" + "".join(f" WHEN '{r}' THEN '{v}'" for v, r in RULES) + " END"
    link, lower = LINK_PATTERN.replace("'", "''"), f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    steps, last = "", "r0"
    for k in range(1, TURNS + 1):
        steps += f"""r{k} AS MATERIALIZED (SELECT kind, host, CAST(sum(rank) AS BIGINT) AS rank FROM (
            SELECT m.kind, m.t AS host, CAST({FOLLOW} AS HUGEINT) * rank * share // (100 * whole) AS rank FROM m JOIN {last} r ON m.kind = r.kind AND m.f = r.host
            UNION ALL SELECT kind, host, rank * {100 - FOLLOW} // 100 FROM r0) GROUP BY kind, host HAVING sum(rank) > 0),
"""
        last = f"r{k}"
    return f"""
WITH h AS (SELECT page_id, coalesce({lower.format(f"regexp_extract(url, '{URL_PATTERN}', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '{URL_PATTERN}', 2), '') AS path, html FROM pages),
p AS MATERIALIZED (SELECT *, CASE{fits} END AS rule FROM h),
e AS (SELECT host, other, count(*) AS share FROM (
        SELECT DISTINCT row_number() OVER () AS k, host, unnest(regexp_extract_all({lower.format('html')}, '{link}', 1)) AS other FROM p WHERE host <> '')
      WHERE host <> other GROUP BY host, other),
b AS (SELECT 'trust' AS kind, host AS f, other AS t, share FROM e UNION ALL SELECT 'distrust', other, host, share FROM e),
m AS MATERIALIZED (SELECT *, CAST(sum(share) OVER (PARTITION BY kind, f) AS BIGINT) AS whole FROM b),
n AS (SELECT host, count(*) AS n, count(*) FILTER ({ruling} = 'allow') AS good, count(*) FILTER ({ruling} = 'block') AS bad
      FROM p WHERE host <> '' GROUP BY host),
k AS (SELECT host, CASE WHEN 100 * bad >= {SEED} * n THEN 'distrust' WHEN 100 * good >= {SEED} * n THEN 'trust' END AS kind FROM n),
r0 AS MATERIALIZED (SELECT kind, host, {SCALE} // count(*) OVER (PARTITION BY kind) AS rank FROM k WHERE kind IS NOT NULL),
{steps}j AS (SELECT host, CAST(coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS BIGINT) AS trust,
            CAST(coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS BIGINT) AS distrust FROM {last} GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce({ruling}, CASE WHEN 100 * distrust > {THRESHOLD} * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM p LEFT JOIN j USING (host)
"""


SQL = _sql()
