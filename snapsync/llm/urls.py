"""URL filters: rules for hosts and paths, and trust that flows over links between hosts.

A page that no rule judges takes its host's verdict. Trust starts at hosts by the share of their
pages that rules allow and follows links (personalised PageRank); distrust starts by the share of
blocked pages and goes against the links, to the hosts that point there.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
# No score is further than this from its limit.
TOLERANCE = 1e-4
# A host is blocked from the distrust on that half of its pages being blocked would give it.
BLOCKED_FROM = (1 - DAMPING) * 0.5
SALTS = 16
TRUST, DISTRUST = "trust", "distrust"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url):
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules, host, path):
    """The longest rule that fits, as (rule, verdict); ties go to the first in text order. The
    rules are a parameter, looked through for every row."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(
            path, F.lit(slash + rest)
        )
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def spread(
    seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, rounds: int | None = None
) -> DataFrame:
    """Personalised PageRank: (kind, host, score) from (kind, host, seed) over (kind, source, target,
    weight), the weights of a source adding up to 1 for each kind. A hub's links are dealt out by a salt.

    Each round moves on what the round before it added. A round passes on at most `DAMPING` of what came
    in, so all later rounds together add at most DAMPING / (1 - DAMPING) of its sum to any score: the
    rounds end when that is below `tolerance` (or after `rounds`, if given).
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = written(
        edges.withColumn("salt", F.pmod(F.xxhash64("target"), F.lit(SALTS)).cast("int"))
    )
    key = ["kind", "host"]
    added = written(seeds.select(*key, (F.col("seed") * (1 - DAMPING)).alias("score")).where("score > 0"))
    found, n = [added], 0
    while rounds is None or n < rounds:
        moving = added.agg(F.sum("score")).first()[0] or 0.0
        if moving * DAMPING / (1 - DAMPING) < tolerance:
            break
        added = written(
            added.withColumn("salt", salts)
            .withColumnRenamed("host", "source")
            .join(salted, ["kind", "source", "salt"])
            .groupBy("kind", F.col("target").alias("host"))
            .agg((F.sum(F.col("score") * F.col("weight")) * DAMPING).alias("score"))
        )
        found, n = [*found, added], n + 1
    folders = {path.rpartition("/")[0] for df in found for path in df.inputFiles()}
    every = seeds.sparkSession.read.schema(added.schema).parquet(*folders)
    return every.groupBy(*key).agg(F.sum("score").alias("score"))


def weighted(edges: DataFrame, source: str, target: str) -> DataFrame:
    totals = edges.groupBy(source).agg(F.sum("n").alias("total"))
    return edges.join(totals, source).select(
        F.col(source).alias("source"),
        F.col(target).alias("target"),
        (F.col("n") / F.col("total")).alias("weight"),
    )


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    tolerance: float = TOLERANCE,
    rounds: int | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: `id`, `host`, `path`, `rule`, `verdict`, and the host's `trust` and
    `distrust`. `rules` holds ('allow' or 'block', 'host/path') pairs.

    A null url, or one without `://`, has an empty host and path; an empty host takes no part in the
    graph and is allowed. Null html has no links. Scores are within `tolerance` of their limits. Ids may be null or repeat. Without links between
    hosts the scores are those of the seeds.
    """
    url = F.col(f"`{url_col}`").cast("string")
    judged = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    ).withColumn("found", rule_for(rules, F.col("host"), F.col("path")))
    verdict = F.col("found.verdict")
    hosts = (
        judged.where("host != ''")
        .groupBy("host")
        .agg(
            (F.count_if(verdict == "allow") / F.count("*")).alias("allowed"),
            (F.count_if(verdict == "block") / F.count("*")).alias("blocked"),
        )
    )
    hosts = written(hosts)
    links = F.regexp_extract_all(F.col(f"`{html_col}`").cast("string"), F.lit(LINK), F.lit(1))
    edges = written(
        pages.select(host_of(url).alias("page_host"), F.explode(links).alias("raw"))
        .select("page_host", F.translate("raw", UPPER, LOWER).alias("link_host"))
        .where("page_host != '' and page_host != link_host")
        .groupBy("page_host", "link_host")
        .agg(F.count("*").alias("n"))
    )
    seeds = hosts.select(
        "host",
        F.stack(F.lit(2), F.lit(TRUST), F.col("allowed"), F.lit(DISTRUST), F.col("blocked")).alias("kind", "seed"),
    )
    onward = weighted(edges, "page_host", "link_host").withColumn("kind", F.lit(TRUST))
    back = weighted(edges, "link_host", "page_host").withColumn("kind", F.lit(DISTRUST))
    spread_scores = spread(seeds, onward.unionByName(back), tolerance, rounds)
    totals = spread_scores.groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("score"))).alias(k) for k in (TRUST, DISTRUST)]
    )
    scores = (
        hosts.select("host")
        .join(totals, "host", "left")
        .fillna(0.0, [TRUST, DISTRUST])
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    blocked = (F.col("distrust") >= BLOCKED_FROM) & (F.col("distrust") > F.col("trust"))
    return (
        judged.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int"))
        .join(scores, ["host", "salt"], "left")
        .select(
            "id",
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce(
                F.col("found.verdict"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
