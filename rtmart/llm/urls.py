"""URL filters: rules first, then trust and distrust propagated over host links.

A page whose url fits a rule gets the rule's verdict (the longest rule wins).
Other pages get their host's: personalised PageRank flows from hosts most of
whose pages the rules allow along links, distrust flows from hosts most of
whose pages they block against the links, and a host is blocked where distrust makes up
``block_share`` of the two. All of it is DataFrame operations; edges are
aggregated per host pair before anything else, ranks are rows, and each round
is written to the shared folder.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is allowed; null html has no links; repeated rows are judged
alike and count as pages each; hosts that no seed reaches, or only with a rank
below the tolerance, are allowed; rules of one length go by their text; long
pages are searched for links whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rtmart.operators.lineage import cut_lineage

#: (verdict, rule): a rule is a host and the start of a path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: Rounds of propagation between looks at how far ranks still move.
LOOK = 8

#: The host of an absolute or protocol-relative link.
LINK_HOST = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path and html."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    split = pages.select("page_id", rest.alias("rest"), "html")
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    return split.select(
        "page_id", ascii_lower(host).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"), "html")


def rule_that_fits(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """The longest rule (verdict, rule) that fits; null where none does.

    The rules are constants and are compared row by row, so no host, however
    many pages it has, is gathered for them.
    """
    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0]))
    table = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule"),
                               F.lit(r.partition("/")[0].lower()).alias("host"),
                               F.lit("/" + r.partition("/")[2]).alias("path")) for v, r in longest])
    return F.get(F.filter(table, lambda r: (
        (host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & path.startswith(r["path"])), F.lit(0))


def judged_by_rule(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, rule_verdict (null where no rule fits)."""
    hit = rule_that_fits(rules, F.col("host"), F.col("path")) if rules else F.lit(None).cast(
        "struct<verdict:string,rule:string>")
    return pages.select("page_id", "host", "path", hit.alias("hit")).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("rule_verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: pages of src that link to dst, other hosts only."""
    targets = F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK_HOST), F.lit(1)), ascii_lower))
    return (pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
            .where((F.col("src") != F.col("dst")) & (F.col("src") != ""))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
              most_rounds: int = 1000) -> DataFrame:
    """kind, host, rank: trust along the links, distrust against them.

    ``seeds``: kind, host, seed, summing to 1 per kind. What reaches a host
    without a way on returns to the seeds. Goes on until all ranks together
    move by less than the tolerance in a round, which damping brings about after
    about log(tolerance) / log(damping) rounds (looked at every LOOK rounds);
    ``most_rounds`` only raises.
    """
    def shares(kind: str, a: str, b: str) -> DataFrame:
        total = links.groupBy(a).agg(F.sum("n").alias("total"))
        return links.join(total, a).select(
            F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"),
            (F.col("n") / F.col("total")).alias("share"))

    ways = cut_lineage(shares("trust", "src", "dst").unionByName(
        shares("distrust", "dst", "src")), "url-ways")
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    nothing = F.lit(0.0)
    moved = None
    for k in range(1, most_rounds + 1):
        sent = (ways.join(ranks, ["kind", "host"])
                .groupBy("kind", F.col("to").alias("host"))
                .agg(F.sum(F.col("rank") * F.col("share")).alias("got")))
        both = (seeds.select("kind", "host", "seed", nothing.alias("got"), nothing.alias("old"))
                .unionByName(sent.select("kind", "host", nothing.alias("seed"), "got",
                                         nothing.alias("old")))
                .unionByName(ranks.select("kind", "host", nothing.alias("seed"),
                                          nothing.alias("got"), F.col("rank").alias("old"))))
        state = cut_lineage(both.groupBy("kind", "host").agg(
            *[F.sum(c).alias(c) for c in ("seed", "got", "old")]), "url-ranks")
        lost = {r["kind"]: 1.0 - r["got"] for r in
                state.groupBy("kind").agg(F.sum("got").alias("got")).collect()}
        back = F.when(F.col("kind") == "trust", F.lit(lost.get("trust", 0.0))) \
            .otherwise(F.lit(lost.get("distrust", 0.0)))
        rank = (1 - damping) * F.col("seed") + damping * (F.col("got") + back * F.col("seed"))
        ranks = state.select("kind", "host", rank.alias("rank"))
        if k == 1 or k % LOOK == 0:
            moved = state.agg(F.sum(F.abs(rank - F.col("old")))).first()[0] or 0.0
            if moved < tolerance:
                return ranks
    raise RuntimeError(f"ranks still move by {moved} after {most_rounds} rounds; tolerance {tolerance}")


def blocked_hosts(judged: DataFrame, links: DataFrame, damping: float = 0.85,
                  tolerance: float = 1e-6, block_share: float = 0.5,
                  seed_share: float = 0.5) -> DataFrame:
    """Hosts where distrust is at least block_share of trust and distrust.

    A host is a seed where the rules give one verdict to seed_share of its
    pages or more; its weight is that share.
    """
    judged = judged.where(F.col("host") != "")
    share = lambda v: F.avg((F.coalesce("rule_verdict", F.lit("")) == v).cast("double"))
    by_host = judged.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    seeds = by_host.select("host", F.explode(F.create_map(
        F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "seed"))
    seeds = seeds.where(F.col("seed") >= seed_share)
    total = seeds.groupBy("kind").agg(F.sum("seed").alias("total"))     # two rows
    seeds = cut_lineage(seeds.join(F.broadcast(total), "kind").select(
        "kind", "host", (F.col("seed") / F.col("total")).alias("seed")), "url-seeds")
    ranks = propagate(links, seeds, damping, tolerance)
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0))
    return (ranks.groupBy("host").agg(of("trust").alias("t"), of("distrust").alias("d"))
            .where((F.col("d") > 0) & (F.col("d") >= block_share * (F.col("t") + F.col("d"))))
            .select("host", F.lit(True).alias("blocked")))


def judge_pages(pages: DataFrame, rules: list[tuple[str, str]] = RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    split = with_host_and_path(pages)
    judged = cut_lineage(judged_by_rule(split, rules), "url-judged")
    links = cut_lineage(host_links(split), "url-links")
    blocked = blocked_hosts(judged, links, **options)
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"))


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
