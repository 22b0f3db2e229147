"""URL filters: explicit rules, and path templates learnt per host that the rules' labels show to be bad.

Every host has a tree of path segments. Segments that look like numbers, hashes or mixes with digits become wildcards
of that look. Where a node still has very many children, the rare ones become one wildcard. Siblings of the same shape
below, whose shares of blocked pages don't differ significantly, are merged into one branch. A leaf of the tree is a
template; the pages a rule judges are its labels. It is rejected if its share of blocked labels, smoothed towards one
half, is over ``REJECT``, so a template with few labels or none is not.

Scale. Pages are counted per host and lexical path before any tree is grown, in the tasks first; a host with a third of
all pages is as many rows as it has different paths. Tree levels are aggregations and joins over those rows, never one
host in one task. Pages meet their template's verdict by a join whose small side is broadcast after it was measured.

Results for odd input: a url that is null or has no ``://`` has an empty host and path, no rule, and the template of
the empty path. Null ids and repeated rows are judged each for itself. Of a path with more than ``LEVELS`` segments,
the rest is one last segment. Equal templates on different hosts are judged apart. An empty table gives an empty one.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small
from quayside.llm.words import let
from quayside.session import stage

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
LEVELS = 8
MANY_CHILDREN = 48  # literal children from which the rare ones are one wildcard
RARE = 0.02  # of the node's pages
SMOOTHING = 2.0  # labels, half of them blocked, that every template begins with
REJECT = 0.75
SIMILAR = 1.96  # standard errors between the shares of branches that are merged


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, after, k), F.lit("")) for k in (1, 2))
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that fits host and path, and its verdict; null for none."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):  # a longer one overrides
        name, slash, below = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + below)
        found, verdict = F.when(fits, rule).otherwise(found), F.when(fits, says).otherwise(verdict)
    return found, verdict


def looks(segment: Column) -> Column:
    """A segment that varies by its look becomes a wildcard; the end of a file name stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{number}"), ending))
        .when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.concat(F.lit("{date}"), ending))
        .when(stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.concat(F.lit("{hash}"), ending))
        .when(stem.rlike(r"[0-9]"), F.concat(F.lit("{mixed}"), ending))
        .otherwise(segment)
    )


def segments(path: Column) -> Column:
    """At most ``LEVELS`` segments, the last of a deeper path its joined rest; blank ones don't count."""

    def cut(every: Column) -> Column:
        rest = F.array_join(F.slice(every, LEVELS, F.greatest(F.size(every) - (LEVELS - 1), F.lit(1))), "/")
        return F.when(F.size(every) > LEVELS, F.concat(F.slice(every, 1, LEVELS - 1), F.array(rest))).otherwise(every)

    return let(F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), looks), cut)


def _prefix(level: int) -> Column:
    """The generalised path above a level, as one text."""
    return F.concat_ws("/", F.lit(""), F.slice("parts", 1, level))


def widen(paths: DataFrame, level: int) -> DataFrame:
    """At the nodes above ``level`` with very many literal children, makes the rare ones a wildcard."""
    node, child = ["host", "above"], F.get("parts", F.lit(level))
    here = paths.withColumn("above", _prefix(level)).withColumn("child", child)
    literal = here.where(F.col("child").isNotNull() & ~F.col("child").startswith("{"))
    children = literal.groupBy(*node, "child").agg(F.sum("pages").alias("pages"))
    crowded = children.groupBy(*node).agg(F.count("*").alias("n"), F.sum("pages").alias("all")).where(F.col("n") > MANY_CHILDREN)
    crowded = stage(crowded.drop("n"), "crowded")
    if crowded.isEmpty():
        return paths
    rare = children.join(crowded, node).where(F.col("pages") < F.col("all") * RARE).select(*node, "child", F.lit(True).alias("rare"))
    parts = F.when(
        F.col("rare"), F.concat(F.slice("parts", 1, level), F.array(F.lit("{any}")), F.slice("parts", level + 2, LEVELS))
    ).otherwise(F.col("parts"))
    return stage(here.join(rare, [*node, "child"], "left").withColumn("parts", parts).select(*paths.columns), "widened")


def merge_similar(paths: DataFrame, level: int) -> DataFrame:
    """Names siblings at ``level`` alike where the tree below is the same and the shares of blocked labels agree.

    Siblings with labels are lined up by their share; neighbours less than ``SIMILAR`` standard errors apart belong
    together. Siblings without any label can only be alike among themselves.
    """
    node, below = ["host", "above"], F.concat_ws("/", F.slice("parts", level + 2, LEVELS))
    here = paths.withColumn("above", _prefix(level)).withColumn("child", F.get("parts", F.lit(level)))
    literal = here.where(F.col("child").isNotNull() & ~F.col("child").startswith("{"))
    shapes = (
        literal.groupBy(*node, "child", below.alias("below"))
        .agg(F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"))
        .groupBy(*node, "child")
        .agg(
            F.sum(F.pmod(F.xxhash64("below"), F.lit(1 << 40))).alias("shape"),
            F.sum("labels").alias("labels"),
            F.sum("blocked").alias("blocked"),
        )
    )
    share = (F.col("blocked") + 0.5) / (F.col("labels") + 1)
    error = share * (1 - share) / (F.col("labels") + 1)
    alike = Window.partitionBy(*node, "shape", F.col("labels") > 0).orderBy("share", "child")
    apart = (F.col("share") - F.lag("share").over(alike)) >= SIMILAR * F.sqrt(F.col("error") + F.lag("error").over(alike))
    lined = shapes.withColumns({"share": share, "error": error})
    lined = lined.withColumn("apart", F.coalesce(apart & (F.col("labels") > 0), F.lit(False)).cast("int"))
    run = F.sum("apart").over(alike.rowsBetween(Window.unboundedPreceding, 0))
    grouped = lined.withColumn("run", run).withColumn("has", F.col("labels") > 0)
    together = Window.partitionBy(*node, "shape", "has", "run")
    names = F.array_sort(F.collect_list("child").over(together))  # of one node: crowded ones have few literals
    merged = F.concat(F.lit("("), F.array_join(names, "|"), F.lit(")"))
    renamed = grouped.withColumn("names", names).select(*node, "child", F.when(F.size("names") > 1, merged).alias("merged"))
    renamed = stage(renamed.where("merged is not null"), "merged")
    if renamed.isEmpty():
        return paths
    parts = F.when(
        F.col("merged").isNotNull(),
        F.concat(F.slice("parts", 1, level), F.array("merged"), F.slice("parts", level + 2, LEVELS)),
    ).otherwise(F.col("parts"))
    return stage(here.join(renamed, [*node, "child"], "left").withColumn("parts", parts).select(*paths.columns), "regrouped")


def grow(paths: DataFrame) -> DataFrame:
    """``paths`` (host, lexical, pages, labels, blocked) with the template of each."""
    paths = stage(paths.withColumn("parts", F.col("lexical")), "paths")
    depth = paths.agg(F.coalesce(F.max(F.size("parts")), F.lit(0))).first()[0]
    for level in range(depth):  # at most LEVELS
        paths = widen(paths, level)
    for level in reversed(range(depth)):
        paths = merge_similar(paths, level)
    return paths.withColumn("template", F.concat(F.lit("/"), F.array_join("parts", "/"))).drop("parts")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url", smoothing: float = SMOOTHING
) -> DataFrame:
    """Per row: key, ``host``, ``path``, ``rule``, ``verdict``, and the page's ``template`` with its smoothed
    ``blocked_share``."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "says": says, "lexical": segments(F.col("path"))})
    paths = parsed.groupBy("host", "lexical").agg(
        F.count("*").alias("pages"), F.count("says").alias("labels"), F.count_if(F.col("says") == "block").alias("blocked")
    )
    grown = grow(paths)
    purity = (F.col("blocked") + smoothing / 2) / (F.col("labels") + smoothing)
    templates = grown.groupBy("host", "template").agg(F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"))
    templates = templates.select("host", "template", purity.alias("blocked_share"))
    verdicts = stage(grown.select("host", "lexical", "template").join(templates, ["host", "template"]), "templates")
    verdicts = verdicts.select("host", F.concat_ws("/", "lexical").alias("at"), "template", "blocked_share")
    judged = parsed.withColumn("at", F.concat_ws("/", "lexical")).join(broadcast_if_small(verdicts), ["host", "at"], "left")
    verdict = F.coalesce("says", F.when(F.col("blocked_share") > REJECT, "block").otherwise("allow"))
    return judged.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "template", "blocked_share")
