"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources; documents with the same set of sources form a pattern. What a pattern can
give (its words, once and once more) flows to the quotas of its sources; a second pass over the same words costs
more than the first, so repetition is the last resort and goes where it must. Then documents are selected per pattern
in a seeded order until the pattern's flow is met.

Scale. Texts are read once, for their sizes. Patterns and sources are aggregated before anything reaches the driver,
which solves the flow on a few numbers per pattern. Beyond ``MOST_PATTERNS`` patterns, sources that no document shares
with another leave the network: each is an arc of its own, whose flow is the smaller of its quota and its words, so
their targets, flows and places are found by joins and aggregates and only overlapping patterns are solved. Selection finds the place in the seeded order where the flow ends
by sums over hash prefixes, so no pattern is sorted or gathered in one task; only the documents of one last prefix
(one in 16 million) are put in order.

Results for odd input: a null or empty text has size 0 and is taken with 0 words. A null source is a source of its
own and sorts last. Documents are taken whole, so a source's words miss its target by less than one document.
Rows equal in key and text share a place in the order and are taken or left together. An empty table gives an empty
one. Other columns are ignored by ``mix`` and returned untouched by ``sample``, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.joins import broadcast_if_small
from quayside.functions.ordering import running_total
from quayside.llm.words import whole, words
from quayside.session import stage

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)  # of all words, what the mix asks for
MOST = 2  # times a document may be taken
MOST_PATTERNS = 100_000  # sets of sources that go through the driver


# Targets --------------------------------------------------------------------------------------------------


def targets(
    sizes: dict, total: int, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST
) -> dict:
    """Per source the words it should give: by weight, at most ``most`` times its size, the excess shared anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))  # texts sort by code point
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    found: dict = {}
    while True:
        open_ = [s for s in names if s not in found]
        left, by = share * total - sum(found.values()), sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] > most * sizes[s] * by]
        if not above:
            return found | {s: left * weight[s] / Fraction(by) for s in open_}
        found |= {s: Fraction(most * sizes[s]) for s in above}


# Flow -----------------------------------------------------------------------------------------------------


class Network:
    """A directed graph with capacities and costs, every arc beside its reverse."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head, self.room, self.cost = [], [], []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.head))
            self.head.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.head) - 2

    def send(self, source: int, sink: int) -> None:
        """Largest flow of least cost, by successive cheapest paths; costs of the arcs laid are not negative."""
        price = [0] * len(self.out)
        while True:
            best, came, queue = {source: 0}, {}, [(0, source)]
            while queue:
                far, at = heapq.heappop(queue)
                if far > best[at]:
                    continue
                for arc in self.out[at]:
                    to = self.head[arc]
                    there = far + self.cost[arc] + price[at] - price[to]
                    if self.room[arc] and there < best.get(to, there + 1):
                        best[to], came[to] = there, arc
                        heapq.heappush(queue, (there, to))
            if sink not in came:
                return
            for node in range(len(price)):
                price[node] += min(best.get(node, best[sink]), best[sink])
            path, at = [], sink
            while at != source:
                path.append(came[at])
                at = self.head[came[at] ^ 1]
            amount = min(self.room[arc] for arc in path)
            for arc in path:
                self.room[arc] -= amount
                self.room[arc ^ 1] += amount


def route(members: dict[str, tuple], total: dict[str, int], quota: dict, most: int = MOST) -> dict[str, int]:
    """Words each pattern gives: ``total`` per pattern and pass, the k-th pass at cost k; at most ``quota`` per source."""
    node_of = {s: len(members) + 1 + k for k, s in enumerate(quota)}
    sink = len(members) + len(quota) + 1
    net, passes = Network(sink + 1), {}
    for k, (pattern, own) in enumerate(members.items(), 1):
        passes[pattern] = [net.arc(0, k, total[pattern], cost) for cost in range(most)]
        for s in own:
            net.arc(k, node_of[s], most * total[pattern], 0)
    for s, words_wanted in quota.items():
        net.arc(node_of[s], sink, words_wanted, 0)
    net.send(0, sink)
    return {p: sum(net.room[arc ^ 1] for arc in arcs) for p, arcs in passes.items()}


# Selection ------------------------------------------------------------------------------------------------


def pattern_name(sources: Column) -> Column:
    """A text that tells apart any two sets of sources, also with nulls in them."""
    return F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("s")), {"ignoreNullFields": "false"})


def edge_places(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per pattern the last place in the seeded order that is taken once more: ``pattern, last``, null for none.

    ``sized`` has ``pattern, size, place``; ``wanted`` has ``pattern, rest``, the words to take beyond whole passes.
    """
    by_pattern = Window.partitionBy("pattern")

    def narrow(rows: DataFrame, digits: int) -> DataFrame:
        """The prefix within which the words run out, and what is left of them there."""
        earlier = by_pattern.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy("pattern", F.substring("place", 1, digits).alias("prefix")).agg(
            F.sum("size").alias("n"), F.first("rest").alias("rest")
        )
        before = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        here = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("n"))
        return before.where(here).select("pattern", "prefix", (F.col("rest") - F.col("before")).alias("rest"))

    def inside(edges: DataFrame, digits: int) -> DataFrame:
        prefixed = sized.withColumn("prefix", F.substring("place", 1, digits))
        return prefixed.join(edges, ["pattern", "prefix"]).drop("prefix")

    coarse = narrow(sized.where("size > 0").join(broadcast_if_small(wanted), "pattern"), 3)
    last = inside(narrow(inside(coarse, 3), 6), 6).groupBy("pattern", "place", "rest").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(by_pattern.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The document in which the words run out is taken if that comes nearer than leaving it.
    taken = last.withColumn("before", before).withColumn("over", F.col("before") + F.col("n") - F.col("rest"))
    near = (F.col("over") <= 0) | ((F.col("before") < F.col("rest")) & (F.col("over") < F.col("rest") - F.col("before")))
    edge = F.coalesce(F.max(F.when(near, F.col("place"))), F.max(F.substring("place", 1, 6)))
    return taken.groupBy("pattern").agg(edge.alias("last"))


def _parts(key: str, text: str, sources: Column, seed: int) -> dict[str, Column]:
    """What selection needs of a document, from its own columns alone."""
    own = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    return {
        "pattern": pattern_name(sources),
        "size": F.size(words(whole(text))).cast("bigint"),
        "place": F.md5(F.concat_ws("/", F.lit(seed), own, F.md5(whole(text)))),
    }


def _times(place: Column) -> Column:
    """How often the document at ``place`` is taken, beside its pattern's row of the plan."""
    return F.col("passes") + F.coalesce(place <= F.col("last"), F.lit(False)).cast("int")


def plan_mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """One row per pattern: whole ``passes`` over its documents, the ``last`` place taken once more, and
    ``source_size`` and ``target`` of its first source.

    ``sized`` has ``pattern, sources, size, place``. Up to ``MOST_PATTERNS`` patterns go through the driver; beyond,
    ``plan_apart`` gives the same plan.
    """
    spark = sized.sparkSession
    patterns = sized.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("words"))
    patterns = stage(patterns, "patterns")
    rows = patterns.limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        return plan_apart(sized, patterns, weights, share, most)
    members = {row.pattern: tuple(dict.fromkeys(row.sources)) for row in sorted(rows, key=lambda r: r.pattern)}
    total = {row.pattern: row.words for row in rows}
    sizes: dict = {}
    for pattern, own in members.items():
        for s in own:
            sizes[s] = sizes.get(s, 0) + total[pattern]
    wanted = targets(sizes, sum(total.values()), weights, share, most)
    given = route(members, total, {s: round(t) for s, t in wanted.items()}, most)

    rest = [(p, given[p] % total[p]) for p in members if total[p] and given[p] % total[p]]
    edges = edge_places(sized, spark.createDataFrame(rest, "pattern string, rest bigint"))
    last = {row.pattern: row["last"] for row in edges.collect()}  # a row per pattern
    table = [
        (p, given[p] // total[p] if total[p] else 0, last.get(p), sizes[own[0]] if own else 0, float(wanted[own[0]]) if own else 0.0)
        for p, own in members.items()
    ]
    return spark.createDataFrame(table, "pattern string, passes int, last string, source_size bigint, target double")


def spread_targets(sizes: DataFrame, total: int, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """``targets`` for any number of sources: adds ``target`` and ``quota``, the target in whole words, to ``s, words``.

    A source stops at its most while what is left would give it more by weight. What is left per weight never falls
    from one round to the next, so a round is one aggregate over all sources.
    """
    spark = sizes.sparkSession
    named = running_total(sizes.where("s is not null").select("s"), "s", F.lit(1), "position")
    last = spark.createDataFrame([(None, named.count() + 1)], "s string, position bigint")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    position = named.select("s", "position").union(last).select("s", turn.alias("weight"))
    same = F.col("a.s").eqNullSafe(F.col("b.s"))
    ranked = stage(sizes.alias("a").join(position.alias("b"), same).select("a.*", "weight"), "weighted-sources")

    room = (F.col("words") * most).cast("decimal(20,0)")
    all_weights, capped, before = ranked.agg(F.sum("weight")).first()[0], (0, 0, 0), None
    while capped != before:
        before = capped
        left, by = share * total - capped[0], all_weights - capped[1]
        up, down = F.lit(Decimal(left.numerator)), F.lit(Decimal(left.denominator * by))
        full = F.lit(True) if by == 0 else up * F.col("weight") > room * down
        found = ranked.where(full).agg(F.sum(room), F.sum("weight"), F.count("*")).first()
        capped = (int(found[0] or 0), found[1] or 0, found[2])
    part = up * F.col("weight")
    shares = ranked.select("*", room.cast("bigint").alias("room"), full.alias("full"), part.alias("part"), down.alias("down"))
    if by == 0:
        return shares.withColumns({"target": F.col("room").cast("double"), "quota": F.col("room")})
    even = shares.withColumn("below", F.expr("part div down"))
    over = F.col("part") * 2 - F.col("below") * F.col("down") * 2  # half a word goes to the even number
    up_one = (over > F.col("down")) | ((over == F.col("down")) & (F.col("below") % 2 == 1))
    quota = F.when(F.col("full"), F.col("room")).otherwise(F.col("below") + up_one.cast("int"))
    target = F.when(F.col("full"), F.col("room").cast("double")).otherwise(part.cast("double") / F.col("down").cast("double"))
    return even.select("*", target.alias("target"), quota.alias("quota"))


def plan_apart(sized: DataFrame, patterns: DataFrame, weights: Sequence[int], share: Fraction, most: int) -> DataFrame:
    """``plan_mix`` for more patterns than the driver should hold; more than ``MOST_PATTERNS`` that overlap are refused."""
    spark = sized.sparkSession
    own = F.array_distinct("sources")
    patterns = patterns.withColumns({"own": own, "alone": F.size(own) == 1})
    each = patterns.select("pattern", F.explode(F.col("own").cast("array<string>")).alias("s"), "words", "alone")
    sizes = each.groupBy("s").agg(F.sum("words").alias("words"), F.bool_and("alone").alias("apart"))
    total = int(patterns.agg(F.sum("words")).first()[0])
    wanted = stage(spread_targets(stage(sizes, "source-sizes"), total, weights, share, most), "source-targets")

    same = F.col("p.s").eqNullSafe(F.col("w.s"))
    met = each.alias("p").join(wanted.alias("w"), same).select("pattern", "p.words", "w.s", "apart", "quota")
    lone = met.where("apart").select("pattern", F.least("quota", F.col("words") * most).alias("given"))
    net = met.where("not apart").groupBy("pattern").agg(F.first("words").alias("words"), F.collect_set(F.struct("s", "quota")).alias("own"))
    rows = net.limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} sets of sources that overlap")
    rows.sort(key=lambda r: r.pattern)
    quota = {s: q for r in rows for s, q in r.own}
    solved = route({r.pattern: tuple(s for s, _ in r.own) for r in rows}, {r.pattern: r.words for r in rows}, quota, most)
    given = lone.union(spark.createDataFrame(list(solved.items()), "pattern string, given bigint"))

    named = patterns.select("pattern", "words", F.get("sources", F.lit(0)).cast("string").alias("s"), F.size("own").alias("n"))
    facts = wanted.select("s", F.col("words").alias("source_size"), "target")
    named = named.alias("p").join(facts.alias("w"), (F.col("n") > 0) & F.col("p.s").eqNullSafe(F.col("w.s")), "left")
    table = named.select("pattern", "words", "source_size", "target").join(given, "pattern", "left")
    whole_words, passes = F.greatest("words", F.lit(1)), F.coalesce("given", F.lit(0))
    table = table.select(
        "pattern",
        F.when(F.col("words") > 0, F.floor(passes / whole_words)).otherwise(0).cast("int").alias("passes"),
        F.when(F.col("words") > 0, passes % whole_words).otherwise(0).alias("rest"),
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
    )
    table = stage(table, "mix-plan")
    edges = edge_places(sized, table.where("rest > 0").select("pattern", "rest"))
    return table.join(edges, "pattern", "left").select("pattern", "passes", "last", "source_size", "target")


def mix(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", seed: int = 0, **how) -> DataFrame:
    """Per row of ``docs``: key, ``size``, ``source_size`` and ``target`` of its first source, and ``taken``, the words
    the mix takes of it, repeats counted. ``sources`` is an array column; ``how`` goes to ``plan_mix``."""
    sized = docs.select(F.col(f"`{key}`").alias("key"), sources.alias("sources"), F.col(f"`{text}`").alias("_text"))
    parts = _parts("key", "_text", F.col("sources"), seed)
    sized = stage(sized.select("key", "sources", *[c.alias(n) for n, c in parts.items()]), "sizes")
    planned = sized.join(broadcast_if_small(stage(plan_mix(sized, **how), "plan")), "pattern")
    taken = F.col("size") * _times(F.col("place"))
    return planned.select(F.col("key").alias(key), "size", "source_size", "target", taken.alias("taken"))


def sample(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", seed: int = 0, **how) -> DataFrame:
    """``docs`` as the mix takes them: rows left out are gone, rows taken twice stand twice."""
    parts = _parts(key, text, sources, seed)
    sized = stage(docs.select(sources.alias("sources"), *[c.alias(n) for n, c in parts.items()]), "sizes")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    planned = docs.select(row, *[c.alias(n) for n, c in parts.items()])
    planned = planned.join(broadcast_if_small(stage(plan_mix(sized, **how), "plan")), "pattern")
    times = F.when(F.col("size") > 0, _times(F.col("place"))).otherwise(F.lit(0))
    return planned.select(F.explode(F.array_repeat("_row", times)).alias("_row")).select("_row.*")
