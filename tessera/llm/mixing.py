"""Mixing sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Uses of one document at most.
MAX_USES = 3


def targets(sizes: dict, weights: dict, total: float, max_uses: int = MAX_USES) -> dict:
    """Share ``total`` by weight; a target stops at ``max_uses`` times its
    source's size, and the excess is shared again by weight until none is above."""
    out, open_ = {}, dict(weights)
    left = float(total)
    while open_:
        whole = sum(open_.values())
        full = [s for s in open_ if left * open_[s] / whole > max_uses * sizes[s]]
        if not full:
            out.update({s: left * w / whole for s, w in open_.items()})
            break
        for s in full:
            out[s] = float(max_uses * sizes[s])
            del open_[s]
        left = max(0.0, total - sum(out[s] for s in out))
    return out


def route(patterns: dict, quotas: dict, max_uses: int = MAX_USES) -> dict:
    """Integer flow {(pattern, source): words} of largest total and, among
    these, least cost.  ``patterns`` maps a tuple of sources to its words.

    The k-th use of a pattern's words costs k, so the marginal cost is convex.
    Costs lie on the patterns' supply alone, and an augmenting path never takes
    supply back; raising all supplies one use at a time and augmenting to the
    maximum each time therefore gives a flow of least cost.
    """
    sent, got, flow = defaultdict(int), defaultdict(int), defaultdict(int)
    users = defaultdict(list)
    for p in patterns:
        for s in p:
            users[s].append(p)
    for uses in range(1, max_uses + 1):
        for start in sorted(patterns, key=repr):
            while (spare := uses * patterns[start] - sent[start]) > 0:
                # Breadth first over residual edges: pattern -> source, and
                # back to a pattern that already sends words there.
                came, queue, end = {("p", start): None}, deque([("p", start)]), None
                while queue and end is None:
                    kind, at = queue.popleft()
                    if kind == "p":
                        step = [("s", s) for s in at]
                    elif got[at] < quotas.get(at, 0):
                        end = ("s", at)
                        break
                    else:
                        step = [("p", p) for p in users[at] if flow[p, at] > 0]
                    for x in step:
                        if x not in came:
                            came[x] = (kind, at)
                            queue.append(x)
                if end is None:
                    break
                chain, x = [], end
                while x is not None:
                    chain.append(x)
                    x = came[x]
                chain.reverse()
                amount = min(spare, quotas[end[1]] - got[end[1]])
                for (k, a), (_, b) in zip(chain, chain[1:]):
                    if k == "s":
                        amount = min(amount, flow[b, a])
                for (k, a), (_, b) in zip(chain, chain[1:]):
                    if k == "p":
                        flow[a, b] += amount
                    else:
                        flow[b, a] -= amount
                sent[start] += amount
                got[end[1]] += amount
    return {k: v for k, v in flow.items() if v}


def mix(docs: DataFrame, weights: list[float] | dict, *, share: float = 1.0, seed: int = 7,
        buckets: int = 1024, max_patterns: int = 200_000) -> DataFrame:
    """Choose documents so that each source's words come to its target.

    ``docs`` needs doc_id, size (long) and sources (array of string; null is a
    source of its own).  Weights repeat over the sources by code point, null
    last, or come as a dict.  Returns doc_id, size, sources and ``parts``: an
    array of (source, words) that the mix takes from this row, at most
    ``MAX_USES`` times its size in all.

    Rows of one membership pattern are laid on a line by a seeded hash of
    their id; a pattern's words for each source are a stretch of that line,
    which ends at the document that comes nearest.  The line is cut into
    ``buckets`` by hash, so a source that holds most rows is summed by many
    tasks; only one row per pattern and bucket is summed again.  One row per
    pattern reaches the driver (the method's aggregate), ``max_patterns`` at
    most, else it raises.

    Rows of size 0 give 0 words; a null or empty array counts as the null
    source, a null size as 0; repeated rows are rows of their own; an empty
    table gives an empty result; other columns are dropped.
    """
    spark = docs.sparkSession
    base = docs.select(
        "doc_id", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(F.when(F.size("sources") > 0, F.col("sources")).otherwise(
            F.array(F.lit(None).cast("string"))))).alias("sources"))
    base = base.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "size"))
    base = base.withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int"))
    sums = base.groupBy("sources", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    per_pattern = sums.groupBy("sources").agg(F.sum("words").alias("words")).limit(max_patterns + 1).collect()
    if len(per_pattern) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns; group the sources first")
    patterns = {tuple(r.sources): r.words for r in per_pattern}
    sizes = defaultdict(int)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    by = weights if isinstance(weights, dict) else {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(patterns.values()) * share
    wanted = targets(sizes, {s: by[s] for s in names}, total)
    flow = route(patterns, {s: round(t) for s, t in wanted.items()})

    rows = []
    for p in patterns:
        at = 0
        for s in p:
            if n := flow.get((p, s), 0):
                rows.append((list(p), s, at, at + n))
                at += n
    stretches = (spark.createDataFrame(rows, "sources array<string>, source string, low long, high long")
                 .groupBy("sources").agg(F.collect_list(F.struct("source", "low", "high")).alias("stretches")))
    lines = spark.createDataFrame([(list(p), n) for p, n in patterns.items()],
                                  "sources array<string>, pattern_words long")
    plan = lines.join(stretches, "sources", "left")
    before = Window.partitionBy("sources").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
              .join(plan, "sources").drop("words", "rows"))
    inside = (Window.partitionBy("sources", "bucket").orderBy("order", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (base.withColumn("end_in", F.sum("size").over(inside))
              .join(starts, ["sources", "bucket"])
              .withColumn("middle", F.col("start") + F.col("end_in") - F.col("size") / 2))
    # Use k of a document lies at its place plus k lines; it belongs to the
    # stretch that holds its middle.
    uses = F.sequence(F.lit(0), F.lit(MAX_USES - 1))

    def taken(part):
        at = F.transform(uses, lambda k: F.col("middle") + k * F.col("pattern_words"))
        hits = F.size(F.filter(at, lambda x: (x >= part["low"]) & (x < part["high"])))
        return F.struct(part["source"].alias("source"), (hits * F.col("size")).alias("words"))

    parts = F.filter(F.transform(F.coalesce(F.col("stretches"), F.array()), taken), lambda x: x["words"] > 0)
    return placed.select("doc_id", "size", "sources", parts.alias("parts"))


def source_targets(sizes: DataFrame, weights: list[float], total: float) -> DataFrame:
    """(source, source_size, target) of a small table (source, source_size)."""
    found = {r.source: r.source_size for r in sizes.collect()}
    names = sorted(found, key=lambda s: (s is None, s or ""))
    wanted = targets(found, {s: weights[i % len(weights)] for i, s in enumerate(names)}, total)
    return sizes.sparkSession.createDataFrame([(s, found[s], wanted[s]) for s in names],
                                              "source string, source_size long, target double")
