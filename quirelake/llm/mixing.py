"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed up by membership pattern (the set of sources they belong to). The
words of a pattern can be used up to MAX_REPEATS times, each repetition at a higher cost;
the cheapest flow of words from patterns to the quotas of their sources says how often
each pattern is used. Within a pattern, documents are drawn in a seeded order.
"""

from collections import defaultdict, deque
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.llm.components import components
from quirelake.llm.workspace import written

MAX_REPEATS = 3
#: Cost of a word's first, second and third use; it rises faster each time.
REPEAT_COSTS = (0, 1, 4)
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 20_240_607
#: Parts of the seeded order, by which the place to stop at is found.
BINS = 4_096

WORDS = r"[^\x20\x09-\x0D]+"


def shares(sizes: dict, weights: dict, total: int) -> dict:
    """Targets in proportion to the weights, none above MAX_REPEATS times its source's
    size; what a full source leaves is reshared by weight until none is above."""
    target, free, left = {}, dict(sizes), float(total)
    while free:
        weight = sum(weights[s] for s in free)
        full = [s for s in free if left * weights[s] / weight > MAX_REPEATS * free[s]]
        if not full:
            return target | {s: left * weights[s] / weight for s in free}
        for s in full:
            target[s] = float(MAX_REPEATS * free.pop(s))
            left -= target[s]
    return target


def _cheapest_flow(sizes: dict, quotas: dict) -> dict:
    """Words that each pattern (a tuple of sources) gives; successive shortest paths."""
    arcs, heads = [], defaultdict(list)  # arc i and i ^ 1 are each other's reverse

    def arc(a, b, room, cost):
        for ends, r, c in (((a, b), room, cost), ((b, a), 0, -cost)):
            heads[ends[0]].append(len(arcs))
            arcs.append([ends[1], r, c])

    for pattern, size in sizes.items():
        for cost in REPEAT_COSTS:
            arc("from", ("p", pattern), size, cost)
        for source in pattern:
            arc(("p", pattern), ("s", source), sum(quotas.values()), 0)
    for source, quota in quotas.items():
        arc(("s", source), "to", quota, 0)
    while True:
        cost, via, queue, queued = {"from": 0}, {}, deque(["from"]), {"from"}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for i in heads[a]:
                b, room, c = arcs[i]
                if room > 0 and cost[a] + c < cost.get(b, float("inf")):
                    cost[b], via[b] = cost[a] + c, i
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if "to" not in via:
            break
        path, at = [], "to"
        while at != "from":
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        room = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= room
            arcs[i ^ 1][1] += room
    given = dict.fromkeys(sizes, 0)
    for i in heads["from"]:
        given[arcs[i][0][1]] += arcs[i ^ 1][1]
    return given


def routed(sizes: dict, targets: dict) -> dict:
    """Words to take of each pattern, by the cheapest flow to the rounded targets."""
    quotas = {s: round(targets[s]) for pattern in sizes for s in pattern}
    return _cheapest_flow(sizes, quotas)


def mix(docs: DataFrame, memberships: str = "array(source)", weights: dict | None = None,
        seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, taken and times.

    ``memberships`` is an SQL expression: the array of sources a document belongs to; a
    NULL member is a source like others, an empty or NULL array counts as [NULL]. size is the number of
    words (NULL text: 0), source_size and target are those of the first source by code
    point, NULL last. taken is size times the whole number of times that the document is
    used, 0 to MAX_REPEATS. Documents of size 0 are never taken. Rows that repeat are
    documents of their own and share a place in the seeded order; they only differ where
    a source is full in between, and then it does not matter which of them is taken. No row
    gives no result. Columns of ``docs`` that have one of the new names are replaced, all
    others stay, whatever their names.

    Sources and patterns may be of any number: targets are found by sums over the table of
    sources, and each set of sources that patterns connect is a flow of its own in a task.
    """
    sized = _sized(docs, memberships, seed)
    measured = written(sized.select("pattern", "place", "size"))
    sums = written(measured.groupBy("pattern").agg(F.sum("size").alias("size")))
    plan = written(_routes(sums, written(_targets(sums, weights))))
    cut = written(_within(measured, written(_cut(measured, plan))))
    taken = _taken(sized, written(_filled(measured, cut)))
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in _NEW]
    return taken.select(*kept, *_NEW)


_NEW = ("size", "source_size", "target", "taken", "times")


def _sized(docs: DataFrame, memberships: str, seed: int) -> DataFrame:
    """The rows as they are in __row, with size, pattern (a sorted set, NULL last) and place
    (the seeded order)."""
    id_ = F.col("doc_id").cast("string")
    members = F.expr(f"coalesce({memberships}, array(NULL))").cast("array<string>")
    members = F.when(F.size(members) == 0, F.array(F.lit(None).cast("string"))).otherwise(members)
    return docs.select(
        F.struct(*docs.columns).alias("__row"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.array_sort(F.array_distinct(members)).alias("pattern"),
        F.xxhash64(F.lit(seed), id_, F.when(id_.isNull(), F.col("text"))).alias("place"),
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with number: their place in code point order, NULL last, from 0."""
    places = F.monotonically_increasing_id().alias("at")
    ordered = written(sources.orderBy(F.asc_nulls_last("source")).select("*", places))
    block = F.shiftright("at", 33)
    counts = sorted(map(tuple, ordered.groupBy(block.alias("block")).count().collect()))
    starts, n = [], 0
    for number, count in counts:  # one row per partition
        starts.append((number, n))
        n += count
    starts = ordered.sparkSession.createDataFrame(starts, "block long, start long")
    return (
        ordered.withColumn("block", block).join(F.broadcast(starts), "block")
        .select("source", "size", F.expr("start + (at & 8589934591)").alias("number"))
    )


def _targets(sums: DataFrame, weights: dict | None) -> DataFrame:
    """Per source: source, number, size and target.

    What ``shares`` says, by sums over the table: a source is full when its room per weight
    lies below what is left per weight, and that only grows from step to step.
    """
    spark = sums.sparkSession
    sources = _numbered(
        sums.select(F.explode("pattern").alias("source"), "size").groupBy("source").agg(
            F.sum("size").alias("size")
        )
    )
    if weights is None:
        weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
        sources = sources.withColumn("weight", weight.cast("double"))
    else:
        given = [(s, float(w)) for s, w in weights.items()]
        given = spark.createDataFrame(given, "source string, weight double")
        sources = sources.join(given, sources["source"].eqNullSafe(given["source"])).drop(given["source"])
    sources = written(sources)
    total = sums.agg(F.sum("size")).first()[0] or 0
    room = F.lit(MAX_REPEATS) * F.col("size")
    every = sources.agg(F.sum("weight")).first()[0] or 0.0
    left, weight, full = float(total), every, 0
    while weight > 0:
        is_full = left * F.col("weight") / weight > room
        row = sources.where(is_full).agg(F.count("*"), F.sum(room), F.sum("weight")).first()
        if row[0] == full:
            break
        full, left, weight = row[0], float(total - row[1]), every - row[2]
    shared = left * F.col("weight") / weight if weight > 0 else room.cast("double")
    target = F.when(shared > room, room.cast("double")).otherwise(shared)
    return sources.select("source", "number", "size", target.alias("target"))


def _routes(sums: DataFrame, sources: DataFrame) -> DataFrame:
    """Per pattern: source_size and target of its first source, and what the flow takes of
    it: whole repeats of all its documents and the rest in words."""
    members = sums.select("pattern", "size", F.explode("pattern").alias("source")).join(
        sources.select(F.col("source").alias("s"), "number", F.col("size").alias("held"), "target"),
        F.expr("source <=> s"),
    )
    listed = members.groupBy("pattern", "size").agg(
        F.array_sort(F.collect_list(F.struct("number", "held", "target"))).alias("members")
    )
    # sources that a pattern joins belong to one flow; a lone source is a flow of its own
    edges = listed.where(F.size("members") > 1).select(
        F.col("members")[0]["number"].alias("a"), F.explode("members.number").alias("b")
    )
    roots = components(edges)
    first = F.col("members")[0]["number"]
    if roots is None:
        grouped = listed.withColumn("flow", first)
    else:
        grouped = listed.join(roots, first == roots["node"], "left").withColumn(
            "flow", F.coalesce("root", first)
        )
    rows = grouped.select("flow", "pattern", "size", F.col("members.number").alias("numbers"),
                          F.col("members.target").alias("targets"),
                          F.col("members")[0]["held"].alias("source_size"))
    return rows.repartition("flow").sortWithinPartitions("flow", "numbers").mapInArrow(
        _flows, "pattern array<string>, source_size long, target double, repeats int, rest long"
    )


def _flows(batches):
    """Rows come flow by flow."""

    def routes(group):
        sizes = {tuple(r["numbers"]): r["size"] for r in group}
        targets = {s: t for r in group for s, t in zip(r["numbers"], r["targets"])}
        taken = routed(sizes, targets)
        out = []
        for r in group:
            words = taken[tuple(r["numbers"])]
            repeats, rest = divmod(words, r["size"]) if r["size"] else (0, 0)
            out.append((r["pattern"], r["source_size"], r["targets"][0], repeats, rest))
        return out

    kinds = [pa.list_(pa.string()), pa.int64(), pa.float64(), pa.int32(), pa.int64()]
    names = ["pattern", "source_size", "target", "repeats", "rest"]
    rows = (row for batch in batches for row in batch.to_pylist())
    out = []
    for _, group in groupby(rows, itemgetter("flow")):
        out += routes(list(group))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _bin() -> F.Column:
    return F.expr(f"shiftrightunsigned(place, {64 - BINS.bit_length() + 1})").cast("int")


def _cut(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with the bin in which each pattern's rest is reached, and the words wanted there."""
    bins = measured.groupBy("pattern", _bin().alias("bin")).agg(F.sum("size").alias("size"))
    before = F.sum("size").over(Window.partitionBy("pattern").orderBy("bin")) - F.col("size")
    bins = bins.select("pattern", "bin", before.alias("before"), "size")
    reached = (
        plan.join(bins, "pattern").where("before <= rest AND rest < before + size")
        .select("pattern", "bin", (F.col("rest") - F.col("before")).alias("wanted"))
    )
    return plan.join(reached, "pattern", "left")


def _within(measured: DataFrame, cut: DataFrame) -> DataFrame:
    """The cut with last (in its bin, documents up to this place are taken) and gap.

    A bin holds one part in BINS of a pattern.
    """
    held = measured.withColumn("bin", _bin()).join(
        cut.where("wanted IS NOT NULL").select("pattern", "bin", "wanted"), ["pattern", "bin"]
    )
    same = held.groupBy("pattern", "bin", "wanted", "place").agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("place"))
    stop = (
        same.withColumn("upto", upto).where("upto <= wanted")
        .groupBy("pattern").agg(F.max("place").alias("last"), F.max("upto").alias("upto"))
    )
    return cut.join(stop, "pattern", "left").withColumn(
        "gap", F.col("wanted") - F.coalesce("upto", F.lit(0))
    ).drop("upto")


def _again() -> F.Column:
    """Whether a document is used once more than its pattern's whole repeats."""
    return F.expr(
        "CASE WHEN rest = 0 OR wanted IS NULL THEN false WHEN __bin = bin"
        " THEN coalesce(place <= last, false) ELSE __bin < bin END"
    )


def _filled(measured: DataFrame, cut: DataFrame) -> DataFrame:
    """The cut with fill: the place of the one document left over that best fits the gap."""
    left = (
        measured.withColumn("__bin", _bin()).join(cut.where("gap > 0"), "pattern")
        .where(~_again()).where("size > 0 AND size < 2 * gap")
        .groupBy("pattern", "place", "gap").agg(F.sum("size").alias("size"))
        .where("size < 2 * gap")
    )
    best = left.groupBy("pattern").agg(
        F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "place")).alias("best")
    ).select("pattern", F.col("best.place").alias("fill"))
    return cut.join(best, "pattern", "left")


def _taken(sized: DataFrame, cut: DataFrame) -> DataFrame:
    limits = cut.withColumnRenamed("pattern", "of")
    more = _again() | F.coalesce(F.col("place") == F.col("fill"), F.lit(False))
    return (
        sized.withColumn("__bin", _bin()).join(limits, F.col("pattern") == F.col("of"))
        .withColumn("times", F.when(F.col("size") == 0, 0)
                    .otherwise(F.col("repeats") + more.cast("int")))
        .withColumn("taken", F.col("size") * F.col("times"))
    )


def mixed_documents(docs: DataFrame, memberships: str = "array(source)") -> DataFrame:
    """Each document as many times as the mix uses it, with the columns of ``docs``."""
    rows = mix(docs.withColumn("__whole", F.struct(*docs.columns)), memberships)
    return rows.where("times > 0").select(
        "__whole", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("__time")
    ).select("__whole.*")
