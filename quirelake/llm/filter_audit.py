"""How filters act together: truth-table survival words, counted by carry-save adders.

With five filters there are 32 subsets. A document becomes one 32-bit word: bit S is set
when the document survives all filters of the subset S. The positions of the words are
counted per part and label in the tasks, by full adders over whole words, and from the 32
survivor counts follows every figure of every order of the filters.
"""

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
BLANKS = "[\\x20\\x09-\\x0D]+"
#: (part, label) pairs a task counts before it hands on what it has.
HELD_GROUPS = 10_000

#: failure mask -> survival word: bit S is set when no filter of S fails.
SURVIVAL = np.array(
    [sum(1 << s for s in range(SUBSETS) if not s & mask) for mask in range(SUBSETS)], np.uint32
)
_BITS = np.arange(SUBSETS, dtype=np.uint32)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """For each of the 32 positions, how many of the words have that bit set.

    Three words of one weight become a sum of the same weight and a carry of the next one,
    until two at most are left of a weight; only these are read bit by bit.
    """
    counts = np.zeros(SUBSETS, np.int64)
    level, weight = words.astype(np.uint32, copy=False), 1
    while len(level):
        carries = []
        while len(level) >= 3:
            n = len(level) // 3
            a, b, c = level[:n], level[n : 2 * n], level[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate([half ^ c, level[3 * n :]])
        counts += weight * ((level[:, None] >> _BITS) & np.uint32(1)).sum(0, dtype=np.int64)
        level = np.concatenate(carries) if carries else np.empty(0, np.uint32)
        weight *= 2
    return counts


def _count(batches):
    held: dict[tuple, np.ndarray] = {}

    def rows():
        keys = list(held)
        of = np.repeat(np.arange(len(keys)), SUBSETS)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()).take(pa.array(of)),
             pa.array([k[1] for k in keys], pa.int32()).take(pa.array(of)),
             pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(keys))),
             pa.array(np.concatenate([held[k] for k in keys]))],
            ["part", "label", "subset", "n"],
        )
        held.clear()
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode()
        label = batch.column("label").to_numpy(zero_copy_only=False)
        failed = batch.column("failed").to_numpy(zero_copy_only=False)
        key = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + label
        order = np.argsort(key, kind="stable")
        words = SURVIVAL[failed[order]]
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        names = parts.dictionary.to_pylist()
        for at, group in zip(key[order][starts], np.split(words, starts[1:])):
            name = (names[at >> 2], int(at & 3))
            counts = positional_counts(group)
            held[name] = held[name] + counts if name in held else counts
        if len(held) >= HELD_GROUPS:
            yield rows()
    if held:
        yield rows()


def survivors(marked: DataFrame) -> DataFrame:
    """Per part, the survivors of each subset of the filters: part and the arrays ``n``,
    ``good`` and ``toxic`` of 32 longs, by subset.

    ``marked`` has part (string), failed (int, bit i: filter i fails) and label (int,
    bit 0: good, bit 1: toxic).
    """
    counted = marked.select("part", "label", "failed").mapInArrow(
        _count, "part string, label int, subset int, n long"
    )
    sums = counted.groupBy("part", "subset").agg(
        F.sum("n").alias("n"),
        F.sum(F.expr("IF(label & 1 = 1, n, 0L)")).alias("good"),
        F.sum(F.expr("IF(label & 2 = 2, n, 0L)")).alias("toxic"),
    )
    listed = sums.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("by_subset")
    )
    return listed.select("part", *[F.col(f"by_subset.{c}").alias(c) for c in ("n", "good", "toxic")])


def steps() -> list[dict]:
    """Every step of every order: the subset before it, after it, and its filter's number."""
    out = []
    for order in permutations(range(len(LETTERS))):
        before = 0
        for step, x in enumerate(order, 1):
            out.append({"filter_order": "".join(LETTERS[i] for i in order), "step": step,
                        "x": x, "before": before, "after": before | 1 << x})
            before |= 1 << x
    return out


def _shapley(x: int) -> str:
    """Removed by filter x, summed over all orders, in SQL over the array n."""
    terms = []
    for s in range(SUBSETS):
        if not s & 1 << x:
            size = s.bit_count()
            orders = factorial(size) * factorial(len(LETTERS) - 1 - size)
            terms.append(f"{orders} * (n[{s}] - n[{s | 1 << x}])")
    return " + ".join(terms)


def audit(marked: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``marked`` is as in ``survivors``. kept: survivors of the filters up to this step;
    removed: what this step takes away; redundant: fails this filter, but was removed
    before; unique_fails: fails this filter only; good_lost and toxic_lost: removed here and
    so labelled; shapley: removed by this filter, summed over all orders. Without rows
    there is no part and no row.
    """
    everything = SUBSETS - 1
    kinds = "array<struct<filter_order: string, step: int, x: int, before: int, after: int>>"
    step = F.explode(F.from_json(F.lit(json.dumps(steps())), kinds)).alias("s")
    shares = F.array(*[F.expr(_shapley(x)) for x in range(len(LETTERS))]).alias("shares")
    rows = survivors(marked).select("part", "n", "good", "toxic", shares)
    return rows.select("*", step).select("*", "s.*").select(
        "part", "filter_order", "step",
        F.expr("n[after]").alias("kept"),
        F.expr("n[before] - n[after]").alias("removed"),
        F.expr("(n[0] - n[shiftleft(1, x)]) - (n[before] - n[after])").alias("redundant"),
        F.expr(f"n[{everything} - shiftleft(1, x)] - n[{everything}]").alias("unique_fails"),
        F.expr("good[before] - good[after]").alias("good_lost"),
        F.expr("toxic[before] - toxic[after]").alias("toxic_lost"),
        F.expr("shares[x]").alias("shapley"),
    )


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, label and failed of each row of ``docs`` (doc_id, text, lang) under five filters.

    A: under 100 words. B: 100 * distinct words < 80 * words. C: 100 * letters A-Z > 10 *
    code points. D: holds one of ``#$%&*|``. E: the same text under a smaller doc_id. A
    NULL text is empty and a NULL lang the part ''. A row without doc_id makes no copy of
    others, is none, and has no label. Rows that repeat a doc_id and its text are no copies
    of each other. ``labels`` (doc_id, quality, toxic): one row with quality = 1 or toxic = 1
    is enough, whatever others say. Other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    seen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), words.alias("words"),
    )
    n_words = F.size("words")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = [
        n_words < 100,
        F.lit(100) * F.size(F.array_distinct("words")) < F.lit(80) * n_words,
        F.lit(100) * capitals > F.lit(10) * F.length("text"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    mask = sum(F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails))
    rows = seen.select("doc_id", "part", mask.alias("mask"), F.sha2("text", 256).alias("digest"))
    # the joins meet on doc_id: a group of copies is spread by it, rows without one by their text
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "is_first", F.lit(True)
    )
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    told = told.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.coalesce(F.max(F.expr("IF(quality = 1, 1, 0)")), F.lit(0))
         + F.coalesce(F.max(F.expr("IF(toxic = 1, 2, 0)")), F.lit(0))).alias("label")
    )
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (
        rows.join(firsts, ["doc_id", "digest"], "left")
        .withColumn("spread", spread)
        .join(told.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
        .select("part", F.coalesce("label", F.lit(0)).alias("label"),
                (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("failed"))
    )


def _rows_sql() -> str:
    return ", ".join(
        f"('{s['filter_order']}', {s['step']}, {1 << s['x']}, {s['before']}, {s['after']})"
        for s in steps()
    )


AUDIT_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)
                    THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN first < w.doc_id THEN 16 ELSE 0 END AS failed
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
m AS (SELECT part, failed, good, toxic, count(*) AS n FROM f GROUP BY part, failed, good, toxic),
o (filter_order, step, x, before, after) AS (VALUES {_rows_sql()}),
r AS (SELECT part, filter_order, step, x,
             sum(CASE WHEN failed & after = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN failed & before = 0 AND failed & x > 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failed & before > 0 AND failed & x > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = x THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN failed & before = 0 AND failed & x > 0 AND good = 1 THEN n ELSE 0 END)
                 AS good_lost,
             sum(CASE WHEN failed & before = 0 AND failed & x > 0 AND toxic = 1 THEN n ELSE 0 END)
                 AS toxic_lost
      FROM m, o GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""
