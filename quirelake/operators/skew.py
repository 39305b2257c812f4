"""Left outer joins that survive a heavy key.

Spark's adaptive skew join splits only the preserved side of an outer join,
so a key that holds a large share of the *right* side would end in one task.
Here a mergeable sketch, one small state per task, names the keys that may be heavy, and
only those are counted exactly; no side is shuffled on its keys for it.  The side that
owns most of a heavy key's rows is spread over several salts, and the other sides'
rows of that key are repeated once per salt.  All other keys keep salt 0.

The inputs must be distinct rows: spreading hashes the whole row.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
_OWNER = "__owner"
_SALTS = "__salts"
_HIT = "__hit"


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as heavy.

    min_rows: rows of one key that one task may take; also the rows per salt
    """

    min_rows: int = 1_000_000


DEFAULT_POLICY = SkewPolicy()

#: Keys a sketch tracks. It surely names a key with more than about 1 in 10,000 of all rows;
#: a smaller one is no larger than a shuffle partition of so many rows should be.
TRACKED = 65_536
#: The most keys a sketch of that size holds, so none that it names is left out.
NAMED = TRACKED * 3 // 4
#: Sketches of tasks meet in so many groups before they meet in one.
_GROUPS = 64


def _rows(side: str) -> str:
    return f"__rows_{side}"


def _key_hash(keys: list[str]):
    return F.xxhash64(*keys).alias("__key")


def candidate_keys(sides: dict[str, DataFrame], keys: list[str], policy: SkewPolicy) -> DataFrame:
    """Hashes of the keys that may be heavy: ``NAMED`` at most, none where nothing is.

    What leaves a task is its sketch, whatever the number of keys.
    """
    hashes = [with_keys(df.select(*keys), keys).select(_key_hash(keys)) for df in sides.values()]
    every = reduce(DataFrame.unionByName, hashes)
    by_group = every.groupBy((F.spark_partition_id() % _GROUPS).alias("__group")).agg(
        F.expr(f"approx_top_k_accumulate(__key, {TRACKED})").alias("__sketch")
    )
    # grouped, as this aggregate fails in tasks without rows otherwise
    whole = by_group.groupBy(F.lit(0).alias("__all")).agg(
        F.expr(f"approx_top_k_combine(__sketch, {TRACKED})").alias("__sketch")
    )
    named = whole.select(F.explode(F.expr(f"approx_top_k_estimate(__sketch, {NAMED})")).alias("__n"))
    # estimates are never too small
    return named.where(F.col("__n.count") >= policy.min_rows).select(F.col("__n.item").alias("__key"))


def heavy_keys(
    sides: dict[str, DataFrame],
    keys: list[str],
    policy: SkewPolicy,
    needs: dict[str, str] | None = None,
) -> DataFrame:
    """The heavy keys with their owner side and salt count, counted exactly.

    There are ``NAMED`` at most, whatever the input, so the table is broadcast.
    ``needs`` names, for a side, another side without which its rows of a key
    can never be joined; it owns no key that the other side lacks.
    """
    needs = needs or {}
    candidates = candidate_keys(sides, keys, policy)
    tagged = [
        df.select(*keys, F.lit(side).alias("__side"), _key_hash(keys))
        for side, df in sides.items()
    ]
    per_key = (
        reduce(DataFrame.unionByName, tagged)
        .join(F.broadcast(candidates), "__key", "left_semi")
        .groupBy(*keys)
        .agg(*[F.count_if(F.col("__side") == side).alias(_rows(side)) for side in sides])
    )
    counts = {
        side: F.when(F.col(_rows(needs[side])) > 0, F.col(_rows(side))).otherwise(0)
        if side in needs
        else F.col(_rows(side))
        for side in sides
    }
    most = F.greatest(*counts.values())
    owner = F.coalesce(*[F.when(n == most, F.lit(side)) for side, n in counts.items()])
    return with_keys(per_key.where(most >= policy.min_rows), keys).select(
        *keys,
        owner.alias(_OWNER),
        F.ceil(most / policy.min_rows).cast("int").alias(_SALTS),
    )


def place(
    df: DataFrame,
    side: str,
    heavy: DataFrame,
    keys: list[str],
    preserved: bool = False,
) -> DataFrame:
    """Add the salt: spread the rows of owned keys, repeat those of others' keys.

    Preserved rows with a NULL key match nothing; each gets a salt of its own
    hash, so they lie wherever there is room.
    """
    columns = df.columns
    row_hash = "xxhash64({})".format(", ".join(f"`{c}`" for c in columns))
    unmatched = " OR ".join(f"`{k}` IS NULL" for k in keys) if preserved else "false"
    salts = f"""
        CASE WHEN {unmatched} THEN array(int(pmod({row_hash}, 2147483647)))
             WHEN {_OWNER} = '{side}' THEN array(int(pmod({row_hash}, {_SALTS})))
             WHEN {_OWNER} IS NOT NULL THEN sequence(0, {_SALTS} - 1)
             ELSE array(0)
        END"""
    marked = df.join(F.broadcast(heavy), keys, "left")
    return marked.select(*columns, _OWNER, F.expr(f"explode({salts})").alias(_SALT))


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that can be joined at all; stated early, so every use shares one scan."""
    return df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def _met(hit: str, *owners: str) -> str:
    """Leaves out a repeated row that met no partner on its salt.

    It meets one on another salt: the owner of its key has rows.
    """
    listed = ", ".join(f"'{owner}'" for owner in owners)
    return f"{hit} IS NOT NULL OR {_OWNER} IS NULL OR {_OWNER} NOT IN ({listed})"


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``left`` left outer join ``right`` on equal keys (both distinct)."""
    right = with_keys(right, keys)
    heavy = heavy_keys({"left": left, "right": right}, keys, policy)
    placed_left = place(left, "left", heavy, keys, preserved=True)
    placed_right = place(right, "right", heavy, keys)
    joined = placed_left.join(
        placed_right.drop(_OWNER).withColumn(_HIT, F.lit(True)),
        [*keys, _SALT],
        "left",
    )
    kept = joined.where(_met(_HIT, "right"))
    added = [c for c in right.columns if c not in keys]
    return kept.select(*left.columns, *added)


def chained_left_join(
    first: DataFrame,
    second: DataFrame,
    third: DataFrame,
    keys: list[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``first`` join ``second`` join ``third``, the last keyed on ``second``.

    A row without a partner in ``second`` gets nothing from ``third`` either,
    so ``second`` and ``third`` are joined first.  Both joins then hash on the
    same keys: each input is shuffled once, and no shuffle carries the NULL
    keys of unmatched rows.
    """
    second, third = with_keys(second, keys), with_keys(third, keys)
    sides = {"first": first, "second": second, "third": third}
    heavy = heavy_keys(sides, keys, policy, needs={"third": "second"})
    on = [*keys, _SALT]

    head = place(first, "first", heavy, keys, preserved=True)
    middle = place(second, "second", heavy, keys)
    tail = place(third, "third", heavy, keys).drop(_OWNER)

    pair = middle.join(tail.withColumn("__hit_third", F.lit(True)), on, "left")
    pair = pair.where(_met("__hit_third", "third"))
    pair = pair.drop(_OWNER, "__hit_third").withColumn(_HIT, F.lit(True))

    joined = head.join(pair, on, "left")
    kept = joined.where(_met(_HIT, "second", "third"))
    added = [c for df in (second, third) for c in df.columns if c not in keys]
    return kept.select(*first.columns, *added)


def star_left_join(
    first: DataFrame,
    second: DataFrame,
    third: DataFrame,
    keys: list[str],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``first`` joined to ``second`` and to ``third``, both keyed on ``first``."""
    second, third = with_keys(second, keys), with_keys(third, keys)
    sides = {"first": first, "second": second, "third": third}
    heavy = heavy_keys(sides, keys, policy)
    on = [*keys, _SALT]

    head = place(first, "first", heavy, keys, preserved=True)
    middle = place(second, "second", heavy, keys).drop(_OWNER)
    tail = place(third, "third", heavy, keys).drop(_OWNER)

    pair = head.join(middle.withColumn(_HIT, F.lit(True)), on, "left")
    pair = pair.where(_met(_HIT, "second")).drop(_HIT)
    joined = pair.join(tail.withColumn(_HIT, F.lit(True)), on, "left")
    kept = joined.where(_met(_HIT, "third"))
    added = [c for df in (second, third) for c in df.columns if c not in keys]
    return kept.select(*first.columns, *added)
