"""Joins: suffixed equi-joins, anti-joins, lookups, and splitting of hot keys.

No side is broadcast by hint. Sizes are left to the optimizer, which reads them from
statistics and, with adaptive execution, from finished shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key counts as hot from this share of the rows on, so there are at most 200 of them.
HOT_SHARE = 0.005


def _quoted(name: str):
    return F.col(f"`{name}`")


def suffix_overlap(
    left: DataFrame,
    right: DataFrame,
    suffixes: tuple[str, str],
    shared: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Suffix the column names found on both sides, except the shared join keys."""
    overlap = (set(left.columns) & set(right.columns)) - set(shared)

    def renamed(frame: DataFrame, suffix: str) -> DataFrame:
        return frame.select(
            *[_quoted(c).alias(c + suffix if c in overlap else c) for c in frame.columns]
        )

    return renamed(left, suffixes[0]), renamed(right, suffixes[1])


def join_on_different_keys(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    suffixes: tuple[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Inner join on keys with different names; both keys stay, overlapping names are suffixed.

    Null keys match nothing unless ``null_safe``.
    """
    named = {}
    for side, frame, key in ((0, left, left_key), (1, right, right_key)):
        other = (right, left)[side]
        named[side] = key + suffixes[side] if key in other.columns else key
    left, right = suffix_overlap(left, right, suffixes)
    a, b = left[f"`{named[0]}`"], right[f"`{named[1]}`"]
    return left.join(right, a.eqNullSafe(b) if null_safe else a == b)


def join_on_shared_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_safe: bool = False,
) -> DataFrame:
    """Inner join on a key both sides have; it appears once, first among the left columns."""
    left, right = suffix_overlap(left, right, suffixes, [key])
    if not null_safe:
        joined = left.join(right, key)
    else:
        joined = left.join(right, left[f"`{key}`"].eqNullSafe(right[f"`{key}`"])).drop(
            right[f"`{key}`"]
        )
    rest = [c for c in right.columns if c != key]
    return joined.select(*[_quoted(c) for c in [*left.columns, *rest]])


#: Items a sketch of frequent keys holds; its error is below a thousandth of the rows.
SKETCH_ITEMS = 16_384


def hot_keys(frame: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys that hold at least this share of the rows: at most ``1 / share`` of them.

    One pass over the key column, in a sketch of bounded size. Its counts are not too low, so no
    hot key is missed; a key just below the share may be among them.
    """
    most = int(1 / share)
    top = F.expr(f"approx_top_k(`{key}`, {most}, {max(SKETCH_ITEMS, 4 * most)})").alias("top")
    found = frame.where(_quoted(key).isNotNull()).agg(F.count("*").alias("n"), top).first()
    return [entry["item"] for entry in found["top"] or [] if entry["count"] >= share * found["n"]]


def _stable_piece(frame: DataFrame, pieces: int):
    """A piece for each row that is the same when a lost task runs again, in whatever order its rows come.

    Rows that are equal in all columns go apart by the partition they stand in.
    """
    hashable = [f.name for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *map(_quoted, hashable)), F.lit(pieces))


def join_splitting_hot_keys(
    many: DataFrame,
    few: DataFrame,
    many_key: str,
    few_key: str,
    how: str = "inner",
    pieces: int = 64,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Join in which each hot key of ``many`` is dealt over ``pieces`` tasks.

    Rows of ``few`` are repeated for the hot keys only, once per piece, so every pair of
    rows meets once, as in the plain join; ``how`` is inner, left, left_semi or left_anti.
    The columns of ``many`` come first; names must not overlap.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of the repeated side would come out more than once: {how}")
    hot = hot_keys(many, many_key, share)
    if not hot:
        return many.join(few, many[f"`{many_key}`"] == few[f"`{few_key}`"], how)
    dealt = F.when(_quoted(many_key).isin(hot), _stable_piece(many, pieces)).otherwise(F.lit(0))
    left = many.withColumn("_piece", dealt.cast("int"))
    repeats = F.when(
        _quoted(few_key).isin(hot), F.sequence(F.lit(0), F.lit(pieces - 1))
    ).otherwise(F.array(F.lit(0)))
    right = few.withColumn("_few_piece", F.explode(repeats))
    same_key = left[f"`{many_key}`"] == right[f"`{few_key}`"]
    joined = left.join(right, same_key & (left["_piece"] == right["_few_piece"]), how)
    return joined.drop("_piece", "_few_piece")


def without_keys(frame: DataFrame, held: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``frame`` whose key is not among the ``held`` keys.

    ``keys`` maps the frame's key columns to the held table's. A held key with a null in
    it removes nothing. Repeats among the held keys change nothing, so no aggregate stands between
    the shuffle and the join, and adaptive execution can split a hot key.
    """
    taken = held.select(*[_quoted(h).alias(f"_held_{f}") for f, h in keys.items()])
    taken = taken.dropna()
    condition = [frame[f"`{f}`"] == taken[f"_held_{f}"] for f in keys]
    return frame.join(taken, condition, "left_anti")


def key_difference(frame: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``frame`` that ``held`` lacks; a null equals a null here."""
    return frame.select(*keys).subtract(held.select(*keys))


def join_aggregate(frame: DataFrame, aggregate: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join with a side that holds each key once, such as an aggregate by the same keys.

    Such a side comes partitioned by the keys, and a join that takes this over cannot be split at a hot key of the
    frame. A hash of the keys as one more join column gives both sides an exchange of their own, so adaptive
    execution splits a hot key of the frame over tasks and repeats the one row of the aggregate for them.
    """
    code = F.xxhash64(*map(_quoted, keys))
    right = aggregate.withColumn("_key_code", code)
    joined = frame.withColumn("_key_code", code).join(right, [*keys, "_key_code"], how)
    rest = [] if how in ("left_semi", "left_anti") else [c for c in aggregate.columns if c not in keys]
    return joined.select(*map(_quoted, [*frame.columns, *rest]))


def join_spread(frame: DataFrame, values: DataFrame, keys: Sequence[str], pieces: int = 64) -> DataFrame:
    """Left join with a narrow side that holds each key once, every key of the frame dealt over ``pieces`` tasks.

    Each row of ``values`` is repeated for the pieces. No key is counted first and nothing is left to adaptive
    execution, so wide rows of one key, also of a null one, stay apart under any settings.
    """
    left = frame.withColumn("_piece", _stable_piece(frame, pieces).cast("int"))
    right = values.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    rest = [c for c in values.columns if c not in keys]
    return left.join(right, [*keys, "_piece"], "left").select(*map(_quoted, [*frame.columns, *rest]))


def lookup(frame: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of ``values`` by key; a key without an entry gives nulls.

    ``values`` must hold each key once, as ``last_value`` leaves it.
    """
    return join_aggregate(frame, values, keys, "left")


def lookup_misses(frame: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``frame`` that ``values`` lacks."""
    return frame.select(*keys).distinct().join(values.select(*keys), list(keys), "left_anti")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; columns a frame lacks are null."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united
