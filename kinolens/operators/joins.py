"""Joins by key, by vocabulary and by position.

No join here forces a broadcast on data that can grow: Spark broadcasts a side
when its size is below the configured threshold. Adaptive execution splits hot
keys of the other joins if both sides are plain exchanges, that is if neither is
an aggregate of its own exchange: such a side is stored first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolens.session import materialise

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def small_side(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Broadcast hint for a side whose plan proves that it is small.

    The optimizer knows a most number of rows for plans that end in a limit or
    a bounded literal table. With ``row_bytes`` for each row that bound must fit
    MAX_BROADCAST_BYTES; without a bound, or beyond it, Spark decides by the
    sizes it sees.
    """
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    proven = bound.isDefined() and int(str(bound.get())) * row_bytes <= MAX_BROADCAST_BYTES
    return F.broadcast(df) if proven else df


#: Reviews of one film that one task joins; a film with more is split.
SLICE_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(key, slices) of the keys with more than ``slice_rows`` rows, stored; at most one row per ``slice_rows`` rows of ``df``."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > slice_rows)
    return materialise(counts.select(key, F.ceil(F.col("__n") / slice_rows).cast("int").alias("__slices")), "hot-keys")


def join_reviews_movies(reviews: DataFrame, movies: DataFrame, key: str = "title_url", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Every review with the fields of its film, nulls where there is none.

    Reviews carry their text through this join, so a film with a large share of
    them must not meet in one task, whatever its side of the join is made of.
    Films are counted first, from the key column alone. The reviews of a hot
    film are dealt to slices by a hash of the row, its film goes to every slice,
    and the join is by film and slice. Reviews without a film are dealt out too.
    """
    hot = hot_keys(reviews, key, slice_rows)
    rows = hot.count()
    side = F.broadcast(hot) if rows * 64 <= MAX_BROADCAST_BYTES else hot
    spread = F.xxhash64(*[F.col(c) for c, kind in reviews.dtypes if not kind.startswith("map")])
    salt = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(1 << 16))).otherwise(F.coalesce(F.pmod(spread, F.col("__slices")), F.lit(0)))
    dealt = reviews.join(side, key, "left").withColumn("__salt", salt.cast("int")).drop("__slices")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("__slices", F.lit(1)) - 1))
    films = movies.join(side, key, "left").withColumn("__salt", copies).drop("__slices")
    joined = dealt.join(films, [key, "__salt"], "left")
    return joined.select(key, *[c for c in reviews.columns if c != key], *[c for c in movies.columns if c != key])


def not_yet_seen(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``existing``."""
    return df.join(existing.select(key), key, "left_anti")


def keep_vocabulary(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Token rows whose word is in ``vocab``."""
    return tokens.join(small_side(vocab.select("word")), "word", "left_semi")


def drop_vocabulary(tokens: DataFrame, stops: DataFrame) -> DataFrame:
    """Token rows whose word is not in ``stops``."""
    return tokens.join(small_side(stops.select("word")), "word", "left_anti")


def lookup_vectors(df: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Rows with the vector stored under their key; unknown keys drop out."""
    return df.join(vectors, key, "inner")


def unmatched_keys(df: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """How many rows :func:`lookup_vectors` cannot serve."""
    return df.join(vectors.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


def crawl_frontier(
    keys: DataFrame, key: str, offsets, url: Column, seen: DataFrame | None = None
) -> DataFrame:
    """One request per key and page offset, for keys that are not done yet.

    The offsets are a short literal list, so they are exploded in the row
    instead of joined. ``url`` is built from ``key`` and ``offset``.
    """
    todo = keys.select(key) if seen is None else not_yet_seen(keys.select(key), seen, key)
    pages = todo.select(key, F.explode(F.array(*[F.lit(o) for o in offsets])).alias("offset"))
    return pages.withColumn("url", url)


def zip_by_position(left, right, names=("left", "right")) -> Column:
    """Array of structs: element i of one list with element i of the other."""
    a = F.col(left) if isinstance(left, str) else left
    b = F.col(right) if isinstance(right, str) else right
    return F.zip_with(a, b, lambda x, y: F.struct(x.alias(names[0]), y.alias(names[1])))
