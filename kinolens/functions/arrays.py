"""Parsing string-encoded values, label vectors and vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinolens.labels import KEPT_POSITIONS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- values that arrive wrapped in quotes or brackets ----


def strip_outer(c, left: int = 1, right: int = 1) -> Column:
    """Text without its first ``left`` and last ``right`` characters."""
    text = _col(c)
    return F.substring(text, F.lit(left + 1), F.greatest(F.length(text) - (left + right), F.lit(0)))


def parse_bracketed_int(c) -> Column:
    """``"[123]"`` to 123."""
    return F.trim(strip_outer(c)).try_cast("int")


def parse_nested_vector(c) -> Column:
    """``"[[0.1,2]]"`` to an array of double."""
    return F.get(F.from_json(_col(c), "array<array<double>>"), F.lit(0))


def parse_bool_vector(c) -> Column:
    """``"[true,false]"`` to ``[1, 0]``; anything but ``true`` is 0."""
    return F.transform(F.split(strip_outer(c), ","), lambda x: (x == "true").cast("int"))


def parse_number_vector(c) -> Column:
    """``"[0 1 0]"`` to an array of double."""
    return F.transform(F.split(F.trim(strip_outer(c)), r"\s+"), lambda x: x.try_cast("double"))


def parse_rating(c) -> Column:
    """Digits in front of ``/10``; null for any other text."""
    return F.regexp_extract(_col(c), r"(\d+)/10", 1).try_cast("int")


# ---- genre strings and label vectors ----


def split_genres(c, sep: str = r"\|") -> Column:
    """Trimmed, lower-case, sorted genre names of a ``' | '`` joined text."""
    names = F.transform(F.split(F.lower(_col(c)), sep), lambda g: F.regexp_replace(g, r"(?U)^\s+|\s+$", ""))
    return F.array_sort(F.array_remove(names, ""))


def normalise_genres(c, drop=None, keep=None) -> Column:
    """Sorted genre text without the names in ``drop``, or only those in ``keep``."""
    names = split_genres(c)
    if keep is not None:
        names = F.filter(names, lambda g: g.isin(list(keep)))
    if drop is not None:
        names = F.filter(names, lambda g: ~g.isin(list(drop)))
    return F.array_join(names, " | ")


def genre_vector(genres, labels) -> Column:
    """0/1 membership of each label, in label order."""
    names = _col(genres)
    return F.array(*[F.array_contains(names, label).cast("int") for label in labels])


def select_labels(vector, positions=tuple(KEPT_POSITIONS)) -> Column:
    """The given positions of a label vector."""
    v = _col(vector)
    return F.array(*[F.get(v, F.lit(i)) for i in positions])


def names_of(vector, labels) -> Column:
    """Names of the labels that are on."""
    v = _col(vector)
    return F.array_compact(F.array(*[F.when(F.get(v, F.lit(i)) == 1, F.lit(x)) for i, x in enumerate(labels)]))


# ---- scores ----


def round_half_even(c) -> Column:
    """Nearest integer, ties to the even one."""
    return F.bround(_col(c), 0).cast("int")


def threshold(c, n: float) -> Column:
    """1 from ``n`` upward, else 0."""
    return (_col(c) >= F.lit(n)).cast("int")


def threshold_vector(c, n: float) -> Column:
    return F.transform(_col(c), lambda p: (p >= F.lit(n)).cast("int"))


# ---- vectors ----


def dot(a, b) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalise(a) -> Column:
    """Vector of length one; a zero vector stays as it is."""
    unit = F.transform(
        F.array(F.struct(_col(a).alias("v"), norm(a).alias("len"))),
        lambda s: F.transform(s["v"], lambda x: F.when(s["len"] > 0, x / s["len"]).otherwise(x)),
    )
    return F.get(unit, F.lit(0))


def cosine_similarity(a, b) -> Column:
    """Cosine of two vectors; 0 when either has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))
