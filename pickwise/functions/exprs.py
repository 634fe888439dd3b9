"""Column expressions shared by the operators.  All are native Catalyst
expressions (codegen-friendly); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
LABEL_TRUE_TEXTS = ("True", "1", "true")
DEFAULT_SYNERGY = 0.5
DEFAULT_PATCH_YEAR = 2020
# Prediction bands on P(radiant): (lower bound exclusive, strength, advice).
BANDS = (
    (0.65, "strong",
     "Radiant should maintain aggressive tempo and secure objectives. Dire needs successful ganks to stabilize."),
    (0.55, "slight",
     "Game is balanced. Both teams should focus on objective control and avoid mistakes."),
    (0.45, "slight",
     "Game is even. Next teamfight will be crucial in determining momentum."),
    (0.35, "strong",
     "Dire has advantage. Radiant needs to avoid fights and farm defensively. Dire should press advantage."),
)
LAST_BAND = ("very strong",
             "Dire has commanding lead. Radiant should defend high ground and look for comeback opportunities.")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_bool(c: Column | str) -> Column:
    """A boolean outcome, also from text; unreadable text gives NULL."""
    return col_(c).try_cast("boolean")


def label_from_bool(radiant_win: Column | str = "radiant_win") -> Column:
    """1.0 when the outcome is true; false and NULL give 0.0."""
    return F.when(as_bool(radiant_win), F.lit(1.0)).otherwise(F.lit(0.0))


def label_from_text(radiant_win: Column | str = "radiant_win") -> Column:
    """Text-tolerant label: 'True', '1', 'true' give 1, anything else (and NULL) 0."""
    return F.when(col_(radiant_win).cast("string").isin(*LABEL_TRUE_TEXTS), F.lit(1)).otherwise(F.lit(0))


def score_wins(score: Column | str, other: Column | str) -> Column:
    """1 when `score` beats `other`; ties and NULLs give 0."""
    return F.when(col_(score) > col_(other), F.lit(1)).otherwise(F.lit(0))


def side_won(team: Column | str = "team", radiant_win: Column | str = "radiant_win") -> Column:
    """Per-row win flag from the side and a boolean outcome (NULL outcome: not won)."""
    t, rw = col_(team), as_bool(radiant_win)
    return (
        F.when(((t == 0) & (rw == F.lit(True))) | ((t == 1) & (rw == F.lit(False))), F.lit(1))
        .otherwise(F.lit(0))
    )


def side_won_scores(team: Column | str, radiant_win: Column | str, dire_win: Column | str) -> Column:
    """Per-row win flag from the side and two 0/1 score outcomes."""
    t = col_(team)
    return (
        F.when((t == 0) & (col_(radiant_win) == 1), F.lit(1))
        .when((t == 1) & (col_(dire_win) == 1), F.lit(1))
        .otherwise(F.lit(0))
    )


def weighted_pairs(counts: Column | str, with_self: bool, left: str = "hero1", right: str = "hero2") -> Column:
    """Pairs of a multiset given as a sorted array<struct<hero, n>> of distinct heroes.

    Emits (h_i, h_j, n_i * n_j) for i < j and, if `with_self`, (h, h, n(n-1)/2)
    for heroes present more than once: the same pair counts as expanding the
    multiset and taking all index pairs, but bounded by the hero vocabulary
    instead of the group size.
    """
    a = col_(counts)
    cross = F.flatten(
        F.transform(
            a,
            lambda x, i: F.transform(
                F.slice(a, i + 2, F.greatest(F.size(a) - i - 1, F.lit(0))),
                lambda y: F.struct(
                    x["hero"].alias(left), y["hero"].alias(right), (x["n"] * y["n"]).alias("w")
                ),
            ),
        )
    )
    if not with_self:
        return cross
    selfs = F.transform(
        F.filter(a, lambda x: x["n"] > 1),
        lambda x: F.struct(
            x["hero"].alias(left), x["hero"].alias(right), (x["n"] * (x["n"] - 1) / 2).cast("long").alias("w")
        ),
    )
    return F.concat(selfs, cross)


def nan_to_zero(x: Column | str, digits: int | None = None) -> Column:
    """NULL or NaN become 0.0, optionally rounded."""
    v = F.coalesce(F.nanvl(col_(x).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.round(v, digits) if digits is not None else v


def per_second(rows: Column | str, seconds: Column | str) -> Column:
    """Rows per second, 0 when the time is not positive."""
    return F.when(col_(seconds) > 0, col_(rows) / col_(seconds)).otherwise(F.lit(0.0))


def band_strength(p: Column | str) -> Column:
    x = col_(p)
    expr = None
    for bound, strength, _ in BANDS:
        expr = F.when(x > bound, F.lit(strength)) if expr is None else expr.when(x > bound, F.lit(strength))
    return expr.otherwise(F.lit(LAST_BAND[0]))


def band_advice(p: Column | str) -> Column:
    x = col_(p)
    expr = None
    for bound, _, advice in BANDS:
        expr = F.when(x > bound, F.lit(advice)) if expr is None else expr.when(x > bound, F.lit(advice))
    return expr.otherwise(F.lit(LAST_BAND[1]))
