"""Hero pair and hero statistics: team hero lists, within-team pairs, pair win
rates, per-match synergy, hero meta, synergy wins and counter wins.

Pairs are generated from per-(match, side, hero) multiplicities, never from the
raw rows of a group: a group expands to at most H·(H+1)/2 weighted pairs (H =
hero vocabulary), whatever its row count, and the multiplicity pre-aggregate
collapses a hot (match, side, hero) key map-side before the first shuffle.
All pair tables are keyed by two hero ids, so they are bounded by H².
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions import exprs as X
from pickwise.operators.draft import dedupe_matches, label_from_scores
from pickwise.plans.guards import Lookup

MIN_GAMES_FOR_SYNERGY = 10


def side_hero_counts(picks: DataFrame, picks_only: bool = True, sides: tuple[int, ...] | None = None) -> DataFrame:
    """(match_id, team, hero_id, n): multiplicity of a hero on a side of a match."""
    p = picks.where(F.col("hero_id").isNotNull())
    if picks_only:
        p = p.where(F.col("is_pick") == F.lit(True))
    if sides is not None:
        p = p.where(F.col("team").isin(*sides))
    return p.groupBy("match_id", "team", "hero_id").agg(F.count(F.lit(1)).alias("n"))


def _side_multisets(counts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(match_id, team, *extra, heroes: sorted array<struct<hero, n>>) — ≤ H elements."""
    return counts.groupBy("match_id", "team", *extra).agg(
        F.sort_array(F.collect_list(F.struct(F.col("hero_id").alias("hero"), F.col("n")))).alias("heroes")
    )


def team_heroes(picks: DataFrame) -> DataFrame:
    """(match_id, team, heroes): the sorted hero list of each side (pick rows)."""
    ms = _side_multisets(side_hero_counts(picks))
    expanded = F.flatten(F.transform("heroes", lambda x: F.array_repeat(x["hero"], x["n"].cast("int"))))
    return ms.select("match_id", "team", expanded.alias("heroes"))


def team_pairs(picks: DataFrame) -> DataFrame:
    """(match_id, team, hero1, hero2, pairs): unordered within-side pick pairs,
    hero1 ≤ hero2; a hero picked twice gives (h, h)."""
    ms = _side_multisets(side_hero_counts(picks))
    return ms.select("match_id", "team", F.inline(X.weighted_pairs("heroes", with_self=True))).withColumnRenamed(
        "w", "pairs"
    )


def match_multisets(picks: DataFrame) -> DataFrame:
    """(match_id, heroes): one sorted array<struct<team, hero, n>> per match over
    pick rows (≤ sides·H entries).  Shared by the pair statistics and the match
    synergy so that a query using both reuses one exchange."""
    entry = F.struct(F.col("team"), F.col("hero_id").alias("hero"), F.col("n"))
    return side_hero_counts(picks).groupBy("match_id").agg(F.sort_array(F.collect_list(entry)).alias("heroes"))


def same_side_pairs(arr) -> "F.Column":
    """Weighted pairs of a sorted (team, hero, n) array within equal teams (null-safe):
    (team, hero1, hero2, w) with hero1 ≤ hero2; a hero listed n > 1 times adds (h, h)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    cross = F.flatten(F.transform(a, lambda x, i: F.transform(
        F.filter(F.slice(a, i + 2, F.greatest(F.size(a) - i - 1, F.lit(0))), lambda y: y["team"].eqNullSafe(x["team"])),
        lambda y: F.struct(x["team"].alias("team"), x["hero"].alias("hero1"), y["hero"].alias("hero2"), (x["n"] * y["n"]).alias("w")),
    )))
    selfs = F.transform(F.filter(a, lambda x: x["n"] > 1), lambda x: F.struct(
        x["team"].alias("team"), x["hero"].alias("hero1"), x["hero"].alias("hero2"), (x["n"] * (x["n"] - 1) / 2).cast("long").alias("w")))
    return F.concat(selfs, cross)


def pair_synergy_winrate(picks: DataFrame, meta: DataFrame, min_games: int = MIN_GAMES_FOR_SYNERGY) -> DataFrame:
    """(hero1, hero2, games, wins, win_rate) over same-side pick pairs, games ≥ min_games.

    ``meta`` gives the boolean outcome (one row per match); a NULL outcome is a loss
    for both sides.  Fit this on training matches only when it feeds a model.
    One multiset per match (sorted by side, hero) keeps the rows hash-partitioned
    on match_id, so the outcome join adds no exchange on the pick side; pairs are
    formed within a side only (sides compared null-safely, like a grouping key).
    """
    per_match = match_multisets(picks)
    outcome = dedupe_matches(meta.select("match_id", "radiant_win"))
    pairs = per_match.join(outcome, "match_id", "inner").select(
        F.inline(same_side_pairs("heroes")), "radiant_win"
    ).select("hero1", "hero2", "w", X.side_won().alias("won"))
    stats = pairs.groupBy("hero1", "hero2").agg(
        F.sum("w").cast("long").alias("games"),
        F.sum(F.col("w") * F.col("won")).cast("long").alias("wins"),
    )
    return stats.where(F.col("games") >= min_games).withColumn("win_rate", F.col("wins") / F.col("games"))


def match_synergy(picks: DataFrame, stats: DataFrame, matches: DataFrame | None = None, all_matches: bool = True) -> DataFrame:
    """(match_id, radiant_synergy, dire_synergy, synergy_diff).

    A side's synergy is the mean pair win rate over its within-side pairs found in
    ``stats``; no pair found (or fewer than two heroes) gives 0.5.  ``matches``
    (default: every match of ``picks``) fixes the output rows; ``all_matches=False``
    returns only matches with a found pair (radiant/dire synergy, NULL for a
    side without one).  Both sides'
    multisets live in one row per match, so after the lookup of the pair rates the
    per-match average needs no further shuffle: ``stats`` is keyed by two heroes
    (≤ H² rows), materialised, measured and broadcast; pair rows are never shuffled
    on hero keys.
    """
    sides01 = F.filter("heroes", lambda x: x["team"].isin(0, 1))
    pairs = match_multisets(picks).select("match_id", F.inline(same_side_pairs(sides01)))
    found = Lookup(stats.select("hero1", "hero2", "win_rate")).join(pairs, ["hero1", "hero2"])
    per_side = found.groupBy("match_id").agg(
        *[
            (
                F.sum(F.when(F.col("team") == t, F.col("w") * F.col("win_rate")))
                / F.sum(F.when(F.col("team") == t, F.col("w")))
            ).alias(f"{side}_synergy")
            for t, side in ((0, "radiant"), (1, "dire"))
        ]
    )
    if not all_matches:  # only matches with a found pair; the caller joins and fills
        return per_side
    if matches is None:
        matches = picks.select("match_id").distinct()
    out = matches.join(per_side, "match_id", "left").fillna(
        X.DEFAULT_SYNERGY, subset=["radiant_synergy", "dire_synergy"]
    )
    return out.withColumn("synergy_diff", F.col("radiant_synergy") - F.col("dire_synergy"))


# ----------------------------------------------------------------------------
# Score-outcome statistics (hero meta, synergy wins, counter wins)
# ----------------------------------------------------------------------------

def hero_rows(picks: DataFrame, meta: DataFrame, include_bans: bool = True) -> DataFrame:
    """Draft rows joined with score outcomes: (match_id, team, hero_id, hero_win).

    ``include_bans=True`` keeps ban rows too (the reference counts them as picks).
    """
    rows = picks if include_bans else picks.where(F.col("is_pick") == F.lit(True))
    return rows.join(label_from_scores(dedupe_matches(meta)), "match_id", "inner").select(
        "match_id", "team", "hero_id",
        X.side_won_scores("team", "radiant_win", "dire_win").alias("hero_win"),
    )


def hero_meta(picks: DataFrame, meta: DataFrame, include_bans: bool = True) -> DataFrame:
    """(hero_id, pick_count, wins, win_rate, pick_rate) per hero.

    win_rate = wins / pick_count and pick_rate = pick_count / matches, both cast
    to float (then widened to double).  Rows are first collapsed to
    (match, side, hero) counts — map-side, so a hot match is one row per hero
    before any shuffle — and then to one row per match, which is joined with the
    outcomes once.  That row yields its heroes and one more entry, marked as the
    match itself, so one scan and one aggregate give the hero sums and the match
    total; the total is read back over the ≤ H + 1 result rows.
    """
    rows = picks if include_bans else picks.where(F.col("is_pick") == F.lit(True))
    counts = rows.groupBy("match_id", "team", "hero_id").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.lit(False).alias("is_match"), F.col("team"), F.col("hero_id"), F.col("n"))
    per_match = counts.groupBy("match_id").agg(F.collect_list(entry).alias("heroes"))
    own = F.array(F.struct(F.lit(True).alias("is_match"), F.lit(None).cast("int").alias("team"), F.lit(None).cast("int").alias("hero_id"), F.lit(1).cast("bigint").alias("n")))
    joined = per_match.join(label_from_scores(dedupe_matches(meta)), "match_id", "inner").select(
        F.inline(F.concat("heroes", own)), "radiant_win", "dire_win"
    )
    won = X.side_won_scores("team", "radiant_win", "dire_win")
    agg = joined.groupBy("is_match", "hero_id").agg(
        F.sum("n").cast("long").alias("pick_count"),
        F.sum(F.col("n") * won).cast("long").alias("wins"),
    )
    total = F.max(F.when(F.col("is_match"), F.col("pick_count"))).over(Window.partitionBy())  # ≤ H + 1 rows
    as_float = lambda c: c.cast("float").cast("double")
    return agg.withColumn("total", total).where(~F.col("is_match")).select(
        "hero_id", "pick_count", "wins",
        as_float(F.col("wins") / F.col("pick_count")).alias("win_rate"),
        as_float(F.col("pick_count") / F.col("total")).alias("pick_rate"),
    )


def pair_synergy_wins(picks: DataFrame, meta: DataFrame, include_bans: bool = True, team: int = 0) -> DataFrame:
    """(h1, h2, wins): for every match, each pair of distinct heroes h1 < h2 on side
    ``team`` adds that side's win (0/1) times the pair multiplicity."""
    counts = side_hero_counts(picks, picks_only=not include_bans, sides=(team,))
    won_col = "radiant_win" if team == 0 else "dire_win"
    ms = _side_multisets(counts).join(label_from_scores(dedupe_matches(meta)), "match_id", "inner")
    pairs = ms.select(F.inline(X.weighted_pairs("heroes", with_self=False, left="h1", right="h2")), F.col(won_col).alias("won"))
    return pairs.groupBy("h1", "h2").agg(F.sum(F.col("w") * F.col("won")).cast("long").alias("wins"))


def counter_wins(picks: DataFrame, meta: DataFrame, include_bans: bool = True) -> DataFrame:
    """(counter_hero, target_hero, wins): for every match, each dire hero × radiant
    hero adds the dire win (0/1) times both multiplicities."""
    counts = side_hero_counts(picks, picks_only=not include_bans, sides=(0, 1))
    hero = F.struct(F.col("hero_id").alias("hero"), F.col("n"))
    per_match = counts.groupBy("match_id").agg(
        F.collect_list(F.when(F.col("team") == 0, hero)).alias("rad"),
        F.collect_list(F.when(F.col("team") == 1, hero)).alias("dire"),
    )
    cross = F.flatten(
        F.transform(
            "dire",
            lambda d: F.transform(
                "rad",
                lambda r: F.struct(d["hero"].alias("counter_hero"), r["hero"].alias("target_hero"), (d["n"] * r["n"]).alias("w")),
            ),
        )
    )
    pairs = per_match.join(label_from_scores(dedupe_matches(meta)), "match_id", "inner").select(F.inline(cross), "dire_win")
    return pairs.groupBy("counter_hero", "target_hero").agg(
        F.sum(F.col("w") * F.col("dire_win")).cast("long").alias("wins")
    )
