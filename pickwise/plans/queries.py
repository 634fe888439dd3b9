"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame built
from the driver tables through the fixture views.  Columns that the oracle
rounds are rounded identically here (floating sums differ in order only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickwise.operators import draft as D
from pickwise.operators import ml as M
from pickwise.operators import pairs as P
from pickwise.operators import recommend as R
from pickwise.operators import series as S
from pickwise.plans import features as FE
from pickwise.plans.guards import materialize, written
from pickwise.sources import views as V


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ statistics
def hero_meta(spark: SparkSession, sf: str) -> DataFrame:
    return P.hero_meta(V.picks_bans(spark, sf), V.metadata(spark, sf))


def pair_synergy_wins(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_synergy_wins(V.picks_bans(spark, sf), V.metadata(spark, sf))


def counter_wins(spark: SparkSession, sf: str) -> DataFrame:
    return P.counter_wins(V.picks_bans(spark, sf), V.metadata(spark, sf))


def _recommender_inputs(spark: SparkSession, sf: str):
    pb, md = written(V.picks_bans(spark, sf)), V.metadata(spark, sf)  # read by every step
    return pb, P.hero_meta(pb, md), R.score_lookups(pb, md)


SCORE_DIGITS = {"score": 9, "synergy_score": 9, "counter_score": 9, "meta_score": 9}


def recommend_topk(spark: SparkSession, sf: str) -> DataFrame:
    pb, meta, lookups = _recommender_inputs(spark, sf)
    return _r(R.recommend_topk(V.drafts(spark, sf, pb), meta, k=3, lookups=lookups), SCORE_DIGITS)


def hero_score(spark: SparkSession, sf: str) -> DataFrame:
    pb, meta, lookups = _recommender_inputs(spark, sf)
    return _r(R.hero_score(V.drafts(spark, sf, pb), V.candidates(spark, sf, pb), meta, lookups=lookups), SCORE_DIGITS)


def _listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata in which every third match is listed twice."""
    md = V.metadata(spark, sf)
    return md.union(md.where(F.col("match_id") % 3 == 0))


def hero_meta_dup(spark: SparkSession, sf: str) -> DataFrame:
    return P.hero_meta(V.picks_bans(spark, sf), _listed_twice(spark, sf))


def pair_synergy_winrate_dup(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_synergy_winrate(V.picks_bans(spark, sf), _listed_twice(spark, sf))


def draft_features_dup(spark: SparkSession, sf: str) -> DataFrame:
    df = FE.draft_features(written(V.picks_bans(spark, sf)), _listed_twice(spark, sf), V.draft_timings(spark, sf), hero_ids=range(V.HERO_POOL))
    return _r(df, {"std_pick_time": 6, "radiant_synergy": 6, "dire_synergy": 6, "synergy_diff": 6})


# ------------------------------------------------------------------ draft blocks
def dedupe_matches(spark: SparkSession, sf: str) -> DataFrame:
    return D.dedupe_matches(V.draft_timings(spark, sf), prefer=())


def match_label(spark: SparkSession, sf: str) -> DataFrame:
    return D.match_label(V.metadata(spark, sf))


def match_label_text(spark: SparkSession, sf: str) -> DataFrame:
    return D.match_label_text(V.metadata(spark, sf))


def label_from_scores(spark: SparkSession, sf: str) -> DataFrame:
    return D.label_from_scores(V.metadata(spark, sf))


def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return D.label_distribution(D.match_label(V.metadata(spark, sf)))


def hero_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return D.hero_vocabulary(V.picks_bans(spark, sf))


def hero_onehot(spark: SparkSession, sf: str) -> DataFrame:
    return D.hero_onehot(V.picks_bans(spark, sf), range(V.HERO_POOL))


def hero_onehot_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """The sparse vectors, as the list of their non-zero column names."""
    from pyspark.ml.functions import vector_to_array

    names = D.onehot_columns(range(V.HERO_POOL))
    df = D.hero_onehot_sparse(V.picks_bans(spark, sf), range(V.HERO_POOL)).select("match_id", vector_to_array("draft_onehot").alias("v"))
    named = F.filter(F.transform(F.col("v"), lambda x, i: F.when(x > 0, F.element_at(F.array(*map(F.lit, names)), i + 1))), lambda x: x.isNotNull())
    return df.select("match_id", F.array_join(F.array_sort(named), ",").alias("present"), F.size(named).cast("long").alias("n_present"))


def pick_order(spark: SparkSession, sf: str) -> DataFrame:
    return D.pick_order(V.picks_bans(spark, sf))


def draft_counts(spark: SparkSession, sf: str) -> DataFrame:
    return D.draft_counts(V.picks_bans(spark, sf))


def draft_timing(spark: SparkSession, sf: str) -> DataFrame:
    return _r(D.draft_timing(V.draft_timings(spark, sf)), {"std_pick_time": 6})


def patch_feature(spark: SparkSession, sf: str) -> DataFrame:
    md = V.metadata(spark, sf)
    base = V.picks_bans(spark, sf).select("match_id").distinct()
    return D.patch_feature(D.patch_feature(base, md), md.drop("patch"))


def team_heroes(spark: SparkSession, sf: str) -> DataFrame:
    th = P.team_heroes(V.picks_bans(spark, sf))
    return th.select("match_id", "team", F.array_join("heroes", ",").alias("heroes"), F.size("heroes").cast("long").alias("n_heroes"))


def team_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return P.team_pairs(V.picks_bans(spark, sf))


def pair_synergy_winrate(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_synergy_winrate(V.picks_bans(spark, sf), V.metadata(spark, sf))


def match_synergy(spark: SparkSession, sf: str) -> DataFrame:
    pb, md = V.picks_bans(spark, sf), V.metadata(spark, sf)
    ms = P.match_synergy(pb, P.pair_synergy_winrate(pb, md))
    return _r(ms, {"radiant_synergy": 6, "dire_synergy": 6, "synergy_diff": 6})


# ------------------------------------------------------------------ early game
def series_gold_early(spark: SparkSession, sf: str) -> DataFrame:
    return _r(S.series_early(V.gold_adv(spark, sf), "gold"), {"gold_avg_10min": 6, "gold_volatility_10min": 6})


def series_exp_early(spark: SparkSession, sf: str) -> DataFrame:
    return _r(S.series_early(V.exp_adv(spark, sf), "exp"), {"exp_avg_10min": 6, "exp_volatility_10min": 6})


def series_trend(spark: SparkSession, sf: str) -> DataFrame:
    return S.series_trend(V.gold_adv(spark, sf), "gold")


def objectives_early(spark: SparkSession, sf: str) -> DataFrame:
    return S.objectives_early(V.objectives(spark, sf))


def teamfights_early(spark: SparkSession, sf: str) -> DataFrame:
    return S.teamfights_early(V.teamfights(spark, sf))


EARLY_DIGITS = {"gold_avg_10min": 6, "gold_volatility_10min": 6, "exp_avg_10min": 6, "exp_volatility_10min": 6}


def early_table(spark: SparkSession, sf: str) -> DataFrame:
    return FE.early_features(
        V.picks_bans(spark, sf), V.metadata(spark, sf), V.gold_adv(spark, sf), V.exp_adv(spark, sf),
        V.objectives(spark, sf), V.teamfights(spark, sf),
    )


def early_features(spark: SparkSession, sf: str) -> DataFrame:
    return _r(early_table(spark, sf), EARLY_DIGITS)


def draft_features(spark: SparkSession, sf: str) -> DataFrame:
    df = FE.draft_features(written(V.picks_bans(spark, sf)), V.metadata(spark, sf), V.draft_timings(spark, sf), hero_ids=range(V.HERO_POOL))
    return _r(df, {"std_pick_time": 6, "radiant_synergy": 6, "dire_synergy": 6, "synergy_diff": 6})


# ------------------------------------------------------------------ ML plumbing
def split_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return M.split_keyed(V.metadata(spark, sf).select("match_id"))


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    ef = M.split_keyed(materialize(early_table(spark, sf)))
    scaled, _ = M.scale_features(ef, FE.EARLY_FEATURES, train=ef.where("is_train"))
    return M.unpack(scaled, "features", FE.EARLY_FEATURES, digits=6)


def eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    out = M.eval_auc(early_table(spark, sf), "combined_advantage", "label")
    return out.select(F.round("auc", 9).alias("auc"), "positives", "negatives")


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_matrix(early_table(spark, sf), "label", "is_radiant_ahead")


def eval_prf(spark: SparkSession, sf: str) -> DataFrame:
    out = M.eval_prf(early_table(spark, sf), "label", "is_radiant_ahead")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


def prediction_bands(spark: SparkSession, sf: str) -> DataFrame:
    ef = early_table(spark, sf)
    p = F.round(1 / (1 + F.exp(-F.col("combined_advantage") / 10)), 6)
    return M.prediction_bands(ef.select("match_id", p.alias("radiant_win_probability")))


# ------------------------------------------------------------------ file sources and sinks
from pickwise.operators import sinks as SK  # noqa: E402
from pickwise.session import shared_dir  # noqa: E402
from pickwise.sources import files as FS  # noqa: E402
from pickwise.sources import fixtures as FX  # noqa: E402
from pickwise.sources import schemas as SC  # noqa: E402

_FILES: dict[tuple[str, str, str], str] = {}


def _fixture(spark: SparkSession, sf: str, kind: str, writer) -> str:
    """Write a fixture once per session and table folder; return its base folder."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FILES:
        base = shared_dir(spark, f"fixture-{kind}")
        _FILES[key] = writer(base)
    return _FILES[key]


def _yearly(spark: SparkSession, sf: str, kind: str):
    writers = {"picks": FX.write_yearly_picks, "timings": FX.write_yearly_timings, "meta": FX.write_yearly_metadata}

    def write(base: str) -> str:
        return base + "|" + writers[kind](spark, sf, base)

    base, pattern = _fixture(spark, sf, kind, write).split("|")
    return base, pattern


def src_yearly_union(spark: SparkSession, sf: str) -> DataFrame:
    base, pattern = _yearly(spark, sf, "picks")
    cols = ["is_pick", "hero_id", "team", "order", "match_id", "leagueid"]
    return FS.load_yearly(spark, base, pattern, SC.PICKS_BANS, cols, years=FX.years(spark, sf))


def src_yearly_optional(spark: SparkSession, sf: str) -> DataFrame:
    base, pattern = _yearly(spark, sf, "meta")
    return FS.load_yearly(
        spark, base, pattern, SC.MAIN_METADATA, [],
        optional=["match_id", "radiant_win", "patch", "leagueid", "start_time"], years=FX.years(spark, sf),
    )


def src_yearly_defaults(spark: SparkSession, sf: str) -> DataFrame:
    base, pattern = _yearly(spark, sf, "timings")
    return FS.load_yearly(
        spark, base, pattern, SC.DRAFT_TIMINGS, ["match_id", "pick", "total_time_taken", "extra_time"],
        defaults=FS.TIMING_DEFAULTS, require=["match_id"], years=FX.years(spark, sf),
    )


def src_row_audit(spark: SparkSession, sf: str) -> DataFrame:
    return FS.row_audit({"picks_bans": src_yearly_union(spark, sf), "draft_timings": src_yearly_defaults(spark, sf)})


META_SCHEMA = SC.T.StructType([
    SC.T.StructField("match_id", SC.T.LongType()),
    SC.T.StructField("radiant_win", SC.T.BooleanType()),
    SC.T.StructField("radiant_score", SC.T.IntegerType()),
    SC.T.StructField("dire_score", SC.T.IntegerType()),
    SC.T.StructField("patch", SC.T.IntegerType()),
    SC.T.StructField("year", SC.T.IntegerType()),
])


def src_csv(spark: SparkSession, sf: str) -> DataFrame:
    def write(base: str) -> str:
        V.metadata(spark, sf).write.option("header", True).csv(f"{base}/main_metadata.csv")
        return base

    base = _fixture(spark, sf, "meta_csv", write)
    return FS.read_csv(spark, f"{base}/main_metadata.csv", META_SCHEMA)


def src_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of one folder with different column orders, an undeclared column and
    whole numbers written with a fraction: matched by name."""

    def write(base: str) -> str:
        pb = V.picks_bans(spark, sf).withColumn("hero_id", F.format_string("%d.0", "hero_id")).withColumn("leagueid", F.lit(None).cast("string")).withColumn("note", F.lit("x, y"))
        orders = (["is_pick", "hero_id", "team", "order", "match_id", "leagueid"], ["match_id", "note", "order", "team", "hero_id", "is_pick", "leagueid"])
        with Workspace(spark, "picks") as work:
            pb = work.table(pb)
            for i, cols in enumerate(orders):
                pb.where(F.col("match_id") % 2 == i).select(*cols).write.mode("append").option("header", True).csv(f"{base}/picks_bans.csv")
        return base

    return FS.read_csv(spark, f"{_fixture(spark, sf, 'picks_reordered', write)}/picks_bans.csv", SC.PICKS_BANS, mode="DROPMALFORMED")


def src_text_label(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of outcomes written as text in several spellings."""

    def write(base: str) -> str:
        spelling = F.when(F.col("radiant_win"), F.element_at(F.array(F.lit("True"), F.lit("1"), F.lit("true")), (F.col("match_id") % 3 + 1).cast("int")))
        spelling = spelling.when(~F.col("radiant_win"), F.element_at(F.array(F.lit("False"), F.lit("0")), (F.col("match_id") % 2 + 1).cast("int")))
        V.metadata(spark, sf).select("match_id", spelling.alias("radiant_win")).write.option("header", True).csv(f"{base}/main_metadata.csv")
        return base

    return D.match_label_text(FS.read_csv(spark, f"{_fixture(spark, sf, 'meta_text', write)}/main_metadata.csv", SC.MAIN_METADATA))


def src_csv_dropmalformed(spark: SparkSession, sf: str) -> DataFrame:
    bad = ["not_a_match,3,100", "17,minute,5", "18,4,gold"]

    def write(base: str) -> str:
        return FX.write_csv_with_malformed(spark, V.gold_adv(spark, sf), base, "radiant_gold_adv.csv", bad)

    glob = _fixture(spark, sf, "gold_csv", write)
    return FS.read_csv(spark, glob, SC.GOLD_ADV, mode="DROPMALFORMED")


def src_json_corrupt(spark: SparkSession, sf: str) -> DataFrame:
    def write(base: str) -> str:
        return FX.write_json_with_csv_body(spark, V.teamfights(spark, sf), base, "teamfights.csv")

    glob = _fixture(spark, sf, "fights_json", write)
    return FS.read_json_clean(spark, glob, SC.TEAMFIGHTS)


def src_optional(spark: SparkSession, sf: str) -> DataFrame:
    missing = shared_dir(spark, "absent")  # never written
    obj = FS.read_optional(spark, f"{missing}/objectives.csv", SC.OBJECTIVES)
    fights = FS.read_optional(spark, f"{missing}/teamfights.json", SC.TEAMFIGHTS, fmt="json")
    ef = FE.early_features(
        V.picks_bans(spark, sf), V.metadata(spark, sf), V.gold_adv(spark, sf), V.exp_adv(spark, sf), obj, fights
    )
    return _r(ef, EARLY_DIGITS)


def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    ef = early_features(spark, sf)
    path = SK.write_csv(ef, shared_dir(spark, "sink-csv") + "/early_features")
    return FS.read_csv(spark, path, ef.schema)


def sink_json(spark: SparkSession, sf: str) -> DataFrame:
    meta = hero_meta(spark, sf)
    path = SK.write_json(meta, shared_dir(spark, "sink-json") + "/hero_meta")
    return spark.read.schema(meta.schema).json(path)


# ------------------------------------------------------------------ models
# Fits are checked by certificates (see operators/trees.py), by an independent fit in SQL
# and by a planted signal; the tables around a model also on the fixed coefficients below.
from pickwise.operators import trees as TR  # noqa: E402
from pickwise.plans import models as MR  # noqa: E402
from pickwise.plans.workspace import Workspace  # noqa: E402

# Fixed coefficients on the early features (all others 0) by model name: (by feature, intercept).
FIXED = {
    "logistic_regression": ({"combined_advantage": 0.05, "radiant_picks": 0.1, "dire_picks": -0.1}, 0.02),
    "random_forest": ({"exp_at_10min": 0.0004, "tower_kills_10min": 0.01}, -0.05),
    "gradient_boosting": ({"gold_trend_10min": 0.0001, "gold_at_10min": 0.00005}, 0.0),
    "draft_only": ({"radiant_picks": 0.2, "dire_picks": -0.2}, 0.01),
}
QUALITY = ("accuracy", "auc_roc", "precision", "recall", "f1")


def _fixed(name: str):
    by, intercept = FIXED[name]
    return M.logreg_from([by.get(c, 0.0) for c in FE.EARLY_FEATURES], intercept)


def _assembled(spark: SparkSession, sf: str) -> DataFrame:
    """The early table with its raw feature vector and split, built once."""
    return M.assemble(M.split_keyed(materialize(early_table(spark, sf))), FE.EARLY_FEATURES, output="features")


def _fixed_metrics(table: DataFrame, names) -> dict[str, dict]:
    test = table.where("NOT is_train")
    return {n: {**{k: round(v, 9) for k, v in M.evaluate(_fixed(n).transform(test)).items()}, "train_seconds": 0.0} for n in names}


def fit_summary(run: MR.ModelRun, name: str) -> DataFrame:
    """Rows of the split and of the scored test matches, and how many scores are sound."""
    pred = M.batch_score(run.model(name), run.test)
    sound = F.col("prediction").isin(0.0, 1.0) & F.col("radiant_win_probability").between(0.0, 1.0)
    return pred.agg(F.count(F.lit(1)).alias("scored_rows"), F.sum(sound.cast("long")).alias("sound_rows")).select(
        F.lit(name).alias("model"), F.lit(run.n_train).cast("long").alias("train_rows"), F.lit(run.n_test).cast("long").alias("test_rows"),
        "scored_rows", "sound_rows",
    )


def _certified(run: MR.ModelRun, name: str) -> DataFrame:
    """The summary of a fit with its certificate: gradient entries or trees, test rows whose
    probability follows from the exported model, and entries or leaves that are wrong."""
    found = run.certificate(name)
    return fit_summary(run, name).select("*", *[F.lit(found[c]).cast("long").alias(c) for c in ("parts", "agreeing_rows", "faults")])


def fit_logreg(spark: SparkSession, sf: str) -> DataFrame:
    return _certified(MR.early_run(spark, sf), "logistic_regression")


def fit_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _certified(MR.early_run(spark, sf), "random_forest")


def fit_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _certified(MR.early_run(spark, sf), "gradient_boosting")


def draft_model_logreg(spark: SparkSession, sf: str) -> DataFrame:
    """Draft-feature model without leakage: pair win rates and scaler from training matches."""
    return _certified(MR.draft_run(spark, sf), "logistic_regression")


def draft_model_set(spark: SparkSession, sf: str) -> DataFrame:
    """The three models on the draft features, one row each."""
    run = MR.draft_run(spark, sf)
    rows = [_certified(run, n) for n in M.MODEL_ORDER]
    return rows[0].union(rows[1]).union(rows[2])


PLANTED_SET = {"random_forest": {"numTrees": 10, "maxDepth": 5}, "gradient_boosting": {"maxIter": 8, "maxDepth": 3}}
PLANTED_AUC = 0.9


def fit_planted_signal(spark: SparkSession, sf: str) -> DataFrame:
    """The three models on a label that the features decide (advantage above zero):
    every one must reach an AUC of PLANTED_AUC."""
    table = early_table(spark, sf).withColumn("label", (F.col("combined_advantage") > 0).cast("int"))
    run = MR.ModelRun(table, FE.EARLY_FEATURES, PLANTED_SET)
    try:
        quality = spark.createDataFrame([(n, run.metrics(n)["auc_roc"] >= PLANTED_AUC) for n in M.MODEL_ORDER], "model string, finds_signal boolean")
        return quality.select("model", F.lit(run.n_train).cast("long").alias("train_rows"), F.lit(run.n_test).cast("long").alias("test_rows"), "finds_signal")
    finally:
        run.close()


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    return _r(M.batch_score(_fixed("logistic_regression"), _assembled(spark, sf)), {"radiant_win_probability": 9})


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 most important features of the fitted forest."""
    run = MR.early_run(spark, sf)
    return M.feature_importance(run.model("random_forest"), run.feature_cols, top=20)


def importance_from_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Per tree model: features, and for how many the importance that MLlib gives
    follows from the gains in the node table."""
    run = MR.early_run(spark, sf)
    out = None
    for name in ("random_forest", "gradient_boosting"):
        theirs = M.feature_importance(run.model(name), run.feature_cols).select("feature", F.col("importance").alias("theirs"))
        index = spark.createDataFrame(list(enumerate(run.feature_cols)), "i int, name string")
        ours = index.join(TR.importance(run.nodes(name), each_tree=name == "random_forest").withColumnRenamed("feature", "i"), "i", "left")
        both = theirs.join(ours.select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("ours")), "feature")
        same = (F.abs(F.col("theirs") - F.col("ours")) <= TR.AGREE).cast("long")
        row = both.agg(F.count("*").alias("features"), F.sum(same).alias("agreeing"), F.round(F.sum("theirs"), 9).alias("total"))
        row = row.select(F.lit(name).alias("model"), "features", "agreeing", "total")
        out = row if out is None else out.union(row)
    return out


def logreg_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    """The coefficients of the fitted regression on the scaled features."""
    run = MR.early_run(spark, sf)
    return _r(M.logreg_coefficients(run.model("logistic_regression"), run.feature_cols), dict.fromkeys(("coefficient", "abs_coefficient", "intercept"), 3))


def variance_share(spark: SparkSession, sf: str) -> DataFrame:
    """The ten features with the largest share of the summed variance."""
    ef = early_table(spark, sf)
    one = ef.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in FE.EARLY_FEATURES])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(0.0)).alias("v")) for c in FE.EARLY_FEATURES])))
    total = F.sum("v").over(Window.partitionBy())  # one row a feature
    return M.importance_table(long.select("feature", F.round(F.col("v") / total, 9).alias("importance")), top=10)


def single_slopes(spark: SparkSession, sf: str) -> DataFrame:
    """Slope of the label on each feature alone, with the label's mean as intercept."""
    ef = early_table(spark, sf)
    slope = lambda c: F.coalesce(F.try_divide(F.covar_samp(F.col(c).cast("double"), F.col("label").cast("double")), F.var_samp(F.col(c).cast("double"))), F.lit(0.0))
    one = ef.agg(F.avg("label").alias("_mean"), *[slope(c).alias(c) for c in FE.EARLY_FEATURES])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 9).alias("coefficient"), F.round("_mean", 9).alias("intercept")) for c in FE.EARLY_FEATURES])))
    return M.coefficient_table(long)


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return M.model_comparison(_fixed_metrics(_assembled(spark, sf), M.MODEL_ORDER)).drop("train_seconds")


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    return M.best_model(model_comparison(spark, sf))


def draft_baseline_gain(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted regression on all features against an unregularised one on the draft-only
    columns, both on the run's own split."""
    gain = MR.early_run(spark, sf).baseline_gain()
    return _r(gain, {"baseline_auc": 4, "model_auc": 4, "auc_gain": 3, "baseline_accuracy": 4, "model_accuracy": 4, "accuracy_gain_points": 1})


def fixed_model_gain(spark: SparkSession, sf: str) -> DataFrame:
    """The gain table on two regressions with fixed coefficients."""
    m = _fixed_metrics(_assembled(spark, sf), ("draft_only", "logistic_regression"))
    base = {"accuracy": m["draft_only"]["accuracy"], "auc": m["draft_only"]["auc_roc"]}
    out = M.gain_table(M.draft_only_columns(FE.EARLY_FEATURES), base, m["logistic_regression"])
    return _r(out, {"accuracy_gain_points": 6, "auc_gain": 6})


def fitted_models(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison of the three fitted models, each exported with its predictions: the
    metrics worked out again from the exported files, the targets they meet, the best."""
    run = MR.early_run(spark, sf)
    best, rows = run.best_name(), []
    schema = SC.T.StructType.fromDDL("match_id long, label int, prediction double, radiant_win_probability double")
    for i, name in enumerate(M.MODEL_ORDER):
        path = SK.export_predictions(run.predictions(name), run.work.folder("export"))
        back = FS.read_csv(spark, path, schema)
        again = M.eval_prf(back).first().asDict() | M.eval_auc(back, "radiant_win_probability").first().asDict()
        m = run.metrics(name)
        pairs = {"accuracy": "accuracy", "weighted_precision": "precision", "weighted_recall": "recall", "weighted_f1": "f1", "auc": "auc_roc"}
        same = sum(abs(again[a] - m[b]) <= 1e-6 for a, b in pairs.items())
        rows.append((i, name, again["positives"] + again["negatives"], same, bool(m["auc_roc"] <= run.metrics(best)["auc_roc"]), again["accuracy"], again["auc"]))
    made = spark.createDataFrame(rows, "ordinal int, model string, test_rows long, metrics_again int, best_is_no_worse boolean, accuracy double, auc double")
    targets = run.comparison().select("model", "meets_accuracy_target", "meets_auc_target")
    agrees = lambda flag, value, least: F.col(flag) == (F.col(value) >= least)
    return made.join(targets, "model").select(
        "ordinal", "model", "test_rows", "metrics_again", agrees("meets_accuracy_target", "accuracy", M.TARGET_ACCURACY).alias("accuracy_target_agrees"),
        agrees("meets_auc_target", "auc", M.TARGET_AUC).alias("auc_target_agrees"), "best_is_no_worse",
    )


def fitted_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics, training times and targets of the three fitted models."""
    return MR.early_run(spark, sf).comparison()


def prediction_export(spark: SparkSession, sf: str) -> DataFrame:
    test = _assembled(spark, sf).where("NOT is_train")
    path = SK.export_predictions(_fixed("logistic_regression").transform(test), shared_dir(spark, "predictions") + "/predictions")
    schema = "match_id long, label int, prediction double, radiant_win_probability double"
    return _r(FS.read_csv(spark, path, SC.T.StructType.fromDDL(schema)), {"radiant_win_probability": 9})


def prediction_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Five example predictions (lowest match ids of the test split) with their
    10-minute context and confidence band."""
    test = _assembled(spark, sf).where("NOT is_train")
    context = ["gold_at_10min", "exp_at_10min", "teamfights_count_10min", "tower_kills_10min"]
    pred = M.batch_score(_fixed("logistic_regression"), test, keep=("match_id", "label", *context))
    out = M.prediction_bands(pred, keep=("match_id", "label", "prediction", *context)).orderBy("match_id").limit(5)
    return _r(out, {"radiant_win_probability": 9, "predicted_probability": 9})


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The best model saved with its assembler and scaler, loaded, and run on the raw
    feature columns: does every test match get the same probability?"""
    from pyspark.ml import PipelineModel

    run = MR.early_run(spark, sf)
    name = run.best_name()
    loaded = PipelineModel.load(run.save(run.work.folder("best")))
    a = M.batch_score(run.model(name), run.test).select("match_id", F.col("radiant_win_probability").alias("p0"))
    b = M.batch_score(loaded, run.data.where("NOT is_train")).select("match_id", F.col("radiant_win_probability").alias("p1"))
    return a.join(b, "match_id").select("match_id", (F.col("p0") == F.col("p1")).alias("same_probability"))


def _run_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Stages of a run: rows, seconds and rows a second, from the one write of each stage."""
    rep, run = SK.RunReport(), MR.early_run(spark, sf)
    with Workspace(spark, "stages") as work, work.active():
        with rep.stage("data_loading") as st:
            st["rows"] = sum(SK.written(V.table(spark, sf, t), work.folder(t)) for t in ("lineitem", "orders", "events"))
        with rep.stage("feature_engineering", features=len(FE.EARLY_FEATURES)) as st:
            st["rows"] = SK.written(early_table(spark, sf), work.folder("features"))
    for name in M.MODEL_ORDER:
        run.model(name)
        rep.add(f"train_{name}", run.seconds[name], rows=run.n_train, features=len(run.feature_cols))
    return rep.to_df(spark)


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Stages of a run with their rows; a stage that took no measurable time, or whose rate
    is not its rows by its seconds, is marked."""
    rate = F.abs(F.col("rows_per_second") * F.col("seconds") - F.col("rows")) <= 0.01 * F.col("rows") + 0.01 * F.col("seconds")
    return _run_stages(spark, sf).select("ordinal", "stage", "rows", "features", (F.col("seconds") > 0).alias("timed"), rate.alias("rate_holds"))


def run_rates(spark: SparkSession, sf: str) -> DataFrame:
    """(ordinal, stage, seconds, rows, features, rows_per_second) of a run."""
    return _run_stages(spark, sf)


def report_text(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the run over the three fitted models, written as text lines and read back."""
    run = MR.early_run(spark, sf)
    comparison = run.comparison()
    top = recommend_topk(spark, sf).orderBy("draft_id", "rank").limit(3)
    lines = SK.full_report(comparison, M.best_model(comparison), run.baseline_gain(), feature_importance(spark, sf).where("rank <= 10"), top)
    value = F.concat_ws(" | ", F.col("section"), F.col("value"))
    path = SK.write_text(lines.orderBy("ordinal", "line_no").select(value.alias("value")), shared_dir(spark, "report") + "/report")
    return spark.read.text(path)


# ------------------------------------------------------------------ runs over match files
def _match_files(spark: SparkSession, sf: str) -> str:
    """The views written as exports: CSV with headers, teamfights as JSON lines."""

    def write(base: str) -> str:
        tables = {
            "picks_bans": V.picks_bans(spark, sf), "main_metadata": V.metadata(spark, sf).drop("year"),
            "radiant_gold_adv": V.gold_adv(spark, sf), "radiant_exp_adv": V.exp_adv(spark, sf), "objectives": V.objectives(spark, sf),
        }
        for name, df in tables.items():
            df.write.option("header", True).csv(f"{base}/{name}.csv")
        V.teamfights(spark, sf).write.json(f"{base}/teamfights.json")
        return base

    return _fixture(spark, sf, "match_files", write)


def early_features_files(spark: SparkSession, sf: str) -> DataFrame:
    return _r(MR.early_features_from_files(spark, _match_files(spark, sf)), EARLY_DIGITS)


def draft_features_files(spark: SparkSession, sf: str) -> DataFrame:
    def write(base: str) -> str:
        md = V.metadata(spark, sf)
        years = md.select("match_id", "year")
        tables = {
            "picks_bans": V.picks_bans(spark, sf).join(years, "match_id"), "main_metadata": md.select("match_id", "radiant_win", "patch", "year"),
            "draft_timings": V.draft_timings(spark, sf).join(years, "match_id"),
        }
        for name, df in tables.items():
            FX.write_yearly_files(spark, df, base, name)
        return base

    base = _fixture(spark, sf, "yearly_files", write)
    picks, meta, timings = MR.draft_inputs(spark, base, FX.years(spark, sf))
    df = FE.draft_features(picks, meta, timings, hero_ids=range(V.HERO_POOL))
    return _r(df, {"std_pick_time": 6, "radiant_synergy": 6, "dire_synergy": 6, "synergy_diff": 6})
