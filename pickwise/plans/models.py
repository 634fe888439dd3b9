"""Model runs over the per-match feature tables.

The early-game run (21 features) and the draft run (one-hot + order + timing +
synergy + patch) share one shape: keyed split → scaler fitted on the training
rows → fits → evaluation on the test rows.  Statistics that use labels (pair
win rates, scaler moments) come from training matches only.  Fitted models are
kept per session, table folder and state of its files, so that the registered keys
that read the same fit do not refit it.
"""

from __future__ import annotations

import time
import warnings

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.operators import ml as M
from pickwise.operators import pairs as P
from pickwise.operators import trees as TR
from pickwise.plans import features as FE
from pickwise.plans.guards import written
from pickwise.plans.workspace import Workspace, stamp
from pickwise.sources import files as FS
from pickwise.sources import schemas as SC
from pickwise.sources import views as V

_RUNS: dict[tuple, "ModelRun"] = {}
_STAMPS: dict[tuple, tuple] = {}  # the files that the last run of a folder read
ROWS_PER_PARTITION = 20_000  # training rows of one task of a small table
PARTITIONS, MOST_ROWS = 48, 500_000  # of a larger one: so many tasks, more once they would hold more rows
SMALL_SAMPLE = 100  # fewer labelled matches than this: warn


def partitions(rows: int) -> int:
    """Tasks of a fit over ``rows`` training rows.  Every one of a fit's hundreds of passes
    starts that many tasks, and every task of a tree's level sends on the statistics of all
    its nodes, so a large table is dealt by as few tasks as hold its rows."""
    return min(-(-rows // ROWS_PER_PARTITION), max(PARTITIONS, -(-rows // MOST_ROWS)))


class ModelRun:
    """Split, scale and (lazily) fit the three classifiers on one feature table.  What
    the run writes belongs to its workspace and goes with :meth:`close`."""

    def __init__(self, table: DataFrame, feature_cols: list[str], params: dict[str, dict] | None = None):
        self.feature_cols = list(feature_cols)
        self.params = params or {}
        self.work = Workspace(table.sparkSession, "run")
        self.models: dict = {}
        self.seconds: dict[str, float] = {}
        self._metrics: dict[str, dict] = {}
        self._nodes: dict[str, DataFrame] = {}
        self.train: DataFrame | None = None
        try:
            self._prepare(table)
        except BaseException:
            self.close()
            raise

    def _prepare(self, table: DataFrame) -> None:
        # The fits scan the training rows many times: materialise the feature
        # table once (in the shared folder; cuts the lineage of the feature joins
        # and keeps plan optimisation trivial).
        self.data = M.split_keyed(self.work.table(table.select("match_id", "label", *self.feature_cols)))
        sizes = {r["is_train"]: r["n"] for r in self.data.groupBy("is_train").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.n_train, self.n_test = sizes.get(True, 0), sizes.get(False, 0)
        if not self.n_train or not self.n_test:
            raise ValueError(f"cannot train and test on {self.n_train} and {self.n_test} matches")
        if self.n_train + self.n_test < SMALL_SAMPLE:
            warnings.warn(f"only {self.n_train + self.n_test} labelled matches: metrics are not reliable", stacklevel=3)
        self.assembler = VectorAssembler(inputCols=self.feature_cols, outputCol="raw_features", handleInvalid="skip")
        assembled = self.assembler.transform(self.data)
        self.scaler = M.fit_scaler(assembled.where(F.col("is_train")))
        self.scaled = self.scaler.transform(assembled).select("match_id", "label", "is_train", "features")
        self.train = self.scaled.where(F.col("is_train")).repartition(partitions(self.n_train), "match_id").persist(StorageLevel.MEMORY_AND_DISK)
        self.test = self.scaled.where(~F.col("is_train"))

    def model(self, name: str):
        if name not in self.models:
            t0 = time.perf_counter()
            self.models[name] = M.FITTERS[name](self.train, rows=self.n_train, **self.params.get(name, {}))
            self.seconds[name] = time.perf_counter() - t0
        return self.models[name]

    def predictions(self, name: str) -> DataFrame:
        return self.model(name).transform(self.test)

    def metrics(self, name: str) -> dict:
        if name not in self._metrics:
            with self.work.active():
                m = M.evaluate(self.predictions(name))
            m["train_seconds"] = self.seconds.get(name, 0.0)
            self._metrics[name] = m
        return self._metrics[name]

    def comparison(self) -> DataFrame:
        return M.model_comparison({n: self.metrics(n) for n in M.MODEL_ORDER})

    def best_name(self) -> str:
        return M.best_model(self.comparison()).first()["model"]

    def baseline_gain(self, name: str = "logistic_regression") -> DataFrame:
        """Gain of a model over an unregularised regression on the draft-only columns,
        on this run's own split."""
        with self.work.active():
            return M.draft_baseline_gain(self.data.where("is_train"), self.data.where("NOT is_train"), self.feature_cols, self.metrics(name))

    def nodes(self, name: str) -> DataFrame:
        """The node table of the fitted forest or boosting."""
        if name not in self._nodes:
            self._nodes[name] = TR.node_table(self.model(name), self.work.folder(name))
        return self._nodes[name]

    def gradient(self) -> DataFrame:
        """(feature, coefficient, gradient) of the fitted regression over the training rows."""
        m = self.model("logistic_regression")
        return TR.logreg_gradient(self.train, m.coefficients.toArray(), m.intercept, m.getRegParam(), self.feature_cols)

    def certificate(self, name: str) -> dict[str, int]:
        """What holds of the fitted model without calling it: its ``parts`` (gradient
        entries or trees), test rows whose probability follows from its exported
        coefficients or nodes (``agreeing_rows``), and ``faults``: gradient entries over
        the bound, or leaves that the training rows contradict."""
        model = self.model(name)
        keep = ["match_id", "theirs"]
        scored = self.predictions(name).select("match_id", "features", vector_to_array("probability")[1].alias("theirs"))
        if name == "logistic_regression":
            found = TR.logreg_probabilities(scored, model.coefficients.toArray(), model.intercept, keep)
            entries = self.gradient().agg(F.count("*").alias("n"), F.sum((F.abs("gradient") > M.GRADIENT_BOUND).cast("int")).alias("over")).first()
            return {"parts": entries["n"], "agreeing_rows": TR.agreeing(found), "faults": entries["over"]}
        boosting, nodes, depth = name == "gradient_boosting", self.nodes(name), model.getMaxDepth()
        found = TR.probabilities(TR.reached(scored, nodes, keep, depth), boosting, keep)
        sums = TR.routed_sums(self.train, nodes, boosting, depth)
        wrong = TR.wrong_boosting_leaves(nodes, sums) if boosting else TR.wrong_forest_leaves(nodes, sums)
        return {"parts": nodes.select("tree").distinct().count(), "agreeing_rows": TR.agreeing(found), "faults": wrong.count()}

    def save(self, path: str, name: str | None = None) -> str:
        """The best (or named) model with its assembler and scaler, as one pipeline
        that scores the raw feature columns."""
        PipelineModel([self.assembler, self.scaler, self.model(name or self.best_name())]).write().overwrite().save(path)
        return path

    def close(self) -> None:
        """Frees the cached training rows and deletes what the run wrote; the run is forgotten."""
        if self.train is not None:
            self.train.unpersist()
        self.work.close()
        for key in [k for k, v in _RUNS.items() if v is self]:
            del _RUNS[key]


def _run(spark: SparkSession, sf: str, kind: str, params: dict | None, build) -> ModelRun:
    """The session's run over a folder; one over older files of the folder is closed."""
    key, files = (spark.sparkContext.applicationId, sf, kind, repr(params)), stamp(spark, sf)
    if (old := _RUNS.get((*key, _STAMPS.get(key)))) is not None and _STAMPS[key] != files:
        old.close()
    _STAMPS[key] = files
    if (*key, files) not in _RUNS:
        _RUNS[(*key, files)] = build()
    return _RUNS[(*key, files)]


def early_run(spark: SparkSession, sf: str, params: dict | None = None) -> ModelRun:
    from pickwise.plans.queries import early_table

    return _run(spark, sf, "early", params, lambda: ModelRun(early_table(spark, sf), FE.EARLY_FEATURES, params))


def draft_table(picks: DataFrame, meta: DataFrame, timings: DataFrame | None, hero_ids=None) -> DataFrame:
    """Draft features with pair win rates fitted on training matches only."""
    stats = P.pair_synergy_winrate(picks, meta.where(V.split_flag("match_id")))
    return FE.draft_features(picks, meta, timings, synergy_stats=stats, hero_ids=hero_ids)


def draft_run(spark: SparkSession, sf: str, params: dict | None = None) -> ModelRun:
    def build() -> ModelRun:
        with Workspace(spark, "draft") as work, work.active():
            table = draft_table(written(V.picks_bans(spark, sf)), V.metadata(spark, sf), V.draft_timings(spark, sf), range(V.HERO_POOL))
            return ModelRun(table, FE.draft_feature_columns(table), params)

    return _run(spark, sf, "draft", params, build)


# ---------------------------------------------------------------- from match files
def early_features_from_files(spark: SparkSession, base: str) -> DataFrame:
    """The early feature table of a folder of exports: ``<table>.csv*`` files with
    headers (malformed rows dropped), objectives optional, teamfights as JSON lines,
    optional."""
    read = lambda name, schema: FS.read_csv(spark, f"{base}/{name}.csv*", schema, mode="DROPMALFORMED")
    return FE.early_features(
        read("picks_bans", SC.PICKS_BANS), read("main_metadata", SC.MAIN_METADATA),
        read("radiant_gold_adv", SC.GOLD_ADV), read("radiant_exp_adv", SC.EXP_ADV),
        FS.read_optional(spark, f"{base}/objectives.csv", SC.OBJECTIVES),
        FS.read_optional(spark, f"{base}/teamfights.json", SC.TEAMFIGHTS, fmt="json"),
    )


def run_early(spark: SparkSession, base: str, params: dict | None = None) -> ModelRun:
    """Files to early features to the three models."""
    return ModelRun(early_features_from_files(spark, base), FE.EARLY_FEATURES, params)


def draft_inputs(spark: SparkSession, base: str, years) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Picks, outcomes and timings of yearly files, read once and materialised."""
    picks = written(FS.load_picks_bans(spark, base, years).drop("year", "leagueid"))
    meta = written(FS.load_metadata(spark, base, years).drop("year"))
    timings = FS.load_draft_timings(spark, base, years)
    return picks, meta, timings.drop("year") if timings is not None else None


def run_draft(spark: SparkSession, base: str, years, params: dict | None = None, hero_ids=None) -> ModelRun:
    """Yearly files to draft features (pair rates from training matches) to the three models."""
    table = draft_table(*draft_inputs(spark, base, years), hero_ids)
    return ModelRun(table, FE.draft_feature_columns(table), params)
