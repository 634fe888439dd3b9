"""Evaluation operators against brute force / MLlib, and file sources on small edge files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pickwise.operators import ml as M
from pickwise.operators import sinks as SK
from pickwise.session import shared_dir
from pickwise.sources import files as FS
from pickwise.sources import schemas as SC


def _auc_brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("partitions", [1, 4, 64, None])
def test_exact_auc_with_ties(spark, partitions):
    rnd = random.Random(7)
    data = [(float(rnd.randint(0, 30)), int(rnd.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(data, "s double, label int")
    got = M.eval_auc(df, "s", "label", partitions=partitions).first()["auc"]
    assert got == pytest.approx(_auc_brute(data), abs=1e-12)


def test_auc_of_one_class_and_of_large_counts(spark):
    one = spark.createDataFrame([(0.1, 1), (0.7, 1)], "s double, label int")
    assert M.eval_auc(one, "s").first()["auc"] is None and M.eval_auc(one.limit(0), "s").first()["auc"] is None
    # 4e9 positives × 4e9 negatives overflow a bigint product
    rows = spark.createDataFrame([(1.0, 4_000_000_000, 0), (0.0, 0, 4_000_000_000)], "s double, pos long, neg long")
    import pickwise.operators.ml as ml

    class Counted:  # a table whose per-score counts are given
        def groupBy(self, *_):
            return self

        def agg(self, *_):
            return rows

    assert ml.eval_auc(Counted(), "s").first()["auc"] == pytest.approx(1.0)


def test_prf_equals_mllib(spark):
    rnd = random.Random(3)
    data = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 1))) for _ in range(300)] + [(1.0, 1.0)] * 50
    df = spark.createDataFrame(data, "label double, prediction double")
    got = M.eval_prf(df).first()
    for col, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                        ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        assert got[col] == pytest.approx(M.multiclass_metric(df, metric), abs=1e-12)
    cm = {(r["label"], r["prediction"]): r["count"] for r in M.confusion_matrix(df).collect()}
    assert sum(cm.values()) == 350


def _write_text(path, lines):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_yearly_loader_edges(spark, tmp_path):
    base = str(tmp_path)
    _write_text(f"{base}/picks_bans_2016.csv", ["match_id,hero_id,team,order,is_pick,leagueid,extra",
                                                "1,5,0,1,True,9,x", "1,6,1,2,False,9,y"])
    _write_text(f"{base}/picks_bans_2018.csv", ["match_id,team,hero_id,is_pick", "2,0,7,true"])  # no order/leagueid
    _write_text(f"{base}/picks_bans_2019.csv", ["match_id,hero_id,team,order,is_pick,leagueid",
                                                "3,8,1,1,false,4", "oops,not,a,row,at,all"])
    df = FS.load_picks_bans(spark, base, years=range(2015, 2021))  # 2015, 2017, 2020 missing
    got = {tuple(r) for r in df.collect()}  # PERMISSIVE: the malformed line becomes a NULL row
    assert len(got) == 5 and (None, None, None, None, None, None, 2019) in got
    assert (True, 5, 0, 1, 1, 9, 2016) in got and (True, 7, 0, None, 2, None, 2018) in got
    assert (False, 8, 1, 1, 3, 4, 2019) in got
    assert df.columns == ["is_pick", "hero_id", "team", "order", "match_id", "leagueid", "year"]
    with pytest.raises(FileNotFoundError):
        FS.load_picks_bans(spark, base, years=range(2000, 2003))


EXPORT_ORDER = "is_pick,hero_id,team,order,match_id,leagueid,note"


def test_csv_is_read_by_name_whatever_the_column_order(spark, tmp_path):
    base = str(tmp_path / "picks")
    _write_text(f"{base}/part-0.csv", [EXPORT_ORDER, 'True,7.0,0,1,12345678901,5,"a, b"', "0,8,1,2.0,2,,"])
    _write_text(f"{base}/part-1.csv", ["match_id,note,order,team,hero_id,is_pick", "3,x,1,0,9,1"])
    want = [(2, 8, 1, 2, False, None), (3, 9, 0, 1, True, None), (12345678901, 7, 0, 1, True, 5)]
    for mode in ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"):
        assert sorted(tuple(r) for r in FS.read_csv(spark, base, SC.PICKS_BANS, mode=mode).collect()) == want
    _write_text(f"{base}/part-2.csv", [EXPORT_ORDER, "True,7.5,0,1,4,5,x", "True,7,0", "True,7,0,1,5,5,x"])
    kept = FS.read_csv(spark, base, SC.PICKS_BANS, mode="DROPMALFORMED")
    assert sorted(r.match_id for r in kept.collect()) == [2, 3, 5, 12345678901]
    loose = FS.read_csv(spark, base, SC.PICKS_BANS).where("match_id = 4").first()
    assert loose.hero_id is None and loose.is_pick is True  # 7.5 is no hero id; the rest of the row stays
    with pytest.raises(Exception, match="malformed"):
        FS.read_csv(spark, base, SC.PICKS_BANS, mode="FAILFAST").count()
    # a present optional source goes through the same reader
    got = FS.read_optional(spark, f"{base}/part-1.csv", SC.PICKS_BANS).first()
    assert (got.match_id, got.hero_id) == (3, 9)


def test_outcome_text_reaches_the_label(spark, tmp_path):
    from pickwise.operators import draft as D

    base = str(tmp_path)
    texts = ["True", "1", "true", "0", "False", "TRUE", ""]
    _write_text(f"{base}/main_metadata_2016.csv", ["radiant_win,match_id"] + [f"{t},{i}" for i, t in enumerate(texts)])
    df = FS.load_metadata(spark, base, years=[2016])
    labels = {r.match_id: r.label for r in D.match_label_text(df).collect()}
    assert [labels[i] for i in range(7)] == [1, 1, 1, 0, 0, 0, 0]
    flags = {r.match_id: r.label for r in D.match_label(df).collect()}
    assert [flags[i] for i in range(7)] == [1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0]


def test_mixed_part_headers_in_yearly_folders(spark, tmp_path):
    base = str(tmp_path)
    _write_text(f"{base}/picks_bans_2016.csv/part-0.csv", ["match_id,hero_id,team,order,is_pick,leagueid", "1,5,0,1,true,9"])
    _write_text(f"{base}/picks_bans_2016.csv/part-1.csv", ["hero_id,match_id,team,order,is_pick,leagueid", "6,2,1,1,false,9"])
    got = {(r.match_id, r.hero_id, r.year) for r in FS.load_picks_bans(spark, base, years=[2016]).collect()}
    assert got == {(1, 5, 2016), (2, 6, 2016)}


def test_timings_defaults_and_skip(spark, tmp_path):
    base = str(tmp_path)
    _write_text(f"{base}/draft_timings_2016.csv", ["match_id,pick,total_time_taken", "1,true,12.5"])
    _write_text(f"{base}/draft_timings_2017.csv", ["pick,total_time_taken,extra_time", "true,3,4"])  # no key: skipped
    _write_text(f"{base}/draft_timings_2018.csv", ["match_id", "2"])
    got = sorted(tuple(r) for r in FS.load_draft_timings(spark, base, years=range(2016, 2019)).collect())
    assert got == [(1, True, 12.5, 0.0, 2016), (2, True, 0.0, 0.0, 2018)]
    assert FS.load_draft_timings(spark, base, years=range(2000, 2001)) is None


def test_metadata_optional_columns(spark, tmp_path):
    base = str(tmp_path)
    _write_text(f"{base}/main_metadata_2016.csv", ["match_id,radiant_win,patch", "1,True,7"])
    _write_text(f"{base}/main_metadata_2017.csv", ["match_id,radiant_win,start_time", "2,False,99"])
    df = FS.load_metadata(spark, base, years=[2016, 2017])
    assert set(df.columns) == {"match_id", "radiant_win", "patch", "start_time", "year"}
    got = {r["match_id"]: r for r in df.collect()}
    assert got[1]["patch"] == 7 and got[1]["start_time"] is None and got[2]["start_time"] == 99


def test_dropmalformed_and_json_that_is_csv(spark, tmp_path):
    base = str(tmp_path)
    _write_text(f"{base}/radiant_gold_adv.csv", ["match_id,minute,gold", "1,0,10", "x,1,2", "1,1,-5"])
    _write_text(f"{base}/radiant_gold_adv.csv.1", ["match_id,minute,gold", "2,0,7"])
    assert FS.read_csv(spark, f"{base}/radiant_gold_adv.csv*", SC.GOLD_ADV, mode="DROPMALFORMED").count() == 3
    _write_text(f"{base}/teamfights.csv", ["match_id,start", "1,20"])  # CSV body read as JSON
    _write_text(f"{base}/teamfights.json", ['{"match_id": 1, "start": 30}'])
    assert FS.read_json_clean(spark, f"{base}/teamfights.csv", SC.TEAMFIGHTS).count() == 0
    assert FS.read_json_clean(spark, f"{base}/teamfights.*", SC.TEAMFIGHTS).count() == 1
    empty = FS.read_optional(spark, f"{base}/absent.csv", SC.OBJECTIVES)
    assert empty.count() == 0 and empty.schema == SC.OBJECTIVES


def test_row_audit_one_job_per_call(spark):
    a = spark.createDataFrame([(1, 2016), (2, 2016), (3, 2017)], "x int, year int")
    b = spark.createDataFrame([(1,)], "x int")
    got = sorted(tuple(r) for r in FS.row_audit({"a": a, "b": b}).collect())
    assert got == [("a", 2016, 2), ("a", 2017, 1), ("b", None, 1)]


def test_stage_work_reads_all_columns(spark, tmp_path):
    import os

    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    df.write.parquet(f"{tmp_path}/t")
    assert SK.worked(spark.read.parquet(f"{tmp_path}/t").groupBy("k").count()) == 7
    assert SK.worked(df.limit(0)) == 0
    path = SK.write_csv(df, f"{tmp_path}/one", single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1


def test_report_text_lines(spark, sf_small):
    import __spark_entry__ as E

    lines = [r.value for r in E.queries()["report_text"](spark, sf_small).collect()]
    parts = [x.split(" | ")[0] for x in lines]
    assert [parts.count(p) for p in ("models", "best model", "gain over draft only", "top features", "recommendations")] == [3, 1, 1, 10, 3]
    best = M.best_model(E.queries()["fitted_comparison"](spark, sf_small)).first()
    assert f"best model | {best.model} (AUC {best.auc_roc:.4f})" in lines


def test_report_and_sinks_roundtrip(spark):
    rep = SK.RunReport()
    with rep.stage("load") as st:
        st["rows"] = 100
    rep.add("fit", 0.0, rows=None)
    df = rep.to_df(spark)
    got = {r["stage"]: r for r in df.collect()}
    assert got["fit"]["rows_per_second"] == 0.0 and got["load"]["rows"] == 100
    assert SK.report_text(df).count() == 2
    path = SK.write_json(df, shared_dir(spark, "t-json"))
    assert spark.read.schema(df.schema).json(path).count() == 2


def test_a_folder_of_two_thousand_part_files(spark, tmp_path):
    import time

    layouts = ["match_id,hero_id,team", "team,match_id,hero_id,extra"]
    for i in range(2000):
        rows = [f"{i},7,1"] if i % 2 == 0 else [f"1,{i},7,x"]
        (tmp_path / f"part-{i:04d}.csv").write_text("\n".join([layouts[i % 2], *rows]) + "\n")
    schema = SC.T.StructType.fromDDL("match_id long, hero_id int, team int")
    began = time.perf_counter()
    groups = FS.header_groups(spark, str(tmp_path))
    assert time.perf_counter() - began < 30
    assert {h: len(f) for h, f in groups.items()} == {tuple(x.split(",")): 1000 for x in layouts}
    got = FS.read_csv(spark, str(tmp_path), schema).agg(F.count("*"), F.sum("match_id"), F.min("hero_id"), F.max("hero_id"), F.sum("team")).first()
    assert tuple(got) == (2000, sum(range(2000)), 7, 7, 2000)
