import corpus_pipeline as P
from llm_cases import awkward, documents

from pickwise.llm import cotrain, decontaminate, near_dups, secret_scan


def test_every_stage_takes_effect_on_all_that_came_before(spark, sf_small):
    docs = documents(spark, sf_small)
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "mixing sources to target weights"]
    ids = lambda df: [r[0] for r in df.select("doc_id").collect()]
    kept = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_small).persist()
        kept[name] = (docs, out)
        assert len(ids(out)) == len(set(ids(out))) and set(ids(out)) <= set(ids(docs))
        if name != P.STAGES[-1][0]:
            assert out.columns == P.COLUMNS
        docs = out
    before, after = kept["quality classifier"]
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    rejected = {r.doc_id for r in cotrain.score(before, cotrain.learn(before, labels)).filter("NOT keep").collect()}
    assert set(ids(after)) == set(ids(before)) - rejected and rejected
    before, after = kept["SimHash near-dedup"]
    groups = {}
    for r in near_dups.near_duplicates(before).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert set(ids(after)) == {min(g) for g in groups.values()} and len(groups) < before.count()
    before, after = kept["benchmark decontamination"]
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contaminated(before, bench).collect()}
    assert set(ids(after)) == set(ids(before)) - leaks
    before, after = kept["secret scans"]
    assert set(ids(after)) == set(ids(before))
    again = secret_scan.scan(after, secret_scan.Formats({}, [])).agg({"n_assign": "sum", "n_access": "sum", "n_hex": "sum"}).first()
    assert list(again) == [0, 0, 0]
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = kept["mixing sources to target weights"]
    assert after.filter("copies < 1 OR taken <> copies * size").count() == 0


def test_run_equals_the_stages_one_by_one(spark, sf_small):
    docs = documents(spark, sf_small)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_small).persist()
    assert sorted(map(tuple, P.run(spark, sf_small).collect())) == sorted(map(tuple, docs.collect()))


def test_awkward_rows(spark, sf_small):
    docs = awkward(spark)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_small).persist()
        docs.count()
