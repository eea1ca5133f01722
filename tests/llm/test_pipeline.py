from collections import Counter

import corpus_pipeline
from siltstone.llm import decontaminate, mixing, near_duplicates, quality, secret_scan

SF_DIR = "/root/testdata/sf0.01"


def test_stages_take_effect_on_what_came_before(spark, sample, fresh):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    docs, kept = sample, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{fresh}/{k}")
        after = spark.read.parquet(f"{fresh}/{k}")
        assert after.dtypes == sample.dtypes
        kept.append((docs, after))
        docs = after

    def ids(frame):
        return Counter(r["doc_id"] for r in frame.select("doc_id").collect())

    before, after = kept[0]
    assert ids(after) == Counter(r["doc_id"] for r in quality.classify(before, labels).filter("keep").collect())
    before, after = kept[1]
    assert ids(after) == Counter(r["doc_id"] for r in near_duplicates.report(before).filter("kept").collect())
    before, after = kept[2]
    clean = decontaminate.report(before, bench).filter("not contaminated")
    assert ids(after) == Counter(r["doc_id"] for r in clean.collect()) and before.count() > after.count()
    before, after = kept[3]
    texts = {r["doc_id"]: r for r in after.collect()}
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(before).collect()}
    for r in before.collect():
        new = texts[r["doc_id"]]
        assert (new["text"] == r["text"]) == (not spans[r["doc_id"]]) and new["n_chars"] == len(new["text"])
    assert secret_scan.scan(after).filter("n_assign + n_access + n_hex > 0").count() == 0
    before, after = kept[4]
    assert ids(after) == Counter({r["doc_id"]: r["copies"] for r in mixing.plan_mix(before).filter("copies > 0").collect()})
    final = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, after.collect()))


def test_stages_on_odd_and_empty_documents(spark, odd, empty, fresh):
    for name, docs in (("odd", odd), ("empty", empty)):
        frame = docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, frame, SF_DIR).write.parquet(f"{fresh}/{name}/{k}")
            after = spark.read.parquet(f"{fresh}/{name}/{k}")
            assert after.dtypes == docs.dtypes
            if k in (1, 3):
                rows = after.select("doc_id", "text").collect()
                assert k == 3 or len({r["text"] for r in rows if r["text"]}) == sum(bool(r["text"]) for r in rows)
            frame = after
    assert frame.count() == 0
