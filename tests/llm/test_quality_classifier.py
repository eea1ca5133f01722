import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import quality


def test_held_back_labels(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, rest = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    truth = {r["doc_id"]: r["quality"] for r in rest.collect()}
    rows = {r["doc_id"]: r["keep"] for r in quality.classify(sample, train).collect()}
    assert len(rows) == sample.count()
    good = [rows[d] for d, q in truth.items() if q == 1]
    bad = [rows[d] for d, q in truth.items() if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_sites_too_many_to_broadcast(spark, sample, odd, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for docs in (sample, odd):
        plain = sorted(map(str, quality.classify(docs, labels).collect()))
        with monkeypatch.context() as patch:
            patch.setattr(quality, "fits_broadcast", lambda df: False)
            assert sorted(map(str, quality.classify(docs, labels).collect())) == plain


def test_sparse_sites_shrink_towards_their_parents(spark):
    rows = [("big", "a", -3.0, 0)] * 900 + [("big", "b", 3.0, 0)] * 100 + [("tiny", "a", -3.0, 0)]
    rows += [(f"h{k}", "a", 3.0 if k % 3 else -3.0, 0) for k in range(60) for _ in range(50)]
    sites = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, ratio double, salt int"))
    got = {(r["host"], r["path"]): r for r in sites.collect()}
    low, high = 1 / (1 + np.exp(3)), 1 / (1 + np.exp(-3))
    assert abs(got["big", "a"]["path_rate"] - low) < 0.05
    assert got["tiny", "a"]["path_rate"] > got["big", "a"]["path_rate"]
    # All of that section's documents look good, so it is taken to be good, more than each of them says.
    assert high < got["big", "b"]["path_rate"] < 1


def plain_rates(rows, start, rounds):
    """The rounds site by site."""

    def strength(sites):
        n, k = sum(s[0] for s in sites), len(sites)
        within = sum(s[0] * s[2] * (1 - s[2]) for s in sites)
        if k < 2 or not within:
            return quality.MAX_STRENGTH
        spread = sum(s[0] * (s[1] / s[0] - s[2]) ** 2 for s in sites)
        between = (spread - k * within / n) / max(n - sum(s[0] ** 2 for s in sites) / n, 1e-9)
        return quality.MAX_STRENGTH if between <= within / n / quality.MAX_STRENGTH else max(within / n / between - 1, 1.0)

    sites = sorted({r[:2] for r in rows})
    rate = dict.fromkeys(sites, start)
    for _ in range(rounds):
        n = {s: sum(r[:2] == s for r in rows) for s in sites}
        good = dict.fromkeys(sites, 0.0)
        for host, path, ratio in rows:
            p = min(max(rate[host, path], quality.LEAST_RATE), 1 - quality.LEAST_RATE)
            good[host, path] += 1 / (1 + np.exp(-(np.log(p / (1 - p)) + ratio)))
        hosts = sorted({h for h, _ in sites})
        host_n = {h: sum(n[s] for s in sites if s[0] == h) for h in hosts}
        host_good = {h: sum(good[s] for s in sites if s[0] == h) for h in hosts}
        overall = (sum(good.values()) + start) / (len(rows) + 1)
        a = strength([(host_n[h], host_good[h], overall) for h in hosts])
        host_rate = {h: (host_good[h] + a * overall) / (host_n[h] + a) for h in hosts}
        b = strength([(n[s], good[s], host_rate[s[0]]) for s in sites])
        rate = {s: (good[s] + b * host_rate[s[0]]) / (n[s] + b) for s in sites}
    return rate


def test_rates_are_those_of_plain_rounds(spark):
    rng = np.random.default_rng(9)
    ratios = np.round(rng.normal(0, 2, 400) / quality.STEP) * quality.STEP
    rows = [(f"h{rng.integers(6)}", f"p{rng.integers(4)}", float(r)) for r in ratios]
    frame = spark.createDataFrame(rows, "host string, path string, ratio double")
    got = {(r["host"], r["path"]): r["path_rate"] for r in quality.site_posteriors(frame, 0.8, 4).collect()}
    want = plain_rates(rows, 0.8, 4)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_texts_without_any_signal_get_the_labelled_rate(spark):
    docs = spark.range(2000).selectExpr(
        "id as doc_id", "'the same words in every text of them all' as text", "concat('s', id % 7) as source", "'en' as lang"
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 200 >= 19 as int) as quality")
    found = quality.classify(docs, labels).agg(F.avg("quality"), F.avg("host_rate"), F.count_if("keep")).first()
    assert abs(found[0] - 0.905) < 0.02 and abs(found[1] - 0.905) < 0.02 and found[2] == 2000


def test_own_evidence_counts_once(spark):
    rows = [("big", "a", 0.0)] * 400 + [("other", "a", 0.0)] * 400 + [("single", "a", -4.0)]
    frame = spark.createDataFrame(rows, "host string, path string, ratio double")
    sites = quality.site_posteriors(frame, 0.9).filter("host = 'single'").withColumn("ratio", F.lit(-4.0))
    host, path = quality._without_own(F.col("ratio"))
    found = sites.select(host.alias("host"), path.alias("path"), "path_rate").first()
    assert abs(found["host"] - 0.9) < 0.02 and abs(found["path"] - 0.9) < 0.02


def test_features_do_not_depend_on_the_batch(sample):
    import pyarrow as pa

    texts = [r["text"] for r in sample.limit(40).collect()] + ["", None, "a\nb\nb\n", "é " * 30]
    together = quality.features(pa.array(texts))
    for k, text in enumerate(texts):
        assert np.allclose(together[k], quality.features(pa.array([text], pa.string()))[0]), k


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, None), (None, 1, 0), (7, None, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(odd, labels)
    assert rows.count() == odd.count()
    assert rows.filter(F.col("keep").isNull() | F.col("quality").isNull()).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.classify(odd, labels.limit(0)).filter("not keep").count() == 0
    assert quality.classify(empty, labels).count() == 0
