import re
from collections import defaultdict

from siltstone.llm import mixing


def targets(sizes):
    """Water filling, source by source, in exact fractions."""
    from fractions import Fraction

    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        share = Fraction(total - sum(3 * sizes[s] for s in full))
        out = {s: Fraction(3 * sizes[s]) for s in full}
        out |= {s: share * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if out[s] >= 3 * sizes[s]}
        if not above:
            return out
        full |= above


def check(docs):
    rows = mixing.plan_mix(docs).collect()
    inputs = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()]
    sizes = defaultdict(int)
    for _, s, n in inputs:
        sizes[s] += n
    want = targets(sizes)
    left = sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6)) for r in rows)
    right = sorted((str(d), n, sizes[s], round(float(want[s]), 6)) for d, s, n in inputs)
    assert left == right
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in rows)
    return rows


def test_targets_and_copies(sample):
    rows = check(sample)
    assert abs(sum(r["taken"] for r in rows) / sum(r["size"] for r in rows) - 1) < 0.1
    again = mixing.plan_mix(sample.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_sources_too_many_to_broadcast(sample, odd, monkeypatch):
    monkeypatch.setattr(mixing, "fits_broadcast", lambda df: False)
    check(sample)
    check(odd)


def test_small_sources_stop_at_three_times(spark):
    docs = spark.createDataFrame(
        [(k, "w " * n, None, s, 0) for k, (s, n) in enumerate([("a", 1000), ("b", 10), ("é", 3), ("z", 5), (None, 0), (None, 7)])],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    rows = check(docs)
    assert {r["doc_id"]: r["taken"] for r in rows}[1] == 30


def test_copies_are_whole_documents(sample):
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(sample).collect()}
    mixed = mixing.mix(sample)
    assert mixed.columns == sample.columns
    got = defaultdict(int)
    for r in mixed.select("doc_id").collect():
        got[r["doc_id"]] += 1
    assert dict(got) == {d: n for d, n in plan.items() if n}


def test_odd_rows(odd, empty):
    check(odd)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def taken_of_sevens(docs):
    """(taken, target) of the source whose documents have seven words."""
    rows = mixing.plan_mix(docs).collect()
    return sum(r["taken"] for r in rows if r["size"] == 7), next(r["target"] for r in rows if r["size"] == 7)


def test_targets_are_met_without_ids_with_one_id_and_with_equal_rows(spark):
    other = [(10**6 + k, "x " * 9, None, "b", 0) for k in range(300)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for doc_id in (None, 5):
        for text in ("w{} a b c d e f", "the same a b c d e"):
            rows = [(doc_id, text.format(k), None, "a", 0) for k in range(500)]
            docs = spark.createDataFrame(rows + other, schema).repartition(6)
            taken, target = taken_of_sevens(docs)
            assert abs(taken / target - 1) < 0.1, (doc_id, text, taken, target)
            mixed = mixing.mix(docs).filter("source = 'a'").count() * 7
            assert mixed == taken
