import random
import re

import numpy as np
import pyarrow as pa

from siltstone.llm import near_duplicates as nd
from siltstone.llm.components import components


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    """Component ids by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < k}:
            both = len(s & sets[j])
            if find(j) != find(k) and 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[max(find(j), find(k))] = min(find(j), find(k))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        r = find(k)
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return sorted((str(d), len(s), str(least.get(find(k)))) for k, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.report(frame).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got)


def test_whole_table(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    assert found(spark, rows) == brute(rows)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_around_the_threshold(spark):
    rng = random.Random(9)
    rows = []
    for g in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([40, 90, 300]))]
        for _ in range(rng.choice([2, 3, 8])):
            rows.append((len(rows), edited(rng, words, rng.randrange(0, max(2, len(words) // 25)))))
    assert found(spark, rows) == brute(rows)


def test_one_large_group(spark):
    """A region far above its size, chains in it, and other groups that share its first words."""
    rng = random.Random(10)
    common = [f"c{k}" for k in range(60)]
    rows = [(k, edited(rng, common, rng.randrange(0, 3))) for k in range(400)]
    chain = list(common)
    for k in range(400, 440):
        chain = chain[2:] + [f"d{k}", f"e{k}"]
        rows.append((k, " ".join(chain)))
    rows += [(k, " ".join(common[:25] + [f"f{k}-{j}" for j in range(30)])) for k in range(440, 520)]
    assert found(spark, rows) == brute(rows)


def test_blocks_are_compared_whole(monkeypatch):
    monkeypatch.setattr(nd, "_COLUMNS", 64)
    rng = random.Random(12)
    base = [f"b{k}" for k in range(60)]
    texts = [edited(rng, base, rng.randrange(1, 4)) for _ in range(80)] + ["q " * k for k in range(3, 9)]
    sets = nd.shingle_sets(pa.array(texts))
    own = np.array([k % 3 > 0 for k in range(len(sets))])
    component = np.arange(len(sets)) // 2
    found = nd.across(sets, component, own)
    linked = {
        (i, j)
        for i in range(len(sets))
        for j in range(len(sets))
        if own[i] and component[i] != component[j]
        and 100 * len(set(sets[i]) & set(sets[j])) >= 75 * len(set(sets[i]) | set(sets[j]))
    }
    assert set(found) <= linked and len(found) < len(sets)

    def joined(pairs):
        root = list(range(len(sets)))
        for x, y in [*pairs, *[(k, k + 1) for k in range(0, len(sets) - 1, 2)]]:
            a, b = root[x], root[y]
            root = [a if r == b else r for r in root]
        return [root.index(r) for r in root]

    assert joined(found) == joined(linked) and len(set(joined(found))) < 60


def test_few_words_and_ties(spark):
    rows = [(1, "A b"), (2, "a B"), (3, "a b c"), (4, ""), (5, None), (6, " "), (None, "a b"), (None, "q r s t u v"), (7, "É b"), (8, "é b"), (1, "A b"), (9, "b a")]
    assert found(spark, rows) == brute(rows)


def test_keep_one(odd, empty):
    left = nd.keep_one(odd)
    assert left.columns == odd.columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(["1", "None", "None", "2", "3", "4", "6", "7", "8"])
    assert nd.keep_one(empty).count() == 0 and nd.report(empty).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(60) if k != 30] + [(100, 5), (200, 201), (201, 202), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 0 for k in (*range(31), 100)} | {k: 31 for k in range(31, 61)} | {k: 200 for k in (200, 201, 202)}
