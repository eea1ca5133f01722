import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import language_id
from siltstone.llm.texts import flat


def segmentations(word, table):
    if not word:
        return 1.0
    return sum(table[word[:n]] * segmentations(word[n:], table) for n in range(1, len(word) + 1) if word[:n] in table)


def test_forward_sums_all_segmentations():
    import pyarrow as pa

    from siltstone.llm.texts import prefix_sums

    names = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"cab", b"bca"]
    pieces = language_id.Pieces(names)
    rng = np.random.default_rng(3)
    probs = rng.random((pieces.size, 2)) / 10
    probs[0] = 0
    for word in ("abcab", "a", "cabca", "zzabc", "é", "abcabcabcabc"):
        raw = word.encode()
        data, _ = flat(pa.array([word]))
        scores = language_id.word_scores(pieces, prefix_sums(data), np.array([0]), np.array([len(raw)]), probs)
        for column in range(2):
            table = {n: probs[k + 1, column] for k, n in enumerate(names)}
            assert np.isclose(np.exp(scores[0, column]), segmentations(raw, table))


def test_held_out_accuracy(sample):
    truth = {r["doc_id"]: r["lang"] for r in sample.collect()}
    rows = [r for r in language_id.identify(sample).collect() if r["held_out"]]
    assert 200 < len(rows) < 300
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_column_is_not_an_input(spark, sample):
    from pyspark.sql import functions as F

    held = language_id.held_out(F.col("doc_id"))
    other = sample.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    left = sorted(map(tuple, language_id.identify(sample).collect()))
    assert left == sorted(map(tuple, language_id.identify(other).collect()))


def test_odd_rows(odd, empty):
    rows = language_id.identify(odd).collect()
    assert len(rows) == odd.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 6)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (4, 5, 7, 8)} <= {"en", "fr"}
    assert language_id.identify(empty).count() == 0
    unlabelled = odd.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_whole_vocabulary_and_long_words():
    import pyarrow as pa

    from siltstone.llm.texts import prefix_sums

    names = language_id.vocabulary_pieces()
    assert max(map(len, names)) > 12 and len(names) > 20_000
    table = [bytes([b]) for b in range(256)] + [b"abcabcabcabc", "\u4e2d\u6587\u5b57".encode(), b"cab"]
    pieces = language_id.Pieces(table)
    probs = np.random.default_rng(5).random((pieces.size, 3)) / 10
    probs[0] = 0
    words = ["abc" * 40, "abc" * 11 + "a", "\u4e2d\u6587\u5b57" * 30, "x" * 2000, "abc"]
    data, offsets = flat(pa.array([" ".join(words)]))
    sums, starts, lengths, _, which = language_id.distinct_words(data, offsets, 0, len(data))
    assert sorted(lengths[which]) == sorted(len(w.encode()) for w in words)
    scores = language_id.word_scores(pieces, sums, starts, lengths, probs)[which]
    for k, word in enumerate(words):
        raw = word.encode()
        for column in range(3):
            alpha = [np.longdouble(1)]
            for j in range(1, len(raw) + 1):
                ways = [(n, raw[j - n : j]) for n in range(1, min(j, 12) + 1)]
                alpha.append(sum(alpha[j - n] * probs[table.index(p) + 1, column] for n, p in ways if p in table))
            assert np.isclose(float(np.log(alpha[-1])), scores[k, column])
    _, _, parts, _, which = language_id.distinct_words(data, offsets, 0, len(data), cut=True)
    assert parts.max() <= language_id.MAX_RUN and parts[which].sum() == sum(len(w.encode()) for w in words)


def test_every_language_is_learned(spark):
    rows = [(k, f"w{n}x" * 3, f"l{n}") for n in range(300) for k in (2 * n, 2 * n + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = docs.filter(~language_id.held_out(F.col("doc_id"))).select("lang").distinct().count()
    assert language_id.sample_of(docs).select("lang").distinct().count() == learned > 256


def test_copies_of_one_text_take_no_language_away(spark):
    french = [(k, f"le chat numéro {k} est sous la table et la rue est longue", "fr") for k in range(40)]
    english = [(10**6, "the cat is under the table and the road is long", "en")] * 6000
    docs = spark.createDataFrame(french + english, "doc_id long, text string, lang string").repartition(4)
    counts = {r["lang"]: (r["n"], r["texts"]) for r in language_id.sample_of(docs).groupBy("lang").agg(
        F.max("n").alias("n"), F.count("*").alias("texts")).collect()}
    learned = docs.filter(~language_id.held_out(F.col("doc_id")) & (F.col("lang") == "fr")).count()
    assert counts["fr"] == (learned, learned) and counts["en"] in ((6000, 1),)
    found = language_id.identify(docs.filter("lang = 'fr'").union(docs.limit(0))).filter("lang_pred = 'fr'").count()
    assert found == 40
    both = language_id.identify(docs).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in both} == {"fr": 40, "en": 6000}


def test_the_sample_does_not_depend_on_partitions(spark, sample):
    rows = [sorted(map(str, language_id.sample_of(d).collect())) for d in (sample, sample.repartition(7))]
    assert rows[0] == rows[1]
