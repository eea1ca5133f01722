import re
from collections import Counter
from fractions import Fraction

import pytest

from siltstone.llm import joins, phrases, texts

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 5):
                f.update((lang or "und", *words[i : i + m]) for i in range(len(words) - m + 1))
    found = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    out = []
    for lang in n:
        ranked = []
        for p, a in ((p, a) for p, a in found.items() if p[0] == lang):
            w = p[1:]
            cuts = []
            for k in range(1, len(w)):
                left, right = f[(lang, *w[:k])], f[(lang, *w[k:])]
                cuts.append((int(Fraction(2000000 * a, left + right)), k, left, right))
            score, _, left, right = min(cuts)
            inside = [
                c for q, c in found.items()
                if q[0] == lang and len(q) > len(p) and any(q[i : i + len(w)] == w for i in range(1, len(q)))
            ]
            if not any(100 * c >= 80 * a for c in inside):
                ranked.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **kwargs):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame = frame.selectExpr("*", "'x' as place", "1 as level", "'y' as phrase", "2 as h1", "3 as n", "4 as f")
    found = phrases.collocations(frame, **kwargs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 250")
    return [(r["doc_id"], r["text"], r["lang"]) for r in table.collect()]


def test_documents(spark, rows):
    want = brute(rows)
    assert mined(spark, rows) == want and len(want) > 20
    assert mined(spark, rows, top=7) == brute(rows, top=7)


def test_nothing_proposed_is_found_in_further_passes(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLE_LEAST", 10**9)
    passes = []
    real = phrases.tally
    monkeypatch.setattr(phrases, "tally", lambda d, levels, *f: passes.append(levels) or real(d, levels, *f))
    assert mined(spark, rows) == brute(rows)
    assert passes[0] == [1] and passes[2:] == [[1, 2, 3, 4], *[[2, 3, 4]] * 3]


def test_full_filters_small_blocks_and_heavy_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", (64, 1024))
    monkeypatch.setattr(phrases, "HELD_ROWS", 2000)
    monkeypatch.setattr(phrases, "PART_BYTES", 1000)
    monkeypatch.setattr(texts, "BLOCK_BYTES", 300)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "HEAVY_ROWS", 20)
    assert mined(spark, rows[:120]) == brute(rows[:120])


ODD = [
    (1, None, "en"),
    (2, "", None),
    (None, "a b c d e " * 40, None),
    (3, "A  B\tc . d, e" * 40, "und"),
    (4, "x x x x x x " * 2000, "fr"),
    (5, "w" * 300_000 + " end", "fr"),
    (6, "à b\xa0c   é è! " * 50, "fr"),
    (6, "à b\xa0c   é è! " * 50, "fr"),
    (7, " ,;: \n", "de"),
    (8, "one two three four five six\r\nseven" * 31, "de"),
]


@pytest.mark.parametrize("block", [1 << 19, 7])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(texts, "BLOCK_BYTES", block)
    want = brute(ODD)
    assert mined(spark, ODD) == want and {"und", "fr", "de"} == {r[0] for r in want}
    assert mined(spark, ODD[:2]) == mined(spark, []) == []


def test_a_phrase_across_blocks_of_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(texts, "BLOCK_BYTES", 64)
    text = " ".join(f"w{i % 7} alpha beta gamma delta" for i in range(3000))
    assert mined(spark, [(1, text, "en")]) == brute([(1, text, "en")])


def test_shares_are_exact_beyond_64_bits(spark):
    score = spark.sql(
        "select (cast(2000000 as decimal(8,0)) * cast(9000000000000000000 as decimal(20,0)))"
        " div (cast(9100000000000000000 as decimal(38,0)) + 9200000000000000001) as s"
    ).first()["s"]
    assert score == 2000000 * 9 * 10**18 // (91 * 10**17 + 92 * 10**17 + 1)
