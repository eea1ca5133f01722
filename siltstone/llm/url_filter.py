"""URL filter: suffix rules first, then segmented host and path words under naive Bayes.

Names run together in hosts ("freecasinobets") are split by a unigram Viterbi search over the
whole words of a public vocabulary, whose ranks give word probabilities by Zipf's law. Multinomial
naive Bayes then scores host and path words. It learns from all URLs of the table by expectation
maximisation: URLs with a seed word are bad in every round; the others count as bad by the chance that
the last round's words give them, so a word that stands beside seed words gains weight, and then those
beside it. URLs without a seed word weigh ``UNLABELLED`` as much, or the many would wash out the few.
Counts are grouped over the whole table in whole numbers, so reruns agree; only words of the vocabulary
are features, so the model is bounded by the vocabulary.

Nulls, and URLs without "://", have an empty host and path; no rule fits them and the method
allows them. Rows repeat as they come; other columns, whatever their names, are not read. An empty
table gives no rows. Very long URLs are segmented whole. A score of exactly 0 is allowed.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"

# The rules, as (verdict, host and path).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# Words that mark a bad URL for training.
SEED_WORDS = (
    "adult bet bets betting casino cheap gambling jackpot lottery nude pills poker porn "
    "sex slots spam viagra xxx"
).split()

MAX_WORD = 20
MIN_PIECE = 3
SMOOTHING = 10.0
# Share of bad URLs before any word is seen, rounds of learning, and weight of URLs without a seed word.
PRIOR = 0.05
ROUNDS = 4
UNLABELLED = 0.25
_SEED_COUNT = 1.0
# Soft counts are whole numbers of this part of a URL.
_UNIT = 1 << 20
_CACHED_RUN = 64
_RUN = re.compile(r"[a-z]+|[0-9]+")


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits the host or a parent of it, and the path."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def word_costs(path: str = VOCABULARY) -> dict[str, float]:
    """-log probability of each whole lower-case word of the vocabulary, by rank."""
    with open(path, encoding="utf-8") as f:
        ranks = json.load(f)["model"]["vocab"]
    whole = [w[:-4] for w, _ in sorted(ranks.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    words = [w for w in whole if re.fullmatch("[a-z]+", w) and (len(w) >= MIN_PIECE or w in ("a", "i", "x"))]
    total = sum(1 / (k + 10) for k in range(len(words)))
    return {w: math.log((k + 10) * total) for k, w in enumerate(words) if len(w) <= MAX_WORD}


def segment(run: str, costs: dict[str, float]) -> list[str]:
    """The cheapest split of a run of letters; letters that fit no word come out one by one.

    Of the costs only those of the last ``MAX_WORD`` places are held, of the split a byte a letter.
    """
    unknown = 14.0
    recent, length = [0.0], bytearray(len(run) + 1)
    for end in range(1, len(run) + 1):
        least, chosen = math.inf, 1
        for back in range(len(recent), 0, -1):
            word = costs.get(run[end - back : end], unknown if back == 1 else math.inf)
            if recent[-back] + word < least:
                least, chosen = recent[-back] + word, back
        recent.append(least)
        length[end] = chosen
        del recent[:-MAX_WORD]
    words, end = [], len(run)
    while end:
        words.append(run[end - length[end] : end])
        end -= length[end]
    return words[::-1]


def url_words(host: str, path: str, costs: dict[str, float], seen: dict[str, list[str]]) -> list[str]:
    """Words of host and path; numbers become one token, unknown letters another."""
    out = []
    for run in _RUN.findall(host + " " + path.lower()):
        if run[0].isdigit():
            out.append("<number>")
            continue
        words = seen.get(run)
        if words is None:
            words = [w if w in costs else "<letter>" for w in segment(run, costs)]
            if len(run) <= _CACHED_RUN and len(seen) < 100_000:
                seen[run] = words
        out += words
    return out


def log_odds(words: list[str], weights: dict[str, float], prior: float) -> float:
    """Log odds, bad to good, of a URL with these words; words without a weight say nothing."""
    return math.fsum((math.log(prior / (1 - prior)), *(weights.get(w, 0.0) for w in words)))


def _count_words(costs: dict[str, float], seeds: frozenset, weights: dict[str, float], prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good: dict[str, int] = {}
        bad: dict[str, int] = {}
        seen: dict[str, list[str]] = {}
        for batch in batches:
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True):
                words = url_words(host, path, costs, seen)
                if not seeds.isdisjoint(words):
                    as_bad, as_good = _UNIT, 0
                else:
                    # Before the first round there is nothing to tell them by: they count as good.
                    odds = log_odds(words, weights, prior) if weights else -math.inf
                    chance = 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0
                    as_bad = round(chance * UNLABELLED * _UNIT)
                    as_good = round((1 - chance) * UNLABELLED * _UNIT)
                for w in words:
                    bad[w] = bad.get(w, 0) + as_bad
                    good[w] = good.get(w, 0) + as_good
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(good), pa.string())}
            | {n: pa.array(c.values(), pa.int64()) for n, c in (("good", good), ("bad", {w: bad[w] for w in good}))}
        )

    return run


def _weights(good: dict[str, float], bad: dict[str, float]) -> dict[str, float]:
    n_good, n_bad = sum(good.values()), sum(bad.values())

    def chance(of: dict[str, float], n: float, w: str) -> float:
        # Smoothed towards both classes together, so that a rare word leans to neither for its rarity.
        pooled = (good.get(w, 0) + bad.get(w, 0)) / (n_good + n_bad)
        return (of.get(w, 0) + SMOOTHING * pooled) / (n + SMOOTHING)

    return {w: math.log(chance(bad, n_bad, w) / chance(good, n_good, w)) for w in good.keys() | bad.keys()}


def fit(urls: DataFrame, costs: dict[str, float], seeds=SEED_WORDS, prior: float = PRIOR) -> dict[str, float]:
    """Log likelihood ratio, bad to good, of each word; at most one per word of the vocabulary.

    ``ROUNDS`` passes over all URLs. Seed words join the bad side with a count of one each, so that an
    input without bad URLs still has both classes. Words never seen weigh nothing.
    """
    weights: dict[str, float] = {}
    for _ in range(ROUNDS):
        counts = urls.mapInArrow(
            _count_words(costs, frozenset(seeds), weights, prior), "word string, good long, bad long"
        )
        rows = counts.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
        good = {r["word"]: r["good"] / _UNIT for r in rows}
        bad = {r["word"]: r["bad"] / _UNIT for r in rows}
        for w in seeds:
            bad[w] = bad.get(w, 0) + _SEED_COUNT
        weights = _weights(good, bad)
    return weights


def judge(
    pages: DataFrame,
    vocabulary: str = VOCABULARY,
    rules=RULES,
    seeds=SEED_WORDS,
    prior: float = PRIOR,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else the method's.

    ``score`` is the method's log odds that the URL is bad, given for every row; ``prior`` the share of
    bad URLs that it starts from.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    costs = word_costs(vocabulary)
    weights = fit(urls.select("host", "path"), costs, seeds, prior)

    @F.arrow_udf("double")
    def scored(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        seen: dict[str, list[str]] = {}
        pairs = zip(hosts.to_pylist(), paths.to_pylist(), strict=True)
        words = (url_words(h, p, costs, seen) for h, p in pairs)
        return pa.array([log_odds(some, weights, prior) for some in words], pa.float64())

    ruled = urls.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "score", scored("host", "path")
    )
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return ruled.select(
        "page_id",
        "host",
        "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", method).alias("verdict"),
        "score",
    )
