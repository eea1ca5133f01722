"""Quality classifier: document evidence under hierarchical empirical Bayes over sites.

A logistic regression on the make-up of a text (shares of byte classes, word lengths, repeated
words and lines) gives each document's log likelihood ratio, good to bad. Sites follow the pages'
layout, a host and the section (first part of the path) below it; for ``documents`` these are
``source`` and ``lang``. Grouped sums of the documents' own probabilities give the number of good
ones per section and host. Host rates are shrunk towards the global rate, and section rates towards
their host's, by beta priors whose strength is fitted by the method of moments, so a site with few
documents stays near its parent. Probabilities and rates are worked out in turn, from the rate among
the labels on. The final log odds are the section's prior odds, from all its other documents, plus
the document's ratio; odds of 0 are rejected. A text of any length is worked on in blocks.

The classifier is fitted on at most ``SAMPLE_DOCS`` labelled documents, chosen by hash; site counts
cover every document. Null text counts as empty, null hosts and sections are sites of their own,
rows repeat as they come, extra columns pass through, an empty table gives no rows. Without labels
of both classes no document can be told apart, and all are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.texts import blocks, bound_batches, flat, lowered, prefix_sums, range_hash, slices, word_spans
from siltstone.runtime import checkpointed, fits_broadcast

SAMPLE_DOCS = 6000
KEEP_ODDS = 0.0
MAX_STRENGTH = 1000.0
MAX_RATIO = 12.0
ROUNDS = 5
STEP = 0.05
LEAST_RATE = 1e-6
_SALTS = 64

# One class per ASCII sign, one each for upper case, lower case, digit, blank, line end, control
# and non-ASCII bytes.
_CLASS = np.zeros(256, dtype=np.int64)
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
for _k, _b in enumerate(_SIGNS):
    _CLASS[_b] = 7 + _k
for _b in range(256):
    _c = chr(_b)
    if _b >= 128:
        _CLASS[_b] = 6
    elif _c.isupper():
        _CLASS[_b] = 0
    elif _c.islower():
        _CLASS[_b] = 1
    elif _c.isdigit():
        _CLASS[_b] = 2
    elif _c in " \t":
        _CLASS[_b] = 3
    elif _c == "\n":
        _CLASS[_b] = 4
    elif not _c.isprintable():
        _CLASS[_b] = 5
_CLASSES = 7 + len(_SIGNS)
FEATURES = _CLASSES + 6


def _repeats(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Per row, how many of its hashes it has had before."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    same = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    return np.bincount(r[1:][same], minlength=n).astype(float)


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text."""
    data, offsets = flat(texts)
    n = len(texts)
    classes = np.zeros((n, _CLASSES))
    row_parts, hash_parts, length_parts, line_rows, line_hashes = [], [], [], [], []
    for start, end in blocks(data, offsets):
        rows = np.searchsorted(offsets, np.arange(start, end), side="right") - 1
        low, high = int(rows[0]), int(rows[-1]) + 1
        counted = np.bincount(
            (rows - low) * _CLASSES + _CLASS[data[start:end]], minlength=(high - low) * _CLASSES
        )
        classes[low:high] += counted.reshape(high - low, _CLASSES)
        sums = prefix_sums(lowered(data[start:end]))
        first, last = word_spans(data, offsets, start, end)
        row_parts.append(rows[first])
        hash_parts.append(range_hash(sums, first, last))
        length_parts.append(last - first)
        breaks = np.flatnonzero(data[start:end] == 10)
        edges = offsets[(offsets > start) & (offsets < end)] - start
        cuts = np.unique(np.concatenate([[0], breaks + 1, edges, [end - start]]))
        line_rows.append(rows[cuts[:-1]])
        line_hashes.append(range_hash(sums, cuts[:-1], cuts[1:]))
    if not row_parts:
        return np.zeros((n, FEATURES))
    rows, hashes, lengths = map(np.concatenate, (row_parts, hash_parts, length_parts))
    lines, line_h = np.concatenate(line_rows), np.concatenate(line_hashes)
    words = np.bincount(rows, minlength=n)
    per = np.maximum(words, 1)
    twice = (rows[1:] == rows[:-1]) & (hashes[1:] == hashes[:-1])
    size = np.maximum(classes.sum(axis=1, keepdims=True), 1)
    n_lines = np.maximum(np.bincount(lines, minlength=n), 1)
    extra = np.stack(
        [
            np.log1p(words) / 10,
            np.bincount(rows, weights=lengths, minlength=n) / per / 10,
            np.bincount(rows[1:][twice], minlength=n) / per,
            _repeats(rows, hashes, n) / per,
            _repeats(lines, line_h, n) / n_lines,
            np.bincount(rows, weights=lengths > 20, minlength=n) / per,
        ],
        axis=1,
    )
    return np.concatenate([np.sqrt(classes / size), extra], axis=1)


@dataclass(frozen=True)
class Classifier:
    """Linear log odds over standardised features, with the training prior taken out."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def ratio(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio, good to bad, bounded by ``MAX_RATIO`` either way."""
        odds = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return np.clip(odds - self.prior, -MAX_RATIO, MAX_RATIO)


def fit_classifier(x: np.ndarray, good: np.ndarray, ridge: float = 1.0) -> Classifier:
    """Ridge-penalised logistic regression by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - good) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    rate = good.mean()
    return Classifier(mean, scale, w[:-1], float(w[-1]), float(np.log(rate / (1 - rate))))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Classifier | None:
    """Fitted on the labelled documents with the smallest hashes; None without both classes."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality").cast("double")).alias("good")
    )
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    extract = F.arrow_udf(
        lambda texts: pa.array(list(features(texts)), pa.list_(pa.float64())), "array<double>"
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "good", extract("text").alias("x"))
        .orderBy("doc_id", "x")
        .limit(sample)
        .collect()
    )
    good = np.array([float(r["good"] > 0) for r in rows])
    if not rows or good.min() == good.max():
        return None
    return fit_classifier(np.array([r["x"] for r in rows]), good)


def evidence_udf(model: Classifier | None):
    """The document's log likelihood ratio as a column function of its text."""

    def run(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(texts), MAX_RATIO))
        parts = [model.ratio(features(part)) for part in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(run, "double")


def _odds(rate: Column) -> Column:
    return F.log(rate / (1 - rate))


def _strength(sites: DataFrame, rate: Column) -> float:
    """Documents' worth of the beta prior around ``rate``, by the method of moments.

    The spread of site rates beyond what their sizes explain says how alike sites are: none
    beyond it means full trust in the parent, a wide one little.
    """
    row = sites.select(F.col("n"), F.col("good"), rate.alias("m")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.count("*").alias("k"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("m"), 2)).alias("spread"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("within"),
    ).first()
    if not row["n"] or row["k"] < 2 or not row["within"]:
        return MAX_STRENGTH
    mean_within = row["within"] / row["n"]
    between = (row["spread"] - row["k"] * mean_within) / max(row["n"] - row["nn"] / row["n"], 1e-9)
    if between <= mean_within / MAX_STRENGTH:
        return MAX_STRENGTH
    return max(mean_within / between - 1, 1.0)


def _chance(rate: Column, ratio: Column) -> Column:
    """Probability of a good document from its site's rate and its own likelihood ratio."""
    return 1 / (1 + F.exp(-(_odds(rate) + ratio)))


def site_posteriors(scored: DataFrame, start: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """(host, path, n, good, host_n, host_good, host_rate, path_rate, overall, a, b) per site, from
    rows (host, path, ratio) of all documents.

    Rounds start with every rate at ``start``: documents' probabilities under the present rates are
    summed per site, and the sums shrunk to new rates. A site is held as the numbers of its documents
    by ratio, in steps of ``STEP``, so rounds do not look at documents again.
    """
    cells = scored.groupBy("host", "path", F.round(F.col("ratio") / STEP).cast("int").alias("cell"))
    cells = cells.agg(F.count("*").alias("n"))
    sites = cells.groupBy("host", "path").agg(
        F.sort_array(F.collect_list(F.struct((F.col("cell") * STEP).alias("ratio"), "n"))).alias("cells"),
        F.sum("n").alias("n"),
    )
    rated = checkpointed(sites.withColumn("path_rate", F.lit(start)))
    for _ in range(rounds):
        good = F.aggregate(
            "cells", F.lit(0.0), lambda sum_, c: sum_ + c["n"] * _chance(_bounded(F.col("path_rate")), c["ratio"])
        )
        # Sums of decimals do not depend on the order of rows.
        paths = rated.select("host", "path", "cells", "n", good.cast("decimal(28,9)").alias("good"))
        hosts = checkpointed(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")))
        total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").cast("double").alias("good")).first()
        paths, hosts = (df.withColumn(c, F.col(c).cast("double")) for df, c in ((paths, "good"), (hosts, "host_good")))
        overall = (total["good"] + start) / (total["n"] + 1.0) if total["n"] else start
        a = round(_strength(hosts.selectExpr("host_n as n", "host_good as good"), F.lit(overall)), 6)
        host_rate = (F.col("host_good") + a * overall) / (F.col("host_n") + a)
        above = hosts.select(F.col("host").alias("h"), "host_n", "host_good", host_rate.alias("host_rate"))
        below = checkpointed(paths.join(above, F.col("host").eqNullSafe(F.col("h"))).drop("h"))
        b = round(_strength(below, F.col("host_rate")), 6)
        rate = (F.col("good") + b * F.col("host_rate")) / (F.col("n") + b)
        rated = below.withColumns(
            {"path_rate": rate, "overall": F.lit(overall), "a": F.lit(float(a)), "b": F.lit(float(b))}
        )
    return checkpointed(rated.drop("cells"))


def _bounded(rate: Column) -> Column:
    return F.least(F.greatest(rate, F.lit(LEAST_RATE)), F.lit(1 - LEAST_RATE))


def _without_own(ratio: Column) -> tuple[Column, Column]:
    """The host's and the section's rate from all other documents."""
    own = _chance(_bounded(F.col("path_rate")), ratio)
    host = (F.col("host_good") - own + F.col("a") * F.col("overall")) / (F.col("host_n") - 1 + F.col("a"))
    path = (F.col("good") - own + F.col("b") * host) / (F.col("n") - 1 + F.col("b"))
    return _bounded(host), _bounded(path)


_SITE = ("n", "good", "host_n", "host_good", "path_rate", "overall", "a", "b")


def _same() -> Column:
    return F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p"))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The documents in a column ``doc`` with evidence, host_rate, path_rate, quality and keep."""
    model = learn(bound_batches(docs), labels)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        evidence_udf(model)(F.col("text")).alias("ratio"),
        F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(_SALTS)).cast("int").alias("salt"),
    )
    start = 1 / (1 + np.exp(-model.prior)) if model else 0.5
    sites = site_posteriors(rows.select("host", "path", "ratio"), float(start))
    if fits_broadcast(sites):
        renamed = F.broadcast(sites.withColumnsRenamed({"host": "h", "path": "p"}))
        return _judged(rows.join(renamed, _same()))
    key = F.xxhash64(*[F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("host", "path")])
    # Each site's row is dealt over the salts, so that a site with a third of all rows is no one task's.
    dealt = sites.select(
        F.col("host").alias("h"),
        F.col("path").alias("p"),
        *_SITE,
        key.alias("k"),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("s"),
    )
    keyed = rows.withColumn("key", key)
    return _judged(keyed.join(dealt, (F.col("key") == F.col("k")) & (F.col("salt") == F.col("s")) & _same()))


def _judged(joined: DataFrame) -> DataFrame:
    host_rate, path_rate = _without_own(F.col("ratio"))
    odds = _odds(path_rate) + F.col("ratio")
    return joined.select(
        "doc",
        F.col("ratio").alias("evidence"),
        host_rate.alias("host_rate"),
        path_rate.alias("path_rate"),
        (1 / (1 + F.exp(-odds))).alias("quality"),
        (odds > KEEP_ODDS).alias("keep"),
    )


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """(doc_id, evidence, host_rate, path_rate, quality, keep) per document."""
    needed = docs.select("doc_id", "text", *[c for c in ("source", "lang") if c in docs.columns])
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    return score(needed, labels, host, path).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "evidence", "host_rate", "path_rate", "quality", "keep"
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier keeps, with their own columns."""
    return score(docs, labels, F.col("source"), F.col("lang")).filter("keep").select("doc.*")
