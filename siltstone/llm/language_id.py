"""Language identification: unigram pieces, all segmentations summed.

Pieces are those of a fixed public vocabulary, all of them, and every single byte. Each
language gives each piece a probability, and a word's probability is the sum over all its
segmentations, by the forward algorithm. Probabilities come from a few rounds of
expectation-maximisation over the words of a bounded sample of different labelled texts, at most about
``SAMPLE_DOCS`` per language, each language in a task of its own. A text's log likelihood is the sum over all its words, each distinct
word worked out once per block; with the languages' shares as prior this gives the score, the
posterior of the language predicted.

Null text, and text without a letter, gets "und" and score 0. Ties go to the smaller language
name. Null languages are not learned, all others are; with no labelled text every prediction is "und".
Words of any length are scored whole; those above ``MAX_RUN`` bytes are learned from in parts of about that
length, cut between characters. Rows repeat as they come, extra columns are
not read, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.texts import blocks, bound_batches, flat, lowered, prefix_sums, range_hash, word_spans
from siltstone.runtime import checkpointed, fits_broadcast

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
MAX_RUN = 32
SAMPLE_DOCS = 600
SAMPLE_BYTES = 4 << 20
ROUNDS = 3
# Languages scored at a time.
_COLUMNS = 32
# Larger than elsewhere: the more text, the fewer of its words are distinct.
WORD_BLOCK = 4 << 20
_SLOTS = 1 << 18


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept from training: its id's CRC-32 leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def vocabulary_pieces(path: str = VOCABULARY) -> list[bytes]:
    """Every byte, then the vocabulary's pieces of 2 bytes and more, lower-cased."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(k).removeprefix("▁").lower().encode() for k in range(model.get_piece_size())}
    longer = sorted(p for p in pieces if len(p) >= 2 and not p.startswith(b"<0x"))
    return [bytes([b]) for b in range(256)] + longer


class Pieces:
    """Looks up byte ranges among the pieces by hash; 0 stands for none."""

    def __init__(self, pieces: list[bytes]):
        data, offsets = flat(pa.array(pieces, pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
        hashes = range_hash(prefix_sums(data), offsets[:-1], offsets[1:])
        self.size = len(pieces) + 1
        self.longest = max(map(len, pieces))
        self._keys = np.zeros(4 * _SLOTS, dtype=np.uint64)
        self._ids = np.zeros(4 * _SLOTS, dtype=np.int32)
        for h, k in zip(hashes, range(1, self.size), strict=True):
            slot = int(h) & (_SLOTS - 1)
            while self._ids[slot]:
                slot += 1
            self._keys[slot], self._ids[slot] = h, k
        self._probes = 1
        taken = np.flatnonzero(self._ids)
        self._probes = int((taken - (self._keys[taken] & np.uint64(_SLOTS - 1)).astype(np.int64)).max()) + 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        out = np.where(self._keys[slots] == hashes, self._ids[slots], 0)
        for step in range(1, self._probes):
            again = np.flatnonzero((out == 0) & (self._ids[slots + step] != 0))
            if not len(again):
                break
            at = slots[again] + step
            out[again] = np.where(self._keys[at] == hashes[again], self._ids[at], 0)
        return out


def distinct_words(
    data: np.ndarray, offsets: np.ndarray, start: int, end: int, cut: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums for hashing, starts and lengths of the block's distinct words, and for every word its
    row and which distinct word it is. With ``cut``, longer words are cut at most every ``MAX_RUN``
    bytes, between characters.
    """
    first, last = word_spans(data, offsets, start, end)
    rows = np.searchsorted(offsets, first + start, side="right") - 1
    if cut and len(first) and int((last - first).max()) > MAX_RUN:
        # Parts of MAX_RUN - 3 bytes: a cut goes on over at most 3 bytes within a character.
        step = MAX_RUN - 3
        parts = -(-(last - first) // step)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(last, parts)
        first = np.repeat(first, parts) + nth * step
        rows = np.repeat(rows, parts)
        inside = np.append((data[start:end] & 0xC0) == 0x80, False)
        for _ in range(3):
            first = np.where((nth > 0) & (first < ends) & inside[np.minimum(first, len(inside) - 1)], first + 1, first)
        more = np.append(nth[1:] > 0, False)
        last = np.where(more, np.append(first[1:], 0), ends)
        some = last > first
        first, last, rows = first[some], last[some], rows[some]
    sums = prefix_sums(lowered(data[start:end]))
    _, index, which = np.unique(range_hash(sums, first, last), return_index=True, return_inverse=True)
    return sums, first[index], last[index] - first[index], rows, which


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(lengths, kind="stable")
    sizes, begins = np.unique(lengths[order], return_index=True)
    for size, group in zip(sizes, np.split(order, begins[1:]), strict=True):
        for k in range(0, len(group), 8192):
            yield int(size), group[k : k + 8192]


def _lattice(pieces: Pieces, sums: np.ndarray, starts: np.ndarray, size: int) -> list[list[np.ndarray]]:
    """ids[j][n - 1]: the piece that covers bytes [j - n, j) of each word."""
    return [
        [pieces.find(range_hash(sums, starts + j - n, starts + j)) for n in range(1, min(j, pieces.longest) + 1)]
        for j in range(1, size + 1)
    ]


def forward(lattice: list[list[np.ndarray]], probs: np.ndarray) -> list[np.ndarray]:
    """alpha[j]: probability of the first j bytes, by word and language, all segmentations."""
    words = len(lattice[0][0])
    alpha = [np.ones((words, probs.shape[1]))]
    for ids in lattice:
        alpha.append(sum(alpha[-n] * probs[ids[n - 1]] for n in range(1, len(ids) + 1)))
    return alpha


def backward(lattice: list[list[np.ndarray]], probs: np.ndarray) -> list[np.ndarray]:
    size, words = len(lattice), len(lattice[0][0])
    beta = [np.zeros((words, probs.shape[1])) for _ in range(size)] + [np.ones((words, probs.shape[1]))]
    for j in range(size, 0, -1):
        for n, ids in enumerate(lattice[j - 1], 1):
            beta[j - n] = beta[j - n] + probs[ids] * beta[j]
    return beta


def word_scores(pieces: Pieces, sums, starts, lengths, probs: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language."""
    out = np.zeros((len(starts), probs.shape[1]))
    short = np.flatnonzero(lengths <= MAX_RUN)
    for size, group in _by_length(lengths[short]):
        group = short[group]
        out[group] = np.log(forward(_lattice(pieces, sums, starts[group], size), probs)[-1])
    # Words of like length go together, the longest first, few at a time.
    far = np.flatnonzero(lengths > MAX_RUN)
    far = far[np.argsort(-lengths[far], kind="stable")]
    for k in range(0, len(far), 256):
        group = far[k : k + 256]
        out[group] = _long_scores(pieces, sums, starts[group], lengths[group], probs)
    return out


def _long_scores(pieces: Pieces, sums, starts, lengths, probs: np.ndarray) -> np.ndarray:
    """The same for long words, by falling length: alpha is carried on, scaled anew every ``MAX_RUN`` bytes."""
    reach, out = pieces.longest, np.zeros((len(starts), probs.shape[1]))
    # Extended range, as an unlikely stretch of a piece's length must not become 0.
    likely = probs.astype(np.longdouble)
    back = np.arange(1, reach + 1)
    last = np.zeros((len(starts), reach, probs.shape[1]), dtype=np.longdouble)
    last[:, 0] = 1
    scale = np.zeros((len(starts), probs.shape[1]))
    for at in range(0, int(lengths[0]), MAX_RUN):
        n = int(np.searchsorted(-lengths, -at))
        last, scale = last[:n], scale[:n]
        steps = np.arange(at + 1, min(at + MAX_RUN, int(lengths[0])) + 1)
        ends = np.minimum(steps, lengths[:n, None])
        begins = ends[:, :, None] - back
        known = (begins >= 0) & (steps <= lengths[:n, None])[:, :, None]
        base = starts[:n, None, None]
        low = base + np.maximum(begins, 0)
        high = np.broadcast_to(base + ends[:, :, None], low.shape)
        ids = np.where(known, pieces.find(range_hash(sums, low.ravel(), high.ravel())).reshape(low.shape), 0)
        for k, j in enumerate(steps):
            used = np.flatnonzero(ids[:, k].any(axis=0))
            alpha = (last[:, used] * likely[ids[:, k][:, used]]).sum(axis=1)
            done = np.flatnonzero(lengths[:n] == j)
            if len(done):
                out[done] = (np.log(alpha[done]) + scale[done]).astype(float)
            last = np.concatenate([alpha[:, None], last[:, :-1]], axis=1)
        most = last.max(axis=1)
        most[most == 0] = 1
        last /= most[:, None]
        scale = scale + np.log(most).astype(float)
    return out


def fit(samples: dict[str, list[str]], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """Languages by name and their piece probabilities, (pieces + 1) x languages; row 0 is none."""
    languages = sorted(samples)
    probs = np.zeros((pieces.size, len(languages)))
    for column, language in enumerate(languages):
        data, offsets = flat(pa.array(samples[language], pa.string()))
        counts = np.zeros(pieces.size)
        mine = np.full((pieces.size, 1), 1.0 / pieces.size)
        mine[0] = 0
        for _ in range(ROUNDS):
            counts[:] = 0
            for start, end in blocks(data, offsets):
                sums, starts, lengths, _, which = distinct_words(data, offsets, start, end, cut=True)
                times = np.bincount(which, minlength=len(starts)).astype(float)
                for size, group in _by_length(lengths):
                    lattice = _lattice(pieces, sums, starts[group], size)
                    alpha, beta = forward(lattice, mine), backward(lattice, mine)
                    scale = times[group] / alpha[-1][:, 0]
                    for j, ids in enumerate(lattice, 1):
                        for n, found in enumerate(ids, 1):
                            share = alpha[j - n][:, 0] * mine[found, 0] * beta[j][:, 0] * scale
                            counts += np.bincount(found, weights=share, minlength=pieces.size)
            counts[0] = 0
            mine[1:, 0] = (counts[1:] + 0.05) / (counts.sum() + 0.05 * (pieces.size - 1))
        probs[:, column] = mine[:, 0]
    return languages, probs


def sample_of(docs: DataFrame) -> DataFrame:
    """(lang, n, chance, text): per language a bounded sample of its different labelled texts, chosen
    by hash, each with the number of all its labelled rows.
    """
    learn = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = learn.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    # A document that stands often is one; so copies neither fill the sample nor thin it out.
    copies = hashed.groupBy("lang", "h").agg(F.count("*").alias("n"))
    sizes = checkpointed(copies.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("different")))
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE_DOCS)) / F.col("different"))
    shares = sizes.select("lang", "n", share.alias("share"))
    if fits_broadcast(sizes):
        shares = F.broadcast(shares)
    chance = F.pmod("h", F.lit(1 << 20)) / F.lit(float(1 << 20))
    likely = hashed.withColumn("chance", chance).join(shares, "lang").filter("chance < share")
    once = likely.groupBy("lang", "h").agg(
        F.first("n").alias("n"), F.first("chance").alias("chance"), F.min("text").alias("text")
    )
    order = Window.partitionBy("lang").orderBy("chance", "h")
    kept = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2 * SAMPLE_DOCS)
    return kept.select("lang", "n", "chance", "text")


def learned(sample: DataFrame, words: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages by name, their piece probabilities and numbers of rows; a language is one task's."""

    def fitted(table: pa.Table) -> pa.Table:
        rows = table.sort_by("chance")
        taken, room = [], SAMPLE_BYTES
        for text in rows["text"]:
            size = len(text.as_py())
            if size <= room or not taken:
                room -= size
                taken.append(text.as_py())
        lang = rows["lang"][0].as_py()
        _, probs = fit({lang: taken}, Pieces(words))
        return pa.table({"lang": [lang], "n": rows["n"][:1], "probs": pa.array([probs[:, 0].tobytes()], pa.binary())})

    found = sample.groupBy("lang").applyInArrow(fitted, "lang string, n long, probs binary").collect()
    found = sorted(found, key=lambda r: r["lang"])
    if not found:
        return [], np.zeros((0, 0)), np.zeros(0)
    probs = np.stack([np.frombuffer(r["probs"]) for r in found], axis=1)
    return [r["lang"] for r in found], probs, np.array([r["n"] for r in found], dtype=float)


def predictor(languages: list[str], probs: np.ndarray, prior: np.ndarray, words: list[bytes]):
    """A function from texts to (language, posterior)."""

    # Made once per task, by the first batch.
    known: list[Pieces] = []

    def predict(texts: pa.Array) -> tuple[list[str], list[float]]:
        if not known:
            known.append(Pieces(words))
        pieces = known[0]
        data, offsets = flat(texts)
        total = np.tile(prior, (len(texts), 1))
        for start, end in blocks(data, offsets, WORD_BLOCK):
            sums, starts, lengths, rows, which = distinct_words(data, offsets, start, end)
            for left in range(0, len(languages), _COLUMNS):
                scores = word_scores(pieces, sums, starts, lengths, probs[:, left : left + _COLUMNS])
                for column in range(scores.shape[1]):
                    weights = scores[which, column]
                    total[:, left + column] += np.bincount(rows, weights=weights, minlength=len(texts))
        best = total.argmax(axis=1)
        weight = np.exp(total - total.max(axis=1, keepdims=True))
        posterior = 1.0 / weight.sum(axis=1)
        return [languages[k] for k in best], posterior.tolist()

    return predict


def identify(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document."""
    words = vocabulary_pieces(vocabulary)
    languages, probs, sizes = learned(sample_of(bound_batches(docs)), words)
    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(readable, F.col("text")).alias("text"),
    )
    if not languages:
        return base.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    predict = predictor(languages, probs, np.log(sizes / sizes.sum()), words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted = zip(*predict(batch["text"]), batch["text"].is_valid().to_pylist(), strict=True)
            judged = [(name, score) if known else (UNKNOWN, 0.0) for name, score, known in predicted]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": pa.array([name for name, _ in judged], pa.string()),
                    "score": pa.array([score for _, score in judged], pa.float64()),
                }
            )

    return base.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
