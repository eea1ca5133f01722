"""Secret scan: fixed patterns, and strings that a primed compressor finds new.

Patterns give the base spans. The method adds strings in a sensitive context (a word such as
"secret" or "bearer" within ``CONTEXT`` characters of either end, or inside) that cannot be predicted: a zstandard compressor is primed with
a dictionary of identifiers, and a candidate's novelty is what it adds to the compressed size of
the text around it, per character. Names, paths and repeated strings add little; random keys add
about their entropy. Every whole candidate is judged, and those that adjoin one in context, as the
lines of a key block do, are in context too.

The identifier dictionary is made by rule from a public vocabulary (its alphabetic pieces, most
frequent last, up to ``DICTIONARY_BYTES``). Null text counts as empty; offsets are code points, end
exclusive. Rows repeat as they come, other columns are not read, an empty table gives no rows.
Whole texts are searched, whatever their length.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.texts import bound_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
DICTIONARY_BYTES = 64 << 10

# Base kinds in the order of the digest, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 12, 18

NOVEL = "novel"
SENSITIVE = (
    "password passwd passphrase pwd secret token apikey api_key api-key auth bearer credential private "
    "access_key signature client_id encryption webhook"
).split()
CONTEXT = 128
AROUND = 512
LEAST_CHARS = 16
LEAST_NOVELTY = 0.8
# Names are as new as keys to the compressor: without a digit, this share of letters must change case.
LEAST_CHANGES = 0.3
LEVEL = 15
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# What parts the lines of one block: a line end, indents, quotes, an escaped line end, a comment mark.
_JOINT = re.compile(r"(?:\\[rn]|[\s\"',;:+#>*|-]){1,64}")
_SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE)

Span = tuple[str, int, int]


def identifier_dictionary(path: str = VOCABULARY, size: int = DICTIONARY_BYTES) -> bytes:
    """Alphabetic pieces of the vocabulary, the most frequent nearest to the text."""
    with open(path, encoding="utf-8") as f:
        ranks = json.load(f)["model"]["vocab"]
    pieces, total = [], 0
    for piece, _ in sorted(ranks.items(), key=lambda x: x[1]):
        word = piece.removeprefix("Ġ")
        if len(word) >= 4 and word.isascii() and word.isalpha():
            total += len(word) + 1
            if total > size:
                break
            pieces.append(word)
    return "_".join(reversed(pieces)).encode()


class Novelty:
    """Marginal compressed bytes per character, under one primed compressor."""

    def __init__(self, dictionary: bytes):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self._compress = zstandard.ZstdCompressor(
            dict_data=primed, write_content_size=False, write_dict_id=False
        ).compress

    def of(self, text: str, start: int, end: int, block: tuple[int, int] | None = None) -> float:
        """What text[start:end] adds to its surroundings, all but itself, or its block, as context first."""
        first, last = block or (start, end)
        left, right = text[max(0, first - AROUND) : first], text[last : last + AROUND]
        context = (right + "\n" + left).encode()
        candidate = text[start:end].encode()
        return (len(self._compress(context + candidate)) - len(self._compress(context))) / (end - start)


def find(text: str, low: str) -> list[Span]:
    """Base spans by start, then kind. ``low`` is the text with A-Z lower-cased, or like it."""
    spans: list[Span] = []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    kinds = (*KINDS, NOVEL)
    return span[1], kinds.index(span[0]), span[2]


def _may_be_key(candidate: str) -> bool:
    if any(c.isdigit() for c in candidate):
        return True
    changes = sum(a.isalpha() and b.isalpha() and a.isupper() != b.isupper() for a, b in pairwise(candidate))
    return changes >= LEAST_CHANGES * (len(candidate) - 1)


def _blocks(text: str) -> Iterator[list[tuple[int, int]]]:
    """Whole candidates by block: those with nothing but ``_JOINT`` between, as the lines of a key have.
    Blocks with a candidate that holds a sensitive word, or is within ``CONTEXT`` of one on either side.
    """
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    begins, ends = [s for s, _ in words], [e for _, e in words]

    def near(start: int, end: int) -> bool:
        # The first word that ends within reach of the start must begin within reach of the end.
        k = bisect_left(ends, start - CONTEXT)
        return k < len(ends) and begins[k] <= end + CONTEXT

    block: list[tuple[int, int]] = []
    close = False
    for m in _CANDIDATE.finditer(text):
        if block and not _JOINT.fullmatch(text, block[-1][1], m.start()):
            if close:
                yield block
            block, close = [], False
        block.append(m.span())
        close = close or near(*m.span())
    if close:
        yield block


def find_novel(text: str, low: str, novelty: Novelty) -> list[Span]:
    """Strings near a sensitive word that cost nearly their full length to compress."""
    if not any(w in low for w in SENSITIVE):
        return []
    found = []
    for block in _blocks(text):
        seen: set[str] = set()
        bounds = block[0][0], block[-1][1]
        for start, end in block:
            candidate = text[start:end]
            if not _may_be_key(candidate):
                continue
            new = novelty.of(text, start, end) >= LEAST_NOVELTY
            # Lines of a key make each other's characters cheap, so they are held against the rest too.
            if not new and len(block) > 1 and candidate not in seen:
                new = novelty.of(text, start, end, bounds) >= LEAST_NOVELTY
            seen.add(candidate)
            if new:
                found.append((NOVEL, start, end))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scan(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in (*KINDS, NOVEL)}
            digests, everything = [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                low = text.lower()
                base = find(text, low)
                spans = sorted(base + find_novel(text, low, novelty), key=_order)
                for kind, into in counts.items():
                    into.append(sum(s[0] == kind for s in spans))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                everything.append(joined(spans))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"]}
                | {f"n_{k}": pa.array(counts[k], pa.int64()) for k in KINDS}
                | {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(everything, pa.string())}
                | {f"n_{NOVEL}": pa.array(counts[NOVEL], pa.int64())}
            )

    return run


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel) per document."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return bound_batches(docs).selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        _scan(identifier_dictionary(vocabulary)),
        f"doc_id long, {counts}, base_sha256 string, spans string, n_{NOVEL} long",
    )


def redact(docs: DataFrame, vocabulary: str = VOCABULARY, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span found, base or added, replaced by ``mask``; columns stay."""
    dictionary = identifier_dictionary(vocabulary)

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        novelty = Novelty(dictionary)
        out = []
        for text in texts.to_pylist():
            if text is not None:
                low, kept, at = text.lower(), [], 0
                for _, start, end in sorted(find(text, low) + find_novel(text, low, novelty), key=_order):
                    if end > at:
                        kept += [text[at:start], mask] if start >= at else []
                        at = end
                text = "".join(kept) + text[at:]
            out.append(text)
        return pa.array(out, pa.string())

    return bound_batches(docs).withColumn("text", masked("text"))
