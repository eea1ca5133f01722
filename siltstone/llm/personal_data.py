"""Personal data: identifiers as written, and those behind disguises, at source offsets.

Base kinds are found in the text as it is. Then transducers rewrite the text, keeping for every
character written the range of source characters it stands for: homoglyphs and full-width forms to
ASCII, spelled digits ("five five") to digits, "(at)", "[dot]", " at ... dot " to "@" and ".". The
same detectors run on the rewritten text, and their spans are mapped back to source characters. A
span found this way is added if it overlaps no base span of its kind, or is an email that goes on from
one over spelled signs. Bare " at " and " dot " count in a whole chain of name, host and signs in any mix;
if the at alone is spelled, the chain must end like a domain and not start with "www.".

Null text counts as empty; offsets are code points, end exclusive. Rows repeat as they come, other
columns are not read, an empty table gives no rows. Patterns take time in proportion to the text,
so very long texts are searched whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.texts import bound_batches, flat

# Kinds in the order of the digest.
KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: had it failed at the run's start, it would again.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield "email", start, done
        # A local part may not reach back over this sign, so no character is visited twice.
        done = max(done, at + 1)
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    spans = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


# Homoglyphs of ASCII letters in Cyrillic and Greek, in the order of the letters they look like.
_GLYPHS = dict(
    zip(
        "аАВсСеЕНіІјЈКМоОрРѕЅТуХхΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα",
        "aABcCeEHiIjJKMoOpPsSTyXxABEZHIKMNOPTYXoa",
        strict=True,
    )
)
_SIGNS = {"․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " "}
_GLYPHS |= _SIGNS | {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}
_NUMBERS = "zero one two three four five six seven eight nine".split()
_SPELLED = {w: str(k) for k, w in enumerate(_NUMBERS)} | {"oh": "0"}

_GLYPH = re.compile("[" + re.escape("".join(_GLYPHS)) + "]")
_SIGN = re.compile(
    r"\s{0,3}[\[({<]\s{0,2}(at|dot|punkt|punto|point)\s{0,2}[\])}>]\s{0,3}"
    r"|(?<=[A-Za-z0-9])\s{1,3}(at|dot)\s{1,3}(?=[A-Za-z0-9])",
    re.IGNORECASE | re.ASCII,
)
_WORDS = "|".join(_NUMBERS)
_DIGIT_RUN = re.compile(
    rf"(?<![A-Za-z])(?:{_WORDS})(?:[\x20,.-]{{0,3}}(?:{_WORDS}|oh|[0-9](?![0-9]{{4}}))(?![A-Za-z]))+", re.IGNORECASE
)
_DIGIT = re.compile(rf"({_WORDS}|oh)", re.IGNORECASE)
_LOOKS = re.compile(r"[\[({<]\s{0,2}(?:at|dot|punkt|punto|point)\s{0,2}[\])}>]", re.IGNORECASE)
_BARE = re.compile(r"\s(?:at|dot)\s", re.IGNORECASE)
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,2}", r"\s{0,2}[\])}>]\s{0,3}"
_AT = rf"(?:{_OPEN}at{_CLOSE}|\s{{1,3}}at\s{{1,3}}|@)"
_DOT = rf"(?:{_OPEN}(?:dot|punkt|punto|point){_CLOSE}|\s{{1,3}}dot\s{{1,3}}|\.)"
# One sign after another: each is read once, and what stands on its sides is checked after.
_CHAIN_SIGN = re.compile(rf"(?P<at>{_AT})|(?P<dot>{_DOT})", re.IGNORECASE | re.ASCII)
_LOCAL_PART = re.compile(r"[A-Za-z0-9_%+-]{1,64}", re.ASCII)
_TLD = re.compile(r"(?:[a-z]{2,24}|[A-Z]{2,24})(?![A-Za-z0-9])", re.ASCII)
_HOST_PART = re.compile(r"[A-Za-z0-9-]{1,63}", re.ASCII)


def _chains(text: str) -> Iterator[list[tuple[int, int, str]]]:
    """The signs, as (start, end, "@" or "."), of every "name at host dot tld", signs in any mix."""
    signs = [(m.start(), m.end(), "@" if m.group("at") else ".") for m in _CHAIN_SIGN.finditer(text)]
    for k, (start, end, sign) in enumerate(signs):
        if sign != "@":
            continue
        # Bare dots of the local part need no sign of their own, but a part must stand before each.
        first = k
        while first and signs[first - 1][2] == "." and _LOCAL_PART.fullmatch(text, signs[first - 1][1], signs[first][0]):
            first -= 1
        before = max(0, signs[first][0] - 1)
        if not _LOCAL_PART.match(text, before, signs[first][0]):
            first += 1
        if first > k:
            continue
        last, at = k, end
        while last + 1 < len(signs) and signs[last + 1][2] == "." and _HOST_PART.fullmatch(text, at, signs[last + 1][0]):
            last, at = last + 1, signs[last + 1][1]
        if last > k and not _HOST_PART.match(text, at):
            last -= 1
        if last > k:
            yield signs[first : last + 1]


def _is_disguise(text: str, chain: list[tuple[int, int, str]]) -> bool:
    """Whether any sign is spelled out, and not just the at of a site or a time ("at www.example.com")."""
    spelled = [sign for start, end, sign in chain if text[start:end] != sign]
    if spelled != ["@"] or not text[next(s for s, _, sign in chain if sign == "@")].isspace():
        return bool(spelled)
    host = next(end for _, end, sign in chain if sign == "@")
    return bool(_TLD.match(text, chain[-1][1])) and text[host : host + 4].lower() != "www."


def _edits(text: str) -> list[tuple[int, int, str]]:
    """What to rewrite, as (start, end, replacement), left to right, none overlapping."""
    found: list[tuple[int, int, str]] = []
    low = text.lower() if len(text.lower()) == len(text) else text
    if not text.isascii():
        found += [(m.start(), m.end(), _GLYPHS[m.group()]) for m in _GLYPH.finditer(text)]
    if _LOOKS.search(low):
        signs = [m for m in _SIGN.finditer(text) if m.group(1)]
        found += [(m.start(), m.end(), "@" if m.group(1).lower() == "at" else ".") for m in signs]
    if _BARE.search(low):
        # Bare words count only in a whole "name at host dot tld", else every "at" would.
        for chain in _chains(text):
            if _is_disguise(text, chain):
                found += chain
    if sum(low.count(w) for w in _NUMBERS) >= 2:
        for run in _DIGIT_RUN.finditer(text):
            found += [
                (m.start(), m.end(), _SPELLED[m.group().lower()]) for m in _DIGIT.finditer(text, *run.span())
            ]
            # Blanks between digit words go, so that the digits stand together.
            found += [(m.start(), m.end(), "") for m in re.compile(r"[\x20,.-]+").finditer(text, *run.span())]
    edits, done = [], 0
    for start, end, new in sorted(found):
        if start >= done:
            edits.append((start, end, new))
            done = end
    return edits


def find_disguised(text: str) -> list[Span]:
    """Spans, in source characters, of identifiers that show only after rewriting."""
    edits = _edits(text)
    if not edits:
        return []
    out, starts, ends, at = [], [], [], 0
    for start, end, new in [*edits, (len(text), len(text), "")]:
        out.append(text[at:start])
        starts.append(np.arange(at, start))
        ends.append(np.arange(at + 1, start + 1))
        out.append(new)
        starts.append(np.full(len(new), start))
        ends.append(np.full(len(new), end))
        at = end
    first, last = np.concatenate(starts), np.concatenate(ends)
    return [(kind, int(first[s]), int(last[e - 1])) for kind, s, e in find("".join(out))]


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base with the disguised ones, both by start, then kind."""
    base = find(text)
    # Base spans of a kind do not overlap, so both lists rise.
    bounds = {k: ([s for x, s, _ in base if x == k], [e for x, _, e in base if x == k]) for k in KINDS}

    def is_new(kind: str, start: int, end: int) -> bool:
        """Whether it covers nothing of the base, or whole spans of it and more."""
        starts, ends = bounds[kind]
        first, behind = bisect_right(ends, start), bisect_left(starts, end)
        if first == behind:
            return True
        return start <= starts[first] and ends[behind - 1] <= end and end - start > ends[first] - starts[first]

    added = [span for span in find_disguised(text) if is_new(*span)]
    return base, sorted(base + added, key=_order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _worth_reading(texts: pa.Array) -> np.ndarray:
    """Which texts hold an "@", a digit, a non-ASCII byte or a word that can hide one."""
    data, offsets = flat(texts)
    mark = ((data >= 48) & (data <= 57)) | (data == 64)
    counts = np.concatenate([[0], np.cumsum(mark)])
    return counts[offsets[1:]] > counts[offsets[:-1]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = _worth_reading(batch["text"])
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, everything = [], []
        for k, text in enumerate(batch["text"]):
            text = text.as_py() or ""
            base, spans = all_spans(text) if plain[k] else ([], sorted(find_disguised(text), key=_order))
            for kind, into in zip(KINDS, counts, strict=True):
                into.append(sum(s[0] == kind for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            everything.append(joined(spans))
        columns = {f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(KINDS, counts, strict=True)}
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch["doc_id"], **columns}
            | {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(everything, pa.string())}
        )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per document."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return bound_batches(docs).selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        _scan, f"doc_id long, {counts}, base_sha256 string, spans string"
    )
