import hashlib
import random
import re

from siltstone.llm import personal_data


def naive(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        odd, even = d[-1::-2], d[-2::-2]
        if 14 <= len(d) <= 19 and (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(x)))) for x in even)) % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))


def test_base_spans_as_by_plain_patterns():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(["a@b.co", "@", ".", "1", "25", "0", " ", "-", "+1", "(", "é", "x@y", "4111111111111111"]) for _ in range(rng.randint(0, 25)))
        assert personal_data.find(text) == naive(text), text


def test_whole_table(spark, sample):
    rows = {r["doc_id"]: r for r in personal_data.scan(sample).collect()}
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        base = naive(text)
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(personal_data.joined(base).encode()).hexdigest()
        assert rows[doc_id]["n_card"] == sum(k == "card" for k, *_ in base)
        assert {personal_data.joined([s]) for s in base} <= set(rows[doc_id]["spans"].split(","))
    assert sum(r["n_email"] + r["n_ip"] + r["n_phone"] for r in rows.values()) > 50


def test_disguises_map_back_to_the_source():
    cases = {
        "write to jane (at) example [dot] org now": ("email", "jane (at) example [dot] org"),
        "mail jane at example dot org please": ("email", "jane at example dot org"),
        "call +1 five five five one two three four five six seven today": ("phone", "+1 five five five one two three four five six seven"),
        "jаne@exаmple.com": ("email", "jаne@exаmple.com"),
        "host １２７.0.0.1 up": ("ip", "１２７.0.0.1"),
    }
    for text, (kind, piece) in cases.items():
        base, spans = personal_data.all_spans(text)
        start = text.index(piece)
        assert (kind, start, start + len(piece)) in spans, (text, spans)
        assert set(base) <= set(spans)
    assert personal_data.find_disguised("we met at noon and two of one dot came") == []


def test_odd_rows(odd, empty):
    rows = personal_data.scan(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == "" for r in rows if r["doc_id"] != 6)
    assert personal_data.scan(empty).count() == 0


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000, "+1" * 100_000, "1." * 100_000, "@a" * 100_000, "one " * 50_000):
        personal_data.all_spans(text)


def test_disguises_in_any_mix():
    at = ["@", " at ", " (at) ", "[at]", " AT "]
    dot = [".", " dot ", " [dot] ", "(dot)", "\tDot "]
    for a in at:
        for d in dot:
            for e in dot:
                for name in ("john", f"john{e}smith"):
                    piece = f"{name}{a}mail{d}example{e}com"
                    text = f"write to: {piece}, or call"
                    _, spans = personal_data.all_spans(text)
                    assert ("email", 10, 10 + len(piece)) in spans, (piece, spans)


def test_plain_words_are_no_disguise():
    for text in ("we met at noon", "see us at www.example.com", "we met at noon.Then it rained", "he came at 10.30", "a dot at noon", "he arrived at 10.", "at dot at dot"):
        assert personal_data.all_spans(text)[1] == [], text


def test_many_signs_take_linear_time():
    for text in ("a at " * 50_000, "a dot " * 50_000, "a at b dot " * 30_000, " at dot" * 40_000, "a." * 100_000 + " at b dot c"):
        personal_data.all_spans(text)


def test_a_disguise_around_a_base_span_is_whole():
    base, spans = personal_data.all_spans("j\u043ehn@example.com")
    assert base == [("email", 2, 16)] and ("email", 0, 16) in spans


def test_many_addresses_with_one_dash_take_linear_time():
    import time

    text = "write to " + " ".join(f"user{k}@example{k % 7}.com" for k in range(40_000)) + " \u2013 all of them"
    start = time.perf_counter()
    base, spans = personal_data.all_spans(text)
    assert len(base) == len(spans) == 40_000 and time.perf_counter() - start < 2
