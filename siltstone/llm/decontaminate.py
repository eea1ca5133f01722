"""Benchmark decontamination by template windows, in DataFrame operations only.

Numbers, names and units of a text become typed slots that keep their value beside the type. Each
window of ``WINDOW`` words, slots counting by type alone, is hashed and joined with the windows of
the benchmark, so a question asked again with other numbers or names still matches. Matches of a
document and an item are lined up by their distance; a line-up counts only if its slots are
consistent: every value of the item stands for one value in the document. A document is contaminated
by an item if the consistent windows make up ``COVERAGE`` of the item's, or ``RUN`` of them lie on
one line (13 words). Windows whose plain lower-cased words agree are counted apart, out of all windows
of the item, whatever their slots: ``COVERAGE`` of them, or ``RUN`` in a row on a line, count even if the
slots of the line-up are not consistent. Templates in which every capitalised word is a name, those at
a sentence's start and behind any white space too, are lined up in the same way as a third form.

A name is a capitalised word after a lower-case letter, digit or comma and a blank. Windows with more
than ``MAX_SLOTS`` slots are too general for their template and searched by their plain words. Items
all of whose windows are such are searched whole by their template too, if any word is no slot, and
their slots must be consistent. Items with fewer than ``WINDOW`` words are one whole window of plain
words; of one or two words they must be all the words of the document, as they stand in many texts.
The benchmark's windows are broadcast if their measured size allows, else the join
shuffles. Null texts count as empty, null ids are kept, equal rows get equal verdicts, rows with one
id but other texts are judged apart, extra columns pass through ``remove``; an empty table on either
side gives no contamination.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import checkpointed, fits_broadcast

WINDOW = 5
MAX_SLOTS = 2
COVERAGE = 0.75
RUN = 9

# Marks before a slot's value, from the private use area: number, name, unit.
NUMBER, NAME, UNIT = "", "", ""
UNITS = (
    "percent km cm mm miles mile meters metres feet inches kg mg grams pounds tons liters litres ml "
    "hours hour minutes minute seconds days day weeks months years year mph kmh usd eur dollars euros cents"
).split()
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand"
).split()

# Before a capitalised word that is a slot in wide templates alone.
CAPITAL = "\ue003"
_CAPITAL = r"(?<![\p{L}\p{Co}])(\p{Lu}\p{L}*)"
_NAME = r"([\p{Ll}0-9,;] )(\p{Lu}\p{L}*)"
_UNIT = rf"(?i)([0-9]) ?({'|'.join(UNITS)})\b"
_NUMBER = r"([0-9]+([.,][0-9]+)*)"
_WORD = rf"[{NUMBER}{NAME}{UNIT}]?([\p{{L}}]+|[0-9]+([.,][0-9]+)*)"


def _named(text: Column) -> Column:
    units = F.regexp_replace(F.coalesce(text, F.lit("")), _UNIT, f"$1 {UNIT}$2")
    # A second pass marks the names whose blank the first one used up.
    return reduce(lambda t, _: F.regexp_replace(t, _NAME, f"$1{NAME}$2"), range(2), units)


def _words(named: Column, word: str) -> Column:
    marked = F.regexp_replace(F.lower(named), _NUMBER, f"{NUMBER}$1")
    return F.regexp_extract_all(marked, F.lit(word), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, lower-cased, slots with their mark in front."""
    return _words(_named(text), _WORD)


def marked_words(text: Column) -> Column:
    """The same words, the other capitalised ones with the mark ``CAPITAL``."""
    capitals = F.regexp_replace(_named(text), _CAPITAL, f"{CAPITAL}$1")
    return _words(capitals, f"{CAPITAL}?{_WORD}")


def template(word: Column) -> Column:
    """What a word counts as: the mark alone for a slot, the word itself else."""
    mark = F.substring(word, 1, 1)
    return F.when(mark.isin(NUMBER, NAME, UNIT), mark).when(word.isin(NUMBER_WORDS), F.lit(NUMBER)).otherwise(word)


def _narrow(word: Column) -> Column:
    return F.when(F.substring(word, 1, 1) == CAPITAL, F.substring(word, 2, 1 << 30)).otherwise(word)


def narrow(word: Column) -> Column:
    """What a marked word counts as where only names inside a sentence are slots."""
    return template(_narrow(word))


def wide(word: Column) -> Column:
    """What a marked word counts as where every capitalised word is a name."""
    number = _narrow(word).isin(NUMBER_WORDS)
    return F.when((F.substring(word, 1, 1) == CAPITAL) & ~number, F.lit(NAME)).otherwise(narrow(word))


def _is_slot(word: Column) -> Column:
    return template(word).isin(NUMBER, NAME, UNIT)


def windows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``at`` and ``w0`` to ``w4``: every run of ``WINDOW`` marked words of ``text``."""
    listed = rows.select(*keys, marked_words(F.col("text")).alias("words"))
    count = F.size("words") - (WINDOW - 1)
    shifted = [F.slice("words", F.lit(k + 1), F.greatest(count, F.lit(0))).alias(f"w{k}") for k in range(WINDOW)]
    return listed.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w")).select(
        *keys, "at", *[F.col(f"w.w{k}").alias(f"w{k}") for k in range(WINDOW)]
    )


def plain(word: Column) -> Column:
    """The word without its mark."""
    return F.when(F.substring(word, 1, 1).isin(NUMBER, NAME, UNIT, CAPITAL), F.substring(word, 2, 1 << 30)).otherwise(word)


def _window() -> Column:
    return F.array(*[f"w{k}" for k in range(WINDOW)])


def _hash(form: Callable[[Column], Column]) -> Column:
    return F.xxhash64(*[form(F.col(f"w{k}")) for k in range(WINDOW)])


def _few(form: Callable[[Column], Column]) -> Column:
    slots = [form(F.col(f"w{k}")).isin(NUMBER, NAME, UNIT).cast("int") for k in range(WINDOW)]
    return sum(slots, F.lit(0)) <= MAX_SLOTS


# Name of a form of a window, and what a word counts as in it.
FORMS = {"template": narrow, "wide": wide, "exact": plain}


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, template, wide, exact, few, few_wide, item_words, n, n_wide, n_all) of all windows:
    whether one has few enough slots for its template to be searched, how many of the item's have, and
    how many there are.
    """
    rows = windows(benchmark.select("item_id", "text").distinct(), ["item_id"])
    rows = checkpointed(
        rows.select(
            "item_id",
            "at",
            *[_hash(form).alias(name) for name, form in FORMS.items()],
            _few(narrow).alias("few"),
            _few(wide).alias("few_wide"),
            _window().alias("item_words"),
        )
    )
    sizes = rows.groupBy("item_id").agg(
        F.countDistinct(F.when(F.col("few"), F.col("at"))).alias("n"),
        F.countDistinct(F.when(F.col("few_wide"), F.col("at"))).alias("n_wide"),
        F.countDistinct("at").alias("n_all"),
    )
    sizes = sizes.withColumnRenamed("item_id", "i")
    return checkpointed(rows.join(sizes, F.col("item_id").eqNullSafe(F.col("i"))).drop("i"))


PAIR = ["doc_id", "text_hash", "item_id"]


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Joined on keys that may be null; the right side's keys go."""
    other = right.withColumnsRenamed({c: f"r_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys])
    return left.join(other, same, how).drop(*[f"r_{c}" for c in keys])


def _by_template(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, run) by windows with equal templates, slots consistent."""
    line = [*PAIR, "line"]
    values = (
        found.select(*line, F.explode("slots").alias("slot"))
        .groupBy(*line, F.col("slot.item").alias("item"))
        .agg((F.min("slot.doc") != F.max("slot.doc")).alias("twofold"))
    )
    broken = values.filter("twofold").select(*line).distinct()
    kept = _joined(found.drop("slots"), broken, line, "left_anti")
    lines = kept.groupBy(*line).agg(F.countDistinct("item_at").alias("run"))
    longest = lines.groupBy(*PAIR).agg(F.max("run").alias("run"))
    covered = kept.groupBy(*PAIR).agg((F.countDistinct("item_at") / F.first("n")).alias("coverage"))
    both = _joined(covered, longest, PAIR, "inner")
    return both.filter((F.col("coverage") >= COVERAGE) | (F.col("run") >= RUN)).select(*PAIR, "coverage", "run")


def _longest_run(places: Column) -> Column:
    """The most places in a row, of sorted places."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, at: Column) -> Column:
        run = F.when(at == state["last"] + 1, state["run"] + 1).otherwise(F.lit(1))
        return F.struct(at.alias("last"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    return F.aggregate(places, start, step, lambda state: state["best"])


def _by_words(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, run) by windows with equal plain words."""
    lines = found.groupBy(*PAIR, "line").agg(
        F.sort_array(F.collect_set("item_at")).alias("places"), F.first("n_all").alias("n_all")
    )
    pairs = lines.groupBy(*PAIR).agg(
        (F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.first("n_all")).alias("coverage"),
        F.max(_longest_run(F.col("places"))).cast("long").alias("run"),
    )
    return pairs.filter((F.col("coverage") >= COVERAGE) | (F.col("run") >= RUN))


def whole_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_words, size, key) of the items without a window whose template is searched."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("item_words")).distinct()
    rows = rows.withColumn("size", F.size("item_words")).filter("size > 0")
    slots = F.transform("item_words", lambda w: _is_slot(w).cast("int"))
    counts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("size") - (WINDOW - 1), F.lit(1))),
        lambda at: F.aggregate(F.slice(slots, at, F.lit(WINDOW)), F.lit(0), lambda a, b: a + b),
    )
    short = F.col("size") < WINDOW
    dense = ~F.exists(counts, lambda n: n <= MAX_SLOTS) & F.exists("item_words", lambda w: ~_is_slot(w))
    key = F.when(short, _whole_key(F.col("item_words"), plain)).otherwise(_whole_key(F.col("item_words"), template))
    return checkpointed(rows.filter(short | dense).withColumn("key", key))


def _whole_key(listed: Column, form: Callable[[Column], Column]) -> Column:
    return F.xxhash64(F.transform(listed, form))


def _by_whole(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """(doc_id, text_hash, item_id, coverage, run) of the items found in one piece; None without items."""
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    if not sizes:
        return None
    listed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    found = []
    for size in sizes:
        form = plain if size < WINDOW else template
        sought = items.filter(F.col("size") == size).drop("size")
        enough = F.size("words") == size if size < 3 else F.size("words") >= size
        length = F.lit(size)
        starts = F.sequence(F.lit(1), F.size("words") - (size - 1))
        pieces = F.transform(starts, lambda at: F.slice("words", at, length))  # noqa: B023
        found.append(
            listed.filter(enough)
            .select("doc_id", "text_hash", F.explode(pieces).alias("piece"))
            .withColumn("key", _whole_key(F.col("piece"), form))
            .join(F.broadcast(sought) if fits_broadcast(sought) else sought, "key")
            .select(*PAIR, F.arrays_zip(F.col("item_words").alias("item"), F.col("piece").alias("doc")).alias("pairs"))
        )
    rows = reduce(DataFrame.unionByName, found)
    # Consistent: as many distinct pairs as distinct values of the item, among slots.
    slots = F.filter("pairs", lambda pair: _is_slot(pair["item"]))
    values = F.array_distinct(F.transform(slots, lambda pair: pair["item"]))
    equal = F.forall("pairs", lambda pair: plain(pair["item"]) == plain(pair["doc"]))
    kept = rows.filter(equal | (F.size(F.array_distinct(slots)) == F.size(values)))
    return checkpointed(kept.select(*PAIR, F.lit(1.0).alias("coverage"), F.lit(1).cast("long").alias("run")).distinct())


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, run) of every contaminating item of a document.

    Coverage and run are those of the templates where these suffice, else those of the plain words, of
    the wide templates, of the whole item.
    """
    items = benchmark_windows(benchmark)
    whole = _by_whole(docs, whole_items(benchmark))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # A window without slots has one hash in all forms, so it is sought once.
    keys = F.array_distinct(
        F.array(
            F.when(F.col("few"), F.col("template")).otherwise(F.col("exact")),
            F.when(F.col("few_wide"), F.col("wide")).otherwise(F.col("exact")),
            F.col("exact"),
        )
    )
    sought = items.withColumn("key", F.explode(keys)).withColumnsRenamed(
        {"at": "item_at"} | {name: f"item_{name}" for name in FORMS}
    )
    if fits_broadcast(items):
        sought = F.broadcast(sought)
    pairs = F.arrays_zip(F.col("item_words").alias("item"), _window().alias("doc"))

    def slots(form: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
        kept = F.filter(pairs, lambda pair: form(pair["item"]).isin(NUMBER, NAME, UNIT))
        return F.transform(kept, lambda pair: F.struct(value(pair["item"]).alias("item"), value(pair["doc"]).alias("doc")))

    found = (
        windows(keyed, ["doc_id", "text_hash"])
        .withColumns({name: _hash(form) for name, form in FORMS.items()})
        .withColumn("key", F.explode(F.array_distinct(F.array(*FORMS))))
        .join(sought, "key")
        .select(
            *PAIR,
            "n",
            "n_wide",
            "n_all",
            "item_at",
            (F.col("at") - F.col("item_at")).alias("line"),
            (F.col("few") & (F.col("template") == F.col("item_template"))).alias("by_template"),
            (F.col("few_wide") & (F.col("wide") == F.col("item_wide"))).alias("by_wide"),
            (F.col("exact") == F.col("item_exact")).alias("by_words"),
            slots(narrow, _narrow).alias("slots"),
            slots(wide, plain).alias("wide_slots"),
        )
    )
    found = checkpointed(found)
    lined = [*PAIR, "item_at", "line"]
    wider = found.filter("by_wide").select(*lined, F.col("n_wide").alias("n"), F.col("wide_slots").alias("slots"))
    ways = [
        _by_template(found.filter("by_template").select(*lined, "n", "slots")),
        _by_words(found.filter("by_words")),
        _by_template(wider),
    ]
    ranked = reduce(DataFrame.unionByName, [way.withColumn("rank", F.lit(k)) for k, way in enumerate(ways)])
    if whole is not None:
        ranked = ranked.unionByName(whole.withColumn("rank", F.lit(len(ways))))
    best = ranked.groupBy(*PAIR).agg(F.min_by(F.struct("coverage", "run"), "rank").alias("best"))
    return best.select(*PAIR, "best.coverage", "best.run")


def _per_document(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = matches(docs, benchmark).groupBy("doc_id", "text_hash").agg(
        F.concat_ws(",", F.array_sort(F.collect_set(F.col("item_id").cast("string")))).alias("items"),
        F.count("*").alias("n_items"),
        F.max("coverage").alias("coverage"),
    )
    return checkpointed(
        found.withColumnsRenamed({"doc_id": "c_doc_id", "text_hash": "c_hash"}).select(
            "c_doc_id", "c_hash", "items", "n_items", "coverage"
        )
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_items, items, coverage, contaminated) per document."""
    found = _per_document(docs, benchmark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("text_hash") == F.col("c_hash"))
    return rows.join(F.broadcast(found) if fits_broadcast(found) else found, same, "left").select(
        "doc_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
        F.round(F.coalesce("coverage", F.lit(0.0)), 6).alias("coverage"),
        F.col("n_items").isNotNull().alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without the contaminated ones, with their own columns."""
    found = _per_document(docs, benchmark).select("c_doc_id", "c_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").alias("key_id"),
        F.xxhash64("text").alias("key_hash"),
    )
    same = F.col("key_id").eqNullSafe(F.col("c_doc_id")) & (F.col("key_hash") == F.col("c_hash"))
    return rows.join(F.broadcast(found) if fits_broadcast(found) else found, same, "left_anti").select("doc.*")
