import duckdb
import pytest
from pyspark.sql import functions as F

from siltstone.llm import decontaminate
from siltstone.llm.queries import ORACLE

ITEM = "A train leaves the old station at 9 and travels 120 km before Anna meets Bert who has 120 km left to walk home today"
AGAIN = ITEM.replace("120", "75").replace("Anna", "Mary").replace(" 9 ", " 11 ")
BROKEN = ITEM.replace("travels 120", "travels 75").replace("Anna", "Mary")


def judged(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r["doc_id"]: r for r in decontaminate.report(docs, bench).collect()}


def test_reparameterised_questions_are_caught(spark):
    pad = "other words stand here in front of it. "
    rows = judged(spark, [ITEM, pad + ITEM, pad + AGAIN + ". " + pad, pad * 5, pad + ITEM[: len(ITEM) // 4], None, "", "x"])
    assert [rows[k]["contaminated"] for k in range(8)] == [True, True, True, False, False, False, False, False]
    assert rows[2]["items"] == "0" and rows[2]["coverage"] > 0.9


def test_slots_must_be_consistent(spark):
    rows = judged(spark, [BROKEN, AGAIN])
    assert not rows[0]["contaminated"] and rows[1]["contaminated"]


def test_words_and_templates(spark):
    frame = spark.createDataFrame([("It cost 1,200.50 EUR, said Mary Ann Smith. Then two left.",)], "text string")
    words = frame.select(decontaminate.words(F.col("text"))).first()[0]
    n, p, u = decontaminate.NUMBER, decontaminate.NAME, decontaminate.UNIT
    assert words == ["it", "cost", n + "1,200.50", u + "eur", "said", p + "mary", p + "ann", p + "smith", "then", "two", "left"]


def test_remove_keeps_columns_and_clean_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "same words in the same order as before"), (None, None), (2, "a b")], "item_id long, text string")
    left = decontaminate.remove(odd, bench)
    assert left.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "None", "None", "2", "3", "6", "7", "8"])
    assert decontaminate.remove(odd, bench.limit(0)).count() == odd.count()
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(odd, bench).filter("contaminated").count() == 3


def test_no_python_on_the_executors(spark, sample):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plan = decontaminate.report(sample, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("texts", [[ITEM, AGAIN, BROKEN, None, "", ITEM + " " + AGAIN]])
def test_sql_agrees_on_templates(spark, texts):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    duck.execute("INSERT INTO benchmark VALUES (0, ?)", [ITEM])
    want = {r[0]: r[1:] for r in duck.execute(ORACLE["op4_decontamination"]).fetchall()}
    rows = judged(spark, texts)
    got = {k: (r["n_items"], r["items"], r["coverage"], True) for k, r in rows.items() if r["contaminated"]}
    assert got == want


def test_exact_words_count_despite_one_inconsistent_slot(spark):
    tail = " and then all of them sat down by the river to eat bread and cheese until the sun went down"
    item = ITEM + tail
    docs = [item.replace("travels 120", "travels 75"), item.lower(), item.replace(" Anna", "\nAnna"), BROKEN]
    rows = judged(spark, docs, [item])
    assert [rows[k]["contaminated"] for k in range(4)] == [True, True, True, False]
    assert rows[0]["coverage"] > 0.8


def test_items_of_many_slots_and_short_items_are_found(spark):
    sums, trip, german = "What is 12 + 45 * 3 - 7?", "60 km in 2 hours", "wo Anna Haus Hof Baum Wald Feld Wiese sieht"
    texts = [
        f"some words before. {sums} and after",
        "some words before. What is 8 + 31 * 2 - 9? and after",
        f"they went {trip} at most",
        german.upper() + " heute",
        "And so: who wrote Hamlet? Nobody knows.",
        "yes they can", "Yes.", "What is 8 + 31?", "what was 8 + 31 * 2 - 9",
        "What is 12 + 45 * 12 - 7?",
    ]
    rows = judged(spark, texts, [sums, trip, german, "Who wrote Hamlet?", "yes"])
    found = [rows[k]["items"] for k in range(len(texts))]
    assert found == ["0", "0", "1", "2", "3", "", "4", "", "", "0"]
    twice = judged(spark, ["What is 8 + 31 * 2 - 9?", "What is 8 + 31 * 8 - 9?"], ["What is 12 + 45 * 12 - 7?"])
    assert [twice[k]["contaminated"] for k in range(2)] == [False, True]


def test_names_at_a_sentence_start_are_slots(spark):
    item = "Tom has 3 apples. Ann gives him 4 more. How many apples does Tom have?"
    again = item.replace("Tom", "Bob").replace("Ann", "Sue").replace("3", "8")
    docs = [again, "Text before. " + again.replace(" ", "\n")]
    home = "Tom runs home to his mother. Then the cat sees the dog. Tom runs home to his father."
    docs += [home.replace("Tom", "Bob"), home.replace("Tom", "Bob", 1).replace("Tom", "Kim")]
    rows = judged(spark, docs, [item, home])
    assert [rows[k]["items"] for k in range(4)] == ["0", "0", "1", ""]
