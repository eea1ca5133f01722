"""The operators over whole tables, one query each; SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import (
    decontaminate,
    hard_negatives,
    language_id,
    mixing,
    near_duplicates,
    neighbours,
    personal_data,
    phrases,
    quality,
    repeats,
    secret_scan,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(_table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents found contaminated, with their items; all others are clean."""
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.filter("contaminated")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(_table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, 20)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scan(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), lambda vec_id: vec_id % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_repeats": op2_repeats,
    "op3_secrets": op3_secrets,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_neighbours": op6_neighbours,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_personal_data": op8_personal_data,
    "op9_language": op9_language,
    "op10_url_filter": op10_url_filter,
    "op11_warc": op11_warc,
    "op12_phrases": op12_phrases,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}


def _words_sql(table: str, key: str) -> str:
    d = decontaminate
    named = f"regexp_replace(coalesce(text, ''), '{d._UNIT}', '\\1 {d.UNIT}\\2', 'g')"
    for _ in range(2):
        named = f"regexp_replace({named}, '{d._NAME}', '\\1{d.NAME}\\2', 'g')"
    marked = f"regexp_replace(lower({named}), '{d._NUMBER}', '{d.NUMBER}\\1', 'g')"
    return f"SELECT {key}, text, regexp_extract_all({marked}, '{d._WORD}') AS words FROM {table}"


def _template_sql(words: str) -> str:
    d = decontaminate
    marks = f"('{d.NUMBER}', '{d.NAME}', '{d.UNIT}')"
    numbers = ", ".join(f"'{w}'" for w in d.NUMBER_WORDS)
    return (
        f"list_transform({words}, lambda w: CASE WHEN w[1] IN {marks} THEN w[1] "
        f"WHEN w IN ({numbers}) THEN '{d.NUMBER}' ELSE w END)"
    )


_D = decontaminate
_SPAN = _D.WINDOW - 1
_SLOT = f"('{_D.NUMBER}', '{_D.NAME}', '{_D.UNIT}')"

ORACLE: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS ({_words_sql("documents", "doc_id")}),
b AS ({_words_sql("(SELECT DISTINCT item_id, text FROM benchmark)", "item_id")}),
dw AS (SELECT doc_id, text, pos, words[pos:pos + {_SPAN}] AS w
  FROM d, unnest(range(1, len(words) - {_SPAN - 1})) AS t(pos)),
bw AS (SELECT item_id, spot, words[spot:spot + {_SPAN}] AS w
  FROM b, unnest(range(1, len(words) - {_SPAN - 1})) AS t(spot)),
dt AS (SELECT *, {_template_sql("w")} AS template FROM dw),
bt AS (SELECT *, {_template_sql("w")} AS template FROM bw),
bs AS (SELECT * FROM bt WHERE len(list_filter(template, lambda x: x IN {_SLOT})) <= {_D.MAX_SLOTS}),
bn AS (SELECT item_id, count(DISTINCT spot) AS n FROM bs GROUP BY item_id),
m AS (SELECT dt.doc_id, dt.text, bs.item_id, spot, pos - spot AS line, bs.w AS bw, dt.w AS dw, bs.template AS template
  FROM dt JOIN bs ON dt.template = bs.template),
slots AS (SELECT doc_id, text, item_id, line, bw[k] AS item_word, dw[k] AS doc_word
  FROM m, unnest(range(1, {_D.WINDOW + 1})) AS t(k) WHERE template[k] IN {_SLOT}),
broken AS (SELECT DISTINCT doc_id, text, item_id, line FROM (
  SELECT doc_id, text, item_id, line, item_word FROM slots GROUP BY ALL HAVING count(DISTINCT doc_word) > 1)),
kept AS (SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM broken x WHERE x.doc_id IS NOT DISTINCT FROM m.doc_id
  AND x.text = m.text AND x.item_id IS NOT DISTINCT FROM m.item_id AND x.line = m.line)),
runs AS (SELECT doc_id, text, item_id, max(run) AS run FROM (
  SELECT doc_id, text, item_id, line, count(DISTINCT spot) AS run FROM kept GROUP BY ALL) GROUP BY ALL),
covered AS (SELECT k.doc_id, k.text, k.item_id, count(DISTINCT k.spot) / first(bn.n) AS coverage
  FROM kept k JOIN bn ON bn.item_id IS NOT DISTINCT FROM k.item_id GROUP BY ALL),
hits AS (SELECT c.doc_id, c.text, c.item_id, c.coverage FROM covered c JOIN runs r
  ON c.doc_id IS NOT DISTINCT FROM r.doc_id AND c.text = r.text AND c.item_id IS NOT DISTINCT FROM r.item_id
  WHERE c.coverage >= {_D.COVERAGE} OR r.run >= {_D.RUN}),
per AS (SELECT doc_id, text, count(*) AS n_items, max(coverage) AS coverage,
  array_to_string(list_sort(list(item_id::VARCHAR)), ',') AS items FROM hits GROUP BY ALL)
SELECT documents.doc_id, n_items, items, round(coverage, 6)::DOUBLE AS coverage, true AS contaminated
FROM documents JOIN per ON per.doc_id IS NOT DISTINCT FROM documents.doc_id AND per.text = documents.text
""",
    "op5_mixing": """
WITH sized AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS cap FROM sums),
stepped AS (SELECT *,
    (SELECT sum(source_size) FROM weighed) - coalesce(sum(cap) OVER before, 0) AS share,
    sum(weight) OVER rest AS weights
  FROM weighed WINDOW
    before AS (ORDER BY 6 * cap // weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY 6 * cap // weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
open AS (SELECT share, weights FROM stepped WHERE cap * weights > weight * share
  ORDER BY 6 * cap // weight, place LIMIT 1),
plan AS (SELECT source, source_size, CASE WHEN share IS NULL OR cap * weights <= weight * share THEN cap::DOUBLE
    ELSE (weight * share)::DOUBLE / weights::DOUBLE END AS target
  FROM weighed LEFT JOIN open ON true),
rated AS (SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(sized.source, 'null') || ':'
      || text_key), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS drawn
  FROM sized JOIN plan ON plan.source IS NOT DISTINCT FROM sized.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies
FROM (SELECT *, floor(rate)::BIGINT + (drawn < rate - floor(rate))::BIGINT AS copies FROM rated)
""",
    "op11_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
g AS (SELECT payload, max(page_id) AS kept, sha1(payload) AS hexadecimal FROM p GROUP BY payload),
d AS (SELECT payload, kept, array_to_string(list_transform(range(32), lambda k: substr('{warc.BASE32}',
  1 + (('0x' || substr(hexadecimal, 5 * (k // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) % 32, 1)), '')
  AS digest FROM g)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM p JOIN d USING (payload)
""",
    "op12_phrases": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM documents,
  unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS t(piece)),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM p, unnest(range(1, 5)) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(i)),
words AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, k, (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(2, m)) AS s FROM f WHERE m > 2), unnest(range(1, m - s + 2)) AS t(i) GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN longer o ON o.lang = worst.lang AND o.phrase = worst.phrase
  WHERE o.f IS NULL OR 100 * o.f < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN words USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
    list_dot_product(a.x, o.x)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10
""",
}
