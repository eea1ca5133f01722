"""Fetching pages over HTTP from tasks, landed as responses ``(page, status, body)``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sinks.responses import write_responses
from siltstone.sources.pages import FIRST_PAGE, STATUS_OK, has_no_records

RESPONSE_SCHEMA = "page bigint, status int, body string"

Fetch = Callable[[int], tuple[int, str]]


def http_get(url_template: str, timeout: float = 60.0) -> Fetch:
    """A fetch for pages under a URL such as ``https://host/items?per_page=50&page={page}``."""

    def fetch(page: int) -> tuple[int, str]:
        from urllib.error import HTTPError
        from urllib.request import urlopen

        try:
            with urlopen(url_template.format(page=page), timeout=timeout) as response:
                return response.status, response.read().decode("utf-8")
        except HTTPError as error:
            return error.code, ""

    return fetch


def land_responses(
    spark: SparkSession,
    fetch: Fetch,
    path: str,
    pages_per_wave: int = 64,
    tasks: int = 8,
) -> DataFrame:
    """Fetch pages in waves until one is empty or fails; return all responses as landed.

    A wave is one job; its pages are spread over tasks, which keep one response in memory each.
    Pages behind the end are harmless: the ingest ignores them, and it rejects failed ones.
    """

    def fetch_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["page"]:
                status, body = fetch(int(page))
                yield pd.DataFrame({"page": [page], "status": [status], "body": [body]})

    first = FIRST_PAGE
    while True:
        numbers = spark.range(first, first + pages_per_wave, 1, tasks).toDF("page")
        wave = numbers.mapInPandas(fetch_all, RESPONSE_SCHEMA)
        write_responses(wave, path, append=first > FIRST_PAGE)
        landed = spark.read.schema(RESPONSE_SCHEMA).parquet(path)
        last = (F.col("status") != STATUS_OK) | has_no_records(F.col("body"))
        if landed.filter((F.col("page") >= first) & last).take(1):
            return landed
        first += pages_per_wave
