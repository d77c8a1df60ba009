"""Search connectors and batch clients: the offline forms, and the interfaces of live ones.

A live search is a Python data source that fetches pages on the executors; the offline form answers
the same questions from a table, with predicates that reach the scan.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.curate import first_of_each, seen
from ..operators.search import has_code, in_years, matches
from .exchange import service


def by_phrases(corpus: DataFrame, queries: list[str], columns: tuple[str, ...], year: str, first: int, last: int) -> DataFrame:
    """Rows that match any of the queries; one pass, whatever the number of queries."""
    hit = F.lit(False)
    for q in queries:
        hit = hit | matches(q, *columns)
    return corpus.where(in_years(year, first, last) & hit)


def by_codes(corpus: DataFrame, codes: list[str], column: str, year: str, first: int, last: int) -> DataFrame:
    return corpus.where(in_years(year, first, last) & has_code(column, codes))


def by_keys(corpus: DataFrame, keys: DataFrame, key: str, year: str, first: int, last: int) -> DataFrame:
    """Rows of the given keys: a semi join, where a remote service would take batches."""
    return seen(corpus.where(in_years(year, first, last) & F.col(key).isNotNull()), keys, key)


def researcher_counts(publications: DataFrame, ids: DataFrame, researchers: str = "researchers") -> DataFrame:
    """id, first_name, last_name and the number of the given publications of each researcher, exactly."""
    rows = seen(publications, ids).select(F.explode(researchers).alias("r")).select("r.id", "r.first_name", "r.last_name")
    return rows.where("id is not null and first_name is not null and last_name is not null").groupBy("id", "first_name", "last_name").agg(F.count("*").alias("count"))


def by_researchers(publications: DataFrame, people: DataFrame, year: str, first: int, last: int, researchers: str = "researchers", id_col: str = "id") -> DataFrame:
    """Publications with one of the people among their researchers, each once."""
    rows = publications.where(in_years(year, first, last))
    hits = rows.select(id_col, F.explode(F.col(f"{researchers}.id")).alias("__who")).join(people.select(F.col("id").alias("__who")), "__who", "left_semi").select(id_col).distinct()
    return rows.join(hits, id_col, "left_semi")


def union_results(*frames: DataFrame, id_col: str = "id") -> DataFrame:
    """All results, of each id the first by the order of queries."""
    out = None
    for n, f in enumerate(frames):
        f = f.withColumn("__query", F.lit(n))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    rest = [F.asc_nulls_last(F.xxhash64(*[F.col(c).cast("string") for c in out.columns if c not in ("__query",)]))]
    return first_of_each(out, [id_col], [F.asc("__query"), *rest]).drop("__query")


class PagedSearch(DataSource):
    """``spark.read.format("paged_search")``: a search service asked page by page on executors.

    Options: ``client`` (module:function that gives a callable (query, skip, limit) -> list of dicts),
    ``query``, ``limit``, and ``pages``, how many are asked for side by side; the last goes on until a page is not
    full, so no row is lost whatever their number.  The schema is given with ``.schema``.  With the option ``year`` (a
    column of whole numbers) comparisons with it are sent along as a span of years, where
    ``spark.sql.python.filterPushdown.enabled`` is set.  Spark keeps the reader that took a filter with the loaded frame, so
    with that option load a frame for each span; without it a frame can be filtered again and again.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def reader(self, schema) -> DataSourceReader:
        # Spark refuses a reader that takes filters where that is not switched on
        return (SpanReader if "year" in self.options else PagedReader)(self.options, schema)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.options, self.names, self.span = dict(options), schema.fieldNames(), None

    def query(self) -> str:
        where = f" where {self.options['year']} in [{self.span[0]}:{self.span[1]}]" if self.span else ""
        return self.options.get("query", "") + where

    def partitions(self) -> list[InputPartition]:
        if self.span and self.span[0] > self.span[1]:
            return [InputPartition(None)]  # nothing is asked for
        return [InputPartition(n) for n in range(max(int(self.options.get("pages", 1)), 1))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        fetch = service(self.options["client"])
        limit = int(self.options.get("limit", 1000))
        last, page = max(int(self.options.get("pages", 1)), 1) - 1, partition.value
        while True:
            rows = list(fetch(self.query(), page * limit, limit))
            yield from (tuple(row.get(n) for n in self.names) for row in rows)
            if partition.value < last or len(rows) < limit:
                return
            page += 1


class SpanReader(PagedReader):
    """Takes comparisons with the year along."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keep what bounds the year; Spark goes on to check the rest."""
        for f in filters:
            if not self._bounds(f):
                yield f

    def _bounds(self, f: Filter) -> bool:
        if getattr(f, "attribute", None) != (self.options["year"],):
            return False
        first, last = self.span or (0, 9999)
        if isinstance(f, EqualTo):
            self.span = (max(first, f.value), min(last, f.value))
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.span = (max(first, f.value + isinstance(f, GreaterThan)), last)
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            self.span = (first, min(last, f.value - isinstance(f, LessThan)))
        else:
            return False
        return True


class BatchClient(Protocol):
    """What a service for batches of model requests has to offer."""

    def submit(self, requests: DataFrame) -> str: ...

    def state(self, batch: str) -> str: ...

    def results(self, spark: SparkSession, batch: str) -> DataFrame: ...


def wait(client: BatchClient, batch: str, seconds: float = 600, sleep=time.sleep) -> None:
    """Poll until the batch has ended."""
    while client.state(batch) != "ended":
        sleep(seconds)
