"""Searches of a remote service by keys: tasks take the keys of a table and ask for batches of them.

Keys are distinct, dealt to ``tasks`` tasks, and never pass through the driver.  An answer that is as long
as the service's limit is not trusted to be whole: rows are asked for page by page until one is not full;
summaries, which have no pages, are asked for again for each half of the keys.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .exchange import service

FAMILIES, PUBLICATIONS, PEOPLE, LIMIT = 500, 200, 200, 1000


def key_query(source: str, field: str, keys: list, returns: str, year: str | None = None, years: tuple[int, int] | None = None) -> str:
    """The service's query for some keys, which it takes as a JSON list."""
    span = f" and {year} in [{years[0]}:{years[1]}]" if year and years else ""
    return f"search {source} where {field} in {json.dumps(keys, ensure_ascii=False)}{span} return {returns}"


def pages(fetch: Callable, query: str, limit: int) -> Iterator[dict]:
    skip = 0
    while True:
        rows = list(fetch(query, skip, limit))
        yield from rows
        if len(rows) < limit:
            return
        skip += limit


def halves(fetch: Callable, query: Callable[[list], str], keys: list, limit: int) -> Iterator[dict]:
    rows = list(fetch(query(keys), 0, limit))
    if len(rows) < limit:
        yield from rows
    elif len(keys) == 1:
        raise ValueError(f"the summary of {keys[0]!r} alone reaches the limit of {limit} rows")
    else:
        for part in (keys[: len(keys) // 2], keys[len(keys) // 2 :]):
            yield from halves(fetch, query, part, limit)


def ask(keys: DataFrame, key: str, client: str, schema: T.StructType, query: Callable[[list], str], batch: int, limit: int = LIMIT, summary: bool = False, tasks: int = 8) -> DataFrame:
    """Rows of ``schema`` for all keys; ``client`` is ``module:function``, which gives (query, skip, limit) -> list of dicts."""
    arrow = to_arrow_schema(schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch, held = service(client), []

        def answer(part: list) -> pa.RecordBatch:
            rows = halves(fetch, query, part, limit) if summary else pages(fetch, query(part), limit)
            return pa.RecordBatch.from_pylist([{n: r.get(n) for n in arrow.names} for r in rows], schema=arrow)

        for records in it:
            held += records.column(0).to_pylist()
            while len(held) >= batch:
                yield answer(held[:batch])
                held = held[batch:]
        if held:
            yield answer(held)

    return keys.select(F.col(key).alias("key")).where("key is not null").distinct().repartition(tasks, "key").mapInArrow(run, schema)


def members_of(families: DataFrame, client: str, schema: T.StructType, years: tuple[int, int], returns: str = "patents", key: str = "family_id", **more) -> DataFrame:
    """All members of the families in the span of years, 500 families a request."""
    return ask(families, key, client, schema, lambda part: key_query("patents", key, part, returns, "publication_year", years), more.pop("batch", FAMILIES), **more)


def researchers_of(publications: DataFrame, client: str, key: str = "id", **more) -> DataFrame:
    """id, first_name, last_name, count of the publications' researchers, 200 publications a request; counts of requests are summed."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "first_name", "last_name")] + [T.StructField("count", T.LongType())])
    rows = ask(publications, key, client, schema, lambda part: key_query("publications", "id", part, "researchers limit 1000"), more.pop("batch", PUBLICATIONS), summary=True, **more)
    return rows.groupBy("id", "first_name", "last_name").agg(F.sum("count").alias("count"))


def publications_of(people: DataFrame, client: str, schema: T.StructType, years: tuple[int, int], returns: str = "publications", key: str = "id", **more) -> DataFrame:
    """Publications of the people in the span of years, each once though several of them are its authors."""
    rows = ask(people, key, client, schema, lambda part: key_query("publications", "researchers.id", part, returns, "year", years), more.pop("batch", PEOPLE), **more)
    return rows.dropDuplicates(["id"])
