"""The release catalog as a Spark data source: a task a page, and a stream that gives each entry once.

    spark.dataSource.register(CatalogSource)
    spark.read.format("release_catalog").option("path", ".../page-{page}.json").load()
    spark.readStream.format("release_catalog").option("path", ...).load()

``path`` holds ``{page}``, a number from 0 on: files that executors see, or http addresses. The batch reader asks for page
0 once to learn how many there are and reads all in parallel; an attempt that fails is made again, ``retries`` times
(default 3), ``wait`` seconds apart (default 1). The stream's offset is the set of ids that it has given; a poll reads pages
from the first on until one has nothing new, since new entries come first: one request where nothing is new. Rows are those
of ``catalog.read_pages``, an entry each, with the page's number; ``catalog.entry_releases`` decodes them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "page int, pos int, id string, title string, release_datetime string, files array<string>"


def fetched(path: str, page: int, retries: int, wait: float) -> dict:
    """A page's document."""
    where = path.replace("{page}", str(page))
    for k in range(retries + 1):
        try:
            if where.startswith(("http://", "https://")):
                from urllib.request import urlopen

                with urlopen(where, timeout=60) as f:
                    return json.loads(f.read())
            with open(where.removeprefix("file://").removeprefix("file:"), "rb") as f:
                return json.loads(f.read())
        except (OSError, ValueError):
            if k == retries:
                raise
            time.sleep(wait)
    raise AssertionError("retries is at least 0")


def entries(page: int, document: dict) -> Iterator[tuple]:
    for pos, e in enumerate(document.get("results") or []):
        yield page, pos, e.get("id"), e.get("title"), e.get("release_datetime"), e.get("files") or []


class _Options:
    def __init__(self, options: dict):
        self.path = options.get("path") or ""
        if "{page}" not in self.path:
            raise ValueError("the option path must hold {page}")
        self.retries, self.wait = int(options.get("retries", 3)), float(options.get("wait", 1))

    def page(self, number: int) -> dict:
        return fetched(self.path, number, self.retries, self.wait)


class CatalogReader(_Options, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        pages = (self.page(0).get("pager") or {}).get("total_pages") or 1
        return [InputPartition(k) for k in range(pages)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from entries(partition.value, self.page(partition.value))


class CatalogStream(_Options, SimpleDataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"ids": []}

    def _new(self, known: set) -> Iterator[tuple]:
        """Entries with other ids, each id once, from the first page on."""
        page, pages, met = 0, 1, set(known)
        while page < pages:
            document = self.page(page)
            pages = (document.get("pager") or {}).get("total_pages") or 1
            found = [e for e in entries(page, document) if e[2] not in met]
            for e in found:
                if e[2] not in met:
                    met.add(e[2])
                    yield e
            if not found:
                return
            page += 1

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = list(self._new(set(start["ids"])))
        return iter(found), {"ids": sorted({*start["ids"], *(e[2] for e in found if e[2] is not None)})}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        wanted = set(end["ids"]) - set(start["ids"])
        return iter([e for e in self._new(set(start["ids"])) if e[2] in wanted])


class CatalogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "release_catalog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CatalogReader:
        return CatalogReader(self.options)

    def simpleStreamReader(self, schema) -> CatalogStream:
        return CatalogStream(self.options)
