"""Lists that a server hands out page by page, as a data source of Spark: one partition a page, read by the executors.

The first page tells how many items there are, so the driver fetches it and plans the others; a server that doesn't tell is asked
page by page until one is short.  A page is asked for again, with growing pauses or the pause that the server names, while the server is
busy or fails.  A list that is longer than the server hands out is cut, and its rows say so.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from email.message import Message
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The items of a page and of a whole list at most, the calls after the first, and pauses in seconds.
PAGE_SIZE, MOST_ITEMS = 500, 10_000
RETRIES, PAUSE_BASE, MOST_PAUSE = 6, 1.7, 60.0
SCHEMA = "page int, pos int, item string, total long, complete boolean"


class PageError(RuntimeError):
    """A page that could not be had; status is the server's last answer, or 0 for none."""

    def __init__(self, url: str, status: int, reason: str):
        super().__init__(f"{url}: {status or 'no answer'} {reason}")
        self.status, self.reason = status, reason

    def __reduce__(self):
        return PageError, (self.args[0].partition(": ")[0], self.status, self.reason)


def pause(attempt: int, headers: Message | None, base: float = PAUSE_BASE, most: float = MOST_PAUSE) -> float:
    """Seconds before the next call: as many as the server names in whole numbers, else more with every attempt."""
    named = (headers or {}).get("Retry-After", "")
    return float(named) if str(named).strip().isdigit() else min(most, base**attempt)


def fetch(url: str, headers: dict[str, str], timeout: float, retries: int, sleep: Callable[[float], None] = time.sleep, base: float = PAUSE_BASE) -> object:
    """The JSON at url.  429 and answers from 500 on, no answer and text that is no JSON are tried again; other answers raise at once."""
    for attempt in range(retries + 1):
        told = None
        try:
            with urlopen(Request(url, headers=headers), timeout=timeout) as answer:
                return json.load(answer)
        except HTTPError as e:
            told, error = e.headers, PageError(url, e.code, e.read(200).decode("utf-8", "replace"))
            if e.code != 429 and e.code < 500:
                raise error from None
        except (URLError, TimeoutError, ConnectionError, ValueError) as e:
            error = PageError(url, 0, str(e))
        if attempt < retries:
            sleep(pause(attempt, told, base))
    raise error


def _found(data: object, place: str) -> object:
    """What stands at a place like paging.total; a list that isn't wrapped is its own items."""
    for key in filter(None, place.split(".")):
        data = data.get(key) if isinstance(data, dict) else None
    return data


class Page(InputPartition):
    """One page, with the answer if the driver has it already; following: ask for further pages until one is short."""

    def __init__(self, number: int, answer: str | None = None, total: int | None = None, complete: bool = True, following: bool = False):
        super().__init__(number)
        self.number, self.answer, self.total, self.complete, self.following = number, answer, total, complete, following


class PagedReader(DataSourceReader):
    """Options: url, items (place of the list), total (place of the count), size, most, page_param, size_param, first, timeout, retries, and header.NAME and query.NAME for each of those."""

    def __init__(self, options: dict[str, str]):
        self.url, self.items, self.total = options["url"], options.get("items", ""), options.get("total", "")
        self.size, self.most = int(options.get("size", PAGE_SIZE)), int(options.get("most", MOST_ITEMS))
        self.names = options.get("page_param", "p"), options.get("size_param", "ps")
        self.first, self.timeout, self.retries = int(options.get("first", 1)), float(options.get("timeout", 30)), int(options.get("retries", RETRIES))
        self.base = float(options.get("pause", PAUSE_BASE))
        self.headers = {k[7:]: v for k, v in options.items() if k.startswith("header.")}
        self.query = {k[6:]: v for k, v in options.items() if k.startswith("query.")}

    def _page(self, number: int) -> object:
        query = urlencode({**self.query, self.names[0]: number, self.names[1]: self.size})
        return fetch(f"{self.url}{'&' if '?' in self.url else '?'}{query}", self.headers, self.timeout, self.retries, base=self.base)

    def _list(self, data: object) -> list:
        found = _found(data, self.items)
        return found if isinstance(found, list) else []

    def partitions(self) -> list[Page]:
        try:
            data = self._page(self.first)
        except PageError as e:
            if e.status == 404:  # a list of nothing
                return [Page(self.first, "[]", 0)]
            raise
        total = _found(data, self.total) if self.total else None
        answer = json.dumps(data)
        if not isinstance(total, int):
            return [Page(self.first, answer, following=True)]
        pages = -(-min(total, self.most) // self.size)
        complete = total <= self.most
        return [Page(self.first, answer, total, complete)] + [Page(self.first + k, None, total, complete) for k in range(1, pages)]

    def read(self, partition: Page) -> Iterator[tuple]:
        data = json.loads(partition.answer) if partition.answer is not None else self._page(partition.number)
        number, seen, found = partition.number, 0, self._list(data)
        while True:
            more = partition.following and len(found) == self.size
            seen += len(found)
            over = more and seen >= self.most
            for pos, item in enumerate(found):
                yield number, pos, json.dumps(item), partition.total, partition.complete and not over
            if not more or over:
                return
            number += 1
            found = self._list(self._page(number))


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> PagedReader:
        return PagedReader(dict(self.options))


def read_paged(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """(page, pos, item, total, complete) of a list at url; item is the JSON of one entry, complete is false where the server's limit cut the list.

    In a list whose length the server doesn't tell, only the rows of the last page before the limit say that it was cut.
    """
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_json").options(url=url, **options).load()


def read_issue_search(spark: SparkSession, host: str, project: str, organization: str = "", token: str = "", **options: str) -> DataFrame:
    """Issues of a project from an issue search of pages of 500, of which the server hands out 10,000 at most."""
    wanted = {"query.components": project, "query.componentKeys": project, "query.organization": organization, "items": "issues", "total": "total"}
    secret = {"header.Authorization": f"Bearer {token}"} if token else {}
    return read_paged(spark, f"{host.rstrip('/')}/api/issues/search", **{**wanted, **secret, **options})
