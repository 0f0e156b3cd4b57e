"""A paginated JSON interface as a Spark data source, batch and streaming.

``spark.read.format("paged_json").option("url", ...)`` lists a collection: pages of ``data`` and ``links.next`` (or, for
parallel reads, numbered pages up to ``links.last``). Requests are repeated with growing pauses; rows are the raw JSON of
an object with its id and modified time, so that schemas stay fixed and are applied by ``from_json``.

How a page is fetched is one function of (url, parameters); tests and offline runs put in their own by the option
``fetcher`` ("module:function").
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from civicframe.functions.fixed import UNKNOWN_ORGANIZATION

SCHEMA = "id string, modified string, object string"
Fetch = Callable[[str, dict], dict]
#: Answers that are worth another try.
RETRY = (429, 500, 502, 503, 504)


def http_json(url: str, params: dict) -> dict:
    if params:
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=30) as answer:
        return json.load(answer)


def post_form(url: str, tries: int = 3, pause: float = 1.0, send: Callable[[str, bytes], str] | None = None, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """A function that posts a query as the form field ``data`` and returns the answer's text, with the retries of a page."""

    def http(to: str, body: bytes) -> str:
        with urllib.request.urlopen(urllib.request.Request(to, data=body), timeout=180) as answer:
            return answer.read().decode()

    def post(query: str) -> str:
        body = urllib.parse.urlencode({"data": query}).encode()
        return with_retries(lambda to, _: (send or http)(to, body), url, {}, tries, pause, sleep)

    return post


def fetcher(name: str | None) -> Fetch:
    if not name:
        return http_json
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def with_retries(fetch: Fetch, url: str, params: dict, tries: int = 3, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The answer, or the last error after ``tries`` tries; pauses double."""
    for n in range(tries):
        try:
            return fetch(url, params)
        except Exception as error:
            code = getattr(error, "code", None)
            if n + 1 == tries or code is not None and code not in RETRY:
                raise
            sleep(pause * 2**n)
    raise ValueError("tries must be positive")


def pages(fetch: Fetch, url: str, params: dict | None = None, limit: int | None = None, pause: float = 0.0) -> Iterator[dict]:
    """The pages from ``url`` on. An error ends the listing (what came before stays)."""
    n, ask = 0, dict(params or {})
    while url and (limit is None or n < limit):
        try:
            page = with_retries(fetch, url, ask, pause=pause)
        except Exception:
            return
        yield page
        url, ask, n = (page.get("links") or {}).get("next"), {}, n + 1
        if pause:
            time.sleep(pause)


def objects(fetch: Fetch, url: str, params: dict | None = None, limit: int | None = None) -> Iterator[dict]:
    for page in pages(fetch, url, params, limit):
        yield from page.get("data") or []


def last_page(fetch: Fetch, url: str, params: dict | None = None) -> str | None:
    """The URL of the last page, where the first one tells."""
    return (with_retries(fetch, url, params or {}).get("links") or {}).get("last")


def first_body(fetch: Fetch, system_url: str) -> dict:
    """The first body of a system, whose ``body`` is a list of objects or URLs, or one URL of a list."""
    body = with_retries(fetch, system_url, {}).get("body")
    if isinstance(body, str):
        got = with_retries(fetch, body, {})
        body = got.get("data", [got])
    first = (body or [None])[0]
    return with_retries(fetch, first, {}) if isinstance(first, str) else first or {}


def endpoint(body: dict, *names: str) -> str | None:
    """The first of some keys that the body has (papers have gone by several names)."""
    return next((body[n] for n in names if body.get(n)), None)


def organization_name(fetch: Fetch, url: str | None) -> str:
    """The name, a fixed word for no organization, the URL where it can't be read."""
    if not url:
        return UNKNOWN_ORGANIZATION
    try:
        return with_retries(fetch, url, {}, tries=1).get("name") or url
    except Exception:
        return url


class _Range(InputPartition):
    def __init__(self, url: str, first: int, last: int):
        self.url, self.first, self.last = url, first, last


def _row(o: dict) -> tuple:
    return (o.get("id"), o.get("modified"), json.dumps(o, ensure_ascii=False))


class _Options:
    def __init__(self, options: dict):
        self.url = options["url"]
        self.fetch = fetcher(options.get("fetcher"))
        self.limit = int(options["pagelimit"]) if options.get("pagelimit") else None
        self.params = {k: options[k] for k in ("modified_since", "modified_until") if options.get(k)}
        #: Pages a task reads, where pages have numbers; 0: one after the other.
        self.per_task = int(options.get("pagespertask", 0))

    def wanted(self, o: dict) -> bool:
        """Interfaces may ignore the bounds, so they are applied again; an object without a time is kept."""
        at = o.get("modified")
        return at is None or self.params.get("modified_since", "") <= at and ("modified_until" not in self.params or at < self.params["modified_until"])


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = _Options(self.options)
        if not o.per_task:
            return [_Range(o.url, 0, 0)]
        last = last_page(o.fetch, o.url, o.params)
        n = int(urllib.parse.parse_qs(urllib.parse.urlparse(last or "").query).get("page", ["1"])[0])
        n = min(n, o.limit or n)
        return [_Range(o.url, a, min(a + o.per_task, n + 1)) for a in range(1, n + 1, o.per_task)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        o = _Options(self.options)
        if not partition.first:
            yield from (_row(x) for x in objects(o.fetch, partition.url, o.params, o.limit) if o.wanted(x))
            return
        for page in range(partition.first, partition.last):
            got = with_retries(o.fetch, partition.url, {**o.params, "page": str(page)})
            yield from (_row(x) for x in got.get("data") or [] if o.wanted(x))


class PagedStreamReader(SimpleDataSourceStreamReader):
    """One page a step; the offset is the next page's URL. Stops asking when there is no next page."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {"next": self.options["url"], "page": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        o = _Options(self.options)
        if not start["next"] or o.limit is not None and start["page"] >= o.limit:
            return iter(()), start
        got = with_retries(o.fetch, start["next"], o.params if not start["page"] else {})
        following = (got.get("links") or {}).get("next")
        return iter([_row(x) for x in got.get("data") or [] if o.wanted(x)]), {"next": following, "page": start["page"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = start
        while at["page"] < end["page"]:
            rows, at = self.read(at)
            yield from rows


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))

    def simpleStreamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedJson)
