"""Remote listings as a Spark data source: pages until one is empty, or the latest month that has rows, fetched with care for each host.

    spark.dataSource.register(Listing)
    spark.read.format("listing").option("listings", json).option("fetcher", "package.module:make").load()

A partition is one listing, so a host is asked by one task only, in order and with pauses; listings run side by side, and nothing is fetched before an action asks for it.
How bytes come is left to the fetcher, an object with fetch(url) -> (status, bytes), made once per task from option `fetcher` (and `argument`); tests use files.

Rows: listing, key (page number or month), url, status, content, error. Status is ok, empty (a page without rows), missing, failed or blocked. The loop over pages ends after
an empty or missing page, one without a link to the next, or `most` pages; the loop over months ends at the first month with rows, after `most` months back, or at a host that fails. A host
that cannot be reached leaves a row that says so; it never ends the other listings.
"""

from __future__ import annotations

import datetime
import importlib
import json
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "listing string, key string, url string, status string, content binary, error string"
#: Answers that no retry changes, and the longest pause between two tries, in seconds.
FINAL = (400, 401, 403, 404, 410)
LONGEST_PAUSE, COOLDOWN = 20, 600
MOST_PAGES, MOST_MONTHS = 10, 6  # fixed values


class FetchFailed(Exception):
    """kind: missing (the host answers that there is nothing), failed, blocked (the host wants no more requests) or large."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


class Polite:
    """Fetches with retries, a pause between requests to a host, a rest for a host that blocks, a bound on size, and each address once."""

    def __init__(self, fetch: Callable[[str], tuple[int, bytes]], tries: int = 4, pause: float = 1.0, cooldown: float = COOLDOWN, most_bytes: int = 200 << 20, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.fetch, self.tries, self.pause, self.cooldown, self.most_bytes, self.clock, self.sleep = fetch, tries, pause, cooldown, most_bytes, clock, sleep
        self.asked: dict[str, float] = {}
        self.resting: dict[str, float] = {}
        self.kept: dict[str, bytes] = {}

    def get(self, url: str) -> bytes:
        if url in self.kept:
            return self.kept[url]
        host, why = urlparse(url).netloc, "no try"
        for n in range(self.tries):
            if self.resting.get(host, 0) > self.clock():
                raise FetchFailed("blocked", f"{host} rests")
            self.sleep(max(0.0, self.asked.get(host, -1e18) + self.pause - self.clock()))
            self.asked[host] = self.clock()
            try:
                status, content = self.fetch(url)
            except OSError as e:
                status, content, why = 0, b"", f"{type(e).__name__}: {e}"
            if status == 200:
                if len(content) > self.most_bytes:
                    raise FetchFailed("large", f"more than {self.most_bytes} bytes")
                self.kept[url] = content
                return content
            why = f"HTTP {status}" if status else why
            if status == 429:
                self.resting[host] = self.clock() + self.cooldown
                raise FetchFailed("blocked", why)
            if status in FINAL:
                raise FetchFailed("missing" if status in (404, 410) else "failed", why)
            if n + 1 < self.tries:
                self.sleep(min(2 ** (n + 1), LONGEST_PAUSE))
        raise FetchFailed("failed", why)


class Files:
    """Fetcher of a folder: an address is the file of its quoted form; others are missing, and hosts named in `down` cannot be reached."""

    def __init__(self, folder: str, down: tuple[str, ...] = ()):
        self.folder, self.down = folder, down

    def fetch(self, url: str) -> tuple[int, bytes]:
        if urlparse(url).netloc in self.down:
            raise ConnectionError("unreachable")
        try:
            with open(f"{self.folder}/{quote(url, safe='')}", "rb") as f:
                return 200, f.read()
        except FileNotFoundError:
            return 404, b""


def files(argument: str) -> Files:
    """Fetcher option of tests: {"folder": ..., "down": [...]}."""
    given = json.loads(argument)
    return Files(given["folder"], tuple(given.get("down", ())))


def months(last: str, n: int) -> list[str]:
    """The month yyyy-MM and n - 1 before it, newest first."""
    year, month = map(int, last.split("-"))
    at = year * 12 + month - 1
    return [f"{(at - k) // 12:04d}-{(at - k) % 12 + 1:02d}" for k in range(n)]


def walked(listing: dict, get: Callable[[str], bytes]) -> Iterator[tuple]:
    """Rows of one listing: name, url (with {page} or {month}), rows and next (patterns of a row and of a link on), and most, first or last."""
    by_month = "{month}" in listing["url"]
    most = listing.get("most", MOST_MONTHS if by_month else MOST_PAGES)
    today = datetime.date.today().strftime("%Y-%m")
    keys = months(listing.get("last", today), most) if by_month else [str(k) for k in range(listing.get("first", 0), listing.get("first", 0) + most)]
    for key in keys:
        url = listing["url"].replace("{month}", key).replace("{page}", key)
        try:
            content = get(url)
        except FetchFailed as e:
            yield listing["name"], key, url, "missing" if e.kind == "missing" else "blocked" if e.kind == "blocked" else "failed", None, str(e)
            if by_month and e.kind in ("missing", "large"):
                continue
            return
        text = content.decode("utf-8", "replace")
        some = re.search(listing["rows"], text) is not None if listing.get("rows") else bool(content)
        yield listing["name"], key, url, "ok" if some else "empty", content, None
        more = not some if by_month else some and (not listing.get("next") or re.search(listing["next"], text) is not None)
        if not more:
            return


class _Part(InputPartition):
    def __init__(self, listing: dict):
        self.listing = listing


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[_Part]:
        return [_Part(x) for x in json.loads(self.options["listings"])]

    def read(self, part: _Part) -> Iterator[tuple]:
        module, _, name = self.options["fetcher"].partition(":")
        source = getattr(importlib.import_module(module), name)(self.options.get("argument", ""))
        polite = Polite(source.fetch, tries=int(self.options.get("tries", 4)), pause=float(self.options.get("pause", 1.0)))
        yield from walked(part.listing, polite.get)


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def read_listings(spark: SparkSession, listings: list[dict], fetcher: str, argument: str = "", **options) -> DataFrame:
    """Rows of all listings; nothing is fetched until an action runs."""
    spark.dataSource.register(Listing)
    reader = spark.read.format("listing").option("listings", json.dumps(listings)).option("fetcher", fetcher).option("argument", argument)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def latest_month(rows: DataFrame) -> DataFrame:
    """(listing, key, content): the month with rows of each listing by month."""
    return rows.filter("status = 'ok'").groupBy("listing").agg(F.max_by(F.struct("key", "content"), "key").alias("m")).select("listing", "m.*")


def items(rows: DataFrame, pattern: str) -> DataFrame:
    """(listing, key, pos, item): what a pattern's first group finds on the pages, in order."""
    pages = rows.filter("status = 'ok'").select("listing", "key", F.decode("content", "UTF-8").alias("_t"))
    return pages.select("listing", "key", F.posexplode(F.regexp_extract_all("_t", F.lit(pattern), F.lit(1))).alias("pos", "item"))
