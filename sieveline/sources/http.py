"""Pages by HTTP: of a frontier in a DataFrame, or as a Python data source. Nothing fetches unless it is read."""

from __future__ import annotations

import re
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .arrow import arrow_flat_map

AGENT = "Mozilla/5.0 (compatible; sieveline/1.0)"


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        urls = [u for u in self.options.get("urls", "").split() if u]
        size = int(self.options.get("perTask", 100))
        return [_Urls(urls[i : i + size]) for i in range(0, len(urls), size)] or [_Urls([])]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        attempts, timeout = int(self.options.get("attempts", 3)), float(self.options.get("timeout", 10))
        strict, pause = self.options.get("okRange", "200") == "200", float(self.options.get("pause", 0.5))
        after_any = self.options.get("pauseAfter", "exception") == "any"
        for url in partition.urls:
            yield (url, *fetch(url, attempts, timeout, strict, pause, after_any))


MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
SAID = re.compile(rb"<meta[^>]{0,200}charset\s*=\s*[\"']?\s*([A-Za-z0-9_-]+)|<\?xml[^>]{0,200}encoding\s*=\s*[\"']([A-Za-z0-9_-]+)", re.I)


def decoded(body: bytes, said: str | None = None, sniff: bool = False) -> str:
    """A page's text. By the charset of its header, or UTF-8; where ``sniff``, by what the bytes show: a mark at their start,
    valid UTF-8, the page's own declaration, double bytes that all make Chinese characters, else Western letters."""
    if sniff:
        said = next((name for mark, name in MARKS if body.startswith(mark)), None) or _shown(body)
    try:
        return body.decode(said or "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _shown(body: bytes) -> str:
    declared = next(((a or b).decode("ascii") for a, b in SAID.findall(body[:4096])), None)
    for name in ("utf-8", declared, "gb18030"):
        try:
            text = body.decode(name) if name else ""
        except (LookupError, UnicodeDecodeError):
            continue
        beyond = [c for c in text if ord(c) > 127]
        if name and (name != "gb18030" or beyond and all("\u3000" <= c <= "\u9fff" or "\uff00" <= c <= "\uffef" for c in beyond)):
            return name
    return "cp1252"


def fetched(urls: DataFrame, url: str = "url", attempts: int = 3, timeout: float = 10, strict: bool = True, pause: float = 0.5, after_any: bool = False, between: float = 0.25, tasks_per_host: int = 1) -> DataFrame:
    """``url, status, html`` of a frontier of any length, fetched by the tasks that hold it.

    Addresses of one host go to ``tasks_per_host`` tasks and wait ``between``
    seconds after each, so a host is asked by so many at a time. Nothing is
    fetched before the result is read; write it before using it twice.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#\s]+)", 1))
    spread = urls.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), host.alias("_host"), F.pmod(F.xxhash64(url), F.lit(tasks_per_host)).alias("_turn")).distinct()

    def make():
        def row(u):
            got = fetch(u, attempts, timeout, strict, pause, after_any)
            time.sleep(between)
            yield u, *got

        return row

    return arrow_flat_map(spread.repartition("_host", "_turn").select("url"), make, "url string, status int, html string")


def fetch(url: str, attempts: int = 3, timeout: float = 10, strict: bool = True, pause: float = 0.5, after_any: bool = False) -> tuple[int | None, str | None]:
    """Status and text; only 200 (or any 2xx where not ``strict``) counts. A pause follows an exception, or any failure."""
    import urllib.request

    for _ in range(attempts):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as got:
                if got.status == 200 or not strict and 200 <= got.status < 300:
                    said = got.headers.get_content_charset()
                    return got.status, decoded(got.read(), said, sniff=not strict)
                if after_any:
                    time.sleep(pause)
        except urllib.error.HTTPError:
            if after_any:
                time.sleep(pause)
        except Exception:  # noqa: BLE001 - any failure of the network is one attempt
            time.sleep(pause)
    return None, None


class PageSource(DataSource):
    """``spark.read.format("pages").option("urls", "...")``: url, status, html."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "url string, status int, html string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
