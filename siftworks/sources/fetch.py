"""Live pages as a table, by a function that gets one. Where pages are already at hand, their table takes its place."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks import rules

#: From a URL to the answer's status and body.
Get = Callable[[str], tuple[int, str]]
ATTEMPT = "domain string, url string, status int, html string, error string, tries int"
#: Bytes that a page's body, and a file's, may have. What is larger is an error, TooLarge, never a beginning that passes for the whole.
MOST, MOST_OF_FILE = 16 << 20, 256 << 20
PIECE = 1 << 16
#: What may pass: these are tried again. Whatever else a site does is final.
PASSING = (ConnectionError, TimeoutError)


class TooLarge(Exception):
    """A body above the limit."""


def body_of(answer, most: int) -> bytes:
    """The whole body, read in pieces and given up at the first byte above the limit; at once where its length was announced."""
    announced = answer.headers.get("Content-Length", "")
    if announced.isdigit() and int(announced) > most:
        raise TooLarge(f"{announced} bytes are announced, {most} may come")
    body = bytearray()
    while piece := answer.read(min(PIECE, most + 1 - len(body))):
        body += piece
        if len(body) > most:
            raise TooLarge(f"more than {most} bytes")
    return bytes(body)


def answer_of(url: str, connect: float, read: float, most: int) -> tuple[int, str, str | None, bytes]:
    """status, content type, character set and body of one GET, redirects included, whatever the site's certificate says. Seconds to
    connect, and to wait for each piece. A body of more than `most` bytes raises TooLarge."""
    import ssl
    from http.client import HTTPConnection, HTTPSConnection
    from urllib.error import HTTPError, URLError
    from urllib.request import HTTPHandler, HTTPSHandler, Request, build_opener

    anyone = ssl.create_default_context()
    anyone.check_hostname, anyone.verify_mode = False, ssl.CERT_NONE

    def slower(kind: type) -> type:
        class Connection(kind):
            def connect(self) -> None:
                super().connect()
                self.sock.settimeout(read)

        return Connection

    class Plain(HTTPHandler):
        def http_open(self, request):
            return self.do_open(slower(HTTPConnection), request)

    class Secure(HTTPSHandler):
        def https_open(self, request):
            return self.do_open(slower(HTTPSConnection), request, context=anyone)

    try:
        with build_opener(Plain, Secure(context=anyone)).open(Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=connect) as answer:
            return answer.status, answer.headers.get_content_type(), answer.headers.get_content_charset(), body_of(answer, most)
    except HTTPError as e:  # an answer as well
        return e.code, "", None, b""
    except URLError as e:
        raise (e.reason if isinstance(e.reason, OSError) else e) from None


def http_get(url: str, connect: float = rules.CONNECT_TIMEOUT, read: float = rules.READ_TIMEOUT, most: int = MOST) -> tuple[int, str]:
    """A page: status and text."""
    status, _, charset, body = answer_of(url, connect, read, most)
    return status, body.decode(charset or "utf-8", "replace")


def http_file(url: str, connect: float = rules.FILE_TIMEOUT, read: float = rules.FILE_TIMEOUT, most: int = MOST_OF_FILE) -> tuple[int, str, bytes]:
    """A file: status, content type and bytes."""
    status, kind, _, body = answer_of(url, connect, read, most)
    return status, kind, body


def page_of(spark: SparkSession, url: str, get: Get = http_get) -> DataFrame:
    """value: the page at the URL, fetched by a task; no row if it isn't answered with status 200. What fails is raised."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [get(x) for x in frame["url"]]
            yield pd.DataFrame({"value": [html for status, html in answers if status == rules.LIVE_STATUS]}, dtype=object)

    return spark.createDataFrame([(url,)], "url string").mapInPandas(run, "value string")


def downloads(links: DataFrame, get: Callable[[str], tuple[int, str, bytes]] = http_file) -> DataFrame:
    """links: dt, href. One row each: dt, path (the link), content, error: HtmlPage where a page came instead of a file, the status
    if it wasn't 200, or the failure's name (TooLarge above the limit of get). A task holds one file at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dt, href in zip(frame["dt"], frame["href"], strict=True):
                content, error = None, None
                try:
                    status, kind, body = get(href)
                    if status != rules.LIVE_STATUS:
                        error = str(status)
                    elif "text/html" in kind.lower():
                        error = "HtmlPage"
                    else:
                        content = body
                except Exception as e:  # whatever a site does, the others go on
                    error = type(e).__name__
                yield pd.DataFrame([(dt, href, content, error)], columns=["dt", "path", "content", "error"])

    return links.select("dt", "href").repartition("href").mapInPandas(run, "dt string, path string, content binary, error string")


def get_patiently(get: Get, url: str, tries: int, sleep: Callable[[float], None]) -> tuple[int | None, str | None, str | None, int]:
    """status, html, the last failure's name, and how many tries it took. The wait grows with each try."""
    for n in range(1, tries + 1):
        try:
            return *get(url), None, n
        except PASSING as e:
            error = type(e).__name__
            if n < tries:
                sleep(rules.BACK_OFF * n)
        except Exception as e:  # whatever a site does, the others go on
            return None, None, type(e).__name__, n
    return None, None, error, tries


def attempts(domains: DataFrame, get: Get = http_get, threads: int = rules.FETCH_THREADS, tries: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """domains: domain. One row per domain, got or not: domain, url, status, html, error (the failure's name), tries.

    A task has as many pages under way, and in memory, as it has threads. Null domains give no row.
    """

    def one(domain: str) -> tuple:
        url = f"http://{domain}"
        return domain, url, *get_patiently(get, url, tries, sleep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                for at in range(0, len(frame), threads):
                    rows = list(pool.map(one, frame["domain"].iloc[at : at + threads]))
                    out = pd.DataFrame(rows, columns=["domain", "url", "status", "html", "error", "tries"])
                    yield out.astype({"status": "Int32"})

    return domains.where("domain is not null").select("domain").mapInPandas(run, ATTEMPT)


def live(tried: DataFrame, *keep: str) -> DataFrame:
    """The pages among the attempts: those that were answered with status 200. keep: other columns to keep."""
    return tried.where(F.col("status") == rules.LIVE_STATUS).select("domain", "url", "html", *keep)
