"""Remote sources: Atom feeds and WebDAV folders. An opener does the requests, on the executors; tests bring their own."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.session import ship
from meridian.sources.readers import kind_of

#: (method, url) -> (status, body).
Opener = Callable[[str, str], tuple[int, bytes]]
ATOM = "{http://www.w3.org/2005/Atom}"
DAV = "{DAV:}"


def opener(headers: dict[str, str] | None = None, timeout: float = 30.0) -> Opener:
    """Requests with the given headers, such as an authorisation; a listing goes one level deep."""

    def request(method: str, url: str) -> tuple[int, bytes]:
        asked = urllib.request.Request(url, method=method, headers={**(headers or {}), **({"Depth": "1"} if method == "PROPFIND" else {})})
        try:
            with urllib.request.urlopen(asked, timeout=timeout) as got:
                return got.status, got.read()
        except urllib.error.HTTPError as error:
            return error.code, b""

    return request


def fetched(urls: DataFrame, request: Opener, method: str = "GET", tries: int = 4, wait: float = 5.0) -> DataFrame:
    """(url, ...) -> (url, status, body, error): a request a row, repeated on status 429 after a growing wait.

    Failures are rows: the status, or the error where there was no answer.
    """

    def ask(url: str) -> tuple[int | None, bytes | None, str | None]:
        status: int | None = None
        for n in range(tries):
            try:
                status, body = request(method, url)
            except Exception as error:  # whatever the opener raises is this row's outcome
                return None, None, f"{type(error).__name__}: {error}"
            if status != 429:
                return status, body, None
            time.sleep(wait * (n + 1))
        return status, None, "too many requests"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                status, body, error = ask(url)
                yield pa.RecordBatch.from_arrays([pa.array([url]), pa.array([status], pa.int32()), pa.array([body], pa.binary()), pa.array([error], pa.string())], ["url", "status", "body", "error"])

    ship(urls.sparkSession)
    return urls.select(F.col("url").cast("string")).where("url IS NOT NULL").mapInArrow(run, "url string, status int, body binary, error string")


def _root(body: bytes | None) -> ElementTree.Element | None:
    if not body or b"<!DOCTYPE" in body[:4096]:  # documents that declare entities are not read
        return None
    try:
        return ElementTree.fromstring(body)
    except ElementTree.ParseError:
        return None


ENTRY = "id string, title string, summary string, authors array<string>, published string, url string"


def atom_entries(pages: DataFrame) -> DataFrame:
    """(body, ...) -> a row an entry of the feeds: id (the last part of its address), title, summary, authors, published, url.

    Pages that are no feed give no rows, nor do entries without an id.
    """
    names = [x.split()[0] for x in ENTRY.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]

    def text(x: ElementTree.Element, tag: str) -> str:
        return " ".join((x.findtext(f"{ATOM}{tag}") or "").split("\n")).strip()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(0).to_pylist():
                root = _root(body)
                for x in [] if root is None else root.iter(f"{ATOM}entry"):
                    url = text(x, "id")
                    people = [(a.findtext(f"{ATOM}name") or "").strip() for a in x.findall(f"{ATOM}author")]
                    if url:
                        rows.append((url.rsplit("/", 1)[-1], text(x, "title"), text(x, "summary"), people, text(x, "published"), url))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return pages.select("body").mapInArrow(run, ENTRY)


def arxiv(spark: SparkSession, queries: list[str], most: int = 10, request: Opener | None = None, wait: float = 5.0) -> DataFrame:
    """The latest papers of each query. Fixed value: the address of the public query interface."""
    form = lambda q: urllib.parse.urlencode({"search_query": f"all:{q}", "max_results": most, "sortBy": "submittedDate", "sortOrder": "descending"})
    urls = spark.createDataFrame([(f"https://export.arxiv.org/api/query?{form(q)}",) for q in queries], "url string").coalesce(1)  # one request at a time
    return atom_entries(fetched(urls, request or opener(), wait=wait)).withColumnsRenamed({"id": "arxiv_id", "summary": "abstract"})


def _listed(pages: DataFrame, server: str) -> DataFrame:
    """Answers to PROPFIND -> (url, folder, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for status, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = _root(body) if status in (200, 207) else None
                for x in [] if root is None else root.iter(f"{DAV}response"):
                    href, size = x.findtext(f"{DAV}href"), next((v.text for v in x.iter(f"{DAV}getcontentlength")), None)
                    if href:
                        rows.append((server + href if href.startswith("/") else href, any(True for _ in x.iter(f"{DAV}collection")), int(size) if (size or "").isdigit() else 0))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.bool_(), pa.int64()))], ["url", "folder", "size"])

    return pages.select("status", "body").mapInArrow(run, "url string, folder boolean, size long")


def webdav_files(spark: SparkSession, base: str, request: Opener) -> DataFrame:
    """(url, path, kind, size) of all files under a WebDAV folder, a level of folders at a time.

    Servers answer with paths that begin at their root and may leave out the part of the address before /remote.php; that part
    is put back. Folders that can't be listed are passed over.
    """
    parts = urllib.parse.urlparse(base)
    cut = parts.path.find("/remote.php")
    server, root = f"{parts.scheme}://{parts.netloc}{parts.path[:cut] if cut > 0 else ''}", base.rstrip("/")
    seen, level, files = {root}, [root], spark.createDataFrame([], "url string, folder boolean, size long")
    while level:
        # a level's answers are met twice, by its folders and its files
        found = _listed(fetched(spark.createDataFrame([(u,) for u in level], "url string"), request, "PROPFIND"), server).persist()
        files = files.union(spark.createDataFrame(found.where("NOT folder").toArrow()) if found.where("NOT folder").count() else files.limit(0))
        level = sorted({r.url.rstrip("/") for r in found.where("folder").select("url").distinct().collect()} - seen)
        seen.update(level)
        found.unpersist()
    path = F.substring("url", len(root) + 2, 1 << 20)
    return files.distinct().select("url", path.alias("path"), kind_of(F.col("url")).alias("kind"), "size")


def webdav_pulled(files: DataFrame, request: Opener, have: DataFrame | None = None, kinds: list[str] = ("media",)) -> DataFrame:
    """(path, kind, size, content, error) of files of the wanted kinds, but those that ``have`` (path, size) holds already."""
    wanted = files.where(F.col("kind").isin(*kinds))
    if have is not None:
        wanted = wanted.join(have.select("path", "size").distinct(), ["path", "size"], "left_anti")
    got = fetched(wanted, request)
    failed = F.coalesce("error", F.when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status").cast("string"))))
    return wanted.join(got, "url").select("path", "kind", "size", F.when(failed.isNull(), F.col("body")).alias("content"), failed.alias("error"))
