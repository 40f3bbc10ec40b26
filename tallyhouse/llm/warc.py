"""WARC derivative builder: metadata and conversion records of responses.

A response record gives two records that refer to it: `metadata` with fields taken
from the page and its headers, and `conversion` with the page's plain text. Both
keep the response's URI, date, source headers and digests, and say by
WARC-Refers-To which record they come from. Record ids are made from the
response's id and its page, so building again gives the same records.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VERSION = "WARC/1.1"
#: Date of responses that carry none.
NO_DATE = "1970-01-01T00:00:00Z"
_SPACE_OF_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the RFC's namespace for URLs

#: Elements whose content is no text of the page, and those that begin a new line.
HIDDEN = {"script", "style", "noscript", "template", "svg"}
BLOCKS = set(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li "
    "main nav ol p pre section table td th tr ul".split()
)
_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*HIDDEN, "title")}
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")


def _clean(text: str) -> str:
    return _LINES.sub("\n", _BLANKS.sub(" ", html.unescape(text))).strip()


def _one_line(text: str) -> str:
    return " ".join(text.split())


def read_page(page: str) -> tuple[str, list[tuple[str, str]]]:
    """A page's text, and what a metadata record tells of it: title, language, links.

    The text is without tags, with a new line at each block, entities read and blanks
    joined; the first head, if it ends, is left out, and so are comments and elements
    that hide their content, to the end of the page if they do not end. The page is
    gone through once, from tag to tag: a search that finds no end is not made again.
    """
    pieces: list[str] = []
    title, lang, links = None, None, []
    at, head, titles_end = 0, None, True
    while True:
        begin = page.find("<", at)
        if begin < 0:
            pieces.append(page[at:].replace("\n", " "))
            break
        pieces.append(page[at:begin].replace("\n", " "))
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            pieces.append(" ")
            if end < 0:
                break
            at = end + 3
            continue
        named = _TAG_NAME.match(page, begin)
        if not named and page[begin + 1:begin + 2] not in ("/", "!", "?"):
            pieces.append("<")
            at = begin + 1
            continue
        end = page.find(">", begin)
        tag = page[begin:end + 1] if end >= 0 else page[begin:]
        at = begin + len(tag)
        name, opens = (named[1].lower(), tag[1] != "/") if named else ("", False)
        if opens and name in HIDDEN and not (name == "svg" and tag.endswith("/>")):
            closed = _CLOSED[name].search(page, at)
            pieces.append(" ")
            if not closed:
                break
            at = closed.end()
        elif opens and name == "title" and titles_end:
            closed = _CLOSED[name].search(page, at)
            titles_end = closed is not None
            if closed and title is None:
                title = page[at:closed.start()]
        elif opens and name == "html" and lang is None:
            found = _LANG.search(tag)
            lang = found and found[1]
        elif opens and name == "a":
            found = _HREF.search(tag)
            if found:
                links.append(_one_line(html.unescape(found[1] or found[2] or found[3] or "")))
        elif name == "head" and head is None and opens:
            head = len(pieces)
        elif name == "head" and not opens and isinstance(head, int) and head >= 0:
            del pieces[head:]
            pieces.append(" ")
            head = -1
        if name in BLOCKS:
            pieces.append("\n")
    fields = [("title", title), ("language", lang)]
    known = [(name, _one_line(_clean(value))) for name, value in fields if value is not None]
    return _clean("".join(pieces)), known + [("outlink", link) for link in links if link]


def digest(block: bytes) -> str:
    return "sha256:" + hashlib.sha256(block).hexdigest()


def derived_id(response_id: str, kind: str, payload: str) -> str:
    """An id of a record made from a response; `payload` is the digest of its page."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE_OF_IDS, f'{kind} {payload} {response_id}')}>"


_RECORD = pa.struct([
    ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
    ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("block", pa.string()),
])
_RECORD_DDL = (
    "array<struct<warc_type:string,record_id:string,refers_to:string,"
    "headers:array<struct<name:string,value:string>>,block:string>>"
)


def derive(
    own_id: str | None, key: str | None, uri: str | None, date: str | None, source: dict, page: str | None
) -> list[dict]:
    """The metadata and the conversion record of one response."""
    page = page or ""
    payload = digest(page.encode())
    response = own_id or response_id(key, uri, payload)
    text, fields = read_page(page)
    conversion_id = derived_id(response, "conversion", payload)
    described = [*fields, ("text-record", conversion_id), ("text-digest", digest(text.encode()))]
    described += [(f"source-{name.lower()}", _one_line(value)) for name, value in source.items()]
    records = []
    for kind, content, block in (
        ("metadata", "application/warc-fields", "".join(f"{name}: {value}\r\n" for name, value in described)),
        ("conversion", "text/plain; charset=UTF-8", text),
    ):
        record_id = derived_id(response, kind, payload)
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", response),
            ("WARC-Target-URI", _one_line(uri or "")), ("WARC-Date", date or NO_DATE),
            ("WARC-Refers-To-Date", date or NO_DATE), ("WARC-Source-Payload-Digest", payload),
            ("WARC-Block-Digest", digest(block.encode())), ("Content-Type", content),
            ("Content-Length", str(len(block.encode()))),
        ]
        records.append({
            "warc_type": kind, "record_id": record_id, "refers_to": response,
            "headers": [{"name": n, "value": v} for n, v in headers if v], "block": block,
        })
    return records


def response_id(key, uri: str | None, payload: str) -> str:
    """An id for a response that came without one, from its key, URI and page's digest."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE_OF_IDS, f'response {payload} {key} {uri}')}>"


def derivatives(
    responses: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html",
    record_id: str | None = None, date: str | None = None, headers: str | None = None,
) -> DataFrame:
    """Two records for each response: (key, warc_type, record_id, refers_to, headers, block).

    record_id, date and headers (a map) name columns of the responses, where they
    have them; otherwise ids are made from key, URI and page, so two pages never share
    one. headers of a record are in
    order, as WARC writes them; headers of the source are kept as fields of the
    metadata record. A null page is an empty one; a null URI is left out of the
    headers. Repeated rows give repeated records, with the same ids.
    """
    blank = F.lit(None).cast("string")
    no_headers = F.lit(None).cast("map<string,string>")

    def run(keys: pa.Array, uris: pa.Array, ids: pa.Array, dates: pa.Array, sources: pa.Array, pages: pa.Array) -> pa.Array:
        return pa.array([
            derive(own, k, u, d, dict(s or ()), p)
            for k, u, own, d, s, p in zip(*[x.to_pylist() for x in (keys, uris, ids, dates, sources, pages)])
        ], pa.list_(_RECORD))

    records = F.arrow_udf(run, _RECORD_DDL).asNondeterministic()(
        F.col(key).cast("string"), F.col(uri), F.col(record_id) if record_id else blank, F.col(date) if date else blank,
        F.col(headers) if headers else no_headers, F.col(payload),
    )
    return responses.select(F.col(key).alias(key), F.explode(records).alias("of")).select(key, "of.*")


def write_warc(records: DataFrame, folder: str) -> None:
    """The records as WARC files, one for each task; records are written whole."""
    head = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit("\r\n"))), "")
    text = F.concat(F.lit(VERSION + "\r\n"), head, F.lit("\r\n"), F.col("block"))
    # Two line ends close a record.
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").mode("overwrite").text(folder)
