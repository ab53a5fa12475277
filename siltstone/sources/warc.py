"""Pages from WARC records by byte range.

Each candidate is one gzipped WARC record at (filename, offset, length) under a root that pyarrow's file systems can open.
A page that cannot be read or parsed becomes a row with ok = false and its error; it never fails the task.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import ship_package

RESULT = "html string, ok boolean, error string"


def read_range(system: fs.FileSystem, path: str, offset: int, length: int) -> bytes:
    with system.open_input_file(path) as f:
        return f.read_at(length, offset)


def _plain(raw: bytes) -> bytes:
    """All gzip members, as far as they are whole; plain bytes stay."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        out.append(member.decompress(raw))
        raw = member.unused_data
    return b"".join(out)


def _headers(block: bytes) -> dict[bytes, bytes]:
    lines = block.replace(b"\r\n", b"\n").split(b"\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:] if b":" in line)}


def _dechunked(body: bytes) -> bytes:
    out = []
    while body:
        size, _, rest = body.partition(b"\r\n")
        try:
            n = int(size.split(b";")[0], 16)
        except ValueError:
            return b"".join(out) or body
        if not n:
            break
        out.append(rest[:n])
        body = rest[n + 2 :]
    return b"".join(out)


def html_of(raw: bytes) -> str | None:
    """Text of the first HTML response record, decoded as UTF-8 with replacement; None if there is none."""
    data = _plain(raw)
    while data.startswith(b"WARC/"):
        head, _, rest = data.partition(b"\r\n\r\n")
        record = _headers(head)
        size = int(record.get(b"content-length", b"0"))
        content, data = rest[:size], rest[size:].lstrip(b"\r\n")
        if record.get(b"warc-type") != b"response":
            continue
        http, _, body = content.partition(b"\r\n\r\n")
        fields = _headers(http)
        if b"html" not in fields.get(b"content-type", b""):
            continue
        try:
            if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
                body = _dechunked(body)
            coding = fields.get(b"content-encoding", b"").lower()
            if coding == b"gzip":
                body = gzip.decompress(body)
            elif coding == b"deflate":
                body = zlib.decompress(body)
        except (OSError, EOFError, zlib.error):
            continue
        return body.decode("utf-8", errors="replace")
    return None


def fetch_pages(found: DataFrame, root: str) -> DataFrame:
    """Candidates with html, ok and error."""
    ship_package(found.sparkSession)
    schema = T.StructType([*found.schema.fields, *T.StructType.fromDDL(RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for b in batches:
            out: list[tuple[str | None, bool, str | None]] = []
            for name, offset, length in zip(*(b.column(c).to_pylist() for c in ("filename", "offset", "length")), strict=True):
                try:
                    html = html_of(read_range(system, f"{base}/{name}", offset, length))
                    out.append((html, html is not None, None if html is not None else "no HTML response record"))
                except (OSError, TypeError, ValueError, zlib.error) as e:
                    out.append((None, False, f"{type(e).__name__}: {e}"[:200]))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.string()), strict=True)]], schema.fieldNames())

    return found.mapInArrow(run, schema)
