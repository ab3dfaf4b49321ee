"""WARC derivatives: every response becomes a metadata record and a plain-text conversion record that refer to it."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from feedloom.session import scratch_path, written

EPOCH = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"

COMMENT = re.compile(r"<!--(?:.*?-->|.*\Z)", re.S)
HIDDEN = re.compile(r"<(script|style|noscript|template)\b[^<>]*>(?:.*?</\1\s*>|.*\Z)", re.S | re.I)
BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|li|main|nav|ol|option|p|pre"
    r"|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^<>]*>",
    re.I,
)
TAG = re.compile(r"<[!/?a-zA-Z][^<>]*>")
TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.I)
LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"<>]*)\"|'([^'<>]*)'|([^\s\"'<>]+))", re.I)
CHARSET = re.compile(r"charset=\"?([\w.:-]+)", re.I)
BLANKS = re.compile(r"[^\S\n]+")
LINES = re.compile(r" ?\n[ \n]*")

CHUNK_SIZE = re.compile(rb"[0-9A-Fa-f]{1,15}")
#: Content codings that are undone, and the window bits by which zlib knows them; the first that fits counts.
CODINGS = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}
#: Bytes of a decoded body; a record with a longer one becomes an ``error`` row.
MAX_BODY = 1 << 28
#: Compressed bytes that are decoded at a time.
PIECE = 1 << 16

HEADERS = "map<string,string>"
SCHEMA = f"record_type string, record_id string, refers_to string, target_uri string, headers {HEADERS}, source_headers {HEADERS}, block string"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def serialise(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields; one that is repeated keeps all its values, and a line that begins with a blank goes on."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            last = name.strip()
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record. ValueError if it is not one."""
    head, found, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    headers = _fields(lines)
    length = headers.get("Content-Length", "")
    if not found or not version.startswith(b"WARC/") or not length.isdigit() or int(length) > len(rest):
        raise ValueError("not a WARC record")
    return headers, rest[: int(length)]


def response_record(url: str | None, payload: bytes, name: str, date: str = EPOCH) -> bytes:
    """A response record around an HTML page that was fetched without its headers."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload
    headers = {"WARC-Type": "response", "WARC-Record-ID": record_id(name)}
    headers |= {"WARC-Target-URI": re.sub(r"\s", "%20", url)} if url else {}
    headers |= {
        "WARC-Date": date,
        "WARC-Payload-Digest": digest(payload),
        "WARC-Block-Digest": digest(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return serialise(headers, block)


def _dechunked(data: bytes) -> bytes:
    """The chunks of a body one after the other, as far as they go; a body without chunk sizes is left as it is."""
    out, at = bytearray(), 0
    while True:
        end = data.find(b"\r\n", at)
        size = CHUNK_SIZE.fullmatch(data[at:end].partition(b";")[0].strip()) if end >= 0 else None
        if not size:
            return bytes(out) if at else data
        if not int(size[0], 16):
            return bytes(out)
        at = end + 2 + int(size[0], 16)
        out += data[end + 2 : at]
        at += 2


def _inflated(data: bytes, bits: int, most: int) -> bytes | None:
    """All members of a compressed body, as far as they are sound; None if not even the first one begins as one."""
    out, at, sound, stream = bytearray(), 0, False, zlib.decompressobj(bits)
    while at < len(data):
        piece = data[at : at + PIECE]
        try:
            out += stream.decompress(piece)
        except zlib.error:
            break
        if len(out) > most:
            raise ValueError(f"a body of over {most} bytes")
        sound = True
        at += len(piece) - len(stream.unused_data)
        if stream.eof:
            stream = zlib.decompressobj(bits)
    return bytes(out) if sound else None


def decoded(payload: bytes, http: dict[str, str], most: int = MAX_BODY) -> bytes:
    """The body of a response without its transfer and content codings.

    Bodies that crawlers have decoded already, though the headers still name a coding, stay as they are; truncated ones
    give what can be read. ValueError for a coding that is not known and for more than ``most`` bytes.
    """
    fields = {k.lower(): [x for x in re.split(r"[\s,]+", v.lower()) if x] for k, v in http.items()}
    transfer = fields.get("transfer-encoding", [])
    if "chunked" in transfer:
        payload = _dechunked(payload)
    for coding in reversed([*fields.get("content-encoding", []), *transfer]):
        if coding in ("chunked", "identity", "none"):
            continue
        if coding not in CODINGS:
            raise ValueError(f"unknown coding {coding}")
        payload = next((x for x in (_inflated(payload, bits, most) for bits in CODINGS[coding]) if x is not None), payload)
    return payload


def plain_text(page: str) -> str:
    """The visible text of a page: one line per block element, entities resolved, blanks collapsed."""
    page = HIDDEN.sub(" ", COMMENT.sub(" ", page))
    page = TAG.sub("", BREAK.sub("\n", page.replace("\n", " ")))
    return LINES.sub("\n", BLANKS.sub(" ", html.unescape(page).replace("\r", " "))).strip()


def derive(record: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record, as rows of ``SCHEMA``; none for other records.

    Both name the response in ``WARC-Refers-To``, keep its URI and date, and name each other. The conversion holds
    the text; the metadata holds the source's identifier, digests, length, status and HTTP headers, and the page's
    title and links. Bodies are read as :func:`decoded` gives them.
    """
    source, block = parse(record)
    if source.get("WARC-Type") != "response":
        return []
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.split(b"\r\n")
    http = _fields(lines)
    payload = decoded(payload, http)
    kind = {k.lower(): v for k, v in http.items()}.get("content-type", "")
    named = CHARSET.search(kind)
    try:
        page = payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    about = source.get("WARC-Record-ID", "")
    ids = {t: record_id(f"{about}/{t}") for t in ("metadata", "conversion")}
    shared = {"WARC-Refers-To": about}
    shared |= {k: source[k] for k in ("WARC-Target-URI", "WARC-Date") if k in source}
    title = TITLE.search(page)
    fields = [("source-record-id", about), *((f"source-{k.removeprefix('WARC-').lower()}", source[k]) for k in ("WARC-Payload-Digest", "WARC-Block-Digest", "Content-Type", "Content-Length") if k in source)]
    fields += [("http-status", status.decode("utf-8", "replace")), *((f"http-{k.lower()}", v) for k, v in http.items())]
    fields += [("title", " ".join(html.unescape(title[1]).split()))] if title else []
    fields += [("outlink", " ".join(html.unescape(a or b or c).split())) for a, b, c in LINK.findall(page)]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields)),
        "conversion": ("text/plain; charset=UTF-8", plain_text(page)),
    }
    out = []
    for kind, (content_type, text) in blocks.items():
        other = ids["conversion" if kind == "metadata" else "metadata"]
        data = text.encode("utf-8", "replace")
        headers = {"WARC-Type": kind, "WARC-Record-ID": ids[kind], **shared, "WARC-Concurrent-To": other, "WARC-Block-Digest": digest(data)}
        headers |= {"Content-Type": content_type, "Content-Length": str(len(data))}
        out.append(
            {"record_type": kind, "record_id": ids[kind], "refers_to": about, "target_uri": source.get("WARC-Target-URI"), "headers": list(headers.items()), "source_headers": list(source.items()), "block": data.decode()}
        )
    return out


def responses(pages: DataFrame, date: str = EPOCH) -> DataFrame:
    """``page_id`` and ``record``, the response record of every page (``page_id``, ``url``, ``html``).

    Its identifier follows from the id and the url, so repeated rows have the same one. A null url leaves the URI out,
    a null page is an empty payload, other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            pages = batch.column(2).cast(pa.binary()).to_pylist()
            made = [response_record(u, p or b"", f"{i} {u}", date) for i, u, p in zip(ids, urls, pages, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["page_id", "record"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(build, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """``page_id`` and the columns of ``SCHEMA`` for the derivatives of every response in ``record``.

    Records that are null or cannot be parsed, or whose body is in an unknown coding or over ``MAX_BODY`` long, give
    one row of type ``error`` with the reason as ``block``; records of other types give none, repeated ones give theirs
    each time.
    """
    arrow = pa.schema(
        [("page_id", pa.int64()), *[(c, pa.string()) for c in ("record_type", "record_id", "refers_to", "target_uri")], ("headers", pa.map_(pa.string(), pa.string())), ("source_headers", pa.map_(pa.string(), pa.string())), ("block", pa.string())]
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    made = derive(record or b"")
                except ValueError as e:
                    made = [{"record_type": "error", "headers": [], "source_headers": [], "block": str(e)}]
                rows += [{"page_id": page_id, **row} for row in made]
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return records.select("page_id", "record").mapInArrow(convert, f"page_id long, {SCHEMA}")


def write_warc(derived: DataFrame, folder: str | None = None) -> DataFrame:
    """Write derived records as ``.warc.gz`` files, one member per record; ``path`` and ``n_records`` of each come back.

    A task that is run again writes another file; the rows returned name those that count.
    """
    folder = folder or scratch_path(derived.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        task, sink, n = TaskContext.get(), None, 0
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        for batch in batches:
            for headers, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if sink is None:
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                sink.write(gzip.compress(serialise(dict(headers), block.encode()), 6, mtime=0))
                n += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": pa.array([n], pa.int64())})

    fine = derived.where(F.col("record_type") != "error").select("headers", "block")
    return written(fine.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def read_warc(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of all records of one file, read record by record."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw)) as data:
        while line := data.readline():
            head = [line]
            while (line := data.readline()) not in (b"\r\n", b""):
                head.append(line)
            headers = _fields([x.rstrip(b"\r\n") for x in head[1:]])
            block = data.read(int(headers["Content-Length"]))
            data.read(4)
            yield headers, block
