"""WARC archives with a shared Zstandard dictionary: each record is a frame of its own, the dictionary comes first."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join
from threadloom.session import cut, run_dir

# Fixed values of the compressed archive format: the magic number of the skippable frame that holds the dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_BYTES = 64 * 1024
# The dictionary is built from so many records at most, and so many characters of each, from a place that its hash names.
SAMPLE_ROWS, SAMPLE_CHARS = 500, 16_384
FILE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, without the algorithm's name."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{record}')}>"


def record_bytes(
    record: int, page_id: int | None, url: str | None, payload: bytes, revisited: int | None = None, refers_to: int | None = None, date: str = DATE
) -> bytes:
    """One record: a response with its HTTP message, or a revisit of the record ``revisited`` with the HTTP head alone.

    A record is named by its number. The page's id and that of the page revisited are extension fields, so reading needs
    nothing beside the archive.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if revisited is None else head
    fields = {
        "WARC-Type": "response" if revisited is None else "revisit",
        "WARC-Record-ID": record_name(record),
        "WARC-Date": date,
        "WARC-Target-URI": quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if page_id is not None:
        fields["Page-ID"] = page_id
    if revisited is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_name(revisited)}
    if refers_to is not None:
        fields["Refers-To-Page-ID"] = refers_to
    lines = [VERSION, *(f"{key}: {value}".encode() for key, value in fields.items())]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of a record, its block, and the length of the full payload; a response's digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("a payload that does not match its digest")
    return fields | {"payload": payload if fields["WARC-Type"] == "response" else None, "payload_bytes": length, "digest": digest}


def build_dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> bytes:
    """A Zstandard dictionary from records of at most ``rows`` pages, those with the smallest hashes of id and url.

    Empty if the records are too few or too alike to give one; archives are then written without.
    """
    import zstandard

    named, html = F.xxhash64("page_id", "url"), F.coalesce("html", F.lit(""))
    begin = F.pmod(named, F.greatest(F.length(html) - chars, F.lit(0)) + 1) + 1
    hashed = pages.select(named.alias("_h"), "page_id", "url", F.substr(html, begin.cast("int"), F.lit(chars)).alias("html"))
    # Only hashes are sorted; then the few rows up to the last of them come, one of each hash.
    last = hashed.select("_h").orderBy("_h").limit(rows).agg(F.max("_h")).first()[0]
    few = hashed.filter(F.col("_h") <= F.lit(last)).groupBy("_h").agg(F.min(F.struct("page_id", "url", "html")).alias("r"))
    sample = sorted(few.collect(), key=lambda x: x["_h"])
    records = [record_bytes(i, x["r"]["page_id"], x["r"]["url"], x["r"]["html"].encode()) for i, x in enumerate(sample)]
    try:
        return zstandard.train_dictionary(size, records).as_bytes() if len(records) > 7 else b""
    except zstandard.ZstdError:
        return b""


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, url, html, record, revisited, refers_to): of payloads of ``least`` bytes or more
    that are equal, one row with the smallest page_id (null last) is the response, and the others, rows alike in all columns
    included, refer to it by its record and its page_id. Equality is told by SHA-256; null html is an empty payload.

    Records are numbered by the rows' place in their table, which has to give its rows in one order when it is read again,
    as files and written tables do.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    numbered = pages.select("page_id", "url", "html", F.monotonically_increasing_id().alias("record"))
    keyed = numbered.withColumns({"_sha": F.sha2(payload, 256), "_bytes": F.octet_length(payload)})
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record")
    groups = keyed.groupBy("_sha").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    later = (F.col("_bytes") >= least) & (F.col("record") != F.col("_first.record"))
    revisited, refers_to = (F.when(later, F.col(f"_first.{c}")).alias(name) for c, name in (("record", "revisited"), ("page_id", "refers_to")))
    return skew_join(keyed, groups, "_sha", "left").select("page_id", "url", "html", "record", revisited, refers_to)


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, level: int = 3, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """One record per row of ``pages``, the columns of :func:`revisits`; returns the written index (path, offset, bytes, page_id).

    Each task writes files of about ``file_bytes`` into the shared ``folder`` under names of its own, and only the files of
    tasks that succeeded are in the index: a lost executor or a second attempt leaves files that nobody reads. Records
    whose frames begin at an offset can be read alone with the dictionary of their file.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        store, base = _file_system(folder)
        store.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True)
        out, path, at = None, "", 0
        try:
            for frame in frames:
                index: list[tuple] = []
                for page_id, url, html, record, revisited, refers_to in frame.itertuples(index=False, name=None):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                        out, at = store.open_output_stream(path, compression=None), 0
                        if dictionary:
                            at += out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
                    page, source, target = (None if pd.isna(x) else int(x) for x in (page_id, revisited, refers_to))
                    payload = b"" if html is None else html.encode("utf-8", "surrogatepass")
                    written = compressor.compress(record_bytes(record, page, url, payload, source, target, date))
                    out.write(written)
                    index.append((path, at, len(written), page))
                    at += len(written)
                yield pd.DataFrame(index, columns=["path", "offset", "bytes", "page_id"]).astype({"page_id": "Int64"})
        finally:
            if out is not None:
                out.close()

    nullable = {name: F.col(name).cast("string") for name in ("page_id", "revisited", "refers_to")}
    return cut(pages.select("page_id", "url", "html", "record", "revisited", "refers_to").withColumns(nullable).mapInPandas(write, "path string, offset long, bytes long, page_id long"))


def records_of(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one open archive, frame by frame; at most one record is held."""
    import zstandard

    data = stream.read(8)
    known = None
    if len(data) == 8 and struct.unpack("<II", data)[0] == DICTIONARY_MAGIC:
        known = zstandard.ZstdCompressionDict(bytes(stream.read(struct.unpack("<II", data)[1])))
        data = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=known)
    data = data or stream.read(chunk)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("an archive that ends within a record")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(chunk)
        yield b"".join(parts)
        data = data or stream.read(chunk)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every record in the index's files.

    An empty index gives no rows. A revisit of a page without an id has a null ``refers_to``.
    """
    paths = index.select("path").distinct()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = _file_system(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        for frame in frames:
            for path in frame["path"]:
                rows: list[tuple] = []
                size = 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in records_of(stream):
                        r = parse_record(data)
                        page, target = (int(r[k]) if k in r else None for k in ("Page-ID", "Refers-To-Page-ID"))
                        rows.append((page, r["WARC-Target-URI"], r["payload_bytes"], r["digest"], r["WARC-Type"], target, r["payload"]))
                        size += len(data)
                        if size >= 1 << 24:
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return paths.repartition(max(1, paths.count())).mapInPandas(read, schema)


def archive(pages: DataFrame, least: int = 0, level: int = 3) -> tuple[DataFrame, str]:
    """Write all of ``pages`` below the shared folder; returns the index and the folder. No rows give no files."""
    folder = run_dir(pages.sparkSession, "warc")
    return write_archives(revisits(pages, least), folder, build_dictionary(pages), level), folder
