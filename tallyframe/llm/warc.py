"""WARC archives of pages: written whole, normalised to one gzip member a record, read back.

Spark writes the records as gzip text files, each one stream from end to end, in
which no record can be reached alone. The normaliser inflates each such file
once as a stream, writes every record as a gzip member of its own to a new
archive, and records where it starts; the rows of all archives are the sidecar
index. Records are then read back by seeking to their offsets.

A file is handled by one task in pieces, so a task holds one record at a time.
Archives get their names by a rename at the end; a task that runs again replaces
its file by the same bytes.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import NO_ID, id_back, id_of, write_out
from tallyframe.storage import new_shared_path

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 20_000
PIECE = 1 << 20
END = b"\r\n\r\n"

INDEX = "archive string, offset long, length long, record_id string, record_type string"
READ = (
    "_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, _refers long"
)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# ---- writing -------------------------------------------------------------------------


def _with_digests(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        id_of("page_id").alias("_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("html"),
        F.octet_length(payload).cast("long").alias("n"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("sha256"),
    )


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(_id, sha256, _refers): the pages whose payload a page of a larger id has too."""
    large = pages.filter(F.col("n") >= least).select("_id", "sha256")
    largest = large.groupBy("sha256").agg(
        F.max("_id").alias("_refers"), F.min("_id").alias("least")
    )
    shared = largest.filter("least < _refers").drop("least")
    return large.join(shared, "sha256").filter("_id < _refers").distinct()


def _name(number: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))


def _record(revisit: Column) -> Column:
    """The text of a record, but for the line end that the writer adds."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    refers = F.when(
        revisit, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("_refers")), F.lit("\r\n"))
    ).otherwise("")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        _name(F.col("_id")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        # A line end in an address would end the header.
        F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("sha1"),
        F.lit("\r\n"),
        refers,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
        F.lit("\r\n"),
    )


def write_archives(
    pages: DataFrame,
    least: int = MIN_REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> str:
    """Write a record for each row of (page_id, url, html); returns the folder."""
    here = _with_digests(pages)
    links = _revisits(here, least)
    joined = here.join(links, ["_id", "sha256"], "left")
    path = new_shared_path(pages.sparkSession, "warc")
    (
        joined.select(_record(F.col("_refers").isNotNull()).alias("value"))
        .write.option("compression", "gzip")
        .option("lineSep", "\r\n")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )
    return path


# ---- streams of records --------------------------------------------------------------


class _Inflated:
    """The bytes of a gzip file of one or many members, taken as they are needed."""

    def __init__(self, file):
        self.file, self.buffer = file, bytearray()
        self.inflate, self.rest = zlib.decompressobj(31), b""

    def _more(self) -> bool:
        data = self.rest or self.file.read(PIECE)
        if not data:
            return False
        self.buffer += self.inflate.decompress(data, PIECE)
        self.rest = self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
        return True

    def until(self, end: bytes) -> bytes:
        """Up to and with ``end``; empty at the end of the file."""
        seen = 0
        while (at := self.buffer.find(end, seen)) < 0:
            seen = max(0, len(self.buffer) - len(end) + 1)
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends inside a record")
                return b""
        return self.take(at + len(end))

    def take(self, count: int) -> bytes:
        while len(self.buffer) < count:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.buffer[:count])
        del self.buffer[:count]
        return out


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def records(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and the bytes of each record of an archive, with its end."""
    stream = _Inflated(file)
    while header := stream.until(END):
        fields = _fields(header)
        yield fields, header + stream.take(int(fields["content-length"]) + len(END))


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def normalise_file(uri: str, target: str) -> list[tuple]:
    """Rewrite an archive with a member for each record; returns its index rows."""
    system, source = _open(uri)
    out, final = _open(target)
    partial, rows, offset = f"{final}.{uuid.uuid4().hex}.partial", [], 0
    with system.open_input_stream(source, compression=None) as file:
        with out.open_output_stream(partial, compression=None) as sink:
            for fields, data in records(file):
                member = _member(data)
                sink.write(member)
                kind = (fields["warc-record-id"], fields["warc-type"])
                rows.append((target, offset, len(member), *kind))
                offset += len(member)
    out.move(partial, final)
    return rows


def normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Rewrite every archive of ``folder``; returns the sidecar index, written beside them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    found = found.select("path")
    target = new_shared_path(spark, "warc-members")
    system, path = _open(target)
    system.create_dir(path)

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                name = uri.rsplit("/", 1)[1].split(".")[0]
                rows = normalise_file(uri, f"{target}/{name}.warc.gz")
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")])

    index = found.repartition(max(1, found.count()), "path").mapInPandas(rewrite, INDEX)
    index.write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


# ---- reading -------------------------------------------------------------------------


def _read_record(data: bytes) -> tuple:
    header, _, rest = data.partition(END)
    fields = _fields(header + END)
    http, _, payload = rest[: int(fields["content-length"])].partition(END)
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"][5:]
    number = int(fields["warc-record-id"][10:-1])
    if fields["warc-type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record {number} does not hold the payload it names")
    refers = fields.get("warc-refers-to")
    refers = int(refers[10:-1]) if refers else None
    return number, fields["warc-target-uri"], payload, size, digest, fields["warc-type"], refers


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that an index names, by their offsets; digests are verified."""
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, rows in batch.groupby("archive"):
                system, path = _open(uri)
                with system.open_input_file(path) as file:
                    out = []
                    for offset, length in zip(rows["offset"], rows["length"], strict=True):
                        file.seek(offset)
                        row = _read_record(zlib.decompress(file.read(length), 31))
                        out.append(row if with_payload else (*row[:2], None, *row[3:]))
                        if len(out) == 256:
                            yield _typed(out, names)
                            out = []
                    yield _typed(out, names)

    return index.select("archive", "offset", "length").mapInPandas(read, READ)


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    # From whole numbers, not by way of floats, which would round large ids.
    refers = pd.array([x if x is None else int(x) for x in frame["_refers"]], "Int64")
    return frame.astype({"_id": "int64", "payload_bytes": "int64"}).assign(_refers=refers)


def archive(
    pages: DataFrame, least: int = MIN_REVISIT_BYTES, records_per_file: int = RECORDS_PER_FILE
) -> DataFrame:
    """Write, normalise and read back: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload, a null url an empty address. A null page_id
    counts as the largest. Rows of one page_id and payload never revisit each
    other. Without pages there are no archives and no rows.
    """
    folder = write_archives(pages.select("page_id", "url", "html"), least, records_per_file)
    back = read_records(normalise(pages.sparkSession, folder), with_payload=False)
    return back.select(
        id_back(F.col("_id")).alias("page_id"),
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        id_back(F.col("_refers")).alias("refers_to"),
    )
