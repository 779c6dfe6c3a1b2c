"""WARC archives: written one gzip member per record, read back in splits of any size.

Writing: each task writes one archive into a folder all executors share, under a name of its own
attempt, and reports it; only archives that a finished task reported are read, so a task that ran
twice leaves nothing double. Of records with equal payloads of at least ``MIN_REVISIT`` bytes the
one with the smallest id is a response; the others revisit it and carry no payload.

Reading: an archive is cut into byte ranges, one row each. The task of a range scans it for the
gzip magic number, checks a candidate by decoding it (the member must begin with a WARC version
line and end at the end of the file or at another member), and owns the records that start
inside its range; the last of them is read past the range's end. A record is decoded by itself,
so memory is bounded by the largest record, not by the archive.

Defined results: null text is an empty payload; a null id is never what others refer to, unless
all ids of its payload are null (then each is a response); rows with the same smallest id are
all responses; ``url`` may be null or hold any characters; an empty table gives no records; a
range without record starts gives none.
"""

import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftledger.llm.common import load, materialize
from draftledger.session import shared_dir

MIN_REVISIT = 100
SPLIT_BYTES = 8 * 1024 * 1024
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"  # records carry no capture time of their own
_CHUNK = 1 << 16

RECORD = ("id string, record_type string, url string, refers_to string, payload_bytes long, "
          "payload_digest string, payload binary, archive string, offset long")


def _filesystem(uri: str):
    """(filesystem, path) of a folder or file that every task can reach."""
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def _member(headers: dict[str, str], body: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    record = _VERSION + head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def record_bytes(id_: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None,
                 revisit: bool) -> bytes:
    """One gzip member. The id is kept in the record id; a null id gives one without a name."""
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Date": _DATE,
               "WARC-Record-ID": "<urn:record:" + ("null" if id_ is None else "id:" + quote(id_, safe="")) + ">",
               "WARC-Target-URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=-._~"),
               "WARC-Payload-Digest": f"sha256:{digest}"}
    if revisit:
        headers |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:record:id:{quote(refers_to, safe='')}>"}
        return _member(headers, b"")
    headers["Content-Type"] = "application/http; msgtype=response"
    return _member(headers, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload)


def plan(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
         min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows ready to be written: id, url, payload, digest, refers_to (null for responses)."""
    payload = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # equal payloads of any number meet as one row each: counted and reduced before the shuffle
    groups = (rows.where(F.length("payload") >= min_revisit).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null"))
    groups = materialize(groups.drop("n"), "warcgroups")
    long_ = F.length("payload") >= min_revisit
    joined = rows.join(groups.withColumnRenamed("digest", "same"), (F.col("digest") == F.col("same")) & long_, "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(F.col("id").cast("string").alias("id"), "url",
                         F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "digest",
                         F.when(revisit, F.col("first").cast("string")).alias("refers_to"))


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Writes planned rows as archives under ``folder``; returns (archive, bytes, records)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        store, root = _filesystem(folder)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out, size, n = None, 0, 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                refers = r.refers_to if isinstance(r.refers_to, str) else None
                data = record_bytes(r.id if isinstance(r.id, str) else None, r.url if isinstance(r.url, str) else None,
                                    bytes(r.payload), r.digest, refers, refers is not None)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [n]})

    return materialize(rows.mapInPandas(run, "archive string, bytes long, records long"), "warcarchives")


class _Window:
    """Bytes of a file by position; a few chunks are held at a time."""

    def __init__(self, source, size: int):
        self.source, self.size, self.at, self.data = source, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not self.at <= at or at + n > self.at + len(self.data):
            self.source.seek(at)
            self.at, self.data = at, self.source.read(max(n, 4 * _CHUNK))
        return self.data[at - self.at:at - self.at + n]


def _decode(window: _Window, at: int) -> tuple[bytes, int] | None:
    """(record, end) of the gzip member at ``at``, or None if it isn't a record's."""
    z, parts, to, checked = zlib.decompressobj(31), [], at, False
    while not z.eof:
        data = window.get(to, _CHUNK)
        if not data:
            return None
        try:
            parts.append(z.decompress(data))
        except zlib.error:
            return None
        to += len(data)
        if not checked and sum(map(len, parts)) >= len(_VERSION):
            if not b"".join(parts).startswith(_VERSION):
                return None
            parts, checked = [b"".join(parts)], True
    end = to - len(z.unused_data)
    if not checked or end < window.size and not _MAGIC.startswith(window.get(end, 3)):
        return None
    return b"".join(parts), end


def parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])

    def named(value: str | None) -> str | None:
        value = (value or "").removeprefix("<urn:record:").removesuffix(">")
        return unquote(value.removeprefix("id:")) if value.startswith("id:") else None

    body = rest[:int(fields["Content-Length"])]
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else body.partition(b"\r\n\r\n")[2]
    url = fields.get("WARC-Target-URI")
    return {"id": named(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
            "url": None if url is None else unquote(url), "refers_to": named(fields.get("WARC-Refers-To")),
            "payload_bytes": None if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit
            else sha256(payload).hexdigest(), "payload": payload}


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the records that start in [start, end)."""
    window, at = _Window(source, size), start
    while at < end:
        found = _decode(window, at) if window.get(at, 3) == _MAGIC else None
        if found:
            yield at, found[0]
            at = found[1]
            continue
        data = window.get(at, min(_CHUNK, size - at))
        step = data.find(_MAGIC, 1)
        at += step if step > 0 else max(1, len(data) - 2)


def read(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives given as rows (archive, bytes), a task for every byte range."""
    ranges = archives.select("archive", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "record_type", "url", "refers_to", "payload_bytes", "payload_digest", "payload", "archive", "offset"]
        for batch in batches:
            for r in batch.itertuples(index=False):
                store, path = _filesystem(r.archive)
                rows, held = [], 0
                with store.open_input_file(path) as source:
                    for at, record in records_in(source, r.bytes, r.start, min(r.bytes, r.start + split_bytes)):
                        rows.append(parse(record) | {"archive": r.archive, "offset": at})
                        held += len(record)
                        if held > 4 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    # a row is a range of split_bytes, so tasks are counted by ranges, not by the size of these rows
    n = archives.agg(F.coalesce(F.sum(F.ceil(F.greatest(F.col("bytes"), F.lit(1)) / F.lit(split_bytes))), F.lit(1))).first()[0]
    return ranges.repartition(int(n), "archive", "start").mapInPandas(run, RECORD)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    frame["payload_bytes"] = frame["payload_bytes"].astype("Int64")
    frame["offset"] = frame["offset"].astype("int64")
    return frame


def resolve(records: DataFrame) -> DataFrame:
    """Records with payload_bytes, and payload if the column is asked for, of what they refer to.
    Revisits of one response may be many: the join splits them, the responses are one row each."""
    responses = (records.where("record_type = 'response'").groupBy("payload_digest")
                 .agg(F.first("payload_bytes").alias("full_bytes")))
    responses = materialize(responses, "warcresponses").withColumnRenamed("payload_digest", "same")
    joined = records.join(responses, F.col("payload_digest") == F.col("same"), "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "full_bytes")).drop("same", "full_bytes")


def folder(spark: SparkSession) -> str:
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


def query(spark, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    archives = write(plan(pages.select("page_id", "url", "html")), folder(spark))
    kind = pages.schema["page_id"].dataType
    # the payloads are read and digested in the tasks; what goes on is the index of the records
    index = materialize(read(archives).drop("payload"), "warcindex")
    return resolve(index).select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                                 "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE octet_length(b) >= 100 GROUP BY payload_digest)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND octet_length(b) >= 100
"""
