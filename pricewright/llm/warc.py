"""WARC archives of pages, and an index of captures made by external merging.

Writing: a record per page, each payload stored once; equal payloads point to the page with the smallest id.  Spark's
text writer makes the archives, with the record terminator for a line end, so they go wherever Spark can write.
Reading: Spark hands over whole archives, of bounded size, and records are cut by their Content-Length.
Index: every archive gives a run of captures sorted by URL key and timestamp; spans of keys gather their slice of all
runs, and a loser tree merges the slices.  The spans in order are the global order.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewright.session import materialise, new_table_path

ARCHIVE_BYTES = 8 << 20  # payload of an archive on average
SPAN_ROWS = 50_000  # captures of a span of the index on average
RUN_ROWS = 100_000  # captures that are sorted at once
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CAPTURE = ["url_key", "date", "id", "record_type", "refers_to", "payload_bytes", "payload_digest", "offset", "archive"]
_ORDER = ["url_key", "date", "id", "archive", "offset"]
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 160 bits are 32 characters, five bits each, without padding."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * k, 10), 16, 2), 40, "0") for k in range(4)])
    return F.concat(*[F.lit(_ALPHABET).substr(F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   date: Column | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes a WARC record per page under ``path``, in archives of about ``archive_bytes``: a record that passes that is the last of its archive.

    Of records with equal payloads of at least ``least`` bytes, that with the smallest id is a response and the others
    are revisits that name it and hold no payload.  Null payloads are empty; null or empty URLs become ``urn:page:<id>``;
    line ends and blanks in a URL are percent-encoded.  Rows without an id are left out; of rows with one id, equal payloads
    refer to that id like others.  ``date`` gives the capture time, by default as many seconds after 2020 as the id says.
    """
    clean = pages.where(F.col(id_col).isNotNull())
    stamp = date if date is not None else F.timestamp_seconds(F.lit(1577836800) + F.pmod(F.col(id_col).cast("long"), F.lit(10 ** 9)))
    body = F.coalesce(F.col(payload_col), F.lit(""))
    keyed = clean.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"),
                         F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), F.octet_length(body).cast("long").alias("bytes"),
                         F.sha1(body.cast("binary")).alias("hex"))
    sums = materialise(keyed.select("id", "hex", "bytes"), "payload-sums")
    firsts = sums.where(F.col("bytes") >= least).groupBy("hex", "bytes").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Only copies are joined back, from a written table whose size Spark knows: few of them leave the payloads where they are.
    copies = materialise(sums.join(firsts, ["hex", "bytes"]).where("id <> first").select("id", "hex", "first").distinct(), "payload-copies")
    rows = keyed.join(copies, ["id", "hex"], "left").withColumn("digest", base32(F.col("hex")))
    copy = F.col("first").isNotNull() & (F.col("first") != F.col("id"))
    plain = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    uri = F.when(plain == "", F.concat(F.lit("urn:page:"), F.col("id").cast("string"))).otherwise(plain)
    name = lambda i: F.concat(F.lit("<urn:page:"), i.cast("string"), F.lit(">"))
    content = F.when(copy, F.lit("")).otherwise(F.col("body"))
    header = F.concat_ws("\r\n", F.lit("WARC/1.1"),
        F.when(copy, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))), F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Date: "), F.col("date")), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(copy, F.concat(F.lit(f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), name(F.col("first")))),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string")), F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(content).cast("string")), F.lit(""), content)
    filled = _numbered(rows.select(header.cast("binary").alias("value")), archive_bytes)
    filled.select(F.col("value").cast("string"), "number").write.partitionBy("number").option("lineSep", "\r\n\r\n").text(path)


def _numbered(rows: DataFrame, archive_bytes: int) -> DataFrame:
    """Adds the number of a task's archive: the next one begins once ``archive_bytes`` are in the present one."""
    def run(batches):
        number = size = 0
        for batch in batches:
            numbers = []
            for n in pc.binary_length(batch.column(0)).to_pylist():
                if size >= archive_bytes:
                    number, size = number + 1, 0
                size += n
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int32())], names=["value", "number"])

    return rows.mapInArrow(run, "value binary, number int")


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields in lower case, content) of each record; anything else is an error."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:stop].decode("utf-8").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = stop + 4
        end = start + int(fields["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, fields, data[start:end]
        at = end + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: id, url, date, record_type, refers_to, payload_bytes, payload_digest, archive, offset (and payload).

    A response's length and digest are taken from its content and must equal what its header says; a revisit has those
    of the payload it refers to, from its header.
    """
    names = ["id", "url", "date", "record_type", "refers_to", "payload_bytes", "payload_digest", "archive", "offset"] + ["payload"] * with_payload

    def number(text: str | None) -> int | None:
        return int(text.removeprefix("<urn:page:").removesuffix(">")) if text else None

    def run(batches):
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, fields, content in records(data.as_py()):
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(fields["x-payload-length"])
                    if kind == "response" and (len(content) != size or base64.b32encode(hashlib.sha1(content).digest()).decode() != digest):
                        raise ValueError(f"the payload at byte {offset} of {archive} is damaged")
                    row = (number(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-date"], kind, number(fields.get("warc-refers-to")), size, digest, archive, offset)
                    rows.append(row + ((content if kind == "response" else None),) * with_payload)
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = "id long, url string, date string, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, offset long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, schema + (", payload binary" if with_payload else ""))


def url_key(url: Column) -> Column:
    """Sort-friendly form: lower-case host with its labels reversed and no www, then the rest, without scheme, port and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"(^www\d*\.)|(:\d+$)", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of a match, so the next row costs one match per level."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        n = max(1, len(self.runs))
        self.nodes = [-1] * n
        for run in range(len(self.runs)):
            self._play(run)

    def _less(self, a: int, b: int) -> bool:
        """Whether run ``a`` gives the next row before run ``b``; finished runs lose, ties go to the earlier run."""
        one, other = self.heads[a], self.heads[b]
        if one is None or other is None:
            return other is None and (one is not None or a < b)
        return (one, a) < (other, b)

    def _play(self, run: int) -> None:
        at = (run + len(self.nodes)) // 2
        while at > 0:
            if self.nodes[at] < 0:
                self.nodes[at] = run
                return
            if self._less(self.nodes[at], run):
                self.nodes[at], run = run, self.nodes[at]
            at //= 2
        self.nodes[0] = run

    def __iter__(self):
        while self.runs:
            run = self.nodes[0]
            head = self.heads[run]
            if head is None:
                return
            yield head
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def capture_index(found: DataFrame, span_rows: int = SPAN_ROWS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Captures in global order: span, position, url_key, date, id, record_type, refers_to, payload_bytes, payload_digest, offset, archive.

    ``found`` is what ``read_archives`` gives.  A task sorts the captures that it reads in runs of ``run_rows`` and sends them to
    the spans in slices; a span merges the slices of all runs.  ``span`` numbers the spans in order, ``position`` all
    captures from 0.  Spans are cut by URL key, date and id together, so a URL with very many captures is spread
    over several.  Captures equal in all of these are ordered by archive and offset.  No captures, no rows.
    """
    rows = materialise(found.withColumn("url_key", url_key(F.col("url"))).select("archive", *_CAPTURE[:-1]), "captures")
    count = rows.count()
    spans = max(1, math.ceil(count / span_rows))
    sample = rows.where(F.rand(11) < min(1.0, 16 * spans / max(1, count))).select("url_key", "date", "id").collect() if spans > 1 else []
    sample = sorted(tuple(r) for r in sample)  # some 16 keys a span
    cuts = found.sparkSession.sparkContext.broadcast([sample[len(sample) * k // spans] for k in range(1, spans)] if sample else [])

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        run = pa.Table.from_batches(held).select(_CAPTURE).sort_by([(c, "ascending") for c in _ORDER])
        keys = list(zip(*(run.column(c).to_pylist() for c in ("url_key", "date", "id"))))
        edges = [0, *(bisect.bisect_left(keys, c) for c in cuts.value), len(keys)]
        slices = [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in slices], pa.int64()), pa.array([_packed(run.slice(a, b - a)) for _, a, b in slices], pa.binary())], names=["span", "run"])

    def runs_of_task(batches):
        held = []
        for batch in batches:
            for a in range(0, batch.num_rows, run_rows):
                held.append(batch.slice(a, run_rows))
                if sum(b.num_rows for b in held) >= run_rows:
                    yield cut(held)
                    held = []
        if held:
            yield cut(held)

    def merge(group: pa.Table) -> pa.Table:
        runs = [pa.ipc.open_stream(r).read_all() for r in group.column("run").to_pylist()]
        whole = pa.concat_tables(runs)
        starts = np.cumsum([0, *(t.num_rows for t in runs)]).tolist()
        heads = [zip(*(t.column(c).to_pylist() for c in _ORDER), range(a, a + t.num_rows)) for t, a in zip(runs, starts)]
        order = [row[-1] for row in LoserTree(heads)]
        out = whole.take(pa.array(order, pa.int64()))
        span = group.column("span")[0].as_py()
        return pa.table({"span": np.full(len(order), span), "place": np.arange(len(order)), **{c: out.column(c) for c in _CAPTURE}})

    dealt = rows.mapInArrow(runs_of_task, "span long, run binary")
    merged = materialise(dealt.groupBy("span").applyInArrow(
        merge, "span long, place long, url_key string, date string, id long, record_type string, refers_to long, payload_bytes long, payload_digest string, offset long, archive string"), "capture-index")
    sizes = merged.groupBy("span").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # one row a span
    begins = sizes.select("span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    return merged.join(begins, "span").withColumn("position", F.col("begin") + F.col("place")).select("span", "position", *_CAPTURE)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def round_trip(pages: DataFrame, least: int = 0, **columns: str) -> DataFrame:
    """Writes the pages to a new folder of archives, reads the records back and gives their ``capture_index``."""
    path = new_table_path(pages.sparkSession, "warc")
    write_archives(pages, path, least=least, **columns)
    return capture_index(read_archives(pages.sparkSession, path))
