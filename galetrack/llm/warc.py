"""WARC archives of pages, and the merge of their indexes.

Pages become WARC 1.1 records. Of records with equal payloads the one with the
largest page id is a response; the others are revisits that name it. Partitions
sorted by URL key and time are written as archives, each a locally sorted capture
run; the archives are read back and every record is indexed from its own bytes.
The index rows of all runs are dealt by ranges of (URL key, time, page id), and
in each range the sorted runs are merged by a loser tree, which gives globally
ordered capture histories.

Archives are written and read by Spark's own text and binary sources, so they lie
in any store that Spark reaches. The text source ends each row with CRLF, which
is the second line end after a record's block.

Defined results: null html is an empty payload; payloads below ``least`` bytes are
never revisits; a null or malformed URL has its own text (or "") as key; a null
page id is written as empty and comes back null; rows with equal page ids and
payloads are one response and its revisits. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.llm.common import importable, map_rows, materialise, shared_dir

#: Fixed values of the format.
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages carry no time: a page's is this many seconds after the epoch, plus its id
#: (modulo ``SPAN``, which keeps years at four digits).
FIRST_SECOND, SPAN = 1_600_000_000, 4_000_000_000


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, then path and query, lower case."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "://" in text else f"//{text}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text.lower()
    labels = host.removeprefix("www.").split(".")
    key = ",".join(reversed(labels)) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (parts.path or "/")
    return (key + (f"?{parts.query}" if parts.query else "")).lower()


def one_line(value: str | None) -> str:
    """A header value: line ends and other controls as escapes."""
    return "".join([c if c >= " " else f"%{ord(c):02X}" for c in value or ""])


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """One record without the last CRLF, which the writer adds."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = [
        VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {one_line(url)}", f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "replace") + block + CRLF


def read_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError(f"no record at byte {at}")
        headers = {k: v for k, _, v in (line.partition(": ") for line in lines[1:])}
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != CRLF + CRLF:
            raise ValueError(f"the record at byte {at} is cut")
        yield at, stop + 4 - at, headers, data[start:stop]
        at = stop + 4


class LoserTree:
    """k-way merge of sorted iterators: each inner node keeps the loser of its match."""

    def __init__(self, runs: list[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            held = self.losers[node]
            if held == -1:
                self.losers[node] = winner
                return
            if self._beats(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


INDEX = "page_id long, urlkey string, ts long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def plan(pages: DataFrame) -> DataFrame:
    """Each page with its payload's digest and size, its URL key and its time."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def make():
        def step(rows):
            payloads = [h.encode("utf-8", "replace") for h in rows["html"]]
            return {
                "page_id": rows["page_id"], "url": rows["url"], "html": rows["html"],
                "digest": [digest(p) for p in payloads], "payload_bytes": [len(p) for p in payloads], "urlkey": [url_key(one_line(u)) for u in rows["url"]],
            }

        return step

    marked = map_rows(source, "page_id long, url string, html string, digest string, payload_bytes long, urlkey string", make)
    ts = F.lit(FIRST_SECOND) + F.coalesce(F.pmod("page_id", F.lit(SPAN)), F.lit(0))
    return marked.withColumn("ts", ts)


def decide(keyed: DataFrame, least: int = 0) -> DataFrame:
    """kind and refers_to of each row of page_id, digest, payload_bytes (and a unique ``row``).

    The response of a payload is its row with the largest (page_id, row): a
    maximum, so a payload of very many copies is reduced before the shuffle.
    """
    best = keyed.groupBy("digest").agg(F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"), "row")).alias("best"))
    # Written, so that both sides of the join are plain shuffles, which Spark splits at a very common payload.
    best = materialise(best, "warc-responses")
    joined = keyed.join(best, "digest")
    revisit = (F.col("payload_bytes") >= least) & (F.col("row") != F.col("best.row"))
    refers = F.when(revisit & (F.col("best.page_id") != -(1 << 63)), F.col("best.page_id"))
    return joined.select("row", F.when(revisit, "revisit").otherwise("response").alias("kind"), refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = 0, records_per_archive: int = 512) -> None:
    """Writes every page as a record into archives below ``path``, gzipped.

    A partition is a capture run, sorted by URL key, time and id; it is written
    as consecutive archives of at most ``records_per_archive`` records. They are
    packed at the fastest level: the usual one takes four times the time for a
    tenth fewer bytes.
    """
    spark = pages.sparkSession
    # The rows, once: their order numbers stay as written.
    staged = shared_dir(spark, "warc-pages")
    plan(pages).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(staged)
    rows = spark.read.parquet(staged)
    kinds = decide(rows.select("page_id", "digest", "payload_bytes", "row"), least)
    joined = rows.join(kinds, "row").sortWithinPartitions("urlkey", "ts", "page_id", "row")
    date = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    source = joined.select("page_id", "url", "html", "digest", "kind", "refers_to", date.alias("date"))

    def make():
        def step(rows):
            names = ("page_id", "url", "html", "digest", "kind", "refers_to", "date")
            made = [record(i, u, h.encode("utf-8", "replace"), d, k, r, t) for i, u, h, d, k, r, t in zip(*[rows[n] for n in names])]
            return {"value": [m.removesuffix(CRLF) + CRLF for m in made]}

        return step

    records = map_rows(source, "value binary", make, rows=512).select(F.col("value").cast("string").alias("value"))
    packed = records.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_archive).text(path)


def read_archives(spark, path: str) -> DataFrame:
    """The index of all archives below ``path``: a row per record, from its bytes.

    Archives are dealt as whole files; a file holds a bounded number of records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def make():
        def step(rows):
            out = []
            for name, content in zip(rows["path"], rows["content"]):
                data = zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content
                last = None
                for offset, length, headers, block in read_records(data):
                    page_id = headers["WARC-Record-ID"][len("<urn:page:") : -1]
                    kind, sha = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    head, _, payload = block.partition(CRLF + CRLF)
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (len(payload) != size or digest(payload) != sha):
                        raise ValueError(f"{name}: the payload at byte {offset} doesn't match its digest")
                    refers = headers.get("WARC-Refers-To", "<urn:page:>")[len("<urn:page:") : -1]
                    place = (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"])
                    if last is not None and place < last:
                        raise ValueError(f"{name}: the run falls at byte {offset}")
                    last = place
                    out.append((int(page_id) if page_id else None, *place, size, sha, kind, int(refers) if refers else None, name, offset, length))
            names = ("page_id", "urlkey", "date", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length")
            return {n: [o[i] for o in out] for i, n in enumerate(names)}

        return step

    schema = INDEX.replace("ts long", "date string")
    found = map_rows(files, schema, make, rows=1)
    return found.withColumn("ts", F.unix_timestamp(F.to_timestamp("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"))).select(*[f.split()[0] for f in INDEX.split(", ")])


def merge_indexes(index: DataFrame, rows_per_range: int = 50_000) -> DataFrame:
    """All runs' rows in order of (urlkey, ts, page_id), with ``range`` and ``place`` in it.

    Ranges split even one URL's captures, since time and id are part of the key.
    Within a range the rows of each archive arrive sorted and a loser tree merges
    them; only that range's narrow index rows are held.
    """
    spark = index.sparkSession
    importable(spark)
    from pyspark.sql.pandas.types import to_arrow_schema

    # Written, so that counting rows and choosing ranges don't read the archives again.
    index = materialise(index.select(*[f.split()[0] for f in INDEX.split(", ")]), "warc-index")
    parts = max(1, -(-index.count() // rows_per_range))
    key = ("urlkey", "ts", "page_id")
    dealt = index.repartitionByRange(parts, *key).sortWithinPartitions("archive", "offset")
    schema = spark.createDataFrame([], INDEX + ", range int, place long").schema
    arrow = to_arrow_schema(schema)
    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        runs: dict[str, list] = {}
        for b in batches:
            for row in zip(*[b.column(n).to_pylist() for n in names]):
                page_id = row[0]
                runs.setdefault(row[7], []).append(((row[1], row[2], -(1 << 63) if page_id is None else page_id, row[7], row[8]), row))
        merged = list(LoserTree([runs[a] for a in sorted(runs)]))
        for at in range(0, len(merged), 10_000):
            rows = [(*r[1], part, at + i) for i, r in enumerate(merged[at : at + 10_000])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes, reads back and merges: a row per page, in capture order."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    merged = merge_indexes(read_archives(pages.sparkSession, path))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "ts", "offset", "length", "range", "place")
