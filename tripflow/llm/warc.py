"""WARC archives of pages, and a global index of their captures.

Archives are written by Spark's text writer: a record is a line, and the two line ends that close a
WARC record are the line separator. So writing commits like any table and needs nothing but a
folder that Spark can write. Reading goes by the length each record declares, whatever it holds.

The index is an external merge. Each task that reads archives sorts its captures by URL key,
timestamp and id: a run. Ranges of the key, split within hot keys by time and id, receive their part
of every run, and a tree of losers merges the parts: the smallest capture wins, and replacing it
costs one comparison a level.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.tables import stored
from tripflow.llm.words import let
from tripflow.session import fresh_dir

# Records of one archive file: a file is read into memory whole.
RECORDS_PER_FILE = 1000
# Rows, under 100 bytes each, of repeated payloads that are sent to every executor.
SENT_ROWS = 200_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_EPOCH = "2020-01-01 00:00:00"
_LINE = "\r\n"


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits hold four base32 digits."""

    def group(digits: Column) -> Column:
        value = F.conv(digits, 16, 10).cast("int")
        return F.concat(*(F.substring(F.lit(_BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)))

    return let(F.sha1(payload.cast("binary")), lambda h: F.concat(*(let(F.substring(h, 5 * i + 1, 5), group) for i in range(8))))


def _header(*fields: tuple[str, Column]) -> Column:
    """Header lines of the fields that are not null."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_LINE)), F.lit("")) for name, value in fields]
    return F.concat(*lines)


def _line_safe(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    date_column: str | None = None,
    min_bytes: int = 0,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per row below ``path``.

    Of rows with equal payloads of ``min_bytes`` or more the one with the largest id is a response,
    the others revisit it without payload. A null payload is empty. Rows that repeat the largest id
    of their payload are responses all, and so are rows with a null id, which nothing can refer to.
    A null URL gives a record without target. Without a date column the capture time is the id in
    seconds from a fixed day. Other columns are not read. An empty table gives archives without
    records.
    """
    date = F.col(date_column) if date_column else F.timestamp_seconds(F.unix_timestamp(F.lit(_EPOCH).cast("timestamp")) + F.coalesce(F.col(id_column), F.lit(0)))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        _line_safe(F.col(url_column).cast("string")).alias("url"),
        F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("html"),
        F.date_format(F.to_utc_timestamp(date.cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", payload_digest(F.col("html")))
    shared = (
        rows.where((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("original")).where("n > 1").select("digest", "original")
    )
    shared = stored(shared, "warc-payloads")
    # Only repeated payloads: their table is counted before it is sent.
    shared = F.broadcast(shared) if shared.count() <= SENT_ROWS else shared
    rows = rows.join(shared, "digest", "left")
    revisit = (F.col("page_id") < F.col("original")) & (F.col("bytes") >= min_bytes)
    rows = rows.withColumn("refers_to", F.when(revisit, F.col("original")))
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(_LINE * 2))
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("html"))
    length = F.octet_length(http) + F.octet_length(body)

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))

    head = _header(
        ("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", urn(F.col("refers_to"))),
        ("WARC-Profile", F.when(is_revisit, F.lit(_PROFILE))),
        ("X-Payload-Length", F.col("bytes").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length.cast("string")),
    )
    records = rows.select(F.concat(F.lit(f"WARC/1.1{_LINE}"), head, F.lit(_LINE), http, body).alias("value"))
    (
        records.write.option("lineSep", _LINE * 2).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header, block) of the records of an uncompressed archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split(_LINE)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        header = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(header["content-length"])
        yield at, stop - at, header, content[start:stop]
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        at = stop + 4


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, lower-cased, without scheme, www., port and fragment."""
    if not url:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0].lower()
    host, slash, path = rest.partition("/")
    host = re.sub(r":\d+$", "", host.rpartition("@")[2])
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + ")" + (slash + path if slash else "/")


_COLUMNS = (
    "url_key string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, offset long, length long, run string"
)
_NAMES, _TYPES = zip(*(c.split() for c in _COLUMNS.split(", ")), strict=True)


def _key(capture: tuple) -> tuple:
    """Order of the index; a null id comes first."""
    return capture[0], capture[1], -1 if capture[2] is None else capture[2], capture[8], capture[9]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _capture(file: str, offset: int, length: int, header: dict[str, str], block: bytes) -> tuple:
    payload = block.split(b"\r\n\r\n", 1)[1]
    declared = header["warc-payload-digest"].removeprefix("sha1:")
    kind = header["warc-type"]
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != declared or len(payload) != int(header["x-payload-length"]):
            raise ValueError(f"{file}: the payload at byte {offset} isn't the one that was written")
    url = header.get("warc-target-uri")
    stamp = re.sub(r"\D", "", header["warc-date"])
    return (
        url_key(url), stamp, _number(header["warc-record-id"]), url, int(header["x-payload-length"]), declared, kind,
        _number(header.get("warc-refers-to")), file, offset, length, file,
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of each archive, sorted: one run."""
    for batch in batches:
        for i in range(batch.num_rows):
            name = batch.column("path")[i].as_py().rpartition("/")[2]
            packed = batch.column("content")[i].as_py()
            content = zlib.decompress(packed, 47) if packed else b""
            yield _batch(sorted((_capture(name, *record) for record in read_records(content)), key=_key))


def merge_runs(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Sorted runs as one, by a tree of losers.

    Leaf i is run i; an inner place holds the run that lost the match there. After the winner's
    next row came up only the matches on its way to the top are played again.
    """
    k = len(runs)
    if not k:
        return
    at = [0] * k
    keys = [_key(r[0]) if r else None for r in runs]

    def beats(a: int, b: int) -> bool:
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    losers = [0] * k

    def play(place: int) -> int:
        """Winner below an inner place."""
        stack, won = [(place, False)], {}
        while stack:
            p, ready = stack.pop()
            if p >= k:
                won[p] = p - k
            elif ready:
                a, b = won.pop(2 * p), won.pop(2 * p + 1)
                won[p], losers[p] = (a, b) if beats(a, b) else (b, a)
            else:
                stack += [(p, True), (2 * p, False), (2 * p + 1, False)]
        return won[place]

    winner = play(1) if k > 1 else 0
    while keys[winner] is not None:
        yield runs[winner][at[winner]]
        at[winner] += 1
        keys[winner] = _key(runs[winner][at[winner]]) if at[winner] < len(runs[winner]) else None
        place = (winner + k) // 2
        while place >= 1 and k > 1:
            if beats(losers[place], winner):
                winner, losers[place] = losers[place], winner
            place //= 2


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of keys: its part of every run, merged."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(row[-1], []).append(row)
    for run in runs.values():
        # Parts of a run arrive in order, unless a block was fetched out of turn.
        run.sort(key=_key)
    held: list[tuple] = []
    for row in merge_runs([runs[name] for name in sorted(runs)]):
        held.append(row)
        if len(held) == 10_000:
            yield _batch(held)
            held = []
    yield _batch(held)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """Captures of the archives below ``path``, globally ordered by URL key, timestamp, id and place:
    each partition is in order, and all of it before the next.

    Columns as in ``_COLUMNS``: ``payload_bytes`` and ``payload_digest`` are of the full payload;
    those of responses are recomputed while reading, and a difference is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = stored(files.mapInArrow(_runs, _COLUMNS), "warc-runs")
    # Ranges split hot keys by time and id; the number of ranges is the session's.
    parts = runs.repartitionByRange("url_key", "timestamp", "page_id")
    return parts.mapInArrow(_merged, _COLUMNS)


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the pages as archives, by default to the shared folder, and return their index."""
    spark = pages.sparkSession
    path = path or fresh_dir(spark, "warc")
    write_archives(pages, path, **options)
    return capture_index(spark, path)
