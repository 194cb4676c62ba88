"""WARC archives: written by tasks, read back as locally sorted capture runs, merged into one ordered index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemart.llm.common import arrow_input, scratch_path, written

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
YEARS = 7000 * 365 * 86_400  #: capture dates made from ids stay within these seconds after EPOCH
ROLL_BYTES, ROLL_RECORDS = 512 << 20, 50_000  #: an archive is closed beyond either
FAN_IN, STREAM_ROWS, BATCH_ROWS = 128, 512, 10_000  #: runs merged at once, captures held of each, and of the output
GROUP_BYTES = 1 << 20  #: of a row group of a run
RANGE_ROWS, SMALL_RANGE, SAMPLED = 2_000_000, 5_000, 50  #: captures of a range at most (about) and at least; sampled of each


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def capture_date(page_id: int | None) -> str:
    return (EPOCH + timedelta(seconds=(page_id or 0) % YEARS)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str | None) -> str:
    """A sort-friendly key: host labels from the right, then ``)`` and the rest; empty for no URL."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return url or ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:].partition("#")[0]


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response with the payload, or a revisit of ``refers_to`` with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    name = "" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {capture_date(page_id)}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=6, mtime=0)


def read_records(stream: io.RawIOBase) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of a ``.warc.gz``, one gzip member in memory at a time."""
    at, held = 0, b""
    while True:
        held = held or stream.read(1 << 20)
        if not held:
            return
        member, size, parts = zlib.decompressobj(31), 0, []
        while True:
            parts.append(member.decompress(held))
            size += len(held) - len(member.unused_data)
            held = member.unused_data
            if member.eof:
                break
            held = stream.read(1 << 20)
            if not held:
                raise EOFError("the archive ends within a record")
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        yield at, size, headers, rest[: int(headers["Content-Length"])]
        at += size


class LoserTree:
    """Merges k sorted sources: inner nodes hold the losers of their matches, so each step replays one path to the root."""

    def __init__(self, sources: Iterable[Iterable], key):
        self.sources, self.key = [iter(s) for s in sources], key
        self.k = len(self.sources)
        self.heads = [self._next(i) for i in range(self.k)]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._seat(i)

    def _next(self, i: int):
        """(0, key, source, item), or (1,) after the last: sorts behind all others; equal keys go by source."""
        item = next(self.sources[i], None)
        return (1,) if item is None else (0, self.key(item), i, item)

    def _beats(self, a: int, b: int) -> bool:
        return self.heads[a][:3] < self.heads[b][:3]

    def _seat(self, i: int) -> None:
        """Bring leaf i up while the tree is built: it waits at the first node nobody has come to yet."""
        node = (i + self.k) // 2
        while node:
            if self.tree[node] < 0:
                self.tree[node] = i
                return
            if self._beats(self.tree[node], i):
                i, self.tree[node] = self.tree[node], i
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        if not self.k:
            return
        while True:
            winner = self.tree[0]
            head = self.heads[winner]
            if head[0]:
                return
            yield head[3]
            self.heads[winner] = self._next(winner)
            node = (winner + self.k) // 2
            while node:
                if self._beats(self.tree[node], winner):
                    winner, self.tree[node] = self.tree[node], winner
                node //= 2
            self.tree[0] = winner


def _open(uri: str, write: bool = False):
    """A stream in the shared folder, local or remote."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    if not write:
        return where.open_input_stream(path)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path)


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write a record per page under ``folder``; returns the manifest (archive, records, bytes).

    Of pages whose equal payloads have at least ``min_bytes`` bytes, the one with the largest id is a response and the
    others revisit it; rows that repeat that id with that payload are responses too. A task that runs again writes
    archives with other names; only those that the manifest, a committed table, lists count.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    base = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1")
    )
    shared = (
        base.where(F.length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("id").alias("latest"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    shared = written(shared, "payloads")  # so that Spark may split a payload with many pages in the join
    told = base.join(shared, "sha1", "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("latest")), F.col("latest")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, n, size = None, "", 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, raw, refers_to = (batch.column(i)[row].as_py() for i in range(4))
                if out is None:
                    name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = _open(name, write=True)
                member = record(page_id, url, raw, refers_to)
                out.write(member)
                n, size = n + 1, size + len(member)
                if n >= ROLL_RECORDS or size >= ROLL_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"archive": [name], "records": [n], "bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [n], "bytes": [size]})

    return written(arrow_input(told).mapInArrow(run, "archive string, records long, bytes long"), "manifest")


CAPTURE = [
    ("url_key", "string"),
    ("captured", "string"),
    ("url", "string"),
    ("record_type", "string"),
    ("payload_bytes", "long"),
    ("payload_digest", "string"),
    ("refers_to", "long"),
    ("archive", "string"),
    ("offset", "long"),
    ("length", "long"),
]


def _tasks(spark: SparkSession, n: int) -> DataFrame:
    """(id) from 0 to ``n`` - 1, one to a task; nothing shuffles or joins the tasks."""
    return spark.range(0, n, 1, n)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(f.dataType.simpleString(), pa.int64())) for c, f in zip(columns, schema, strict=True)], names=schema.names
    )


def _batches(rows: Iterable[tuple], schema: T.StructType, size: int) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield _batch(some, schema)


def key_of(row: tuple) -> tuple:
    """URL key, capture date and id (null first), then the record's place, so that no two captures have equal keys."""
    return row[1], row[2], row[0] is not None, row[0] or 0, row[8], row[9]


def read_runs(manifest: DataFrame, id_name: str) -> DataFrame:
    """Read the archives, each response's payload checked against its digest: a task, and a file, is one sorted run.

    An archive has at most ROLL_RECORDS records, so its captures are sorted in memory. Revisits hold no payload: their
    size and digest are compared with those of the response they refer to.
    """
    schema = T.StructType([T.StructField(id_name, T.LongType()), *(T.StructField(n, T._parse_datatype_string(k)) for n, k in CAPTURE)])
    number = lambda urn: int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None
    archives = sorted(r["archive"] for r in manifest.collect())  # a name for each ROLL_RECORDS pages

    def captures(archive: str) -> Iterator[tuple]:
        with _open(archive) as stream:
            for at, size, head, block in read_records(stream):
                http, _, payload = block.partition(b"\r\n\r\n")
                stated = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response" and (len(payload), digest_of(payload)) != (stated, digest):
                    raise ValueError(f"{archive}, byte {at}: the payload is not what its record says")
                url, refers_to = head.get("WARC-Target-URI"), number(head.get("WARC-Refers-To"))
                name = number(head["WARC-Record-ID"])
                yield name, url_key(url), head["WARC-Date"], url, head["WARC-Type"], stated, digest, refers_to, archive, at, size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                yield from _batches(sorted(captures(archives[n]), key=key_of), schema, BATCH_ROWS)

    runs = _run_files(_tasks(manifest.sparkSession, len(archives)).mapInArrow(run, schema))
    _check_revisits(runs, id_name)
    return runs


def _run_files(runs: DataFrame) -> DataFrame:
    """The runs in the shared folder, a file each, in small row groups, so that a merge can begin within one."""
    return written(runs, "runs", **{"parquet.block.size": str(GROUP_BYTES)})


def _check_revisits(runs: DataFrame, id_name: str) -> None:
    """Raise if a revisit states another size or digest than the response that it refers to, or refers to none."""
    what = ["payload_bytes", "payload_digest"]
    revisits = runs.where("record_type = 'revisit'").groupBy(F.col("refers_to").alias("_to"), *what).count()
    responses = runs.where("record_type = 'response'").select(F.col(id_name).alias("_to"), *what)
    lone = revisits.join(responses, ["_to", *what], "left_anti").limit(1).collect()
    if lone:
        raise ValueError(f"a revisit does not match the response it refers to: {lone[0]}")


def run_stream(path: str, low: tuple | None = None, high: tuple | None = None) -> Iterator[tuple]:
    """The captures of a run with low <= key < high, read a batch at a time from the row group where they begin."""
    from pyarrow import fs, parquet

    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as source:
        run = parquet.ParquetFile(source)
        first, groups = 0, run.num_row_groups
        if low is not None:  # the last group that starts before low
            a, b = 0, groups
            while b - a > 1:
                mid = (a + b) // 2
                start = next(run.iter_batches(1, [mid]))
                a, b = (mid, b) if key_of(next(zip(*start.to_pydict().values(), strict=True))) < low else (a, mid)
            first = a
        for batch in run.iter_batches(STREAM_ROWS, list(range(first, groups))):
            for row in zip(*batch.to_pydict().values(), strict=True):
                key = key_of(row)
                if high is not None and key >= high:
                    return
                if low is None or key >= low:
                    yield row


def stretch_stream(stretches: list[tuple], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The same of a run that lies in several files, each (its least key or None, the next file's or None, path)."""
    for first, after, path in stretches:
        if (high is None or first is None or first < high) and (low is None or after is None or low < after):
            yield from run_stream(path, low, high)


def write_run(folder: str, rows: Iterable[tuple], schema: T.StructType) -> str | None:
    """A run in a file of its own, row groups of BATCH_ROWS captures; None if it has no rows."""
    from pyarrow import parquet

    sink = writer = path = None
    for batch in _batches(rows, schema, BATCH_ROWS):
        if writer is None:
            path = f"{folder}/{uuid.uuid4().hex}.parquet"
            sink = _open(path, write=True)
            writer = parquet.ParquetWriter(sink, batch.schema)
        writer.write_batch(batch)
    if writer is not None:
        writer.close()
        sink.close()
    return path


def _ends(keys: list[tuple], parts: int) -> list[tuple]:
    """(low, high) of about so many ranges of keys, by a sorted sample of them."""
    cuts = sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def merge_runs(runs: DataFrame, id_name: str, fan_in: int | None = None, range_rows: int | None = None) -> DataFrame:
    """The runs as one index in order of URL key, capture date and id: ``position`` grows along it, and ``rank`` numbers
    the captures of a URL key from 1.

    An external merge: a loser tree pulls from the runs' files and holds a batch of each, the output leaves in batches.
    More than ``fan_in`` runs are first merged by groups, dealt evenly, into longer ones, as often as needed. In every
    pass a task merges a range of the keys of its group, found by sampling them, from the places in the files where it
    begins, so that each pass has as many tasks as the whole index asks for; a run of several ranges lies in as many
    files, and a task opens only those that its range meets. A frequent URL is spread over ranges by date, id and place.
    The names of a task's files reach it by a broadcast: one for ``ROLL_RECORDS`` captures or a range.
    """
    fan_in, range_rows, spark = fan_in or FAN_IN, range_rows or RANGE_ROWS, runs.sparkSession
    schema = runs.schema
    merging = [[(None, None, f)] for f in sorted(runs.inputFiles())]
    rows = runs.count()
    ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // SMALL_RANGE), -(-rows // range_rows))
    keys = []
    if ranges > 1:  # about SAMPLED keys a range
        keys = sorted(key_of(tuple(r)) for r in runs.sample(min(1.0, SAMPLED * ranges / rows), seed=1).collect())
    while len(merging) > fan_in:
        many = -(-len(merging) // fan_in)
        ends = _ends(keys, -(-ranges // many))
        tasks = spark.sparkContext.broadcast([(merging[g::many], *e) for g in range(many) for e in ends])
        folder = scratch_path(spark, "merged")

        def longer(batches: Iterator[pa.RecordBatch], tasks=tasks, folder=folder) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in batch.column(0).to_pylist():
                    group, low, high = tasks.value[n]
                    path = write_run(folder, LoserTree((stretch_stream(r, low, high) for r in group), key_of), schema)
                    if path:
                        yield pa.RecordBatch.from_pydict({"task": [n], "path": [path]})

        # a task that runs again writes another file; the committed table says which counts
        made = dict(written(_tasks(spark, many * len(ends)).mapInArrow(longer, "task long, path string"), "merges").collect())
        merging = [[(*e, made[at]) for k, e in enumerate(ends) if (at := g * len(ends) + k) in made] for g in range(many)]
        merging = [r for r in merging if r]

    out = T.StructType([*schema.fields, T.StructField("position", T.LongType()), T.StructField("seq", T.LongType())])
    ends = _ends(keys, ranges)
    whole = spark.sparkContext.broadcast(merging)

    def numbered(rows: Iterable[tuple], n: int) -> Iterator[tuple]:
        last, seq = None, 0
        for i, row in enumerate(rows):
            seq = seq + 1 if row[1] == last else 1
            last = row[1]
            yield (*row, (n << 40) + i, seq)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                merged = LoserTree((stretch_stream(r, *ends[n]) for r in whole.value), key_of)
                yield from _batches(numbered(merged, n), out, BATCH_ROWS)

    return _ranked(written(_tasks(spark, len(ends)).mapInArrow(last, out), "index"))


def _ranked(index: DataFrame) -> DataFrame:
    """``rank`` from the numbers within ranges: a URL that a range begins with may have captures in those before."""
    part = F.shiftright("position", 40)
    begun = index.where(F.col("position") == F.shiftleft(part, 40)).select("url_key").distinct()  # a row for each range
    sizes = index.join(F.broadcast(begun), "url_key", "left_semi").groupBy(part.alias("_part"), "url_key").agg(F.max("seq").alias("n"))
    earlier = Window.partitionBy("url_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.col("url_key").alias("_key"), F.sum("n").over(earlier).alias("_before")).where("_before is not null")
    met = index.join(F.broadcast(before), (part == F.col("_part")) & (F.col("url_key") == F.col("_key")), "left")
    rank = F.col("seq") + F.coalesce("_before", F.lit(0))
    return met.select(*[c for c in index.columns if c != "seq"], rank.alias("rank"))


def archive_index(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write the pages as archives, read them back and merge their runs into one ordered index.

    One row per page: id, url_key, captured, url, record_type, payload_bytes, payload_digest, refers_to, archive,
    offset, length, position, rank (its number in the history of its url_key, from 1). Integer ids. Null markup is an empty payload, a null URL or id is left out of the
    record's headers and comes back null; CR and LF in a URL are escaped; repeated rows each have a record; an empty
    table gives an empty index; other columns are not read. ``folder``: a URI all executors share (default: under
    ``spark.checkpoint.dir``).
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, min_bytes, id_col, url_col, html_col)
    index = merge_runs(read_runs(manifest, id_col), id_col)
    kind = pages.schema[id_col].dataType
    return index.withColumns({c: F.col(c).cast(kind) for c in (id_col, "refers_to")})


#: The same rows for DuckDB, without what depends on how the archives were cut.
SQL = """
with hashed as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h,
    case when instr(url, '://') > 0 then
      array_to_string(list_reverse(string_split(lower(regexp_extract(substring(url, instr(url, '://') + 3), '^([^/?#]*)', 1)), '.')), ',') || ')'
      || regexp_extract(substring(url, instr(url, '://') + 3), '(?s)^[^/?#]*([^#]*)', 1) else coalesce(url, '') end as url_key
  from pages
), latest as (
  select *, max(page_id) over (partition by h) as latest from hashed
), symbols as (
  select h, i, (cast('0x' || substring(h, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as bits
  from (select distinct h from hashed), range(32) as r(i)
), digests as (
  select h, string_agg(substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(bits as int) + 1, 1), '' order by i) as digest
  from symbols group by h
)
select page_id, url_key, strftime(timestamp '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') as captured,
  row_number() over (partition by url_key order by page_id) as rank, strlen(html)::bigint as payload_bytes, digest as payload_digest,
  case when page_id = latest then 'response' else 'revisit' end as record_type,
  case when page_id <> latest then latest end as refers_to
from latest join digests using (h)
"""
