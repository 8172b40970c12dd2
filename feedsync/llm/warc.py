"""Deterministic sharded WARC writer and its reader (operator 4).

Records are range-sorted by page id into shards whose bounds come from an exact
histogram of payload bytes over 65,536 equal slices of the id range, repeated between
the lowest and the highest id of a slice that holds too much, so the same pages give
the same archives on any cluster.  Rows without page id spread over as many shards as
their bytes fill by a hash of url and html; only rows of one id, or alike in both, stay
together whatever their size.  A task streams one shard in order,
regenerates headers and digests, closes a file when its compressed size passes
``roll_bytes`` and returns manifest rows (:mod:`feedsync.llm.sharded_files`
commits them).  Every record is a gzip member of its own.

Equal payloads of at least ``min_revisit`` bytes are stored once, with the
smallest page id; the others become revisit records.  Which page refers to which
is found by a pre-aggregated count of payload digests, and these few rows are
merged into the sorted stream ahead of their page, so the html is shuffled once.

Defined results: null html is an empty payload; a row without page id is always a
response and counts towards no group; of rows that repeat id and payload the first
is the response and the rest revisit it; an empty table gives an empty archive;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import staged, work_path
from feedsync.llm.sharded_files import MANIFEST, Attempt, commit, file_system, manifest_batch

SLICES = 65_536
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def shard_table(pages: DataFrame, shard_bytes: int | None) -> tuple[DataFrame, float, float, int, int]:
    """(slice -> first shard and the ids at which further shards start in it, lowest id,
    slice width, number of shards, shards of the rows without id)."""
    spark = pages.sparkSession
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long") + 512
    nameless = F.sum(F.when(F.col("page_id").isNull(), size))
    lo, hi, total, unnamed = pages.agg(F.min("page_id"), F.max("page_id"), F.sum(size), nameless).first()
    lo, hi, total, unnamed = float(lo or 0), float(hi or 0), int(total or 0), int(unnamed or 0)
    target = shard_bytes or min(max(total // 2048, 32 << 20), 1 << 30)
    width = max(1.0, (hi - lo + 1) / SLICES)
    rows = pages.filter("page_id IS NOT NULL").select(
        F.floor((F.col("page_id").cast("double") - lo) / width).cast("int").alias("s"),
        F.col("page_id").cast("long").alias("id"),
        size.alias("size"),
    )
    ends = [F.min("id").alias("a"), F.max("id").alias("b"), F.sum("size").alias("n")]
    found = rows.groupBy("s").agg(*ends).collect()
    leaves = []
    while True:  # ranges that hold too much are cut at their own lowest and highest id
        full = [r for r in found if r["n"] > target and r["a"] < r["b"]]
        leaves += [(r["a"], r["s"], r["n"]) for r in found if not (r["n"] > target and r["a"] < r["b"])]
        if not full:
            break
        fan = max(2, min(SLICES, (1 << 20) // len(full)))
        cuts = [(r["s"], r["a"], r["b"], -(-(r["b"] - r["a"] + 1) // fan)) for r in full]
        table = F.broadcast(spark.createDataFrame(cuts, "s int, lo long, hi long, step long"))
        part = F.expr("(id - lo) div step").alias("part")
        found = rows.join(table, "s").filter("id BETWEEN lo AND hi").groupBy("s", "lo", part).agg(*ends).collect()
    nulls = max(1, -(-unnamed // target))
    shard, filled = (nulls, 0) if nulls > 1 else (0, unnamed)
    firsts, bounds = {}, {}
    for a, s, n in sorted(leaves):
        if filled and filled + n > target:
            shard, filled = shard + 1, 0
            if s in firsts:
                bounds[s].append(a)
        filled += n
        if s not in firsts:
            firsts[s], bounds[s] = shard, []
    table = [(s, first, bounds[s]) for s, first in firsts.items()] or [(0, 0, [])]
    schema = "__slice int, __first long, __bounds array<long>"
    return spark.createDataFrame(table, schema), lo, width, max(shard + 1, nulls), nulls


def _record_id(page_id, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}|{digest}|{nth}'.encode()).digest()[:16], version=5)}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, date: str, refers_to=None, revisit: bool = False, nth: int = 0) -> bytes:
    """One response or revisit record, header and digests regenerated."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    uri = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, nth)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Length", len(payload)),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", page_id))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest, 0))]
        fields.append(("X-Refers-To-Page-Id", refers_to))
    return _record(fields, block)


class _RollingFile:
    """Files of one shard, each closed once its compressed size passes the limit."""

    def __init__(self, attempt: Attempt, shard: int, roll_bytes: int, date: str):
        self.attempt, self.shard, self.roll_bytes, self.date = attempt, shard, roll_bytes, date
        self.seq, self.file, self.rows = 0, None, []

    def _member(self, record: bytes) -> None:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = z.compress(record) + z.flush()
        self.file.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def write(self, record: bytes) -> None:
        if self.file is None:
            self.name = f"shard-{self.shard:07d}/part-{self.seq:05d}.warc.gz"
            self.temporary, self.file = self.attempt.open(self.name.replace("/", "-"))
            self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
            info = f"software: feedsync\r\nformat: WARC File Format 1.1\r\nshard: {self.shard}\r\n".encode()
            fields = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", _record_id("warcinfo", self.name, 0)),
                ("WARC-Date", self.date),
                ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"),
            ]
            self._member(_record(fields, info))
        self._member(record)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.rows.append(
                (self.shard, self.seq, self.name, self.temporary, self.bytes, self.records, self.sha.hexdigest())
            )
            self.seq, self.file = self.seq + 1, None


def write_warc(
    pages: DataFrame,
    out: str | None = None,
    shard_bytes: int | None = None,
    roll_bytes: int | None = None,
    min_revisit: int = 100,
    date: str = "2024-01-01T00:00:00Z",
) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html) below ``out``; returns the folder and the
    manifest of its files.  Without ``shard_bytes`` a shard holds a 2048th of all
    payload bytes, 32 MB at least and 1 GB at most."""
    spark = pages.sparkSession
    out = out or work_path(spark, "warc")
    pages = pages.select("page_id", "url", "html")
    table, lo, width, shards, nulls = shard_table(pages, shard_bytes)
    roll = roll_bytes or max(4 << 20, (shard_bytes or 32 << 20) // 8)

    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keys = pages.filter((F.length(payload) >= min_revisit) & F.col("page_id").isNotNull()).select(
        "page_id", F.sha2(payload, 256).alias("__digest")
    )
    kept = keys.groupBy("__digest").agg(F.min("page_id").alias("__keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    refers = staged(keys.join(kept, "__digest").select("page_id", "__digest", "__keep").distinct(), "warc-refers")

    id_type = pages.schema["page_id"].dataType
    null = lambda kind: F.lit(None).cast(kind)
    stream = pages.select(
        "page_id", F.lit(1).alias("__tag"), null("string").alias("__digest"), null(id_type).alias("__keep"), "url", "html"
    ).unionByName(
        refers.select(
            "page_id",
            F.lit(0).alias("__tag"),
            "__digest",
            "__keep",
            null("string").alias("url"),
            null("string").alias("html"),
        )
    )
    at = (F.col("page_id").cast("double") - lo) / width
    further = F.size(F.filter("__bounds", lambda b: b <= F.col("page_id")))
    spread = F.pmod(F.xxhash64("url", "html"), F.lit(nulls))
    sorted_ = (
        stream.withColumn("__slice", F.floor(at).cast("int"))
        .join(F.broadcast(table), "__slice", "left")
        .withColumn("__shard", F.coalesce(F.col("__first") + further, spread).cast("int"))
        .select("__shard", "page_id", "__tag", "__digest", "__keep", "url", "html")
        .repartitionById(shards, F.col("__shard"))
        .sortWithinPartitions("__shard", "page_id", "__tag", "url", "html")
    )

    def write(batches):
        attempt, file, page, keepers, seen = Attempt(out), None, None, {}, {}
        for b in batches:
            for shard, page_id, tag, digest, keep, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if file is None or file.shard != shard:
                    if file:
                        file.close()
                        yield manifest_batch(file.rows)
                    file = _RollingFile(attempt, shard, roll, date)
                if page_id != page or page_id is None:
                    page, keepers, seen = page_id, {}, {}
                if tag == 0:
                    keepers[digest] = keep
                    continue
                body = (html or "").encode()
                refers_to, nth = None, 0
                if keepers:
                    digest = hashlib.sha256(body).hexdigest()
                    nth = seen[digest] = seen.get(digest, -1) + 1
                    keep = keepers.get(digest)
                    if keep is not None and (keep != page_id or nth):
                        refers_to = keep
                file.write(page_record(page_id, url, body, date, refers_to, refers_to is not None, nth))
        if file:
            file.close()
            yield manifest_batch(file.rows)

    return out, commit(sorted_.mapInArrow(write, MANIFEST), out)


def records(stream, chunk: int = 1 << 20):
    """(header fields, block) of each record of an archive, member by member."""
    data = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            data = data or stream.read(chunk)
            if not data:
                if parts or z.unconsumed_tail:
                    raise ValueError("archive ends inside a record")
                return
            parts.append(z.decompress(data))
            data = z.unused_data
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(manifest: DataFrame, out: str) -> DataFrame:
    """One row per page record of the archives that ``manifest`` names; digests are
    recomputed and compared with the headers."""

    def parse(batches):
        system, root = file_system(out)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
            )

        for b in batches:
            for name in b.column("name").to_pylist():
                rows = []
                with system.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for fields, block in records(f):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise ValueError(f"{name}: block digest of {fields['WARC-Record-ID']} differs")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if digest != hashlib.sha256(payload).hexdigest():
                                raise ValueError(f"{name}: payload digest of {fields['WARC-Record-ID']} differs")
                        page, other = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                        rows.append(
                            (
                                int(page) if page else None,
                                int(fields["X-Payload-Length"]),
                                digest,
                                kind,
                                int(other) if other else None,
                            )
                        )
                        if len(rows) == 10_000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    files = manifest.select("name")
    # a task for each file: their rows are too small for Spark to see the work behind them
    return files.repartition(max(1, files.count())).mapInArrow(parse, schema)
