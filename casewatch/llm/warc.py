"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Writing. Every record is a gzip member of its own. Spark's text writer puts them on any store that
Spark can write: a member's last byte is zero (the high byte of its length), so that byte serves as the
"line end" and the files are plain concatenations of members. Only digests and ids are compared to
find repeated payloads; pages travel compressed.

Reading. Files come as bytes, with or without compression. A record counts only if its member's
checksum, its lengths, its end mark and its digests are right. Where a check fails, the reader
looks for the next place at which a whole valid record starts, goes on there, and reports the bytes
between as a gap. In a member of many records a bad record costs itself alone: version lines are searched in
what the member yields. A member that is cut off or fails its checksum is a gap, but for records
in it whose own block digest is right. A file is read by one task, so the writer limits the records of a file.
"""

import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import functions as F

from casewatch.sources.workspace import fresh_path

LEAST_BYTES = 100  # smaller payloads are always stored
RECORDS_PER_FILE = 20_000
SALTS = 32
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
ENTRIES = (
    "path string, offset long, length long, kind string, reason string, record_type string, page_id long, uri string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _sha256(data):
    return hashlib.sha256(data).hexdigest()


def _urn(page_id):
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id, uri, payload, digest=None, length=None, refers_to=None):
    """Bytes of one record. With refers_to it is a revisit: digest and length tell of the payload left out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"\r\n" if refers_to is not None else http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(uri or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", "sha256:" + (digest or _sha256(payload))),
        ("WARC-Block-Digest", "sha256:" + _sha256(block)),
        ("X-Payload-Length", str(len(payload) if length is None else length)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + END


def member(data):
    """A gzip member that ends in a zero byte: nearly every one does, else an empty member follows."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    return out if out[-1] == 0 else out + member(b"")


def _unpack(data, start):
    """(content, end, reason) of the gzip member at start; if it is damaged or cut off, what it yields before, None, why."""
    unpacker, parts, at, step = zlib.decompressobj(31), [], start, CHUNK
    while not unpacker.eof:
        piece = data[at : at + step]
        if not piece:
            return b"".join(parts), None, "member is cut off"
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error as failure:
            if step == 1:
                return b"".join(parts), None, str(failure)
            # once more up to this piece, and through it byte by byte
            unpacker, parts, step = zlib.decompressobj(31), [], 1
            for before in range(start, at, CHUNK):
                parts.append(unpacker.decompress(data[before : before + CHUNK]))
            continue
        at += len(piece)
    return b"".join(parts), at - len(unpacker.unused_data), None


def _parse(data, start, digested=False):
    """(fields, block, end) of the uncompressed record at start; ValueError if a check fails.

    With digested, a record without a digest of its block does not count.
    """
    version = VERSION.match(data, start)
    if not version:
        raise ValueError("no version line")
    stop = data.find(END, start)
    if stop < 0:
        raise ValueError("header is cut off")
    fields = {}
    for line in data[version.end() : stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no length")
    first = stop + len(END)
    end = first + int(fields["content-length"])
    if data[end : end + len(END)] != END:
        raise ValueError("no end mark")
    block = data[first:end]
    kind, _, digest = fields.get("warc-block-digest", "").partition(":")
    if digested and kind != "sha256":
        raise ValueError("no digest")
    if kind == "sha256" and _sha256(block) != digest:
        raise ValueError("wrong digest")
    return fields, block, end + len(END)


def _inside(content, digested):
    """[(fields, block, reason), ...]: the records of a member's content, and None with a reason for what lies between."""
    found, at = [], 0
    while at < len(content):
        try:
            fields, block, at = _parse(content, at, digested)
            found.append((fields, block, None))
        except ValueError as failure:
            gap, at = at, len(content)
            for start in VERSION.finditer(content, gap + 1):
                try:
                    _parse(content, start.start(), digested)
                except ValueError:
                    continue
                at = start.start()
                break
            found.append((None, b"", f"{failure}: bytes {gap} to {at} of the member's content"))
    return found


def _at(data, pos):
    """([(fields, block, reason), ...], end, reason) of the member or record at pos; end is None if it is damaged."""
    if data[pos : pos + 2] == b"\x1f\x8b":
        content, end, reason = _unpack(data, pos)
        found = _inside(content, end is None)
        return (found if end is not None else [f for f in found if f[0] is not None]), end, reason
    try:
        fields, block, end = _parse(data, pos)
    except ValueError as failure:
        return [], None, str(failure)
    return [(fields, block, None)], end, None


STARTS = re.compile(rb"\x1f\x8b\x08|(?<=\n)WARC/\d")


def salvage(data):
    """Yields (offset, length, fields, block, reason) over a whole file; fields is None for a gap.

    Records and gaps inside a member have the member's offset and length. A damaged member goes up to the next valid
    member or record; it is a gap, and records in it that are right come behind that.
    """
    pos = 0
    while pos < len(data):
        found, end, reason = _at(data, pos)
        if end is None:
            end = len(data)
            for start in STARTS.finditer(data, pos + 1):
                records, valid, _ = _at(data, start.start())
                if records or valid is not None:
                    end = start.start()
                    break
            yield pos, end - pos, None, b"", reason
        for fields, block, why in found:
            yield pos, end - pos, fields, block, why
        pos = end


def _id(urn):
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(digits[1]) if digits else None


def _entry(path, offset, length, fields, block, reason, with_payload):
    if fields is None:
        return (path, offset, length, "gap", reason, None, None, None, None, None, None, None)
    kind = fields.get("warc-type")
    head, mark, payload = block.partition(END)
    if not (mark and head.startswith(b"HTTP/")):
        payload = block
    told = fields.get("warc-payload-digest", "").rpartition(":")[2]
    if kind == "revisit":
        size = int(fields["x-payload-length"]) if fields.get("x-payload-length", "").isdigit() else None
        digest, payload = told, None
    else:
        size, digest = len(payload), _sha256(payload)
        if told and fields["warc-payload-digest"].startswith("sha256:") and told != digest:
            return (path, offset, length, "gap", "wrong payload digest", None, None, None, None, None, None, None)
    return (
        path, offset, length, "record", None, kind, _id(fields.get("warc-record-id")), fields.get("warc-target-uri"),
        size, digest, _id(fields.get("warc-refers-to")), payload if with_payload else None,
    )


def read(spark, folder, with_payload=True):
    """One row per record and per gap of all files under folder (columns: ENTRIES)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(folder).select("path", "content")
    schema = spark.createDataFrame([], ENTRIES).schema
    names = schema.names
    kinds = [pa.int64() if f.dataType.typeName() == "long" else pa.binary() if f.name == "payload" else pa.string() for f in schema]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, data, rows, held = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), [], 0
                for found in salvage(data):
                    rows.append(_entry(path, *found, with_payload))
                    held += len(rows[-1][-1] or b"")
                    if len(rows) == 4096 or held > 1 << 24:
                        yield _batch(rows, kinds, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, kinds, names)

    return files.mapInArrow(run, schema)


def _batch(rows, kinds, names):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def repeated_payloads(pages, least=LEAST_BYTES):
    """digest, first: the smallest page_id of every payload of at least `least` bytes that several rows have."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    seen = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("bytes"))
    groups = seen.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return groups.filter("n > 1").select("digest", "first")


def write(pages, folder, least=LEAST_BYTES, records_per_file=RECORDS_PER_FILE):
    """Writes a record per row of pages (page_id, url, html) under folder, which must be new.

    Of rows with equal payloads of at least `least` bytes, those with the smallest page_id are responses,
    the others revisits of it. Null html is an empty payload; a null page_id is never referred to.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    schema = spark.createDataFrame([], "page_id long, url string, digest string, length long, packed binary").schema

    def pack(batches):
        for batch in batches:
            ids, urls, payloads, digests = (batch.column(i) for i in range(4))
            packed, lengths = [], []
            for i in range(batch.num_rows):
                payload = payloads[i].as_py()
                packed.append(member(record(ids[i].as_py(), urls[i].as_py(), payload, digests[i].as_py())))
                lengths.append(len(payload))
            columns = [ids.cast(pa.int64()), urls, digests, pa.array(lengths, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def finish(batches):
        for batch in batches:
            ids, urls, digests, lengths, packed, first = (batch.column(i) for i in range(6))
            out = []
            for i in range(batch.num_rows):
                refers = first[i].as_py()
                if refers is None:
                    out.append(packed[i].as_py()[:-1])
                else:
                    told = record(ids[i].as_py(), urls[i].as_py(), b"", digests[i].as_py(), lengths[i].as_py(), refers)
                    out.append(member(told)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    packed = source.mapInArrow(pack, schema).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    repeats = repeated_payloads(pages, least).select(F.col("digest").alias("_digest"), "first", salts.alias("_salt"))
    joined = packed.join(repeats, (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt")), "left")
    told = joined.select(
        "page_id", "url", "digest", "length",
        F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")), F.col("packed")).alias("packed"),
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )
    members = told.mapInArrow(finish, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", records_per_file).text(folder)
    return folder


def round_trip(pages, least=LEAST_BYTES):
    """The entries of all pages, written to a fresh folder of the shared workspace and read back."""
    spark = pages.sparkSession
    return read(spark, write(pages, fresh_path(spark, "warc"), least), with_payload=False)
