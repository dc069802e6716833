"""WARC archives: writing, normalising monolithic gzip streams, and indexed reading.

* `write_monolithic` renders one record per row with DataFrame functions and lets
  Spark's text writer gzip each partition: every archive is a single gzip stream,
  as produced by tools that compress a whole file at once.  Such an archive can
  only be read from its start.
* `normalise` inflates each archive's stream once, in pieces, and rewrites every
  record as a gzip member of its own, with a sidecar index of offsets and
  lengths.  Any record can then be read alone.  Memory is bounded by one record.
* `read_records` reads records by index: seek, inflate one member, parse.

Archives, members and sidecars lie in the shared checkpoint folder and are written
under a name of the attempt's own and then moved into place; a lost task is run
again and gives the same bytes.

Duplicate payloads: of the rows with equal payloads (equal SHA-1 and length) of at
least ``min_bytes``, those with the largest id are ``response`` records, the others
``revisit`` records that refer to it and carry no payload.

Edge cases: a null payload counts as empty; a null id never wins over another id,
and if all ids of a payload are null each row is a response; rows that repeat the
largest id are all responses; line breaks in a URL are replaced by blanks; a null
URL is left out; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits (5 hex digits) make 4 letters."""
    digest = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def mark_duplicates(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(id, url, payload, n_bytes, digest, record_type, refers_to).  Only payloads
    that occur more than once are joined back; that table is written first, so
    Spark broadcasts it by its real size or else shuffles."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    own = own.withColumns({"n_bytes": F.octet_length("payload").cast("long"), "digest": sha1_base32(F.col("payload").cast("binary"))})
    groups = (own.filter(F.col("n_bytes") >= min_bytes).groupBy(F.col("digest").alias("d_"), F.col("n_bytes").alias("n_"))
              .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    groups = materialize(groups, "warc-copies")
    own = own.join(groups, (F.col("digest") == F.col("d_")) & (F.col("n_bytes") == F.col("n_")), "left")
    revisit = F.col("copies").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return own.select("id", "url", "payload", "n_bytes", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("keeper")).alias("refers_to"))


def _urn(key: Column) -> Column:
    h = F.md5(key)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def record_text(response: str = "response") -> Column:
    """One WARC record as text, without its last line break."""
    is_response = F.col("record_type") == response
    payload = F.when(is_response, F.col("payload")).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _line("Content-Length", F.col("n_bytes")), F.lit("\r\n"))
    block = F.concat(http, payload)
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _urn(F.concat_ws("|", F.lit("page"), F.col("id").cast("string"), F.col("url")))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(~is_response, F.lit(PROFILE))),
        _line("X-Page-ID", F.col("id")), _line("X-Refers-To-Page", F.col("refers_to")), _line("X-Payload-Length", F.col("n_bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), _line("Content-Length", F.octet_length(block)), F.lit("\r\n"),
        block, F.lit("\r\n"))


def write_monolithic(marked: DataFrame, folder: str) -> None:
    """One gzip stream of records per partition (the writer ends each with CRLF)."""
    marked.select(record_text().alias("value")).write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip").text(folder)


def _open(uri: str):
    """(filesystem, path) of a file that Spark named."""
    from pyarrow import fs

    local = re.match(r"file:/+(.*)", uri)
    return (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(uri)


def inflate(read):
    """Pieces of a gzip stream's content, whether it has one member or many."""
    member = zlib.decompressobj(31)
    while chunk := read(CHUNK):
        while chunk:
            yield member.decompress(chunk)
            chunk = b""
            if member.eof:
                chunk, member = member.unused_data, zlib.decompressobj(31)
    yield member.flush()


def split_records(pieces):
    """(header bytes, block bytes) of each record in a stream of pieces."""
    pieces, buf = iter(pieces), bytearray()

    def need(n: int) -> bool:
        while len(buf) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buf.extend(piece)
        return True

    while need(1):
        at = 0
        while (end := buf.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(buf) - 3)
            if not need(len(buf) + 1):
                raise ValueError("archive ends inside a record's header")
        head = bytes(buf[:end + 4])
        size = re.search(rb"\r\ncontent-length:\s*(\d+)", head, re.I)
        if not head.startswith(b"WARC/") or not size:
            raise ValueError("not a WARC record")
        total = end + 4 + int(size[1])
        if not need(total + 4) or buf[total:total + 4] != b"\r\n\r\n":
            raise ValueError("archive ends inside a record's block")
        yield head, bytes(buf[end + 4:total])
        del buf[:total + 4]


def header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _rewrite(batches):
    """Archive paths in; for each, members and sidecar are written beside its folder."""
    for batch in batches:
        done = []
        for uri in batch.column("path").to_pylist():
            fs, path = _open(uri)
            folder, name = path.rsplit("/", 2)[0] + "/members", path.rsplit("/", 1)[1].split(".")[0]
            target, mine = f"{folder}/{name}.warc.gz", f".{uuid.uuid4().hex}"
            fs.create_dir(folder, recursive=True)
            offset, n = 0, 0
            with fs.open_input_stream(path, compression=None) as src, fs.open_output_stream(f"{folder}/.{name}{mine}", compression=None) as out, \
                    fs.open_output_stream(f"{folder}/.{name}{mine}.idx", compression=None) as index:
                for head, block in split_records(inflate(src.read)):
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = pack.compress(head) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()
                    out.write(member)
                    index.write(f"{offset}\t{len(member)}\t{header(head).get('WARC-Record-ID', '')}\n".encode())
                    offset, n = offset + len(member), n + 1
            fs.move(f"{folder}/.{name}{mine}", target)
            fs.move(f"{folder}/.{name}{mine}.idx", target + ".idx")
            root = uri.rsplit("/", 2)[0] + "/members"
            done.append((f"{root}/{name}.warc.gz", n, offset))
        cols = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                         ["archive", "records", "bytes"])


def normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Rewrite every ``*.gz`` archive of ``folder`` into ``<folder>/../members``
    and return the index: (archive, offset, length, record_id).  The index is read
    back from the sidecars, which stay beside the archives."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    n = paths.count()
    base = folder.rsplit("/", 1)[0]
    schema = "offset long, length long, record_id string"
    if not n:
        return spark.createDataFrame([], "archive string, " + schema)
    paths.repartition(min(n, 4096)).mapInArrow(_rewrite, "archive string, records long, bytes long").write.mode("overwrite").parquet(base + "/archives")
    index = spark.read.option("sep", "\t").option("pathGlobFilter", "*.idx").schema(schema).csv(base + "/members")
    return index.select(F.regexp_replace(F.input_file_name(), r"\.idx$", "").alias("archive"), "offset", "length", "record_id")


def _read(batches):
    from urllib.parse import unquote

    for batch in batches:
        rows, size, opened = [], 0, {}
        for uri, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            if uri not in opened:
                for f in opened.values():
                    f.close()
                fs, path = _open(unquote(uri))
                opened = {uri: fs.open_input_file(path)}
            f = opened[uri]
            f.seek(offset)
            (head, block), = split_records([zlib.decompress(f.read(length), 31)])
            at = block.find(b"\r\n\r\n") + 4
            rows.append((uri, offset, header(head), block[at:] if at > 3 else block))
            size += len(block)
            if size > (8 << 20):
                yield _batch(rows)
                rows, size = [], 0
        for f in opened.values():
            f.close()
        if rows:
            yield _batch(rows)


def _batch(rows):
    a, o, h, p = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(o, pa.int64()), pa.array([list(x.items()) for x in h], pa.map_(pa.string(), pa.string())),
                                       pa.array(p, pa.binary())], ["archive", "offset", "headers", "payload"])


def read_records(index: DataFrame) -> DataFrame:
    """(archive, offset, headers, payload) of every indexed record."""
    return index.select("archive", "offset", "length").mapInArrow(_read, "archive string, offset long, headers map<string,string>, payload binary")


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc") + "/raw"
