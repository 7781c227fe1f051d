"""WARC archives: a writer with payload deduplication and a salvage reader.

The reader checks every record (member checksum, version line, lengths, digests).  After a failed check it
logs the bytes from there as quarantined and looks for the next place that starts a valid record: the end
the record claims for itself, else the next gzip member or version line that passes all checks.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage, scratch_path
from .common import attempt_name, filesystem, rows_of, table, utf8

# Fixed values of the WARC format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = re.compile(rb"\x1f\x8b\x08|WARC/\d")          # a record cut off has no line feed before the next one
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
END = b"\r\n\r\n"


# ---------------------------------------------------------------- records

def record_bytes(kind: str, record_id: str, url: str | None, payload: bytes, refers_to: str | None, sha1: str,
                 date: str = "2020-01-01T00:00:00Z") -> bytes:
    """One uncompressed record; a revisit holds the HTTP head only, and its payload's digest and length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    head += [("WARC-Payload-Digest", f"sha1:{sha1}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}")]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + END


def member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Damage(Exception):
    """A failed check; ``claim``: where the record says it ends, if it got so far."""

    def __init__(self, why: str, claim: int | None = None):
        super().__init__(why)
        self.claim = claim


class Reader:
    """Bytes of a random-access file through a window of a few MB."""

    def __init__(self, file, size: int, window: int = 1 << 22):
        self.file, self.size, self.window = file, size, window
        self.at, self.buf = 0, b""

    def read(self, pos: int, n: int) -> bytes:
        n = max(0, min(n, self.size - pos))
        if not (self.at <= pos and pos + n <= self.at + len(self.buf)):
            self.at, self.buf = pos, self.file.read_at(min(max(n, self.window), self.size - pos), pos) if n else b""
        return self.buf[pos - self.at:pos - self.at + n]

    def next_start(self, pos: int) -> int:
        """The next place from ``pos`` on that looks like a member or a version line, else the end."""
        while pos < self.size:
            part = self.read(pos, 1 << 20)
            m = START.search(part)
            if m:
                return pos + m.start()
            if pos + len(part) >= self.size:
                break
            pos += len(part) - 8
        return self.size


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        raise Damage("version line")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Damage("header line")
        out[name.strip().lower()] = value.strip()
    if not out.get("content-length", "").isdigit():
        raise Damage("content length")
    return out


def _digest_ok(header: str | None, data: bytes) -> bool:
    """True where the digest agrees or is of a kind that can't be checked here."""
    if header is None:
        return True
    kind, _, value = header.partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return True
    h = hashlib.new(kind.lower(), data)
    if len(value) == 2 * h.digest_size:
        return value.lower() == h.hexdigest()
    import base64

    return value.upper().rstrip("=") == base64.b32encode(h.digest()).decode().rstrip("=")


def _checked(head: dict[str, str], block: bytes, claim: int | None) -> dict:
    if not _digest_ok(head.get("warc-block-digest"), block):
        raise Damage("block digest", claim)
    payload = block
    if head.get("content-type", "").startswith("application/http"):
        _, sep, payload = block.partition(END)
        if not sep:
            raise Damage("HTTP head", claim)
    kind = head.get("warc-type", "")
    if kind != "revisit" and not _digest_ok(head.get("warc-payload-digest"), payload):
        raise Damage("payload digest", claim)
    return {"head": head, "block": block, "payload": payload}


def _head(get) -> bytes:
    """A record's header lines, whatever their length, from ``get(n)``: its first n bytes, fewer at the end of the data.

    Bytes are asked for as long as what stands there are header lines.
    """
    n, done = 1 << 12, 0
    while True:
        head = get(n)
        if not VERSION_LINE.match(head):
            raise Damage("version line")
        cut = head.find(END, max(0, done - 3))
        if cut >= 0:
            return head[:cut]
        if len(head) < n:
            raise Damage("header end")
        lines = head[done:head.rfind(b"\r\n") + 2].split(b"\r\n")[1 if not done else 0:-1]
        if any(b":" not in x for x in lines):
            raise Damage("header line")
        done = max(done, head.rfind(b"\r\n") + 2)
        n *= 4


def plain_record(r: Reader, pos: int) -> tuple[dict, int]:
    raw = _head(lambda n: r.read(pos, n))
    fields = _parse(raw)
    first, length = pos + len(raw) + 4, int(fields["content-length"])
    claim = first + length + 4
    if claim > r.size:
        raise Damage("cut off")
    if r.read(first + length, 4) != END:
        raise Damage("record end")
    return _checked(fields, r.read(first, length), claim), claim


class Inflated:
    """The bytes of a gzip member, taken from the front as they are needed."""

    def __init__(self, r: Reader, pos: int):
        self.r, self.at, self.d, self.buf = r, pos, zlib.decompressobj(31), bytearray()

    def get(self, n: int) -> bytes:
        """The next n bytes, fewer at the member's end."""
        while len(self.buf) < n and not self.d.eof:
            part = self.r.read(self.at, 1 << 16)
            if not part:
                raise Damage("member cut off")
            try:
                self.buf += self.d.decompress(part)
            except zlib.error as e:
                raise Damage(f"member: {e}") from None
            self.at += len(part)
        return bytes(self.buf[:n])

    def skip(self) -> bool:
        """Goes on to the next version line behind the first byte; False if the rest of the member has none."""
        del self.buf[:1]
        while True:
            self.get(1 << 16)
            m = VERSION_LINE.search(self.buf)
            if m:
                del self.buf[:m.start()]
                return True
            if self.d.eof:
                return False
            del self.buf[:-16]

    def done(self) -> bool:
        return self.d.eof and not self.buf

    def end(self) -> int:
        """How far the member is read; its end, once all is."""
        return self.at - len(self.d.unused_data)


def member_records(r: Reader, pos: int) -> Iterator[tuple[dict | str, int]]:
    """(record, place in the file up to which the member was read) of each record of a member: one by the book, but any number.

    Between records, (failed check, place) for what had to be left out up to the next version line.  A record counts
    once something, or the member's sound end, stands behind it.
    """
    m, held = Inflated(r, pos), None
    while True:
        try:
            raw = _head(m.get)
            fields = _parse(raw)
            first, length = len(raw) + 4, int(fields["content-length"])
            data = m.get(first + length + 4)
            if data[first + length:] != END:
                raise Damage("record end")
            rec = _checked(fields, data[first:first + length], None)
        except Damage as e:
            if str(e).startswith("member"):
                raise
            if held:
                yield held
                held = None
            if not m.skip():
                e.claim = m.end()                            # the member itself is sound and says where it ends
                raise e from None
            yield str(e), m.end()
            continue
        if held:
            yield held
        del m.buf[:first + length + 4]
        m.get(1)
        held = (rec, m.end())
        if m.done():
            yield held
            return


def salvage(file, size: int) -> Iterator[tuple[str, int, int, dict | str]]:
    """("record", start, end, record) and ("gap", start, end, first failed check), in file order."""
    r, pos, gap, why = Reader(file, size), 0, None, ""

    def records(at: int) -> Iterator[tuple[dict | str, int]]:
        two = r.read(at, 5)
        if two[:2] == b"\x1f\x8b":
            yield from member_records(r, at)
        elif two == b"WARC/":
            yield plain_record(r, at)
        else:
            raise Damage("no member or version line")

    while pos < size:
        start = pos
        try:
            for rec, end in records(start):
                if isinstance(rec, str):
                    if gap is None:
                        gap, why = pos, rec
                    pos = end
                    continue
                if gap is not None:
                    yield "gap", gap, pos, why
                    gap = None
                yield "record", pos, end, rec
                pos = end
        except Damage as e:
            if gap is None:
                gap, why = pos, str(e)
            nxt = r.next_start(max(pos, start + 1))
            if e.claim is not None and e.claim > pos:
                try:                                    # a record that only fails a digest still says where it ends
                    if e.claim < size:
                        next(records(e.claim))
                    nxt = e.claim
                except Damage:
                    pass
            pos = nxt
    if gap is not None:
        yield "gap", gap, size, why


# ---------------------------------------------------------------- Spark

RECORDS = ("kind string, path string, start long, end long, why string, record_type string, record_id string, url string, "
           "payload_digest string, payload_bytes long, refers_to string, payload binary")


def _urn(page) -> str:
    return f"urn:page:{'' if page is None else page}"


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000,
               broadcast_rows: int = 100_000) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): refers_to names the response whose payload a row repeats, else null.

    Of equal payloads of ``least`` bytes or more, the rows with the largest id are the response (several, if
    that id is repeated); rows with a null id refer to it; where all ids are null, all are responses.
    """
    src = pages.select(qcol(id_col).cast("long").alias("page_id"), qcol(url_col).cast("string").alias("url"), utf8(html_col).alias("payload"))
    key = F.when(F.length("payload") >= least, F.sha2("payload", 256))
    same = cut_lineage(src.select("page_id", key.alias("key")).where("key is not null").groupBy("key")
                       .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1 and response is not null").select("key", "response"))
    if same.count() <= broadcast_rows:                  # 100,000 rows of 80 bytes at most; else a shuffled join
        same = F.broadcast(same)
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))           # short payloads: no key of the other side, spread
    rows = src.withColumn("key", F.coalesce(key, alone)).join(same, "key", "left")
    repeats = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), F.when(repeats, F.col("response")).alias("refers_to"))


def write_archives(rows: DataFrame, archive_bytes: int = 64 << 20) -> DataFrame:
    """Writes a record per row of ``with_roles`` into .warc.gz files of about ``archive_bytes`` in the shared folder; returns (path, folder, records)."""
    folder = scratch_path(rows.sparkSession, "warc")
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    arrow = pa.schema([("path", pa.string()), ("folder", pa.string()), ("records", pa.int64())])

    def run(batches):
        out_fs, out_dir = filesystem(folder)
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            for page, url, payload, sha1, refers in rows_of(batch):
                if out is None:
                    name, size, n = f"{out_dir}/{attempt_name('pages', '.warc.gz')}", 0, 0
                    out = out_fs.open_output_stream(name, compression=None)
                kind = "response" if refers is None else "revisit"
                data = member(record_bytes(kind, _urn(page), url, payload, None if refers is None else _urn(refers), sha1))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield table([(name, folder, n)], arrow)
        if out is not None:
            out.close()
            yield table([(name, folder, n)], arrow)

    return cut_lineage(rows.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, "path string, folder string, records long"))


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives (path, folder), one task per file; see RECORDS for the columns."""
    arrow = pa.schema([("kind", pa.string()), ("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("why", pa.string()),
                       ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
                       ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            for path, folder in rows_of(batch):
                fs, _ = filesystem(folder)
                with fs.open_input_file(path) as f:
                    out, held = [], 0
                    for kind, a, b, what in salvage(f, f.size()):
                        if kind == "gap":
                            out.append((kind, path, a, b, what) + (None,) * 7)
                        else:
                            h, payload = what["head"], what["payload"]
                            type_, digest, n = h.get("warc-type"), hashlib.sha1(payload).hexdigest(), len(payload)
                            if type_ == "revisit":
                                digest = h.get("warc-payload-digest", "").removeprefix("sha1:").lower() or None
                                m = re.search(rb"(?im)^Content-Length:\s*(\d+)", what["block"])
                                n = int(m[1]) if m else None
                            out.append((kind, path, a, b, None, type_, h.get("warc-record-id"), h.get("warc-target-uri"), digest, n,
                                        h.get("warc-refers-to"), payload if with_payload else None))
                            held += len(payload) if with_payload else 0
                        if len(out) >= 4096 or held > 1 << 24:
                            yield table(out, arrow)
                            out, held = [], 0
                    yield table(out, arrow)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path", "folder").repartition(n, "path").mapInArrow(run, RECORDS)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000) -> DataFrame:
    """Writes all rows as archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Null html is an empty payload, a null url has no target URI, a null id comes back null.  Repeated rows are
    records of their own.  An empty table writes no file.  Other columns are ignored, whatever their names.
    """
    records = read_archives(write_archives(with_roles(pages, id_col, url_col, html_col, least)), with_payload=False).where("kind = 'record'")
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    as_id = lambda c: F.when(F.length(number(c)) > 0, number(c).cast("long"))
    return records.select(as_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id("refers_to").alias("refers_to"), "url")
