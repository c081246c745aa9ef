"""WARC archives: captures written to them, records read back, and the assembly of captures.

A capture is a transaction of several records: what was asked for (request), what came (response,
or revisit where the same payload is stored elsewhere) and notes about it (metadata). The records
say which ones belong together by ``WARC-Concurrent-To``. They are joined through these identifiers,
and a capture comes out as one nested row.

Files hold a gzip member for each record, so a reader may start at any record. A file is
named after its task's attempt; only the files that finished tasks report are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from fillwatch.llm.tokens import _place
from fillwatch.session import remove, settled, shared_dir

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Types of records that a capture is named by, and types that are attached to one. Fixed values.
MAIN, ATTACHED = ("response", "revisit", "resource"), ("request", "metadata")

#: Bytes of a file after which the next one begins, about, and of records given out at once.
FILE, BATCH = 1 << 30, 1 << 23
#: Records attached to one row of a capture; those of a larger capture go on in further rows.
ATTACH = 1 << 12
#: Payloads held at once of those that are read beside their records.
ROWS = 32
SALTS = 64

_KINDS = ("main", "request", "metadata")
_FILES = "file string, records long, bytes long"
_PAIRS = "array<struct<name: string, value: string>>"
_RECORDS = (
    "file string, place long, type string, record_id string, concurrent_to array<string>,"
    " refers_to string, target_uri string, date string, payload_digest string,"
    f" fields {_PAIRS}, http_status int, http_fields {_PAIRS},"
    " payload binary, payload_bytes long, payload_sha1 string, problem string"
)


def base32(hexadecimal: Column) -> Column:
    """Hexadecimal digits of a SHA-1 in base 32: twenty bits are four digits."""
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _names(numbers: Column, kind: int, drawn: str) -> Column:
    """Identifiers (UUIDs of version 8) from 60 bits ``drawn`` for the archive, a kind, and a number."""
    digits = F.lower(F.lpad(F.hex(numbers), 14, "0"))
    head = f"<urn:uuid:{drawn[:8]}-{drawn[8:12]}-8{drawn[12:15]}-8{kind:x}"
    return F.concat(F.lit(head), F.substring(digits, 1, 2), F.lit("-"), F.substring(digits, 3, 12), F.lit(">"))


def _line(value: Column) -> Column:
    """A value that stays on its line."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record(fields: dict[str, Column], block: Column, more: Column | None = None) -> Column:
    """A record for ``write``: named fields, null ones left out, and its block.

    ``more`` is the bytes of a payload that ``write`` adds to the block, null for none.
    """
    named = [F.concat(F.lit(f"{name}: "), _line(value)) for name, value in fields.items()]
    own = F.octet_length(block)
    bytes_ = own if more is None else own + F.coalesce(more, F.lit(0))
    size = F.concat(F.lit("Content-Length: "), bytes_.cast("string"))
    return F.struct(
        F.concat_ws("\r\n", F.lit(VERSION), *named, size).alias("head"), block.alias("block")
    )


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).cast("binary")


def numbered(pages: DataFrame) -> DataFrame:
    """``pages`` with payload, digests and a number for each row, to be written before use.

    Numbers hang on how the table is dealt out; they tell rows apart and make identifiers.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")
    ).select(
        "*",
        F.monotonically_increasing_id().alias("number"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.unhex(F.sha2("payload", 256)).alias("content"),
        F.concat(F.lit("sha1:"), base32(F.sha1("payload"))).alias("digest"),
    )


def transactions(pages: DataFrame, least_bytes: int = 0, apart: int | None = None) -> DataFrame:
    """The records of each row of ``numbered`` pages that have been written, for ``write``.

    With ``apart``, payloads stay in the files that ``pages`` was read from (``source`` names a row's
    file, the column ``payload`` is not read) and no shuffle carries them: records come in that many
    partitions, those of a file together and in its order, with ``source``, and the ``number`` of the
    row whose payload ends the block, for ``write`` to add.

    Of rows with equal payloads (the html in UTF-8; null is empty) of ``least_bytes`` or more, the
    one with the largest ``page_id`` is a response, null being the smallest; of several such rows
    the one with the largest url, of rows alike in both any one. The others are revisits that
    refer to it. Rows with smaller payloads are all responses. The group of equal payloads is
    merged by salt first, so however large it is, no task gets all of it.
    """
    salt = F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int")
    rows = pages.withColumn("salt", salt)
    best = F.struct("page_id", "url", "number")
    by_salt = rows.filter(F.col("bytes") >= least_bytes).groupBy("content", "salt").agg(F.max(best).alias("best"))
    of_all = F.max("best").over(Window.partitionBy("content"))
    chosen = by_salt.select("content", "salt", of_all["number"].alias("best"))
    drawn = uuid.uuid4().hex
    name = lambda number, kind: _names(number, _KINDS.index(kind), drawn)
    known = (
        rows.join(chosen, ["content", "salt"], "left")
        .withColumn("stays", F.coalesce(F.col("best") == F.col("number"), F.lit(True)))
        .withColumns({"id": name(F.col("number"), "main"), "of": name(F.col("best"), "main")})
    )
    if apart:
        # the upper bits of a number are the task that wrote the row's file
        known = known.repartitionById(apart, F.shiftright("number", 33).cast("int")).sortWithinPartitions("source", "number")
    stays, uri = F.col("stays"), F.col("url")
    head = _text(
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ",
        F.col("bytes").cast("string"),
        "\r\n\r\n",
    )
    asked = _text(
        "GET ", F.coalesce(_line(uri), F.lit("/")), " HTTP/1.1\r\nHost: ",
        F.coalesce(F.try_parse_url(uri, F.lit("HOST")), F.lit("")), "\r\n\r\n",
    )
    date = F.lit("2000-01-01T00:00:00Z")  # pages have no time of their own
    common = {"WARC-Target-URI": uri, "WARC-Date": date}
    main = record(
        {
            "WARC-Type": F.when(stays, "response").otherwise("revisit"),
            "WARC-Record-ID": F.col("id"),
            **common,
            "WARC-Payload-Digest": F.col("digest"),
            "WARC-Profile": F.when(~stays, REVISIT_PROFILE),
            "WARC-Refers-To": F.when(~stays, F.col("of")),
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        head if apart else F.when(stays, F.concat(head, "payload")).otherwise(head),
        F.when(stays, F.col("bytes")) if apart else None,
    )

    def beside(kind: str, content: str, block: Column) -> Column:
        fields = {
            "WARC-Type": F.lit(kind),
            "WARC-Record-ID": name(F.col("number"), kind),
            **common,
            "WARC-Concurrent-To": F.col("id"),
            "Content-Type": F.lit(content),
        }
        return record(fields, block)

    notes = F.coalesce(_text("page-id: ", F.col("page_id").cast("string"), "\r\n"), F.lit(b""))
    each = [
        beside("request", "application/http; msgtype=request", asked),
        main,
        beside("metadata", "application/warc-fields", notes),
    ]
    if not apart:
        return known.select(F.inline(F.array(*each)))
    payload_of = F.when(stays, F.col("number"))
    each = [r.withField("number", payload_of if r is main else F.lit(None).cast("long")) for r in each]
    return known.select("source", F.inline(F.array(*each)))


def _payloads(copy: str) -> Callable[[str, int], bytes]:
    """Payloads of rows of a ``numbered`` table at ``copy``, by file and number, asked for in the files' order."""
    store, folder = _place(copy)
    now, rows = None, iter(())

    def held(file: str) -> Iterator[tuple[pa.Scalar, pa.Scalar]]:
        with store.open_input_file(f"{folder}/{file}") as raw:
            table = pq.ParquetFile(raw, buffer_size=1 << 20)
            for batch in table.iter_batches(ROWS, columns=["number", "payload"]):
                yield from zip(batch.column("number").to_pylist(), batch.column("payload"))

    def payload(file: str, number: int) -> bytes:
        nonlocal now, rows
        if file != now:
            now, rows = file, held(file)
        for own, value in rows:
            if own == number:
                return value.as_py()
        raise LookupError(f"row {number} is not in {file}, or not in order")

    return payload


def write(
    records: DataFrame, path: str, most_bytes: int = FILE, level: int = 6, copy: str | None = None
) -> DataFrame:
    """Writes rows of ``head`` and ``block`` (see ``record``) as WARC files below ``path``.

    With ``copy``, the folder of a ``numbered`` table, ``records`` are those of ``transactions`` with
    payloads apart, and each task reads these from the files that its records are of.

    A task writes a file, and another one whenever it has passed ``most_bytes``. No rows give no
    file. A repeated task leaves files that no row names, and never a broken one that is named.

    Columns: a row for each file: ``file`` (its name below ``path``), ``records``, ``bytes``.
    """

    def member(data: bytes) -> bytes:
        press = zlib.compressobj(level, zlib.DEFLATED, 31)
        return press.compress(data) + press.flush()

    first = f"{VERSION}\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 0"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, folder = _place(path)
        store.create_dir(folder, recursive=True)
        out, name, n, size, files = None, "", 0, 0, 0
        payload = _payloads(copy) if copy else None

        def done() -> pa.RecordBatch:
            out.close()
            return pa.record_batch({"file": [name], "records": [n], "bytes": [size]})

        for batch in batches:
            for row in zip(*batch.columns):
                head, block, *of = (value.as_py() for value in row)
                if of and of[1] is not None:
                    block += payload(*of)
                if out is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{files}.warc.gz"
                    out, n, size, files = store.open_output_stream(f"{folder}/{name}", compression=None), 0, 0, files + 1
                    out.write(member(first.encode() + b"\r\n\r\n\r\n\r\n"))
                data = member(b"".join((head.encode(), b"\r\n\r\n", block, b"\r\n\r\n")))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= most_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    names = ["head", "block", *(["source", "number"] if copy else [])]
    return settled(records.select(*names).mapInArrow(work, _FILES), "archives")


def archive(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (``page_id``, ``url``, ``html``) as captures below ``path``; returns the files.

    See ``transactions`` and ``write``. Null and empty html is an empty payload, every row a capture of
    its own, an empty table no file; other columns are not read.
    """
    spark = pages.sparkSession
    copy = shared_dir(spark, "pages")
    # the copy is what takes disk beside the archives: it is packed more tightly
    packed = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
    numbered(pages).write.options(**packed).parquet(copy)
    held = spark.read.parquet(copy)
    rows = held.drop("payload").withColumn("source", F.col("_metadata.file_name"))
    files = write(transactions(rows, least_bytes, max(1, len(held.inputFiles()))), path, copy=copy)
    remove(spark, copy)
    return files


def _pairs(lines: list[bytes]) -> list[dict]:
    """Named fields; a line that begins with a blank goes on with the one before."""
    out: list[dict] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1]["value"] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            out.append({"name": name.strip(), "value": value.strip()})
    return out


def _values(fields: list[dict]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for field in fields:
        out.setdefault(field["name"].lower(), []).append(field["value"])
    return out


def _head(stream: BinaryIO) -> list[bytes] | None:
    """The lines of a record's head, none at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:20]!r}")
    lines = []
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("the file ends in the head of a record")
        lines.append(line.rstrip(b"\r\n"))
    return lines


def _message(block: bytes) -> tuple[int | None, list[dict], bytes]:
    """Status, fields and body of an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    start, *lines = head.split(b"\r\n")
    status = start.split(b" ")[1:2] if start.startswith(b"HTTP/") else []
    return int(status[0]) if status and status[0].isdigit() else None, _pairs(lines), body


def parsed(stream: BinaryIO) -> Iterator[dict]:
    """The records of one file; where it is broken, a row with only ``problem`` ends it."""
    place = 0
    try:
        while (lines := _head(stream)) is not None:
            fields = _pairs(lines)
            values = _values(fields)
            first = lambda name: values.get(name, [None])[0]
            size = int(first("content-length") or 0)
            block = stream.read(max(size, 0))
            if len(block) != size:
                raise EOFError(f"a record's block has {len(block)} bytes in place of {size}")
            status, http, body = None, [], block
            if (first("content-type") or "").lower().startswith("application/http"):
                status, http, body = _message(block)
            yield {
                "place": place,
                "type": first("warc-type"),
                "record_id": first("warc-record-id"),
                "concurrent_to": values.get("warc-concurrent-to", []),
                "refers_to": first("warc-refers-to"),
                "target_uri": first("warc-target-uri"),
                "date": first("warc-date"),
                "payload_digest": first("warc-payload-digest"),
                "fields": fields,
                "http_status": status,
                "http_fields": http,
                "payload": body,
                "payload_bytes": len(body),
                "payload_sha1": base64.b32encode(hashlib.sha1(body).digest()).decode(),
                "problem": None,
            }
            place += 1
    except (EOFError, ValueError, OSError, zlib.error) as broken:
        yield {"place": place, "problem": str(broken)}


def read(files: DataFrame, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The records of ``files`` (column ``file``, names below ``path``), compressed or not.

    A file is read from end to end by one task, a record at a time. Fields are trimmed; names are
    found in any case. A file that is broken somewhere gives the records before that place and a
    row with ``problem`` and nothing else. ``columns`` are the ones to give out, all if not given.

    Columns: ``file``, ``place`` (from 0), ``type``, ``record_id``, ``concurrent_to``,
    ``refers_to``, ``target_uri``, ``date``, ``payload_digest`` (as stated), ``fields``,
    ``http_status``, ``http_fields``, ``payload`` (the message body, or the block where it is
    not HTTP), ``payload_bytes``, ``payload_sha1`` (of what was read, base 32), ``problem``.
    """
    spark = files.sparkSession
    every = spark.createDataFrame([], _RECORDS)
    schema = every.select(*(columns or every.columns)).schema
    kind = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(path)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{folder}/{name}", compression=None, buffer_size=1 << 20) as raw:
                    plain = io.BufferedReader(raw, 1 << 16)
                    packed = plain.peek(2)[:2] == b"\x1f\x8b"
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=plain), 1 << 16) if packed else plain
                    for row in parsed(stream):
                        size += row.get("payload_bytes", 0) + 512
                        row["file"] = name
                        rows.append({c: row.get(c) for c in kind.names})
                        if size >= BATCH:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return files.select("file").repartition(max(1, files.count())).mapInArrow(work, schema)


def captures(records: DataFrame, attach: int = ATTACH) -> DataFrame:
    """One nested row for each capture in ``records`` (see ``read``).

    A record of a type in ``MAIN`` is a capture. Requests and metadata are attached to the
    capture that they are concurrent to, or that is concurrent to them, also by way of one record
    between; to each of them if there are several. What belongs to no capture is one of its
    own, without a main record. A capture with more than ``attach`` attached records goes on in
    further rows, dealt out by hash, so no row and no task grows with it. Records without an
    identifier have nothing attached. An empty table gives no rows; of ``records``, all columns
    are kept, inside the nested ones. ``records`` are gone through several times: write them to a
    table first if they come straight from ``read``.

    Columns: ``capture_id``, ``part`` (0 for most captures' only row), ``record`` (the main one,
    in each part), ``requests`` and ``metadata`` (arrays, ordered by identifier).
    """
    whole = F.struct(*[F.col(c) for c in records.columns]).alias("record")
    main = records.filter(F.col("type").isin(*MAIN)).select(F.col("record_id").alias("capture_id"), whole)
    beside = records.filter(F.col("type").isin(*ATTACHED))
    pairs = lambda df, a, b: df.select(F.col(a).alias("of"), F.col(b).alias("to")).dropna()
    stated = records.select("type", "record_id", F.explode("concurrent_to").alias("other"))
    by_main = pairs(stated.filter(F.col("type").isin(*MAIN)), "other", "record_id")
    by_beside = stated.filter(F.col("type").isin(*ATTACHED))
    ids = main.select(F.col("capture_id").alias("to")).distinct()
    near = pairs(by_beside, "record_id", "other").join(ids, "to", "left_semi").select("of", "to").union(by_main)
    # by way of one record: what is linked with a record that is linked with a capture
    between = beside.select(F.col("record_id").alias("mid")).distinct()
    steps = near.select(F.col("of").alias("mid"), "to").join(between, "mid", "left_semi")
    links = pairs(by_beside, "record_id", "other").union(pairs(by_beside, "other", "record_id"))
    far = links.select("of", F.col("to").alias("mid")).join(steps, "mid").select("of", "to").filter("of <> to")
    found = near.union(far).distinct()
    attached = beside.select("record_id", "type", whole).join(
        found, F.col("record_id") == F.col("of"), "left"
    ).select(F.coalesce("to", "record_id").alias("capture_id"), "record_id", "type", "record")
    many = (
        attached.groupBy("capture_id").agg(F.count("*").alias("n")).filter(F.col("n") > attach)
        .select("capture_id", F.ceil(F.col("n") / attach).cast("int").alias("parts"))
    )
    one = lambda kind: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("record_id", "record")))),
        lambda x: x["record"],
    )
    grouped = (
        attached.join(many, "capture_id", "left")
        .withColumn("part", F.coalesce(F.pmod(F.xxhash64("record_id"), F.col("parts")), F.lit(0)).cast("int"))
        .groupBy("capture_id", "part")
        .agg(one("request").alias("requests"), one("metadata").alias("metadata"))
    )
    return main.join(grouped, "capture_id", "full").select(
        "capture_id", F.coalesce("part", F.lit(0)).alias("part"), "record",
        F.coalesce("requests", F.array()).alias("requests"),
        F.coalesce("metadata", F.array()).alias("metadata"),
    )
