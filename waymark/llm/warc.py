"""WARC archives: a writer, a streaming reader and the assembly of captures."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import read, scratch_path, stored

_CRLF = "\r\n"
_END = "\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: So many repeated digests, those of most copies, are broadcast: about 120 bytes each.
_MOST = 1 << 16
_RECORD = "file string, record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, payload_digest string, http_length long, block string, payload string"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _uuid(kind: str, *row: Column) -> Column:
    """A record id, from the kind of record and what tells rows apart."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in row]))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its closing blank lines; headers that are null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(_CRLF, F.lit("WARC/1.1"), _text("WARC-Type: ", kind if isinstance(kind, Column) else kind), *lines, length), F.lit(_END), block)


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least_revisit: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", most: int = _MOST) -> None:
    """Write request, response or revisit, and metadata records of every row to gzipped WARC files under path.

    A payload is the text in UTF-8 (null: empty). Of rows with equal payloads of at least
    least_revisit bytes the one with the smallest id is a response, and the others are revisits
    of it, without payload; smaller ones are all responses. The other records of a capture name
    its response or revisit in WARC-Concurrent-To. The metadata record holds the id.

    Every record ends with two CRLFs, so the text sink with that separator writes exact archives
    through Spark's own committer, on any store: no executor keeps a file of its own. A file is as
    large as an input split. Which payloads are repeated is found from digests and ids alone. Of the repeated
    digests the `most` with the most copies are broadcast, with the id of their response's record (fixed size).
    Only if there are more are rows joined by a shuffle, payloads and all, and then just those whose digest
    isn't among the broadcast ones: a large group of copies never meets in one task.

    Cases: a row whose id is null is no other's response; rows that share the smallest id are all responses,
    and equal rows write equal records; a null url leaves its header out; control characters in urls are percent-encoded;
    no rows: no records. Other columns are not read.
    """
    body = F.coalesce(F.col(payload_col), F.lit(""))
    digest = F.sha2(F.encode(body, "UTF-8"), 256)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"), digest.alias("digest"), F.octet_length(body).cast("long").alias("n"))
    order = F.struct(F.col("id").isNull().alias("late"), "id", "url")
    # An id of the response's record instead of its url: all of fixed size.
    def record_id(i: Column, u: Column) -> Column:
        return _uuid("response", i, u, F.col("digest"))

    repeated = rows.where(F.col("n") >= least_revisit).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1").where("first.id is not null").select("digest", F.col("first.id").alias("first_id"), record_id(F.col("first.id"), F.col("first.url")).alias("first_record"), "copies")
    firsts = stored(repeated, "repeated")
    some = firsts.count() <= most
    hot = firsts if some else firsts.orderBy(F.desc("copies"), "digest").limit(most)
    near = rows.join(F.broadcast(hot.drop("copies")), "digest", "left")
    if not some:
        hot = stored(hot.select("digest"), "hot")
        cold = firsts.join(F.broadcast(hot), "digest", "left_anti").drop("copies")
        known = F.col("first_id").isNotNull() | (F.col("n") < least_revisit)
        near = near.where(known).unionByName(near.where(~known).drop("first_id", "first_record").join(cold, "digest", "left"))
    again = (F.col("n") >= least_revisit) & F.col("first_id").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first_id")))
    rows = near.withColumn("again", again)
    encoded = F.col("url")
    for c in [*range(32), 127]:
        encoded = F.replace(encoded, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    rows = rows.withColumn("uri", F.when(F.col("url").rlike(r"[\x00-\x1F\x7F]"), encoded).otherwise(F.col("url")))
    url = F.col("uri")
    path_of = F.coalesce(F.nullif(F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    own, stamp = _uuid("response", F.col("id"), F.col("url"), F.col("digest")), F.lit(date)
    head = _text("HTTP/1.1 200 OK", _CRLF, "Content-Type: text/html; charset=utf-8", _CRLF, "Content-Length: ", F.col("n").cast("string"), _END)
    http = F.when(F.col("again"), head).otherwise(F.concat(head, F.col("body")))
    request = _record("request", [("WARC-Record-ID", _uuid("request", F.col("id"), F.col("url"), F.col("digest"))), ("WARC-Date", stamp), ("WARC-Target-URI", url), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http; msgtype=request"))], _text("GET ", F.coalesce(path_of, F.lit("/")), " HTTP/1.1", _CRLF, "Host: ", F.coalesce(F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1), F.lit("")), _END))
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        [("WARC-Record-ID", own), ("WARC-Date", stamp), ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), ("WARC-Refers-To", F.when(F.col("again"), F.col("first_record"))), ("WARC-Profile", F.when(F.col("again"), F.lit(_REVISIT))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        http,
    )
    metadata = _record("metadata", [("WARC-Record-ID", _uuid("metadata", F.col("id"), F.col("url"), F.col("digest"))), ("WARC-Date", stamp), ("WARC-Target-URI", url), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit(_CRLF)), F.lit("")), F.lit("via: waymark"), F.lit(_CRLF)))
    # One line of the sink for a capture: its records, apart by what also ends the line.
    rows.select(F.concat_ws(_END, request, response, metadata).alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path)


def _header(text: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for line in text.decode("utf-8", "replace").split(_CRLF)[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), []).append(value.strip())
    return out


def _parsed(head: bytes, block: bytes, file: str) -> dict:
    h = _header(head)
    one = lambda name: h.get(name, [None])[0]
    out = {"file": file, "record_id": one("warc-record-id"), "type": one("warc-type"), "concurrent_to": h.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"), "target_uri": one("warc-target-uri"), "date": one("warc-date"), "payload_digest": one("warc-payload-digest"), "http_length": None, "block": None, "payload": None}
    if (one("content-type") or "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _header(http).get("content-length", [""])[0]
        out |= {"http_length": int(length) if length.isdigit() else None, "block": http.decode("utf-8", "replace"), "payload": None if out["type"] == "revisit" else payload.decode("utf-8", "replace")}
    else:
        out["block"] = block.decode("utf-8", "replace")
    return out


def _records(batches) -> Iterator[pa.RecordBatch]:
    """Records from the pieces of files, in order; holds one record and one batch of output."""
    schema = pa.schema([("file", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("payload_digest", pa.string()), ("http_length", pa.int64()), ("block", pa.string()), ("payload", pa.string())])
    end = _END.encode()
    file, head, need, stream, out, size = None, None, 0, bytearray(), [], 0
    for batch in batches:
        for name, piece in zip(batch.column(0), batch.column(1)):
            name = name.as_py()
            if name != file:
                if head is not None:
                    raise ValueError(f"{file} ends within a record")
                file, stream = name, bytearray()
            stream += piece.as_py().encode() + end
            while True:
                if head is None:
                    blank = len(stream) - len(stream.lstrip(b"\r\n"))
                    del stream[:blank]
                    at = stream.find(end)
                    if at < 0:
                        break
                    head = bytes(stream[:at])
                    if not head.startswith(b"WARC/"):
                        raise ValueError(f"no WARC record in {file}: {head[:40]!r}")
                    need = int(_header(head)["content-length"][0])
                    del stream[: at + len(end)]
                if len(stream) < need:
                    break
                out.append(_parsed(head, bytes(stream[:need]), file))
                size += need + 500
                del stream[:need]
                head = None
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
    if head is not None:
        raise ValueError(f"{file} ends within a record")
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the gzipped WARC files under path; framed by Content-Length, read as a stream.

    A gzipped file is never split, so a task sees its pieces in order. payload is null for
    revisits and for records that aren't HTTP. A file that is not WARC or ends early is an error.
    """
    pieces = spark.read.option("lineSep", _END).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return pieces.mapInArrow(_records, _RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit: response (with any further columns of records), requests, metadata.

    Requests and metadata join the response or revisit that they name in concurrent_to, or that
    names them. Their payloads aren't shuffled: joins carry records without one, and the response
    moves once. A record that leads to no response is left out; a capture may lack the others.
    """
    main = F.col("type").isin("response", "revisit")
    further = [c for c in records.columns if c not in ("type", "record_id", "refers_to", "target_uri", "date", "payload_digest", "http_length", "block", "concurrent_to")]
    response = records.where(main).select(F.col("record_id").alias("capture"), F.struct("type", "record_id", "refers_to", "target_uri", "date", "payload_digest", "http_length", F.col("block").alias("http"), *further).alias("response"), "concurrent_to")
    other = records.where(~main).select("record_id", "type", "target_uri", "date", "block", "concurrent_to")
    named = other.select("record_id", F.explode("concurrent_to").alias("capture"))
    naming = response.select(F.explode("concurrent_to").alias("record_id"), "capture")
    links = named.unionByName(naming).distinct()
    members = other.drop("concurrent_to").join(links, "record_id").withColumn("record", F.struct("record_id", "target_uri", "date", "block"))
    gathered = members.groupBy("capture").agg(F.sort_array(F.collect_set(F.when(F.col("type") == "request", F.col("record")))).alias("requests"), F.sort_array(F.collect_set(F.when(F.col("type") == "metadata", F.col("record")))).alias("metadata"))
    return response.drop("concurrent_to").join(gathered, "capture", "left")


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to archives and back; a row for each capture."""
    path = scratch_path(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    body = F.encode("payload", "UTF-8")
    # The archives are parsed once: what is asked of payloads is computed as they pass, and they go.
    records = stored(read_warc(spark, path).withColumn("n", F.octet_length(body).cast("long")).withColumn("sha", F.sha2(body, 256)).drop("payload", "file"), "records")
    found = captures(records)
    revisit = F.col("response.type") == "revisit"
    rows = found.select(
        "capture",
        F.expr("try_cast(nullif(regexp_extract(metadata[0].block, 'page-id: (-?[0-9]+)', 1), '') as bigint)").alias("page_id"),
        F.when(revisit, F.col("response.http_length")).otherwise(F.col("response.n")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("response.payload_digest", "^sha256:", "")).otherwise(F.col("response.sha")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("to"),
    )
    rows = stored(rows, "captures")
    # Only revisits look for their response, salted, as a response may have any number of them.
    salts = 16
    revisits = rows.where("to is not null").withColumn("salt", F.pmod(F.xxhash64("capture"), F.lit(salts)))
    wanted = revisits.select("to").distinct()
    targets = rows.where("record_type = 'response'").select(F.col("capture").alias("to"), F.col("page_id").alias("refers_to")).distinct().join(wanted, "to", "left_semi")
    salted = targets.select("to", "refers_to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = rows.where("to is null").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.select(*names).unionByName(revisits.join(salted, ["to", "salt"], "left").select(*names))


OP8_SQL = """
with p as (select page_id, sha256(coalesce(html, '')) as d, octet_length(encode(coalesce(html, ''))) as n from pages),
f as (select d, min(page_id) as first from p where n >= 100 group by d)
select page_id, n as payload_bytes, p.d as payload_digest, case when page_id > first then 'revisit' else 'response' end as record_type, case when page_id > first then first end as refers_to
from p left join f on f.d = p.d
"""
