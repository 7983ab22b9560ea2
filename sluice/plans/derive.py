"""Inputs derived from the driver's ``events`` and ``pages`` tables.

The service took HTTP requests, CSV uploads and topic messages; the test data
are relational tables. These functions render every row of ``events`` into the
service's input shapes with Spark expressions, so the work grows with the
table. Edge cases (missing, repeated, malformed or damaged fields) are chosen
deterministically from ``event_id``; no row is dropped. The DuckDB oracle
(``sluice.plans.oracle``) states the expected outcome of the same rules
directly from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.schema import MAX_UPLOAD_BYTES, POSTBACK_REQUIRED_FIELDS, RECORD_FIELDS


def _i() -> Column:
    return F.col("event_id")


def _u() -> Column:
    return F.col("user_id")


def _m(n: int) -> Column:
    return F.pmod(_i(), F.lit(n))


def ts_text() -> Column:
    """Event time as text: RFC 3339 in UTC, with a +08:00 offset, or epoch seconds."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return (
        F.when(_m(10) == 5, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .when(_m(10) == 7, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), fmt), F.lit("+08:00")))
        .otherwise(F.concat(F.date_format(F.col("ts"), fmt), F.lit("Z")))
    )


def device_id() -> Column:
    return F.concat(F.lit("dev-"), _u().cast("string"))


def ip_addr() -> Column:
    octets = [F.pmod(_u(), F.lit(256)), _m(256), F.pmod(F.floor(_i() / 256), F.lit(256))]
    return F.concat_ws(".", F.lit("10"), *[o.cast("string") for o in octets])


def k_of_props() -> Column:
    return F.regexp_extract(F.col("props"), r'"k": *(-?[0-9]+)', 1)


def value_text() -> Column:
    return F.col("value").cast("string")


def _when(cond: Column, text: Column | str) -> Column:
    return F.when(cond, F.lit(text) if isinstance(text, str) else text)


def request_log(events: DataFrame) -> DataFrame:
    """One form request per event (request log schema)."""
    enc = F.url_encode
    body = F.concat_ws(
        "&",
        _when(~_m(7).isin(1, 4), F.concat(F.lit("did="), enc(device_id()))),
        _when(_m(7) != 3, F.concat(F.lit("event_type="), enc(F.col("event_type")))),
        F.concat(F.lit("value="), enc(value_text())),
        F.concat(F.lit("k="), k_of_props()),
        _when(_m(6) == 3, "note="),
        _when(_m(8) == 0, "flag"),
        _when(_m(9) == 0, "bad=%zz"),
    )
    query = F.concat_ws(
        "&",
        _when(~_m(7).isin(2, 4), F.concat(F.lit("timestamp="), enc(ts_text()))),
        _when(_m(3) != 0, F.concat(F.lit("ip="), ip_addr())),
        _when(_m(5) != 0, F.concat(F.lit("aid=a"), _i().cast("string"))),
        _when(_m(5) == 2, ""),
        _when(_m(4) == 0, F.concat(F.lit("did=other-"), _i().cast("string"))),
        _when(_m(6) == 0, "k=999"),
        _when(_m(11) == 0, "q=a%3Db%3Dc%26d+e"),
        _when(_m(13) == 0, "event=fake&id=fake"),
    )
    xff = (
        F.when(_m(3) == 0, F.lit(""))
        .when(_m(3) == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("203.0.113."), _m(250).cast("string")))
    )
    remote = F.concat(ip_addr(), F.lit(":"), (F.lit(1024) + _m(50000)).cast("string"))
    return events.select(
        _i().alias("request_id"),
        F.lit("/event").alias("path"),
        query.alias("query"),
        body.alias("body"),
        xff.alias("x_forwarded_for"),
        remote.alias("remote_addr"),
    )


def epoch_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def postback_ts() -> Column:
    """``ts`` parameter: epoch ms, or one of the malformed forms by ``event_id % 23``."""
    m = _m(23)
    return (
        F.when(m == 1, F.lit(" 12 "))
        .when(m == 2, F.lit("1e3"))
        .when(m == 3, F.lit(""))
        .when(m == 4, F.lit("99999999999999999999"))
        .when(m == 5, F.lit("-5"))
        .when(m == 6, F.lit("253402300800000"))
        .otherwise(epoch_ms().cast("string"))
    )


def postback_requests(events: DataFrame, key: str) -> DataFrame:
    """One signed partner postback per event (request log schema)."""
    vals = {
        "appid": F.concat(F.lit("app"), F.pmod(_u(), F.lit(50)).cast("string")),
        "adname": F.concat(F.lit("ad-"), F.col("event_type")),
        "adid": _m(1000).cast("string"),
        "device": F.concat(F.lit("iPhone"), (F.pmod(_u(), F.lit(5)) + 8).cast("string")),
        "idfa": F.concat(F.lit("idfa-"), _u().cast("string")),
        "point": k_of_props(),
        "ts": postback_ts(),
        "keyword": F.concat(F.lit("kw"), _i().cast("string")),
    }

    def signed(k: str) -> Column:
        parts = []
        for name in ("adid", "adname", "appid", "device", "idfa", "point", "ts"):
            parts += [F.lit(f"{name}="), vals[name]]
        return F.md5(F.concat(*parts, F.lit("key="), F.lit(k)))

    m17 = _m(17)
    vals["sign"] = (
        F.when(m17 == 3, signed(key + "-wrong"))
        .when(m17 == 5, F.upper(signed(key)))
        .when(m17 == 7, F.concat(signed(key), F.lit(",x1")))
        .otherwise(signed(key))
    )
    missing = _m(19)

    def part(pos: int, name: str) -> Column:
        return F.when(missing != pos + 1, F.concat(F.lit(name + "="), F.url_encode(vals[name])))

    body = F.concat_ws("&", *[part(p, n) for p, n in enumerate(POSTBACK_REQUIRED_FIELDS) if p < 4])
    query = F.concat_ws(
        "&",
        *[part(p, n) for p, n in enumerate(POSTBACK_REQUIRED_FIELDS) if p >= 4],
        _when(_m(3) != 0, F.concat(F.lit("ip="), ip_addr())),
        _when(_m(4) == 1, F.concat(F.lit("aid=a"), _i().cast("string"), F.lit("&timestamp=t"), _i().cast("string"))),
        F.concat(F.lit("channel=c"), _m(3).cast("string")),
    )
    return events.select(
        _i().alias("request_id"),
        F.lit("/postback").alias("path"),
        query.alias("query"),
        body.alias("body"),
        F.lit(None).cast("string").alias("x_forwarded_for"),
        F.concat(ip_addr(), F.lit(":443")).alias("remote_addr"),
    )


def _entry(key: str, value: Column, present: Column | None = None) -> Column:
    return F.struct(F.lit(key).alias("key"), value.alias("value"), (present if present is not None else F.lit(True)).alias("present"))


def click_record() -> Column:
    """The record a bidder would publish for this event, with fields damaged by rule."""
    from sluice.operators.assemble import record

    k = k_of_props().cast("int")
    adv = (
        F.when(_m(5) == 2, F.lit(""))
        .when(_m(10) == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("adv"), F.pmod(_u(), F.lit(100)).cast("string")))
    )
    osv_text = F.concat((F.pmod(k, F.lit(10)) + 7).cast("string"), F.lit("."), F.pmod(k, F.lit(3)).cast("string"))
    osv = F.when(_m(8) == 5, F.lit("")).otherwise(osv_text)
    model = F.when(_m(11) == 6, F.lit("")).otherwise(F.concat(F.lit("iPhone"), (F.pmod(_u(), F.lit(5)) + 8).cast("string")))
    campaign = F.when(_m(7) == 6, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), _m(4).cast("string")))
    entries = F.array(
        _entry("adv_id", adv, _m(5) != 1),
        _entry("os_version", osv, _m(8) != 3),
        _entry("device_model", model, _m(11) != 4),
        _entry("event_type", F.col("event_type")),
        _entry("campaign", campaign),
    )
    kept = F.transform(F.filter(entries, lambda e: e["present"]), lambda e: F.struct(e["key"], e["value"]))
    ext = F.when(_m(31) != 0, F.map_from_entries(kept))
    return record(
        event=F.when(_m(97) != 3, F.col("event_type")),
        id=F.when(_m(37) != 2, F.concat(F.lit("auc-"), _i().cast("string"))),
        timestamp=ts_text(),
        did=F.when(_m(41) != 3, device_id()),
        ip=F.when(_m(13) != 0, ip_addr()),
        extension=ext,
    )


def click_messages(events: DataFrame, topic: str = "clicks") -> DataFrame:
    """Topic messages (``offset`` = event_id) carrying encoded click records; a few are corrupt."""
    from sluice.operators.codec import encode

    whole = click_record()
    bare = F.struct(*[(F.lit(None).cast("map<string,string>") if n == "extension" else whole[n]).alias(n) for n in RECORD_FIELDS])
    text = encode(bare).cast("string")
    # extensions of another JSON type than an object; the first spells one
    other = F.when(_m(101) == 1, F.lit('"{\\"adv_id\\":\\"a\\",\\"device_model\\":\\"m\\"}"')).when(_m(101) == 2, F.lit("17")).when(_m(101) == 3, F.lit('[{"adv_id":"a"}]'))
    other = F.concat(F.lit('"extension":'), other.otherwise(F.lit('"adv_id"')))
    value = (
        F.when(_m(89) == 7, F.encode(F.lit("not a record"), "UTF-8"))
        .when(_m(89) == 8, F.lit(None).cast("binary"))
        .when(_m(101).isin(1, 2, 3, 4), F.encode(F.replace(text, F.lit('"extension":null'), other), "UTF-8"))
        .otherwise(encode(whole))
    )
    return events.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        _i().alias("offset"),
        F.lit(None).cast("binary").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def stored_record() -> Column:
    """The form-event record of an event, as the service stored it."""
    from sluice.operators.assemble import record

    ext = F.create_map(
        F.lit("event_type"), F.col("event_type"),
        F.lit("value"), value_text(),
        F.lit("k"), k_of_props(),
    )
    return record(
        event=F.lit("TrackerEvent"),
        id=F.lit(""),
        timestamp=ts_text(),
        did=device_id(),
        aid=F.concat(F.lit("a"), _i().cast("string")),
        ip=F.when(_m(3) != 0, ip_addr()),
        extension=ext,
    )


def write_backup_logs(events: DataFrame, root: str) -> str:
    """Write backup logs for every event under ``root``; return ``root``.

    ``backup.log`` (event_id % 5 != 4) holds dated error/record/data triples;
    ``backup.log.0`` (% 10 == 4) and ``backup.log.99`` (% 10 == 9) hold bare
    ``data:`` lines as retry generations do. Payloads are damaged by
    ``event_id % 43``: 1 = a number above 255, 2 = bytes that are not a
    record, 3 = an empty list.
    """
    from sluice.functions.bytelist import bytes_to_list_text
    from sluice.operators.codec import encode

    payload = encode(stored_record())
    m43 = _m(43)
    listed = bytes_to_list_text(payload)
    data_text = (
        F.when(m43 == 1, F.concat(F.regexp_replace(listed, r"\]$", ""), F.lit(" 300]")))
        .when(m43 == 2, bytes_to_list_text(F.encode(F.lit("garbage"), "UTF-8")))
        .when(m43 == 3, F.lit("[]"))
        .otherwise(listed)
    )
    stamp = F.concat(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.lit(" "))
    note = F.when(_m(29) == 0, F.lit(" note data: [1 2 3]")).otherwise(F.lit(""))
    dated = F.array(
        F.concat(stamp, F.lit("error: kafka: Failed to produce message to topic")),
        F.concat(stamp, F.lit("record: aid=a"), _i().cast("string"), note),
        F.concat(stamp, F.lit("data: "), data_text),
    )
    bare = F.array(F.concat(F.lit("data: "), data_text))
    fname = F.when(_m(5) != 4, F.lit("backup.log")).when(_m(10) == 4, F.lit("backup.log.0")).otherwise(F.lit("backup.log.99"))
    lines = events.select(fname.alias("file"), F.explode(F.when(_m(5) != 4, dated).otherwise(bare)).alias("value"))
    lines.write.mode("overwrite").partitionBy("file").text(root)
    return root


# CSV upload variants by upload_id % 4: header names, in file order.
UPLOAD_ROWS = 500
# Uploads beside those of the rows, numbered from these: header only, above the size cap, empty, missing.
HEADER_ONLY, OVERSIZED, EMPTY, MISSING = 1_000_000_000, 2_000_000_000, 3_000_000_000, 4_000_000_000
UPLOAD_HEADERS = (
    ("did", "timestamp", "event_type", "ip", "aid", "value", "k", "note"),
    ("event_type", "k", "value", "timestamp", "did"),
    ("did", "timestamp", "event_type", "did", "value"),
    ("did", "event_type", "value"),
)


def _csv_quote(c: Column) -> Column:
    return F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def csv_note() -> Column:
    return (
        F.when(_m(7) == 0, F.lit('x,"y"'))
        .when(_m(11) == 0, F.lit("line\nbreak"))
        .when(_m(13) == 0, F.lit(""))
        .otherwise(F.concat(F.lit("n"), _i().cast("string")))
    )


def write_uploads(events: DataFrame, root: str) -> str:
    """One CSV upload per ``UPLOAD_ROWS`` events under ``root/upload_id=N/``; return ``root``.

    Rows with ``event_id % 53 == 0`` get an extra field, ``% 59 == 0`` lose
    their last field. Variant 2's header starts with a byte-order mark and
    names ``did`` twice (the first column holds junk). Beside upload N there is
    one with a header only if ``N % 4 == 1``, and one above the size cap if
    ``N % 50 == 3``.
    """
    upload = F.floor(_i() / UPLOAD_ROWS)
    variant = F.pmod(upload, F.lit(4))
    vals = {
        "did": device_id(),
        "timestamp": ts_text(),
        "event_type": F.col("event_type"),
        "ip": F.when(_m(3) != 0, ip_addr()).otherwise(F.lit("")),
        "aid": F.concat(F.lit("a"), _i().cast("string")),
        "value": value_text(),
        "k": k_of_props(),
        "note": csv_note(),
    }

    def fields(v: int) -> Column:
        names = list(UPLOAD_HEADERS[v])
        cols = [_csv_quote(vals[n]) for n in names]
        if v == 2:
            cols[0] = F.concat(F.lit("junk-"), _i().cast("string"))
        long_row = F.array(*cols, F.lit("extra"))
        short_row = F.array(*cols[:-1])
        return F.when(_m(53) == 0, long_row).when(_m(59) == 0, short_row).otherwise(F.array(*cols))

    line = F.array_join(
        F.when(variant == 0, fields(0)).when(variant == 1, fields(1)).when(variant == 2, fields(2)).otherwise(fields(3)), ","
    )
    rows = events.select(upload.alias("upload_id"), _i().alias("line_no"), line.alias("value"))
    uid = F.col("upload_id")
    header = (
        F.when(F.pmod(uid, F.lit(4)) == 0, F.lit(",".join(UPLOAD_HEADERS[0])))
        .when(F.pmod(uid, F.lit(4)) == 1, F.lit(",".join(UPLOAD_HEADERS[1])))
        .when(F.pmod(uid, F.lit(4)) == 2, F.lit("﻿" + ",".join(UPLOAD_HEADERS[2])))
        .otherwise(F.lit(",".join(UPLOAD_HEADERS[3])))
    )
    headers = rows.select("upload_id").distinct().select("upload_id", F.lit(-1).cast("long").alias("line_no"), header.alias("value"))
    ids, first = rows.select("upload_id").distinct(), F.lit(-1).cast("long").alias("line_no")
    plain = F.lit(",".join(UPLOAD_HEADERS[0])).alias("value")
    only = ids.where("upload_id % 4 = 1").select((F.col("upload_id") + HEADER_ONLY).alias("upload_id"), first, plain)
    large = ids.where("upload_id % 50 = 3").select((F.col("upload_id") + OVERSIZED).alias("upload_id"), first, plain)
    # made after the shuffle and the sort, which would hold it otherwise
    above = uid.between(OVERSIZED, EMPTY - 1) & (F.col("line_no") == -1)
    filler = F.when(above, F.concat(F.lit("\n"), F.repeat(F.lit("x"), F.when(above, F.lit(MAX_UPLOAD_BYTES)).otherwise(F.lit(0))))).otherwise(F.lit(""))
    (
        rows.unionByName(headers)
        .unionByName(only)
        .unionByName(large)
        .repartition("upload_id")
        .sortWithinPartitions("upload_id", "line_no")
        .select("upload_id", F.concat("value", filler).alias("value"))
        .write.mode("overwrite")
        # a folder an upload: tasks put their own in place, not the driver one after the other; _SUCCESS says when all are there
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .partitionBy("upload_id")
        .text(root)
    )
    return root


def upload_requests(events: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """The upload requests (file_path, file_size): one a file, and beside upload N an empty one if ``N % 5 == 0``, a missing one if ``N % 5 == 2``."""
    ids = events.select(F.floor(_i() / UPLOAD_ROWS).alias("u")).distinct()

    def beside(rule: str, first: int, size: int) -> DataFrame:
        path = F.concat(F.lit(f"{root}/upload_id="), (F.col("u") + first).cast("string"), F.lit("/upload.txt"))
        return ids.where(rule).select(path.alias("file_path"), F.lit(size).cast("long").alias("file_size"))

    sent = files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    return sent.unionByName(beside("u % 5 = 0", EMPTY, 0)).unionByName(beside("u % 5 = 2", MISSING, 99))


def prefix_table(pages: DataFrame) -> DataFrame:
    """Prefixes from ``pages``: every beginning of every second page's URL, with repeats, ``/`` and a null."""
    url = F.col("url")
    starts = pages.where("page_id % 2 = 0").select(F.explode(F.transform(F.sequence(F.lit(1), F.length(url)), lambda n: F.substring(url, F.lit(1), n))).alias("prefix"))
    odd = pages.select(F.explode(F.array(F.lit("/"), F.lit(None).cast("string"))).alias("prefix")).distinct()
    return starts.unionByName(odd)
