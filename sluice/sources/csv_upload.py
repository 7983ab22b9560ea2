"""CSV uploads to event records.

An upload's first line that is not blank names its columns, in any order.
``did``, ``aid``, ``ip`` and ``timestamp`` become record fields; every other
column goes into the extension (so ``event_type`` is there too). When a name
repeats, its last column wins. ``did``, ``timestamp`` and ``event_type`` are
required (checked in that order on the header; a file without one is rejected
whole), a file above 10 MiB is rejected whole, and a row with the wrong number
of fields or a stray quote is quarantined: every good row is kept and each bad
one is reported. ``until_fault`` gives the original's way instead: a file stops
at its first bad row, the rows before it are kept and the reply is an error.

Plan: one ``binaryFile`` scan. A file is one row, bounded by the 10 MiB cap (a
larger one is never read: the size filter is pushed into the scan). Built-in
expressions cut its text into records and each record into fields, and the
header is the first record of the same row. So there is no shuffle, nothing
reaches the driver, file names are never read as globs, and the same function
parses a micro-batch of files.

Spark's file listing leaves out empty files and names that begin with a dot or
an underscore. Give ``manifest`` (a row per upload request: file_path,
file_size) and each of its uploads gets a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.forms import materialize
from sluice.functions.maps import nonempty_map
from sluice.operators.assemble import csv_record
from sluice.schema import (
    BAD_QUOTE_MSG,
    BAD_REQUEST,
    EMPTY_UPLOAD_MSG,
    MAX_UPLOAD_BYTES,
    MISSING_FIELD_MSG,
    OK,
    RAGGED_ROW_MSG,
    READ_FAILED_MSG,
    RECEIPT_FMT,
    REQUIRED_EVENT_FIELDS,
    SERVER_ERROR,
    TOO_LARGE_MSG,
    UNREAD_UPLOAD_MSG,
    UPLOAD_SEND_FAILED_MSG,
)

CORE_FIELDS = ("did", "aid", "ip", "timestamp")
BOM = "\ufeff"
# A quoted field, one whose quote is never closed, or a plain one. Possessive, so long fields need no backtracking.
_QUOTED = r'"(?:[^"]++|"")*+"'
_FIELD = rf'(?:{_QUOTED}(?=[,\r\n]|\z)|"(?:[^"]++|"")*+\z|[^,\n]*+)'
_RECORD = rf"{_FIELD}(?:,{_FIELD})*+(?:\r?\n|\z)"
# The first record that is not blank.
_HEAD = rf"\A(?:\r?\n)*+({_RECORD})"


def list_uploads(spark: SparkSession, paths: str | list[str], glob: str = "*.csv") -> DataFrame:
    """One row per upload file: ``path``, ``length``, ``content`` (read only where it is used)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(paths)


def _fields(record: Column) -> Column:
    """The fields of a record as they are written; every match begins with a comma, so none is empty."""
    return F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_FIELD})"), F.lit(1))


def _is_bad(field: Column) -> Column:
    """A quote in a field that is not quoted as a whole."""
    return (F.instr(field, '"') > 0) & ~field.rlike(rf"^{_QUOTED}\z")


def _value(field: Column) -> Column:
    inner = F.replace(F.replace(field.substr(F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"')), F.lit("\r\n"), F.lit("\n"))
    return F.when(F.startswith(field, F.lit('"')), inner).otherwise(field)


def _without_line_end(record: Column) -> Column:
    return F.regexp_replace(record, r"\r?\n\z", "")


def with_headers(files: DataFrame) -> DataFrame:
    """Uploads within the cap with their ``text``, the ``head`` record, column ``names`` and whether the header is well formed.

    Only the first record is cut out of the text.
    """
    text = F.col("content").cast("string")
    df = files.where(F.col("length") <= MAX_UPLOAD_BYTES).select("path", "length", F.when(F.startswith(text, F.lit(BOM)), F.substring(text, 2, MAX_UPLOAD_BYTES)).otherwise(text).alias("text"))
    df = materialize(df, {"text": F.col("text"), "head": _without_line_end(F.regexp_extract("text", _HEAD, 1))}, replace=True)
    df = materialize(df, {"header": _fields(F.col("head"))})
    return df.withColumns({"header_bad": F.exists("header", _is_bad), "names": F.transform("header", _value)})


def _verdict(df: DataFrame) -> tuple[Column, Column]:
    """Status and reason of a file with its header."""
    checks = [(F.col("head").isin("", "\r"), SERVER_ERROR, EMPTY_UPLOAD_MSG), (F.col("header_bad"), SERVER_ERROR, "Failed to read the first line of file:" + BAD_QUOTE_MSG)]
    checks += [(~F.array_contains("names", f), BAD_REQUEST, MISSING_FIELD_MSG % f) for f in REQUIRED_EVENT_FIELDS]
    status, reason = F.lit(OK), F.lit(None).cast("string")
    for bad, code, text in reversed(checks):
        status, reason = F.when(bad, F.lit(code)).otherwise(status), F.when(bad, F.lit(text)).otherwise(reason)
    return status, reason


def _too_large(size: Column) -> Column:
    return F.concat(F.lit(TOO_LARGE_MSG), size.cast("string"), F.lit("bytes"))


def file_sizes(files: DataFrame) -> DataFrame:
    """F4 from the listing alone: ``file_path``, ``file_size``, ``within_cap``; no content is read."""
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), (F.col("length") <= MAX_UPLOAD_BYTES).alias("within_cap"))


def file_verdicts(files: DataFrame) -> DataFrame:
    """F4 then F2 per file: ``file_path``, ``file_size``, ``status``, ``reason`` (200/null when the file may be read)."""
    columns = [F.col("path").alias("file_path"), F.col("length").alias("file_size")]
    large = files.where(F.col("length") > MAX_UPLOAD_BYTES)
    large = large.select(*columns, F.lit(BAD_REQUEST).alias("status"), _too_large(F.col("length")).alias("reason"))
    read = with_headers(files)
    status, reason = _verdict(read)
    return read.select(*columns, status.alias("status"), reason.alias("reason")).unionByName(large)


def _fault(fields: Column, n: Column) -> Column:
    """Why a record can't be read, null if it can."""
    return F.when(F.exists(fields, _is_bad), F.lit(BAD_QUOTE_MSG)).when(F.size(fields) != n, F.lit(RAGGED_ROW_MSG))


def upload_rows(files: DataFrame, until_fault: bool = False) -> DataFrame:
    """One row per data record of every accepted file: file, ``line`` (its number among them), ``status``/``reason``, ``record``, ``event_type``, ``raw_line``.

    With ``until_fault`` a file ends at its first faulty record, as the
    original does: the records before it and the faulty one are returned. A
    file's records are one array in order, so the cut needs no shuffle.
    """
    read = with_headers(files)
    read = read.where(_verdict(read)[0] == OK)
    n = F.size("names")
    backwards = F.reverse("names")

    def last(name) -> Column:
        """Place of the last column of a name, null without one."""
        at = F.array_position(backwards, name)
        return F.when(at > 0, (n - at).cast("int"))

    read = materialize(read, {f"{f}_at": last(F.lit(f)) for f in (*CORE_FIELDS, "event_type")})
    others = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (last(F.get("names", i)) == i) & ~F.get("names", i).isin(*CORE_FIELDS))
    read = materialize(read, {"other_at": others})
    read = read.withColumn("other_names", F.transform("other_at", lambda i: F.get("names", i)))
    records = F.filter(F.transform(F.regexp_extract_all("text", F.lit(_RECORD), F.lit(0)), _without_line_end), lambda r: ~r.isin("", "\r"))
    read = materialize(read, {"records": F.slice(records, 2, MAX_UPLOAD_BYTES)}).drop("text")
    if until_fault:
        first = F.array_position(F.transform("records", lambda r: _fault(_fields(r), n).isNotNull()), True)
        read = materialize(read, {"first_fault": first})
        cut = F.when(F.col("first_fault") > 0, F.slice("records", F.lit(1), F.col("first_fault").cast("int"))).otherwise(F.col("records"))
        read = read.withColumn("records", cut)
    rows = read.select("*", F.posexplode("records").alias("at", "raw")).drop("records")
    rows = materialize(rows, {"raw_fields": _fields(F.col("raw"))})
    rows = materialize(rows, {"values": F.transform("raw_fields", _value), "fault": _fault(F.col("raw_fields"), n)})
    good = F.col("fault").isNull()
    fields = {f: F.get("values", F.col(f"{f}_at")) for f in CORE_FIELDS}
    extension = nonempty_map(F.map_from_arrays("other_names", F.transform("other_at", lambda i: F.get("values", i))))
    return rows.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        (F.col("at") + 1).alias("line"),
        F.when(good, F.lit(OK)).otherwise(F.lit(SERVER_ERROR)).alias("status"),
        F.concat(F.lit(READ_FAILED_MSG), F.col("fault")).alias("reason"),
        F.when(good, csv_record(fields, extension)).alias("record"),
        F.when(good, F.get("values", F.col("event_type_at"))).alias("event_type"),
        F.when(~good, F.col("raw")).alias("raw_line"),
    )


def upload_replies(rows: DataFrame, verdicts: DataFrame, until_fault: bool = False, refused: DataFrame | None = None) -> DataFrame:
    """A1: the reply to every upload of ``verdicts``: ``file_path``, ``status``, ``n_written``, ``reply``.

    A file that is read ends with its receipt, of 0 messages too; with
    ``until_fault`` the first fault ends it with an error instead. ``refused``
    (file_path, n_refused, error) counts messages that the sink didn't take:
    such an upload ends with their error, and they aren't counted as written.
    """
    ok = F.col("status") == OK
    counts = rows.groupBy("file_path").agg(F.count_if(ok).alias("n_ok"), F.min_by("reason", F.when(~ok, F.col("line"))).alias("fault"))
    told = verdicts.select("file_path", "status", "reason").join(counts, "file_path", "left")
    if refused is None:
        told = told.withColumns({"n_refused": F.lit(0), "error": F.lit(None).cast("string")})
    else:
        told = told.join(refused.select("file_path", "n_refused", "error"), "file_path", "left")
    told = told.withColumn("n_written", F.coalesce("n_ok", F.lit(0)) - F.coalesce("n_refused", F.lit(0)))
    fault = F.col("fault") if until_fault else F.lit(None).cast("string")
    ended = F.coalesce(F.concat(F.lit(UPLOAD_SEND_FAILED_MSG), F.col("error")), fault)
    status = F.when(F.col("status") != OK, F.col("status")).when(ended.isNotNull(), F.lit(SERVER_ERROR)).otherwise(F.lit(OK))
    reply = F.when(F.col("status") != OK, F.col("reason")).otherwise(F.coalesce(ended, F.format_string(RECEIPT_FMT, F.col("n_written"))))
    return told.select("file_path", status.alias("status"), "n_written", reply.alias("reply"))


def with_manifest(verdicts: DataFrame, manifest: DataFrame) -> DataFrame:
    """A verdict for every upload of ``manifest`` (file_path, file_size): an empty one ends at once, an unlisted one cannot be read."""
    told = manifest.select("file_path", F.col("file_size").alias("sent")).join(verdicts, "file_path", "left")
    none = F.col("status").isNull()
    too_large = _too_large(F.col("sent"))
    reason = F.when(F.col("sent") == 0, F.lit(EMPTY_UPLOAD_MSG)).when(F.col("sent") > MAX_UPLOAD_BYTES, too_large).otherwise(F.lit(UNREAD_UPLOAD_MSG))
    status = F.when(F.col("sent") > MAX_UPLOAD_BYTES, F.lit(BAD_REQUEST)).otherwise(F.lit(SERVER_ERROR))
    return told.select(
        "file_path",
        F.coalesce("file_size", "sent").alias("file_size"),
        F.when(none, status).otherwise(F.col("status")).alias("status"),
        F.when(none, reason).otherwise(F.col("reason")).alias("reason"),
    )


def read_event_csv(
    spark: SparkSession, paths: str | list[str], glob: str = "*.csv", manifest: DataFrame | None = None, until_fault: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Returns ``(rows, files)``: see ``upload_rows`` and ``file_verdicts``; with ``manifest`` every upload in it has a verdict."""
    uploads = list_uploads(spark, paths, glob)
    verdicts = file_verdicts(uploads)
    return upload_rows(uploads, until_fault), verdicts if manifest is None else with_manifest(verdicts, manifest)
