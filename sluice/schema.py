"""Record shape and the fixed values the pipeline must reproduce exactly."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the original service's for identical output ---
# Required form/CSV fields, checked in this order.
REQUIRED_EVENT_FIELDS = ("did", "timestamp", "event_type")
# Parameters that become record fields and are kept out of the extension map.
EVENT_CORE_FIELDS = ("ip", "aid", "did", "timestamp")
# Required postback parameters, checked in this order.
POSTBACK_REQUIRED_FIELDS = ("appid", "adname", "adid", "device", "idfa", "point", "ts", "sign", "keyword")
# Parameters kept out of a postback's extension map.
POSTBACK_DROPPED_FIELDS = ("ip", "aid", "idfa", "timestamp", "keyword", "sign", "ts")
# Constant record values.
TRACKER_EVENT = "TrackerEvent"
POSTBACK_EVENT = "anwo_postback"
POSTBACK_OS = "ios"
CLICK_EVENT = "click"
UNKNOWN = "unknown"
DEFAULT_ROUTE = "default"
# Reply texts (spelling kept as the service writes it).
MISSING_FIELD_MSG = "Missing Required field: No %s"
SIGN_MISMATCH_MSG = "Sign mismatched!"
TS_PARSE_MSG = "Failed to parse ts:"
RECEIPT_FMT = "%d messages have been writen."
NO_HANDLER_MSG = "No handler matched."
TOO_LARGE_MSG = "The file is too large:"
SEND_FAILED_MSG = "Failed to send message to kafka:"
UPLOAD_SEND_FAILED_MSG = "Failed to send to kafka:"
READ_FAILED_MSG = "Err read file:"
EMPTY_UPLOAD_MSG = "Failed to read the first line of file:EOF"
UNREAD_UPLOAD_MSG = "Failed to read upload file:"
RAGGED_ROW_MSG = "wrong number of fields"
BAD_QUOTE_MSG = 'bare " in non-quoted field'
# Limits.
MAX_UPLOAD_BYTES = 10 * 1024 * 1024
MAX_RETRY_GENERATIONS = 100
# Outbound request header.
KEEP_ALIVE_HEADER = "Connection: keep-alive"
# --- end of fixed values ---

# HTTP-style status codes carried in the verdict columns.
OK = 200
BAD_REQUEST = 400
SERVER_ERROR = 500

# RFC 3339 as Spark datetime pattern: 'Z' or +hh:mm offsets, optional fraction.
RFC3339_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"
# RFC 3339 with whole seconds, used when rendering instants.
RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ssXXX"

EXTENSION_TYPE = T.MapType(T.StringType(), T.StringType(), valueContainsNull=True)

# The event record. The original schema file is not available; nullability
# follows which fields every writer sets (event, id, timestamp).
EVENT_RECORD = T.StructType(
    [
        T.StructField("event", T.StringType(), False),
        T.StructField("id", T.StringType(), False),
        T.StructField("timestamp", T.StringType(), False),
        T.StructField("did", T.StringType(), True),
        T.StructField("aid", T.StringType(), True),
        T.StructField("ip", T.StringType(), True),
        T.StructField("os", T.StringType(), True),
        T.StructField("exchange", T.StringType(), True),
        T.StructField("extension", EXTENSION_TYPE, True),
    ]
)
RECORD_FIELDS = tuple(f.name for f in EVENT_RECORD.fields)

# The same record as read back from a codec: nothing can be trusted to be present.
DECODED_RECORD = T.StructType([T.StructField(f.name, f.dataType, True) for f in EVENT_RECORD.fields])

# What a sender reports for a message; a null error means acknowledged.
SEND_RESULT = T.StructType([T.StructField("message_id", T.StringType(), True), T.StructField("error", T.StringType(), True)])

# What a delivery function reports for an outbound request: the reply's status, or the error that kept it from one.
DELIVERY_RESULT = T.StructType(
    [
        T.StructField("request_key", T.StringType(), True),
        T.StructField("status", T.IntegerType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)

# Dead letters: records that could not be written ("unsent", with their payload) and input that
# never became a record ("rejected", with the raw input). ``attempt`` is the try that failed.
UNSENT, REJECTED = "unsent", "rejected"
DEAD_LETTER = T.StructType(
    [
        T.StructField("letter_id", T.StringType(), True),
        T.StructField("kind", T.StringType(), True),
        T.StructField("origin", T.StringType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("record", T.StringType(), True),
        T.StructField("data", T.BinaryType(), True),
        T.StructField("failed_at", T.TimestampType(), True),
        T.StructField("attempt", T.IntegerType(), True),
    ]
)
