"""Record to payload bytes and back.

``codec="json"`` (default) uses ``to_json``/``from_json`` and runs anywhere.
``codec="avro"`` uses Spark's ``to_avro``/``from_avro`` and needs the
``spark-avro`` package on the cluster's classpath.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.forms import materialize
from sluice.schema import DECODED_RECORD, EVENT_RECORD

_CORRUPT = "_corrupt_record"
# the extension is read as raw JSON text first, so a record whose extension is
# not an object (a string, a number, an array) still decodes, without one
_DECODE_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "extension" else f.dataType, True) for f in DECODED_RECORD.fields]
    + [T.StructField(_CORRUPT, T.StringType(), True)]
)


def avro_schema_json() -> str:
    """The record's Avro schema (extension values may be null)."""
    opt = lambda t: ["null", t]
    fields = [
        {"name": "event", "type": "string"},
        {"name": "id", "type": "string"},
        {"name": "timestamp", "type": "string"},
        {"name": "did", "type": opt("string"), "default": None},
        {"name": "aid", "type": opt("string"), "default": None},
        {"name": "ip", "type": opt("string"), "default": None},
        {"name": "os", "type": opt("string"), "default": None},
        {"name": "exchange", "type": opt("string"), "default": None},
        {"name": "extension", "type": opt({"type": "map", "values": ["null", "string"]}), "default": None},
    ]
    return json.dumps({"type": "record", "name": "Event", "fields": fields})


def require_avro() -> None:
    """Fail early and clearly when the ``spark-avro`` package is not on the classpath."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception as exc:  # py4j wraps ClassNotFoundException
        raise RuntimeError("codec='avro' needs the spark-avro package on the Spark classpath") from exc


def encode(rec: Column, codec: str = "json") -> Column:
    """Record struct to BINARY payload."""
    if codec == "json":
        return F.encode(F.to_json(rec, {"ignoreNullFields": "false"}), "UTF-8")
    if codec == "avro":
        require_avro()
        from pyspark.sql.avro.functions import to_avro

        return to_avro(rec, avro_schema_json())
    raise ValueError(f"unknown codec {codec!r}")


def decode_struct(value: Column, codec: str = "json") -> Column:
    """BINARY payload to a struct with the record fields plus ``_corrupt_record``."""
    if codec == "json":
        text = value.cast("string")  # no charset check here: bad bytes surface as a corrupt record
        return F.from_json(text, _DECODE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    if codec == "avro":
        require_avro()
        from pyspark.sql.avro.functions import from_avro

        dec = from_avro(value, avro_schema_json(), {"mode": "PERMISSIVE"})
        return F.struct(*[dec[f.name].alias(f.name) for f in EVENT_RECORD.fields], F.when(dec.isNull(), F.lit("undecodable")).alias(_CORRUPT))
    raise ValueError(f"unknown codec {codec!r}")


def _is_object(text: Column, extension: Column) -> Column:
    """Whether the record's extension is a JSON object, by its type: a string that spells an object is none.

    ``extension`` is its text with the type lost, so only where that looks like
    an object is the record read as a variant. A record that is no variant (it
    repeats a key) is taken by its text.
    """
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), "$.extension", "variant"))
    return F.ltrim(extension).startswith("{") & F.coalesce(kind.startswith("OBJECT"), F.lit(True))


def decode(df: DataFrame, value: str = "value", codec: str = "json", out: str = "record", ok: str = "decoded") -> DataFrame:
    """Add ``record`` (null when undecodable) and ``decoded`` (bool)."""
    df = materialize(df, {"_dec": decode_struct(F.col(value), codec)})
    d = F.col("_dec")
    good = F.col(value).isNotNull() & d.isNotNull() & d[_CORRUPT].isNull()
    if codec == "json":
        ext = F.when(_is_object(F.col(value).cast("string"), d["extension"]), F.from_json(d["extension"], "map<string,string>"))
    else:
        ext = d["extension"]
    rec = F.struct(*[(ext if f.name == "extension" else d[f.name]).alias(f.name) for f in EVENT_RECORD.fields])
    return materialize(df, {ok: good, out: F.when(good, rec)}).drop("_dec")
