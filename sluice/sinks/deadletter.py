"""K4/K5: records that could not be written, as rows of one layout.

The original appended three text lines per failure (``error:``, ``record:``,
``data: [b0 b1 ...]``) to a backup log and replayed ``data:`` lines later;
lines failing again went to ``backup.log.N`` for the first free N below 100.
Here a dead letter is a row (``schema.DEAD_LETTER``) named by a digest of its
kind, topic, origin and payload, so the same failure has the same name however
often it is reported; ``sinks.ledger`` keeps the letters and what became of
them. The text form is kept for old logs (``backup_lines``,
``sources.backup_log``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.bytelist import bytes_to_list_text
from sluice.schema import MAX_RETRY_GENERATIONS, UNSENT

LOG_TIME = "yyyy/MM/dd HH:mm:ss"


def message_id(topic: Column, origin: Column, data: Column, kind: Column | str = UNSENT) -> Column:
    """Digest that names a message, and its dead letter: of kind, topic, origin and payload, each told from an absent one."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws("\n", kind, *[F.coalesce(F.concat(F.lit("="), F.hex(c.cast("string"))), F.lit("-")) for c in (topic, origin)])
    return F.sha2(F.concat(F.encode(head, "UTF-8"), F.coalesce(F.concat(F.encode(F.lit("\n="), "UTF-8"), data.cast("binary")), F.encode(F.lit("\n-"), "UTF-8"))), 256)


def packed(name: Column | str) -> Column:
    """A digest's text as its 32 bytes, for shuffles by name; another text is longer than that, so no two names become one."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(name.rlike(r"\A[0-9a-f]{64}\z"), F.unhex(name)).otherwise(F.encode(F.concat(name, F.lit(" " * 33)), "UTF-8"))


def unpacked(name: Column | str) -> Column:
    """The text that ``packed`` was given."""
    name = F.col(name) if isinstance(name, str) else name
    text = F.decode(name, "UTF-8")
    return F.when(F.octet_length(name) == 32, F.lower(F.hex(name))).otherwise(F.left(text, F.length(text) - 33))


def to_dead_letters(
    df: DataFrame,
    error: Column,
    record: Column | None,
    data: Column,
    topic: Column,
    attempt: Column | int = 0,
    origin: Column | None = None,
    kind: str = UNSENT,
) -> DataFrame:
    """Rows of the dead-letter layout; ``record`` (any struct or map) is kept as JSON text, ``origin`` says where the data came from."""
    att = F.lit(attempt) if isinstance(attempt, int) else attempt
    origin = (F.lit(None) if origin is None else origin).cast("string")
    return df.select(
        message_id(topic, origin, data, kind).alias("letter_id"),
        F.lit(kind).alias("kind"),
        origin.alias("origin"),
        topic.cast("string").alias("topic"),
        error.cast("string").alias("error"),
        (F.to_json(record) if record is not None else F.lit(None).cast("string")).alias("record"),
        data.cast("binary").alias("data"),
        F.current_timestamp().alias("failed_at"),
        att.cast("int").alias("attempt"),
    )


def backup_lines(dead: DataFrame, dated: bool = True) -> DataFrame:
    """The legacy text form: ``error:``, ``record:`` and ``data: [..]`` lines, one ``value`` each."""
    prefix = F.concat(F.date_format("failed_at", LOG_TIME), F.lit(" ")) if dated else F.lit("")
    lines = F.array(
        F.concat(prefix, F.lit("error: "), F.col("error")),
        F.concat(prefix, F.lit("record: "), F.col("record")),
        F.concat(prefix, F.lit("data: "), bytes_to_list_text(F.col("data"))),
    )
    return dead.select(F.explode(lines).alias("value"))


def next_generation(df: DataFrame, attempt: str = "attempt", verdict: str = "verdict") -> DataFrame:
    """K5: failed rows move to the next attempt; past the last generation they are ``exhausted``.

    Adds ``next_attempt`` (null when exhausted or not failed) and ``retry``
    (``ok``/``retry``/``exhausted``).
    """
    failed = F.col(verdict) != "ok"
    nxt = F.col(attempt) + 1
    can = nxt <= MAX_RETRY_GENERATIONS
    return df.withColumns(
        {
            "next_attempt": F.when(failed & can, nxt),
            "retry": F.when(~failed, F.lit("ok")).when(can, F.lit("retry")).otherwise(F.lit("exhausted")),
        }
    )
