"""Column-level building blocks (all built-in Spark expressions, no Python UDFs)."""

from sluice.functions.bytelist import bytes_to_list_text, list_text_to_bytes, list_text_is_valid
from sluice.functions.forms import decode_path, parse_form, with_form_params
from sluice.functions.maps import fill_unknown, has_key, map_without, nonempty_map, sorted_keys
from sluice.functions.sign import first_item, postback_sign
from sluice.functions.timefmt import epoch_ms_in_range, epoch_ms_to_rfc3339, event_time, now_epoch_seconds, parse_rfc3339, rfc3339_to_epoch_ms

__all__ = [
    "bytes_to_list_text",
    "decode_path",
    "epoch_ms_in_range",
    "epoch_ms_to_rfc3339",
    "event_time",
    "fill_unknown",
    "first_item",
    "has_key",
    "list_text_is_valid",
    "list_text_to_bytes",
    "map_without",
    "now_epoch_seconds",
    "nonempty_map",
    "parse_form",
    "with_form_params",
    "parse_rfc3339",
    "postback_sign",
    "rfc3339_to_epoch_ms",
    "sorted_keys",
]
