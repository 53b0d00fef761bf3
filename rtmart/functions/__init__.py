from rtmart.functions.jsonio import (json_fields, checked_fields, parse_typed,
                                     invalid_texts, to_json_row)
from rtmart.functions.timefmt import (epoch_millis, millis_to_day, millis_to_hour,
                                      millis_to_minute, create_date, create_hour,
                                      previous_day, day_key, text_seconds, timestamp_to_text,
                                      valid_time, wall_clock_day_key)

__all__ = [
    "json_fields", "checked_fields", "parse_typed", "invalid_texts", "to_json_row",
    "epoch_millis", "millis_to_day", "millis_to_hour", "millis_to_minute",
    "create_date", "create_hour", "previous_day", "day_key", "text_seconds", "timestamp_to_text",
    "valid_time", "wall_clock_day_key",
]
