"""Action times are ``yyyy-MM-dd HH:mm:ss`` text without a zone.

They are read as zone-free timestamps, so no result depends on the session's
time zone and no clock change stretches a visit.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A date and all three time fields, padded or not; what follows is ignored.
_MOMENT = r"^\s*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"
# Length of "yyyy-MM-dd HH:mm:ss", and where its second colon stands.
_SECOND_TEXT = 19
_SECOND_COLON = 17


def readable_moment(time_text: Column) -> Column:
    """A time text as a zone-free timestamp; NULL if it lacks a field or is no time.

    Padded text goes straight to the cast, the fast parser, and min and max over
    the result stay in the hash aggregate, which text would not. Its second colon
    is looked at because the cast would fill in missing fields.
    """
    has_seconds = F.substring(time_text, _SECOND_COLON, 1) == ":"
    padded = F.when(has_seconds, F.substring(time_text, 1, _SECOND_TEXT))
    other = F.regexp_extract(time_text, _MOMENT, 1)
    return F.coalesce(padded.try_cast("timestamp_ntz"), other.try_cast("timestamp_ntz"))


def is_unreadable(time_text: Column, moment: Column) -> Column:
    return time_text.isNotNull() & moment.isNull()


def unreadable_error() -> Column:
    return F.raise_error(F.lit("[CAST_INVALID_INPUT] action_time is not yyyy-MM-dd HH:mm:ss"))


def action_moment(time_text: Column) -> Column:
    """``readable_moment``, raising where the text is no time."""
    # The error stands last, so that the text is read once.
    return F.coalesce(
        readable_moment(time_text), F.when(time_text.isNotNull(), unreadable_error())
    )


def seconds_between(later: Column, earlier: Column) -> Column:
    return (later - earlier).cast("interval second").cast("bigint")


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970, counting the moment as UTC."""
    return seconds_between(moment, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def moment_text(moment: Column) -> Column:
    return moment.cast("string")


def day_hour(time_text: Column) -> Column:
    """The text before the first colon, e.g. ``2018-11-26 09``."""
    return F.substring_index(time_text, ":", 1)
