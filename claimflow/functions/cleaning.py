"""Tolerant parsing. Nothing here ever returns NaN: absent values are NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLASHED_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})"
# A time of day and how far east of Greenwich it holds.
WITH_OFFSET = r"\d:\d\d.*(Z|[+-]\d\d:?\d\d)\s*$"
# A time of day by the clock of twelve hours.
CLOCK = r"(?i)(:\d\d) ([ap])m$"
TIME = r"( \d{1,2}:\d\d(?::\d\d)?)?$"
# Each shape of a date is turned into ISO by exchanging its parts; a text that has been
# turned has none of the shapes further down. The month comes first where it could be
# either; of several groups for one part, those not met are empty.
SHAPES = (
    # yyyy/M/d, yyyyMMdd
    (r"^(\d{4})(?:/(\d{1,2})/(\d{1,2})|(\d\d)(\d\d))" + TIME, "$1-$2$4-$3$5$6"),
    # M/d/yyyy, d/M/yyyy, d.M.yyyy; the first two with dashes too, or with two digits of the year
    (
        r"^(?:(?:(0?[1-9]|1[0-2])([-/])(\d{1,2})\2|(1[3-9]|2\d|3[01])([-/])(\d{1,2})\5|(\d{1,2})\.(\d{1,2})\.)(\d{4})"
        r"|(?:(0?[1-9]|1[0-2])/(\d{1,2})|(1[3-9]|2\d|3[01])/(\d{1,2}))/(\d\d))" + TIME,
        "\x01$9$14-$1$6$8$10$13-$3$4$7$11$12$15",
    ),
    # d-MMM-yyyy, d-MMM-yy, d MMMM yyyy, MMM d yyyy, MMMM d, yyyy; the name is put in later
    (
        r"^(?:(\d{1,2})(?: [A-Za-z]+ (\d{4})|-[A-Za-z]{3}-(\d\d)|-[A-Za-z]+-(\d{4}))|[A-Za-z]+ (\d{1,2}),? (\d{4}))$",
        "\x01$2$3$4$6-@-$1$5",
    ),
    # years of two digits, told by the mark that the two shapes above leave in front
    (r"^\x01([0-5]\d|6[0-8])-", "20$1-"),
    (r"^\x01(\d\d)-", "19$1-"),
)
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)


def _otherwise_spelled(text: Column) -> Column:
    """Spellings that are neither ISO nor ``MM/dd/yyyy``; two-digit years fall in 1969-2068.

    No parser is tried: the shape of a text decides how its parts are put in order, and
    what comes out is read once, so a text that is no date costs no more than one that is.
    """
    clock = F.lower(F.right(text, F.lit(1))) == "m"
    iso = F.when(clock, F.regexp_replace(text, CLOCK, "$1")).otherwise(text)
    for shape, order in SHAPES:
        iso = F.regexp_replace(iso, shape, order)
    # names are given in three letters or in full
    listed = ",".join([m[:3] for m in MONTHS] + list(MONTHS))
    name = F.lower(F.regexp_extract(text, "[A-Za-z]{3,}", 0))
    month = F.pmod(F.nullif(F.find_in_set(name, F.lit(listed)), F.lit(0)) - 1, F.lit(len(MONTHS))) + 1
    # a text without letters keeps its sign, and is no date
    month = F.when(text.rlike("[A-Za-z]{3}"), month.cast("string")).otherwise(F.lit("@"))
    hour = F.regexp_extract(text, r" (\d{1,2}):", 1).try_cast("int")
    noon = F.when(F.lower(F.right(text, F.lit(2))) == "pm", F.lit(12)).otherwise(F.lit(0))
    shift = F.when(~clock, F.lit(0)).when(~text.rlike(CLOCK), F.lit(None)).when(hour.between(1, 11), noon).when(hour == 12, noon - 12)
    iso = F.ltrim(F.replace(iso, F.lit("@"), month), F.lit("\x01"))
    return iso.try_cast("timestamp_ntz") + F.make_dt_interval(hours=shift)


def parse_timestamp(c: Column | str) -> Column:
    """Text in any of the usual spellings to a timestamp; NULL where it is none.

    The result is a zone-free timestamp, so day arithmetic does not move with
    the session time zone; text with an offset is moved to UTC. More than six
    fractional digits are cut off.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    by_pattern = F.regexp_replace(text, SLASHED_DATE, "$3-$1-$2")
    iso = F.when(text.contains("/"), by_pattern).otherwise(text)
    moved = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    plain = F.when(text.rlike(WITH_OFFSET), moved).otherwise(iso.try_cast("timestamp_ntz"))
    by_shape = F.coalesce(plain, F.when(text.rlike(r"\d"), _otherwise_spelled(F.trim(text))))
    return F.coalesce(_by_place(text).try_cast("timestamp_ntz"), by_shape)


def _by_place(text: Column) -> Column:
    """ISO of the two usual spellings, told and cut by position; the patterns serve the rest.

    With marks at these places and a digit at the end a text can hold no offset.
    """

    def marked(length: int, marks: dict[int, str]) -> Column:
        found = F.length(text) == length
        for at, mark in marks.items():
            found = found & (F.substring(text, at, 1) == mark)
        return found

    slashed = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2))
    timed = marked(19, {5: "-", 8: "-", 14: ":", 17: ":"}) & F.substring(text, 19, 1).between("0", "9")
    return F.when(marked(10, {3: "/", 6: "/"}), slashed).when(timed, text)


def parse_number(c: Column | str, strict: bool = True) -> Column:
    """Text to double. Blank is NULL; bad text raises when ``strict``, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    number = text.cast("double") if strict else text.try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def blank_to_null(c: Column | str) -> Column:
    """White space only becomes NULL, other text is unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    # a text that begins with a visible character is told without the pattern
    visible = F.substring(c, 1, 1).between("!", "~")
    return F.when(visible, c).when(~c.rlike(r"^\s*$"), c)


def as_flag(c: Column | str) -> Column:
    """Boolean with NULL read as false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("boolean"), F.lit(False))


def range_midpoint(c: Column | str) -> Column:
    """``"a-b"`` to (a+b)/2. NULL counts as ``0-0``; text that is no range is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    ends = F.split(F.coalesce(c, F.lit("0-0")), "-")
    return (F.get(ends, F.lit(0)).try_cast("double") + F.get(ends, F.lit(1)).try_cast("double")) / 2


FIRST_QUOTED = r"^\s*[\[(]\s*(['\"])(.*?)\1\s*[,\])]"
FIRST_BARE = r"^\s*[\[(]\s*([^\s'\",\])][^,\])]*)"


def list_first(c: Column | str, default: str = "['Unknown']") -> Column:
    """First item of a list or tuple written as text; NULL text takes the default list.

    Quotes of either kind are dropped; an empty list, and a first item ``None``, is NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    text = F.coalesce(c, F.lit(default))
    bare = F.trim(F.regexp_extract(text, FIRST_BARE, 1))
    plain = F.when((bare != "") & (bare != "None"), bare)
    return F.when(text.rlike(FIRST_QUOTED), F.regexp_extract(text, FIRST_QUOTED, 2)).otherwise(plain)


def list_length(c: Column | str) -> Column:
    """Number of comma-separated pieces; NULL counts as one piece."""
    c = F.col(c) if isinstance(c, str) else c
    return F.size(F.split(F.coalesce(c, F.lit("None")), ","))


URI_PATTERN = r"^[^/]*//([^/]+)/(.*)$"


def uri_bucket(c: Column | str) -> Column:
    """Host part of ``scheme://bucket/key``."""
    return F.regexp_extract(c, URI_PATTERN, 1)


def uri_key(c: Column | str) -> Column:
    """Everything after the first slash behind the host."""
    return F.regexp_extract(c, URI_PATTERN, 2)
