"""Reading of dates and times in the spellings users write.

A spelling is cut into tokens: a clock with seconds, AM or PM and zone, a weekday, a month's name, and up
to three numbers. What a number is follows from the others:

- beside a month's name, a number of four digits or above 31 is the year and the other one the day; of two
  short numbers the first is the day;
- of three numbers, a first one of four digits or above 31 is the year, else the last; of the other two
  the first is the month, unless it is above 12, which only a day can be;
- of two numbers the one of four digits is the year and the other the month; a lone one is a year.

Ambiguous spellings: 3/4/2024 and 3.4.2024 are the 4th of March. Years of two digits are 1975 to 2074. A
missing day or month is the first. A time without a zone is UTC. Weekdays are not checked. Not
read: dates without a year, zones by name other than UTC, GMT and Z."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.rows import bind
from docketry.functions.text import trim_all

# Names of months and weekdays, words that may stand between the tokens.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
WEEKDAY = r"(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?"
ZONE = r"(z|utc|gmt|[+-]\d{1,2}(?::?\d{2})?)"
#: Both in Spark and in Python; all on lower case.
NOISE = rf"\b{WEEKDAY}\b\.?|[,;]|(?<=\d)(?:st|nd|rd|th)\b|\b(?:at|on|and|of)\b"
#: Eight digits are a date, four or six behind them a time.
COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})(?=$|[ tz+-]|\d{4}(?:\d{2})?\b)"
COMPACT_TIME = r"(?<=^\d{4}-\d{2}-\d{2}) ?[t ]?(\d{2})(\d{2})(\d{2})?(?!\d)"
CLOCK = rf"(?:^|[\st])(?=\d{{1,2}}(?::| ?[ap]\.?m\b))(\d{{1,2}})(?::(\d{{2}}))?(?::(\d{{2}})(?:[.,]\d+)?)?:?(?: ?([ap])\.?m\b\.?)?(?: ?{ZONE})?(?=\s|$)"
SIGN = r"[-/. ]*"
NUMBER = r"(\d{1,4})(?!\d)"
DATE = rf"^{SIGN}(?:{NUMBER}{SIGN})?(?:{MONTH}\b{SIGN})?(?:{NUMBER}{SIGN})?(?:{NUMBER}{SIGN})?$"
ISO_SHAPE = r"^\d{4}-\d{1,2}(-\d{1,2}([T ].*)?)?$"
#: The first year of the hundred that two digits stand for.
FIRST_YEAR = 1975


def unquote(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)^([\"'])(.*)\\1$", "$2")


def parse_time(text: Column) -> Column:
    """Timestamp in UTC whole seconds, null if the text is none."""
    return bind(trim_all(unquote(text)), lambda plain: F.date_trunc("second", _read_time(plain)))


def _read_time(plain: Column) -> Column:
    iso = F.when(F.regexp_like(plain, F.lit(ISO_SHAPE)), plain.try_cast("timestamp"))
    return F.coalesce(iso, bind(_cleaned(plain), _from_tokens))


def _cleaned(plain: Column) -> Column:
    text = F.regexp_replace(F.lower(plain), NOISE, " ")
    text = F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), COMPACT_DATE, "$1-$2-$3")
    return F.regexp_replace(text, COMPACT_TIME, " $1:$2:$3")


def _from_tokens(text: Column) -> Column:
    """The tokens' values, put together as one ISO spelling that Spark checks and reads."""
    clock = F.struct(*[F.regexp_extract(text, CLOCK, k).alias(c) for k, c in enumerate(("h", "m", "s", "half", "zone"), 1)])
    rest = F.regexp_replace(text, CLOCK, " ")
    date = F.struct(*[F.regexp_extract(rest, DATE, k).alias(c) for k, c in enumerate(("a", "month", "b", "c"), 1)], F.regexp_like(rest, F.lit(DATE)).alias("fits"))
    return bind(date, lambda d: F.when(d["fits"], bind(clock, lambda c: F.concat(_date(d), F.lit(" "), _clock(c)).try_cast("timestamp"))))


def _date(d: Column) -> Column:
    numbers = F.filter(F.array(d["a"], d["b"], d["c"]), lambda x: x != "")

    def put(n: Column) -> Column:
        first, second, third = (F.get(n, F.lit(k)) for k in range(3))
        whole = lambda x: F.coalesce(x.cast("int"), F.lit(0))
        long = lambda x: F.coalesce((F.length(x) > 2) | (whole(x) > 31), F.lit(False))
        named = d["month"] != ""
        many = F.size(n)
        swap = ~named & (many == 3) & ~long(first) & (whole(first) > 12) | ~named & (many == 3) & long(first) & (whole(second) > 12)
        parts = (
            F.when(named & (many == 2) & long(first), _parts(first, d["month"], second))
            .when(named & (many == 2), _parts(second, d["month"], first))
            .when(named & (many == 1) & long(first), _parts(first, d["month"], F.lit("1")))
            .when(named, None)
            .when((many == 3) & long(first) & swap, _parts(first, third, second))
            .when((many == 3) & long(first), _parts(first, second, third))
            .when((many == 3) & swap, _parts(third, second, first))
            .when(many == 3, _parts(third, first, second))
            .when((many == 2) & (F.length(first) == 4), _parts(first, second, F.lit("1")))
            .when((many == 2) & (F.length(second) == 4), _parts(second, first, F.lit("1")))
            .when((many == 1) & (F.length(first) == 4), _parts(first, F.lit("1"), F.lit("1")))
        )
        return bind(parts, _written_date)

    return bind(numbers, put)


def _parts(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.alias("y"), month.alias("m"), day.alias("d"))


def _written_date(p: Column) -> Column:
    century = FIRST_YEAR % 100
    year = F.when(F.length(p["y"]) != 2, p["y"]).when(p["y"].cast("int") < century, F.concat(F.lit("20"), p["y"])).otherwise(F.concat(F.lit("19"), p["y"]))
    number = F.when(F.rlike(p["m"], F.lit("^[a-z]")), ((F.position(F.left(p["m"], F.lit(3)), F.lit(MONTHS)) + 2) / 3).cast("int").cast("string")).otherwise(p["m"])
    return F.concat(F.when(F.length(year) == 4, year), F.lit("-"), number, F.lit("-"), p["d"])


def _clock(c: Column) -> Column:
    hour = c["h"].cast("int")
    of_day = F.when(c["half"] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(c["half"] == "p", 12).otherwise(0))
    sign, digits = F.left(c["zone"], F.lit(1)), F.regexp_replace(c["zone"], "[^0-9]", "")
    hours = F.when(F.length(digits) > 2, F.left(digits, F.length(digits) - 2)).otherwise(digits)
    zone = F.when(digits == "", "Z").otherwise(F.concat(sign, F.lpad(hours, 2, "0"), F.lit(":"), F.when(F.length(digits) > 2, F.right(digits, F.lit(2))).otherwise("00")))
    two = lambda x: F.lpad(F.when(x == "", "0").otherwise(x), 2, "0")
    return F.when(c["h"] == "", "00:00:00Z").otherwise(F.concat(F.lpad(of_day.cast("string"), 2, "0"), F.lit(":"), two(c["m"]), F.lit(":"), two(c["s"]), zone))


def _plain(text: str) -> str:
    text = re.sub(r"\s+", " ", re.sub(NOISE, " ", text.lower())).strip()
    text = re.sub(COMPACT_DATE, r"\1-\2-\3", text)
    return re.sub(COMPACT_TIME, lambda m: f" {m[1]}:{m[2]}:{m[3] or ''}", text)


def is_date_only(text: str) -> bool:
    """No clock part: neither a colon, an hour with AM or PM, nor an hour after an ISO date."""
    _, mark, tail = text.partition("T")
    return ":" not in text and not (mark and tail[:1].isdigit()) and not re.search(CLOCK, _plain(text))


def literal_time(text: str) -> datetime:
    """A filter literal as naive UTC time in whole seconds, read by the same rules."""
    if len(text) > 1 and text[0] in "\"'" and text[0] == text[-1]:
        text = text[1:-1]
    try:
        found = datetime.fromisoformat(text)
    except ValueError:
        found = _literal_tokens(text)
    if found.tzinfo is not None:
        found = found.astimezone(UTC).replace(tzinfo=None)
    return found.replace(microsecond=0)


def _literal_tokens(text: str) -> datetime:
    plain = _plain(text)
    clock, date = re.search(CLOCK, plain), re.match(DATE, re.sub(CLOCK, " ", plain))
    try:
        year, month, day = _literal_date(date)
        hour, minute, second, zone = _literal_clock(clock) if clock else (0, 0, 0, timedelta())
        return datetime(year, month, day, hour, minute, second) - zone
    except (TypeError, ValueError):
        raise ValueError(f"not a date or time: {text!r}") from None


def _literal_date(date: re.Match) -> tuple[int, int, int]:
    name, numbers = date[2], [x for x in (date[1], date[3], date[4]) if x]
    long = lambda x: len(x) > 2 or int(x) > 31
    if name:
        month = str(MONTHS.index(name[:3]) // 3 + 1)
        if len(numbers) == 1 and long(numbers[0]):
            numbers.append("1")
        first, second = numbers
        parts = (first, month, second) if long(first) else (second, month, first)
    elif len(numbers) == 3:
        a, b, c = numbers
        parts = ((a, c, b) if int(b) > 12 else (a, b, c)) if long(a) else (c, b, a) if int(a) > 12 else (c, a, b)
    else:
        year = next(x for x in (*numbers, "") if len(x) == 4 or not x)
        rest = [x for x in numbers if x is not year] or ["1"]
        parts = (year, rest[0], "1")
    year, month, day = parts
    if len(year) == 2:
        year = ("20" if int(year) < FIRST_YEAR % 100 else "19") + year
    if len(year) != 4:
        raise ValueError
    return int(year), int(month), int(day)


def _literal_clock(clock: re.Match) -> tuple[int, int, int, timedelta]:
    hour, half, zone = int(clock[1]), clock[4], clock[5] or ""
    if half:
        if not 1 <= hour <= 12:
            raise ValueError
        hour = hour % 12 + 12 * (half == "p")
    digits = re.sub("[^0-9]", "", zone)
    hours, minutes = (int(digits[:-2]), int(digits[-2:])) if len(digits) > 2 else (int(digits or 0), 0)
    if hours > 18 or minutes > 59:
        raise ValueError
    ahead = timedelta(hours=hours, minutes=minutes)
    return hour, int(clock[2] or 0), int(clock[3] or 0), -ahead if zone[:1] == "-" else ahead


def day_bounds(moment: datetime) -> tuple[datetime, datetime]:
    start = moment.replace(hour=0, minute=0, second=0)
    return start, start + timedelta(hours=23, minutes=59, seconds=59)
