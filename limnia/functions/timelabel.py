"""Dates and timestamps: lenient parsing, file-name dates, period starts."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnia.functions.cleaning import as_col
from limnia.functions.text import basename

# Date stamps inside product file names.
MONTHLY_NAME = r"\.(\d{8})_(\d{8})\.L3m\.MO\."
DAILY_NAME = r"\.(\d{8})\.L3m\.DAY\."

# Month names by number, and words that carry no date.
MONTHS = ("jan|january", "feb|february", "mar|march", "apr|april", "may", "jun|june", "jul|july", "aug|august",
          "sep|sept|september", "oct|october", "nov|november", "dec|december")
FILLERS = "mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?|at|on|and|of|ad|st|nd|rd|th|t|m"
# A clock time with its am/pm and zone (numbers of a zone only; its name says UTC or nothing).
CLOCK = (r"(?<![\d:.])(\d{1,2})(?::(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,6})\d*)?)?\s*([ap]m\b)?|\s*([ap]m\b))"
         r"\s*(?:([+-])(\d{2}):?(\d{2})?(?!\d)|(?!jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|mon|tue|wed|thu|fri|sat|sun)[a-z]{3,5}\b|z\b)?")
# Digits without separators: what they look like, and the same with separators.
COMPACT = (
    (r"^(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(\d{2})(z|[+-]\d{2}:?\d{2})?$", "$1-$2-$3 $4:$5:$6 $7"),
    (r"^(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(z|[+-]\d{2}:?\d{2})?$", "$1-$2-$3 $4:$5 $6"),
    (r"^(\d{2})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4}-\d{1,2}-\d{1,2})[t ](\d{2})$", "$1 $2:00"),
    (r"^(\d{4})q([1-4])$", "$1 q$2"),
)


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _month_numbers() -> str:
    pairs = [(n, i + 1) for i, group in enumerate(MONTHS) for n in group.split("|")] + [(f"q{i}", 3 * i - 2) for i in range(1, 5)]
    return "map(" + ", ".join(f"'{n}', {i}" for n, i in pairs) + ")"


def _year(w: str) -> str:
    """The year of a word; two digits mean the century that brings it within fifty years of this one."""
    now = "year(current_date())"
    near = f"({w}.n + {now} DIV 100 * 100)"
    return f"CAST(CASE WHEN {w}.len > 2 THEN {w}.n WHEN {near} >= {now} + 50 THEN {near} - 100 WHEN {near} < {now} - 50 THEN {near} + 100 ELSE {near} END AS int)"


def _day(words: str) -> str:
    """Year, month and day from up to three words: month first among numbers, unless only another order can be."""
    a, b, c = (f"get({words}, {i})" for i in range(3))

    def ymd(y, m, d="1"):
        return f"named_struct('y', {_year(y)}, 'm', coalesce({m}.m, {m}.n), 'd', {d if d == '1' else d + '.n'})"

    year = lambda w: f"({w}.len > 2 OR {w}.n > 31)"
    named = lambda w: f"{w}.m IS NOT NULL"
    names = f"size(filter({words}, w -> w.m IS NOT NULL))"
    return f"""CASE WHEN {names} > 1 THEN NULL
        WHEN size({words}) = 1 AND {a}.len = 4 AND {a}.m IS NULL THEN {ymd(a, 'named_struct("m", 1, "n", 1)')}
        WHEN size({words}) = 2 AND {year(a)} AND {a}.m IS NULL AND ({named(b)} OR NOT {year(b)}) THEN {ymd(a, b)}
        WHEN size({words}) = 2 AND {year(b)} AND {b}.m IS NULL THEN {ymd(b, a)}
        WHEN size({words}) <> 3 THEN NULL
        WHEN {named(a)} AND {year(b)} THEN {ymd(b, a, c)} WHEN {named(a)} THEN {ymd(c, a, b)}
        WHEN {named(b)} AND {year(a)} THEN {ymd(a, b, c)} WHEN {named(b)} THEN {ymd(c, b, a)}
        WHEN {named(c)} AND {year(b)} THEN {ymd(b, c, a)} WHEN {named(c)} THEN {ymd(a, c, b)}
        WHEN {year(a)} THEN {ymd(a, b, c)} WHEN {a}.n > 12 THEN {ymd(c, b, a)} ELSE {ymd(c, a, b)} END"""


@cache
def _lenient() -> str:
    """SQL lambda: text -> timestamp."""
    # the text before and after its clock time, and the clock's parts between them
    clock = f"split(regexp_replace(low, r'{CLOCK}', '~$1~$2~$3~$4~$5$6~$7~$8~$9~'), '~')"
    part = lambda i: f"coalesce(try_cast(get(p, {i}) AS int), 0)"
    hour = f"""CASE WHEN size(p) = 1 THEN 0 WHEN get(p, 5) = '' THEN {part(1)} WHEN {part(1)} NOT BETWEEN 1 AND 12 THEN -1
        ELSE {part(1)} % 12 + if(get(p, 5) = 'pm', 12, 0) END"""
    micros = "coalesce(try_cast(rpad(get(p, 4), 6, '0') AS bigint), 0L)"
    zone = f"({part(7)} * 60 + {part(8)}) * if(get(p, 6) = '-', -1, 1)"
    rest = "regexp_replace(concat(p[0], ' ', if(size(p) > 1, p[9], '')), r'(?<!\\d)(\\d{4})(\\d{2})(\\d{2})(?!\\d)', '$1-$2-$3')"
    words = f"filter(regexp_extract_all(rest, r'q[1-4]|[a-z]+|\\d+', 0), w -> NOT w RLIKE r'^({FILLERS})$')"
    known = f"transform({words}, w -> named_struct('m', try_element_at({_month_numbers()}, w), 'n', if(length(w) <= 4, try_cast(w AS int), NULL), 'len', length(w)))"
    fits = f"h BETWEEN 0 AND 23 AND {part(2)} < 60 AND {part(3)} < 60"
    at = f"try_make_timestamp(d.y, d.m, d.d, h, {part(2)}, CAST({part(3)} AS decimal(16, 6)))"
    made = f"CASE WHEN {fits} THEN timestamp_micros(unix_micros({at}) + {micros} - {zone} * 60000000L) END"
    day = _let("d", _let("t", known, f"CASE WHEN NOT exists(t, w -> w.m IS NULL AND w.n IS NULL) THEN {_day('t')} END"), _let("h", hour, made))
    read = _let("rest", rest, f"CASE WHEN NOT rest RLIKE r'[^a-z0-9 ,./\\x27\\t-]' THEN {day} END")
    spaced = "lower(s)"
    for shape, to in COMPACT:
        spaced = f"regexp_replace({spaced}, r'{shape}', '{to}')"
    low = f"if(s RLIKE r'^[0-9]{{4}}[-0-9TtZzqQ:+ ]*[0-9Zz]$|^[0-9]{{6}}$', {spaced}, lower(s))"
    general = _let("low", low, _let("p", clock, f"CASE WHEN size(p) IN (1, 10) THEN {read} END"))
    iso = r"s RLIKE r'^\d{4}-\d{1,2}-\d{1,2}($|[T ]\d{1,2}:\d)' AND NOT s RLIKE '[a-zA-SU-Y]'"
    return f"s -> coalesce(CASE WHEN {iso} THEN try_cast(s AS timestamp) END, CASE WHEN s RLIKE '[0-9]' THEN {general} END)"


def parse_lenient(c: Column | str) -> Column:
    """Mixed-format text -> TIMESTAMP (UTC session); NULL where no date can be read.

    Plain ISO text is cast. Any other text is taken apart: a clock time with am/pm and zone,
    wherever it stands; weekdays and small words, which say nothing; and what is left, one to
    three numbers or a month's name, which are put in order as US dates are: month first, a year
    where only a year can be, two-digit years in the nearest century. A month alone is its first
    day. A time without a date is no date.
    """
    # as text, because a tree of columns of this size takes the driver most of a second to build
    return F.call_function("transform", F.array(F.trim(as_col(c).cast("string"))), F.expr(_lenient()))[0]


def to_utc_timestamp(df, name: str) -> Column:
    """Any date-like column -> TIMESTAMP_NTZ on the UTC clock."""
    t = dict(df.dtypes)[name]
    c = F.col(f"`{name}`")
    if t in ("timestamp", "date", "timestamp_ntz"):
        return c.cast("timestamp_ntz")
    return parse_lenient(c).cast("timestamp_ntz")


def _stamp(text: Column) -> Column:
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd"))


def name_dates(src: Column | str, product: str) -> tuple[Column, Column]:
    """(first, last) timestamp in a file name; daily names carry one date only."""
    fn = basename(src)
    if product == "monthly":
        return (
            _stamp(F.regexp_extract(fn, MONTHLY_NAME, 1)),
            _stamp(F.regexp_extract(fn, MONTHLY_NAME, 2)),
        )
    d = _stamp(F.regexp_extract(fn, DAILY_NAME, 1))
    return d, d


def midpoint(a: Column, b: Column) -> Column:
    """Halfway between two timestamps, microseconds kept."""
    return F.timestamp_micros(F.shiftright(F.unix_micros(a) + F.unix_micros(b), 1))


def time_label(
    src: Column | str,
    product: str,
    time0: Column | None = None,
    start: Column | None = None,
    end: Column | None = None,
) -> Column:
    """When a file's content was observed: first usable of three sources.

    1. its own time value, 2. its coverage attributes (both ends needed; start for a
    daily product, midpoint for a monthly one), 3. its name. NULL when none is usable;
    callers that must have a label check with :func:`limnia.operators.schema.require`.
    """
    options = []
    if time0 is not None:
        options.append(parse_lenient(time0))
    if start is not None and end is not None:
        a, b = parse_lenient(start), parse_lenient(end)
        options.append(midpoint(a, b) if product == "monthly" else F.when(b.isNotNull(), a))
    a, b = name_dates(src, product)
    options.append(midpoint(a, b) if product == "monthly" else a)
    return F.coalesce(*options)


# pandas-style period codes -> date_trunc units.
_PERIOD_UNITS = {
    "D": "day", "H": "hour", "W": "week", "M": "month", "MS": "month",
    "Q": "quarter", "QS": "quarter", "Y": "year", "YS": "year", "A": "year",
}


def period_start(ts: Column | str, freq: str) -> Column:
    """Snap to the start of the day, week (Monday), month, quarter or year."""
    unit = _PERIOD_UNITS.get(freq.upper())
    if unit is None:
        raise ValueError(f"unknown period code {freq!r}")
    t = F.date_trunc(unit, as_col(ts).cast("timestamp"))
    return t.cast("timestamp_ntz") if unit == "hour" else t.cast("date")


def date_text(d: Column | str) -> Column:
    return F.date_format(as_col(d), "yyyy-MM-dd")
