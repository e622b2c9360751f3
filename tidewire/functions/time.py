"""Publish times and relative times. "Now" is always given, never taken from the clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewire import config as C
from tidewire.functions.let import let

MONTHS = ("jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?", "sept?(?:ember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?")
MONTH = rf"(?:{'|'.join(MONTHS)})"
WEEKDAY = "(?:mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:r(?:s(?:day)?)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)"
#: Words that say nothing of a date.
FILLER = "(?:t|at|on|of|and|ad|st|nd|rd|th)"
#: Hour, minute, second, its parts, the half of the day, and a zone: of named ones only those of UTC
#: count, others are no more than a naive time.
CLOCK = (
    r"(?<![\d:.])(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?(?![\d:])\s*(?:([ap])\.?m\.?(?![a-z]))?"
    rf"\s*((?:z|utc|gmt)(?![a-z])(?:\s*[+-]\d{{1,2}}(?::?\d{{2}})?(?!\d))?|[+-]\d{{2}}(?::?\d{{2}})?(?!\d)|(?!{MONTH}\b|{WEEKDAY}\b)[a-z]{{2,5}}(?![a-z]))?"
)
KNOWN = r"^(z|utc|gmt|[+-])"
#: Digits that run together, and what they say: a date with a time, or alone.
RUN_TOGETHER = (
    (r"^(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(\d{2})(?!\d)", "$1-$2-$3 $4:$5:$6"), (r"^(\d{4})(\d{2})(\d{2})[t ](\d{2})(\d{2})(?!\d)", "$1-$2-$3 $4:$5"), (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
)
#: Years of two digits from this on are of the last century.
PIVOT = 70
_CUT = "\x01"


def _tokens(t: Column) -> Column:
    """(clock, words, numbers, plain) of a text: the groups of CLOCK, null without one, what else is
    there, and whether that is nothing but words, numbers and what stands between them."""
    u = F.regexp_replace(F.lower(t), r"\s*\([^()]*\)$", "")
    u = F.translate(u, "年月日", "-- ")
    for run, said in RUN_TOGETHER:
        u = F.regexp_replace(u, run, said)
    # a date alone may have a zone as well, which then is that of its midnight
    u = F.regexp_replace(u, r"^([^:]*\d)\s*(z|utc|gmt|[+-]\d{2}:\d{2})$", "$1 0:00 $2")

    def parts(cut: Column) -> Column:
        has = F.size(cut) > 1
        rest = F.when(has, F.concat_ws(" ", cut[0], cut[7])).otherwise(cut[0])
        # what stands before a clock may end in the T of ISO 8601
        spaced = F.regexp_replace(rest, r"(?<=\d)t(?=\s|$)", " ")
        return F.struct(
            F.when(has, F.slice(cut, 2, 6)).alias("clock"), F.regexp_extract_all(spaced, F.lit("[a-z]+"), F.lit(0)).alias("words"),
            F.regexp_extract_all(spaced, F.lit(r"\d+"), F.lit(0)).alias("numbers"), spaced.rlike(r"^[a-z0-9\s,./;'\-]*$").alias("plain"),
        )

    return let(F.split(F.regexp_replace(u, rf"(?s)^(.*?){CLOCK}(.*)$", _CUT.join(f"${i}" for i in range(1, 9))), _CUT, -1), parts)


def _date(p: Column) -> Column:
    """(y, m, d) as texts of the words and numbers of a date: with a month's name two numbers, without
    one three; null if any is missing or something else is there. A number is the year if it is
    too long or too large for a day; the month comes before the day where both orders would do."""
    named = F.filter(p["words"], lambda w: w.rlike(f"^{MONTH}$"))
    known = F.forall(p["words"], lambda w: w.rlike(f"^(?:{MONTH}|{WEEKDAY}|{FILLER})$"))
    month = F.floor((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.substring(named[0], 1, 3)) + 2) / 3).cast("string")
    n = p["numbers"]
    at = lambda i: F.get(n, F.lit(i))
    yearly = lambda x: (F.length(x) > 2) | (x.try_cast("int") > 31)
    above = lambda x: x.try_cast("int") > 12
    ymd = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))
    worded = F.when(yearly(at(0)), ymd(at(0), month, at(1))).otherwise(ymd(at(1), month, at(0)))
    first = F.when(above(at(1)), ymd(at(0), at(2), at(1))).otherwise(ymd(at(0), at(1), at(2)))
    last = F.when(above(at(0)), ymd(at(2), at(1), at(0))).otherwise(ymd(at(2), at(0), at(1)))
    numeric = F.when(yearly(at(0)), first).otherwise(last)
    found = F.when((F.size(named) == 1) & (F.size(n) == 2), worded).when((F.size(named) == 0) & (F.size(n) == 3), numeric)
    return F.when(p["plain"] & known, found)


def _wall(p: Column) -> Column:
    """The clock time as if it were UTC; midnight without a clock, null without a whole date."""
    clock = p["clock"]
    hour, half = clock[0].try_cast("int"), clock[4]
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    second = F.concat(F.when(clock[2] == "", "0").otherwise(clock[2]), F.lit("."), F.rpad(clock[3], 6, "0")).try_cast("decimal(8,6)")

    def made(d: Column) -> Column:
        year = d["y"].try_cast("int")
        year = F.when(F.length(d["y"]) > 2, year).when(year < PIVOT, year + 2000).otherwise(year + 1900)
        whole = F.when(clock.isNull(), F.lit(0)).otherwise(hour)
        minute = F.when(clock.isNull(), F.lit(0)).otherwise(clock[1].try_cast("int"))
        return F.try_make_timestamp(year, d["m"].try_cast("int"), d["d"].try_cast("int"), whole, minute, F.when(clock.isNull(), F.lit(0).cast("decimal(8,6)")).otherwise(second), F.lit("UTC"))

    return let(_date(p), made)


def _zone_seconds(z: Column) -> Column:
    offset = F.regexp_extract(z, r"([+-].*)$", 1)
    digits = F.regexp_replace(offset, r"[+\-:]", "")
    digits = F.when(F.length(digits) < 3, F.concat(digits, F.lit("00"))).otherwise(digits)
    hours = F.floor(digits.try_cast("int") / 100)
    seconds = (hours * 3600 + digits.try_cast("int") % 100 * 60) * F.when(F.startswith(offset, F.lit("-")), -1).otherwise(1)
    return F.when(offset == "", 0).otherwise(seconds)


def _shift(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) - seconds.cast("long") * 1_000_000)


def parse_published(raw: Column, now: Column, override_minutes: Column | None = None) -> Column:
    """(ts, note). Digits are an epoch in seconds, or in milliseconds if there are 13. Other texts are
    cut into a clock, words and numbers, of which weekdays and fillers say nothing; month names, the
    size of the numbers and their place tell year, month and day. An override keeps the clock time
    and replaces the zone, before the check for the future. A date alone is its midnight; other
    partial dates, such as a time of day or a month alone, and texts with any other word are
    unparseable."""
    override = F.lit(None).cast("int") if override_minutes is None else override_minutes.cast("int")
    late = F.unix_micros(now) + C.FUTURE_TOLERANCE_HOURS * 3_600_000_000

    def split(t: Column) -> Column:
        epoch = t.rlike(r"^\d{10,13}$")
        number = F.when(epoch, t.try_cast("long"))
        from_epoch = F.timestamp_micros(F.when(F.length(t) == 13, number * 1000).otherwise(number * 1_000_000))
        return F.struct(t.alias("t"), epoch.alias("epoch"), from_epoch.alias("from_epoch"), _tokens(F.when(~epoch, t)).alias("p"))

    def read(s: Column) -> Column:
        p = s["p"]
        zone = F.coalesce(p["clock"][5], F.lit(""))
        return F.struct(s["t"].alias("t"), (~s["epoch"] & ~zone.rlike(KNOWN)).alias("naive"), s["epoch"].alias("epoch"), zone.alias("zone"), F.coalesce(s["from_epoch"], _wall(p)).alias("wall"))

    def place(p: Column) -> Column:
        ts = F.when(override.isNotNull(), _shift(p["wall"], override * 60)).when(p["epoch"] | p["naive"], p["wall"]).otherwise(_shift(p["wall"], _zone_seconds(p["zone"])))
        return F.struct(p["t"].alias("t"), p["naive"].alias("naive"), ts.alias("ts"))

    def judge(p: Column) -> Column:
        refusal = (
            F.when(F.coalesce(p["t"], F.lit("")) == "", "missing")
            .when(p["ts"].isNull(), "unparseable")
            .when(F.year(p["ts"]) < C.MIN_PUBLISH_YEAR, "implausible")
            .when(F.unix_micros(p["ts"]) > late, "future_date")
        )
        note = F.when(override.isNotNull(), "tz_corrected").when(p["naive"], "tz_assumed")
        return F.struct(F.when(refusal.isNull(), p["ts"]).alias("ts"), F.coalesce(refusal, note).alias("note"))

    return let(let(let(let(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""), split), read), place), judge)


def relative_time(moment: Column, now: Column) -> Column:
    s = (F.unix_micros(now) - F.unix_micros(moment)) / 1_000_000
    whole = lambda n: F.floor(s / n).cast("string")
    return (
        F.when(s < 0, "刚刚")
        .when(s < 3600, F.concat(F.greatest(F.lit(1), F.floor(s / 60)).cast("string"), F.lit(" 分钟前")))
        .when(s < 86400, F.concat(whole(3600), F.lit(" 小时前")))
        .when(s < 30 * 86400, F.concat(whole(86400), F.lit(" 天前")))
        .otherwise(F.concat(F.floor(F.floor(s / 86400) / 30).cast("string"), F.lit(" 个月前")))
    )


def effective(published: Column, first_seen: Column) -> Column:
    return F.coalesce(published, first_seen)


def date_shape(raw: Column) -> Column:
    """The zone as it is written, or how the text looks without one; for the audit of dates."""
    zone = F.regexp_extract(raw, r"([+-]\d{4}$|\bGMT\b|\bUTC\b|[+-]\d{2}:\d{2}$)", 1)
    return F.when(F.coalesce(raw, F.lit("")) == "", "(无)").when(zone != "", zone).when(F.contains(raw, F.lit("T")), "ISO8601").otherwise("(未知)")


def _ahead(newest: Column, now: Column) -> Column:
    return (F.unix_micros(newest) - F.unix_micros(now)) / 3_600_000_000


def zone_verdict(newest: Column, now: Column) -> Column:
    """Does the newest item of a source lie in the future, as mislabelled zones make it?"""
    hours = _ahead(newest, now)
    return F.when(newest.isNull(), "no_dates").when(hours > 4, "tz_mislabelled").when(hours > 0, "slightly_ahead").otherwise("ok")


def suggested_offset(newest: Column, now: Column) -> Column:
    """Minutes to override the zone with: those of +08:00 where the newest item is about 8 h ahead."""
    return F.when(F.abs(_ahead(newest, now) - 8) < 1.5, 480)
