"""Scalar, array, text, date and geometry expressions. All are JVM-side columns; none needs Python workers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The earth's radius in metres and miles, metres in a degree of latitude.
EARTH_M = 6_371_000.0
EARTH_MILES = 3959.0
METRES_PER_DEGREE = 111_320.0


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def num(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# Geometry -----------------------------------------------------------------------------------------------------------


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_M) -> Column:
    """Great-circle distance in the unit of ``radius``, arcsine form."""
    a1, a2 = F.radians(num(lat1)), F.radians(num(lat2))
    dlat, dlon = F.radians(num(lat2) - num(lat1)) / 2, F.radians(num(lon2) - num(lon1)) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(a1) * F.cos(a2) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def half_extent(radius_m: float, lat: float) -> tuple[float, float]:
    """Half height and half width, in degrees, of the box around a circle at a latitude.

    A degree of longitude shrinks with the cosine of the latitude, which is held above 1e-6 near the poles.
    """
    shrink = max(math.cos(math.radians(lat)), 1e-6)
    height = radius_m / METRES_PER_DEGREE
    return height, height / shrink


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Range predicates, which reach the scan."""
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("long")


def grid_key(lat: Column, lon: Column, decimals: int = 3) -> Column:
    """Text key of a cell, rounded half up to ``decimals``."""
    return F.concat_ws(",", F.format_number(lat, decimals), F.format_number(lon, decimals))


def xywh_to_xyxy(x, y, w, h) -> Column:
    """Centre form to corner form."""
    return F.array(num(x) - num(w) / 2, num(y) - num(h) / 2, num(x) + num(w) / 2, num(y) + num(h) / 2)


def box_overlap_area(a: Column, b: Column) -> Column:
    """Intersection area of two corner-form boxes (arrays of four)."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def repaired_point(lat: Column, lon: Column, auto_west: bool = True, allow_swap: bool = True, box: tuple | None = None) -> Column:
    """struct(lat, lon, flags): out-of-range values become null; whole pairs are flipped west or swapped where that mends them.

    ``box`` is (lat_min, lat_max, lon_min, lon_max). An eastern longitude is flipped if the flipped pair lies in the box, or,
    without a box, if it is between 20 and 170 degrees. A pair outside the box is swapped if it then lies inside. flags say
    what was done: FIXED_WEST, SWAPPED.
    """
    la, lo = F.when(lat.between(-90, 90), lat), F.when(lon.between(-180, 180), lon)
    whole, flags = la.isNotNull() & lo.isNotNull(), []
    if auto_west:
        flip = whole & (lo > 0) & (in_box(la, -lo, box) if box else lo.between(20, 170))
        flags.append(F.when(flip, F.lit("FIXED_WEST")))
        lo = F.when(flip, -lo).otherwise(lo)
    if allow_swap and box:
        swap = whole & ~in_box(la, lo, box) & in_box(lo, la, box)
        flags.append(F.when(swap, F.lit("SWAPPED")))
        la, lo = F.when(swap, lo).otherwise(la), F.when(swap, la).otherwise(lo)
    found = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return F.struct(la.alias("lat"), lo.alias("lon"), found.alias("flags"))


# Vectors ------------------------------------------------------------------------------------------------------------


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one has no length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def cyclic(v: Column, period: float) -> Column:
    """array(sin, cos) of a phase."""
    angle = v * F.lit(2 * math.pi / period)
    return F.array(F.sin(angle), F.cos(angle))


def location_feature(lat: Column, lon: Column, mph: Column, seconds_of_day: Column) -> Column:
    """Seven numbers: latitude and longitude as phases, speed over 80 held to 0..1, time of day as a phase."""
    speed = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(mph, F.lit(0.0)) / 80))
    return F.concat(cyclic(lat, 180.0), cyclic(lon, 360.0), F.array(speed), cyclic(seconds_of_day, 86400.0))


# Intervals ----------------------------------------------------------------------------------------------------------


def overlap(a_start, a_stop, b_start, b_stop) -> Column:
    return F.greatest(F.lit(0.0), F.least(num(a_stop), num(b_stop)) - F.greatest(num(a_start), num(b_start)))


def overlap_share(a_start, a_stop, b_start, b_stop) -> Column:
    """Overlap as a share of the first interval, 1 at most; 0 for an empty interval."""
    length = num(a_stop) - num(a_start)
    return F.when(length > 0, F.least(F.lit(1.0), overlap(a_start, a_stop, b_start, b_stop) / length)).otherwise(F.lit(0.0))


# Text ---------------------------------------------------------------------------------------------------------------


def stable_id(*parts: Column | str) -> Column:
    """md5 of the parts, each followed by a bar; nulls are empty."""
    return F.md5(F.concat(*[x for p in parts for x in (F.coalesce(col(p).cast("string"), F.lit("")), F.lit("|"))]))


def text_hash(x: Column) -> Column:
    return F.sha2(x, 256)


def snippet(x: Column, n: int = 200) -> Column:
    """Line breaks folded to blanks; beyond n characters cut with an ellipsis."""
    flat = F.regexp_replace(x, r"\s*\n\s*", " ")
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n), F.lit("..."))).otherwise(flat)


def slug(x: Column, n: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, n)


def clip_base_key(x: Column) -> Column:
    """A clip's key without its view suffix."""
    return F.regexp_replace(x, "_(F|R|FR)$", "")


def file_key(x: Column) -> Column:
    """The recording's stamp in a file name, else the name without directories, extension and known endings."""
    name = F.regexp_replace(F.regexp_replace(x, "^.*/", ""), r"\.[A-Za-z0-9]+$", "")
    stamp = F.regexp_extract(name, r"(\d{4}_\d{4}_\d{6})", 1)
    # The known endings.
    plain = F.regexp_replace(name, "_(large|medium|small|base|tiny|transcription|speakers|entities|metadata|F|R|FR)+$", "")
    return F.when(stamp != "", stamp).otherwise(plain)


#: First-person words, dates (ISO, or a month's name and a day, a year after them or not) and clock times.
SELF = r"(?i)\b(I|my|me|myself|we|our|us)\b"
DATES = r"(?i)\b(\d{4}-\d{2}-\d{2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2}(?:,?\s+\d{4})?)"
TIMES = r"(?i)\b(\d{1,2}:\d{2}(?::\d{2})?\s*(?:am|pm)?)\b"


def mentions(x: Column) -> Column:
    """struct(is_self, dates, times): first-person words, dates and clock times as written; sorted and distinct."""
    text = F.coalesce(x, F.lit(""))
    found = lambda p: F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(1))))
    return F.struct(text.rlike(SELF).alias("is_self"), found(DATES).alias("dates"), found(TIMES).alias("times"))


def tags(x: Column, rules: list[tuple[str, str]], most: int = 8) -> Column:
    """Names of the rules whose pattern is found, in rule order, ``most`` at most."""
    return F.slice(F.array_compact(F.array(*[F.when(x.rlike(p), F.lit(name)) for name, p in rules])), 1, most)


def route(x: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The first rule whose pattern is found."""
    out = F.lit(default)
    for name, p in reversed(rules):
        out = F.when(x.rlike(p), F.lit(name)).otherwise(out)
    return out


def number(x: Column) -> Column:
    """Text to DOUBLE without thousands commas and percent signs; null where it isn't a number."""
    return F.regexp_replace(x.cast("string"), r"[,%\s]", "").try_cast("double")


def fraction(x: Column) -> Column:
    """As ``number``; a percentage becomes a share."""
    return F.when(x.cast("string").contains("%"), number(x) / 100).otherwise(number(x))


def without_think(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, "(?s)<think>.*?</think>", ""))


def subtitle_text(x: Column) -> Column:
    """Subtitle lines without cue numbers, timings, headers and inline tags, joined by blanks."""
    lines = F.transform(F.split(x, r"\r?\n"), lambda v: F.trim(F.regexp_replace(v, "<[^>]*>", "")))
    keep = F.filter(lines, lambda v: (v != "") & ~v.rlike(r"^\d+$") & ~v.contains("-->") & ~v.rlike("^(WEBVTT|NOTE|STYLE|Kind:|Language:)"))
    return F.array_join(keep, " ")


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm; hours beyond 99 with all their digits."""
    ms = F.round(seconds * 1000).cast("long")
    at = lambda q, m: F.lpad((F.floor(ms / q) % m).cast("string"), 2, "0")
    hours = F.floor(ms / 3_600_000)
    return F.concat(F.when(hours > 99, hours.cast("string")).otherwise(F.lpad(hours.cast("string"), 2, "0")), F.lit(":"), at(60_000, 60), F.lit(":"), at(1000, 60), F.lit(","), F.lpad((ms % 1000).cast("string"), 3, "0"))


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def python_repr_to_json(x: Column) -> Column:
    """A Python literal's text as JSON text: quoting, booleans and None. What stands inside quotes is kept as it is."""
    hexed = lambda v: F.regexp_replace(v, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")

    def written(token: Column) -> Column:
        inner = F.substring(token, F.lit(2), F.length(token) - 2)
        single = F.concat(F.lit('"'), hexed(F.replace(F.replace(inner, F.lit('"'), F.lit('\\"')), F.lit("\\'"), F.lit("'"))), F.lit('"'))
        bare = token
        for a, b in (("True", "true"), ("False", "false"), ("None", "null")):
            bare = F.regexp_replace(bare, rf"\b{a}\b", b)
        return F.when(token.startswith("'"), single).when(token.startswith('"'), hexed(F.replace(token, F.lit("\\'"), F.lit("'")))).otherwise(bare)

    tokens = F.regexp_extract_all(x, F.lit(r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'?|"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[^'"]++"""), F.lit(0))
    return F.array_join(F.transform(tokens, written), "")


def first_json_object(x: Column) -> Column:
    """The first brace-balanced object, at any depth of nesting; null if there is none. Braces in strings don't count.

    A quotation mark opens a string wherever it stands, in front of the object too.
    """
    tokens = F.regexp_extract_all(x, F.lit(r"""(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[{}]|[^"{}]++"""), F.lit(0))
    zero = F.struct(*[F.lit(0).alias(n) for n in ("depth", "at", "first", "last")])

    def step(acc: Column, token: Column) -> Column:
        at, open_ = acc["at"] + 1, acc["last"] == 0
        opens, closes = open_ & (token == "{"), open_ & (token == "}") & (acc["depth"] > 0)
        depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        first = F.when(opens & (acc["depth"] == 0), at).otherwise(acc["first"])
        last = F.when(closes & (depth == 0), at).otherwise(acc["last"])
        return F.struct(depth.alias("depth"), at.alias("at"), first.alias("first"), last.alias("last"))

    def cut(t: Column) -> Column:
        return _with(F.aggregate(t, zero, step), lambda a: F.when(a["last"] > 0, F.array_join(F.slice(t, a["first"], a["last"] - a["first"] + 1), "")))

    return _with(tokens, cut)


_TASK = "title string, description string, labels array<string>, priority string, owner_hint string, agent struct<name:string,confidence:string,rationale:string>, plan array<struct<step:string,action:string,tool:string,operation:string,expected_output:string>>"
PAYLOAD = f"version string, language string, summary string, key_points array<string>, topics array<string>, people array<string>, organizations array<string>, places array<string>, quality_notes string, tasks array<struct<{', '.join(f'{n}:{t}' for n, t in (part.split(' ', 1) for part in _TASK.split(', ')))}>>"


def payload(x: Column) -> Column:
    """The first JSON object of a text as a summary payload: version "1.0", empty texts and empty lists where fields lack.

    Fixed values: a task without title and description goes; title, description, owner, agent and plan fields are cut to
    140, 1000, 100, 60 / 200 and 200 / 50 / 80 / 200 signs, labels to 10 distinct ones and plans to 6 steps; priority is low,
    medium, high or urgent, else medium; an agent's confidence is held to 0..1.
    """
    text = lambda v, n=None: F.coalesce(F.trim(v) if n is None else F.substring(F.trim(v), 1, n), F.lit(""))
    items = lambda v: F.coalesce(v, F.array().cast("array<string>"))

    def task(t: Column) -> Column:
        level = F.lower(text(t["priority"]))
        labels = F.slice(F.array_distinct(F.filter(F.transform(items(t["labels"]), lambda v: F.trim(v)), lambda v: v != "")), 1, 10)
        sure = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t["agent"]["confidence"].try_cast("double"), F.lit(0.0))))
        agent = F.struct(text(t["agent"]["name"], 60).alias("name"), sure.alias("confidence"), text(t["agent"]["rationale"], 200).alias("rationale"))
        step = lambda p, i: F.struct(F.coalesce(p["step"].try_cast("int"), i + 1).alias("step"), text(p["action"], 200).alias("action"), text(p["tool"], 50).alias("tool"), text(p["operation"], 80).alias("operation"), text(p["expected_output"], 200).alias("expected_output"))
        return F.struct(
            text(t["title"], 140).alias("title"), text(t["description"], 1000).alias("description"), labels.alias("labels"),
            F.when(level.isin("low", "medium", "high", "urgent"), level).otherwise("medium").alias("priority"), text(t["owner_hint"], 100).alias("owner_hint"),
            agent.alias("agent"), F.coalesce(F.transform(F.slice(t["plan"], 1, 6), step), F.from_json(F.lit("[]"), "array<struct<step:int,action:string,tool:string,operation:string,expected_output:string>>")).alias("plan"),
        )

    def made(p: Column) -> Column:
        told = F.filter(p["tasks"], lambda t: (text(t["title"]) != "") | (text(t["description"]) != ""))
        plain = [F.coalesce(p[n], F.lit(d)).alias(n) for n, d in (("version", "1.0"), ("language", ""), ("summary", ""))]
        lists = [items(p[n]).alias(n) for n in ("key_points", "topics", "people", "organizations", "places")]
        return F.struct(*plain, *lists, F.coalesce(p["quality_notes"], F.lit("")).alias("quality_notes"), F.transform(F.coalesce(told, F.array().cast(f"array<struct<{_TASK}>>")), task).alias("tasks"))

    return _with(F.from_json(F.coalesce(first_json_object(x), F.lit("{}")), PAYLOAD), made)


#: Fixed values of the lyric rules.
STOP_WORDS = ("the", "a", "an", "and", "or", "but", "to", "of", "in", "on", "for", "with", "is", "are", "am", "be", "was", "were", "it", "that", "this", "you", "i")
REFRAIN = r"\b(la+|na+|yeah+|ooh+|mmm+)\b"
_BLANK = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]"


def _stripped(x: Column) -> Column:
    return F.regexp_replace(x, f"^{_BLANK}+|{_BLANK}+$", "")


def _most_common(xs: Column) -> Column:
    """struct(most, repeated): how often the commonest item stands in a list, and how many items stand there more than once."""
    zero = F.struct(F.lit(None).cast("string").alias("item"), *[F.lit(0).alias(n) for n in ("run", "most", "repeated")])

    def step(acc: Column, item: Column) -> Column:
        run = F.when(acc["item"] == item, acc["run"] + 1).otherwise(1)
        again = F.when(run == 2, 2).when(run > 2, 1).otherwise(0)
        return F.struct(item.alias("item"), run.alias("run"), F.greatest(acc["most"], run).alias("most"), (acc["repeated"] + again).alias("repeated"))

    return F.aggregate(F.array_sort(xs), zero, step)


def lyric_features(text: Column) -> Column:
    """struct(repetition, rhyme, stopwords, lala, linebreak, score): shares of 0 to 1 and their weighted sum.

    repetition: three times the share of word pairs that occur again. rhyme: lines with the commonest last three letters,
    of all lines. stopwords: how far the share of stop words stays under 0.4. lala: whether a refrain syllable occurs.
    linebreak: line breaks for 80 letters. Weights .25, .25, .15, .20, .15. A blank or null text has zeros.
    """

    def made(t: Column, lines: Column, words: Column) -> Column:
        many = F.size(words)
        pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(many - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(many - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        ends = F.transform(F.filter(lines, lambda v: F.length(v) >= 3), lambda v: F.right(v, F.lit(3)))
        repetition = F.least(F.lit(1.0), _most_common(pairs)["repeated"] / F.greatest(many - 1, F.lit(1)) * 3)
        rhyme = F.least(F.lit(1.0), _most_common(ends)["most"] / F.greatest(F.size(lines), F.lit(1)))
        stop = F.greatest(F.lit(0.0), 0.4 - F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))) / F.greatest(many, F.lit(1))) / 0.4
        breaks = F.least(F.lit(1.0), F.greatest(F.size(lines) - 1, F.lit(0)) / F.greatest(F.lit(1.0), F.length(t) / 80))
        lala = F.when(t.rlike(REFRAIN), 1.0).otherwise(0.0)
        return F.struct(repetition.alias("repetition"), rhyme.alias("rhyme"), F.when(t != "", stop).otherwise(0.0).alias("stopwords"), lala.alias("lala"), breaks.alias("linebreak"))

    def bound(t: Column) -> Column:
        lines = F.filter(F.transform(F.split(t, r"[\r\n]+"), _stripped), lambda v: v != "")
        return _with(lines, lambda a: _with(F.regexp_extract_all(t, F.lit("[a-z']+"), F.lit(0)), lambda b: made(t, a, b)))

    f = _with(_stripped(F.lower(F.coalesce(text, F.lit("")))), bound)
    score = lambda v: 0.25 * v["repetition"] + 0.25 * v["rhyme"] + 0.20 * v["lala"] + 0.15 * v["linebreak"] + 0.15 * v["stopwords"]
    return _with(f, lambda v: F.struct(*[v[n].alias(n) for n in ("repetition", "rhyme", "stopwords", "lala", "linebreak")], F.least(F.lit(1.0), F.greatest(F.lit(0.0), score(v))).alias("score")))


def ensemble(audio: Column, text: Column, rules: Column, lyrics_at: float = 0.8, speech_at: float = 0.35) -> Column:
    """struct(score, verdict): weighted vote .5 / .4 / .1 over the parts present, then lyrics, speech or review."""
    score = 0.5 * F.coalesce(audio, F.lit(0.0)) + 0.4 * F.coalesce(text, F.lit(0.0)) + 0.1 * F.coalesce(rules, F.lit(0.0))
    return F.struct(score.alias("score"), F.when(score >= lyrics_at, "lyrics").when(score <= speech_at, "speech").otherwise("review").alias("verdict"))


# Dates --------------------------------------------------------------------------------------------------------------


def any_time(x: Column) -> Column:
    """TIMESTAMP from epoch seconds, epoch milliseconds or ISO text; null for anything else."""
    digits = F.when(x.rlike(r"^-?\d{1,18}(\.\d+)?$"), x.try_cast("double"))
    by_epoch = F.timestamp_millis(F.when(F.abs(digits) >= 1e11, digits).otherwise(digits * 1000).cast("long"))
    return F.coalesce(by_epoch, F.try_to_timestamp(F.when(digits.isNull(), x)))


#: Stamps in recordings' names, tried in this order, and their forms.
STAMPS = (
    (r"(\d{14})", "yyyyMMddHHmmss"),
    (r"(\d{4}_\d{4}_\d{6})", "yyyy_MMdd_HHmmss"),
    (r"(\d{8}_\d{6})", "yyyyMMdd_HHmmss"),
    (r"(\d{4}-\d{2}-\d{2}[_\-]\d{2}-\d{2}-\d{2})", "yyyy-MM-dd_HH-mm-ss"),
    (r"(\d{4}_\d{2}_\d{2}[_\-]\d{2}_\d{2}_\d{2})", "yyyy_MM_dd_HH_mm_ss"),
)


def key_time(key: Column, tz: str = "UTC") -> Column:
    """TIMESTAMP in UTC from the local stamp in a recording's key or path; null without one.

    Forms: those of STAMPS, then the folders /yyyy/MM/dd/ with six digits for the time in the file's name. A stamp that is
    no valid time is passed over.
    """
    tries = [F.try_to_timestamp(F.nullif(F.regexp_extract(key, pattern, 1), F.lit("")), F.lit(form)) for pattern, form in STAMPS]
    day = F.regexp_extract(key, r"/(\d{4}/\d{2}/\d{2})/", 1)
    clock = F.regexp_extract(F.regexp_extract(key, r"([^/]*)$", 1), r"(?<!\d)(\d{6})(?!\d)", 1)
    tries.append(F.try_to_timestamp(F.when((day != "") & (clock != ""), F.concat(day, clock)), F.lit("yyyy/MM/ddHHmmss")))
    return F.to_utc_timestamp(F.coalesce(*tries), tz)


def loose_date(x: Column) -> Column:
    """DATE from six common written forms."""
    # The forms, in this order.
    forms = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd MMM yyyy", "MMM d, yyyy", "yyyyMMdd")
    return F.coalesce(*[F.try_to_timestamp(F.trim(x), F.lit(f)) for f in forms]).cast("date")


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + 1


def coalesce_columns(df, *names: str) -> Column:
    """The first of the columns that exist in ``df``, by value; null if none exists. Tolerates spellings of headers."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[n.lower()]) for n in names if n.lower() in have]
    return F.coalesce(*found) if found else F.lit(None)
