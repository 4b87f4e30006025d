"""Scalar functions on dates, numbers, bytes and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# How files begin, as hex.
MAGIC = [("89504e470d0a1a0a", ".png"), ("ffd8ff", ".jpg"), ("474946383761", ".gif"), ("474946383961", ".gif"), ("255044462d", ".pdf"), ("494433", ".mp3"), ("4f676753", ".ogg")]
FORMS = [("57454250", ".webp"), ("57415645", ".wav"), ("41564920", ".avi")]
MIME = {"image/png": ".png", "image/jpeg": ".jpg", "image/gif": ".gif", "image/webp": ".webp", "application/pdf": ".pdf", "audio/mpeg": ".mp3", "audio/wav": ".wav", "audio/x-wav": ".wav", "audio/ogg": ".ogg", "video/mp4": ".mp4", "video/x-msvideo": ".avi"}
POINTER = r"(?:file-service://|sediment://)(file[-_][A-Za-z0-9_-]+)"


def any_date(text: Column) -> Column:
    """A timestamp from PDF, ISO or plain notation, else null. Times without offset are of the session's zone."""
    t = F.trim(text)
    pdf = r"^D:(\d{4})(\d{2})(\d{2})(\d{2})?(\d{2})?(\d{2})?(?:(Z)|([+-])(\d{2})'?(\d{2})?)?"
    part = lambda i: F.regexp_extract(t, pdf, i)
    or_zero = lambda i: F.coalesce(F.nullif(part(i), F.lit("")), F.lit("00"))
    zone = F.when(part(7) == "Z", "Z").when(part(8) != "", F.concat(part(8), part(9), F.lit(":"), or_zero(10))).otherwise("")
    iso_of_pdf = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"), or_zero(4), F.lit(":"), or_zero(5), F.lit(":"), or_zero(6), zone)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.try_to_timestamp(F.regexp_replace(F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"^(\S{10})[T ](\d{2}:\d{2})(Z|[+-].*)?$", "$1T$2:00$3")))
    slashed = F.when(t.rlike(r"^\d{4}/\d{2}/\d{2}$"), F.try_to_timestamp(F.replace(t, F.lit("/"), F.lit("-"))))
    return F.coalesce(F.when(t.rlike(r"^D:\d{8}"), F.try_to_timestamp(iso_of_pdf)), iso, slashed)


def iso_minutes(at: Column, zone: str = "UTC") -> Column:
    """Local time to the minute with the zone's offset at that time. The session's own zone does not matter."""
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), at.cast("timestamp_ntz"))
    shift = F.unix_seconds(F.from_utc_timestamp(at, zone)) - F.unix_seconds(at)
    offset = F.concat(F.when(shift < 0, "-").otherwise("+"), F.format_string("%02d:%02d", F.floor(F.abs(shift) / 3600), F.floor(F.abs(shift) % 3600 / 60)))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm"), offset)


def resolved_date(candidates: list[tuple[str, Column]], file_name: Column, modified: Column) -> tuple[Column, Column]:
    """(date, where it is from): a field of the document, else the file's name, else its time of change."""
    m = r"^(\d{4}-\d{2}-\d{2})-(\d{2})(\d{2})__"
    named = F.when(file_name.rlike(m), F.try_to_timestamp(F.concat(F.regexp_extract(file_name, m, 1), F.lit(" "), F.regexp_extract(file_name, m, 2), F.lit(":"), F.regexp_extract(file_name, m, 3))))
    parsed = [(name, any_date(c)) for name, c in candidates]
    at = F.coalesce(*[c for _, c in parsed], named, modified)
    source = F.lit(None).cast("string")
    for name, c in [*reversed(parsed)]:
        source = F.when(c.isNotNull(), f"document ({name})").otherwise(source)
    return at, F.coalesce(source, F.when(named.isNotNull(), "filename"), F.when(modified.isNotNull(), "file mtime"), F.lit("unavailable"))


def name_date(name: Column) -> Column:
    """The date that a file name begins with, if there is such a day."""
    found = F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy-MM-dd")))


def record_date(name: Column, head: Column) -> Column:
    """The day of a record: that its file's name begins with, else the date within the first 2,048 characters of its frontmatter."""
    found = F.regexp_extract(F.substring(head, 1, 2048), r'(?m)^date:[ \t]*"?(\d{4}-\d{2}-\d{2})', 1)
    return F.coalesce(name_date(name), F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy-MM-dd"))))


def date_text(at: Column) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("unknown"))


def epoch_text(seconds: Column) -> Column:
    return F.coalesce(F.date_format(F.timestamp_micros((seconds * 1_000_000).cast("long")), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def sheet_serial(serial: Column) -> Column:
    """A spreadsheet's day number as text: empty below 1, a date if whole, else to the second."""
    day = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))
    seconds = F.round((serial - F.floor(serial)) * 86_400).cast("long")
    timed = F.date_format(F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + seconds), "yyyy-MM-dd HH:mm:ss")
    return F.when(serial < 1, "").when(serial == F.floor(serial), F.date_format(day, "yyyy-MM-dd")).otherwise(timed)


def column_number(letters: Column) -> Column:
    """A = 1, Z = 26, AA = 27."""
    return F.aggregate(F.filter(F.split(letters, ""), lambda c: c != ""), F.lit(0), lambda total, c: total * 26 + F.ascii(c) - 64)


def column_letters(number: Column, most: int = 4) -> Column:
    """The letters of a column number, up to ``most`` of them."""
    out, rest = F.lit(""), number
    for _ in range(most):
        out = F.when(rest > 0, F.concat(F.char(65 + (rest - 1) % 26), out)).otherwise(out)
        rest = F.floor((rest - 1) / 26)
    return out


def heading_level(half_points: Column) -> Column:
    return F.when(half_points >= 48, 1).when(half_points >= 36, 2).when(half_points >= 28, 3)


def sniffed_extension(content: Column) -> Column:
    """A file's extension by its first bytes; null where they are none that is known."""
    head = F.lower(F.hex(F.substring(content, 1, 12)))
    tests = [(head.startswith("52494646") & (F.substring(head, 17, 8) == form), ext) for form, ext in FORMS]
    tests += [(head.startswith(magic), ext) for magic, ext in MAGIC]
    return reduce(lambda c, t: c.when(*t), [*tests[1:], (F.substring(head, 9, 8) == "66747970", ".mp4")], F.when(*tests[0]))


def asset_extension(name: Column, mime: Column, content: Column) -> Column:
    """An extension for a stored asset: that of its name, else of its media type, else of its first bytes, else ``.bin``."""
    own = F.nullif(F.lower(F.regexp_extract(name, r".(\.[A-Za-z0-9]{1,8})$", 1)), F.lit(""))
    typed = F.element_at(F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair]), F.lower(F.trim(F.substring_index(mime, ";", 1))))
    return F.coalesce(own, typed, sniffed_extension(content), F.lit(".bin"))


def data_url_bytes(url: Column) -> Column:
    """The payload of a base64 data URL, null where it is none."""
    return F.when(url.rlike(r"^data:[^,]*;base64,"), F.try_to_binary(F.regexp_replace(url, r"^data:[^,]*;base64,", ""), F.lit("base64")))


def pointers(json_text: Column) -> Column:
    """Asset ids that a JSON value names anywhere, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(json_text, F.lit(POINTER), F.lit(1)))


def human_size(n: Column) -> Column:
    scaled = lambda k, unit: F.format_string(f"%.1f {unit}", F.round(n / float(1024**k), 1))
    return F.when(n < 1024, F.format_string("%d B", n)).when(n < 1024**2, scaled(1, "KB")).when(n < 1024**3, scaled(2, "MB")).otherwise(scaled(3, "GB"))
