"""Column functions on names, sizes, durations and packed text.

All of them are compositions of built-in functions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from simquarry.functions import fixed_values as fv


def strip(col: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def blank(col: Column) -> Column:
    """NULL or empty."""
    return F.coalesce(col, F.lit("")) == ""


def ticket_entry(entry: Column, mode: str = "regex") -> tuple[Column, Column, Column]:
    """Landing id, collection and validity of one entry of the packed string.

    ``regex`` takes everything after the second colon as the collection;
    ``split`` takes the second colon-separated field only.
    """
    if mode == "regex":
        # The pattern by hand: prefix, a landing up to the first colon, and a
        # collection, neither empty.  Much cheaper than three matches an entry.
        start, colon = len(fv.TICKET_PREFIX) + 1, F.locate(":", entry)
        ok = (
            entry.startswith(fv.TICKET_PREFIX) & (colon > start) & (F.length(entry) > colon) & ~entry.contains("\n")
        )
        landing = F.substring(entry, F.lit(start), colon - start)
        collection = F.substring(entry, colon + 1, F.length(entry))
    elif mode == "split":
        ok = entry.contains(":")
        collection = second_field(entry)
        landing = landing_name(collection)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(ok, landing), F.when(ok, collection), ok


def second_field(entry: Column) -> Column:
    """Text between the first and the second colon; NULL without a colon."""
    return F.when(entry.contains(":"), F.substring_index(F.substring_index(entry, ":", 2), ":", -1))


def landing_name(collection: Column) -> Column:
    """Last path component, trailing slashes dropped."""
    return F.substring_index(F.rtrim(collection, F.lit("/")), "/", -1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; a leading dot does not count."""
    return F.lower(F.regexp_extract(basename(path), r"^\.*[^.].*?(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    """File name without directory and extension."""
    name = basename(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(path)))


def dirname(path: Column) -> Column:
    d = F.regexp_replace(path, "/?[^/]*$", "")
    return F.when(d == "", ".").otherwise(d)


def repo_id(sim_id: Column) -> Column:
    """MDR and at least eight digits."""
    digits = sim_id.cast("string")
    return F.concat(F.lit("MDR"), F.when(F.length(digits) > 8, digits).otherwise(F.lpad(digits, 8, "0")))


def permanent_path(sim_id: Column, kind: Column | str, name: Column) -> Column:
    """Path below the release root; processed files keep their base name only."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    name = F.when(kind == "processed", basename(name)).otherwise(name)
    joined = F.concat_ws("/", repo_id(sim_id), kind, name)
    return F.when(name.startswith("/"), name).otherwise(joined)


def norm_md5(checksum: Column) -> Column:
    """Bare lower-case digest: scheme prefix and padding dropped."""
    return F.lower(strip(F.regexp_replace(checksum, "^[^:]*:", "")))


def human_bytes(size: Column) -> Column:
    """One decimal, steps of 1024, B to PB.  Ties go to the even digit."""
    value, out = size.cast("double"), None
    for power, unit in enumerate(["B", "KB", "MB", "GB", "TB"]):
        scaled = value / float(1024**power)
        text = F.format_string("%.1f " + unit, F.bround(scaled, 1))
        hit = F.abs(scaled) < 1024
        out = F.when(hit, text) if out is None else out.when(hit, text)
    last = F.format_string("%.1f PB", F.bround(value / float(1024**5), 1))
    return F.when(size.isNotNull(), out.otherwise(last))


def format_hm(seconds: Column) -> Column:
    """``<1m``, ``35m`` or ``26h 5m``; NULL stays NULL."""
    minutes = F.floor(seconds.cast("long") / 60)
    hours = F.floor(minutes / 60)
    rest = (minutes % 60).cast("string")
    return (
        F.when(seconds.isNull(), F.lit(None).cast("string"))
        .when(seconds.cast("long") < 60, "<1m")
        .when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), rest, F.lit("m")))
        .otherwise(F.concat(rest, F.lit("m")))
    )


def tail_lines(text: Column, n: int = 20) -> Column:
    """The last ``n`` lines, white space trimmed at both ends."""
    lines = F.split(F.regexp_replace(text, r"\n\z", ""), "\n")
    kept = F.when(F.size(lines) > n, F.slice(lines, -n, n)).otherwise(lines)
    return strip(F.array_join(kept, "\n"))


def slug(label: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "job").otherwise(s)


def one_line(text: Column, limit: int = 500) -> Column:
    """White space collapsed, cut at ``limit`` characters."""
    return F.left(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r"\s+", " "), F.lit(limit))


def display_name(first: Column, last: Column, username: Column) -> Column:
    full = strip(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))))
    return F.when(full == "", username).otherwise(F.concat(full, F.lit(" ("), username, F.lit(")")))
