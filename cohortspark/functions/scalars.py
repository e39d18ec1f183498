"""Scalar building blocks, all of them plain Spark column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- predicates


def like_any(column: Column, patterns: Sequence[str]) -> Column:
    """True where any LIKE pattern holds; ``_`` and ``%`` are the only wildcards.

    A backslash in a pattern is an ordinary character, as concept paths need.
    """
    if not patterns:
        return F.lit(False)
    used = set("".join(patterns))
    escape = next(c for c in "!~^`|" if c not in used)
    return reduce(
        lambda a, b: a | b, (F.like(column, F.lit(p), F.lit(escape)) for p in patterns)
    )


def matches(column: Column, regex: str) -> Column:
    """Regular-expression test that is false, not NULL, on NULL."""
    return F.coalesce(column.rlike(regex), F.lit(False))


def contains_ignoring_case(column: Column, text: str) -> Column:
    """Substring test in any case, false on NULL."""
    return F.coalesce(F.lower(column).contains(text.lower()), F.lit(False))


def not_before(df: DataFrame, column: str, since: str) -> Column:
    """Floor on a date or time column, in its own type so that scans can use it."""
    kind = df.select(column).schema[0].dataType
    return F.col(column) >= F.lit(since).cast(kind)


def is_unit(column: Column, unit: str) -> Column:
    return F.upper(column) == unit.upper()


def within_or_open(moment: Column, start: Column, end: Column) -> Column:
    """``moment`` lies in [start, end], or there is no start at all."""
    return ((moment <= end) & (moment >= start)) | start.isNull()


def in_box(lon: Column, lat: Column, lons: tuple[float, float], lats: tuple[float, float]) -> Column:
    return lon.between(*lons) & lat.between(*lats)


def starts_with_any(column: Column, prefixes: Sequence[str]) -> Column:
    """OR of prefix tests; Parquet and ORC scans can push it down.

    A prefix that extends another listed one adds nothing and is left out.
    """
    kept: list[str] = []
    for prefix in sorted(set(prefixes)):
        if not kept or not prefix.startswith(kept[-1]):
            kept.append(prefix)
    if not kept:
        return F.lit(False)
    return reduce(lambda a, b: a | b, (column.startswith(p) for p in kept))


# ------------------------------------------------------------------- codes


def after_last_colon(column: Column) -> Column:
    return F.substring_index(column, ":", -1)


def code_system(column: Column) -> Column:
    """Part before the first colon, with the charge prefix ``CH`` read as ``CPT``."""
    system = F.substring_index(column, ":", 1)
    return F.when(system == "CH", F.lit("CPT")).otherwise(system)


def loinc_url(column: Column) -> Column:
    return F.concat(F.lit("https://loinc.org/"), column)


def search_url(column: Column) -> Column:
    return F.concat(
        F.lit("https://www.google.com/search?q="),
        code_system(column),
        F.lit(":"),
        after_last_colon(column),
    )


def key_digits(key: Column, digits: int = 1, width: int = 6, start: int = 3) -> Column:
    """Number held by the characters of the left-padded key from ``start`` on.

    Keys longer than ``width`` keep their first ``width`` characters.
    """
    padded = F.lpad(key.cast("string"), width, "0")
    return F.substring(padded, start, digits).cast("int")


# -------------------------------------------------------------------- time


def hours_between(start: Column, end: Column, digits: int = 0) -> Column:
    """Hours from ``start`` to ``end``, rounded half to even."""
    return F.bround(F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9), digits)


def days_between(start: Column, end: Column, digits: int = 0) -> Column:
    return F.bround(F.timestamp_diff("MICROSECOND", start, end) / F.lit(8.64e10), digits)


def shifted_hours(moment: Column, hours: int) -> Column:
    return moment + F.expr(f"INTERVAL '{int(hours)}' HOUR")


def clamped(hours: Column, upper: Column) -> Column:
    """``hours`` held in [0, upper]; a missing bound or value is passed over."""
    return F.least(F.greatest(hours, F.lit(0.0)), upper)


def biweek(week_rank: Column) -> Column:
    return F.floor(week_rank / F.lit(2)) + F.lit(1)


# ----------------------------------------------------------------- recoding


def recode_first(column: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern the lower-cased value contains."""
    lowered = F.lower(column)
    (pattern, label), *rest = rules
    out = F.when(lowered.rlike(pattern), F.lit(label))
    for pattern, label in rest:
        out = out.when(lowered.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit(default))


def keep_listed(
    column: Column, listed: Sequence[str], canonical: Sequence[str] = (), default: str = "OT"
) -> Column:
    """Listed values as they are, a canonical phrase where one occurs, NULL as
    NULL, and ``default`` for all the rest."""
    out = F.when(column.isin(*listed), column)
    for phrase in canonical:
        out = out.when(column.contains(phrase), F.lit(phrase))
    return out.when(column.isNull(), F.lit(None).cast("string")).otherwise(F.lit(default))


def decode(column: Column, labels: Mapping[int, str]) -> Column:
    out = F.lit(None).cast("string")
    for value, label in labels.items():
        out = F.when(column == value, F.lit(label)).otherwise(out)
    return out


def present(column: Column) -> Column:
    """1 where there is a value, 0 where it is missing."""
    return column.isNotNull().cast("int")


def visit_class(ed_episode: Column, visit: Column) -> Column:
    """Inpatient visits that began as an emergency get a class of their own."""
    return F.when(
        (ed_episode == 1) & (visit == "Inpatient"), F.lit("Emergency-Inpatient")
    ).otherwise(visit)


# --------------------------------------------------------------- arithmetic


def mean_arterial(systolic: Column, diastolic: Column, recorded: Column) -> Column:
    """(2 * diastolic + systolic) / 3 rounded; the recorded value if one is missing."""
    both = systolic.isNotNull() & diastolic.isNotNull()
    return F.when(both, F.bround((diastolic * 2 + systolic) / 3)).otherwise(recorded)


def share_of_total(part: Column, total: Column) -> Column:
    """Percent of a total. A part above its total was recorded on another scale.

    A total of zero gives NULL.
    """
    ratio = F.bround(F.try_divide(part, total), 3)
    return F.when(part > total, ratio / 10).otherwise(ratio * 100)


def safe_ratio(value: Column, base: Column) -> Column:
    return F.when(base > 0, F.bround(F.try_divide(value, base), 3)).otherwise(F.lit(0.0))


def range_flag(value: Column, low: Column, high: Column) -> Column:
    return F.when(value < low, "low").when(value > high, "high").otherwise("normal")


# ------------------------------------------------------------------- labels


def number_text(value: Column, digits: int) -> Column:
    """Rounded number without trailing zeros; ``NA`` for a missing one."""
    text = F.format_string(f"%.{digits}f", F.bround(value.cast("double"), digits))
    if digits:
        text = F.regexp_replace(text, r"\.?0+$", "")
    text = F.when(text == "-0", F.lit("0")).otherwise(text)
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit("NA")).otherwise(text)


def suppressed(count: Column, least: int = 11) -> Column:
    """Counts under ``least`` are shown as ``< least`` only."""
    return F.when(count < least, F.lit(f"< {least}")).otherwise(count.cast("string"))


def text_or_na(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("NA"))


# ---------------------------------------------------------------- web pages


# parts of a start tag: what stands in quotes may hold anything but that quote
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_ANCHOR = rf"""(?is)<a(?=[\s/>])(?:[^>"']++|{_QUOTED})*+>"""
# the attributes before the wanted one are passed over whole, so that its name in a value is not taken for it
_HREF = rf"""(?is)^<a(?:[\s/]++(?!href[\s=])[^\s"'>/=]++(?:\s*+=\s*+(?:{_QUOTED}|[^\s"'>]++))?+)*+[\s/]++href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
# The named characters of addresses.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def decoded_entities(text: Column) -> Column:
    """Named and numbered characters of markup as themselves, each decoded once.

    A number that names no character stands for the replacement character; a reference without its
    semicolon, or with an unknown name, stays as it is.
    """
    pieces = F.split(text, "(?=&)")

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);", 1)
        rest = F.substring(piece, F.length(name) + 3, F.length(piece))
        digits = F.regexp_replace(name, "^#[xX]?", "")
        # more digits than any character has are cut before they overflow
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        value = F.when(name.rlike("^#[xX]"), F.conv(short, 16, 10)).otherwise(F.conv(short, 10, 10))
        number = F.when((F.length(short) > 7) | (short == ""), F.lit(0)).otherwise(value.cast("long"))
        valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        code = F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0")
        out = F.when(name.startswith("#"), F.concat(F.decode(F.unhex(code), "UTF-32"), rest))
        for known, character in _NAMED.items():
            out = out.when(name == known, F.concat(F.lit(character), rest))
        return out.otherwise(piece)

    return F.array_join(F.transform(pieces, decoded), "")


def first_secure_link(html: Column) -> Column:
    """First https address among the anchors inside level-three headings.

    Start tags are read as such: an address may stand in double quotes, in single quotes or bare, a
    quoted value may hold brackets or look like an attribute, comments count for nothing, and
    characters given by name or number are decoded. Tracking parameters behind ``&sa=U`` are cut, and
    a redirect address is reduced to the target it holds. NULL where no such link exists.
    """
    shown = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    headings = F.regexp_extract_all(shown, F.lit(r"(?is)<h3(?=[\s/>])[^>]*+>(.*?)</h3\s*+>"), 1)
    anchors = F.flatten(F.transform(headings, lambda h: F.regexp_extract_all(h, F.lit(_ANCHOR), 0)))

    def address(tag: Column) -> Column:
        # an attribute that does not match gives an empty text
        return decoded_entities(F.concat(*(F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3))))

    secure = F.filter(F.transform(anchors, address), lambda u: u.contains("https:"))
    first = F.try_element_at(secure, F.lit(1))
    return F.regexp_replace(F.regexp_replace(first, r"(?s)&sa=U.*$", ""), r"(?s)^.*https://", "https://")
