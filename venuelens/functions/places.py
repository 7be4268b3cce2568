"""Place names out of free text.

``literal=True`` gives the behaviour as published, where numeric districts are
lost, "Dis" of "District" is read as a short form and the letter đ is dropped.
The default gives the behaviour that the published tests and notes ask for.
``ascii=True`` gives labels without accents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv

# Unicode-aware, case-blind matching.
_I = "(?iU)"
# Whitespace other than the plain space, and what has to become one plain space.
_ODD_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_RUN = f"[ {_ODD_SPACE}]{{2,}}|[{_ODD_SPACE}]"
_IS_PLACEHOLDER = f"(?i)^(?:{'|'.join(p for p in fv.PLACEHOLDERS if p)})$"


def _once(value: Column, change: Callable[[Column], Column]) -> Column:
    """``change(value)`` with ``value`` worked out a single time however often ``change`` uses it; NULL stays NULL."""
    return F.get(F.transform(F.filter(F.array(value), lambda x: x.isNotNull()), lambda x: change(x)), 0)


def clean_location_text(value: Column) -> Column:
    """One line, single spaces, no outer spaces or commas; NULL and placeholders give ''."""
    text = F.regexp_replace(F.coalesce(value, F.lit("")), _SPACE_RUN, " ")
    text = F.btrim(F.btrim(F.btrim(text), F.lit(",")))
    return F.regexp_replace(text, _IS_PLACEHOLDER, "")


def is_unknown_location(value: Column) -> Column:
    """N6."""
    return clean_location_text(value) == ""


@cache
def _accent_table() -> tuple[str, str]:
    """Characters whose compatibility decomposition holds exactly one ASCII character, and that character."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        ascii_part = [c for c in unicodedata.normalize("NFKD", chr(code)) if c < "\x80"]
        if len(ascii_part) == 1:
            source.append(chr(code))
            target.append(ascii_part[0])
    return "".join(source), "".join(target)


def accented_letters() -> str:
    """The characters that ``strip_accents`` turns into one ASCII character each."""
    return _accent_table()[0] + "đĐ"


def strip_accents(value: Column, literal: bool = False) -> Column:
    """ASCII text. Accents go, whether composed or combining; other non-ASCII characters are dropped."""
    source, target = _accent_table()
    if not literal:
        source, target = source + "đĐ", target + "dD"

    def folded(text: Column) -> Column:
        plain = F.regexp_replace(F.translate(text, source, target), r"[^\x00-\x7F]", "")
        return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)

    return _once(value, folded)


def trim_noise(value: Column, literal: bool = False, ascii: bool = False) -> Column:
    """The text after the last street or building word, without leading house numbers and a trailing ward/district."""
    return _trim_cleaned(clean_location_text(value), literal, ascii)


def _trim_cleaned(value: Column, literal: bool, ascii: bool) -> Column:
    """``trim_noise`` of text that is on one line with single spaces, as all parts of a cleaned text are."""
    street = fv.STREET_WORDS_PATTERN_ASCII if ascii else fv.STREET_WORDS_PATTERN

    def after_street(text: Column) -> Column:
        rest = F.regexp_replace(text, "(?isU)^.*" + street, "")
        return F.when(text.rlike(_I + street), rest).otherwise(text)

    # A capture that is only a short number is the name of a district or ward and stays.
    short_stays = "" if literal else r"(?!^\s*\d{1,2}\s*$)"
    house_number = short_stays + fv.HOUSE_NUMBER_PATTERN
    text = F.btrim(F.regexp_replace(_once(value, after_street), house_number, ""), F.lit(" -.,"))
    text = F.btrim(F.regexp_replace(text, _I + fv.AREA_SUFFIX_PATTERN, ""), F.lit(" -.,"))
    return F.regexp_replace(text, _IS_PLACEHOLDER, "")


def _title_case(text: Column) -> Column:
    """First letter of each space-separated part upper, the rest lower."""
    return F.array_join(
        F.transform(
            F.split(text, " "),
            lambda part: F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 2147483647))),
        ),
        " ",
    )


def normalize_area_name(value: Column, literal: bool = False, ascii: bool = False) -> Column:
    """The known spelling of the area (J2), else title case; a short number stays as it is."""
    return _known_or_title(trim_noise(value, literal, ascii), literal, ascii)


def _known_or_title(trimmed: Column, literal: bool, ascii: bool) -> Column:
    names = {k: _ascii_text(v) if ascii else v for k, v in fv.AREA_ALIASES.items()}
    aliases = F.str_to_map(F.lit("|".join(f"{k}={v}" for k, v in names.items())), F.lit("[|]"), F.lit("="))

    def named(text: Column) -> Column:
        key = F.lower(strip_accents(text, literal))
        key = F.trim(F.regexp_replace(F.regexp_replace(key, r"[^a-z0-9\s-]", " "), r"\s+", " "))
        return F.coalesce(F.try_element_at(aliases, key), _title_case(key if ascii else text))

    return _once(trimmed, named)


def match_first(source: Column, patterns: Sequence[str], literal: bool = False, ascii: bool = False) -> Column:
    """Trimmed capture of the first pattern that matches a cleaned text, even if empty; NULL when none does."""
    result = None
    for pattern in patterns:
        hit, capture = source.rlike(_I + pattern), F.regexp_extract(source, _I + pattern, 1)
        trimmed = _trim_cleaned(capture, literal, ascii)
        result = F.when(hit, trimmed) if result is None else result.when(hit, trimmed)
    return result


def extract_admin_area(*values: Column, literal: bool = False, ascii: bool = False, cleaned: bool = False) -> Column:
    """N11: "Quận X" or "Phường X" out of the sources, else "Unknown". ``cleaned`` says that N5 was applied to them.

    Kinds go first, sources second: a numbered district in any source beats a
    named district, which beats a ward. Later patterns run only where none has matched.
    """
    sources = list(values) if cleaned else [clean_location_text(v) for v in values]
    if ascii:
        sources = [strip_accents(s, literal) for s in sources]
    prefix = fv.DISTRICT_PREFIX_PATTERN_LITERAL if literal else fv.DISTRICT_PREFIX_PATTERN
    named = [fv.DISTRICT_LOCAL_PATTERN, prefix, fv.DISTRICT_SUFFIX_PATTERN]
    wards = [fv.WARD_LOCAL_PATTERN, fv.WARD_SUFFIX_PATTERN, fv.WARD_PREFIX_PATTERN]
    if ascii:
        named = [_ascii_pattern(p) for p in named]
        wards = [_ascii_pattern(p) for p in wards]
    district_label, ward_label = fv.DISTRICT_LABEL, fv.WARD_LABEL
    if ascii:
        district_label, ward_label = _ascii_text(district_label), _ascii_text(ward_label)

    all_sources = F.array(*sources)
    candidates: list[Column] = []
    if not literal:  # as published, a captured number is trimmed away again
        number = _first_found(all_sources, lambda s: F.regexp_extract(s, _I + fv.DISTRICT_NUMBER_PATTERN, 1))
        candidates.append(F.concat(F.lit(f"{district_label} "), number))
    for label, patterns in ((district_label, named), (ward_label, wards)):
        found = _first_found(all_sources, lambda s, patterns=patterns: match_first(s, patterns, literal, ascii))
        area = _once(found, lambda x: _known_or_title(_trim_cleaned(x, literal, ascii), literal, ascii))
        candidates.append(F.concat(F.lit(f"{label} "), area))
    return F.coalesce(*candidates, F.lit(fv.UNKNOWN))


def _first_found(sources: Column, find: Callable[[Column], Column]) -> Column:
    """The first non-empty result over the sources, else NULL. Sources after a hit are not looked at."""

    def step(found: Column, source: Column) -> Column:
        return F.coalesce(found, F.get(F.filter(F.array(find(source)), lambda x: x != ""), 0))

    return F.aggregate(sources, F.lit(None).cast("string"), step)


def _ascii_text(text: str) -> str:
    plain = text.translate(str.maketrans("đĐ", "dD"))
    return unicodedata.normalize("NFKD", plain).encode("ascii", "ignore").decode("ascii")


def _ascii_pattern(pattern: str) -> str:
    return pattern.replace("Phường", "Phuong")


def normalize_city(*values: Column, cleaned: bool = False) -> Column:
    """The first usable source without post code and country; all spellings of one city give one name.

    ``cleaned`` says that N5 was applied to the sources.
    """
    def label(text: Column) -> Column:
        is_city = strip_accents(text).rlike(_I + fv.CITY_PATTERN)
        return F.when(text != "", F.when(is_city, F.lit(fv.CITY_LABEL)).otherwise(text))

    candidates = []
    for value in values:
        text = F.regexp_replace(value if cleaned else clean_location_text(value), "(?U)" + fv.POSTCODE_PATTERN, "")
        text = F.regexp_replace(text, _I + fv.COUNTRY_PATTERN, "")
        text = F.btrim(F.btrim(F.trim(F.regexp_replace(text, _SPACE_RUN, " ")), F.lit(",")))
        candidates.append(_once(text, label))
    return F.coalesce(*candidates, F.lit(fv.UNKNOWN))
