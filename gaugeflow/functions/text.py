"""Text helpers: HTML cell text, the estimated tag and numeric parsing."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.constants import ESTIMATED_CODE, ESTIMATED_TAG, NA_TEXTS, NO_CODE

# Python's Unicode \w and \s, written for Java regex (Java's own \w and \s
# are ASCII unless (?U) is set, and even then differ on marks and \x1c-\x1f).
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"

_ESTIMATED_RE = r"\*\*Estimated"
# Shape Python's float() accepts for plain decimal text.
_DIGITS = r"\d(?:_?\d)*"
_NUMBER_RE = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_SPECIAL_RE = r"(?i)^[+-]?(?:nan|inf|infinity)$"
# Plain decimal text, optionally tagged: parsed without the slow path.
_PLAIN_NUMBER_RE = r"^-?\d+(?:\.\d+)?(?:\*\*Estimated)?$"
# Thousands separators between digit groups.
_THOUSANDS_RE = r"(?<=\d),(?=\d{3}(?:\D|$))"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: drop Unicode whitespace at both ends."""
    return F.regexp_replace(_c(col), rf"^{SPACE}+|{SPACE}+$", "")


# Numeric references to 128-159 mean the characters of this code page, and the
# references that no character follows from are the replacement character.
_C1_PAGE = "cp1252"
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{1,31};?)"


def _json_map(mapping: dict) -> Column:
    """A constant map column (folded into the plan once)."""
    return F.from_json(F.lit(json.dumps(mapping)), "map<string,string>")


# Names that may be written without a semicolon, and their longest one.
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE_LENGTH = max(map(len, _BARE))


def _c1() -> Column:
    return _json_map({str(i): bytes([i]).decode(_C1_PAGE, errors="ignore") or chr(i) for i in range(128, 160)})


def _numeric_reference(ref: Column) -> Column:
    """The character of ``&#...``: code points past the last one, surrogates and
    zero are the replacement character, control characters nothing."""
    digits = F.regexp_replace(ref, r"[&#;xX]", "")
    hexadecimal = F.lower(F.substring(ref, 3, 1)) == "x"
    digits = F.regexp_replace(digits, "^0+(?=.)", "")
    short = F.length(digits) <= 10
    n = F.when(short, F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")).otherwise(F.lit(1 << 40))
    bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    none = (n.between(1, 31) & ~n.isin(9, 10, 12, 13)) | (n == 127) | n.between(0xFDD0, 0xFDEF) | ((n % 65536) >= 65534) | (n == 11)
    # the code point as UTF-32, the one encoding that needs no arithmetic
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when(bad, F.lit("\ufffd")).when(n == 13, F.lit("\r"))
            .when(n.between(128, 159), F.element_at(_c1(), n.cast("string")))
            .when(none, F.lit("")).otherwise(char))


def _named_reference(ref: Column) -> Column:
    """The characters of ``&name;``; a known name may be cut short of its
    semicolon, with or without text after it (the longest one counts)."""
    name = F.substring(ref, 2, 64)
    sizes = F.sequence(F.greatest(F.least(F.length(name), F.lit(_BARE_LENGTH)), F.lit(2)), F.lit(2), F.lit(-1))
    tried = F.transform(sizes, lambda n: F.concat(F.try_element_at(_json_map(_BARE), F.left(name, n)), F.substr(name, n + 1)))
    cut_short = F.get(F.filter(tried, lambda t: t.isNotNull()), 0)
    return F.coalesce(F.try_element_at(_json_map(html5), name), cut_short, ref)


def html_unescape(col) -> Column:
    """Every named and numeric character reference decoded, in one pass (what a
    reference decodes to is not looked at again)."""
    src = _c(col)
    refs = F.transform(F.regexp_extract_all(src, F.lit(_REFERENCE), 0),
                       lambda r: F.when(F.substring(r, 2, 1) == "#", _numeric_reference(r)).otherwise(_named_reference(r)))
    whole = F.array_join(F.zip_with(F.split(src, _REFERENCE), refs, lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))), "")
    return F.when(F.instr(src, "&") > 0, whole).otherwise(src)


def html_text(col) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded."""
    src = _c(col)
    full = html_unescape(F.regexp_replace(src, r"<[^>]*>", ""))
    return F.when((F.instr(src, "<") > 0) | (F.instr(src, "&") > 0), full).otherwise(src)


# Words of visible ASCII characters, but < and &, with single spaces between them.
_ASCII_CELL_RE = r"\A(?:[!-%'-;=-~]++(?: [!-%'-;=-~]++)*+)?+\z"
_PLAIN_CELL_RE = rf"[<&\r\n]|^{SPACE}|{SPACE}$|{SPACE}{{2}}"


def cell_text(col) -> Column:
    """Text of a table cell as an HTML table reader returns it: tags removed,
    entities decoded, stripped, runs of newlines or of two or more spaces
    collapsed to one space. Cells without markup or odd whitespace (the
    common case) are returned as they are after one cheap check."""
    c = _c(col)
    full = F.regexp_replace(py_strip(html_text(c)), rf"[\r\n]+|{SPACE}{{2,}}", " ")
    return F.when(c.rlike(_ASCII_CELL_RE), c).when(c.rlike(_PLAIN_CELL_RE), full).otherwise(c)


def is_estimated(col) -> Column:
    """True where the cell carries the estimated tag; a null cell is not."""
    return F.coalesce(F.contains(_c(col), F.lit(ESTIMATED_TAG)), F.lit(False))


def estimated_code(cells) -> Column:
    """Row code: '21' if *any* data cell of the row is tagged, else ''.

    ``cells`` is an array column of the row's data cells; the code is shared
    by every stream of the row.
    """
    return F.when(F.exists(_c(cells), is_estimated), F.lit(ESTIMATED_CODE)).otherwise(F.lit(NO_CODE))


def numeric_value(col) -> Column:
    """Parse a data cell to ``struct(value double, error string)``.

    Missing-value texts give a null value; the tag and thousands separators
    are removed; text Python's ``float()`` would reject gives an error message
    (the caller rejects the page) instead of a silently wrong number.
    """
    raw = _c(col)
    plain = raw.rlike(_PLAIN_NUMBER_RE)
    text = py_strip(F.regexp_replace(raw, _ESTIMATED_RE, ""))
    text = F.regexp_replace(text, _THOUSANDS_RE, "")
    is_missing = raw.isNull() | py_strip(raw).isin(NA_TEXTS)
    special = F.lower(F.regexp_replace(text, r"^\+", ""))
    special_value = (
        F.when(special.endswith("nan"), F.lit(float("nan")))
        .when(special.startswith("-"), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf")))
    )
    value = (
        F.when(is_missing, F.lit(None).cast("double"))
        .when(text.rlike(_NUMBER_RE), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        .when(text.rlike(_SPECIAL_RE), special_value)
    )
    error = F.when(
        ~is_missing & ~text.rlike(_NUMBER_RE) & ~text.rlike(_SPECIAL_RE),
        F.concat(F.lit("could not convert string to float: '"), text, F.lit("'")),
    )
    none = F.lit(None).cast("string")
    plain_value = F.replace(raw, F.lit(ESTIMATED_TAG), F.lit("")).try_cast("double")
    return (
        F.when(plain, F.struct(plain_value.alias("value"), none.alias("error")))
        .when(raw == "", F.struct(F.lit(None).cast("double").alias("value"), none.alias("error")))
        .otherwise(F.struct(value.alias("value"), error.alias("error")))
    )
