"""Station identifiers derived from display names and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.constants import STATION_ID_PREFIX, UPPER_LOWER, WATER_WORDS
from gaugeflow.functions.text import SPACE, WORD, py_strip

_WATER = "|".join(WATER_WORDS)
_UL = "|".join(UPPER_LOWER)
_UL_RE = rf"^({WORD}+)({SPACE}?)({_UL})"
_URL_NAME_RE = rf"20Pages/({WORD}+)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def station_id(name) -> Column:
    """Dimension id from a sidebar station name.

    Upper-case; remove RIVER, LAKE, CREEK and every whitespace anywhere;
    then if the text starts with word characters followed by UPPER or LOWER,
    keep only ``U_``/``L_`` + those characters (the last such tag wins, text
    after it is dropped); prefix ``P_``. A tag that cannot be reached from
    the start leaves the name unchanged.
    """
    s = F.regexp_replace(F.upper(_c(name)), rf"({_WATER}|{SPACE})", "")
    tagged = F.concat(
        F.substring(F.regexp_extract(s, _UL_RE, 3), 1, 1),
        F.lit("_"),
        F.regexp_extract(s, _UL_RE, 1),
    )
    return F.concat(F.lit(STATION_ID_PREFIX), F.when(s.rlike(_UL_RE), tagged).otherwise(s))


def coord_station_id(name) -> Column:
    """Id used to match coordinates: a different rule from ``station_id``.

    Upper-case; remove RIVER, LAKE, CREEK; strip; ``U`` + space -> ``U_`` and
    ``L`` + space -> ``L_`` anywhere; remove remaining whitespace; prefix
    ``P_``.
    """
    s = F.regexp_replace(F.upper(_c(name)), rf"({_WATER})", "")
    s = py_strip(s)
    s = F.regexp_replace(s, rf"U{SPACE}", "U_")
    s = F.regexp_replace(s, rf"L{SPACE}", "L_")
    s = F.regexp_replace(s, SPACE, "")
    return F.concat(F.lit(STATION_ID_PREFIX), s)


def url_name(url) -> Column:
    """Station url name: the word after ``20Pages/`` in a link; null if none."""
    return F.nullif(F.regexp_extract(_c(url), _URL_NAME_RE, 1), F.lit(""))
