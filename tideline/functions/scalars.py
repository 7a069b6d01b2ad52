"""Scalar functions of the SQL dialect that Spark spells differently or lacks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def truncate(x, digits: int = 0) -> Column:
    """TRUNCATE(x, n): cut digits towards zero."""
    scaled = _col(x) * F.lit(10.0) ** digits
    cut = F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled))
    return cut / F.lit(10.0) ** digits


def between_symmetric(x, a, b) -> Column:
    return _col(x).between(F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b)))


def convert_using(text, charset: str) -> Column:
    """CONVERT(text USING charset); a character the charset lacks is an error."""
    return F.decode(F.encode(_col(text), charset), charset)


def similar_regex(pattern: str, escape: str | None = None) -> str:
    """A SIMILAR TO pattern as a Java regular expression that must match the whole text."""
    out, i, in_set = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if escape and ch == escape and i + 1 < len(pattern):
            i += 1
            out.append("\\" + pattern[i])
        elif in_set:
            in_set = ch != "]"
            out.append(ch)
        elif ch == "[":
            in_set = True
            out.append(ch)
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch in ".^$\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
        i += 1
    return "(?s)^(?:" + "".join(out) + ")$"


def similar_to(text, pattern: str, escape: str | None = None) -> Column:
    return _col(text).rlike(similar_regex(pattern, escape))


# fixed values: sub-second and calendar units EXTRACT knows beyond Spark's own, as SQL over {t}
EXTRA_UNITS = {
    "NANOSECOND": "CAST(extract(SECOND FROM {t}) * 1000000000 AS BIGINT)",
    "MICROSECOND": "CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT)",
    "MILLISECOND": "CAST(floor(extract(SECOND FROM {t}) * 1000) AS BIGINT)",
    "DECADE": "CAST(floor(year({t}) / 10) AS BIGINT)",
    "CENTURY": "CAST(floor((year({t}) + 99) / 100) AS BIGINT)",
    "MILLENNIUM": "CAST(floor((year({t}) + 999) / 1000) AS BIGINT)",
    "ISODOW": "CAST(weekday({t}) + 1 AS BIGINT)",
    "ISOYEAR": "CAST(extract(YEAROFWEEK FROM {t}) AS BIGINT)",
    "EPOCH": "CAST(unix_seconds(CAST({t} AS TIMESTAMP)) AS BIGINT)",
}


def extract(unit: str, time: str) -> Column:
    """EXTRACT(unit FROM time) as a whole number; DOW counts from Sunday = 1."""
    unit = unit.upper()
    text = EXTRA_UNITS.get(unit, f"CAST(floor(extract({unit} FROM {{t}})) AS BIGINT)")
    return F.expr(text.format(t=time))


def floor_time(time: str, unit: str) -> Column:
    return F.expr(f"date_trunc('{unit}', {time})")


def ceil_time(time: str, unit: str) -> Column:
    """CEIL(time TO unit): the time itself where it is a whole unit, else the next one."""
    down = f"date_trunc('{unit}', {time})"
    return F.expr(f"CASE WHEN {down} = {time} THEN {time} ELSE {down} + INTERVAL 1 {unit} END")
