"""Scalar Column helpers. Everything here is a built-in expression (JVM side,
whole-stage codegen); nothing calls back into Python per row."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (API_NAMES, CONVERTED_STATUS, EMAIL_PATTERN, ERROR_LABELS, STATUS_ORDER,
                         STATUS_OTHER_RANK, WHITE_SPACE)

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- time --------------
def as_of_lit(as_of) -> Column:
    """The query clock. ``None`` = ``current_timestamp()``; else a literal."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(str(as_of)))


def days_before(as_of, days: int) -> Column:
    return as_of_lit(as_of) - F.make_dt_interval(F.lit(days))


def sunday_week(ts: ColumnOrName) -> Column:
    """Start of the Sunday-based week containing ``ts`` as a DATE."""
    d = F.to_date(_c(ts))
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(ts: ColumnOrName) -> Column:
    return F.trunc(F.to_date(_c(ts)), "month")


# ---------------------------------------------------------------- arithmetic --------
def round_half_up(x: ColumnOrName, digits: int) -> Column:
    """Decimal rounding, half away from zero, of a DOUBLE; returns DOUBLE.

    Rounding goes through DECIMAL(38,10) so that a value printed as x.xx5 rounds up
    whatever its binary form is."""
    return F.round(_c(x).cast("decimal(38,10)"), digits).cast("double")


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    return round_half_up(safe_div(num, den) * F.lit(100), digits)


def is_converted(status: ColumnOrName = "lead_status") -> Column:
    return _c(status) == F.lit(CONVERTED_STATUS)


def converted_count(status: ColumnOrName = "lead_status") -> Column:
    return F.count_if(is_converted(status))


def conversion_rate(status: ColumnOrName = "lead_status", digits: int = 2) -> Column:
    return pct(converted_count(status), F.count(F.lit(1)), digits)


def status_rank(status: ColumnOrName = "lead_status") -> Column:
    expr = None
    for name, rank in STATUS_ORDER:
        cond = _c(status) == F.lit(name)
        expr = F.when(cond, F.lit(rank)) if expr is None else expr.when(cond, F.lit(rank))
    return expr.otherwise(F.lit(STATUS_OTHER_RANK))


# ---------------------------------------------------------------- text --------------
def unicode_trim(x: ColumnOrName) -> Column:
    """Strip leading and trailing Unicode white space (plain ``trim`` strips only the
    ASCII space): a character-set trim, cheaper than a regular expression."""
    return F.trim(_c(x), F.lit(WHITE_SPACE))


def clean_text(x: ColumnOrName) -> Column:
    """Trim Unicode white space; empty becomes NULL."""
    return F.nullif(unicode_trim(x), F.lit(""))


def email_ok(x: ColumnOrName) -> Column:
    return F.coalesce(_c(x).rlike(EMAIL_PATTERN), F.lit(False))


# ---------------------------------------------------------------- JSON --------------
def json_value(doc: ColumnOrName, name: str) -> Column:
    """Scalar member ``name`` as text; NULL for JSON null, objects and arrays.

    API-shaped records nest the fields under ``properties``; both paths are read."""
    out = None
    for path in (f"$.{name}", f"$.properties.{name}"):
        v = F.get_json_object(_c(doc), path)
        v = F.when(~(v.startswith("{") | v.startswith("[")), v)
        out = v if out is None else F.coalesce(out, v)
    return out


def with_json_fields(df, doc: str, names: list[str], out: str = "_j"):
    """Parse the JSON text ``doc`` ONCE per row into a struct of string members ``out``
    (the optimizer keeps one parse even when several members are used). A record is flat
    (a CSV row) or an API contact, whose members stand under ``properties``: both are
    parsed."""
    flat = ", ".join(f"`{n}` string" for n in dict.fromkeys([*names, "id"]))
    nested = ", ".join(f"`{API_NAMES.get(n, n)}`: string" for n in names)
    return df.withColumn(out, F.from_json(F.col(doc), f"{flat}, properties struct<{nested}>"))


def jfield(name: str, out: str = "_j") -> Column:
    """Member of a ``with_json_fields`` struct with JSON_VALUE semantics: scalar text, NULL
    for JSON null, objects and arrays. The flat member counts first, then that of the API
    record."""
    api = "id" if name == "contact_id" else f"properties.{API_NAMES.get(name, name)}"
    both = [F.col(f"{out}.{p}") for p in (name, api)]
    return F.coalesce(*[F.when(~(v.startswith("{") | v.startswith("[")), v) for v in both])


def error_label(error_type: ColumnOrName = "error_type", labels: dict | None = None) -> Column:
    """Map produced error types onto the labels the error reports count."""
    labels = ERROR_LABELS if labels is None else labels
    expr = None
    for k, v in labels.items():
        cond = _c(error_type) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return _c(error_type) if expr is None else expr.otherwise(_c(error_type))


# ---------------------------------------------------------------- parsing -----------
# A timestamp text is accepted in ISO form with a 'T', whole seconds and up to six
# fraction digits, optionally followed by an offset; 'Z' and a trailing ' +0000' are
# read as +00:00 first. Anything else is NULL, never an error.
TS_PATTERN = (r"^(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)"
              r"(?:([+-])(\d{2}):(\d{2}))?$")


def normalise_ts_text(x: ColumnOrName) -> Column:
    s = F.regexp_replace(F.trim(_c(x)), "Z", "+00:00")
    return F.when(s.endswith(" +0000"), F.regexp_replace(s, " \\+0000", "+00:00")).otherwise(s)


def parse_ts(x: ColumnOrName) -> Column:
    """V8: text → UTC TIMESTAMP, NULL when blank, without 'T' or unparsable."""
    s = normalise_ts_text(x)
    ok = F.coalesce(s.rlike(TS_PATTERN) & F.trim(_c(x)).contains("T"), F.lit(False))
    local = F.try_to_timestamp(
        F.concat(F.regexp_extract(s, TS_PATTERN, 1), F.lit(" "),
                 F.regexp_extract(s, TS_PATTERN, 2)))
    sign = F.when(F.regexp_extract(s, TS_PATTERN, 3) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.coalesce(F.regexp_extract(s, TS_PATTERN, 4).try_cast("int"), F.lit(0))
    mm = F.coalesce(F.regexp_extract(s, TS_PATTERN, 5).try_cast("int"), F.lit(0))
    offset = F.make_dt_interval(F.lit(0), F.lit(0), sign * (hh * 60 + mm))
    return F.when(ok, local - offset)


INT_PATTERN = r"^[+-]?[0-9]+(_[0-9]+)*$"


def int_text_ok(x: ColumnOrName) -> Column:
    """Integer text in the sense of Python ``int()``: sign, digits, single
    underscores between digits, surrounding white space; '' counts as absent. A number
    beyond BIGINT is no integer here: it would be lost as NULL."""
    t = unicode_trim(x)
    fits = F.regexp_replace(t, "_", "").try_cast("bigint").isNotNull()
    return _c(x).isNull() | (_c(x) == "") | F.coalesce(t.rlike(INT_PATTERN) & fits, F.lit(False))


def parse_int(x: ColumnOrName, ok: Column | None = None) -> Column:
    """``ok``: ``int_text_ok(x)``, where a column holds it already."""
    t = F.regexp_replace(unicode_trim(x), "_", "")
    return F.when((int_text_ok(x) if ok is None else ok) & (_c(x) != ""), t.try_cast("bigint"))
