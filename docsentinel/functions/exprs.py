"""Scalar expressions shared by the staging and analytic plans.

All helpers return ``pyspark.sql.Column`` built from built-in functions, so they
stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Decode rules that must equal the source project's CASE arms.
# Order matters: the first matching arm wins.
# ---------------------------------------------------------------------------

# (substring of lower(trim(identifier)), control_name)
CONTROL_NAME_RULES = (
    ("alternatefamilynameconsistency", "alternate_family_name_consistency"),
    ("alternatefamilynamedetection", "alternate_family_name_detection"),
    ("familynameaccountholdersearch", "family_name_account_holder_search"),
    ("familynameconsistency", "family_name_consistency"),
    ("familynamesearch", "family_name_search"),
    ("addresslocalityconsistency", "address_locality_consistency"),
    ("addressconsistency", "address_consistency"),
    ("birthdatemrzconsistency", "birthdate_mrz_consistency"),
    ("personalidconsistency", "personal_id_consistency"),
    ("bicibanconsistency", "bic_iban_consistency"),
    ("datevalidation", "date_validation"),
)

# (substring of lower(trim(identifier)), control_subject)
CONTROL_SUBJECT_RULES = (
    ("document", "document"),
    ("applicant", "applicant"),
)

# Subtypes whose issuing country is the last three characters (LIKE patterns).
COUNTRY_SUFFIX_PATTERNS = (
    "%ADDRESS_PROOF%",
    "%BANK_ACCOUNT_DETAILS%",
    "%BANK_ACCOUNT_STATEMENT%",
    "%INCOME_TAX_DECLARATION_STATEMENT%",
    "%INCOME_TAX_STATEMENT%",
    "%PAYSLIP%",
    "%VEHICLE_INSURANCE_INFORMATION_STATEMENT%",
    "%VEHICLE_REGISTRATION_CERTIFICATE%",
)
# Subtypes that carry an issue year as their last four characters.
YEAR_PATTERNS = ("%RESIDENCE_PERMIT%", "%PASSPORT%", "%ID_CARD%", "%DRIVING_LICENSE%")
UNKNOWN_COUNTRY_PATTERN = "%XYZ%"
UNKNOWN_COUNTRY = "XYZ"
# ---------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    """Backquoted SQL identifier (a possibly dotted column name stays one name)."""
    return "`" + name.replace("`", "``") + "`"


def _lit_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case_sql(arms: Sequence[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in arms) + " END"


def lower_trim(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_col(c)))


# -- percentages -------------------------------------------------------------


def pct(numerator: ColumnOrName, denominator: ColumnOrName, precision: int = 2) -> Column:
    """``round(100.0 * n / greatest(d, 1), precision)``, exact, half away from zero.

    Worked in integer units of ``10^-precision`` percent:
    ``units = (2 * 10^(precision+2) * |n| + d) div (2 * d)``, so the result is
    exact for any count instead of depending on the scale a decimal division
    keeps. ``greatest`` skips NULLs (a NULL denominator acts as 1); a NULL
    numerator gives NULL. Returns ``decimal(38, precision)``.
    """
    if isinstance(numerator, str) and isinstance(denominator, str):
        n, d = f"CAST({_q(numerator)} AS BIGINT)", f"greatest(CAST({_q(denominator)} AS BIGINT), 1L)"
        num, den = f"(abs({n}) * {2 * 10 ** (precision + 2)}L + {d})", f"({d} * 2L)"
        units = f"CAST(CAST({num} - {num} % {den} AS DECIMAL(38,0)) / CAST({den} AS DECIMAL(38,0)) AS DECIMAL(38,0))"
        return F.expr(
            f"CAST(CASE WHEN {n} < 0 THEN -{units} ELSE {units} END / {10 ** precision} AS DECIMAL(38,{precision}))"
        )
    n = _col(numerator).cast("long")
    d = F.greatest(_col(denominator).cast("long"), F.lit(1).cast("long"))
    num = F.abs(n) * F.lit(2 * 10 ** (precision + 2)) + d
    den = d * F.lit(2)
    # (num - num % den) is an exact multiple of den: the decimal quotient is exact.
    units = ((num - num % den).cast("decimal(38,0)") / den.cast("decimal(38,0)")).cast("decimal(38,0)")
    signed = F.when(n < 0, -units).otherwise(units)
    return (signed / F.lit(10**precision)).cast(f"decimal(38,{precision})")


def status_rank(status: ColumnOrName = "control_status") -> Column:
    """Display order of a status: OK=1, KO=2, NA=3, NULL=4, anything else=5."""
    s = _col(status)
    return (
        F.when(s == "OK", 1).when(s == "KO", 2).when(s == "NA", 3).when(s.isNull(), 4).otherwise(5)
    )


# -- keys, text and JSON ---------------------------------------------------------


def surrogate_key(*parts: ColumnOrName, null_as_empty: bool = True) -> Column:
    """MD5 hex of the parts joined by ``'|'``.

    ``null_as_empty=True`` mirrors ``coalesce(part, '')`` around each part;
    ``False`` mirrors plain ``||``, where one NULL part makes the key NULL.
    (``concat_ws`` is not used: it silently drops NULL parts.)
    """
    if all(isinstance(p, str) for p in parts):
        items = [f"CAST({_q(p)} AS STRING)" for p in parts]
        if null_as_empty:
            items = [f"coalesce({i}, '')" for i in items]
        return F.expr("md5(concat(" + ", '|', ".join(items) + "))")
    cols = [_col(p).cast("string") for p in parts]
    if null_as_empty:
        cols = [F.coalesce(c, F.lit("")) for c in cols]
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(c)
    return F.md5(F.concat(*pieces))


def json_first(json_text: ColumnOrName, fields: Sequence[str]) -> Column:
    """Struct of ``fields`` read from the first element of a JSON array.

    Same result as ``col #>> '{0, field}'`` per field: a missing key, JSON null,
    an empty array, a non-array document or malformed text give NULL, and a
    nested value comes back as compact JSON text. The text is parsed once, element 0
    again for its fields.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    # As an array of texts: anything that is no valid array is NULL, and elements may be of any type.
    # The text is named twice, so that Catalyst does not move an expression that makes it into
    # ``from_json``, whose arguments are computed without generated code.
    text = _col(json_text)
    elements = F.when(text.isNotNull(), F.from_json(text, T.ArrayType(T.StringType())))
    return F.from_json(F.get(elements, 0), schema)


def to_json_keep_nulls(struct_col: Column) -> Column:
    """JSON object text that keeps NULL members (``jsonb_build_object`` does)."""
    return F.to_json(struct_col, {"ignoreNullFields": "false"})


def _first_substring(identifier: str, rules: Sequence[tuple[str, str]]) -> Column:
    q = _q(identifier)
    return F.expr(_case_sql([(f"contains({q}, {_lit_sql(part)})", _lit_sql(value)) for part, value in rules]))


def control_subject(identifier: str) -> Column:
    """Subject from a lower-cased identifier column; first listed substring wins."""
    return _first_substring(identifier, CONTROL_SUBJECT_RULES)


def control_name(identifier: str) -> Column:
    """Control name from a lower-cased identifier column; first listed substring wins."""
    return _first_substring(identifier, CONTROL_NAME_RULES)


def _like(q: str, pattern: str) -> str:
    """``q LIKE pattern``, its regular expression run only on texts that contain the pattern's longest plain part."""
    plain = max(re.split("[%_]", pattern), key=len)
    return f"(contains({q}, {_lit_sql(plain)}) AND {q} LIKE {_lit_sql(pattern)})"


def issuing_country(subtype: str) -> Column:
    """Issuing country decoded from the raw (case-sensitive) document subtype column.

    First matching arm wins; ``_`` inside a LIKE pattern is a wildcard.
    """
    q = _q(subtype)

    def like(p):
        return _like(q, p)

    no_xyz, dl = f"NOT {like(UNKNOWN_COUNTRY_PATTERN)}", like("%DRIVING_LICENSE%")
    return F.expr(_case_sql([
        ("(" + " OR ".join(like(p) for p in COUNTRY_SUFFIX_PATTERNS) + ")", f"right({q}, 3)"),
        (f"{dl} AND {like('%CARD%')}", f"left(right({q}, 13), 3)"),
        (f"{dl} AND {like('%PAPER%')}", f"left(right({q}, 14), 3)"),
        (f"{like('%DRIVING_LICENSE_%')} AND {no_xyz}", f"left(right({q}, 8), 3)"),
        (like(UNKNOWN_COUNTRY_PATTERN), _lit_sql(UNKNOWN_COUNTRY)),
        (like("%ID_CARD%"), f"left(right({q}, 8), 3)"),
        (f"{like('%PASSPORT%')} AND {no_xyz}", f"left(right({q}, 8), 3)"),
        (f"{like('%RESIDENCE_PERMIT%')} AND {no_xyz}", f"left(right({q}, 8), 3)"),
    ]))


def issue_year(subtype: str) -> Column:
    """Issue year: last four characters of an identity-document subtype column."""
    q = _q(subtype)
    identity = " OR ".join(_like(q, p) for p in YEAR_PATTERNS)
    return F.expr(f"CASE WHEN ({identity}) AND NOT {_like(q, UNKNOWN_COUNTRY_PATTERN)} THEN right({q}, 4) END")


# -- dates -----------------------------------------------------------------------


def ts_ntz(value: dt.datetime | dt.date) -> Column:
    """A wall-clock ``TIMESTAMP_NTZ`` literal.

    ``F.lit(datetime)`` would go through the Python process's local time zone
    and the comparison with an NTZ column through the session's; a literal
    written as text involves neither, and still reaches the parquet scan as a
    pushed filter.
    """
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def lookback(ts: ColumnOrName, as_of: dt.date, days: int) -> Column:
    """``ts::date >= as_of - days`` with no upper bound.

    Written as ``ts >= <midnight literal>`` on the bare column, which is the
    same predicate for timestamps and lets the parquet scan push it down.
    """
    return _col(ts) >= ts_ntz(as_of - dt.timedelta(days=days))


def month_start(ts: ColumnOrName) -> Column:
    """``date_trunc('month', ts)::date``."""
    return F.trunc(_col(ts).cast("date"), "MM")


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """``later - earlier`` on dates, as an integer number of days."""
    return F.datediff(_col(later), _col(earlier))


# -- status aggregates -------------------------------------------------------------


def status_flags(status: ColumnOrName = "control_status") -> list[Column]:
    """Per-row 0/1 flags ``is_ok, is_ko, is_na, is_null`` for two-phase counting."""
    if isinstance(status, str):
        q = _q(status)
        return [F.expr(f"CASE WHEN {q} = 'OK' THEN 1 ELSE 0 END AS is_ok"),
                F.expr(f"CASE WHEN {q} = 'KO' THEN 1 ELSE 0 END AS is_ko"),
                F.expr(f"CASE WHEN {q} = 'NA' THEN 1 ELSE 0 END AS is_na"),
                F.expr(f"CASE WHEN {q} IS NULL THEN 1 ELSE 0 END AS is_null")]
    s = _col(status)
    return [
        F.when(s == "OK", 1).otherwise(0).alias("is_ok"),
        F.when(s == "KO", 1).otherwise(0).alias("is_ko"),
        F.when(s == "NA", 1).otherwise(0).alias("is_na"),
        F.when(s.isNull(), 1).otherwise(0).alias("is_null"),
    ]


def status_counts(document_id: ColumnOrName = "document_id", status: ColumnOrName = "control_status",
                  prefix: str = "") -> list[Column]:
    """Distinct-document counts overall and per status (one-phase form).

    ``count_document, count_ok, count_ko, count_na, count_null``; the heavy
    plans use the two-phase form in ``operators.status`` instead.
    """
    d, s = _col(document_id), _col(status)
    return [
        F.count_distinct(d).alias(f"{prefix}count_document"),
        F.count_distinct(F.when(s == "OK", d)).alias(f"{prefix}count_ok"),
        F.count_distinct(F.when(s == "KO", d)).alias(f"{prefix}count_ko"),
        F.count_distinct(F.when(s == "NA", d)).alias(f"{prefix}count_na"),
        F.count_distinct(F.when(s.isNull(), d)).alias(f"{prefix}count_null"),
    ]


def status_percentages(total: str = "count_document", prefix: str = "") -> list[Column]:
    """``perc_ok, perc_ko, perc_na, perc_null`` of ``{prefix}count_*`` over ``{prefix}{total}``."""
    return [pct(f"{prefix}count_{k}", f"{prefix}{total}").alias(f"{prefix}perc_{k}") for k in ("ok", "ko", "na", "null")]
