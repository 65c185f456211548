"""String cleaning expressions (F-01, F-02, F-04, F-06, F-07, F-08, S-01..S-06).

All are Column -> Column built-ins: they stay inside whole-stage codegen, no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() / str.split() whitespace: ASCII whitespace, the
# information separators 0x1c-0x1f, NEL and the Unicode space separators.
PY_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"

# Fixed value of the reference: UUID versions 1-5, RFC 4122 variant.
UUID_PATTERN = (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-"
                r"[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: also strips tabs, newlines and Unicode spaces."""
    return F.regexp_replace(_c(c), f"^{PY_SPACE}+|{PY_SPACE}+$", "")


def collapse_spaces(c) -> Column:
    """``re.sub(r'\\s+', ' ', x)``."""
    return F.regexp_replace(_c(c), f"{PY_SPACE}+", " ")


def _titlecase_char(ch: Column) -> Column:
    """Titlecase of one character: upper case, except letters whose titlecase
    differs (Python turns a leading 'ß' into 'Ss', upper() gives 'SS')."""
    return F.when(ch == "ß", F.lit("Ss")).otherwise(F.upper(ch))


def py_title(c) -> Column:
    """Python ``str.title()`` (F-08): a word starts after any non-letter.

    ``initcap`` only starts words after spaces (``O'neil``); this splits the
    text into letter runs and non-letter runs and capitalises each run, so
    ``o'neil 3rd`` becomes ``O'Neil 3Rd`` as in Python.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda x: F.concat(_titlecase_char(F.left(x, F.lit(1))),
                                             F.lower(F.substring(x, 2, 1 << 30)))),
        "")


def py_capitalize(c) -> Column:
    """Python ``str.capitalize()``: first character upper, the rest lower."""
    c = _c(c)
    return F.concat(_titlecase_char(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1 << 30)))


# Fixed values of the reference: the case rules.
CASE_RULES = ("UPPER", "LOWER", "TITLE", "CAPITALIZE", "STRIP", "SENTENCE")


def case_rule(c, rule: str) -> Column | None:
    """One case rule (F-06); an unknown rule returns None (column unchanged)."""
    rule = rule.upper()
    c = _c(c)
    if rule == "UPPER":
        return F.upper(c)
    if rule == "LOWER":
        return F.lower(c)
    if rule == "TITLE":
        return py_title(c)
    if rule in ("CAPITALIZE", "SENTENCE"):
        return py_capitalize(c)
    if rule == "STRIP":
        return py_strip(c)
    return None


def trim_title(c) -> Column:
    """Trim, collapse whitespace runs to one space, title-case (F-07)."""
    return py_title(collapse_spaces(py_strip(c)))


def null_if_blank_or_nul(c) -> Column:
    """A string that contains NUL or is blank after strip becomes NULL (F-02)."""
    c = _c(c)
    return F.when(c.contains("\u0000") | (py_strip(c) == ""), F.lit(None).cast("string")).otherwise(c)


def empty_to_null(c) -> Column:
    """Empty string -> NULL (F-04)."""
    return F.nullif(_c(c), F.lit(""))


def uuid_upper(c) -> Column:
    """Strip; a UUID (versions 1-5) is returned in upper case (F-01)."""
    s = py_strip(c)
    return F.when(s.rlike(UUID_PATTERN), F.upper(s)).otherwise(s)


def tsql_concat(*cols) -> Column:
    """T-SQL ``CONCAT``: NULL counts as '' (S-02)."""
    return F.concat(*[F.coalesce(_c(x).cast("string"), F.lit("")) for x in cols])


def text_before(c, marker: str, *, whole_if_absent: bool) -> Column:
    """Text before ``marker`` (D-08).

    PostgreSQL form (``whole_if_absent=True``): the whole text if the marker is
    absent.  T-SQL ``LEFT(x, PATINDEX(...))`` form: empty string if absent.
    NULL stays NULL in both.
    """
    c = _c(c)
    pos = F.instr(c, marker)
    found = F.substring(c, F.lit(1), pos - 1)
    return F.when(pos > 0, found).when(c.isNotNull(), c if whole_if_absent else F.lit(""))
