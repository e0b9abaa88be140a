"""Column helpers. All of them are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words and forms that mark a corrective change message.
CORRECTIVE_MESSAGE = (
    r"\b(fix(e[ds])?|fixup|bugfix|hotfix|bug(s)?|defect|patch|"
    r"error|fault|fail(ure|ed|s)?|issue|resolve[ds]?|resolving|"
    r"correct(ed|ion|s)?|repair(ed|s)?|workaround|revert)\b"
    r"|"
    r"\b(close[sd]?|fix(e[sd])?|resolve[sd]?)\s*#\d+"
)
BLANK_OR_COMMENT = r"^\s*(#.*)?$"
# White space as Python's str.split sees it.
_SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"
MESSAGE_HEAD_CHARS = 120

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back (numpy's rounding)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(value: Column) -> Column:
    """Text to double; anything that is not a plain number becomes missing.

    The pattern keeps out the Java-only forms (``1d``, ``1f``) that a cast accepts.
    """
    text = value.cast("string")
    return nan_to_null(F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double")))


def to_instant(value: Column) -> Column:
    """ISO-8601 text (with or without offset) to a UTC instant; junk becomes missing."""
    return value.try_cast("timestamp")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is missing, not an error, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def floor_at(value: Column, bound: float) -> Column:
    """Clip from below, keeping missing values missing."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(bound))))


def slashed(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def subsystem(path: Column) -> Column:
    """First path segment; a file at the root is its own subsystem."""
    return F.substring_index(slashed(path), "/", 1)


def directory(path: Column) -> Column:
    """Everything before the last slash; empty for a file at the root."""
    clean = slashed(path)
    inside = F.substring_index(clean, "/", -1)
    return F.rtrim(F.left(clean, F.length(clean) - F.length(inside)), F.lit("/"))


def is_python(path: Column) -> Column:
    return F.coalesce(F.endswith(path, F.lit(".py")), F.lit(False))


def first_filled(*values: Column, default: str) -> Column:
    """First value that is neither missing nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(default))


def author_key(email: Column, name: Column) -> Column:
    return first_filled(email, name, default="unknown")


def is_corrective(message: Column) -> Column:
    """Does the message announce a correction? Unicode-aware word boundaries, any case."""
    return F.coalesce(message, F.lit("")).rlike("(?iU)" + CORRECTIVE_MESSAGE)


def message_head(message: Column) -> Column:
    """Cut first, then collapse runs of white space."""
    head = F.substring(message, 1, MESSAGE_HEAD_CHARS)
    return F.trim(F.regexp_replace(head, "(?U)" + _SPACES, " "))


def is_meaningful_line(content: Column) -> Column:
    """Neither blank nor a comment. Only a line feed ends a line, spaces are Unicode's."""
    return ~F.coalesce(content, F.lit("")).rlike("(?dU)" + BLANK_OR_COMMENT)


def micros(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp"))


def days_between(earlier: Column, later: Column) -> Column:
    """Fractional days, never negative."""
    return F.greatest((micros(later) - micros(earlier)) / F.lit(86_400_000_000.0), F.lit(0.0))
