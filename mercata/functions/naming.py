"""Identifier cleaning for landed files, sheets and header cells.

The rule is applied to table names (file stem, sheet name) and to sheet column
names.  Two forms exist: a driver-side one for names (a handful of strings per
file) and a Column form that runs inside whole-stage codegen over data.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the naming rule (must equal the source warehouse's rule):
#   1. strip surrounding whitespace (Python ``str.strip`` semantics)
#   2. lower-case
#   3. " " -> "_", "-" -> "_", "(" -> "", ")" -> ""
_REPLACED = " -"
_REPLACEMENT = "__"
_REMOVED = "()"

# Whitespace as Python's str.strip sees it, derived from the rule (isspace).
_WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
WHITESPACE_CLASS = "".join(f"\\x{{{ord(ch):04X}}}" for ch in _WHITESPACE)
# Java and RE2 both read \x{HHHH}; the same pattern is used by the SQL oracle.
STRIP_PATTERN = f"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$"

_TABLE = str.maketrans(_REPLACED, _REPLACEMENT, _REMOVED)


def clean_name(name: str) -> str:
    """Driver-side form for file, sheet and column names."""
    return name.strip().lower().translate(_TABLE)


def clean_name_col(col: Column | str) -> Column:
    """Same rule as a Column expression (no Python in the hot path)."""
    c = F.col(col) if isinstance(col, str) else col
    stripped = F.regexp_replace(c, STRIP_PATTERN, "")
    return F.translate(F.lower(stripped), _REPLACED + _REMOVED, _REPLACEMENT)


def clean_names(names: list[str], what: str = "column") -> list[str]:
    """Clean a list of names; two inputs that clean to one name are an error."""
    out = [clean_name(str(n)) for n in names]
    seen: dict[str, str] = {}
    for raw, cleaned in zip(names, out):
        if cleaned in seen:
            raise ValueError(
                f"{what} names {seen[cleaned]!r} and {raw!r} both clean to {cleaned!r}"
            )
        seen[cleaned] = raw
    return out
