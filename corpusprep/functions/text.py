"""Transcript string functions, all native column expressions (whole-stage codegen).

Each has a DuckDB twin (``sql_*``) with the same result, used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers used in transcripts.
NOSPEECH = "<|nospeech|>"
NOCAPTIONS = "<|nocaptions|>"

# White space in the Unicode sense, spelled out so Java and RE2 agree (their \s are ASCII and differ on \x0B).
WS_CLASS = "\\t\\n\\x0B\\f\\r \\x1C-\\x1F\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
WS = f"[{WS_CLASS}]"

# Evaluation normaliser rules (basic text standardisation).
BRACKETED = "[<\\[][^>\\]]*[>\\]]"  # <...> or [...] spans
PARENTHESISED = "\\(([^)]+?)\\)"  # (...) spans
MARKS_SYMBOLS_PUNCT = "[\\p{M}\\p{S}\\p{P}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_target(text, lower: bool = True) -> Column:
    """Newline to blank, then lower case if asked."""
    t = F.regexp_replace(_c(text), "\n", " ")
    return F.lower(t) if lower else t


def normalise(text) -> Column:
    """Lower; drop bracketed and parenthesised spans; marks, symbols, punctuation to blank; collapse blanks."""
    t = F.lower(_c(text))
    t = F.regexp_replace(t, BRACKETED, "")
    t = F.regexp_replace(t, PARENTHESISED, "")
    # marks to blank and blanks collapsed in one pass
    return F.regexp_replace(t, f"[\\p{{M}}\\p{{S}}\\p{{P}}{WS_CLASS}]+", " ")


def strip(text) -> Column:
    """Remove leading and trailing white space."""
    return F.regexp_replace(_c(text), f"^{WS}+|{WS}+$", "")


def words(text) -> Column:
    """White-space separated words, empty pieces dropped."""
    return F.filter(F.split(_c(text), WS + "+"), lambda x: x != "")


def rename_marker(text, old: str = NOSPEECH, new: str = NOCAPTIONS) -> Column:
    """Whole-string rewrite of a marker (only exact equality)."""
    return F.when(_c(text) == old, F.lit(new)).otherwise(_c(text))


def null_to_empty(text) -> Column:
    return F.coalesce(_c(text), F.lit(""))


# --- DuckDB twins ---------------------------------------------------------------------

def sql_clean_target(t: str, lower: bool = True) -> str:
    s = f"replace({t}, chr(10), ' ')"
    return f"lower({s})" if lower else s


def sql_normalise(t: str) -> str:
    s = f"lower({t})"
    s = f"regexp_replace({s}, '{BRACKETED}', '', 'g')"
    s = f"regexp_replace({s}, '{PARENTHESISED}', '', 'g')"
    s = f"regexp_replace({s}, '{MARKS_SYMBOLS_PUNCT}', ' ', 'g')"
    return f"regexp_replace({s}, '{WS}+', ' ', 'g')"


def sql_strip(t: str) -> str:
    return f"regexp_replace({t}, '^{WS}+|{WS}+$', '', 'g')"


def sql_words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{WS}+'), lambda x: x <> '')"


def sql_rename_marker(t: str, old: str = NOSPEECH, new: str = NOCAPTIONS) -> str:
    return f"CASE WHEN {t} = '{old}' THEN '{new}' ELSE {t} END"
