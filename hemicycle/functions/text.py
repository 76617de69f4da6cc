"""Column expressions over session text.

All patterns run with Unicode classes on, so that accented capitals and
non-breaking spaces behave as a reader expects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_WS = r"[\s\x1c-\x1f]"
_LINE_BREAK = r"\R|[\x1c-\x1e]"
_CUT = "\x00"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, rf"(?U)\A{_WS}+|{_WS}+\z", "")


def drop_boilerplate(text: Column) -> Column:
    for pattern in (K.IMPRINT_PATTERN, K.PAGE_PATTERN, K.ISSUE_PATTERN):
        text = F.regexp_replace(text, f"(?iuUd){pattern}", "")
    return text


def keep_mixed_case_lines(text: Column) -> Column:
    """Keep lines holding at least one ASCII lower-case letter (a bold marker counts)."""
    return F.array_join(F.filter(F.split(text, _LINE_BREAK), lambda x: x.rlike("[a-z]")), "\n")


def collapse_blank_lines(text: Column) -> Column:
    return strip(F.regexp_replace(text, rf"(?U)\n{_WS}*\n", "\n"))


def join_hyphenated(text: Column) -> Column:
    return F.replace(text, F.lit("- \n"), F.lit(""))


def merge_bold_lines(text: Column) -> Column:
    """Turn consecutive bold lines into one bold run."""
    return F.regexp_replace(text, rf"(?U)\*-b\*{_WS}*\n{_WS}*\*b-\*", " ")


def isolate_bold_markers(text: Column) -> Column:
    for marker in (K.BOLD_CLOSE, K.BOLD_OPEN):
        text = F.replace(text, F.lit(marker), F.lit(f"\n{marker}\n"))
    return text


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, " {2,}", " "))


def newlines_to_spaces(text: Column) -> Column:
    return strip(F.replace(text, F.lit("\n"), F.lit(" ")))


def cut_before_act(text: Column) -> Column:
    """Drop everything through the first act heading, then five characters in any case."""
    return F.substr(F.regexp_replace(text, rf"(?sU)\A.*?{K.ACT_PATTERN}", ""), F.lit(6))


def clean_raw_text(text: Column, keep_newlines: bool = False) -> Column:
    """The whole cleaning chain; ``keep_newlines`` leaves the line structure in place."""
    text = collapse_blank_lines(keep_mixed_case_lines(drop_boilerplate(text)))
    text = isolate_bold_markers(merge_bold_lines(join_hyphenated(text)))
    text = collapse_spaces(collapse_blank_lines(text))
    if not keep_newlines:
        text = newlines_to_spaces(text)
    return F.lower(strip(cut_before_act(text)))


def session_date(text: Column) -> Column:
    """First ``d de <mes> de yyyy``; null when absent or not a calendar day."""
    months = "|".join(K.MONTHS)
    found = F.lower(
        F.regexp_extract(text, rf"(?iuU)\d{{1,2}}\s+de\s+(?:{months})\s+de\s+\d{{4}}", 0)
    )
    parts = F.split(found, r"(?U)\s+de\s+")
    month = F.array_position(F.array(*[F.lit(m) for m in K.MONTHS]), F.get(parts, F.lit(1)))
    day_text = F.concat_ws("-", F.get(parts, F.lit(2)), month.cast("string"), F.get(parts, F.lit(0)))
    return F.try_to_date(day_text, "yyyy-M-d")


def _header(text: Column) -> Column:
    return F.upper(F.regexp_replace(F.substring(text, 1, 1000), rf"(?U){_WS}", ""))


def session_chamber(text: Column) -> Column:
    return F.when(_header(text).contains("CÁMARADEREPRESENTANTES"), "house").otherwise("senate")


def session_type(text: Column) -> Column:
    header = _header(text)
    is_committee = header.contains("COMISIÓN") | header.contains("COMISION")
    # Fixed value: the spelling "commitee" is what downstream tables hold.
    return F.when(is_committee, "commitee").otherwise("plenary")


def split_bold(text: Column) -> Column:
    """Array of segments in order, each bold run a segment of its own."""
    marked = F.regexp_replace(
        F.replace(text, F.lit(_CUT), F.lit("")), r"(?s)(\*b-\*.*?\*-b\*)", f"{_CUT}$1{_CUT}"
    )
    return F.split(marked, _CUT)


def is_bold(segment: Column) -> Column:
    return segment.startswith(K.BOLD_OPEN) & segment.endswith(K.BOLD_CLOSE)


def headline_text(segment: Column) -> Column:
    for marker in (K.BOLD_OPEN, K.BOLD_CLOSE):
        segment = F.replace(segment, F.lit(marker), F.lit(""))
    return F.lower(strip(segment))


def is_headline(headline: Column) -> Column:
    """Accept a cleaned headline of more than five characters that names no bill."""
    return ~headline.contains("proyecto") & (F.length(headline) > 5)


def preview(text: Column, length: int = 100) -> Column:
    return F.substring(text, 1, length)
