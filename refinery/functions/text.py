"""Column functions for cleaning catalogue text. All are built-in expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the cleaning rules. (?U) gives \s and \w their Unicode meaning, (?d) keeps '.' and '$' to line feeds.
LIST_PREFIX = r"(?Ud)^전성분(?:명)?\s*:?\s*"
#: What may stand before a notice is optional, so its first characters are looked at before it is tried, else every place of a text is.
FREE_FROM_TAIL = r"(?Udisu)(?=[*※무\s])[*※]?\s*무첨가\s*성분\s*:.*$"
LEGEND = (
    r"(?Ud)(?=[※*+제I\s])(?:(?:※|\*|\+)\s*(?:표시\s*:|자연\s*유래|식물\s*유래|유기농|ILN\d+)|(?:※|\*|\+)?\s*(?:제공된\s*성분은|ILN\d+\s*성분\s*목록은))"
    r".*?(?=\[|<|(?:^|\s)\d{1,2}\)\s*[가-힣a-zA-Z]|$)"
)
ILN_TAG = r"(?Ud)(?i)[<\[]?ILN\d+[>\]]?"
MARKED_BRACKET = r"\([^)]*[*※+][^)]*\)"
MARKER = r"[*※+]"
#: A run of letters is tried from its first one left (its start, or where the last header ended): what matches from within it matches from there.
SECTION_HEADER = (
    r"(?Ud)(?:<[^>]+>|■\s*[^:■]+:\s*|(?:\G|(?<![가-힣a-zA-Z0-9]))[가-힣a-zA-Z0-9]+\s*-\s*\[전성분|\[(?![Ii][Ll][Nn])[^\]]+\]|(?:^|\s)\d{1,2}\)\s*[가-힣a-zA-Z]+"
    r"|(?:\G|(?<![가-힣a-zA-Z0-9\s]))[가-힣a-zA-Z0-9\s]+(?:볼|앰플|세럼|크림|토너|로션)\s*[):]\s*(?=[가-힣]))"
)
#: Each header has one of these.
HEADER_SIGN = r"[<■\[):]"
MAIN_ITEM = r"\[본품\]"
OPTION_BUNDLE = r"(?Ud)\d+\s*[종가지]\s*(?:(?:택|중|중\s*\d+)\s*(?:1|일|택|선택))?|\b(?:택|선택)\s*\d+\b"
CONCENTRATION_BRACKET = (
    r"(?Ud)\([^)]*(ppm|PPM|ppb|PPB|%|mg|mG|G|g|ml|mL|IU|NON\s*GMO|CI\s*\d+|BHA|AHA|산\s*|전성분|전성분명|성분|유래|추출물|아쿠아"
    r"|[\d.]+\s*(?:%|ppm|ppb|mg|ml|g)?$).*?\)"
)
NAME_BRACKET = r"(?d)\[.*?\]|\(.*?\)"
VOLUME_TAIL = r"(?iuUd)(\d+(?:\.\d+)?\s*[+xX*]\s*\d+.*|\d+(?:\.\d+)?\s*(?:ml|㎖|l|ℓ|g|매|호|ea|개입|입|p|종)(?=[^a-zA-Z가-힣]|$).*|\b\d+(?:\.\d+)?$).*"
MARKETING = (
    r"(?iuUd)기획|증정|단독|1\+1|본품|추가|대용량|세트|듀오|트리플|한정|리필팩|리필|단품|구성|트래블\s*키트|캡슐\s*키트|스틱포"
    r"|더블\s*(기획|세트|구성|\d+입|\d+\s*(ml|g|㎖))"
)
TAIL_SYMBOLS = r"(?Ud)[\s*/\-.,]+$|(?<=\s)[*/\-,.]+(?=\s|$)"
COMMA_BETWEEN = r"(?<=[A-Za-z0-9]),(?=[A-Za-z0-9])"
COMMA_MASK = "_C_"
WORD_EDGE = "[가-힣a-zA-Z0-9\\-./]"
SIGNIFICANT = "[가-힣a-zA-Z0-9]"

#: Namespace of stable ids; a parameter of ``stable_id``.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "refinery.example")


def text(c: Column, default: str = "") -> Column:
    """P1."""
    return F.coalesce(c.cast("string"), F.lit(default))


def strip(c: Column) -> Column:
    """All white space off both ends, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """P5: null, white space only, or the text nan."""
    return c.isNull() | c.rlike(r"(?Ud)^\s*(nan)?\s*\z")


def missing_fields(fields: dict[str, Column]) -> Column:
    """Names of blank or null fields, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in fields.items()]))


def safe_timestamp(c: Column) -> Column:
    """To UTC in a UTC session; what cannot be read is null."""
    return F.try_to_timestamp(c.cast("string"))


def safe_double(c: Column) -> Column:
    """P3."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def safe_int(c: Column) -> Column:
    """Through double, cut towards zero; NaN and what does not fit give 0."""
    return F.coalesce(c.try_cast("double").try_cast("int"), F.lit(0))


def exact_keyword(c: Column, words: list[str]) -> Column:
    """P7."""
    return c.isin(words) if words else F.lit(False)


def holds_keyword(c: Column, words: list[str]) -> Column:
    """P8."""
    found = F.lit(False)
    for w in words:
        found = found | F.contains(c, F.lit(w))
    return found


def countable_item(c: Column) -> Column:
    """P10: longer than one character and not only digits."""
    return (F.length(c) > 1) & ~c.rlike("^[0-9]+$")


def after_mark(c: Column, mark: str | None) -> Column:
    """Above the high-water mark; without one, all."""
    return F.lit(True) if mark is None else c > F.lit(mark)


def significant(residual: Column) -> Column:
    """P13."""
    s = strip(residual)
    return (F.length(s) > 2) & s.rlike(SIGNIFICANT)


def collapse(c: Column) -> Column:
    """T5."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def replace_all(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered (Java pattern, replacement) pairs, each over the result of the one before."""
    for pattern, fix in rules:
        c = F.regexp_replace(c, F.lit(pattern), F.lit(fix))
    return c


def literal_pattern(raw: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()<>*+-=!?^$|" else ch for ch in raw)


def literal_fix(fix: str) -> str:
    return fix.replace("\\", "\\\\").replace("$", "\\$")


def name_rules(rows: list[dict]) -> list[tuple[str, str]]:
    """T6 rules from (raw, fix, match_type): simple is literal, else a regex."""
    return [(literal_pattern(r["raw"]) if r.get("match_type", "regex") == "simple" else "(?Ud)" + r["raw"], literal_fix(r["fix"])) for r in rows]


def boundary_rules(rows: list[dict]) -> list[tuple[str, str]]:
    """Literal texts that stand alone, longest first, ties by text."""
    longest = sorted(rows, key=lambda r: (-len(r["raw"]), r["raw"]))
    return [(f"(?<!{WORD_EDGE}){literal_pattern(r['raw'])}(?!{WORD_EDGE})", literal_fix(r["fix"])) for r in longest]


def fix_typos(c: Column, boundary: list[dict], plain: list[dict]) -> Column:
    """T8, then T9."""
    c = replace_all(c, boundary_rules(boundary))
    for r in sorted(plain, key=lambda r: (-len(r["raw"]), r["raw"])):
        c = F.replace(c, F.lit(r["raw"]), F.lit(r["fix"]))
    return c


def clean_name(c: Column, rules: list[tuple[str, str]] = ()) -> Column:
    """T1 to T6."""
    c = F.regexp_replace(c, NAME_BRACKET, " ")
    c = F.regexp_replace(c, VOLUME_TAIL, " ")
    c = F.regexp_replace(c, MARKETING, " ")
    c = F.regexp_replace(c, TAIL_SYMBOLS, " ")
    return collapse(replace_all(collapse(c), list(rules)))


def unify_separators(c: Column) -> Column:
    """Line ends and tabs go, @ and | become commas."""
    return F.translate(c, "@|\r\n\t", ",,")


def drop_notices(c: Column) -> Column:
    """T10."""
    for pattern in (LIST_PREFIX, FREE_FROM_TAIL, LEGEND, ILN_TAG, MARKED_BRACKET, MARKER):
        c = F.regexp_replace(c, pattern, "")
    return c


def header_count(c: Column, pattern: str = SECTION_HEADER) -> Column:
    """T12's count."""
    found = F.regexp_count(c, F.lit(pattern))
    return F.when(~c.rlike(HEADER_SIGN), 0).otherwise(found) if pattern == SECTION_HEADER else found


def main_item_count(c: Column) -> Column:
    """T11."""
    return F.regexp_count(c, F.lit(MAIN_ITEM))


def strip_header(c: Column) -> Column:
    """A single header goes; none or several are left."""
    return F.when(header_count(c) == 1, F.regexp_replace(c, SECTION_HEADER, "")).otherwise(c)


def drop_concentrations(c: Column) -> Column:
    """T13."""
    return F.regexp_replace(c, CONCENTRATION_BRACKET, "")


def mask_commas(c: Column) -> Column:
    """T14."""
    return F.regexp_replace(c, COMMA_BETWEEN, COMMA_MASK)


def despace(c: Column) -> Column:
    """T15, T18."""
    return F.replace(c, F.lit(" "), F.lit(""))


def unmask(c: Column) -> Column:
    """T16."""
    return strip(F.replace(c, F.lit(COMMA_MASK), F.lit(",")))


def stable_id(brand: Column, name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """Version 5 UUID of brand||name."""
    sha = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(F.concat(brand, F.lit("||"), name), "utf-8")))
    variant = F.translate(F.substring(sha, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(sha, 1, 8), F.substring(sha, 9, 4), F.concat(F.lit("5"), F.substring(sha, 14, 3)), F.concat(variant, F.substring(sha, 18, 3)), F.substring(sha, 21, 12))


def rate(part: Column, whole: Column) -> Column:
    """Rounded to four places, 0 for an empty whole."""
    return F.when(whole > 0, F.bround(part / whole, 4)).otherwise(F.lit(0.0))


def path_part(path: Column, pattern: str, group: int = 1) -> Column:
    """T20."""
    return F.regexp_extract(path, pattern, group)
