"""Validation and sanitising expressions (V1-V9), evaluated in the JVM.

The patterns are the reference's fixed values, written for Java regular
expressions. Python's ``\\b`` / ``\\w`` are Unicode-aware; here a word
character is spelled ``[\\pL\\pN_]`` and a boundary as an explicit
non-word character (or the text edge), which Java and RE2 read the same way.
``.`` is written ``[^\\n]`` because Python's dot stops only at ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

W = r"[\pL\pN_]"        # Python's Unicode \w
NW = r"[^\pL\pN_]"      # its complement

# Format patterns (anchored at both ends).
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+?\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\+?1?[-.\s]?(\d{3})[-.\s]?(\d{3})[-.\s]?(\d{4})$"
URL_PATTERN = r"(?i)^https?://(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?::\d+)?(?:/[^\n]*)?$"

# SQL-injection patterns (case-insensitive), boundaries explicit.
SQLI_PATTERNS = [
    rf"(?i)(^|{NW})(OR|AND)[^\pL\pN_\n][^\n]*=",
    r"(--|#|/\*)",
    rf"(?i);\s*(DROP|SELECT|INSERT|DELETE|UPDATE|CREATE|ALTER|EXEC)({NW}|$)",
]

# Script-injection patterns (case-insensitive).
XSS_PATTERNS = [
    r"(?i)<script([^\pL\pN_>][^>]*)?>[^\n]*</script>",
    r"(?i)javascript:",
    rf"(?i)on{W}+\s*=",
    r"(?i)<iframe([^\pL\pN_>][^>]*)?>[^\n]*</iframe>",
]

# Tags kept by the HTML sanitiser.
ALLOWED_TAGS = ["b", "i", "u", "strong", "em", "br", "p"]

# The special characters of the configuration password rule.
CONFIG_SPECIALS = "!@#$%^&*()_+-=[]{}|;:,.<>?"


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL_PATTERN)


def is_phone(c: Column) -> Column:
    return c.rlike(PHONE_PATTERN)


def is_url(c: Column) -> Column:
    return c.rlike(URL_PATTERN)


def combined_pattern(patterns: list[str]) -> str:
    """One alternation for a list of patterns: a leading inline flag group
    such as ``(?i)`` becomes a scoped ``(?i:...)`` branch, so each pattern
    keeps its own flags and the text is scanned once."""
    branches = []
    for p in patterns:
        if p.startswith("(?") and ")" in p and p[2:p.index(")")].isalpha():
            flags, body = p[2:p.index(")")], p[p.index(")") + 1:]
            branches.append(f"(?{flags}:{body})")
        else:
            branches.append(f"(?:{p})")
    return "|".join(branches)


def any_match(c: Column, patterns: list[str]) -> Column:
    """True when any pattern matches: one scan with the combined alternation."""
    return c.rlike(combined_pattern(patterns))


def has_sql_injection(c: Column) -> Column:
    return any_match(c, SQLI_PATTERNS)


def has_xss(c: Column) -> Column:
    return any_match(c, XSS_PATTERNS)


def html_steps(allowed: list[str] | None = None) -> list[tuple[str, str]]:
    """``sanitise_html`` as (pattern, replacement) steps, each read alike by Java and RE2.

    U+0001 and U+0002 stand for the marks of kept tags, U+0003 for the ``&`` of
    a character reference. A tag has no ``<`` inside, so a stray ``<`` never
    swallows the text after it, and what only becomes a tag once another one
    is gone is escaped like any stray mark.
    """
    tags = "|".join(allowed or ALLOWED_TAGS)
    return [
        ("[\\x01\\x02\\x03]", ""),
        ("(?s)<!--.*?-->", ""),
        ("<[!?][^<>]*>", ""),
        (f"(?i)<(/?)({tags})(?:[ \\t\\n\\f\\r/][^<>]*)?>", "\x01\\1\\2\x02"),
        ("</?[A-Za-z][^<>]*>", ""),
        ("&([A-Za-z][A-Za-z0-9]*;|#[0-9]+;|#[xX][0-9A-Fa-f]+;)", "\x03\\1"),
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ("\\x01", "<"),
        ("\\x02", ">"),
        ("\\x03", "&"),
    ]


def sanitise_html(c: Column, allowed: list[str] | None = None) -> Column:
    """Drop comments and declarations, keep allowed tags without their
    attributes, strip every other tag but keep its text, and escape every
    mark that is left (``<``, ``>``, and ``&`` outside character references).

    Applying it again changes nothing. Null stays null. A ``>`` inside a quoted
    attribute ends the tag; the rest of the attribute stays as escaped text.
    """
    for pattern, to in html_steps(allowed):
        c = F.regexp_replace(c, pattern, to.replace("\\1", "$1").replace("\\2", "$2"))
    return c


def sanitise_filename(c: Column, as_of: Column) -> Column:
    """Base name, characters outside ``[\\w.-]`` -> ``_``; an empty or over-long
    result becomes ``file_<yyyyMMdd_HHmmss of as_of>``."""
    base = F.regexp_extract(c, r"([^/]*)$", 1)
    clean = F.regexp_replace(base, r"[^\pL\pN_.\-]", "_")
    fallback = F.concat(F.lit("file_"), F.date_format(as_of, "yyyyMMdd_HHmmss"))
    return F.when((F.length(clean) == 0) | (F.length(clean) > 255), fallback).otherwise(clean)


def password_strength(c: Column) -> Column:
    """Struct of five flags: length >= 12, upper, lower, digit, special
    (any non-word character)."""
    return F.struct(
        (F.length(c) >= 12).alias("length"),
        c.rlike("[A-Z]").alias("upper"),
        c.rlike("[a-z]").alias("lower"),
        c.rlike(r"\p{Nd}").alias("digit"),
        c.rlike(NW).alias("special"),
    )


def password_strength_config(c: Column) -> Column:
    """Second rule set: any upper / lower / digit character (Unicode
    classes) and a special from the fixed list."""
    specials = "".join("\\" + ch for ch in CONFIG_SPECIALS)
    return F.struct(
        (F.length(c) >= 12).alias("length"),
        c.rlike(r"\p{Lu}").alias("upper"),
        c.rlike(r"\p{Ll}").alias("lower"),
        c.rlike(r"\p{Nd}").alias("digit"),
        c.rlike(f"[{specials}]").alias("special"),
    )


def secret_strength(c: Column) -> Column:
    """Length >= 32 and not purely alphanumeric (V9)."""
    return (F.length(c) >= 32) & ~c.rlike(r"^[\pL\pN]+$")
