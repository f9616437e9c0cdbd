"""Text expressions shared by the jobs. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as browsers and Node define it; Java's own \s is ASCII only. The
# first half of the class rules out most letters before the long half is tried.
SPACE = r"[[^!-~\x{A1}-\x{167F}]&&[\s\x0B\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]]"
SPACES = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

# Some character from the blocks that hold white space beyond ASCII. Most texts
# have none, and for them Java's own \s says the same several times faster.
WIDE = r"[^\x00-\x{9F}\x{A1}-\x{167F}]"

# ASCII word boundaries, written out because Java's \b also looks at accents.
WORD_START = r"(?<![A-Za-z0-9_])"
WORD_END = r"(?![A-Za-z0-9_])"

# Terminal escape sequences and control characters to clean.
ANSI = r"[\x{1B}\x{9B}][\[()#;?]*(?:[0-9]{1,4}(?:;[0-9]{0,4})*)?[0-9A-ORZcf-nqry=><]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]"


def trim_space(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def _split(c: Column) -> Column:
    """Pieces between runs of white space."""
    return F.when(c.rlike(WIDE), F.split(c, f"{SPACE}+")).otherwise(F.split(c, r"\s+"))


def words(c: Column) -> Column:
    """Array of the words of a text; an empty text has none."""
    t = trim_space(c)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(_split(t))


def split_count(c: Column) -> Column:
    """Pieces after splitting at white space; an empty text counts as one."""
    return F.size(_split(c))


def strip_ansi(c: Column) -> Column:
    has = c.contains(F.lit("\x1b")) | c.contains(F.lit("\x9b"))
    return F.when(has, F.regexp_replace(c, ANSI, "")).otherwise(c)


def clean(c: Column) -> Column:
    """Drop terminal escapes and NUL, turn control characters into spaces, trim.

    All three need a control character, so one look spares most texts the rest.
    """
    t = F.regexp_replace(strip_ansi(c), r"\x00", "")
    t = F.regexp_replace(t, CONTROL, " ")
    return trim_space(F.when(c.rlike(CONTROL), t).otherwise(c))


def number(c: Column) -> Column:
    """Double from text, null where it is not a plain number.

    The pattern comes first because a failing cast costs an exception per row.
    """
    return F.when(c.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), c.try_cast("double"))


def default_if_missing(c: Column, value: str) -> Column:
    return F.coalesce(c, F.lit(value))


def counter(c: Column) -> Column:
    """Whole number from a string counter; missing or unreadable is 0."""
    digits = F.nullif(F.regexp_extract(c.cast("string"), r"^\s*([+-]?[0-9]+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


# The patterns of the three slug rules; directory names depend on them.


def slug_chars(c: Column) -> Column:
    """Every character outside a-z, A-Z, 0-9 becomes an underscore; lower case."""
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]", "_"))


def slug_runs(c: Column) -> Column:
    """Lower case, each run outside a-z, 0-9 becomes one hyphen; ends are kept."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")


def slug_trimmed(c: Column, max_len: int = 40) -> Column:
    """Lower case, other characters dropped, spaces and hyphens merged, ends cut."""
    t = F.regexp_replace(F.lower(c), rf"(?!{SPACE})[^a-z0-9-]", "")
    t = F.regexp_replace(t, rf"(?:{SPACE}|-)+", "-")
    return F.substring(F.regexp_replace(t, "^-+|-+$", ""), 1, max_len)


def hashtag(c: Column) -> Column:
    return F.concat(F.lit("#"), F.regexp_replace(c, f"{SPACE}+", ""))


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)


def with_suffix(c: Column, suffix: str) -> Column:
    """Append a marker unless the trimmed text already ends with it."""
    t = trim_space(c)
    return F.when(t.endswith(suffix), c).otherwise(F.concat(t, F.lit(suffix)))


def escape_drawtext(c: Column) -> Column:
    """Escape a caption for a media filter argument."""
    for plain, escaped in DRAWTEXT_ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


# Characters to escape, applied in this order.
DRAWTEXT_ESCAPES = [
    ("\\", "\\\\"),
    (":", "\\:"),
    ("'", "\\'"),
    (";", "\\;"),
    ("\n", ""),
]


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def fill(template: str, **values: Column) -> Column:
    """Fill ``{name}`` holes of a template with columns."""
    parts, rest = [], template
    while rest:
        at = {n: rest.find("{" + n + "}") for n in values}
        at = {n: p for n, p in at.items() if p >= 0}
        if not at:
            parts.append(F.lit(rest))
            break
        name = min(at, key=at.get)
        if at[name]:
            parts.append(F.lit(rest[: at[name]]))
        parts.append(values[name])
        rest = rest[at[name] + len(name) + 2 :]
    return F.concat(*parts)
