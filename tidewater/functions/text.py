"""Text, hash and key primitives that every operator shares.

Patterns say (?Ud): Unicode classes, and lines that end at \\n only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hex digits of each hash.
_DIGITS = {"md5": 32, "sha1": 40}


def or_text(column: Column, default) -> Column:
    """A text column, or the default where it is null or empty; the text "0" is a text."""
    return F.when(column.isNull() | (column == ""), default).otherwise(column)


def or_number(column: Column, default) -> Column:
    return F.when(column.isNull() | (column == 0), default).otherwise(column)


def strip(column: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.regexp_replace(column, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def strip_right(column: Column) -> Column:
    return F.regexp_replace(column, r"(?U)[\s\x1c-\x1f]+\z", "")


def one_space(column: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(column, r"(?U)[\s\x1c-\x1f]+", " ")


def lines(column: Column) -> Column:
    """The lines of a text, at every kind of line end; a last line end opens no line."""
    cut = F.split(column, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]", -1)
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def replace_first(column: Column, pattern: str, replacement: str) -> Column:
    """The first match replaced; the pattern's groups count from $2."""
    return F.regexp_replace(column, rf"(?s)\A(.*?)(?:{pattern})", f"$1{replacement}")


def hash_hex(column: Column, algorithm: str) -> Column:
    return F.md5(column) if algorithm == "md5" else F.sha1(column)


def hex_mod(digits: Column, n_digits: int, modulus: int) -> Column:
    """A hexadecimal number modulo a number below 2 ** 31, 8 digits at a time, so no step overflows."""
    out = F.lit(0).cast("long")
    for at in range(0, n_digits, 8):
        part = F.conv(F.substring(digits, at + 1, min(8, n_digits - at)), 16, 10).cast("long")
        out = (out * (16 ** min(8, n_digits - at)) + part) % modulus
    return out


def hash_mod(column: Column, modulus: int, algorithm: str = "md5") -> Column:
    """The hash of a text as a whole number, modulo a number."""
    return hex_mod(hash_hex(column, algorithm), _DIGITS[algorithm], modulus)


def choose(key: Column, options: list[str]) -> Column:
    """One of the options, by the md5 of the key."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (hash_mod(key, len(options)) + 1).cast("int"))


def weighted_choice(key: Column, options: list[tuple[str, int]]) -> Column:
    """One of (name, weight), by the md5 of the key modulo the sum of weights."""
    pick, upto, out = hash_mod(key, sum(w for _, w in options)), 0, None
    for name, weight in options:
        upto += weight
        out = F.when(pick < upto, name) if out is None else out.when(pick < upto, name)
    return out


def content_hash(column: Column) -> Column:
    """sha256 of a text with \\n line ends and no white space at its ends."""
    return F.sha2(strip(F.replace(column, F.lit("\r\n"), F.lit("\n"))), 256)


def once(column: Column, used: Callable[[Column], Column]) -> Column:
    """What `used` makes of a column that is worked out once a row, however often it is named in there."""
    return F.transform(F.array(column), used)[0]


def if_said(column: Column, words: tuple[str, ...], found: Column, other: Column) -> Column:
    """found (null of a null text) for texts with one of the words, else other: for patterns whose matches all hold a word, as looking for words costs a hundredth of trying a pattern at each place."""
    said = F.contains(column, F.lit(words[0]))
    for w in words[1:]:
        said = said | F.contains(column, F.lit(w))
    return F.when(~said, other).otherwise(found)


def all_said(column: Column, words: tuple[str, ...], pattern: str, group: int = 0) -> Column:
    """All matches of a pattern (their group), each of which holds one of the words."""
    return if_said(column, words, F.regexp_extract_all(column, F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))


def normalized(column: Column) -> Column:
    """Lower case, no // and /* */ comments (in this order), numbers as <n>, single spaces."""
    c = F.regexp_replace(F.lower(column), r"(?d)//.*", "")
    c = F.regexp_replace(c, r"(?s)/\*.*?\*/", "")
    return strip(one_space(F.regexp_replace(c, r"(?U)\d+", "<n>")))


def fingerprint(column: Column, length: int = 3000) -> Column:
    """md5 of the normalised text's first characters."""
    return F.md5(F.substring(normalized(column), 1, length))


def slug(column: Column) -> Column:
    """Lower case, x for the multiplication sign, other runs of characters than letters and digits as _."""
    c = F.regexp_replace(F.replace(F.lower(column), F.lit("×"), F.lit("x")), "[^a-z0-9]+", "_")
    return F.regexp_replace(c, r"\A_+|_+\z", "")


def json_text(column: Column, ascii_only: bool = False) -> Column:
    """A JSON string literal as Python's json writes it; null for null."""
    c = F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        c = F.replace(c, F.lit(raw), F.lit(short))
    bad = r"[\x00-\x1f]" if not ascii_only else r"[^\x20-\x7e]"
    units = lambda x: F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-16BE"))), "(.{4})", r"\\u$1")
    escaped = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(bad), units(x)).otherwise(x)), "")
    return F.concat(F.lit('"'), F.when(c.rlike(bad), escaped).otherwise(c), F.lit('"'))


def iso_utc(time: Column) -> Column:
    """A time in UTC as 2024-01-31T08:00:00.000001+00:00, without the fraction where it is zero (the session's zone is UTC)."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(time, "SSSSSS")
    return F.concat(whole, F.when(part == "000000", "").otherwise(F.concat(F.lit("."), part)), F.lit("+00:00"))


def canonical_json(ascii_only: bool = False, **columns: Column) -> Column:
    """A JSON object with sorted keys and `", "` and `": "` between; nulls stay as null."""
    parts: list[Column] = []
    for name in sorted(columns):
        parts += [F.lit(f'{", " if parts else ""}"{name}": '), F.coalesce(json_text(columns[name], ascii_only), F.lit("null"))]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def row_key(instruction: Column, variant: Column, source: Column, bug_type: Column) -> Column:
    """The key that orders rows: md5 of their canonical JSON, absent fields as the empty text."""
    of = lambda c: F.coalesce(c, F.lit(""))
    return F.md5(canonical_json(True, instruction=of(instruction), variant=of(variant), source=of(source), bug_type=of(bug_type)))


def row_id(slug_: Column, context: Column, response: Column) -> Column:
    return F.sha1(canonical_json(slug=slug_, context=context, response=response))


# ---- the same in DuckDB, for the SQL twins


def duck_hex_mod(digits: str, n_digits: int, modulus: int) -> str:
    out = "0::BIGINT"
    for at in range(0, n_digits, 8):
        out = f"(({out} * 4294967296 + ('0x' || substr({digits}, {at + 1}, 8))::BIGINT) % {modulus})"
    return out


def duck_normalized(column: str) -> str:
    c = f"regexp_replace(lower({column}), '//[^\\n]*', '', 'g')"
    c = f"regexp_replace({c}, '(?s)/\\*.*?\\*/', '', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '[0-9]+', '<n>', 'g'), '[ \\t\\n\\r\\x0b\\x0c]+', ' ', 'g')"
    return f"trim({c})"


def duck_fingerprint(column: str, length: int = 3000) -> str:
    return f"md5(substr({duck_normalized(column)}, 1, {length}))"
