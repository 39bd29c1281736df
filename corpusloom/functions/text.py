"""Text functions as Spark columns.

Blanks follow Unicode, not ASCII: `BLANK` covers everything that splits words in Unicode-aware languages, with
no-break space, NEL and the information separators. Every function maps NULL to NULL unless it says otherwise.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
SOLID = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
#: Prefixes of wiki metadata lines.
WIKI_PREFIXES = ("Category", "File", "Image", "Template", "Portal", "Wikipedia", "Special")
WIKI_LINE = rf"(?i)^{BLANK}*(?:(?:{'|'.join(WIKI_PREFIXES)}):|\[\[Category:[^\]]+\]\])"
#: What counts as a URL, an e-mail address, a mention and a hashtag.
URL = r"(?i)\b(?:https?://|www\.)[^\s<>]+"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[A-Za-z]{2,}\b"
MENTION = r"(^|[\s])@[A-Za-z0-9_]{2,}"
HASHTAG = r"(^|[\s])#[^\s#]+"


def strip(c: Column) -> Column:
    """Without blanks at both ends."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+$", "")


def words(c: Column) -> Column:
    """Runs of non-blank characters, in order; none for an empty or blank text."""
    return F.filter(F.split(c, rf"{BLANK}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"{SOLID}+"))


def char_count(c: Column) -> Column:
    return F.length(c)


def is_short(c: Column, max_words: int = 8, max_chars: int = 40) -> Column:
    """At most `max_words` words or `max_chars` code points; NULL counts as short."""
    return F.coalesce((word_count(c) <= max_words) | (F.length(c) <= max_chars), F.lit(True))


def remove_numbers(c: Column) -> Column:
    """Without runs of decimal digits of any script."""
    return F.regexp_replace(c, r"\p{Nd}+", "")


@functools.lru_cache(maxsize=1)
def digit_table() -> tuple[str, str]:
    """Characters with a decimal, else a digit value, and the ASCII digits they stand for."""
    source, target = [], []
    for cp in range(128, sys.maxunicode + 1):
        c = chr(cp)
        value = unicodedata.decimal(c, unicodedata.digit(c, None))
        if value is not None:
            source.append(c)
            target.append(str(value))
    return "".join(source), "".join(target)


def fold_digits(c: Column) -> Column:
    """Digits of any script, superscript and circled ones too, as ASCII digits."""
    return F.translate(c, *digit_table())


def drop_wiki_lines(c: Column) -> Column:
    """Without lines of wiki metadata; the rest joined by newlines, blanks at both ends stripped."""
    lines = F.filter(F.split(c, LINE_END), lambda x: ~F.regexp_like(x, F.lit(WIKI_LINE)))
    return strip(F.array_join(lines, "\n"))


def normalize(c: Column, form: str) -> Column:
    """Unicode normal form NFC, NFD, NFKC or NFKD."""
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"unknown normal form {form}")

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize(form, t))

    return run(c)


def casefold(c: Column) -> Column:
    """Full case folding."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else t.casefold())

    return run(c)


def clean(
    c: Column, lowercase: bool = False, strip_numbers: bool = False, digits: bool = False, wiki: bool = False, form: str = "NFC", fold_case: bool = False, always_normalize: bool = False
) -> Column:
    """Cleaning in fixed order: lower case, decimal digits out, then normal form, folding, digits folded, wiki lines out.

    As digits are removed before others are folded, a superscript reappears as an ASCII digit. The normal form is
    applied only if another of the later steps is, or a form other than NFC is asked for, or `always_normalize`.
    """
    if lowercase:
        c = F.lower(c)
    if strip_numbers:
        c = remove_numbers(c)
    if form != "none" and (digits or wiki or fold_case or form != "NFC" or always_normalize):
        c = normalize(c, form)
    if fold_case:
        c = casefold(c)
    if digits:
        c = fold_digits(c)
    if wiki:
        c = drop_wiki_lines(c)
    return c


def clean_social(
    c: Column, lowercase: bool = True, normalize_digits: bool = True, strip_urls: bool = True, strip_emails: bool = True, strip_mentions: bool = True, strip_hashtags: bool = False, form: str = "NFKC"
) -> Column:
    """Without URLs, e-mail addresses, mentions and hashtags as asked, digits as 0, one blank between words. NULL gives ''."""
    c = F.coalesce(c, F.lit(""))
    if form != "none":
        c = normalize(c, form)
    for on, pattern in ((strip_urls, URL), (strip_emails, EMAIL), (strip_mentions, MENTION), (strip_hashtags, HASHTAG)):
        if on:
            c = F.regexp_replace(c, pattern, " ")
    if normalize_digits:
        c = F.regexp_replace(c, r"\p{Nd}", "0")
    if lowercase:
        c = F.lower(c)
    return strip(F.regexp_replace(c, rf"{BLANK}+", " "))


@functools.lru_cache(maxsize=1)
def _digit_class() -> str:
    """Character class of everything that is a digit, superscript and circled ones included."""
    return r"[\p{Nd}" + "".join(rf"\x{{{ord(c):x}}}" for c in digit_table()[0] if unicodedata.category(c) != "Nd") + "]"


def _without_digits(c: Column) -> Column:
    # a hash lookup per character; a class of hundreds of single characters would be tried one by one
    return F.translate(c, digit_table()[0] + "0123456789", "")


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def digit_ratio(c: Column) -> Column:
    """Share of characters that are digits; 0 for the empty text."""
    return (F.length(c) - F.length(_without_digits(c))) / F.greatest(F.length(c), F.lit(1))


def has_diacritics(c: Column) -> Column:
    """Whether any character combines after decomposition."""

    @F.pandas_udf("boolean")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else not t.isascii() and any(map(unicodedata.combining, unicodedata.normalize("NFD", t))))

    return run(c)


def len_bucket(c: Column, word_short: int = 8, word_long: int = 20, char_short: int = 40, char_long: int = 120) -> Column:
    n, m = word_count(c), F.length(c)
    return F.when(c.isNull(), None).when((n <= word_short) | (m <= char_short), "SHORT").when((n >= word_long) & (m >= char_long), "LONG").otherwise("MEDIUM")


def digit_bucket(ratio: Column, low: float = 0.05, med: float = 0.20) -> Column:
    return let(ratio, lambda r: F.when(r.isNull(), None).when(r <= 0, "NONE").when(r < low, "LOW").when(r < med, "MED").otherwise("HIGH"))


#: Blocks that name a script, in alphabetical order of the names.
BLOCKS = {
    "Arabic": ((0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF)),
    "Cyrillic": ((0x0400, 0x052F),),
    "Devanagari": ((0x0900, 0x097F),),
    "Greek": ((0x0370, 0x03FF),),
    "Han": ((0x4E00, 0x9FFF),),
    "Hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "Hebrew": ((0x0590, 0x05FF),),
    "Hiragana": ((0x3040, 0x309F),),
    "Katakana": ((0x30A0, 0x30FF),),
    "Latin": ((0x0000, 0x024F),),
    "Thai": ((0x0E00, 0x0E7F),),
}


def block_class(name: str) -> str:
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in BLOCKS[name]) + "]"


def block_script(c: Column) -> Column:
    """Most frequent of the blocks' scripts among characters that are no digits, blanks, punctuation, symbols or
    controls; the alphabetically first of equals; `Other` if there is none."""
    bare = F.regexp_replace(_without_digits(c), r"[\p{P}\p{S}\p{C}\s\x{1c}-\x{1f}\x{85}\p{Z}]+", "")

    def best(b: Column) -> Column:
        return F.array_max(F.array(*[F.struct(F.regexp_count(b, F.lit(block_class(name))).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, name in enumerate(BLOCKS)]))

    return F.when(c.isNull(), None).otherwise(let(let(bare, best), lambda x: F.when(x["n"] == 0, "Other").otherwise(x["name"])))


def meta_tokens(c: Column, script: bool = True, length: bool = True, digits: bool = True) -> Column:
    """` __feat_SCRIPT=.. __feat_LEN=.. __feat_DIGITRATIO=..`, or '' if none is asked for."""
    parts = []
    if script:
        parts.append(F.concat(F.lit("__feat_SCRIPT="), block_script(c)))
    if length:
        parts.append(F.concat(F.lit("__feat_LEN="), len_bucket(c)))
    if digits:
        parts.append(F.concat(F.lit("__feat_DIGITRATIO="), digit_bucket(digit_ratio(c))))
    if not parts:
        return F.when(c.isNotNull(), "")
    return F.when(c.isNotNull(), F.concat(F.lit(" "), F.concat_ws(" ", *parts)))


def shingles(c: Column, n: int = 3) -> Column:
    """Character n-grams with repeats; a shorter text is its own only one, the empty text has none."""
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(n))))


# ---- labelled lines ----

LABEL = "__label__"


def label_line(label: Column, text: Column, region: Column, raw: bool = False, literal_nulls: bool = False) -> Column:
    """`__label__<label> <text> <region>`. NULL prints as '' (`None` with `literal_nulls`); line breaks in the text
    become one blank, unless `raw`."""
    blank = F.lit("None" if literal_nulls else "")
    body = F.coalesce(text, blank)
    if not raw:
        body = F.regexp_replace(body, r"[\r\n]+", " ")
    return F.concat(F.lit(LABEL), F.coalesce(label, blank), F.lit(" "), body, F.lit(" "), F.coalesce(region, blank))


def parse_label_line(line: Column, prefix: str = LABEL) -> Column:
    """`struct(gold, text)`: the first token with the prefix and the tokens after it. Without one, all tokens."""
    tokens = words(line)
    at = F.coalesce(F.array_position(F.transform(tokens, lambda t: F.startswith(t, F.lit(prefix))), True), F.lit(0)).cast("int")
    return F.struct(
        F.when(at > 0, F.try_element_at(tokens, at)).alias("gold"),
        F.array_join(F.slice(tokens, at + 1, F.greatest(F.size(tokens), F.lit(1))), " ").alias("text"),
    )


def label_tokens(line: Column) -> Column:
    """All labels anywhere in a line."""
    return F.regexp_extract_all(line, F.lit(rf"({LABEL}{SOLID}+)"), F.lit(1))


def vocabulary_tokens(line: Column) -> Column:
    """Runs of letters, numbers and underscores."""
    return F.regexp_extract_all(line, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def human_bytes(n: Column) -> Column:
    """B, KB, MB, GB or TB with one decimal."""
    n = n.cast("double")
    out = F.when(n < 1024, F.format_string("%.1f B", n))
    for k, unit in ((1, "KB"), (2, "MB"), (3, "GB")):
        out = out.when(n < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", n / 1024.0**k))
    return out.otherwise(F.format_string("%.1f TB", n / 1024.0**4))


# ---- training profile ----

#: Vocabulary bound (exclusive), name, dim, bucket, minn, maxn, word n-grams.
PROFILES = ((128, "micro", 32, 20000, 2, 3, 1), (256, "tiny", 64, 50000, 2, 4, 1), (5000, "small", 100, 100000, 2, 5, 2), (50000, "med", 200, 200000, 2, 5, 2), (None, "large", 300, 500000, 2, 6, 2))


def training_profile(vocab: Column) -> Column:
    names = ("name", "dim", "bucket", "minn", "maxn", "word_ngrams")
    out = None
    for bound, *values in PROFILES:
        s = F.struct(*[F.lit(v).alias(n) for n, v in zip(names, values)])
        out = s if bound is None and out is None else F.when(vocab < bound, s) if out is None else out.when(vocab < bound, s) if bound is not None else out.otherwise(s)
    return out


def pick_dsub(dim: Column, forced: int | None = None) -> Column:
    """Width of the sub-vectors of a product quantiser: a forced one if it divides `dim`, else 1; by default the first
    of 4, 8, 6, 5, 10, 3 and 2 that divides it, else 1."""
    if forced:
        return F.when(dim % forced == 0, forced).otherwise(1)
    out = F.when(dim % 4 == 0, 4)
    for d in (8, 6, 5, 10, 3, 2):
        out = out.when(dim % d == 0, d)
    return out.otherwise(1)


def safe_cutoff(desired: Column, vocab: Column) -> Column:
    """Vocabulary cutoff between 1 and the vocabulary; no wish means the whole vocabulary."""
    wish = F.coalesce(desired.cast("long"), F.lit(1_000_000_000))
    return F.when(vocab < 1, 1).otherwise(F.greatest(F.lit(1), F.least(wish, vocab)))


# ---- seeded draws ----


def draw(seed: int, *keys: Column | str) -> Column:
    """A reproducible number from 0 to 2^32 - 1 for the seed and keys: the first 32 bits of their MD5."""
    return F.conv(F.substr(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in keys])), F.lit(1), F.lit(8)), 16, 10).cast("long")


def rand_int(seed: int, low: Column, high: Column, *keys: Column | str) -> Column:
    """A reproducible whole number from `low` to `high`, both included."""
    return (low + draw(seed, *keys) % (high - low + 1)).cast("int")


