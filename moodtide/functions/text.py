"""Text columns: whitespace, PII scrubbing, lexicons, markdown, URLs.

Patterns are Java regular expressions. Character classes are spelled out so that
a word, digit or space is the same Unicode set everywhere, not Java's ASCII
default (which would let phone numbers in Arabic-Indic digits through).
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- fixed values: character classes (to be put between brackets) -------------
# Frequent characters are listed one by one and the rest sits behind a range, so
# that an ordinary letter is dismissed by a table look-up and one comparison.
ODD_SPACE = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
SPACE = " " + ODD_SPACE
NO_SPACE = rf"\x21-\x7e[^{SPACE}]"
DIGIT = r"0-9[\u0660-\x{10ffff}&&\p{Nd}]"
WORD = r"A-Za-z0-9_[\xaa-\x{10ffff}&&[\p{L}\p{N}]]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# --- fixed values: placeholder bodies and redaction marker ---------------------
DELETED_MARKERS = ("[deleted]", "[removed]")
REDACTION = "[REDACTED:{kind}]"

# --- fixed values: PII kinds, in the order they are applied --------------------
# The local part of an address starts at the head of its run of legal characters
# (or where the previous match ended), so a long run is scanned only once. The
# other kinds look at the first character before anything dearer.
PII_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "url": rf"(?=[hHwW])(?iu)(?:https?://|www\.)[^{SPACE}]+",
    "handle": rf"(?=[/uU])(?iu)(?<![{WORD}/])/?u/[A-Za-z0-9_-]+",
    "mention": rf"@(?<![{WORD}]@)[A-Za-z0-9_]{{2,}}",
    "phone": (
        rf"(?=[+{DIGIT}])(?<![{WORD}])\+?[{DIGIT}][{DIGIT}{SPACE}().-]{{5,}}[{DIGIT}](?![{WORD}])"
    ),
}

# Substrings without which a kind cannot match; a plain byte search is far
# cheaper than starting the pattern at every character of a clean text.
PII_HINTS = {
    "email": ("@",),
    "url": ("://", "ww.", "wW.", "Ww.", "WW."),
    "handle": ("u/", "U/"),
    "mention": ("@",),
}
# No match of these kinds holds a space or looks across one, so words can be scrubbed one by one.
PII_IN_WORDS = ("email", "url", "handle", "mention")

# --- fixed values: distress lexicon --------------------------------------------
ACUTE_PHRASES = (
    "kill myself",
    "killing myself",
    "end my life",
    "ending my life",
    "want to die",
    "wanted to die",
    "wish i was dead",
    "wish i were dead",
    "better off dead",
    "no reason to live",
    "nothing to live for",
    "end it all",
    "suicidal",
    "suicide",
    "self harm",
    "self-harm",
    "hurt myself",
    "harming myself",
)
SEVERE_TERMS = (
    "hopeless",
    "hopelessness",
    "worthless",
    "unbearable",
    "can't go on",
    "cant go on",
    "can't take it anymore",
    "cant take it anymore",
    "give up on everything",
    "giving up on everything",
    "no way out",
    "empty inside",
    "burden to everyone",
    "crisis",
)

# --- fixed values: word lists counted per 100 words ----------------------------
FIRST_PERSON = ("i", "me", "my", "myself", "i'm", "im", "i've", "ive")
NEGATION = ("no", "not", "never", "can't", "cant", "won't", "wont", "nothing", "nobody")

# --- fixed values: markers of questions about individuals ----------------------
INDIVIDUAL_MARKERS = (
    r"\b(?:who|whose|author|authors|poster|posters|person|individual|individuals)\b",
    r"\b(?:user|users|username|usernames|handle|handles|profile|profiles)\b",
    r"\b(?:account|accounts|identify|verbatim|quote|quotes|dm|op)\b",
    r"de-?anonymi\w*",
    r"/?u/",
    r"posted by",
    r"real name",
    r"name of",
    r"(?:example|actual|specific|negative|saddest|top|that|this|the) post",
    r"direct message",
    r"private message",
    r"message the",
)

# --- fixed values: markdown patterns -------------------------------------------
IMAGE = r"!\[[^\]]*\]\([^)]*\)"
LINK = r"\[([^\]]+)\]\([^)]*\)"
# Possessive: a rail of thousands of links must not recurse once per link.
NAV_LINE = (
    rf"^[{SPACE}]*(?:[-*+][{SPACE}]*)?(?:\[[^\]]*\]\([^)]*\)[{SPACE}]*)++\z"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- whitespace -----------------------------------------------------------------


def normalize_space(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim; NULL stays NULL.

    Words with lone spaces between them already are what they should be and are
    taken over in one piece, up to the next longer run or other whitespace character.
    """
    pattern = rf"[{SPACE}]*([{NO_SPACE}]*(?: [{NO_SPACE}]+)*+)[{SPACE}]*"
    return F.trim(F.regexp_replace(_col(c), pattern, "$1 "))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_col(c), rf"^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\z", "")


def words(c: Column | str) -> Column:
    """Whitespace-separated tokens; blank text gives an empty array."""
    return F.filter(F.split(_col(c), rf"[{SPACE}]+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated tokens."""
    pieces = F.split(_col(c), rf"[{SPACE}]+")
    # split() can only leave an empty token at either end.
    edges = (F.element_at(pieces, 1) == "").cast("int") + (
        (F.element_at(pieces, -1) == "") & (F.size(pieces) > 1)
    ).cast("int")
    return F.size(pieces) - edges


def has_body(c: Column | str) -> Column:
    """True when normalised text is neither missing, empty nor a removal marker.

    Tested on the raw text: the pattern gives up at the first other character,
    so long posts are not normalised twice.
    """
    markers = "|".join(rf"\Q{m}\E" for m in DELETED_MARKERS)
    blank = rf"^[{SPACE}]*+(?:{markers})?[{SPACE}]*+\z"
    return _col(c).isNotNull() & ~_col(c).rlike(blank)


# --- identifiers ----------------------------------------------------------------


def derive_post_id(*parts: Column | str) -> Column:
    """16 hex characters of sha1 over the ``|``-joined parts, missing as ''."""
    joined = F.concat_ws("|", *[F.coalesce(_col(p), F.lit("")) for p in parts])
    return F.substring(F.sha1(joined), 1, 16)


def hash_author(author: Column | str, salt: Column) -> Column:
    """Salted sha256 pseudonym; missing and empty authors have none."""
    a = _col(author)
    return F.when(F.length(a) > 0, F.sha2(F.concat(salt, F.lit(":"), a), 256))


def content_hash(c: Column | str, length: int) -> Column:
    return F.substring(F.sha2(_col(c), 256), 1, length)


# --- PII ------------------------------------------------------------------------


def matches_pii(c: Column | str, kind: str) -> Column:
    """Does the text still hold this kind of identifier?"""
    found = _col(c).rlike(PII_PATTERNS[kind])
    hint = _hinted(_col(c), kind)
    return found if hint is None else hint & found


def _hinted(c: Column, kind: str) -> Column | None:
    hints = [c.contains(h) for h in PII_HINTS.get(kind, ())]
    return reduce(lambda a, b: a | b, hints) if hints else None


def scrub_kind(c: Column | str, kind: str) -> Column:
    return F.regexp_replace(_col(c), PII_PATTERNS[kind], REDACTION.format(kind=kind))


def scrub_text(c: Column | str) -> Column:
    """Replace every identifier kind, in order, by its marker."""
    return reduce(scrub_kind, PII_PATTERNS, _col(c))


def scrub_columns(df: DataFrame, *columns: str) -> DataFrame:
    """``scrub_text`` over whole columns, skipping texts and words that cannot match.

    One projection per kind keeps each rewritten text evaluated once.
    """

    def where_hinted(c: Column, kind: str, scrubbed: Column) -> Column:
        hint = _hinted(c, kind)
        return scrubbed if hint is None else F.when(hint, scrubbed).otherwise(c)

    def scrubbed(c: Column, kind: str) -> Column:
        if kind not in PII_IN_WORDS:
            return scrub_kind(c, kind)
        pieces = F.transform(F.split(c, " "), lambda w: where_hinted(w, kind, scrub_kind(w, kind)))
        return F.array_join(pieces, " ")

    for kind in PII_PATTERNS:
        df = df.withColumns({c: where_hinted(F.col(c), kind, scrubbed(F.col(c), kind)) for c in columns})
    return df


def register_scrub(spark: SparkSession, name: str = "scrub_pii") -> None:
    """``scrub_text`` as a SQL function, for models written in SQL."""
    body = "t"
    for kind, pattern in PII_PATTERNS.items():
        body = f"regexp_replace({body}, r'{pattern}', '{REDACTION.format(kind=kind)}')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN {body}")


# --- lexicons -------------------------------------------------------------------


def distinct_hits(c: Column | str, terms: Iterable[str]) -> Column:
    """How many of the terms occur as substrings of the lowered text."""
    lowered = F.lower(_col(c))
    return reduce(add, [lowered.contains(t).cast("int") for t in terms], F.lit(0))


def count_hits(c: Column | str, terms: Iterable[str]) -> Column:
    """Non-overlapping occurrences, summed over the terms.

    Most texts hold few of the terms, so a byte search decides whether a term is
    worth counting.
    """
    lowered = F.lower(_col(c))

    def count(term: str) -> Column:
        found = F.regexp_count(lowered, F.lit(rf"\Q{term}\E"))
        return F.when(lowered.contains(term), found).otherwise(0)

    return reduce(add, [count(t) for t in terms], F.lit(0))


def count_tokens(c: Column | str, tokens: Iterable[str]) -> Column:
    """Occurrences of whole tokens, any case, bounded by non-word characters.

    The pattern takes a first letter before it looks back or at anything dearer. The four
    characters that equal an ASCII letter in Unicode's upper or lower case only sit behind a range.
    """
    by_head: dict[str, list[str]] = {}
    for token in tokens:
        by_head.setdefault(token[0].lower(), []).append(token[1:])
    ascii_heads = "".join(h + h.upper() for h in sorted(by_head))
    head = rf"[{ascii_heads}[\u0130-\u212a&&[\u0130\u0131\u017f\u212a]]]"
    choice = "|".join(rf"(?<={h})(?:{'|'.join(rests)})" for h, rests in by_head.items())
    return F.regexp_count(_col(c), F.lit(rf"{head}(?iu)(?<![{WORD}]{head})(?:{choice})(?![{WORD}])"))


def targets_individual(question: Column | str) -> Column:
    """Does a question ask about a person or a single post?"""
    return _col(question).rlike("(?iU)" + "|".join(INDIVIDUAL_MARKERS))


# --- markdown and URLs ----------------------------------------------------------


def clean_markdown(c: Column | str) -> Column:
    """Drop images and link-only lines, unwrap links, collapse blank runs."""
    lines = F.transform(
        F.split(F.coalesce(_col(c), F.lit("")), LINE_BREAK),
        lambda line: strip(F.regexp_replace(line, IMAGE, "")),
    )
    prose = F.filter(lines, lambda line: ~line.rlike(NAV_LINE))
    unwrapped = F.transform(prose, lambda line: F.regexp_replace(line, LINK, "$1"))
    return strip(F.regexp_replace(F.array_join(unwrapped, "\n"), r"\n{3,}", "\n\n"))


def url_scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_host(url: Column | str) -> Column:
    """Lower-cased host without user info or port; '' when there is none."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:]*)"
    return F.lower(F.regexp_extract(_col(url), pattern, 1))


def last_segment(url: Column | str) -> Column:
    """Text after the last slash, trailing slashes ignored."""
    return F.regexp_extract(F.regexp_replace(_col(url), r"(?<!/)/+\z", ""), r"[^/]*\z", 0)
