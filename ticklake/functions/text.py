"""Text column functions: cleaning, titles, whitespace, sentences, HTML.

Everything is a composition of ``regexp_replace`` / ``split`` / higher-order
array functions, so it runs inside the JVM with no Python UDF.  Python's
Unicode ``\\s`` and ``\\w`` are spelled out as explicit classes because Java's
``\\s`` / ``\\w`` are ASCII-only.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from .coerce import strip

ColLike = str | Column

# Python str.isspace() characters as a Java regex class body.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
WS_RUN = f"[{WS}]+"


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squash(c: ColLike) -> Column:
    """T4: ``" ".join(text.split())`` - runs of whitespace become one space, ends trimmed."""
    return F.btrim(F.regexp_replace(_c(c), WS_RUN, " "), F.lit(" "))


def clean_filing_text(c: ColLike) -> Column:
    """Collapse whitespace, tags -> space, characters other than word
    characters, whitespace and . , ! ? - -> space, collapse again.  NULL -> ''."""
    s = squash(F.coalesce(_c(c), F.lit("")))
    s = F.regexp_replace(s, r"<[^>]+>", " ")
    s = F.regexp_replace(s, rf"[^\p{{L}}\p{{N}}_{WS}.,!?\-]", " ")
    return squash(s)


def extract_title(c: ColLike, max_len: int = 200) -> Column:
    """First stripped line longer than 20 characters without a boilerplate
    phrase, cut to ``max_len``; else 'Press Release'."""
    lines = F.transform(F.split(F.coalesce(_c(c), F.lit("")), "\n"), lambda x: strip(x))

    def ok(x):
        cond = F.length(x) > 20
        for phrase in schemas.TITLE_BOILERPLATE:
            cond = cond & ~F.lower(x).contains(phrase)
        return cond

    first = F.get(F.filter(lines, ok), 0)
    return F.coalesce(F.substring(first, 1, max_len), F.lit(schemas.TITLE_DEFAULT))


SENTENCE_BREAK = rf"(?<=[.!?])[{WS}]+(?=[A-Z])"


def sentences(c: ColLike) -> Column:
    """T5: sentence split at whitespace between [.!?] and an upper-case letter;
    parts are stripped, empty parts dropped."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), SENTENCE_BREAK, -1)
    return F.filter(F.transform(parts, lambda x: strip(x)), lambda x: x != "")


def words(c: ColLike) -> Column:
    """Whitespace tokens (``text.split()``)."""
    s = squash(_c(c))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _named_references() -> Column:
    """All named references of HTML5 (the standard library's table) as a map."""
    table = sorted((name, char) for name, char in html5.items() if name.endswith(";"))
    return F.map_from_arrays(F.split(F.lit(" ".join(f"&{n}" for n, _ in table)), " "),
                             F.split(F.lit("\x01".join(c for _, c in table)), "\x01"))


def _control_characters() -> Column:
    """What the code points 0x80 to 0x9F of numeric references stand for
    (windows-1252, where it defines them)."""
    chars = [(i, bytes([i]).decode("cp1252", "replace")) for i in range(0x80, 0xA0)]
    return F.map_from_arrays(F.array(*[F.lit(i) for i, _ in chars]),
                             F.array(*[F.lit(chr(i) if c == "\ufffd" else c) for i, c in chars]))


def _numeric_character(ref: Column) -> Column:
    """The character of ``&#...;``; U+FFFD where there is none."""
    is_hex = F.lower(F.substring(ref, 3, 1)) == "x"
    digits = F.ltrim(F.when(is_hex, F.substring(ref, 4, 2**30)).otherwise(F.substring(ref, 3, 2**30)), F.lit("0"))
    digits = F.replace(digits, F.lit(";"), F.lit(""))
    fits = F.length(digits).between(1, 7)
    n = F.when(fits, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)).try_cast("bigint")
    valid = fits & n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, n).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(n.between(0x80, 0x9F), F.try_element_at(_control_characters(), n.cast("int"))).otherwise(char)


def html_unescape(c: ColLike) -> Column:
    """Decode all character references in one pass: names of the HTML5 table
    (unknown ones stay) and numbers (windows-1252 for 0x80 to 0x9F; U+FFFD for
    code points that do not exist)."""
    s = _c(c)
    names = _named_references()

    def char(ref):
        return F.when(ref.startswith("&#"), _numeric_character(ref)).otherwise(F.coalesce(F.try_element_at(names, ref), ref))

    chars = F.transform(F.regexp_extract_all(s, F.lit(_REFERENCE), 0), char)
    parts = F.split(s, _REFERENCE, -1)
    joined = F.array_join(F.zip_with(parts, F.concat(chars, F.array(F.lit(""))), lambda p, d: F.concat(p, d)), "")
    return F.when(s.contains("&"), joined).otherwise(s)


# FIXED VALUES: tags whose boundaries start a new text block.
BLOCK_TAGS = ("p", "div", "br", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6",
              "article", "section", "header", "footer", "nav", "title", "blockquote", "pre")


def html_to_text(c: ColLike) -> Column:
    """HTML page -> text blocks separated by blank lines.

    script/style/comments removed, block-level tag boundaries -> blank line,
    remaining tags removed, entities decoded, spaces inside a block collapsed."""
    s = _c(c)
    s = F.regexp_replace(s, r"(?is)<script\b.*?</script\s*>", " ")
    s = F.regexp_replace(s, r"(?is)<style\b.*?</style\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?i)</?(" + "|".join(BLOCK_TAGS) + r")\b[^>]*>", "\n\n")
    s = F.regexp_replace(s, r"<[^>]*>", "")
    s = html_unescape(s)
    s = F.regexp_replace(s, r"[ \t\x0B\f\r\xA0]+", " ")
    s = F.regexp_replace(s, r" ?\n ?", "\n")
    s = F.regexp_replace(s, r"\n{3,}", "\n\n")
    return F.btrim(s, F.lit(" \n"))
