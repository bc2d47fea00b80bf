"""Page text and tokens (G2, G3, F18, A2) as JVM-side string expressions.

The tokeniser is a documented approximation of a tree parser plus a word
tokeniser, built only from regex replace/split so it stays in codegen:

1. visible text: comments, ``<script>``/``<style>`` elements and every tag
   become a space (the title's text stays); a ``>`` inside a quoted attribute
   does not end a tag, ``<`` before anything but a name is text, and what
   nothing closes goes on to the end of the page;
2. named and numeric entities are decoded, each once (``&amp;lt;`` gives
   ``&lt;``); unknown names stay as they are;
3. ``,`` and ``:`` separate unless a digit follows (``1,000``, ``10:30``), and
   ``n't`` is a token of its own (``don't`` gives ``do``, ``n't``);
4. split on white space (all of Unicode's), quotes and punctuation;
5. keep a token only when its first character is an ASCII letter or digit
   (a token such as ``éclair`` is dropped whole, never cut to ``clair``);
6. strip ``'s``, ``'ll`` and their like and trailing ``.``/``'``, lower-case.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlstats.functions.urls import let

# Markup, scanned from left to right in one pass: a comment, a script or style
# element, or a tag. Each runs to the end of the page when nothing closes it, and
# every repeat is possessive, which Java matches in a loop: a tag of any length
# takes no stack, and no stretch of text is read more than once.
BLANK = r"[ \t\n\f\r]"
# The inside of a tag after its name: quotes count only as an attribute's value.
TAG_REST = rf"""[^>=]*+(?:={BLANK}*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
RAW_ELEMENT = "|".join(rf"<{e}(?:(?:{BLANK}|/){TAG_REST})?+(?:\z|>.*?(?:</{e}(?:(?:{BLANK}|/)[^>]*+)?+>|\z))" for e in ("script", "style"))
ANY_TAG = rf"<[A-Za-z/!?]{TAG_REST}(?:>|\z)"
INVISIBLE = rf"(?is){COMMENT}|{RAW_ELEMENT}"
MARKUP = rf"{INVISIBLE}|{ANY_TAG}"

# Entities: a name or a number between '&' and ';'.
ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
# The 252 names of HTML 4, with HTML 5's characters (from the standard library),
# and 'apos'; the no-break space is an ordinary one to a reader.
ENTITY_NAMES = {f"&{n};": html5[f"{n};"] for n in sorted(name2codepoint)} | {"&apos;": "'", "&nbsp;": " "}
# Numbers of C1 controls stand for the characters of Windows-1252, where it has any.
C1 = {n: c for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))}
REPLACEMENT = "\uFFFD"

# Token separators: all of Unicode's white space, quotes, and punctuation that never belongs to a word.
# The separators beyond ASCII are looked for in characters beyond ASCII only.
WIDE_SEPARATORS = (
    r"\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
    r"\x{00AB}\x{00BB}\x{2018}-\x{201F}\x{2039}\x{203A}"
)
SEPARATOR = rf"[\t\n\x0B\f\r ;@#$%&?!()\[\]{{}}<>\"*[\x{{0080}}-\x{{3000}}&&[{WIDE_SEPARATORS}]]]"
SEPARATORS = SEPARATOR + "++"
# ',' and ':' that separate: no digit follows. The next character is group 1.
COMMA_COLON = r"(?<![,:])[,:]++([^0-9]|$)"
# "n't" at the end of a word; groups: it, what follows.
NEGATION = r"(n't|N'T)([^A-Za-z0-9']|$)"
TOKEN_START = r"^[A-Za-z0-9]"
TRAILING = r"(?:'(?:[sSmMdD]|ll|LL|re|RE|ve|VE)[.']*|[.']+)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(hex_digits: Column) -> Column:
    """The character of a hexadecimal code point; U+FFFD where there is none."""
    n = F.conv(hex_digits, 16, 10).cast("int")
    plain = F.decode(F.unhex(F.lpad(hex_digits, 8, "0")), "UTF-32")
    c1 = F.element_at(F.array(*[F.lit(C1.get(i, REPLACEMENT)) for i in range(128, 160)]), n - 127)
    bad = (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    return F.when(bad, F.lit(REPLACEMENT)).when(n.between(128, 159), c1).otherwise(plain)


def entity_text(entity: Column) -> Column:
    """What one entity stands for; itself if the name is unknown."""
    names = F.create_map(*[F.lit(x) for pair in ENTITY_NAMES.items() for x in pair])
    decimal = F.hex(F.regexp_extract(entity, "([0-9]+);", 1).cast("bigint"))
    hexadecimal = F.regexp_extract(entity, "[xX]([0-9A-Fa-f]+);", 1)
    return (
        F.when(F.substring(entity, 2, 1) != "#", F.coalesce(F.try_element_at(names, entity), entity))
        .when(F.lower(F.substring(entity, 3, 1)) == "x", _code_point(hexadecimal))
        .otherwise(_code_point(decimal))
    )


def decode_entities(text) -> Column:
    """Every entity replaced once: the text between entities, zipped with what they stand for."""
    def decoded(t: Column) -> Column:
        between = F.split(t, ENTITY, -1)
        found = F.transform(F.regexp_extract_all(t, F.lit(ENTITY), 0), entity_text)
        joined = F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(t.contains("&"), F.array_join(joined, "")).otherwise(t)

    return let(_col(text), decoded)


def visible_text(html) -> Column:
    """The text a reader sees, tags replaced by spaces, entities decoded."""
    return decode_entities(F.regexp_replace(_col(html), MARKUP, " "))


def spaced(text) -> Column:
    """The text with separating commas and colons gone and ``n't`` set apart."""
    commas = lambda t: F.when(t.contains(",") | t.contains(":"), F.regexp_replace(t, COMMA_COLON, " $1")).otherwise(t)
    apart = lambda t: F.when(t.contains("n't") | t.contains("N'T"), F.regexp_replace(t, NEGATION, " $1$2")).otherwise(t)
    return let(let(_col(text), commas), apart)


def split_words(text) -> Column:
    """Raw pieces between separators (may hold empties and junk)."""
    return F.split(spaced(text), SEPARATORS, -1)


def _trimmed(r: Column) -> Column:
    """A word in lower case without what trails it; few words have a quote or a final period."""
    trails = r.endswith(".") | r.contains("'")
    return F.lower(F.when(trails, F.regexp_replace(r, TRAILING, "")).otherwise(r))


def clean_token(raw) -> Column:
    """F18 + lower-casing for one raw piece; null when it is not a word."""
    r = _col(raw)
    return F.when(r.rlike(TOKEN_START), _trimmed(r))


def tokens(text) -> Column:
    """Array of tokens of a plain text, duplicates kept, in order."""
    raw = F.filter(split_words(text), lambda x: x.rlike(TOKEN_START))
    return F.transform(raw, _trimmed)


def page_tokens(html) -> Column:
    """G3 over HTML."""
    return tokens(visible_text(html))


def token_count(text) -> Column:
    """A2: number of tokens of a plain text, without building the array.

    A token starts where a word character follows the start or a separator,
    so counting those starts equals ``size(tokens(text))``; null text gives 0.
    """
    starts = rf"(?:^|{SEPARATOR})[A-Za-z0-9]"
    return F.coalesce(F.regexp_count(spaced(text), F.lit(starts)), F.lit(0)).cast("long")


def page_token_count(html) -> Column:
    return token_count(visible_text(html))
