"""Text functions over columns; no Python runs on the executors.

The regular expressions are fixed values: results depend on them to the letter.

White space is the ASCII kinds, U+00A0 and U+FEFF; ends lose all of Unicode's space separators. Lengths and cuts count code points. A null gives a null.
"""

from __future__ import annotations

from string import ascii_lowercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V

WS = r"[\t\n\x0B\f\r \x{a0}\x{feff}]"
NOT_WS = r"[^\t\n\x0B\f\r \x{a0}\x{feff}]"
CJK = r"\x{4e00}-\x{9fff}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{ac00}-\x{d7a3}"
CJK_MORE = r"\x{3400}-\x{4dbf}\x{f900}-\x{faff}"
#: Unicode's space separators.
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
TOKEN = rf"[{CJK}{CJK_MORE}]|[^\t\n\x0B\f\r \x{{a0}}\x{{feff}}{CJK}{CJK_MORE}]+"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (a lambda over the bound column): what a lambda captures is computed anew for each element."""
    return F.transform(F.array(value), body)[0]


def strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def trim_blanks(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def collapsed(c: Column) -> Column:
    return trim_blanks(F.regexp_replace(c, f"{WS}+", " "))


def strip_markup(c: Column) -> Column:
    """Tags become spaces, markdown signs go, white space collapses."""
    return collapsed(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"[*_~`#\[\]()!]", ""))


def normalize_title(c: Column) -> Column:
    return collapsed(F.regexp_replace(F.lower(strip_markup(c)), r"[^a-z0-9\t\n\x0B\f\r \x{a0}\x{feff}]", ""))


def split_title(title: Column, label: Column) -> tuple[Column, Column]:
    """(title, source) of 'Headline - Source'; the feed's label wins over the suffix."""
    pattern = rf"^(.*?){WS}+-{WS}+([^-]{{2,60}})$"
    clean = strip_markup(title)
    suffix = F.regexp_extract(clean, pattern, 2)
    hit = suffix != ""
    return F.when(hit, F.regexp_extract(clean, pattern, 1)).otherwise(clean), F.coalesce(F.nullif(label, F.lit("")), F.nullif(suffix, F.lit("")), F.lit("News source"))


def truncate_hint(c: Column, limit: int = V.HINT_CHARS) -> Column:
    clean = strip_markup(c)
    return F.when(F.length(clean) <= limit, clean).otherwise(F.concat(F.regexp_replace(F.substring(clean, 1, limit), rf"{WS}+{NOT_WS}*$", ""), F.lit("…")))


def title_tokens(c: Column) -> Column:
    """Distinct tokens of a title, in order: over two characters, no stop words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(strip_markup(c)), "[^a-z0-9]+", " ")), " ")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*V.TITLE_STOPWORDS)))


def claims(title: Column, hint: Column, terms: Column) -> Column:
    """The first five of the entities and the topic's terms that occur anywhere in title and hint."""
    wanted = F.array_distinct(F.concat(strings(V.CLAIM_ENTITIES), F.transform(terms, F.lower)))
    return let(F.lower(F.concat(title, F.lit(" "), hint)), lambda text: F.slice(F.filter(wanted, lambda t: F.contains(text, t)), 1, 5))


def html_text(c: Column) -> Column:
    """Readable text of a page: content-free elements and tags go, six entities are decoded (& first), runs of white space collapse."""
    out = F.regexp_replace(c, rf"(?is)<({'|'.join(V.DROPPED_TAGS)})[^>]*>.*?</\1>", " ")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&nbsp;", " ")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.regexp_replace(F.regexp_replace(out, r"[ \t\r\n]{2,}", " "), rf"^{WS}+|{WS}+$", "")


def main_body(text: Column) -> Column:
    """Paragraphs over 80 characters, else the first 500 characters."""
    parts = F.filter(F.transform(F.split(text, rf"\n{{2,}}|{WS}{{4,}}"), lambda p: F.trim(p)), lambda p: F.length(p) > 80)
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n\n")).otherwise(F.trim(F.substring(text, 1, 500)))


def page_lang(html: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(html, r"""(?i)<html[^>]+lang=["']([a-zA-Z]+)[a-zA-Z-]*["']""", 1)), F.lit(""))


def paywalled(html: Column, domain: Column) -> Column:
    low = F.lower(html)
    marks = [F.contains(low, F.lit(f'{a}="{m}"')) for m in V.PAYWALL_MARKS for a in ("class", "id")]
    hit = domain.isin(*V.CLOSED_DOMAINS) | html.rlike(r"""(?i)isAccessibleForFree["'\s]*:\s*["']?false""") | html.rlike(r"""(?i)og:article:access["'\s]*content=["']subscriber""")
    for m in marks:
        hit = hit | m
    return hit | (F.length(html_text(html)) < 200)


def space_words(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(f"{NOT_WS}+"), F.lit(0))).cast("long")


def tokens(c: Column) -> Column:
    """A CJK character or a run of other characters without white space."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def word_count(c: Column) -> Column:
    return F.size(tokens(c)).cast("long")


def trim_quote(c: Column, limit: int = V.QUOTE_WORDS) -> Column:
    return F.when(word_count(c) <= limit, c).otherwise(F.concat(F.array_join(F.slice(tokens(c), 1, limit), " "), F.lit("…")))


def gram_words(c: Column) -> Column:
    """Words for the verbatim screen: lower-cased, all but word characters, white space and four CJK ranges deleted.

    Text of ASCII characters alone, before or after the deletion, takes plainer expressions with the same result.
    """
    plain = lambda t: F.octet_length(t) == F.char_length(t)
    ascii_ = rf"[^{ascii_lowercase}{digits}_\t\n\x0B\f\r ]+"  # signs one by one are looked up in one table, ranges are tried in turn
    kept = lambda t: F.when(plain(t), F.regexp_replace(t, ascii_, "")).otherwise(F.regexp_replace(t, rf"[^a-z0-9_\t\n\x0B\f\r \x{{a0}}\x{{feff}}{CJK}]+", ""))
    cut = lambda t: F.when(plain(t), F.array_remove(F.split(t, r"[\t\n\x0B\f\r ]+"), "")).otherwise(tokens(t))
    return let(let(F.lower(c), kept), cut)


def word_grams(c: Column, n: int = V.GRAM_WORDS) -> Column:
    """Distinct n-grams of words, joined by spaces."""

    def grams(w: Column) -> Column:
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(let(gram_words(c), grams))


def gram_keys(c: Column, n: int = V.GRAM_WORDS) -> Column:
    """The n-grams of words as 128-bit keys, structs (a, b) of two hashes; one for each place, as distinct structs would be sought pair by pair."""

    def keys(w: Column) -> Column:
        def key(i: Column) -> Column:
            words = [F.get(w, i + k) for k in range(n)]
            return F.struct(F.xxhash64(*words).alias("a"), F.xxhash64(F.lit("second"), *words).alias("b"))

        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), key)).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))

    return let(gram_words(c), keys)
