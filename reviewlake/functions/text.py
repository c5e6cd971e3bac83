"""Text rules as native Spark column expressions (no Python UDF on the hot path).

Every rule is a ``Column -> Column`` function built from ``regexp_replace`` / ``lower`` / ``trim`` /
higher-order array functions, so it stays inside whole-stage codegen and Catalyst can still push
filters below it. Character classes reproduce Python's Unicode ``\\w`` / ``\\s`` explicitly, because
Java's defaults are ASCII-only (they would delete Vietnamese letters).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Sequence
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------------------------
# Fixed values. These must equal the rules of the reviewed pipeline for results to match.
# --------------------------------------------------------------------------------------------

# Python's Unicode whitespace (str.isspace) and word characters, as Java/RE2-safe classes.
WS_CHARS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
WORD_CHARS = r"\p{L}\p{N}_"

# The satisfied phrase that slang words map to.
SATISFIED = "hài lòng"

# Review cleaner (whole words; "ok" followed by ASCII letters also maps to the satisfied phrase).
REVIEW_SLANG: dict[str, str] = {
    "good": " hài lòng ",
    "god": " hài lòng ",
    "gud": " hài lòng ",
    "nice": " hài lòng ",
    "acepted": " hài lòng ",
    "ok": " hài lòng ",
    "k": "không",
    "ko": "không",
    "kg": "không",
    "kh": "không",
    "khg": "không",
    "khog": "không",
    "khong": "không",
    "aps": "ứng dụng",
    "sp": "sản phẩm",
    "iu": "yêu",
}
REVIEW_SLANG_OK_PREFIX = " hài lòng "

# Collapse cleaner: these whole words, "ok" and "ok" + word characters become the satisfied phrase.
COLLAPSE_OK_WORDS: tuple[str, ...] = ("ok", "oce", "good", "gud", "nice")

# Title repair: label -> keywords that trigger the repair (first hit wins; the action is per label).
TITLE_KEYWORDS: dict[str, tuple[str, ...]] = {
    "negative": ("hài lòng", "bình thường", "tốt", "tuyệt vời", "hay", "ổn"),
    "positive": ("không hài lòng", "k hài lòng", "ko hài lòng", "không tốt", "k tốt", "ko tốt",
                 "tạm được", "tạm ổn", "khá hài lòng", "thất vọng", "bình thường"),
    "neutral": ("hay", "hài lòng", "tốt"),
}
TITLE_NEGATIVE_PREFIX = "không "
TITLE_POSITIVE_DROP_WORDS: tuple[str, ...] = ("tạm", "khá", "thất vọng")
TITLE_POSITIVE_SWAP = ("thất vọng", "hài lòng")
TITLE_NEUTRAL_VALUE = "bình thường"

# Product-name cleaner: substrings removed in this order.
NAME_PHRASES: tuple[str, ...] = ("hàng chính hãng", "chính hãng", "hàng nhập khẩu", "nhập khẩu",
                                 "chi tiết", "phân phối")

# Product-text cleaner: whole-word trade phrases removed.
PRODUCT_PHRASES: tuple[str, ...] = ("hàng chính hãng", "chính hãng", "chi tiết", "phân phối", "hãng")

# Literal two-character escapes left in API descriptions, replaced by a space (plus the double quote).
HTML_TEXT_BLANKED: tuple[str, ...] = ('"', "\\n", "\\x", "\\r")

# --------------------------------------------------------------------------------------------

WS_RUN = f"[{WS_CHARS}]+"
PUNCT = f"[^{WORD_CHARS}{WS_CHARS}]"
NOT_WORD = f"[^{WORD_CHARS}]"
STRIP_WS = f"^[{WS_CHARS}]+|[{WS_CHARS}]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_words(words: Iterable[str]) -> str:
    """Java regex matching any of ``words`` as whole words under Python's Unicode ``\\b``."""
    alt = "|".join(re.escape(w) for w in words)
    return f"(?<![{WORD_CHARS}])(?:{alt})(?![{WORD_CHARS}])"


def collapse_ws(c) -> Column:
    return F.regexp_replace(_c(c), WS_RUN, " ")


def drop_punct(c, repl: str = "") -> Column:
    return F.regexp_replace(_c(c), PUNCT, repl)


def strip_ws(c) -> Column:
    """Python ``str.strip()`` (all Unicode whitespace)."""
    return F.regexp_replace(_c(c), STRIP_WS, "")


def clean_base(c) -> Column:
    """Whitespace runs -> ' ', drop punctuation, lower, strip. Null stays null."""
    return F.trim(F.lower(drop_punct(collapse_ws(c))))


def clean_safe(c) -> Column:
    """N1 with null -> ''."""
    return F.coalesce(clean_base(c), F.lit(""))


def clean_boilerplate(c, sentence) -> Column:
    """Remove every exact occurrence of a boilerplate sentence (text or column), then N2."""
    s = F.lit(sentence) if isinstance(sentence, str) else sentence
    return clean_safe(F.replace(_c(c), s, F.lit("")))


def _map_words(t: Column, fn) -> Column:
    """Apply a word -> word rule to each space-separated word (empty words kept)."""
    return F.array_join(F.transform(F.split(t, " "), fn), " ")


def clean_review_slang(c, slang: dict[str, str] | None = None,
                       ok_prefix_value: str | None = REVIEW_SLANG_OK_PREFIX) -> Column:
    """N1 steps without strip; collapse doubled ASCII letters; whole-word slang map; strip.

    After punctuation removal only word characters and single spaces are left, so a whole word
    is exactly one space-separated token and the map is a per-token lookup.
    """
    slang = REVIEW_SLANG if slang is None else slang
    t = F.lower(drop_punct(collapse_ws(c)))
    t = F.regexp_replace(t, r"([A-Za-z])\1+", "$1")

    def rule(w: Column) -> Column:
        out = w
        # group by replacement so each becomes one hashed IN-set test
        by_value: dict[str, list[str]] = {}
        for k, v in slang.items():
            by_value.setdefault(v, []).append(k)
        expr = None
        for v, keys in by_value.items():
            cond = w.isin(keys)
            if ok_prefix_value is not None and v == ok_prefix_value:
                cond = cond | w.rlike("^ok[a-zA-Z]+$")
            expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
        return out if expr is None else expr.otherwise(w)

    return F.trim(_map_words(t, rule))


def clean_collapse(c, ok_words: Sequence[str] = COLLAPSE_OK_WORDS) -> Column:
    """Whitespace -> ' ', punctuation -> ' ', lower, collapse any doubled word character,
    whole-word ok/slang -> satisfied phrase, strip; null -> ''."""
    t = F.lower(drop_punct(collapse_ws(c), " "))
    t = F.regexp_replace(t, f"([{WORD_CHARS}])\\1+", "$1")
    t = _map_words(t, lambda w: F.when(w.isin(list(ok_words)) | w.rlike(f"^ok[{WORD_CHARS}]+$"),
                                       F.lit(SATISFIED)).otherwise(w))
    return F.coalesce(F.trim(t), F.lit(""))


def clean_product(c, sentence: str | None = None, phrases: Sequence[str] = PRODUCT_PHRASES) -> Column:
    """Falsy -> ''; drop boilerplate; N1 without strip; remove whole-word phrases; strip."""
    t = F.coalesce(_c(c), F.lit(""))
    if sentence:
        t = F.replace(t, F.lit(sentence), F.lit(""))
    t = F.lower(drop_punct(collapse_ws(t)))
    if phrases:
        t = F.regexp_replace(t, whole_words(phrases), "")
    return F.trim(t)


def clean_name(c, phrases: Sequence[str] = NAME_PHRASES) -> Column:
    """Lower, strip, drop punctuation, then substring removal of phrases in order (no final strip)."""
    t = drop_punct(strip_ws(F.lower(_c(c))))
    for p in phrases:
        t = F.replace(t, F.lit(p), F.lit(""))
    return t


def label_from_rating(c) -> Column:
    """P25: integer rating -> sentiment label (null and anything else -> Unknown)."""
    c = _c(c)
    return (F.when(c.isin(1, 2), F.lit("negative"))
            .when(c == 3, F.lit("neutral"))
            .when(c.isin(4, 5), F.lit("positive"))
            .otherwise(F.lit("Unknown")))


def label_from_rating_str(c) -> Column:
    """String rating '1'..'5' -> sentiment label (null and anything else -> Unknown)."""
    c = _c(c)
    return (F.when(c.isin("1", "2"), F.lit("negative"))
            .when(c == "3", F.lit("neutral"))
            .when(c.isin("4", "5"), F.lit("positive"))
            .otherwise(F.lit("Unknown")))


def _contains_any(t: Column, words: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda k: F.contains(t, k))


def repair_title(title, rating, keywords: dict[str, Sequence[str]] | None = None) -> Column:
    """Clean the title (N5), then repair it against its rating label when a keyword occurs."""
    keywords = TITLE_KEYWORDS if keywords is None else keywords
    t = clean_collapse(title)
    label = label_from_rating_str(rating)
    positive = F.replace(F.regexp_replace(t, whole_words(TITLE_POSITIVE_DROP_WORDS), ""),
                         F.lit(TITLE_POSITIVE_SWAP[0]), F.lit(TITLE_POSITIVE_SWAP[1]))
    out = None
    actions = {
        "negative": F.concat(F.lit(TITLE_NEGATIVE_PREFIX), t),
        "positive": positive,
        "neutral": F.lit(TITLE_NEUTRAL_VALUE),
    }
    for lab, action in actions.items():
        words = keywords.get(lab)
        if not words:
            continue
        cond = (label == lab) & _contains_any(t, words)
        out = F.when(cond, action) if out is None else out.when(cond, action)
    return t if out is None else out.otherwise(t)


def strip_tags(c) -> Column:
    """Remove comments, script and style bodies and every tag."""
    t = F.regexp_replace(_c(c), r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?is)<script[^>]*>.*?</script\s*>", "")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style\s*>", "")
    return F.regexp_replace(t, r"(?s)<[^>]*>", "")


def _numeric_ref_overrides() -> dict[int, str]:
    """HTML numeric references that do not map to their code point, built by rule: 0 -> U+FFFD,
    13 -> CR, and 0x80-0x9F read as windows-1252 (undefined bytes stay themselves)."""
    table = {0x00: "\ufffd", 0x0D: "\r"}
    for b in range(0x80, 0xA0):
        try:
            table[b] = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


NUMERIC_REF_OVERRIDES = _numeric_ref_overrides()


def codepoint_char(n) -> Column:
    """Character of an HTML numeric reference: the overrides above, U+FFFD for surrogates and
    out-of-range values, '' for control and non-character code points, else the code point."""
    n = n.cast("long")
    out = None
    for k, ch in NUMERIC_REF_OVERRIDES.items():
        out = F.when(n == k, F.lit(ch)) if out is None else out.when(n == k, F.lit(ch))
    bad = n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    dropped = (n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F)
               | n.between(0xFDD0, 0xFDEF) | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE))
    return (out.when(bad, F.lit("\ufffd")).when(dropped, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def decode_entities(c) -> Column:
    """Decode character references in one left-to-right pass, as an HTML parser does (so
    ``&amp;lt;`` stays ``&lt;``): ``&name;`` for every name of HTML 5, ``&#NNN`` / ``&#xHH`` with or
    without ``;``, and the old names that may be written without ``;``. Unknown references stay."""
    names = F.from_json(F.lit(json.dumps({k.rstrip(";"): v for k, v in html5.items()})), "map<string,string>")
    legacy = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True))
    parts = F.split(_c(c), "&")

    def lookup(name: Column) -> Column:
        return F.try_element_at(names, name)

    def piece(p: Column) -> Column:
        # values used several times are bound once through one-element lambdas (an expression
        # referenced repeatedly inside a lambda would be re-evaluated each time)
        def with_refs(refs: Column) -> Column:
            semi, num, old = refs.getField("semi"), refs.getField("num"), refs.getField("old")
            digits = F.regexp_extract(num, r"[0-9a-fA-F]+", 0)
            code = F.when(num.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
            named = lookup(semi)
            return (F.when(named.isNotNull(), F.concat(named, F.substring(p, F.length(semi) + 2, 1 << 30)))
                    .when(num != "", F.concat(codepoint_char(code), F.substring(p, F.length(num) + 1, 1 << 30)))
                    .when(old != "", F.concat(lookup(old), F.substring(p, F.length(old) + 1, 1 << 30)))
                    .otherwise(F.concat(F.lit("&"), p)))
        refs = F.struct(F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*);", 1).alias("semi"),
                        F.regexp_extract(p, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0).alias("num"),
                        F.regexp_extract(p, f"^({legacy})", 1).alias("old"))
        return F.transform(F.array(refs), with_refs).getItem(0)

    joined = F.array_join(F.concat(F.slice(parts, 1, 1),
                                   F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), piece)), "")
    return F.when(_c(c).contains("&"), joined).otherwise(_c(c))


def html_text(c) -> Column:
    """HTML -> text; then double quote and literal \\n, \\x, \\r -> ' '; strip."""
    t = decode_entities(strip_tags(c))
    for s in HTML_TEXT_BLANKED:
        t = F.replace(t, F.lit(s), F.lit(" "))
    return strip_ws(t)


def html_text_each(c) -> Column:
    """Per array element: HTML -> text and literal \\n removed. Tags go in a pass of their own, so that
    the decoder sees a bound value (a lambda evaluates its argument wherever it is named)."""
    return F.transform(F.transform(_c(c), strip_tags), lambda x: F.replace(decode_entities(x), F.lit("\\n"), F.lit("")))


def tokenize(c) -> Column:
    """N11 (default mode): split on single spaces; null -> empty array."""
    return F.coalesce(F.split(_c(c), " "), F.array().cast("array<string>"))


def remove_stopwords(tokens, words: Sequence[str], case_sensitive: bool = False) -> Column:
    """Drop tokens found in the word list, keeping order and duplicates.

    ``isin`` with many literals becomes a hashed ``InSet`` test inside the lambda.
    """
    ws = list(dict.fromkeys(words if case_sensitive else (w.lower() for w in words)))
    if not ws:
        return _c(tokens)
    return F.filter(_c(tokens), lambda x: ~(x if case_sensitive else F.lower(x)).isin(ws))


def _accent_table() -> tuple[str, str]:
    """Rule-built translate table: Latin letters with marks -> base letter (plus d-stroke)."""
    src, dst = [], []
    ranges = [(0x00C0, 0x024F), (0x1E00, 0x1EFF)]
    for lo, hi in ranges:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = "".join(x for x in unicodedata.normalize("NFD", ch) if not unicodedata.combining(x))
            if len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    for ch, base in (("đ", "d"), ("Đ", "D")):
        src.append(ch)
        dst.append(base)
    return "".join(src), "".join(dst)


_ACCENT_FROM, _ACCENT_TO = _accent_table()


def strip_accents(c) -> Column:
    """Accent removal by a native ``translate`` (combining marks dropped as well)."""
    return F.regexp_replace(F.translate(_c(c), _ACCENT_FROM, _ACCENT_TO), r"\p{M}+", "")


def underscore(c) -> Column:
    """Spaces -> '_'."""
    return F.replace(_c(c), F.lit(" "), F.lit("_"))


def parse_bool(c) -> Column:
    """P20: 'true' in any case -> true, everything else (null included) -> false."""
    return F.coalesce(F.lower(_c(c)) == F.lit("true"), F.lit(False))


def tokenize_lexicon(c, lexicon: Sequence[str]) -> Column:
    """N11 (lexicon mode): greedy longest match of space-separated syllables against a user lexicon (entries with ``_`` or spaces); matched compounds are joined with ``_``.

    The one place a Python function is needed (a per-text greedy scan); it runs as an Arrow-batched
    pandas UDF. The lexicon is a bounded, user-supplied list shipped with the task.
    """
    lex = frozenset(" ".join(w.replace("_", " ").lower().split()) for w in lexicon if w and w.strip())
    longest = max((len(w.split(" ")) for w in lex), default=1)
    opening = frozenset(w.split(" ")[0] for w in lex if " " in w)      # syllables that start a compound

    @F.pandas_udf("array<string>")
    def _segment(s: pd.Series) -> pd.Series:
        out = []
        for text in s:
            if text is None:
                out.append([])
                continue
            syl = text.split(" ")
            i, res = 0, []
            while i < len(syl):
                for n in range(min(longest, len(syl) - i) if syl[i].lower() in opening else 1, 1, -1):
                    if " ".join(syl[i:i + n]).lower() in lex:
                        res.append("_".join(syl[i:i + n]))
                        i += n
                        break
                else:
                    res.append(syl[i])
                    i += 1
            out.append(res)
        return pd.Series(out)

    from pyspark.sql import SparkSession

    from reviewlake.session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    return _segment(_c(c))
