"""Text rules: native Spark expressions vs independent character-level Python statements."""

import random

import pytest
from pyspark.sql import functions as F

from reviewlake.functions import text as tx

# ---- independent statements of the rules, character by character -------------------------
# A word character is what Python calls alphanumeric, or '_'; whitespace is str.isspace().


def _word(ch):
    return ch.isalnum() or ch == "_"


def _squeeze_space(t):
    out, prev_space = [], False
    for ch in t:
        if ch.isspace():
            if not prev_space:
                out.append(" ")
            prev_space = True
        else:
            out.append(ch)
            prev_space = False
    return "".join(out)


def _punct(t, repl):
    return "".join(ch if (_word(ch) or ch.isspace()) else repl for ch in t)


def _dedupe_runs(t, keep):
    out = []
    for ch in t:
        if out and out[-1] == ch and keep(ch):
            continue
        out.append(ch)
    return "".join(out)


def _strip(t):
    i, j = 0, len(t)
    while i < j and t[i].isspace():
        i += 1
    while j > i and t[j - 1].isspace():
        j -= 1
    return t[i:j]


def _per_word(t, fn):
    return " ".join(fn(w) for w in t.split(" "))


def _drop_phrases(t, phrases):
    """Remove whole-word phrases scanning left to right (first listed phrase wins at a position)."""
    words = t.split(" ")
    out, i = [], 0
    while i < len(words):
        for ph in phrases:
            pw = ph.split(" ")
            if words[i:i + len(pw)] == pw:
                out.append("")
                i += len(pw)
                break
        else:
            out.append(words[i])
            i += 1
    return " ".join(out)


def py_base(t):
    return _strip(_punct(_squeeze_space(t), "").lower())


ASCII = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def py_slang(t):
    t = _punct(_squeeze_space(t), "").lower()
    t = _dedupe_runs(t, lambda ch: ch in ASCII)

    def word(w):
        if w in tx.REVIEW_SLANG:
            return tx.REVIEW_SLANG[w]
        if len(w) > 2 and w.startswith("ok") and all(c in ASCII for c in w[2:]):
            return tx.REVIEW_SLANG_OK_PREFIX
        return w
    return _strip(_per_word(t, word))


def py_collapse(t):
    if not isinstance(t, str):
        return ""
    t = _punct(_squeeze_space(t), " ").lower()
    t = _dedupe_runs(t, _word)
    ok = set(tx.COLLAPSE_OK_WORDS)
    t = _per_word(t, lambda w: tx.SATISFIED if (w in ok or (w.startswith("ok") and len(w) > 2)) else w)
    return _strip(t)


def py_product(t, sentence=None):
    if not t:
        return ""
    if sentence:
        t = t.replace(sentence, "")
    t = _punct(_squeeze_space(t), "").lower()
    return _strip(_drop_phrases(t, tx.PRODUCT_PHRASES))


def py_name(t):
    t = _punct(_strip(t.lower()), "")
    for p in tx.NAME_PHRASES:
        t = t.replace(p, "")
    return t


def py_label(r):
    return {"1": "negative", "2": "negative", "3": "neutral", "4": "positive", "5": "positive"}.get(r, "Unknown")


def py_title(title, rating):
    t = py_collapse(title)
    label = py_label(rating)
    words = tx.TITLE_KEYWORDS.get(label, ())
    if not any(k in t for k in words):
        return t
    if label == "negative":
        return tx.TITLE_NEGATIVE_PREFIX + t
    if label == "neutral":
        return tx.TITLE_NEUTRAL_VALUE
    return _drop_phrases(t, tx.TITLE_POSITIVE_DROP_WORDS).replace(*tx.TITLE_POSITIVE_SWAP)


HAND = [
    "", "!!!", "   ", "a - b", "a b", "été", "Tốt lắm!!", "goood", "okkkk", "OK.", "ok123",
    "okay nha", "k", "ko kg kh khg khog khong", "kk", "sp spa aps iu iuu", "1000 đ", "Ääpfel __x__",
    "hàng chính hãng chính hãng hãng", "chính hãng hãng chính hãng", "phân phối chi tiết hãngx",
    "hãng hãng hãng hãng", "tạm được, thất vọng", "khá khá tạm thất vọngx", "\tTab\nnew\r\nline\x0bvt\x1c",
    "Không hài lòng lắm", "bình thường thôi", "hay quá", "nice  good gud", "oce oke okee",
]

ALPHABET = list("abcdeghikmnoptuyk ") + list("áàảãạăắđêếôơưửữ") + ["ok", "k", "sp", " ", " ", "!", ",", "-",
                                                                      " ", "\t", "\n", "é", "1", "0", "_"]


def random_texts(n=300, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t) for i, t in enumerate(HAND + random_texts())]
    return rows, spark.createDataFrame(rows + [(len(rows), None)], "id int, t string")


def _collect(df, expr):
    return {r["id"]: r["v"] for r in df.select("id", expr.alias("v")).collect()}


@pytest.mark.parametrize("rule, py", [
    (tx.clean_base, py_base),
    (tx.clean_review_slang, py_slang),
    (tx.clean_collapse, py_collapse),
    (tx.clean_product, py_product),
    (tx.clean_name, py_name),
])
def test_rule_matches_python(texts, rule, py):
    rows, df = texts
    got = _collect(df, rule("t"))
    for i, t in rows:
        assert got[i] == py(t), (t, got[i], py(t))


def test_null_handling(texts):
    rows, df = texts
    null_id = len(rows)
    assert _collect(df, tx.clean_base("t"))[null_id] is None
    assert _collect(df, tx.clean_safe("t"))[null_id] == ""
    assert _collect(df, tx.clean_collapse("t"))[null_id] == ""
    assert _collect(df, tx.clean_product("t"))[null_id] == ""


def test_boilerplate(spark):
    df = spark.createDataFrame([(1, "Xin chào. Phí ship. Hết."), (2, None)], "id int, t string")
    got = _collect(df, tx.clean_boilerplate("t", "Phí ship."))
    assert got == {1: "xin chào hết", 2: ""}


def test_title_repair(spark):
    rows = []
    for title in ["Rất hài lòng", "Tạm được, thất vọng", "Hay quá", "sản phẩm tốt", "bình thường", None, "", "ok"]:
        for rating in ["1", "2", "3", "4", "5", "0", None, "Unknown"]:
            rows.append((len(rows), title, rating))
    df = spark.createDataFrame(rows, "id int, title string, rating string")
    got = {r["id"]: r["v"] for r in df.select("id", tx.repair_title("title", "rating").alias("v")).collect()}
    for i, title, rating in rows:
        assert got[i] == py_title(title, rating), (title, rating)


def test_labels(spark):
    df = spark.createDataFrame([(i, i if i < 7 else None) for i in range(8)], "id int, r int")
    got = _collect(df, tx.label_from_rating("r"))
    assert [got[i] for i in range(8)] == ["Unknown", "negative", "negative", "neutral", "positive", "positive",
                                          "Unknown", "Unknown"]
    got = _collect(df, tx.label_from_rating_str(F.col("r").cast("string")))
    assert got[3] == "neutral" and got[7] == "Unknown"


def test_html_text(spark):
    html = ('<!DOCTYPE html><html><head><title>T&amp;C</title><style>p{x:1}</style>'
            '<script>var a="</p>";</script></head><body><!-- c --><p>A &lt;b&gt; &quot;q&quot; '
            'x\\ny</p></body></html>')
    df = spark.createDataFrame([(1, html)], "id int, t string")
    assert _collect(df, tx.html_text("t"))[1] == "T&CA <b>  q  x y"


def test_html_text_each(spark):
    df = spark.createDataFrame([(1, ["<b>1</b>\\n", "a &amp; b"])], "id int, a array<string>")
    assert _collect(df, tx.html_text_each("a"))[1] == ["1", "a & b"]


def test_tokenize_and_stopwords(spark):
    df = spark.createDataFrame([(1, "Tôi  rất thích"), (2, None)], "id int, t string")
    toks = _collect(df, tx.tokenize("t"))
    assert toks == {1: ["Tôi", "", "rất", "thích"], 2: []}
    kept = _collect(df, tx.remove_stopwords(tx.tokenize("t"), ["tôi", "rất"]))
    assert kept[1] == ["", "thích"]


def test_lexicon_tokenizer(spark):
    df = spark.createDataFrame([(1, "tôi rất hài lòng với sản phẩm này"), (2, None)], "id int, t string")
    got = _collect(df, tx.tokenize_lexicon("t", ["hài_lòng", "sản phẩm", "với sản phẩm này tốt"]))
    assert got[1] == ["tôi", "rất", "hài_lòng", "với", "sản_phẩm", "này"]
    assert got[2] == []


def test_strip_accents(spark):
    df = spark.createDataFrame([(1, "Đường phố Hà Nội é")], "id int, t string")
    assert _collect(df, tx.strip_accents("t"))[1] == "Duong pho Ha Noi e"


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, "a b c", "True"), (2, None, "yes")], "id int, t string, b string")
    assert _collect(df, tx.underscore("t"))[1] == "a_b_c"
    assert _collect(df, tx.parse_bool("b")) == {1: True, 2: False}


def test_entities_single_pass(spark):
    import html
    cases = ["&#233;t&#xE9; &amp;lt; &#38;lt; &bogus; & a", "a&b", "&amp;&amp;", "x&#0;y&#xD800;", "&#39;&quot;",
             "&", "&&lt;", "no refs", "ver&amp", "&ampToned", "&ltfoo; &#65x &#x42", "&copyright &middot;",
             "&#99999999999999999999;"]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    got = _collect(df, tx.decode_entities("t"))
    for i, t in enumerate(cases):
        assert got[i] == html.unescape(t), (t, got[i])


def test_every_named_reference_is_decoded(spark):
    import html
    from html.entities import html5
    cases = [f"x&{name}y" for name in html5] + ["caf&eacute; &ndash; &hellip; 5&deg; &trade;", "&notit; &NotEqualTilde; &nbsp;"]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    got = _collect(df, tx.decode_entities("t"))
    # Names of more than one form (&notin; and &not) are decoded by their first full match, as the parser does.
    for i, t in enumerate(cases):
        if ";" in t:
            assert got[i] == html.unescape(t), (t, got[i])


def test_lexicon_of_long_entries(spark):
    df = spark.createDataFrame([(1, "x a b c d e y a b")], "id int, t string")
    assert _collect(df, tx.tokenize_lexicon("t", ["a_b_c_d_e", "a b"]))[1] == ["x", "a_b_c_d_e", "y", "a_b"]


def test_numeric_references_match_html_unescape(spark):
    import html
    nums = list(range(0, 0x200)) + [0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 0x1F600]
    cases = [f"a&#{n};b&#x{n:X}c" for n in nums]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    got = _collect(df, tx.decode_entities("t"))
    for i, t in enumerate(cases):
        assert got[i] == html.unescape(t), (t, got[i], html.unescape(t))
