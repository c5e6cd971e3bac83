"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Base findings are the leftmost non-overlapping matches of three patterns. The method then weighs
each candidate value (the values of base findings and generic high-variety tokens) by its
*ownership*: the number of distinct owners (sources) and distinct repositories (documents) that
hold its hash. A value that several owners share is a copied example; one that a single owner holds looks live,
in however many of its repositories it stands. Owner-specific generic tokens that overlap no base finding are added as
findings of kind ``live``; base findings always stay. Repositories are reported and decide nothing.

Hashes are counted with partial aggregation in each task (a hot value is combined before the
shuffle); texts are read once and never shuffled. Positions inside a text are running sums that are built by
doubling, and overlaps are found in one sorted pass, so m matches of a text cost m log m.

Defined results: null text counts as empty and has no findings; null owners count as one unnamed
owner; repeated rows are rows of their own, with one repository per doc_id; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage

# Kind, pattern, group that holds the value, fewest code points of that group. In this order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
#: A generic candidate: one long token; it must mix digits and letters and hold many distinct characters.
GENERIC = r"[A-Za-z0-9+/_-]{20,}"
MIN_DISTINCT = 10
MIN_DIGITS = 3
#: A value with at most this many owners is owner-specific.
MAX_OWNERS = 1

_SPAN = "struct<start:int,k:int,stop:int,kind:string,value:string>"


def running(values: Column, combine) -> Column:
    """Running totals of an array under ``combine``: after round r every element holds the 2^(r+1) up to it."""
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))

    def step(total: Column, r: Column) -> Column:
        back = F.pow(F.lit(2), r).cast("int")
        return F.transform(total, lambda v, i: F.when(i >= back, combine(v, F.get(total, i - back))).otherwise(v))
    return F.aggregate(rounds, values, step)


def findings(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches as (start, rank, end, kind, value) in code points, ends exclusive.

    The pieces between matches give the positions: a match ends where the pieces and matches up to it end.
    """
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.slice(between, F.lit(1), F.size(whole)).alias("between"), whole.alias("whole"), value.alias("value"))

    def placed(found: Column) -> Column:
        ends = running(F.transform(found, lambda x: F.length(x["between"]) + F.length(x["whole"])), lambda a, b: a + b)
        return F.zip_with(found, ends, lambda x, end: F.struct(
            (end - F.length(x["whole"])).alias("start"), F.lit(rank).alias("k"), end.alias("stop"), F.lit(kind).alias("kind"),
            x["value"].alias("value")))
    # Bound once per row through a one-element transform.
    every = F.transform(F.array(rows), placed).getItem(0)
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.rlike(pattern), F.filter(every, lambda x: F.length(x["value"]) >= least)).otherwise(none)


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others. All are sorted once: a span by its end, the others by their start;
    then a span overlaps one of those before it if the furthest end among them lies beyond its start."""
    nothing = F.lit(None).cast(_SPAN)
    marks = F.array_sort(F.concat(
        F.transform(spans, lambda x: F.struct(x["stop"].alias("at"), F.lit(0).alias("other"), F.lit(0).alias("stop"), x.alias("span"))),
        F.transform(others, lambda x: F.struct(x["start"].alias("at"), F.lit(1).alias("other"), x["stop"].alias("stop"), nothing.alias("span")))))

    def left(m: Column) -> Column:
        furthest = running(F.transform(m, lambda x: x["stop"]), lambda a, b: F.greatest(a, b))
        return F.filter(F.zip_with(m, furthest, lambda x, end: F.when((x["other"] == 0) & (end <= x["span"]["start"]), x["span"])),
                        lambda x: x.isNotNull())
    return F.when(F.size(spans) > 0, F.transform(F.array(marks), left).getItem(0)).otherwise(spans)


def _varied(value: Column) -> Column:
    letters = F.array_distinct(F.split(value, ""))
    return ((F.size(letters) >= MIN_DISTINCT) & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= MIN_DIGITS)
            & value.rlike("[A-Za-z]"))


def candidates(docs: DataFrame, owner_col: str = "source") -> DataFrame:
    """(row_id, doc_id, owner, base, generic): findings of each row; landed in the shared folder."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(*[findings(F.col("t"), i, *kind) for i, kind in enumerate(KINDS)])
    generic = F.filter(findings(F.col("t"), len(KINDS), "live", GENERIC, 0, 20), lambda x: _varied(x["value"]))
    out = (docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col(f"`{owner_col}`").cast("string").alias("owner"), text.alias("t"))
           .select("row_id", "doc_id", "owner", F.array_sort(base).alias("base"), generic.alias("generic")))
    return cut_lineage(out, "secret-candidates")


def ownership(values: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) of (hash, doc_id, owner) rows."""
    owners = values.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"))
    repositories = (values.groupBy("hash", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("hash")
                    .agg(F.count(F.lit(1)).alias("n_repositories")))
    return repositories.join(owners, "hash")


def scan(docs: DataFrame, owner_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added findings, numbers of owner-specific and copied values, and the
    most repositories that hold one of its owner-specific values."""
    rows = candidates(docs, owner_col)
    value = (rows.where((F.size("base") > 0) | (F.size("generic") > 0))
             .select("row_id", "doc_id", "owner", F.explode(F.concat("base", "generic")).alias("span"))
             .withColumn("hash", F.sha2(F.col("span.value"), 256)))
    owned = ownership(value.select("hash", "doc_id", "owner"))
    specific = F.col("n_owners") <= MAX_OWNERS
    live = (value.join(owned, "hash").groupBy("row_id")
            .agg(F.collect_list(F.when(specific & (F.col("span.k") == len(KINDS)), F.col("span"))).alias("added"),
                 F.count_if(specific).alias("n_owner_specific"), F.count_if(~specific).alias("n_copied"),
                 F.max(F.when(specific, F.col("n_repositories"))).alias("most_repositories")))
    none = F.array().cast(f"array<{_SPAN}>")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (rows.join(live, "row_id", "left")
            .select("doc_id", "base", apart(F.coalesce("added", none), F.col("base")).alias("live"),
                    zero("n_owner_specific"), zero("n_copied"), zero("most_repositories")))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each finding by start, then kind, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts by kind and the digest of the base findings."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k[0]) for k in KINDS],
                        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.concat("base", "live")).alias("spans"), "n_owner_specific", "n_copied", "most_repositories")
