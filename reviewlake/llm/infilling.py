"""Fill-in-the-middle transformation of whole texts.

A text is cut into units at most twice, and the middle part is moved to the end, between marks. The
units come from one match: ``fullmatch`` of ``(unit)*`` with the ``regex`` library keeps every
repetition of the group, so ``ends(1)`` gives the number of units and both cuts without a loop.

The draws of a document depend on its id and the seed alone (``sha256("<seed>:<doc_id>")``), so they
stay the same whatever the partitioning, and a lost task gives the same rows again.

Defined results: null text is empty; an empty text, and one that holds a mark, stays plain. A null
doc_id counts as one without digits, so all such rows draw alike. Rows that repeat a doc_id are
rows of their own. An empty table gives none. Extra columns are ignored. A task holds a block of
texts; the match of a text takes about 120 bytes a unit, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import slices

#: A unit: a word with the white space before it, or white space that ends the text.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Shares of texts that are rearranged, and of those in suffix-first order, in hundredths.
RATE, SUFFIX_FIRST = 50, 80
BLOCK_BYTES = 4 << 20


def _draw(number: int, seed: int) -> Column:
    """The number-th group of eight hexadecimal digits (from 1) of the digest of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 8 * number - 7, 8), 16, 10).cast("long")


def _cut_task(unit: str):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(rf"({unit})*")
        for block in slices(batches, "text", BLOCK_BYTES):
            out = []
            for row in zip(*(block.column(c).to_pylist() for c in ("form", "h1", "h2", "text")), strict=True):
                out.append(_arranged(units, *row))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)
    return run


def _arranged(units: regex.Pattern, form: str, h1: int, h2: int, text: str) -> tuple:
    """Number of units, form, code points of prefix and middle, and the text in its form."""
    ends = units.fullmatch(text).ends(1)
    if form == "plain":
        return len(ends), form, None, None, text
    first, last = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    a, b = (ends[i - 1] if i else 0 for i in (first, last))
    prefix, suffix = PREFIX + text[:a], SUFFIX + text[b:]
    return len(ends), form, a, b - a, (suffix + prefix if form == "spm" else prefix + suffix) + MIDDLE + text[a:b]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
                   unit: str = UNIT) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points), output (text).

    The unit has no capture groups, and units cover every text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text, marked = F.col("text"), F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    form = (F.when((text == "") | marked | (_draw(3, seed) % 100 >= rate), "plain")
            .when(_draw(4, seed) % 100 < suffix_first, "spm").otherwise("psm"))
    drawn = rows.select("doc_id", "text", form.alias("form"), _draw(1, seed).alias("h1"), _draw(2, seed).alias("h2"))
    return drawn.mapInArrow(_cut_task(unit), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text from its output and form alone. A mark starts and ends unlike any of its other letters,
    so cuts beside a mark make no second one."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
            .when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(output))
