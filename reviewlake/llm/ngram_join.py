"""Jaccard join on word shingles by token-combination prefixes.

Tokens are 64-bit hashes of five-word shingles. Tokens are ordered by the number of documents that
hold them. Of a document with n tokens a partner may lack at most t = n - ceil(0.8 n), so
two similar documents share a signature of their prefixes, which are extended until the
signatures can't all be destroyed by t missing tokens:

* a rare token is a signature by itself and stands one missing token;
* frequent tokens are dealt into small classes by hash; each pair of prefix tokens of one class is a
  signature, and a class of c prefix tokens stands c - 1 missing tokens. The number of classes follows
  the document's size level (powers of 1.25); documents write the signatures of their own
  level and the next, so that any two similar ones share a level;
* a token no other document holds needs no signature. A document with more than t of them has no partner.

Steps: documents with the same set become one class (by a 128-bit sum over its tokens). Each task
sends the tokens of its distinct sets, packed and sorted, to buckets by token; a bucket counts the
documents of each token and returns those held by two or more, as small numbers, to buckets of
documents. There the prefixes are cut. Documents that share a signature are first verified with
one leader (the one with the earliest signature); then every pair that lies in different components
and shares a signature early enough for sets of their two sizes (each document's prefix for partners
of one size is shorter than that for all) is verified by exact intersection. So no pair is lost,
and pairs inside a large group of copies are not written out.

Similar: 100 * intersection >= 80 * union. Defined results: null or empty text has no tokens and is
linked with nothing; fewer than five words are one token. Rows with a null doc_id take part, but
name no component; a component of only such rows has a null name. Rows that repeat a doc_id
are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.blocks import (
    deltas, mix64, ngrams, pack, range_hashes, records, releasing, releasing_group, runs, slices, spread, unpack, words,
)
from reviewlake.llm.components import components
from reviewlake.session import cut_lineage

SHINGLE = 5
#: Similar when 5 * intersection >= 4 * union (0.8).
NUM, DEN = 4, 5
#: A token of more documents than this is frequent.
FREQUENT = 64
BLOCK_BYTES = 4 << 20
#: Bytes of a block whose words are hashed at a time.
SET_BYTES = 1 << 20
#: Tokens that one bucket of tokens is meant to hold, and documents of one bucket of documents.
BUCKET_TOKENS = 1 << 20
BUCKET_DOCS = 4096
_LEVELS = 1.25 ** np.arange(1, 200)


def allowed(n):
    """How many of n tokens any similar document may lack."""
    return n - (NUM * n + DEN - 1) // DEN


def token_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token) of the distinct tokens of each text, by row and token, and the tokens of each row.

    The words and their order take many times the room of the tokens, so they are held for a part of the texts at a time.
    """
    parts, at = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))], 0
    for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text", SET_BYTES):
        row, token, n = _token_sets(part.column(0), shingle)
        parts.append((row + at, token, n))
        at += part.num_rows
    row, token, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    return row, token, n


def _token_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    w = words(column, lower=True)
    h = w.hashes()
    token, at = ngrams(h, w.first, shingle)
    row = np.searchsorted(w.first, at, side="right") - 1
    few = np.flatnonzero((w.counts > 0) & (w.counts < shingle))
    row = np.concatenate((row, few))
    token = np.concatenate((token, range_hashes(h, w.first[few], w.first[few + 1])))
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    row, token = row[new], token[new]
    return row, token, np.bincount(row, minlength=len(column))


def set_sums(row: np.ndarray, token: np.ndarray, n_rows: int) -> np.ndarray:
    """Two 64-bit sums over the tokens of each row; the same set gives the same sums."""
    out = np.zeros((2, n_rows), dtype=np.uint64)
    start, _ = runs(row)
    for i, salt in enumerate((0x51ED270B35A1C9F7, 0xC2B2AE3D27D4EB4F)):
        if len(start):
            out[i, row[start]] = np.add.reduceat(mix64(token ^ np.uint64(salt)), start)
    return out.view(np.int64)


def _sets_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in slices(batches, "text", BLOCK_BYTES):
        row, token, n = token_sets(block.column("text"))
        sums = set_sums(row, token, block.num_rows)
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("text_hash"), pa.array(n, pa.int64()),
                                          pa.array(sums[0]), pa.array(sums[1])], ["doc_id", "text_hash", "n", "s1", "s2"])


def _scatter_task(n_buckets: int):
    """Packed tokens of the distinct sets of a task, by bucket of token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for block in slices(batches, "text", BLOCK_BYTES):
            row, token, n = token_sets(block.column("text"))
            sums = set_sums(row, token, block.num_rows)
            node = block.column("node").to_numpy(zero_copy_only=False)
            surrogate = ~block.column("plain").to_numpy(zero_copy_only=False)
            node = np.where(surrogate, stand_in(sums[0], sums[1]), node)
            own = np.zeros(block.num_rows, dtype=bool)
            for i, key in enumerate(zip(sums[0].tolist(), sums[1].tolist(), strict=True)):
                if n[i] >= NUM and key not in seen:       # smaller sets are similar to the same set only
                    seen.add(key)
                    own[i] = True
            use = own[row]
            row, token = row[use], token[use]
            if not len(row):
                continue
            order = np.argsort(token, kind="stable")
            row, token = row[order], token[order]
            buckets, values = [], []
            for bucket, at in spread(token, n_buckets):
                rows, doc = np.unique(row[at], return_inverse=True)
                by = np.argsort(node[rows], kind="stable")
                place = np.empty(len(by), dtype=np.uint32)
                place[by] = np.arange(len(by), dtype=np.uint32)
                buckets.append(bucket)
                values.append(pack(deltas(token[at]), place[doc], deltas(node[rows][by]), n[rows][by].astype(np.uint32)))
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(values, pa.binary())], ["bucket", "packed"])
    return run


def stand_in(s1, s2):
    """A node's name where its doc_id doesn't name it: drawn from its set, below all others."""
    drawn = mix64(np.asarray(s1).view(np.uint64) + mix64(np.asarray(s2).view(np.uint64)))
    return -(np.int64(1) << np.int64(62)) - (drawn >> np.uint64(2)).view(np.int64)


def _count_bucket(n_doc_buckets: int):
    """Tokens held by two or more documents, with that number, to the buckets of their documents."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        token, doc, node, size = [], [], [], []
        for value in table.column("packed").to_pylist():
            t, d, i, n = unpack(value)
            doc.append(d.astype(np.int64) + sum(map(len, node)))
            token.append(np.cumsum(t, dtype=np.uint64))
            node.append(np.cumsum(i, dtype=np.int64))
            size.append(n)
        token, doc, node, size = (np.concatenate(x) for x in (token, doc, node, size))
        # A repeated row was sent by each task that read it, always with the same set: one of them counts.
        once = np.zeros(len(node), dtype=bool)
        once[np.unique(node, return_index=True)[1]] = True
        token, doc = token[once[doc]], doc[once[doc]]
        order = np.argsort(token, kind="stable")
        start, times = runs(token[order])
        many = times > 1
        number = (np.int64(key[0].as_py()) << np.int64(32)) + np.repeat(np.cumsum(many) - 1, times)
        keep = np.repeat(many, times)
        doc, number, times = doc[order][keep], number[keep], np.repeat(times, times)[keep]
        target = (mix64(node.view(np.uint64)) >> np.uint64(20)) % np.uint64(n_doc_buckets)
        by = np.lexsort((number, node[doc], target[doc]))
        doc, number, times = doc[by], number[by], times[by]
        start, length = runs(target[doc])
        buckets, values = [], []
        for s, z in zip(start, length, strict=True):
            own = slice(s, s + z)
            first, count = runs(node[doc[own]])
            docs = doc[own][first]
            buckets.append(int(target[docs[0]]))
            values.append(pack(deltas(node[docs]), size[docs], count.astype(np.uint32),
                               (number[own] & np.int64(0xFFFFFFFF)).astype(np.uint32), times[own].astype(np.uint32)))
        return pa.table({"docs": pa.array(buckets, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(buckets), pa.int32()),
                         "packed": pa.array(values, pa.binary())})
    return run


def frequent_signatures(tokens: np.ndarray, stands: int, budget: int, n: int, level: int) -> tuple[list[int], list[int]]:
    """Pairs of frequent tokens of one class for the shortest run of tokens that stands ``budget`` losses.

    Second: the losses that the run up to each pair's later token stands; ``stands`` come before the first.
    """
    n_classes = max(1, round(n / (DEN * 3)))
    of = (mix64(tokens.view(np.uint64) + np.uint64(level)) % np.uint64(n_classes)).astype(np.int64)
    members: dict[int, list[int]] = {}
    out, losses = [], []
    for t, c in zip(tokens.tolist(), of.tolist(), strict=True):
        if stands >= budget:
            break
        before = members.setdefault(c, [])
        if before:
            stands += 1
            out += [(a, t) for a in before]
            losses += [stands] * len(before)
        before.append(t)
    if not out:
        return [], []
    a, b = np.array(out, dtype=np.int64).view(np.uint64).T
    return mix64(mix64(a * np.uint64(2 * level + 3)) + b).view(np.int64).tolist(), losses


def signatures(n: int, tokens: np.ndarray, times: np.ndarray, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray] | None:
    """Signatures of a document of n tokens, of which the given ones, rarest first, are shared.

    Second: for each signature, how many losses the shortest prefix that holds it stands. A partner
    that leaves the document fewer than that many losses shares an earlier signature with it.
    """
    budget, stands = int(allowed(n)) + 1, n - len(tokens)
    if stands >= budget:
        return None
    rare = int(np.searchsorted(times, frequent, side="right"))
    use = min(rare, budget - stands)
    out, losses = mix64(tokens[:use].view(np.uint64)).view(np.int64).tolist(), list(range(stands + 1, stands + use + 1))
    stands += use
    if stands < budget:
        own = int(np.searchsorted(_LEVELS, n, side="right"))
        for level in (own, own + 1):
            # The classes of a level, not of a document: both partners must deal tokens alike.
            more, lost = frequent_signatures(tokens[rare:], stands, budget, int(1.25 ** level), level)
            out, losses = out + more, losses + lost
    out, first = np.unique(np.array(out, dtype=np.int64), return_index=True)
    return out, np.array(losses, dtype=np.int32)[first]


def _prefix_bucket(frequent: int):
    def run(table: pa.Table) -> pa.Table:
        node, size, held, token, times = [], [], [], [], []
        for bucket, value in zip(table.column("bucket"), table.column("packed"), strict=True):
            i, n, count, number, t = unpack(value.as_py())
            node.append(np.cumsum(i, dtype=np.int64))
            size.append(n)
            held.append(count)
            token.append((np.int64(bucket.as_py()) << np.int64(32)) + number.astype(np.int64))
            times.append(t)
        # Of each token only its document's number is kept; names and sizes are kept once for each document.
        node, first, doc = np.unique(np.concatenate(node), return_index=True, return_inverse=True)
        size, doc = np.concatenate(size)[first], np.repeat(doc.astype(np.int32), np.concatenate(held))
        token = np.concatenate(token)
        times = np.concatenate(times)
        order = np.lexsort((token, times, doc))
        rows = []
        ends = np.cumsum(np.bincount(doc, minlength=len(node)))
        for i, end in enumerate(ends):
            n, own = int(size[i]), order[ends[i - 1] if i else 0:end]
            found = signatures(n, token[own], times[own], frequent)
            if found is not None and len(found[0]):
                rows.append((int(node[i]), n, pack(deltas(np.sort(token[own]))), *found))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table({"node": pa.array(columns[0], pa.int64()), "n": pa.array(columns[1], pa.int64()),
                         "tokens": pa.array(columns[2], pa.binary()), "signatures": pa.array(columns[3], pa.list_(pa.int64())),
                         "losses": pa.array(columns[4], pa.list_(pa.int32()))})
    return run


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = [], []
        for row in records([batch]):
            x, y = (np.cumsum(unpack(row[c])[0]) for c in ("tokens_a", "tokens_b"))
            both = len(np.intersect1d(x, y, assume_unique=True))
            if DEN * both >= NUM * (row["n_a"] + row["n_b"] - both):
                a.append(row["a"])
                b.append(row["b"])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs whose sets are similar."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"tokens_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(releasing(_verify_task), "a long, b long")


def _leader_pairs(signed: DataFrame) -> DataFrame:
    """Each document with one leader: of the leaders of its signatures, the one with the earliest signature."""
    rank = F.struct((F.col("loss") / F.col("n")).alias("part"), F.col("node"))
    leaders = (signed.groupBy("signature").agg(F.min(rank).alias("leader"), F.count(F.lit(1)).alias("size"))
               .where("size > 1").select(F.col("signature").alias("s"), "leader"))
    return (signed.join(leaders, F.col("signature") == F.col("s")).groupBy("node").agg(F.min("leader").alias("leader"))
            .select(F.col("node").alias("a"), F.col("leader.node").alias("b")).where("a <> b"))


def _possible(n: str, m: str, loss_n: str, loss_m: str):
    """Whether similar sets of n and m tokens may have this signature as an early one of both.

    Similar sets share at least ceil(NUM (n + m) / (NUM + DEN)) tokens, so a set of n lacks at most n
    less that many; of their common signatures one lies in the prefixes that stand just more.
    """
    least = F.floor((NUM * (F.col(n) + F.col(m)) + NUM + DEN - 1) / (NUM + DEN))
    return (F.col(loss_n) <= F.col(n) - least + 1) & (F.col(loss_m) <= F.col(m) - least + 1)


def _open_pairs(signed: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs that share an early signature and lie in different components."""
    named = (signed.join(labels, "node", "left")
             .select("signature", "node", "n", "loss", F.coalesce("component", "node").alias("component")))
    mixed = lambda rows: rows.join(
        rows.groupBy("signature").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
        .where("c0 <> c1").select(F.col("signature").alias("s")), F.col("signature") == F.col("s"), "left_semi")
    named = cut_lineage(mixed(named), "open-signatures")
    # Sizes at hand for each signature, with the earliest place of each.
    sizes = named.groupBy("signature", "n").agg(F.min("loss").alias("least")).select(
        F.col("signature").alias("s"), F.col("n").alias("m"), "least")
    named = named.join(sizes, (F.col("signature") == F.col("s")) & _possible("n", "m", "loss", "least"), "left_semi")
    named = cut_lineage(mixed(named), "open-signatures")
    side = lambda c: named.select("signature", *[F.col(x).alias(f"{x}_{c}") for x in ("node", "n", "loss", "component")])
    return (side("a").join(side("b"), "signature")
            .where((F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
                   & _possible("n_a", "n_b", "loss_a", "loss_b"))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())


def join_groups(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id, set_size, group_key, text_hash).

    set_size counts the rows with the same set; group_key tells components apart, also those without a name.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = cut_lineage(own.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        releasing(_sets_task), "doc_id long, text_hash long, n long, s1 long, s2 long"), "sets")
    total = found.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows")).first()

    # A doc_id names its node unless it is null or names rows with different sets.
    unclear = cut_lineage(found.groupBy("doc_id").agg(F.min("s1").alias("a"), F.max("s1").alias("b"), F.min("s2").alias("c"),
                                                      F.max("s2").alias("d"))
                          .where("doc_id IS NULL OR a <> b OR c <> d OR doc_id < 0").select(F.col("doc_id").alias("u"))
                          .withColumn("unclear", F.lit(True)), "unclear")
    if unclear.isEmpty():
        named = lambda rows: rows.withColumn("plain", F.lit(True))
    else:
        named = lambda rows: (rows.join(unclear, F.col("doc_id").eqNullSafe(F.col("u")), "left")
                              .withColumn("plain", F.col("unclear").isNull()).drop("u", "unclear"))
    n_buckets = max(1, -(-(total.tokens or 0) // BUCKET_TOKENS))
    n_doc_buckets = max(1, -(-total.rows // BUCKET_DOCS))
    packed = named(own).select(F.coalesce("doc_id", F.lit(0)).alias("node"), "plain", "text").mapInArrow(
        releasing(_scatter_task(n_buckets)), "bucket int, packed binary")
    shared = packed.groupBy("bucket").applyInArrow(releasing_group(_count_bucket(n_doc_buckets)), "docs int, bucket int, packed binary")
    prefixes = _prefix_bucket(frequent)
    sets = cut_lineage(shared.groupBy("docs").applyInArrow(
        releasing_group(lambda _, table: prefixes(table)), "node long, n long, tokens binary, signatures array<long>, losses array<int>"), "prefixes")

    # Of the nodes of one class (a set sent by several tasks) one goes on.
    classes = found.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("set_size"))
    nodes = _with_node(named(found.where("n > 0")))
    members = cut_lineage(nodes.join(sets.select(F.col("node").alias("i")).distinct(), F.col("node") == F.col("i"), "left_semi")
                          .select("node", "n", "s1", "s2").distinct(), "members")
    one = members.groupBy("n", "s1", "s2").agg(F.min("node").alias("node"))
    one = cut_lineage(one.join(classes, ["n", "s1", "s2"]).select("node", "low", "n", "s1", "s2"), "classes")
    sets = sets.join(one.select("node"), "node", "left_semi")
    signed = cut_lineage(sets.select("node", "n", F.inline(F.arrays_zip("signatures", "losses")))
                         .withColumnsRenamed({"signatures": "signature", "losses": "loss"}), "signatures")

    links = cut_lineage(verified(_leader_pairs(signed), sets), "links")
    labels = components(links)
    more = cut_lineage(verified(_open_pairs(signed, labels), sets), "links")
    labels = components(links.unionByName(more))
    lows = (labels.join(one, "node").groupBy("component").agg(F.min("low").alias("component_low")))
    named_classes = (one.join(labels, "node").join(lows, "component")
                     .select(F.col("n").alias("cn"), F.col("s1").alias("c1"), F.col("s2").alias("c2"), "component_low", "component"))
    named_classes = (classes.join(named_classes, (F.col("n") == F.col("cn")) & (F.col("s1") == F.col("c1"))
                                  & (F.col("s2") == F.col("c2")), "left")
                     .select(F.col("n").alias("kn"), F.col("s1").alias("k1"), F.col("s2").alias("k2"), "set_size",
                             F.coalesce("component_low", "low").alias("low"), F.col("component").alias("label")))
    return (found.join(named_classes, (F.col("n") == F.col("kn")) & (F.col("s1") == F.col("k1"))
                       & (F.col("s2") == F.col("k2")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("set_size", F.lit(1)).alias("set_size"),
                    F.coalesce(F.col("label").cast("string"), F.concat_ws("/", "n", "s1", "s2")).alias("group_key"), "text_hash"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one of each group stays: the smallest doc_id.

    Rows without tokens are in no group and stay. Of rows that repeat doc_id and text one stays.
    """
    groups = cut_lineage(join_groups(docs, **how), "groups")
    chosen = (groups.where("n_shingles > 0").groupBy("group_key")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("c"))
              .select("c.doc_id", "c.text_hash", F.lit(True).alias("one")))
    empty = groups.where("n_shingles = 0").select("doc_id", "text_hash").distinct().withColumn("one", F.lit(False))
    stays = chosen.unionByName(empty).select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "one")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"))
    met = own.join(stays, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")))
    if groups.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        return met.select("row.*")                  # no row is repeated, so no text needs another shuffle
    first = Window.partitionBy("doc_id", "text_hash").orderBy("h")
    return met.withColumn("at", F.row_number().over(first)).where("at = 1 OR NOT one").select("row.*")


def _with_node(rows: DataFrame) -> DataFrame:
    """Adds the node's name, as the tasks that send tokens name it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s1, s2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("s1", "s2"))
            doc = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            plain = b.column("plain").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(plain, doc, stand_in(s1, s2))), b.column("n"), b.column("s1"),
                                              b.column("s2")], ["node", "n", "s1", "s2"])
    return rows.select("doc_id", "n", "s1", "s2", "plain").mapInArrow(releasing(run), "node long, n long, s1 long, s2 long")
