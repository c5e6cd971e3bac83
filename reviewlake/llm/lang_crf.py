"""Language of the words of a text by a linear-chain conditional random field.

Labels are the learned languages. A word's features are its affixes (byte n-grams of 1 to 4 that
touch its start or end), its inner byte n-grams, and its entry in a lexicon of the words frequent
in a language; each has a weight per label. Transition weights between the labels of neighbouring
words are learned from training texts that are cut and joined across languages, as in
code-switched writing. Forward-backward gives each word's label probabilities; their mean over
the words with a letter is the text's, and the largest of these is the prediction and its score. ``label_runs`` gives the
stretches of a text in one language, word by word.

Long texts are cut into segments whose transfer matrices are multiplied, so the exact messages of
all segments are computed side by side; nothing is cut off.

The model is fitted on the driver on a bounded sample: at most ``train_docs`` labelled rows of each
language, the first by a hash of the id; every row is predicted, where it lies, without a shuffle.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or when nothing
could be learned. A row with a null id is not learned from and not held out. Repeated rows are
predicted alike. Extra columns are ignored. Lexicon and n-grams lower-case A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.blocks import mix64, releasing, slices, utf8, words
from reviewlake.operators.joins import broadcast_if_small

#: Labelled rows of each language that the model is fitted on, at most.
TRAIN_DOCS = 200
#: Words of each of these rows that are fitted on, at most (a bound of the fit; prediction reads all).
TRAIN_WORDS = 1500
HASHES = 1 << 17
ORDERS = (1, 2, 3, 4)
LEXICON = 400
ROUNDS = 40
SEGMENT = 64
BLOCK_BYTES = 1 << 20
UNKNOWN = "und"


@dataclass
class Model:
    """Weights of features by label, of transitions, and the lexicon's word hashes (ascending)."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray


def word_features(w, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a block: (word position -> distinct word), feature ids, their word, has a letter."""
    hashes = w.hashes()
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = w.starts[first], w.ends[first]
    size = ends - starts + 2                                        # with a mark at either end
    offset = np.append(0, np.cumsum(size))
    of = np.repeat(np.arange(len(first)), size)
    at = np.arange(offset[-1]) - offset[of]
    marks = (at == 0) | (at == size[of] - 1)
    source = np.minimum(np.maximum(starts[of] + at - 1, 0), max(len(w.data) - 1, 0))
    byte = np.where(marks, np.where(at == 0, 1, 2), w.data[source] if len(w.data) else 0).astype(np.uint64)
    raw = byte.astype(np.uint8)
    letter = ~marks & ((raw >= 128) | ((raw >= 97) & (raw <= 122)))
    ids, owner = [], []
    h = np.zeros(len(byte), dtype=np.uint64)
    for n in ORDERS:
        if len(byte) < n:
            break
        h = h[:len(byte) - n + 1] * np.uint64(257) + byte[n - 1:]
        inside = at[:len(h)] + n <= size[of[:len(h)]]
        ids.append((mix64(h[inside] * np.uint64(8) + np.uint64(n)) % np.uint64(HASHES)).astype(np.int64))
        owner.append(of[:len(h)][inside])
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, distinct), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[place] == distinct)
        ids.append(HASHES + place[known])
        owner.append(known)
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    has_letter = np.bincount(of[letter], minlength=len(first)) > 0
    return inverse, ids, owner, has_letter


def _sums(weights: np.ndarray, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the weight rows of each owner."""
    out = np.empty((n, weights.shape[1]), dtype=np.float32)
    for label in range(weights.shape[1]):
        out[:, label] = np.bincount(owner, weights=weights[ids, label], minlength=n)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (x @ np.ones((x.shape[-1],) * 2, dtype=x.dtype))        # faster than a sum over a short axis


def marginals(emission: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word, for consecutive sequences of the given numbers of words.

    Second: the forward messages, i.e. the label probabilities given the words so far.
    """
    n_labels = emission.shape[1]
    t = np.exp(transitions - transitions.max()).astype(np.float32)
    e = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    n_segments = -(-counts // SEGMENT)
    total = int(n_segments.sum())
    if not total:
        return (np.zeros((0, n_labels), dtype=np.float32),) * 2
    sequence = np.repeat(np.arange(len(counts)), n_segments)
    before = np.cumsum(n_segments) - n_segments
    nth = np.arange(total) - before[sequence]
    start = (np.cumsum(counts) - counts)[sequence] + nth * SEGMENT
    length = np.minimum(counts[sequence] - nth * SEGMENT, SEGMENT)
    at = start[:, None] + np.arange(SEGMENT)
    live = np.arange(SEGMENT) < length[:, None]
    ee = np.where(live[..., None], e[np.minimum(at, len(e) - 1)], np.float32(1))

    alpha0 = np.full((total, n_labels), 1 / n_labels, dtype=np.float32)         # before each segment
    beta1 = np.ones((total, n_labels), dtype=np.float32)                        # after each segment
    long = np.flatnonzero(n_segments[sequence] > 1)
    if len(long):
        transfer = np.tile(np.eye(n_labels, dtype=np.float32), (len(long), 1, 1))
        for i in range(SEGMENT):
            moved = (transfer @ t) * ee[long, i, None, :]
            moved /= moved.max(axis=(1, 2), keepdims=True)
            transfer = np.where(live[long, i, None, None], moved, transfer)
        place = np.full(total, -1)
        place[long] = np.arange(len(long))
        for step in range(1, int(nth.max()) + 1):
            own = np.flatnonzero(nth == step)
            alpha0[own] = _unit(np.einsum("ij,ijk->ik", alpha0[own - 1], transfer[place[own - 1]]))
        last = n_segments[sequence] - 1 - nth
        for step in range(1, int(nth.max()) + 1):
            own = np.flatnonzero(last == step)
            beta1[own] = _unit(np.einsum("ijk,ik->ij", transfer[place[own + 1]], beta1[own + 1]))
    alphas = np.empty((total, SEGMENT, n_labels), dtype=np.float32)
    a = alpha0
    for i in range(SEGMENT):
        a = np.where(live[:, i, None], _unit((a @ t) * ee[:, i]), a)
        alphas[:, i] = a
    forward = alphas[live]
    b = beta1
    for i in range(SEGMENT - 1, -1, -1):
        alphas[:, i] *= b
        b = np.where(live[:, i, None], _unit((ee[:, i] * b) @ t.T), b)
    return _unit(alphas[live]), forward                 # segments and their words are in order


def _switched(labels: np.ndarray, counts: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of training sequences: texts cut into short runs, dealt anew, and joined."""
    rng = np.random.default_rng(seed)
    first = np.cumsum(counts) - counts
    cut = []
    for start, n in zip(first, counts, strict=True):
        while n > 0:
            size = min(int(rng.geometric(1 / 24)), n)
            cut.append((start, size))
            start, n = start + size, n - size
    order = rng.permutation(len(cut))
    position = np.concatenate([np.arange(cut[i][0], cut[i][0] + cut[i][1]) for i in order]) if cut else np.zeros(0, int)
    n_full = -(-len(position) // SEGMENT)
    sizes = np.full(n_full, SEGMENT)
    if n_full:
        sizes[-1] = len(position) - SEGMENT * (n_full - 1)
    return position, sizes


def fit(texts: list[str], langs: list[str], rounds: int = ROUNDS, seed: int = 5) -> Model:
    """Maximum conditional likelihood by adaptive gradient steps, on labelled texts."""
    names = sorted(set(langs))
    w = words(pa.array(texts, pa.string()), lower=True)
    counts = np.minimum(w.counts, TRAIN_WORDS)
    # Of a longer text, words drawn evenly over all of it.
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    use = np.repeat(w.first[:-1], counts) + at * np.repeat(w.counts, counts) // np.repeat(counts, counts)
    label = np.repeat(np.array([names.index(x) for x in langs], dtype=np.int64), counts)
    hashes = w.hashes()[use]
    lexicon = []
    for i in range(len(names)):
        value, times = np.unique(hashes[label == i], return_counts=True)
        lexicon.append(value[np.lexsort((value, -times))][:LEXICON])
    lexicon = np.unique(np.concatenate(lexicon)) if names else np.zeros(0, dtype=np.uint64)
    n = len(names)
    model = Model(names, np.zeros((HASHES + len(lexicon), n), dtype=np.float32), np.zeros((n, n)), lexicon)
    if n < 2 or not len(use):
        return model
    inverse, ids, owner, _ = word_features(w, lexicon)
    n_distinct = int(inverse.max()) + 1
    position, sizes = _switched(label, counts, seed)
    word, y = inverse[use][position], label[position]
    truth = np.eye(n, dtype=np.float64)[y]
    inner = np.ones(len(position), dtype=bool)
    inner[np.cumsum(sizes) - sizes] = False
    pairs = np.zeros((n, n))
    np.add.at(pairs, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    step_w, step_t = np.full_like(model.weights, 1e-3), np.full((n, n), 1e-3)
    for _ in range(rounds):
        emission = _sums(model.weights, ids, owner, n_distinct)[word]
        gamma, forward = (x.astype(np.float64) for x in marginals(emission, sizes, model.transitions))
        rest = truth - gamma
        by_word = np.stack([np.bincount(word, weights=rest[:, i], minlength=n_distinct) for i in range(n)], axis=1)
        grad = np.stack([np.bincount(ids, weights=by_word[owner, i], minlength=len(model.weights)) for i in range(n)],
                        axis=1) / len(position) - 1e-6 * model.weights
        step_w += grad ** 2
        model.weights = (model.weights + 0.3 * grad / np.sqrt(step_w)).astype(np.float32)
        # Expected transitions: the label before, given the label after, by the forward messages.
        joint = forward[np.flatnonzero(inner) - 1][:, :, None] * np.exp(model.transitions)
        joint *= (gamma[inner] / joint.sum(axis=1))[:, None, :]
        grad_t = (pairs - joint.sum(axis=0)) / max(pairs.sum(), 1)
        step_t += grad_t ** 2
        model.transitions = model.transitions + 0.3 * grad_t / np.sqrt(step_t)
    return model


def training_rows(docs: DataFrame, learn, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(text, lang) of at most ``train_docs`` rows of each language, picked by a hash of their id."""
    picked = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
           .withColumn("at", F.row_number().over(picked)).where(F.col("at") <= train_docs)
           .select(F.col("doc_id").alias("id"), F.col("lang").alias("label")).distinct())
    # Texts are not shuffled for these few rows: their measured ids go to the texts.
    return (docs.join(broadcast_if_small(ids), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("label")))
            .select("doc_id", "text", "lang").dropDuplicates(["doc_id", "lang"]).orderBy("doc_id", "lang"))


def _labelled(m: Model, w) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word of a block, and whether it has a letter."""
    inverse, ids, owner, letter = word_features(w, m.lexicon)
    emission = _sums(m.weights, ids, owner, int(inverse.max()) + 1)[inverse]
    return marginals(emission, w.counts, m.transitions)[0], letter[inverse]


def _label_task(model, text_at: int):
    """text_at: where the struct ``row`` holds the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array([*m.labels, UNKNOWN], dtype=object)
        flat = (pa.RecordBatch.from_arrays([b.column(0), pc.struct_field(b.column(0), [text_at])], ["row", "text"])
                for b in batches)
        for block in slices(flat, "text", BLOCK_BYTES):
            w = words(block.column("text"), lower=True)
            n_rows, n = block.num_rows, len(m.labels)
            mean = np.zeros((n_rows, n))
            if len(w.starts) and n:
                gamma, letter = _labelled(m, w)
                gamma, row = gamma * letter[:, None], w.row
                for i in range(n):
                    mean[:, i] = np.bincount(row, weights=gamma[:, i], minlength=n_rows)
                mean /= np.maximum(np.bincount(row, weights=letter, minlength=n_rows), 1)[:, None]
            best = mean.argmax(axis=1) if n else np.zeros(n_rows, dtype=int)
            score = np.clip(mean.max(axis=1), 0, 1) if n else np.zeros(n_rows)
            best = np.where(score > 0, best, n)
            fields = block.column("row").flatten()
            kept = [f for i, f in enumerate(fields) if block.schema.field("row").type.field(i).name != _DROPPED]
            names_kept = [f.name for f in block.schema.field("row").type if f.name != _DROPPED]
            yield pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(kept, names_kept), pa.array(names[best], pa.string()),
                 pa.array(score, pa.float64())], ["row", "lang_pred", "score"])
    return run


#: Field under which a text travels to the task when the result does not carry it.
_DROPPED = "text to label"


def predict(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score): ``row`` holds the carried columns of ``docs``, by default all."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    text = F.col("text").cast("string")
    spoken = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    columns = [F.col(f"`{c}`") for c in carry]
    out_type = docs.select(F.struct(*columns).alias("row")).schema["row"].dataType.simpleString()
    # A text without a letter needs no labelling; it is judged here and travels as it is.
    whole = docs.select(F.struct(*columns, F.when(spoken, text).alias(_DROPPED)).alias("row"))
    out = whole.mapInArrow(releasing(_label_task(spark.sparkContext.broadcast(model), len(carry))),
                           f"row {out_type}, lang_pred string, score double")
    return out


def _runs_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array(m.labels, dtype=object)
        for block in slices(batches, "text", BLOCK_BYTES):
            w = words(block.column("text"), lower=True)
            if not len(w.starts) or not len(names):
                continue
            gamma, letter = _labelled(m, w)
            spoken = np.flatnonzero(letter > 0)                     # words without a letter belong to no run's ends or score
            if not len(spoken):
                continue
            label, row = gamma[spoken].argmax(axis=1), w.row[spoken]
            new = np.ones(len(spoken), dtype=bool)
            new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(spoken)) - 1
            data, offsets = utf8(block.column("text"))
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))        # code points before each byte
            at, of = points[offsets], row[first]
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id").take(pa.array(of)), pa.array(points[w.starts[spoken[first]]] - at[of]),
                pa.array(points[w.ends[spoken[last]]] - at[of]), pa.array(names[label[first]], pa.string()),
                pa.array(last - first + 1), pa.array(np.add.reduceat(gamma[spoken, label], first) / (last - first + 1))],
                ["doc_id", "start", "stop", "lang", "n_words", "score"])
    return run


def label_runs(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, start, stop, lang, n_words, score): the stretches of each text in one language, as code-switched texts have.

    Every word with a letter (here also any other character beyond ASCII) gets its most probable label by forward-backward; a run is a longest stretch of such words with
    one label, from the first to the last of them in code points (end exclusive). The score is the mean probability of the label.
    Texts without a letter have no runs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(releasing(_runs_task(docs.sparkSession.sparkContext.broadcast(model))),
                           "doc_id long, start long, stop long, lang string, n_words long, score double")


def learn(docs: DataFrame, allowed, train_docs: int = TRAIN_DOCS) -> Model:
    """The model fitted on the rows that ``allowed`` (a Column) lets it learn from."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
    rows = training_rows(narrow, allowed, train_docs).collect()        # bounded: train_docs rows of each language
    return fit([r.text for r in rows], [r.lang for r in rows])


def learn_and_predict(docs: DataFrame, allowed, train_docs: int = TRAIN_DOCS, carry: list[str] | None = None) -> DataFrame:
    """Fit on the rows that ``allowed`` (a Column) lets it learn from, predict all: (row, lang_pred, score)."""
    return predict(docs, learn(docs, allowed, train_docs), carry)
