"""Language identification by a linear-chain conditional random field (operator 8).

Words are labelled one by one, so code-switched text keeps its parts: affixes,
character n-grams and a lexicon score each word, learned transitions tie neighbours,
and forward-backward gives each word's label probabilities over the whole text. A
document's language is the one with the most probability over its words.

The field is fitted in one task to a bounded sample of labelled texts, some of them joined
in pairs, so that switches of language are seen; transitions are learned from the exact
posteriors of neighbouring labels. Prediction runs over every word of every text in Arrow
batches. Chains are cut into stretches whose transfer matrices are multiplied first, so
long texts cost no more a word than short ones; a very long text is worked on part by
part, from both ends.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fit takes at most so many labelled texts, the first by a hash of the id, each whole.
MAX_TEXTS = 1_500
#: Longer texts aren't learned from; and no more characters in all.
MAX_TEXT_CHARS, MAX_CHARS = 400_000, 40_000_000
#: Every so many-th pair of texts is joined for learning.
JOIN_EVERY = 4
EPOCHS, RATE, DECAY = 2, 0.3, 1e-4
BUCKETS = 1 << 15
LEXICON = 400
UNKNOWN = "und"
#: Words in one stretch, and words worked on at once.
STRETCH, BATCH_WORDS = 64, 200_000
#: Three-byte n-grams at one place of the chain; a longer word takes several places in a row.
PIECE = 40
#: Blank-separated strings up to this length are remembered; longer ones hardly come again.
LONG = 64
_LETTERS = regex.compile(r"\p{L}+")


def features(word: str) -> list[list[int]]:
    """Hashed three-byte n-grams of the whole word by piece; the first has the prefixes and the word itself, the last the suffixes."""
    w = b"<%b>" % word.encode("utf-8", "surrogatepass")
    grams = [crc32(w[i : i + 3]) % BUCKETS for i in range(len(w) - 2)]
    found = [grams[i : i + PIECE] for i in range(0, len(grams), PIECE)]
    found[0] += [crc32(w[:n], 1) % BUCKETS for n in (2, 3, 4)]
    found[-1] += [crc32(w[-n:], 2) % BUCKETS for n in (2, 3, 4)]
    found[0].append(crc32(w, 3) % BUCKETS)
    return found


@dataclass
class Field:
    """A fitted field: its labels, feature weights (the lexicon's last) and transitions."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def of_word(self, word: str) -> list[list[int]]:
        found = features(word)
        if word in self.lexicon:
            found[0].append(BUCKETS + self.lexicon[word])
        return found


def _stretches(emit: np.ndarray, lengths: np.ndarray):
    """(stretch, place, label) emissions, which places are words, and each text's first stretch."""
    per = -(-lengths // STRETCH)
    first = np.r_[0, np.cumsum(per)[:-1]]
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(emit)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    cells = np.ones((int(per.sum()), STRETCH, emit.shape[1]))
    real = np.zeros(cells.shape[:2], dtype=bool)
    at = first[text] + place // STRETCH, place % STRETCH
    cells[at], real[at] = emit, True
    return cells, real, first, per, at


def _passes(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None):
    """Emissions, transitions, and each word's forward and backward vectors, every one up to a factor.

    ``start`` is the forward vector before the first word (uniform if not given), ``end``
    the backward vector of what follows the last one, for a single text.
    """
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12
    step = np.exp(moves - moves.max())
    cells, real, first, per, at = _stretches(emit, lengths)
    n, _, k = cells.shape
    whole = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(STRETCH):
        on = real[:, t]
        moved = (whole[on] @ step) * cells[on, t][:, None, :]
        whole[on] = moved / moved.max(axis=(1, 2), keepdims=True)
    head, tail = np.full((n, k), 1.0 / k), np.ones((n, k))
    if start is not None:
        head[first] = start
    if end is not None:
        tail[first + per - 1] = end
    for s in range(1, int(per.max())):
        on = np.flatnonzero(per > s)
        h = np.einsum("ij,ijk->ik", head[first[on] + s - 1], whole[first[on] + s - 1])
        head[first[on] + s] = h / h.sum(axis=1, keepdims=True)
        back = first[on] + per[on] - 1 - s
        b = np.einsum("ijk,ik->ij", whole[back + 1], tail[back + 1])
        tail[back] = b / b.max(axis=1, keepdims=True)
    alpha, beta = np.empty_like(cells), np.empty_like(cells)
    for t in range(STRETCH):
        moved = (head @ step) * cells[:, t]
        head = np.where(real[:, t, None], moved / moved.sum(axis=1, keepdims=True), head)
        alpha[:, t] = head
    for t in range(STRETCH - 1, -1, -1):
        beta[:, t] = tail
        moved = (cells[:, t] * tail) @ step.T
        tail = np.where(real[:, t, None], moved / moved.max(axis=1, keepdims=True), tail)
    return emit, step, alpha[at], beta[at]


def _shares(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True)


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Each word's label probabilities; texts lie one after another, none is empty."""
    _, _, alpha, beta = _passes(scores, lengths, moves)
    return _shares(alpha, beta)


def expectations(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's label probabilities, and how often each label is expected to follow each.

    A word's pair with the one before it has the probability alpha before, times the
    transition, the emission and beta. The first word of a text follows any label alike.
    """
    emit, step, alpha, beta = _passes(scores, lengths, moves)
    before = np.empty_like(alpha)
    before[1:] = alpha[:-1]
    before[np.cumsum(lengths) - lengths] = 1.0 / alpha.shape[1]
    after, pairs = emit * beta, np.zeros_like(step)
    for i in range(0, len(after), BATCH_WORDS):
        joint = before[i : i + BATCH_WORDS, :, None] * step[None] * after[i : i + BATCH_WORDS, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return _shares(alpha, beta), pairs


def mean_marginals(table: np.ndarray, rows: np.ndarray, moves: np.ndarray, part: int = BATCH_WORDS) -> np.ndarray:
    """The mean of the marginals of one text whose words have these ``rows`` of scores, ``part`` words at a time.

    A first run keeps the forward vector at the beginning of each part, a second one goes
    back from the end with the backward vector.
    """
    cuts = range(0, len(rows), part)
    one = lambda i: (table[rows[i : i + part]], np.array([min(part, len(rows) - i)]), moves)
    starts: list[np.ndarray | None] = [None]
    for i in cuts[:-1]:
        starts.append(_passes(*one(i), start=starts[-1])[2][-1])
    total, end = np.zeros(table.shape[1]), None
    for i, start in zip(reversed(cuts), reversed(starts), strict=True):
        emit, step, alpha, beta = _passes(*one(i), start=start, end=end)
        total += _shares(alpha, beta).sum(axis=0)
        end = step @ (emit[0] * beta[0])
        end = end / end.max()
    return total / len(rows)


def fit(texts: list[tuple[str, list[str]]]) -> Field | None:
    """A field from (language, words) samples; None without any."""
    texts = [(lang, words) for lang, words in texts if words]
    if not texts:
        return None
    labels = sorted({lang for lang, _ in texts})
    counts = {lang: Counter() for lang in labels}
    for lang, words in texts:
        counts[lang].update(words)
    known: dict[str, int] = {}
    for k, lang in enumerate(labels):
        for word, n in counts[lang].most_common(LEXICON):
            if 2 * n > sum(c[word] for c in counts.values()):
                known[word] = k
    model = Field(labels, np.zeros((BUCKETS + len(labels), len(labels))), np.zeros((len(labels),) * 2), known)
    types = sorted({w for _, words in texts for w in words})
    each, places = [], {}
    for w in types:
        pieces = model.of_word(w)
        places[w] = range(len(each), len(each) + len(pieces))
        each += pieces
    flat, starts = np.concatenate(each), np.r_[0, np.cumsum([len(x) for x in each])]
    seqs = [(labels.index(lang), np.fromiter(chain.from_iterable(places[w] for w in words), dtype=np.int64)) for lang, words in texts]
    rng, past, past_moves = np.random.default_rng(0), np.full(model.weights.shape, 1e-6), np.full(model.moves.shape, 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(seqs))
        for b in range(0, len(order), 64):
            batch = [seqs[i] for i in order[b : b + 64]]
            words, sizes_of = np.concatenate([w for _, w in batch]), np.array([len(w) for _, w in batch])
            gold = np.repeat([k for k, _ in batch], sizes_of)
            # Where texts begin: the second of some pairs goes on where the first ends.
            joined = np.zeros(len(batch), dtype=bool)
            joined[1 :: 2 * JOIN_EVERY] = True
            lengths = np.add.reduceat(sizes_of, np.flatnonzero(~joined))
            some, back = np.unique(words, return_inverse=True)
            used = [flat[starts[i] : starts[i + 1]] for i in some]
            sizes = np.array([len(u) for u in used])
            feats = np.concatenate(used)
            per_type = np.add.reduceat(model.weights[feats], np.r_[0, np.cumsum(sizes)[:-1]], axis=0)
            probs, pairs = expectations(per_type[back], lengths, model.moves)
            miss = -probs
            miss[np.arange(len(gold)), gold] += 1
            by_type = np.zeros((len(some), len(labels)))
            np.add.at(by_type, back, miss)
            grad = np.zeros_like(model.weights)
            np.add.at(grad, feats, np.repeat(by_type, sizes, axis=0))
            grad = grad / 64 - DECAY * model.weights
            past += grad**2
            model.weights += RATE * grad / np.sqrt(past) * (grad != 0)
            begins = np.cumsum(lengths) - lengths
            inner = np.ones(len(gold), dtype=bool)
            inner[begins] = False
            now = np.flatnonzero(inner)
            seen = np.zeros_like(model.moves)
            np.add.at(seen, (gold[now - 1], gold[now]), 1)
            any_ = np.exp(model.moves - model.moves.max(axis=0))
            np.add.at(seen.T, gold[begins], (any_ / any_.sum(axis=0)).T[gold[begins]])
            step = (seen - pairs) / len(words) - DECAY * model.moves
            past_moves += step**2
            model.moves += RATE * step / np.sqrt(past_moves)
    return model


class Labeller(dict):
    """Predicts texts; as a mapping it gives the row of scores of a blank-separated string.

    Every letter run in it has a row for each of its pieces. A string without a letter
    gives -1, one with several rows -2 and below, by which ``runs`` holds them in order.
    """

    keep = 400_000

    def __init__(self, model: Field):
        super().__init__()
        self.model = model
        self._forget()

    def __missing__(self, word: str) -> int:
        rows = [row for part in _LETTERS.findall(word) for row in self._rows_of(part)]
        if len(rows) > 1:
            self.runs.append(np.array(rows, dtype=np.int64))
            self.held += len(rows)
            row = -1 - len(self.runs)
        else:
            row = rows[0] if rows else -1
        if len(word) <= LONG:
            self[word] = row
        return row

    def _rows_of(self, part: str) -> range:
        rows = self.parts.get(part)
        if rows is None:
            pieces = self.model.of_word(part)
            rows = self.parts[part] = range(self.rows, self.rows + len(pieces))
            self.rows += len(pieces)
            self.new += pieces
        return rows

    def _forget(self) -> None:
        self.clear()
        self.parts: dict[str, range] = {}
        self.runs: list[np.ndarray] = []
        self.rows, self.held, self.new = 0, 0, []
        self.table = np.empty((0, len(self.model.labels)))

    def _scores(self) -> np.ndarray:
        """The rows of all pieces so far."""
        if self.new:
            starts = np.cumsum([0, *map(len, self.new[:-1])])
            fresh = np.add.reduceat(self.model.weights[np.fromiter(chain.from_iterable(self.new), dtype=np.int64)], starts, axis=0)
            self.table, self.new = np.concatenate([self.table, fresh]), []
        return self.table

    def _rows(self, text: str) -> np.ndarray:
        """The rows of the text's letter runs, in order."""
        rows = np.fromiter(map(self.__getitem__, text.lower().split()), dtype=np.int64)
        rows = rows[rows != -1]
        several = np.flatnonzero(rows < -1)
        if not len(several):
            return rows
        cut, at = [], 0
        for k in several.tolist():
            cut += [rows[at:k], self.runs[-2 - rows[k]]]
            at = k + 1
        return np.concatenate([*cut, rows[at:]])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, sure, n = [UNKNOWN] * len(texts), [0.0] * len(texts), 0
        held: list[tuple[int, np.ndarray]] = []
        for i, text in enumerate([*texts, None]):
            if i < len(texts) and text:
                rows = self._rows(text)
                if len(rows) > BATCH_WORDS:
                    mean = mean_marginals(self._scores(), rows, self.model.moves)
                    labels[i], sure[i] = self.model.labels[int(mean.argmax())], float(min(1.0, mean.max()))
                elif len(rows):
                    held.append((i, rows))
                    n += len(rows)
            if held and (n >= BATCH_WORDS or i == len(texts)):
                table = self._scores()
                lengths = np.array([len(r) for _, r in held])
                probs = marginals(table[np.concatenate([r for _, r in held])], lengths, self.model.moves)
                means = np.add.reduceat(probs, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
                for (j, _), mean in zip(held, means, strict=True):
                    labels[j], sure[j] = self.model.labels[int(mean.argmax())], float(min(1.0, mean.max()))
                held, n = [], 0
                if max(len(self), self.rows, self.held) > self.keep:
                    self._forget()
        return labels, sure


_labellers: dict[str, Labeller] = {}


def _labeller_of(model: Field) -> Labeller:
    """One labeller per worker process and field, so that later tasks find its words."""
    if model.name not in _labellers:
        _labellers.clear()
        _labellers[model.name] = Labeller(model)
    return _labellers[model.name]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text) of at most ``MAX_TEXTS`` learnable rows of ``MAX_CHARS`` characters in all; of those with one id, the least.

    Texts of more than ``MAX_TEXT_CHARS`` aren't learned from, as the fit is one task's.
    """
    learnable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    learnable = learnable.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    learnable = learnable.filter(F.length("text") <= MAX_TEXT_CHARS)
    # Ids first, so that the sort moves no texts; the sample is bounded, and so is what it broadcasts.
    first = learnable.groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("chars")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TEXTS)
    so_far = F.sum("chars").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    ids = first.withColumn("so_far", so_far).filter(F.col("so_far") <= MAX_CHARS).select("doc_id")
    chosen = learnable.join(F.broadcast(ids), "doc_id", "left_semi")
    return chosen.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("s")).select("doc_id", "s.lang", "s.text")


def fit_documents(docs: DataFrame) -> Field | None:
    """The field of ``docs``' sample, fitted in one task, so that the driver holds the field alone; None without a sample."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared: dict[str, str] = {}
        texts = []
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                texts.append((lang, [shared.setdefault(w, w) for w in _LETTERS.findall(text.lower())]))
        model = fit(texts)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = training_sample(docs).repartition(1).sortWithinPartitions("doc_id").mapInArrow(learn, "model binary").collect()
    return pickle.loads(bytes(fitted[0][0])) if fitted else None


def label_documents(docs: DataFrame, model: Field | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``, from its whole text alone.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null
    or has no letter, or nothing was learned. The score is the mean probability of the
    language over the text's words. Repeated rows are labelled each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller_of(shared.value) if shared.value is not None else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            labels, sure = labeller.predict(texts) if labeller is not None else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(labels, pa.string()), pa.array(sure, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def label_rows(docs: DataFrame, model: Field | None, name: str = "__lang_pred", score: str = "__score") -> DataFrame:
    """``docs`` with each row's language as ``name`` and its score, decided by its own text as in ``label_documents``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller_of(shared.value) if shared.value is not None else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            labels, sure = labeller.predict(texts) if labeller is not None else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(sure, pa.float64())], [*batch.schema.names, name, score])

    more = [T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *more]))


def recognized(docs: DataFrame, model: Field | None, least: float = 1.2) -> DataFrame:
    """The rows of ``docs`` whose text is in some language, with their columns.

    A text is rejected if it is null or has no letter, or if its best language is hardly
    likelier than a guess: a score under ``least`` divided by the number of languages.
    Where nothing was learned, or one language only, a letter is enough.
    """
    if model is None:
        return docs.filter(F.col("text").cast("string").rlike(r"\p{L}"))
    least = least / len(model.labels) if len(model.labels) > 1 else 0.0
    labelled = label_rows(docs, model)
    return labelled.filter((F.col("__lang_pred") != UNKNOWN) & (F.col("__score") >= least)).select(*docs.columns)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that aren't held out, label all rows."""
    return label_documents(docs, fit_documents(docs))
