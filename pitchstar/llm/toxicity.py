"""Operator 9. Toxicity by a support vector machine over a string kernel.

Kernel. The gap-weighted subsequence kernel of order ``ORDER``: two words share
every subsequence of that many characters, each weighted by ``DECAY`` to the
power of the lengths it spans. Inserted characters and gaps thin a match out but
do not break it. Words lose all but their letters first ("m.o-r on" in single
letters is joined), so separators cost nothing.

The kernel of a word and a landmark is that of the landmark and the stretch of
the word, up to ``STRETCH`` letters longer than it, that suits it best.

Nyström. Landmarks are words, and cores, with which several words begin, that mark
toxic texts in the training sample: at most ``LANDMARKS``, none within another. A word is described by its normalised
kernel values with the landmarks; words that lack too many of a landmark's
pairs of letters (``PAIRS``) count 0 for it. A sentence takes the maximum of
its words, and is mapped by the inverse square root of the landmarks' kernel
matrix; a linear SVM (squared hinge) in that space is an SVM of the kernel.

Training. Labelled sentences: of each sampled text the sentence that looks most
like a landmark carries its label, and of toxic texts every sentence that holds
something like one; classes are balanced, with at most ``SAMPLE`` texts a
class, picked by a hash of the id. Scores are calibrated by a sigmoid. A text's
score is that of its worst sentence.

Scoring is one pass over whole texts; distinct words are described once per
slice. Only the sample's word counts reach the driver, at most ``WORDS`` words.

Defined cases: a null or empty text is a sentence without words and gets the
score of one; rows are scored one by one, so repeated rows agree; labels that
contradict each other count as toxic, null labels not at all; without toxic or
clean training texts every score is the prior; words longer than ``SPAN``
letters are read in overlapping windows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, BASE2, Words, cut, prefix_hash, slices, span_hash, table, text_buffers

ORDER, DECAY = 3, 0.8
#: The kernel is raised to this power, so that part of a landmark is worth little.
POWER = 4
SAMPLE, WORDS, LANDMARKS = 2000, 1000, 40
#: Lengths of cores, with the mark of the word's begin.
CORE = (5, 9)
SHARE = 0.02
SPAN, STEP = 22, 11
BEGIN, END = 94, 36  # ^ and $ stand at the ends of a word
#: A word must hold this share of a landmark's pairs of letters, one more letter between them or none.
PAIRS = 0.6
STRETCH = 2
KNOWN = 2_000_000


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Subsequence kernel of the words in the rows of ``a`` and ``b``; zeros pad."""
    n, length, m = len(a), a.shape[1], b.shape[1]
    same = (a[:, :, None] == b[:, None, :]) & (a[:, :, None] > 0)
    before = np.ones((n, length + 1, m + 1))  # weights of shorter subsequences, decayed to each place
    for _ in range(ORDER - 1):
        hits = np.where(same, before[:, :-1, :-1], 0.0) * DECAY * DECAY
        for j in range(1, m):
            hits[:, :, j] += DECAY * hits[:, :, j - 1]
        for i in range(1, length):
            hits[:, i] += DECAY * hits[:, i - 1]
        before = np.zeros((n, length + 1, m + 1))
        before[:, 1:, 1:] = hits
    return np.where(same, before[:, :-1, :-1], 0.0).sum(axis=(1, 2)) * DECAY * DECAY


def padded(words: list[bytes]) -> np.ndarray:
    out = np.zeros((len(words), max(map(len, words), default=1) or 1), np.uint8)
    for i, w in enumerate(words):
        out[i, :len(w)] = np.frombuffer(w, np.uint8)
    return out


def pairs_of(words: np.ndarray, gaps: tuple[int, ...]) -> np.ndarray:
    """Which pairs of letters with so many letters between them occur, as 256 hashed bits."""
    out = np.zeros((len(words), 4), np.uint64)
    x = words.astype(np.uint32)
    for g in gaps:
        if words.shape[1] < g + 2:
            continue
        a, b = x[:, :-1 - g], x[:, 1 + g:]
        code = (a * np.uint32(251) + b * np.uint32(7919)) * np.uint32(40503) >> np.uint32(7) & np.uint32(255)
        bit = np.where((a > 0) & (b > 0), np.uint64(1) << (code & np.uint32(63)).astype(np.uint64), np.uint64(0))
        for k in range(4):
            out[:, k] |= np.bitwise_or.reduce(np.where(code >> np.uint32(6) == k, bit, np.uint64(0)), axis=1)
    return out


class Landmarks:
    def __init__(self, words: list[bytes]):
        self.words = words
        self.table = padded(words)
        self.size = np.array([len(w) for w in words], np.int64)
        self.own = np.sqrt(kernel(self.table, self.table))
        i, j = (x.ravel() for x in np.indices((len(words), len(words))))
        gram = (kernel(self.table[i], self.table[j]) / (self.own[i] * self.own[j])).reshape(len(words), -1) ** POWER if words else np.zeros((0, 0))
        values, vectors = np.linalg.eigh(gram)
        self.map = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        self.pairs = pairs_of(self.table, (0,))
        self.need = np.ceil(np.bitwise_count(self.pairs).sum(axis=1) * PAIRS)

    def of(self, found: Sentences) -> np.ndarray:
        """Features of the distinct strings. Strings met before that are like no
        landmark are remembered by their hash, up to KNOWN of them."""
        if not hasattr(self, "known"):
            self.known = np.zeros(0, np.uint64)
        to = np.searchsorted(self.known, found.keys)
        new = np.flatnonzero(to == len(self.known)) if not len(self.known) else np.flatnonzero(self.known[np.minimum(to, len(self.known) - 1)] != found.keys)
        out = np.zeros((len(found.keys), len(self.words)))
        out[new] = self.features(found.strings(new))
        none = found.keys[new[~out[new].any(axis=1)]]
        self.known = none if len(self.known) + len(none) > KNOWN else np.sort(np.concatenate((self.known, none)), kind="stable")
        return out

    def features(self, words: np.ndarray) -> np.ndarray:
        """For words (rows of bytes) and landmarks: the normalised kernel of the
        landmark and the stretch of the word that suits it best, to the POWER."""
        out = np.zeros((len(words), len(self.words)))
        has = pairs_of(words, (0, 1))
        near = [np.flatnonzero(np.bitwise_count(has & self.pairs[k]).sum(axis=1) >= self.need[k]) for k in range(len(self.words))]
        word, mark = np.concatenate([*near, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(near)), [len(x) for x in near])
        size = (words[word] > 0).sum(axis=1)
        for more in range(STRETCH + 1):  # stretches of the landmark's length, and up to STRETCH longer
            length = np.minimum(self.size[mark] + more, size)
            times = size - length + 1
            at = np.repeat(np.arange(len(word)), times)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            for part in np.array_split(np.arange(len(at)), len(at) // 4000 + 1):
                if not len(part):
                    continue
                w, k = word[at[part]], mark[at[part]]
                col = np.arange(int(length[at[part]].max()))
                u = np.where(col < length[at[part]][:, None], words[w[:, None], np.minimum(nth[part][:, None] + col, words.shape[1] - 1)], 0)
                own = np.sqrt(kernel(u, u))
                value = kernel(u, self.table[k]) / np.where(own > 0, own, 1) / self.own[k]
                np.maximum.at(out, (w, k), np.minimum(value, 1.0) ** POWER)
        return out


class Sentences:
    """Distinct letter strings of a slice of texts, and where they occur."""

    def __init__(self, column: pa.Array):
        w = Words(*text_buffers(column), lower=True)
        letter = (w.data >= 128) | ((w.data >= 97) & (w.data <= 122))
        self.letters = w.data[letter]
        place = np.concatenate(([0], np.cumsum(letter)))
        lo, hi = place[w.start], place[w.end]
        row = w.row()
        # a sentence ends at . ! ? and at line breaks
        lines = np.concatenate(([0], np.cumsum(w.data == 10)))
        new = np.ones(len(lo), bool)
        new[1:] = (row[1:] != row[:-1]) | np.isin(w.data[w.end[:-1] - 1], (33, 46, 63)) | (lines[w.start[1:]] != lines[w.start[:-1]])
        sentence = np.cumsum(new) - 1
        self.sentence_row = row[new]
        # three or more single letters in a row are read as one word
        single = (hi - lo == 1).astype(np.int8)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], single, [0]))))
        runs = [(a, b) for a, b in zip(edge[::2], edge[1::2]) if b - a >= 3]
        lo = np.concatenate((lo, lo[[a for a, _ in runs]])) if runs else lo
        hi = np.concatenate((hi, hi[[b - 1 for _, b in runs]])) if runs else hi
        sentence = np.concatenate((sentence, sentence[[a for a, _ in runs]])) if runs else sentence
        # long words in overlapping windows
        extra = np.maximum(0, -(-(hi - lo - SPAN) // STEP))
        lo, hi, sentence = np.repeat(lo, extra + 1), np.repeat(hi, extra + 1), np.repeat(sentence, extra + 1)
        nth = np.arange(len(lo)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
        lo = lo + nth * STEP
        hi = np.minimum(hi, lo + SPAN)
        first, last = nth == 0, nth == np.repeat(extra, extra + 1)
        full = hi - lo >= ORDER
        self.lo, self.size, self.first, self.last = lo[full], (hi - lo)[full], first[full], last[full]
        self.sentence = sentence[full]
        h = span_hash(prefix_hash(self.letters.astype(np.uint64) * BASE2 + BASE2, BASE), self.lo, self.lo + self.size)
        self.keys, self.at, self.which = np.unique(h ^ (self.first + 2 * self.last).astype(np.uint64), return_index=True, return_inverse=True)

    def strings(self, some: np.ndarray | None = None) -> np.ndarray:
        """The distinct strings, or some of them, as rows of bytes."""
        i = self.at if some is None else self.at[some]
        lo, size, first, last = self.lo[i], self.size[i], self.first[i], self.last[i]
        nth = np.arange(SPAN + 2) - first[:, None].astype(np.int64)
        at = np.clip(lo[:, None] + nth, 0, max(len(self.letters) - 1, 0))
        rows = np.where((nth >= 0) & (nth < size[:, None]), self.letters[at] if len(self.letters) else 0, 0).astype(np.uint8)
        rows[first, 0] = BEGIN
        rows[last, (size + first)[last]] = END
        return rows

    def describe(self, marks: Landmarks) -> tuple[np.ndarray, np.ndarray]:
        """(sentences with any feature, their features)."""
        f = marks.of(self)
        some = f.any(axis=1)[self.which]
        sentence, f = self.sentence[some], f[self.which[some]]
        order = np.argsort(sentence, kind="stable")
        sentence, f = sentence[order], f[order]
        if not len(sentence):
            return sentence, f
        ids, start = np.unique(sentence, return_index=True)
        return ids, np.maximum.reduceat(f, start, axis=0)


# ----------------------------------------------------------------- training

def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, toxic) of at most SAMPLE texts a class, none held out."""
    told = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and id is not null")
            .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic")))
    picked = [told.where(F.col("toxic") == t).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).withColumnRenamed("id", "l_id") for t in (1, 0)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * SAMPLE rows of two numbers
    return docs.join(chosen, F.col("id") == F.col("l_id")).select("id", "text", "toxic").dropDuplicates(["text", "toxic"])


def word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in slices(b):
            s = Sentences(part.column("text"))
            pair = np.unique(np.stack([s.which, s.sentence_row[s.sentence]], axis=1), axis=0) if len(s.which) else np.zeros((0, 2), np.int64)
            words = [bytes(x[x > 0]) for x in s.strings()]
            toxic = np.asarray(part.column("toxic"))
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in pair[:, 0]], pa.binary()), pa.array(toxic[pair[:, 1]], pa.int32())], ["word", "toxic"])


def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each counted word, and what it begins with."""
    for b in batches:
        out = [(x, t, c) for w, t, c in zip(*(b.column(x).to_pylist() for x in ("word", "t", "c")))
               for x in (w, *(w[:n] for n in range(CORE[0], min(CORE[1], len(w) - 1) + 1) if w[0] == BEGIN))]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.int64()))], ["core", "t", "c"])


def choose(counted: list[tuple[bytes, int, int]], n_toxic: int, n_clean: int) -> list[bytes]:
    """Landmarks: cores that tell toxic texts from clean ones, the strongest
    first, longer before shorter; none lies within another."""
    gain = [(t * (np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))) * (1 + 0.05 * len(w)), w) for w, t, c in counted if t > 9 * c]
    out: list[bytes] = []
    for g, w in sorted(gain, key=lambda x: (-x[0], x[1])):
        if g <= 0 or len(out) == LANDMARKS:
            break
        if not any(w in x or x in w for x in out) and (not out or Landmarks(out).features(padded([w])).max() < 0.5):
            out.append(w)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weights and bias of a linear SVM: squared hinge, classes balanced, Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    s = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1))
    reg = np.full(a.shape[1], ridge)
    reg[-1] = 1e-6
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        act = s * (a @ w) < 1
        h = (a[act] * weight[act, None]).T @ a[act] + np.diag(reg)
        new = np.linalg.solve(h, (a[act] * (weight * s)[act, None]).sum(axis=0))
        if np.allclose(new, w, atol=1e-8):
            break
        w = 0.5 * (w + new)
    return w


def fit_sigmoid(f: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift of P(toxic | f), with smoothed targets."""
    pos, neg = int((y > 0).sum()), int((y <= 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    p = np.zeros(2)
    x = np.stack([f, np.ones(len(f))], axis=1)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - q))
        p = p + step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(p[0]), float(p[1])


class Model:
    """Everything that scoring needs: a few kilobytes."""

    def __init__(self, prior: float, marks: Landmarks | None = None, weights: np.ndarray | None = None, bias: float = 0.0, slope: float = 1.0, shift: float = 0.0):
        self.prior, self.marks, self.weights, self.bias, self.slope, self.shift = prior, marks, weights, bias, slope, shift

    def score(self, column: pa.Array) -> np.ndarray:
        if self.marks is None:
            return np.full(len(column), self.prior)
        s = Sentences(column)
        ids, f = s.describe(self.marks)
        best = np.full(len(column), self.bias)  # a sentence without features
        np.maximum.at(best, s.sentence_row[ids], f @ self.weights + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.shift, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on rows (id, text) and labels (doc_id, toxic)."""
    sample = sample_of(docs, labels)
    sizes = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    prior = (n_toxic + 1) / (n_toxic + n_clean + 2)
    if not n_toxic or not n_clean:
        return Model(prior)
    counted = cut(sample.mapInArrow(word_sets, "word binary, toxic int").groupBy("word")
                  .agg(F.sum("toxic").cast("long").alias("t"), F.sum(1 - F.col("toxic")).cast("long").alias("c")))
    told = cut(counted.mapInArrow(cores, "core binary, t long, c long").groupBy("core").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t > 1"))
    # found in so many toxic texts, and hardly a clean one, that chance would give less
    # than one such core; groups of copies, in which any word recurs, stay below SHARE
    often = max(np.log(max(told.count(), 2)) / np.log((n_toxic + n_clean) / n_toxic), SHARE * n_toxic)
    best = (told.where((F.col("t") >= float(often)) & (F.col("t") > 9 * F.col("c")))
            .orderBy(F.desc(F.col("t") - 9 * F.col("c")), "core").limit(WORDS).collect())
    marks = Landmarks(choose([(bytes(r.core), r.t, r.c) for r in best], n_toxic, n_clean))
    if not marks.words:
        return Model(prior)

    def witness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                s = Sentences(part.column("text"))
                ids, f = s.describe(marks)
                row, peak = s.sentence_row[ids], f.max(axis=1) if len(ids) else np.zeros(0)
                order = np.lexsort((peak, row))
                last = order[np.append(row[order][1:] != row[order][:-1], True)] if len(ids) else order
                toxic = np.asarray(part.column("toxic"))
                pick = np.union1d(last, np.flatnonzero((peak >= 0.5) & (toxic[row] == 1)))
                bare = np.setdiff1d(np.arange(part.num_rows), row)  # texts in which nothing is like a landmark
                own = np.concatenate((row[pick], bare)).astype(np.int64)
                out = np.concatenate((f[pick], np.zeros((len(bare), len(marks.words)))))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(own)), part.column("toxic").take(pa.array(own)), pa.array(list(out), pa.list_(pa.float64()))], ["id", "toxic", "f"])

    seen = sample.mapInArrow(witness, "id long, toxic int, f array<double>").orderBy("id", "toxic", "f").toArrow()
    x, y = np.array(seen.column("f").to_pylist()), seen.column("toxic").to_numpy()
    w = fit_svm(x @ marks.map, y)
    weights, bias = marks.map @ w[:-1], float(w[-1])
    slope, shift = fit_sigmoid(x @ weights + bias, y)
    return Model(prior, marks, weights, bias, slope, shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, score) of rows (id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sent.value.score(part.column("text")))], ["id", "score"])
    return docs.mapInArrow(run, "id long, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole text of documents."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("id"), "text")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
