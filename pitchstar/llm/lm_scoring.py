"""Operator 12. Language-model scores from a subword lattice.

Texts, A-Z lower-cased, are words ``[^\\x20\\x09-\\x0D]+`` and one end. The model is
learned from the documents that are not held out and scores all:

    log10 P(text) = sum over words of log10 P(word) + log10 P(end)

P(end) is (D + 0.5) / (N + 1) for D learned documents and N learned tokens. A word
is, with Witten and Bell's weight, one that was seen or one that is spelled:

    P(word) = (1 - P(end)) * (c + V * lattice(word)) / (W + V)

c is its count, W that of all words, V that of distinct ones; without any learned
word P(word) = (1 - P(end)) * lattice(word).

Method. ``lattice(word)`` is the probability of the word summed over all its
segmentations into pieces of an existing vocabulary, a first piece (with the mark
of a word's start, or that mark alone) and any further ones; a byte piece may
stand for any byte, so every word has segmentations. A forward recursion over
byte positions gives it in log space:

    alpha[j] = log sum over pieces word[i:j] of exp(alpha[i] + log p(piece))

Pieces weigh by the vocabulary's own scores: with ``scores="rank"`` these are merge
ranks and a piece weighs 1 / (1 + rank) (a byte piece as the last rank); with
``scores="log"`` they are log probabilities. The vocabulary stays as it is; in each
of ``rounds`` passes over the learned words the expected use of every piece, from
that recursion run backwards, is added to the existing weights (worth ``TRUST``
uses in all). The weights sum to one over all pieces, whether they start a word or
go on with it, which makes the lattice a distribution over words.

Each distinct word of the corpus is scored once, as rows of a table; a slice of
documents then joins its distinct words, not its tokens. The driver sees sums: the
counts N, W, V, D and one number for each piece of the vocabulary.

``base_score`` is the sum over tokens, the end included, of
log10((c + 0.5) / (N + 0.5 * (V' + 1))) with V' distinct tokens.

Defined cases: null text: empty (its end is scored); a null id is learned from and
not held out; rows sharing an id are scored each; nothing learned: N = 0 and
n_known = 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, slices, table, text_buffers
from .wordcodes import SLICE, code_words, pack, spans, unpack, words_of, written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Uses that the existing weights are worth against expected ones.
TRUST = 10_000
#: Expected uses are summed in whole parts of this size, in any order alike.
PART = 1 << 20
#: Bytes of distinct words that a task lays out at once.
LAYER = 1 << 20
_MARK = "▁"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -------------------------------------------------------------- vocabulary

class Vocabulary:
    """Pieces (bytes, whether they start a word, whether one raw byte) and the
    log of their weights. Read once, on the driver; tasks get it with the code."""

    def __init__(self, pieces: list, weights: np.ndarray):
        self.pieces = pieces
        self.log = np.log(weights / weights.sum())

    @classmethod
    def read(cls, path: str, scores: str = "rank") -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, score = [], []
        for i in range(model.get_piece_size()):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                pieces.append((bytes([int(p[3:5], 16)]), False, True))
                score.append(None)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and _MARK not in p[1:]:
                pieces.append((p.removeprefix(_MARK).encode(), p.startswith(_MARK), False))
                score.append(model.get_score(i))
        known = {(p, byte) for p, start, byte in pieces if byte or start and not p}
        for p in [(bytes([b]), False, True) for b in range(256)] + [(b"", True, False)]:
            if (p[0], p[2]) not in known:  # every word has a segmentation
                pieces.append(p)
                score.append(None)
        least = min((s for s in score if s is not None), default=0.0)
        score = np.array([least if s is None else s for s in score])
        return cls(pieces, 1 / (1 + np.maximum(-score, 0)) if scores == "rank" else np.exp(score))

    def adapted(self, uses: np.ndarray) -> Vocabulary:
        return Vocabulary(self.pieces, np.exp(self.log) * TRUST + uses)


class Trie:
    """Direct-address transitions, and the piece that a node spells."""

    def __init__(self, pieces: list):
        nodes: list[dict] = [{}]
        inner, first = [-1], [-1]
        self.byte = np.zeros(256, np.int64)
        for k, (text, start, raw) in enumerate(pieces):
            if raw:
                self.byte[text[0]] = k
                continue
            at = 0
            for b in text:
                to = nodes[at].get(b)
                if to is None:
                    to = nodes[at][b] = len(nodes)
                    nodes.append({}), inner.append(-1), first.append(-1)
                at = to
            (first if start else inner)[at] = k
        self.next = np.zeros((len(nodes), 256), np.int32)
        for at, edges in enumerate(nodes):
            for b, to in edges.items():
                self.next[at, b] = to
        self.inner, self.first = np.array(inner), np.array(first)


_tries: dict = {}


def trie_of(pieces: list) -> Trie:
    """One per worker and vocabulary."""
    key = hash(tuple(pieces))
    if key not in _tries:
        _tries.clear()
        _tries[key] = Trie(pieces)
    return _tries[key]


# ----------------------------------------------------------------- lattice

class Lattice:
    """All segmentations of some non-empty words, laid out by end position."""

    def __init__(self, trie: Trie, data: np.ndarray, offsets: np.ndarray):
        words = len(offsets) - 1
        self.size = np.diff(offsets)
        owner = np.repeat(np.arange(words), self.size)
        last = offsets[1:][owner]
        at, node, starts = np.arange(len(data)), np.zeros(len(data), np.int32), np.zeros(len(data), bool)
        starts[offsets[:-1]] = True
        src, end, piece, opening = [at], [at + 1], [trie.byte[data]], [np.zeros(len(at), bool)]
        step = 0
        while len(at):
            node = trie.next[node, data[at + step]]
            step += 1
            live = node > 0
            at, node = at[live], node[live]
            for of, only in ((trie.inner, None), (trie.first, starts)):
                k = of[node]
                some = k >= 0 if only is None else (k >= 0) & only[at]
                src.append(at[some]), end.append(at[some] + step), piece.append(k[some]), opening.append(np.full(int(some.sum()), only is not None))
            more = at + step < last[at]
            at, node = at[more], node[more]
        src, end, piece, opening = (np.concatenate(x) for x in (src, end, piece, opening))
        word = owner[src]
        depth = end - offsets[:-1][word]
        order = np.lexsort((word, depth))
        src, word, depth, self.piece, opening = src[order], word[order], depth[order], piece[order], opening[order]
        # a word of n bytes has positions 0..n; one more, the last, is before all words
        base = offsets[:-1] + np.arange(words)
        self.zero, self.final = base, base + self.size
        self.states = len(data) + words + 1
        self.src = np.where(opening, self.states - 1, src + word)
        self.word, target = word, base[word] + depth
        new = np.flatnonzero(np.diff(target, prepend=-1))
        self.target, self.new = target[new], new
        self.many = np.diff(new, append=len(target))
        self.levels = np.flatnonzero(np.diff(depth[new], prepend=-1)) if len(new) else new
        self.bare = int(trie.first[0])

    def _spans(self):
        ends = np.append(self.levels[1:], len(self.new))
        for a, b in zip(self.levels, ends):
            lo = self.new[a]
            hi = self.new[b - 1] + self.many[b - 1]
            yield a, b, lo, hi

    def forward(self, log: np.ndarray) -> np.ndarray:
        """Log probability of each word."""
        self.alpha = alpha = np.zeros(self.states)
        alpha[self.zero] = log[self.bare]
        weight = log[self.piece]
        for a, b, lo, hi in self._spans():
            c = alpha[self.src[lo:hi]] + weight[lo:hi]
            at = self.new[a:b] - lo
            top = np.maximum.reduceat(c, at)
            alpha[self.target[a:b]] = top + np.log(np.add.reduceat(np.exp(c - np.repeat(top, self.many[a:b])), at))
        return alpha[self.final]

    def uses(self, log: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, in parts, over ``count`` copies of each word."""
        self.forward(log)
        share = np.zeros(self.states)
        share[self.final] = 1
        out = np.zeros(len(log), np.int64)
        weight = log[self.piece]
        post = np.zeros(len(weight))
        for a, b, lo, hi in reversed(list(self._spans())):
            to = np.repeat(self.target[a:b], self.many[a:b])
            post[lo:hi] = share[to] * np.exp(self.alpha[self.src[lo:hi]] + weight[lo:hi] - self.alpha[to])
            np.add.at(share, self.src[lo:hi], post[lo:hi])
        np.add.at(out, self.piece, np.rint(post * PART).astype(np.int64) * count[self.word])
        out[self.bare] += int((np.rint(share[self.zero] * PART).astype(np.int64) * count).sum())
        return out


def _layers(batch):
    """Words of a batch in runs of about LAYER bytes."""
    for part in slices(batch, "word", LAYER):
        yield part, text_buffers(part.column("word"))


# --------------------------------------------------------------- operator

_CODED = pa.schema([("kind", pa.string()), ("slice", pa.int64()), ("code", pa.int32()), ("word", pa.string()), ("n", pa.int64()),
                    ("stream", pa.binary()), ("ids", pa.list_(pa.int64())), ("learned", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32()))])
_CODED_SQL = "kind string, slice long, code int, word string, n long, stream binary, ids array<long>, learned array<boolean>, sizes array<int>"


def code_documents(batches):
    """Slices of documents: their words with learned counts, and their codes."""
    first, made = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for part in slices(batch, most=SLICE):
            data, offsets = text_buffers(part.column("text"))
            data = _LOWER[data]
            start, end = spans(data, offsets, _SPACE)
            codes, words = code_words([words_of(data, start, end)])
            sizes = np.diff(np.searchsorted(start, offsets))
            learned = np.asarray(part.column("learned").to_numpy(zero_copy_only=False), bool)
            m = len(words)
            counts = np.bincount(codes, weights=np.repeat(learned, sizes), minlength=m).astype(np.int64)
            made += 1
            number = first + made
            fixed = lambda value, type_, k: pa.array([value], type_).take(pa.array(np.zeros(k, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [fixed("word", pa.string(), m), fixed(number, pa.int64(), m), pa.array(np.arange(m), pa.int32()), words.cast(pa.string()),
                 pa.array(counts), *[pa.nulls(m, f.type) for f in list(_CODED)[5:]]], schema=_CODED)
            yield pa.RecordBatch.from_pylist([{
                "kind": "text", "slice": number, "stream": pack(codes.astype(np.int32)), "ids": part.column("doc_id").to_pylist(),
                "learned": learned.tolist(), "sizes": sizes.tolist()}], schema=_CODED)


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def lm_scores(docs: DataFrame, learned, vocabulary: str = VOCABULARY, scores: str = "rank", rounds: int = 2) -> DataFrame:
    """Return (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score); ``learned`` is a Boolean column, true for rows to learn from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learned, F.lit(True)).alias("learned"))
    coded = written(rows.mapInArrow(code_documents, _CODED_SQL), "kind")
    words = coded.where("kind = 'word'").select("slice", "code", "word", "n")
    texts = coded.where("kind = 'text'").select("slice", "stream", "ids", "learned", "sizes")
    known = cut(words.groupBy("word").agg(F.sum("n").alias("c")))
    sums = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    all_words, distinct = sums[0], sums[1]
    ends = texts.agg(F.coalesce(F.sum(F.size(F.filter("learned", lambda x: x))), F.lit(0))).first()[0]
    tokens = all_words + ends

    model = Vocabulary.read(vocabulary, scores)
    pieces = model.pieces

    for _ in range(rounds if all_words else 0):
        log = model.log

        def expect(batches):
            out = np.zeros(len(log), np.int64)
            for batch in batches:
                for part, (data, offsets) in _layers(batch):
                    out += Lattice(trie_of(pieces), data, offsets).uses(log, part.column("c").to_numpy())
            k = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(out[k])], ["piece", "uses"])

        uses = np.zeros(len(pieces))
        summed = known.where("c > 0").mapInArrow(expect, "piece long, uses long").groupBy("piece").agg(F.sum(F.col("uses").cast("decimal(38,0)")).alias("uses"))
        for r in summed.collect():  # one row for each piece of the vocabulary
            uses[r.piece] = float(r.uses) / PART
        model = model.adapted(uses)

    log = model.log
    end = math.log((ends + 0.5) / (tokens + 1))
    go_on = math.log1p(-math.exp(end))
    base_total = tokens + 0.5 * (distinct + (ends > 0) + 1)

    def score_words(batches):
        for batch in batches:
            for part, (data, offsets) in _layers(batch):
                lattice = Lattice(trie_of(pieces), data, offsets).forward(log)
                c = part.column("c").to_numpy().astype(np.float64)
                if distinct:
                    with np.errstate(divide="ignore"):
                        lattice = np.logaddexp(np.log(c), math.log(distinct) + lattice) - math.log(all_words + distinct)
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("c"), pa.array((lattice + go_on) / math.log(10))], ["word", "c", "score"])

    scored = known.mapInArrow(score_words, "word string, c long, score double")
    looked = words.select(F.col("slice").alias("of"), "code", "word").join(scored, "word").select("of", "code", "c", "score")

    def score_texts(text: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for t in text.to_pylist():
            codes = unpack(t["stream"], np.int32)
            c, value = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows)
            at = found.column("code").to_numpy()
            c[at], value[at] = found.column("c").to_numpy(), found.column("score").to_numpy()
            n = len(t["ids"])
            doc = np.repeat(np.arange(n), t["sizes"])
            base = np.log10((c + 0.5) / base_total)
            sums = [np.bincount(doc, weights=x[codes], minlength=n) for x in (c > 0, base, value)]
            out.append(pa.table([
                pa.array(t["ids"], pa.int64()), pa.array([not x for x in t["learned"]]), pa.array(np.asarray(t["sizes"], np.int64) + 1),
                pa.array(sums[0].astype(np.int64) + (ends > 0)), pa.array(np.full(n, tokens), pa.int64()),
                pa.array(sums[1] + math.log10((ends + 0.5) / base_total)), pa.array(sums[2] + end / math.log(10))], schema=_SCORED))
        return pa.concat_tables(out) if out else _SCORED.empty_table()

    return texts.groupBy("slice").cogroup(looked.groupBy("of")).applyInArrow(
        score_texts, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; one in five, by crc32 of the id, is held out."""
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, F.crc32(F.col("doc_id").cast("string")) % 5 != 1)
