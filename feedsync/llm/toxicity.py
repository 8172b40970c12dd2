"""Toxicity scores by a subsequence string-kernel SVM with Nystroem landmarks (operator 8).

The kernel compares two words by their common subsequences of four symbols that
span at most six places, each place skipped costing a factor ``DECAY``; so an
insult keeps most of its kernel value when characters are inserted or left out.
A word opens with a boundary symbol.  Case is folded, punctuation inside a word is
dropped and runs of single letters ("i d i o t") are joined first; a filler at every
second place ("i1d1i1o1t") is dropped, and a digit beside letters stands for the
letter it looks like ("1d10t").

Training takes a bounded sample of labelled documents (``MAX_TOXIC`` and
``MAX_CLEAN`` of each class, in hash order; of rows that repeat an id, the one with
the least text), staged as symbol streams.  Each sentence has its document's label
and is represented by its most toxic word under the current model: the best
sentences of toxic documents are positive, those of clean documents negative.  The
first model gives each subsequence the lower confidence bound of its log odds between
toxic and clean documents, so that what many toxic documents share stands out from
what a few have by chance, also in a language with few labelled rows.
Kernel values against landmark words, whitened (Nystroem), feed a linear SVM with
squared hinge loss; choosing and fitting alternate a few times.  A logistic curve
over a document's three highest word scores and its length gives the probability.
Counting, choosing words and scoring the sample are Spark jobs over the staged
streams; the driver gets counts of at most 2^20 subsequences a class and, of a document,
``SENTENCES`` + 1 words of at most ``MAX_WORD`` symbols and four numbers.

Since the kernel is a dot product of subsequence counts, the landmarks' weights
fold into one table over all 2^20 subsequences (4 MB, broadcast), and scoring a
text is gathering that table over its symbols.  Scoring reads every document whole
and shuffles nothing.

An insult split by a space into parts of several letters is two words and often missed.

Defined results: a null or empty text, or one without words, gets the score of a
text with no evidence; without toxic or without clean training rows every score is
the share of toxic rows (0 if there are none); repeated rows get equal scores; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsync.llm.common import mix64, slices, staged, texts

MAX_TOXIC, MAX_CLEAN = 1200, 2500
LANDMARKS = 256
DECAY = 0.7
SPAN = 5  # last offset of a subsequence
# Of a training document, in each round: so many of its words of the highest score
# are looked at, and speak for so many of its sentences at most.
WORDS_TRIED, SENTENCES = 12, 3
MAX_WORD = 64  # a training word's first symbols
# The first model: standard errors below the log odds, occurrences counted of one
# document, and the word score from which a toxic document's word is positive.
DOUBT, OCCURRENCES, SEED_LEAST = 2.0, 4, 0.4
THRESHOLD = 0.3
ROUNDS = 3
CHUNK = 1 << 20  # symbols scored at a time

_OFFSETS = [(a, b, c) for c in range(3, SPAN + 1) for b in range(2, c) for a in range(1, b)]
_LETTERS = re.compile("[.!?\n]")


def _symbols() -> np.ndarray:
    table = np.full(0x3000, 255, np.uint8)
    for cp in range(0x3000):
        ch = chr(cp)
        if ch.isspace():
            table[cp] = 0
        elif "a" <= ch <= "z":
            table[cp] = cp - 96
        elif ch.isdigit():
            table[cp] = 32 + unicodedata.digit(ch)
        elif ch.isalpha():
            table[cp] = 28 + cp % 4 if cp < 0x370 else 1 + cp % 26
    return table


_TABLE = _symbols()
# Digits 0 to 9 beside letters: o i (2) e a s (6) t (8) (9); others are one symbol.
_LOOKS = np.array([15, 9, 27, 5, 1, 19, 27, 20, 27, 27], np.uint8)


def _plain(s: np.ndarray) -> np.ndarray:
    """The stream without fillers at every second place of a word (four equal symbols or
    more, or three digits or more between letters), and digits as symbols below 32."""
    starts = np.flatnonzero(s == 0)
    lengths = np.diff(starts, append=len(s)) - 1
    if len(starts) and lengths.max() >= 6:
        at = np.arange(len(s)) - np.repeat(starts, lengths + 1)
        even = (at % 2 == 0) & (at > 0)
        # the last two places of a word have nothing to be compared with
        ahead = np.append(s[2:], np.zeros(min(2, len(s)), np.uint8))
        equal = ~even | (ahead == s) | (at + 2 > np.repeat(lengths, lengths + 1))
        filled = np.logical_and.reduceat(equal, starts) & (lengths >= 8)
        digit = s >= 32
        if digit.any():
            filled |= np.logical_and.reduceat(even == digit, starts) & (lengths >= 6)
        if filled.any():
            s = s[~(np.repeat(filled, lengths + 1) & even)]
    digit = np.flatnonzero(s >= 32)
    if len(digit):
        padded = np.concatenate([[0], s, [0]])
        letter = (padded > 0) & (padded < 32)
        beside = letter[digit] | letter[digit + 2]
        s = s.copy()
        s[digit] = np.where(beside, _LOOKS[s[digit] - 32], 27)
    return s


def symbols(text: str) -> np.ndarray:
    """The text as symbols 0..31: each word opens with 0."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = np.where(cps < len(_TABLE), _TABLE[np.minimum(cps, len(_TABLE) - 1)], (1 + cps % 26).astype(np.uint8))
    s = np.concatenate([np.zeros(1, np.uint8), s[s != 255]])
    gap = s == 0
    s = s[~(gap & np.append(gap[1:], True))]  # one boundary before each word, none at the end
    starts = np.flatnonzero(s == 0)
    if len(starts) > 2:
        single = np.diff(starts, append=len(s)) == 2
        run = single[1:] & single[:-1]
        triple = run.copy()  # boundary between two of three single letters or more
        triple[1:] &= run[:-1]
        triple[:-1] |= triple[1:]
        triple &= run
        s = np.delete(s, starts[1:][triple])
    return _plain(s)


def _norms(longest: int) -> np.ndarray:
    """Kernel norm of a word of n letters whose subsequences all differ."""
    n = np.arange(longest + 1)
    total = np.zeros(longest + 1)
    for _, _, c in _OFFSETS:
        total += np.maximum(n + 1 - c, 0) * DECAY ** (2 * (c - 3))
    return np.sqrt(np.maximum(total, 1e-9))


def _remaining(s: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Letters from each place to the end of its word."""
    ends = np.append(starts[1:], len(s))
    return np.repeat(ends, ends - starts) - np.arange(len(s)) - 1


def word_scores(s: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The kernel expansion's value for each word of a symbol stream."""
    starts = np.flatnonzero(s == 0)
    if not len(starts):
        return np.zeros(0, np.float32)
    lengths = np.diff(starts, append=len(s)) - 1
    left = _remaining(s, starts)
    total = np.zeros(len(s), np.float32)
    w = np.concatenate([s, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    n = len(s)
    for c in range(3, SPAN + 1):
        able = left >= c
        part = np.zeros(n, np.float32)
        for a, b in [(a, b) for a, b, last in _OFFSETS if last == c]:
            key = (w[:n] << 15) | (w[a : n + a] << 10) | (w[b : n + b] << 5) | w[c : n + c]
            part += weights[key]
        total += np.where(able, part, 0) * np.float32(DECAY ** (c - 3))
    return np.add.reduceat(total, starts) / _norms(int(lengths.max()))[lengths].astype(np.float32)


def _subsequences(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of a symbol stream, weights normalised by word."""
    starts = np.flatnonzero(s == 0)
    lengths = np.diff(starts, append=len(s)) - 1
    left, word = _remaining(s, starts), np.repeat(np.arange(len(starts)), lengths + 1)
    scale = 1 / _norms(int(lengths.max(initial=0)))[lengths]
    w, out = s.astype(np.int32), []
    for a, b, c in _OFFSETS:
        i = np.flatnonzero(left >= c)
        key = (w[i] << 15) | (w[i + a] << 10) | (w[i + b] << 5) | w[i + c]
        out.append((word[i], key, DECAY ** (c - 3) * scale[word[i]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Landmarks:
    def __init__(self, words: list[bytes]):
        self.n = len(words)
        word, key, weight = _subsequences(np.frombuffer(b"".join(words), np.uint8))
        self.keys, at = np.unique(key, return_inverse=True)
        self.table = np.zeros((len(self.keys), self.n), np.float32)
        np.add.at(self.table, (at, word), weight.astype(np.float32))
        k = self.table.T.astype(np.float64) @ self.table
        values, vectors = np.linalg.eigh(k + 1e-6 * np.eye(self.n))
        self.whiten = vectors / np.sqrt(np.maximum(values, 1e-6))

    def features(self, words: list[bytes]) -> np.ndarray:
        """Nystroem features of words."""
        out = []
        for i in range(0, len(words), 1000):
            part = words[i : i + 1000]
            word, key, weight = _subsequences(np.frombuffer(b"".join(part), np.uint8))
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            k = np.zeros((len(part), self.n), np.float32)
            order = np.argsort(word[known], kind="stable")
            rows = word[known][order]
            if len(rows):
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                values = self.table[at[known][order]] * weight[known][order, None].astype(np.float32)
                k[rows[first]] = np.add.reduceat(values, first)
            out.append((k @ self.whiten).astype(np.float32))
        return np.concatenate(out)

    def folded(self, beta: np.ndarray) -> np.ndarray:
        """The linear model over the features as a table over all subsequences."""
        weights = np.zeros(1 << 20, np.float32)
        weights[self.keys] = self.table @ (self.whiten @ beta)
        return weights


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; y is +1 or -1."""
    a = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    ridge = np.eye(a.shape[1])
    ridge[-1, -1] = 1e-3
    beta = np.zeros(a.shape[1])
    active = None
    for _ in range(steps):
        inside = y * (a @ beta) < 1
        if active is not None and np.array_equal(inside, active):
            break
        active = inside
        active_rows = a[inside]
        z = active_rows * cost[inside, None].astype(a.dtype)
        beta = np.linalg.solve(ridge + (z.T @ active_rows).astype(np.float64), z.T @ y[inside])
    return beta[:-1], float(beta[-1])


def evidence(found: np.ndarray) -> np.ndarray:
    """What a document's word scores say: the three highest (insults come in numbers,
    chance likenesses do not) and the logarithm of how many words there are."""
    top = np.zeros(3)
    n = min(3, len(found))
    if n:
        top[:n] = np.sort(np.partition(found, len(found) - n)[-n:])[::-1]
    return np.append(top, np.log1p(len(found)))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve over :func:`evidence`, the last for the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    theta, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (y - p) - ridge @ theta)
        theta += step
        if np.abs(step).max() < 1e-6:
            break
    return theta


@dataclass
class Model:
    weights: np.ndarray  # over subsequences
    curve: np.ndarray  # over evidence

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _keys(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct subsequences of a stream and how often each occurs in it."""
    left, w, found = _remaining(s, np.flatnonzero(s == 0)), s.astype(np.int32), []
    for a, b, c in _OFFSETS:
        i = np.flatnonzero(left >= c)
        found.append((w[i] << 15) | (w[i + a] << 10) | (w[i + b] << 5) | w[i + c])
    return np.unique(np.concatenate(found), return_counts=True)


def log_odds(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Of each subsequence, by its occurrences in clean and toxic documents: the log odds
    of its rates, ``DOUBT`` standard errors down, or 0 if that is less."""
    odds = np.log((counts[1] + 0.5) / (documents[1] + 1)) - np.log((counts[0] + 0.5) / (documents[0] + 1))
    error = np.sqrt(1 / (counts[0] + 0.5) + 1 / (counts[1] + 0.5))
    return np.maximum(odds - DOUBT * error, 0).astype(np.float32)


def chosen_words(s: np.ndarray, counts: np.ndarray, score: np.ndarray, least: float | None) -> list[bytes]:
    """The words that speak for a document's sentences: those of the highest score, one a
    sentence, above ``least`` if that is given."""
    starts = np.flatnonzero(s == 0)
    ends, sentence = np.append(starts[1:], len(s)), np.repeat(np.arange(len(counts)), counts)
    words, taken = [], set()
    for i in np.argsort(-score, kind="stable")[:WORDS_TRIED]:
        if sentence[i] in taken or len(taken) == SENTENCES:  # one word speaks for its sentence
            continue
        if least is not None and score[i] <= least:
            break
        taken.add(sentence[i])
        words.append(s[starts[i] : min(ends[i], starts[i] + MAX_WORD)].tobytes())
    return words


def _order(words: list[bytes]) -> list[bytes]:
    """Distinct words, most frequent first, then in hash order."""
    found, counts = np.unique(np.array(words, dtype=object), return_counts=True)
    keys = [int.from_bytes(w[1:9].ljust(8, b"\0"), "little") for w in found]
    rank = np.lexsort((mix64(np.array(keys, np.uint64)), -counts)) if len(found) else []
    return [found[i] for i in rank]


def flat_model(share: float) -> Model:
    """Every document has the same probability."""
    flat = np.clip(share, 1e-9, 1 - 1e-9)
    return Model(np.zeros(1 << 20, np.float32), np.array([0.0] * 4 + [np.log(flat / (1 - flat))]))


def fit_words(positive: list[bytes], negative: list[bytes]) -> tuple[np.ndarray, float]:
    """The support vector machine between two lists of words, as a table over
    subsequences and a constant."""
    landmarks = Landmarks(_order(positive)[: LANDMARKS // 2] + _order(negative)[: LANDMARKS // 2])
    x = landmarks.features(positive + negative)
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    cost = np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative)))
    beta, bias = fit_svm(x, y, cost)
    return landmarks.folded(beta), bias


# ------------------------------------------------------------------ on Spark


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample of the labelled rows that are not held out, as :func:`train` takes
    it, staged: id, toxic, symbols (the streams of its sentences laid end to end), words
    (the number of words of each sentence)."""
    named = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    named = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        named.filter("toxic = 1")
        .orderBy(*by_hash)
        .limit(MAX_TOXIC)
        .unionByName(named.filter("toxic = 0").orderBy(*by_hash).limit(MAX_CLEAN))
    )

    def split(batches):
        for b in (part for whole in batches for part in slices(whole, "text")):
            streams, counts = [], []
            for text in texts(b.column(2)):
                parts = [symbols(p) for p in _LETTERS.split(text)]
                streams.append(b"".join(p.tobytes() for p in parts))
                counts.append([int((p == 0).sum()) for p in parts if len(p)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(streams, pa.binary()), pa.array(counts, pa.list_(pa.int32()))],
                names=["id", "toxic", "symbols", "words"],
            )

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select(F.col("doc_id").cast("string").alias("id"), F.col("toxic").cast("int").alias("toxic"), "text")
    )
    return staged(rows.mapInArrow(split, "id string, toxic int, symbols binary, words array<int>"), "toxicity-sample")


def _streams(batches):
    """id, toxic, symbol stream and words of each sentence of the sample's rows."""
    for b in batches:
        for id_, toxic, raw, words in zip(*(b.column(i) for i in range(4)), strict=True):
            yield id_.as_py(), toxic.as_py(), np.frombuffer(raw.as_py(), np.uint8), np.asarray(words.as_py(), np.int64)


def _rows(found: list[tuple], schema: pa.Schema):
    for at in range(0, len(found), 1 << 16):
        columns = zip(*found[at : at + (1 << 16)], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _count(sample: DataFrame) -> np.ndarray:
    """Occurrences of each subsequence in clean and toxic documents, at most
    ``OCCURRENCES`` of one document."""

    def run(batches):
        counts = np.zeros((2, 1 << 20), np.int64)
        for _, toxic, s, _ in _streams(batches):
            if len(s):
                keys, n = _keys(s)
                counts[toxic, keys] += np.minimum(n, OCCURRENCES)
        side, key = np.nonzero(counts)
        for at in range(0, len(key), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(side[part]), pa.array(key[part]), pa.array(counts[side[part], key[part]])],
                names=["side", "key", "n"],
            )

    rows = sample.mapInArrow(run, "side long, key long, n long").groupBy("side", "key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, 1 << 20))
    counts[rows["side"].to_numpy(), rows["key"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _choose(sample: DataFrame, weights: np.ndarray, bias: float, first: bool) -> tuple[list[bytes], list[bytes]]:
    """The words that speak for toxic and for clean documents under a model."""
    shared = sample.sparkSession.sparkContext.broadcast(weights)
    schema = pa.schema([("id", pa.string()), ("toxic", pa.int32()), ("words", pa.list_(pa.binary()))])

    def run(batches):
        found = []
        for id_, toxic, s, counts in _streams(batches):
            score = word_scores(s, shared.value) + bias
            if not len(score):
                continue
            least = (SEED_LEAST if first else 0.0) if toxic else None
            words = chosen_words(s, counts, score, least)
            if first and not toxic:  # and one word as it comes
                starts = np.flatnonzero(s == 0)
                i = len(starts) // 2
                end = starts[i + 1] if i + 1 < len(starts) else len(s)
                words.append(s[starts[i] : min(end, starts[i] + MAX_WORD)].tobytes())
            found.append((id_, toxic, words))
        yield from _rows(found, schema)

    rows = sample.mapInArrow(run, "id string, toxic int, words array<binary>").toArrow().sort_by("id").to_pylist()
    shared.unpersist()
    return tuple([w for r in rows if r["toxic"] == side for w in r["words"]] for side in (1, 0))


def _evidence_of(sample: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shared = sample.sparkSession.sparkContext.broadcast(weights)
    schema = pa.schema([("id", pa.string()), ("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        found = [(id_, y, evidence(word_scores(s, shared.value)).tolist()) for id_, y, s, _ in _streams(batches)]
        yield from _rows(found, schema)

    rows = sample.mapInArrow(run, "id string, toxic int, x array<double>").toArrow().sort_by("id")
    shared.unpersist()
    return np.array(rows["x"].to_pylist()), rows["toxic"].to_numpy().astype(float)


def train(sample: DataFrame) -> Model:
    """Fit a model to a :func:`training_sample`."""
    rows = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    documents = np.array([rows.get(0, 0), rows.get(1, 0)])
    if not documents.all():
        return flat_model(documents[1] / max(documents.sum(), 1))
    weights, bias = log_odds(_count(sample), documents), 0.0
    for round_ in range(ROUNDS):
        positive, negative = _choose(sample, weights, bias, round_ == 0)
        if not positive or not negative:
            break
        weights, bias = fit_words(positive, negative)
    return Model(weights, fit_curve(*_evidence_of(sample, weights)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep_columns: bool = False) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs`` (doc_id, text); on request
    with the whole row as struct ``row``, in which the text then goes, once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if keep_columns or f.name in ("doc_id", "text")]
    names = [f.name for f in fields]
    id_at, text_at = names.index("doc_id"), names.index("text")
    schema = T.StructType(
        [T.StructField("doc_id", fields[id_at].dataType), T.StructField("score", T.DoubleType())]
        + [T.StructField("predicted", T.IntegerType())]
        + [T.StructField("row", T.StructType(fields))] * keep_columns
    )

    def run(batches):
        model = shared.value
        for b in (part for whole in batches for part in slices(whole, pc.struct_field(whole.column(0), [text_at]))):
            rows = b.column(0)
            x = np.tile(evidence(np.zeros(0)), (b.num_rows, 1))
            pending, size = [], 0

            def flush():
                found = word_scores(np.concatenate([s for _, s in pending]), model.weights)
                sizes = [int((s == 0).sum()) for _, s in pending]
                ends = np.cumsum(sizes)
                for (row, _), end, n in zip(pending, ends.tolist(), sizes, strict=True):
                    x[row] = evidence(found[end - n : end])

            for row, text in enumerate(texts(pc.struct_field(rows, [text_at]))):
                s = symbols(text)
                if len(s):
                    pending.append((row, s))
                    size += len(s)
                if size >= CHUNK:
                    flush()
                    pending, size = [], 0
            if pending:
                flush()
            p = model.probability(x)
            found = [pc.struct_field(rows, [id_at]), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(found + [rows] * keep_columns, names=schema.names)

    named = [F.col("`" + n.replace("`", "``") + "`") for n in names]
    return docs.select(F.struct(*named).alias("row")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(training_sample(docs, labels))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
