"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1-, 2- and 3-grams of the lower-case letters (anything else is a gap), with document frequencies counted over
all labelled rows.  Weights are fitted by FTRL-proximal with elastic-net penalties (per-coordinate steps; the L1 part keeps
most weights at zero) on a sample of labelled rows of at most about ``SAMPLE_ROWS`` in all, drawn evenly per language; a part of the
sample is held back to fit one temperature that calibrates the scores.  A term frequency is a share of the text's
n-grams, so a prediction is a mean of weights over all places of the whole text.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if there is nothing to
learn from; rows without a language are not learned from; repeated rows get equal results; of equally probable languages the first by name is
told; texts are worked on in stretches, so memory does not follow their length; other columns are ignored, but kept ones must not be named
``lang_pred`` or ``score``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from paperloom.llm.arrow import enter, small_batches

FEATURE_BITS = 17
ORDERS = 3
#: Rows that the weights and the temperature are fitted on.
SAMPLE_ROWS = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1e-4
#: Brings mean term weights to the order of one.
SCALE = 40.0
UNKNOWN = "und"
#: Places of texts that are worked on at a time.
STRETCH = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case code point of letters, a space for the rest, up to U+FFFF."""
    if not _TABLE:
        table = np.full(1 << 16, 32, np.uint32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                table[c] = ord(chr(c).lower()[0])
        _TABLE.append(table)
    return _TABLE[0]


def _features(text: str) -> list[np.ndarray]:
    """Feature numbers of every place, one array per order; the last places lack what follows them."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 1 << 16, _letters()[np.minimum(points, 0xFFFF)], points).astype(np.uint64)
    out, key = [], codes
    for order in range(1, ORDERS + 1):
        if order > 1:
            key = key * np.uint64(0x110003) + np.concatenate([codes[order - 1 :], np.full(order - 1, 32, np.uint64)])
        out.append(((key + np.uint64(order)) * _SPREAD >> np.uint64(64 - FEATURE_BITS)).astype(np.int32))
    return out


def gram_features(texts: list[str], places: int = STRETCH) -> Iterator[tuple[list[int], list[np.ndarray], np.ndarray]]:
    """Groups of texts, or stretches of them, of about ``places`` places at most.

    Each group has the number of the text of every part, the feature numbers of every place, one array per order, and where parts
    begin and end in them, one after the other.  A gap stands before a text and behind it.
    """
    owners, parts, spans, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) + 1, places):
            n = min(places, len(text) + 1 - at)
            if owners and size + n > places:
                yield owners, _features("".join(parts)), np.array(spans)
                owners, parts, spans, size = [], [], [], 0
            # Place ``at`` is the gap for 0 and the character before it otherwise; two more are what its grams need.
            part = (" " if at == 0 else "") + text[max(0, at - 1) : at + n + 1]
            part += " " * (n + 2 - len(part))
            owners.append(i)
            parts.append(part)
            spans += [size, size + n]
            size += n + 2
    if owners:
        yield owners, _features("".join(parts)), np.array(spans)


@dataclass
class LanguageModel:
    languages: list[str]
    #: Weight times inverse document frequency, feature by language.
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        # The weights of all places of a group, for every language, are in memory at once.
        for owners, features, spans in gram_features(texts, max(1 << 10, STRETCH * 4 // len(self.languages))):
            for f in features:
                np.add.at(total, owners, np.add.reduceat(self.table[f], spans, axis=0)[::2])
        sizes = np.array([len(t) + 1 for t in texts]) * ORDERS
        z = (total * (SCALE / sizes[:, None]) + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 5, is 0 (a missing id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _document_counts(rows: DataFrame) -> DataFrame:
    """(feature, n) over all rows; a task sends each feature once."""

    def run(batches):
        enter("langid")
        count, mark = np.zeros(1 << FEATURE_BITS, np.int64), np.zeros(1 << FEATURE_BITS, bool)
        for batch in small_batches(batches, "text", 1 << 20):
            last = 0
            for owners, features, spans in gram_features(batch.column("text").to_pylist()):
                for owner, a, b in zip(owners, spans[::2].tolist(), spans[1::2].tolist()):
                    if owner != last:
                        count += mark
                        mark[:] = False
                        last = owner
                    for f in features:
                        mark[f[a:b]] = True
            count += mark
            mark[:] = False
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used])], names=["feature", "n"])

    return rows.select("text").mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature by class) and bias from rows of (feature numbers, values, class)."""
    shape = (1 << FEATURE_BITS) + 1, classes
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        size = np.maximum(np.abs(z) - l1, 0)
        return -np.sign(z) * size / ((BETA + np.sqrt(n)) / ALPHA + L2)

    random = np.random.default_rng(7)
    last = shape[0] - 1
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(z[at], n[at], L1)
            b = weights(z[last], n[last], 0.0)
            s = x @ w + b
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            for where, g, v in ((at, x[:, None] * p, w), (last, p, b)):
                grown = n[where] + g * g
                z[where] += g - (np.sqrt(grown) - np.sqrt(n[where])) / ALPHA * v
                n[where] = grown
    return weights(z[:-1], n[:-1], L1), weights(z[last], n[last], 0.0)


def best_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    if not len(classes):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(classes)), classes]).mean())

    a, b, ratio = -2.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from the columns text and lang.  Fitting runs in one task over the bounded sample."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), np.zeros(0), 1.0)
    frequency = np.zeros(1 << FEATURE_BITS)
    for r in _document_counts(rows).collect():
        frequency[r[0]] = r[1]
    idf = (np.log((1 + sum(counts.values())) / (1 + frequency)) + 1).astype(np.float32)
    each = max(1, sample_rows // len(languages))
    shares = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(each / counts[k]))])
    # Copies of a text fall on the same side of the split.
    calibrate = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    # Drawn by a hash of the row, so the same rows whatever files they lie in; copies under other ids are drawn apart.
    key = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    chance = F.pmod(F.xxhash64(F.lit(11), *key), F.lit(1 << 30)) / (1 << 30)
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    drawn = labelled.where(chance < shares[F.col("lang")]).select("text", "lang", calibrate.alias("calibrate"))
    number = {k: i for i, k in enumerate(languages)}
    weights_of = docs.sparkSession.sparkContext.broadcast(idf)

    def described(batches):
        enter("langid")
        for batch in small_batches(batches, "text", 1 << 20):
            texts = batch.column("text").to_pylist()
            met: list[dict] = [{} for _ in texts]
            for owners, features, spans in gram_features(texts):
                for owner, a, b in zip(owners, spans[::2].tolist(), spans[1::2].tolist()):
                    used, n = np.unique(np.concatenate([f[a:b] for f in features]), return_counts=True)
                    known = met[owner]
                    for u, c in zip(used.tolist(), n.tolist()):
                        known[u] = known.get(u, 0) + c
            at, values = [], []
            for text, known in zip(texts, met):
                used = np.array(sorted(known), np.int32)
                n = np.array([known[u] for u in used.tolist()])
                at.append(used.tobytes())
                values.append((n * weights_of.value[used] * (SCALE / (ORDERS * (len(text) + 1)))).astype(np.float32).tobytes())
            y = [number[x] for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.binary()), pa.array(values, pa.binary()), pa.array(y, pa.int32()), batch.column("calibrate")],
                names=["at", "x", "y", "calibrate"],
            )

    k = len(languages)

    def fit(batches):
        fitted, kept = [], []
        for batch in batches:
            for a, x, y, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                (kept if c else fitted).append((np.frombuffer(a, np.int32), np.frombuffer(x, np.float32), y))
        w, b = ftrl(sorted(fitted or kept, key=lambda r: (r[2], r[0].tobytes())), k)
        logits = np.array([x @ w[a] + b for a, x, _ in kept]).reshape(-1, k)
        t = best_temperature(logits, np.array([y for _, _, y in kept], int))
        used = np.flatnonzero(np.abs(w).sum(axis=1))
        flat = pa.array([r.tobytes() for r in w[used]] + [b.tobytes(), np.array([t]).tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(used.tolist() + [-1, -2], pa.int64()), flat], names=["feature", "w"])

    table, bias, temperature = np.zeros((1 << FEATURE_BITS, k)), np.zeros(k), 1.0
    made = drawn.mapInArrow(described, "at binary, x binary, y int, calibrate boolean")
    for feature, w in made.repartition(1).mapInArrow(fit, "feature bigint, w binary").collect():
        values = np.frombuffer(w)
        if feature >= 0:
            table[feature] = values
        elif feature == -1:
            bias = values
        else:
            temperature = float(values[0])
    return LanguageModel(languages, (table * idf[:, None]).astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang_pred, score of the column text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    own = ["_text" if c == "text" else c for c in keep]

    def run(batches):
        enter("langid")
        model = shared.value
        for batch in small_batches(batches, "_text", 1 << 20):
            texts = batch.column("_text").to_pylist()
            known = [i for i, t in enumerate(texts) if t and _LETTER.search(t) and model.languages]
            label, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                p = model.probabilities([texts[i] for i in known])
                for i, j, s in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    label[i], score[i] = model.languages[j], s
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array(label, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    # A kept text travels once.
    rows = docs.select(*[c for c in keep if c != "text"], F.col("text").alias("_text"))
    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType(fields))
