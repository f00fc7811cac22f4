"""Quality rules with an n-gram model: modified Kneser-Ney perplexity and language-specific bands.

Spark counts all n-grams of ``ORDER`` characters of all texts by language, with nothing folded.  The shorter ones, their continuation counts, and
the interpolated modified Kneser-Ney estimates follow from them by aggregation and joins.  The estimates of the longest n-grams are the model:
a table of 64-bit hashes, sorted and partitioned by ranges of (language, hash), that grows with the corpus and the number of languages.  It is sent nowhere as a
whole: a task that scores texts gathers the distinct n-grams of about ``BLOCK`` characters and searches the parts of the table that hold
their languages, one slice at a time.

A text is scored by the counts of the other folds: every n-gram has ``FOLDS`` estimates, each without the counts of one fold, and equal texts
are in one fold.  Otherwise rare contexts, which junk consists of, would foretell themselves.  The log perplexity is the sum over all
characters for each letter or digit, so that marks strewn between words, which are easily foretold, do not lower it.

Every language has its own model and band, however many there are.  Its band of log perplexity lies ``BAND`` interquartile ranges beyond its
quartiles, over all texts that pass the base rules, and is wider for short texts, whose mean varies more: by the root of
``1 + SHORT / characters``.  Junk lies far outside, and no fixed share of the texts is rejected.

Defined results: a null text counts as empty, without words, and fails the base rules; a null language is a language of its own; repeated rows
are measured each; other columns are ignored, but kept ones must not be named like results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute, parquet
from pyspark.sql import Column, DataFrame, functions as F, types as T

from paperloom.llm.arrow import enter, filesystem, small_batches
from paperloom.llm.common import stage, union_all

ORDER = 5
FOLDS = 4
#: Bytes of text that are scored together, and rows of the model that are searched at a time.
BLOCK = 1 << 24
SLICE = 1 << 18
#: Entries that a counting task holds before it passes them on.
HELD = 1 << 19
#: The small alphabet of ``kneser_ney``, the estimates over a full array.
CLASSES = 32
GRAMS = CLASSES**4
BAND = 3.0
SHORT = 600
LEAST_WORDS = 50
MOST_REPEATED = 0.5
SYMBOLS = b"#*$%&|<>"
_LEAST = 1e-12
_TABLE: list[np.ndarray] = []


def _alphanumeric() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with gaps before each text, and the 64-bit hash of the n-gram that begins at each."""
    gap = " " * (ORDER - 1)
    points = np.frombuffer("".join(gap + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    each = _mixed(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    n = len(points) - ORDER + 1
    total = each[:n].copy()
    for i in range(1, ORDER):
        total *= np.uint64(0x5851F42D4C957F2D)
        total += each[i : n + i]
    return points, _mixed(total).view(np.int64)


def text_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, where the n-grams that end inside a text begin, and their hashes; as many for a text as it has characters."""
    points, hashes = gram_hashes(texts)
    used = np.ones(len(hashes), bool)
    ends = np.cumsum([len(t) + ORDER - 1 for t in texts[:-1]], dtype=np.int64)
    for back in range(1, ORDER):
        used[ends - back] = False
    at = np.flatnonzero(used)
    return points, at, hashes[at]


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2, and more, from the counts of counts."""
    n = [int((counts == i).sum()) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    d = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
    return np.array([0.0] + [min(max(x, 0.05), i) for i, x in enumerate(d, 1)])


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """log P(last | the ones before) for every n-gram number, from raw counts of the longest n-grams.

    The plain form of ``estimates``, over a full array of a small alphabet, to which these are compared.
    """
    levels = [counts]
    while levels[-1].size > CLASSES:
        levels.append((levels[-1] > 0).reshape(CLASSES, -1).sum(axis=0))
    p = np.full(1, 1.0 / CLASSES)
    for c in reversed(levels):
        rows = c.reshape(-1, CLASSES).astype(np.float64)
        total = rows.sum(axis=1, keepdims=True)
        cut = _discounts(c)[np.minimum(rows, 3).astype(int)]
        lower = np.broadcast_to(p if p.size == 1 else np.tile(p, rows.size // p.size), rows.size).reshape(rows.shape)
        share = np.divide(cut.sum(axis=1, keepdims=True), total, out=np.ones_like(total), where=total > 0)
        own = np.divide(rows - cut, total, out=np.zeros_like(rows), where=total > 0)
        p = (own + share * lower).reshape(-1)
    return np.log(np.maximum(p, _LEAST)).astype(np.float32)


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes in order, counts by fold and code points, from several of such."""
    hashes, first, place = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    counts = np.concatenate([p[1] for p in parts])
    sums = [np.bincount(place, counts[:, f], len(hashes)) for f in range(FOLDS)]
    return hashes, np.stack(sums, axis=1).astype(np.int64), np.concatenate([p[2] for p in parts])[first]


def count_grams(docs: DataFrame) -> DataFrame:
    """(model, h, gram, n0, n1, ...) over all texts: how often each fold has it."""
    names = [f"n{f}" for f in range(FOLDS)]

    def rows(model, found):
        hashes, counts, points = found
        for i in range(0, len(hashes), SLICE):
            part = points[i : i + SLICE]
            line = part.tobytes().decode("utf-32-le", "surrogatepass")
            grams = [line[j : j + ORDER] for j in range(0, len(line), ORDER)]
            columns = [pa.array(counts[i : i + SLICE, f]) for f in range(FOLDS)]
            columns = [pa.array([model] * len(grams), pa.string()), pa.array(hashes[i : i + SLICE]), pa.array(grams, pa.string()), *columns]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "h", "gram", *names])

    def run(batches):
        enter("quality")
        held: dict[str, list] = {}
        size = 0
        for batch in small_batches(batches, "text"):
            groups: dict[tuple, list[str]] = {}
            for model, fold, text in zip(*(batch.column(c).to_pylist() for c in ("model", "fold", "text"))):
                if text:
                    groups.setdefault((model, fold), []).append(text)
            for (model, fold), texts in groups.items():
                points, at, hashes = text_hashes(texts)
                distinct, first, n = np.unique(hashes, return_index=True, return_counts=True)
                counts = np.zeros((len(distinct), FOLDS), np.int64)
                counts[:, fold] = n
                chars = np.lib.stride_tricks.sliding_window_view(points, ORDER)[at[first]]
                held.setdefault(model, []).append((distinct, counts, chars))
                size += len(distinct)
            if size > HELD:
                held = {m: [_merged(parts)] for m, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > HELD // 2:
                    for model, parts in held.items():
                        yield from rows(model, parts[0])
                    held, size = {}, 0
        for model, parts in held.items():
            yield from rows(model, _merged(parts))

    parts = docs.select("model", "fold", "text").mapInArrow(run, "model string, h bigint, gram string, " + ", ".join(f"{n} bigint" for n in names))
    return parts.groupBy("model", "h").agg(F.first("gram").alias("gram"), *[F.sum(n).alias(n) for n in names])


def estimates(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(model, h, p0, p1, ...): P(last | the ones before) for each n-gram, without the counts of one fold each.

    Shorter n-grams count how many different ones continue them to the left.
    """
    folds = range(FOLDS)
    every = sum((F.col(f"n{f}") for f in folds), F.lit(0))
    top = stage(counts.select("model", "h", "gram", *[(every - F.col(f"n{f}")).alias(f"c{f}") for f in folds]), "quality-grams")
    levels = [top]
    for k in range(order - 1, 0, -1):
        more = [F.sum((F.col(f"c{f}") > 0).cast("bigint")).alias(f"c{f}") for f in folds]
        lower = levels[-1].groupBy("model", F.substring("gram", 2, k).alias("gram")).agg(*more)
        levels.append(lower.select("model", F.lit(None).cast("bigint").alias("h"), "gram", *[f"c{f}" for f in folds]))
    grams = stage(union_all([x.withColumn("k", F.lit(order - i)) for i, x in enumerate(levels)]), "quality-levels")
    seen = [F.sum((F.col(f"c{f}") == i).cast("double")).alias(f"s{f}_{i}") for f in folds for i in range(1, 5)]
    cuts = grams.groupBy("model", "k").agg(F.count(F.lit(1)).alias("chars"), *seen)
    cuts = stage(cuts.select("model", "k", "chars", *[d for f in folds for d in _cuts(f)]), "quality-discounts")
    found = None
    for k in range(1, order + 1):
        rows = grams.where(F.col("k") == k).drop("k").join(cuts.where(F.col("k") == k).drop("k"), "model")
        rows = rows.select("model", "h", "gram", "chars", *[f"c{f}" for f in folds], *[_cut(f).alias(f"d{f}") for f in folds])
        rows = rows.withColumns({"before": F.substring("gram", 1, k - 1), "after": F.substring("gram", 2, k - 1)})
        sums = [F.sum(f"{x}{f}").alias(f"{y}{f}") for f in folds for x, y in (("c", "total"), ("d", "free"))]
        rows = rows.join(rows.groupBy("model", "before").agg(*sums), ["model", "before"])
        if found is None:
            rows = rows.withColumns({f"lower{f}": 1 / F.col("chars") for f in folds})
        else:
            lower = found.select("model", F.col("gram").alias("after"), *[F.col(f"p{f}").alias(f"lower{f}") for f in folds])
            rows = rows.join(lower, ["model", "after"])
        col = lambda name, f: F.col(f"{name}{f}")
        value = lambda f: (col("c", f) - col("d", f) + col("free", f) * col("lower", f)) / col("total", f)
        found = rows.select("model", "h", "gram", *[F.when(col("total", f) > 0, value(f)).otherwise(col("lower", f)).alias(f"p{f}") for f in folds])
    return found.drop("gram")


def _cuts(f: int) -> list[Column]:
    """Discounts for counts 1, 2, and more, from the counts of counts, as ``_discounts``."""
    n = {i: F.col(f"s{f}_{i}") for i in range(1, 5)}
    y = F.when(n[1] > 0, n[1] / (n[1] + 2 * n[2])).otherwise(0.0)
    cut = lambda i: F.when(n[i] > 0, i - (i + 1) * y * n[i + 1] / n[i]).otherwise(0.5 * i)
    return [F.least(F.greatest(cut(i), F.lit(0.05)), F.lit(float(i))).alias(f"cut{f}_{i}") for i in (1, 2, 3)]


def _cut(f: int) -> Column:
    c = F.col(f"c{f}")
    return F.when(c == 0, 0.0).when(c == 1, F.col(f"cut{f}_1")).when(c == 2, F.col(f"cut{f}_2")).otherwise(F.col(f"cut{f}_3"))


def train(docs: DataFrame) -> list[str]:
    """The files of the model: log probabilities sorted by (model, h), a range of it in each file.  Needs model, fold, text."""
    logs = [F.log(F.greatest(F.col(f"p{f}"), F.lit(_LEAST))).cast("float").alias(f"p{f}") for f in range(FOLDS)]
    rows = estimates(count_grams(docs)).select("model", "h", *logs)
    return stage(rows.repartitionByRange("model", "h").sortWithinPartitions("model", "h"), "quality-model").inputFiles()


def _slices(files: list[str], wanted: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of the model, in slices, from the row groups that can hold one of the languages."""
    for file in files:
        store, place = filesystem(file)
        with store.open_input_file(place) as source:
            table = parquet.ParquetFile(source)
            column = table.schema_arrow.get_field_index("model")
            groups = []
            for i in range(table.num_row_groups):
                found = table.metadata.row_group(i).column(column).statistics
                if found is None or not found.has_min_max or any(found.min <= w <= found.max for w in wanted):
                    groups.append(i)
            if groups:
                yield from table.iter_batches(SLICE, row_groups=groups)


def look_up(files: list[str], wanted: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The log probabilities, by fold, of each language's hashes, which are in order."""
    found = {m: np.full((FOLDS, len(h)), np.log(_LEAST), np.float32) for m, h in wanted.items()}
    for rows in _slices(files, sorted(wanted)):
        models = rows.column("model")
        for model in compute.unique(models).to_pylist():
            if model not in wanted:
                continue
            own = rows.filter(compute.equal(models, model))
            have = own.column("h").to_numpy()
            keys = wanted[model]
            first, last = np.searchsorted(keys, have[0]), np.searchsorted(keys, have[-1], "right")
            place = np.minimum(np.searchsorted(have, keys[first:last]), len(have) - 1)
            same = have[place] == keys[first:last]
            for f in range(FOLDS):
                found[model][f, first:last][same] = own.column(f"p{f}").to_numpy()[place[same]]
    return found


def log_perplexities(files: list[str], batches: list[pa.RecordBatch]) -> list[np.ndarray]:
    """Of each text of each batch, 0 for empty ones."""
    parts, wanted = [], {}
    for b, batch in enumerate(batches):
        groups: dict[str, list[int]] = {}
        texts, models, folds = (batch.column(c).to_pylist() for c in ("text", "model", "fold"))
        for i, text in enumerate(texts):
            if text:
                groups.setdefault(models[i], []).append(i)
        for model, some in groups.items():
            points, _, hashes = text_hashes([texts[i] for i in some])
            distinct, place = np.unique(hashes, return_inverse=True)
            sizes = np.array([len(texts[i]) for i in some])
            begins = np.cumsum(sizes + ORDER - 1) - sizes - ORDER + 1
            signs = np.maximum(1, np.add.reduceat(_alphanumeric()[points], begins, dtype=np.int64))
            parts.append((b, model, np.array(some), sizes, signs, np.array([folds[i] for i in some]), distinct, place.astype(np.int32)))
            wanted.setdefault(model, []).append(distinct)
    keys = {m: np.unique(np.concatenate(h)) for m, h in wanted.items()}
    found = look_up(files, keys) if keys else {}
    out = [np.zeros(batch.num_rows) for batch in batches]
    for b, model, some, sizes, signs, folds, distinct, place in parts:
        logs = found[model][:, np.searchsorted(keys[model], distinct)].astype(np.float64)
        values = logs[np.repeat(folds, sizes), place]
        out[b][some] = -np.add.reduceat(values, np.cumsum(sizes) - sizes) / signs
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    block, size = [], 0
    for batch in small_batches(batches, "text"):
        block.append(batch)
        size += compute.sum(compute.binary_length(batch.column("text"))).as_py() or 0
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, i) for i, w in enumerate(words)), np.int64, n)
    pair = ids[:-1] * n + ids[1:]
    if n >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * n + ids[2:]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not twice.size:
        return 0
    hit = np.isin(window, twice)
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i : n - 2 + i] |= hit
    return int(inside.sum())


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()
    gaps = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - gaps, symbols, len(lines) - len(set(lines)), repeated_words(words)


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the measures, base_failed, kept, log_perplexity, low, high.  Needs the columns text and lang."""
    # A missing language is none of the named ones.
    language = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("model")
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    # A kept text travels once.
    kept = ["text" if c == "text" else f"_k{i}" for i, c in enumerate(keep)]
    others = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, kept) if c != "text"]
    rows = docs.select(*others, language, fold, "text")
    files = train(rows)

    def run(batches):
        enter("quality")
        for block in _blocks(batches):
            for batch, mean in zip(block, log_perplexities(files, block)):
                found = list(zip(*(measures(t or "") for t in batch.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in kept]
                    + [batch.column("model")]
                    + [pa.array(f, pa.int64()) for f in found]
                    + [pa.array(mean)],
                    names=[*kept, "model", *_MEASURES, "log_perplexity"],
                )

    fields = [rows.schema[c] for c in kept] + [T.StructField("model", T.StringType())]
    fields += [T.StructField(m, T.LongType()) for m in _MEASURES] + [T.StructField("log_perplexity", T.DoubleType())]
    scored = stage(rows.mapInArrow(run, T.StructType(fields)), "quality")
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(int(100 * MOST_REPEATED)) * F.col("n_words")
    failed = (F.col("n_words") < LEAST_WORDS) | repeated
    quartiles = scored.where(~failed).groupBy("model").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q"))
    # A language whose texts hardly differ still gets a band of some width.
    reach = F.lit(BAND) * F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.02))
    # Written, so that Spark knows its size and chooses the join by it.
    bands = stage(quartiles.select("model", F.struct(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"), reach.alias("reach")).alias("band")), "bands")
    wide = F.sqrt(1 + F.lit(SHORT) / F.greatest(F.lit(1), F.col("word_chars") + F.col("n_words")))
    out = scored.join(bands, "model", "left").select("*", failed.alias("base_failed"), wide.alias("wide"))
    low = F.col("band.low") - F.col("band.reach") * F.col("wide")
    high = F.col("band.high") + F.col("band.reach") * F.col("wide")
    inside = F.col("log_perplexity").between(low, high)
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(kept, keep)],
        *_MEASURES,
        "base_failed",
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"),
        "log_perplexity",
        low.alias("low"),
        high.alias("high"),
    )
