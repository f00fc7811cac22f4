"""Whitening, phrase collocations and token counts against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import counts, phrases, whiten
from paperloom.llm.queries import QUERIES

from tests.conftest import SF_DIR
from tests.llm.conftest import HOSTILE

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- token counts -------------------------------------------------------------


def _library(texts):
    from tokenizers import Tokenizer

    return [len(e) for e in Tokenizer.from_file(TOKENIZER).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_are_those_of_the_library(spark):
    got = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    texts = [d.text or "" for d in docs]
    assert len(got) == len(docs)
    for doc, text, n in zip(docs, texts, _library(texts)):
        assert got[doc.doc_id][1:] == (len(text.encode()), n, n > 1024)


def test_token_counts_of_odd_texts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(counts, "BLOCK_BYTES", 4000)
    texts = [
        *HOSTILE, "a  <|endoftext|>  b<|endoftext|>", "<|endoftext|", "  two  spaces ", "don't I'LL we've 12 34٠١",
        "à᪰ 123԰Ա ꬰ", "\r\n\r\n x y z　", "<|endoftext|><|endoftext|>",
    ]
    rows = [(i % 20, t, None) for i, t in enumerate(texts * 2)]
    got = counts.count_tokens(make_docs(rows), TOKENIZER, ["doc_id", "score", "ids"], "n").collect()
    assert {(r.score, r.ids) for r in got} == {("x", "x")}
    wanted = Counter(zip((r[0] for r in rows), _library([t or "" for _, t, _ in rows])))
    assert Counter((r.doc_id, r.n) for r in got) == wanted


def test_token_counts_of_long_texts_and_words(spark):
    word = "".join(random.Random(1).choices("abcdefgh", k=300_000))
    long = " ".join(random.Random(2).choices(["alpha", "beta,", "gamma\n", "δέλτα"], k=400_000))
    texts = [word, long, long + "<|endoftext|>" + long]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(counts.count_tokens(rows, TOKENIZER, ["doc_id"]).collect())
    assert [r.n_tokens for r in got] == _library(texts)


def test_token_counts_of_an_empty_table_and_refused_names(spark, make_docs):
    empty = make_docs([])
    assert counts.count_tokens(empty, TOKENIZER, ["doc_id", "kept"]).collect() == []
    with pytest.raises(ValueError):
        counts.count_tokens(empty.withColumn("n_tokens", F.lit(1)), TOKENIZER, ["n_tokens"])


def test_each_pre_token_is_encoded_once_and_no_ids_are_kept(spark):
    """One row per block and distinct pre-token is all that is shuffled by pre-token."""
    docs = spark.createDataFrame([(i, "one two two three") for i in range(500)], "doc_id long, text string").coalesce(1)
    cutter = counts.PreTokens(open(TOKENIZER).read())
    dealt, packed = counts.frequencies(["one two two three"] * 500, cutter, 4)
    assert len(dealt) == 4 and sorted(sum(dealt, [])) == [b" three", b" two", b"one"]
    assert {r.n_tokens for r in counts.count_tokens(docs, TOKENIZER, ["doc_id"]).collect()} == {4}


def test_packed_numbers_return():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**35, 5, 2**62])
    data, ends = counts.pack_numbers(values)
    back, again = counts.unpack_numbers(data)
    assert back.tolist() == values.tolist() and again.tolist() == ends.tolist()
    assert counts.unpack_numbers(np.zeros(0, np.uint8))[0].tolist() == []


# --- phrases ------------------------------------------------------------------


def _pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def _brute_counts(rows, threshold, longest=5):
    found, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in _pieces(text):
            words[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    found[lang, tuple(w[i : i + m])] += 1
    return {k: n for k, n in found.items() if n >= threshold}, words


def _brute_scores(found, words):
    out = {}
    for (lang, w), a in found.items():
        if len(w) < 2:
            continue
        held = any(
            lang == other and len(v) > len(w) and n >= a and any(v[i : i + len(w)] == w for i in range(len(v)))
            for (other, v), n in found.items()
        )
        if held:
            continue
        cuts = []
        for k in range(1, len(w)):
            l, r = found[lang, w[:k]], found[lang, w[k:]]
            cuts.append((1000 * a * words[lang] // (l * r), k, a, l, r))
        score, _, a, l, r = min(cuts)
        out[lang, " ".join(w)] = (a, l, r, words[lang], score)
    return out


def _texts(seed, n):
    """Skewed words with planted phrases, some of them in few texts only."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    planted = ["alpha beta gamma delta eps zeta", "New York", "la la la la la", "ünï cödé ÀB", "x y z"]
    rows = []
    for i in range(n):
        parts = [words[min(int(draw.expovariate(0.12)), 59)] for _ in range(draw.randint(0, 40))]
        if draw.random() < 0.4 or i > n - 8:
            parts.insert(draw.randint(0, len(parts)), draw.choice(planted))
        text = draw.choice([" ", "  ", "\t"]).join(parts)
        rows.append((text.replace("w9 ", "w9. ").replace("w8 ", "w8\n"), draw.choice(["en", "fr", None, "und", ""])))
    return rows + [(None, "en"), ("", None), (" \t ", "xx"), (".,;", "xx")]


def _phrase_rows(spark, rows, partitions=3):
    table = spark.createDataFrame(rows, "text string, lang string").withColumns({"h": F.lit("x"), "n": F.lit(1), "m": F.lit(2)})
    return table.repartition(partitions)


@pytest.mark.parametrize("shards, threshold", [(1, 5), (3, 7)])
def test_phrase_counts_and_scores(spark, monkeypatch, shards, threshold):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(phrases, "HELD", 300)
    # So few bytes that phrases meet in them: more is sent, nothing may change.
    monkeypatch.setattr(phrases, "SLOTS", 256 if shards == 1 else 1 << 16)
    rows = _texts(shards, 300)
    found, words = phrases.count_phrases(_phrase_rows(spark, rows), threshold, shards=shards)
    wanted, total = _brute_counts(rows, threshold)
    got = found.collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in got} == wanted and len(got) == len(wanted)
    assert {r.m for r in got} == {1, 2, 3, 4, 5}
    assert {r.lang: r.n for r in words.collect()} == {"xx": 0, **total}
    scored = phrases.score_collocations(found, words)
    scores = _brute_scores(wanted, total)
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in scored.collect()} == scores
    best = phrases.best_collocations(scored, 5, spread=3).collect()
    for lang in {lang for lang, _ in scores}:
        ranked = sorted(
            ((-s[4], -s[0], p.encode()) for (l, p), s in scores.items() if l == lang)
        )[:5]
        mine = sorted((r.rank, r.phrase) for r in best if r.lang == lang)
        assert mine == [(i + 1, p.decode()) for i, (_, _, p) in enumerate(ranked)]


def test_products_beyond_64_bits(spark):
    big = 10**14
    found = spark.createDataFrame(
        [(1, 1, 0, 1, big, "en", "a"), (1, 2, 0, 2, big, "en", "b"), (2, 1, 2, 3, big - 1, "en", "a b")],
        "m int, a long, b long, h long, n long, lang string, phrase string",
    )
    words = spark.createDataFrame([("en", 10**16)], "lang string, n long")
    (row,) = phrases.score_collocations(found, words).collect()
    assert row.score == 1000 * (big - 1) * 10**16 // (big * big)


def test_a_long_text_without_piece_ends(spark):
    """Stretches of one text are cut at gaps, and phrases over the cut are counted."""
    text = " ".join(["ab", "cd", "ef"] * 180_000)
    found, words = phrases.count_phrases(_phrase_rows(spark, [(text, "en")], 1), 100, 3, shards=1)
    got = {r.phrase: r.n for r in found.collect()}
    n = 540_000
    assert words.first().n == n
    assert got["ab"] == got["cd"] == got["ef"] == n // 3
    assert got["ab cd"] == got["cd ef"] == n // 3 and got["ef ab"] == n // 3 - 1
    assert got["ab cd ef"] == n // 3 and got["cd ef ab"] == n // 3 - 1


def test_phrases_of_an_empty_table(spark):
    found, words = phrases.count_phrases(_phrase_rows(spark, []).limit(0), shards=1)
    assert found.collect() == [] and words.collect() == []
    assert phrases.best_collocations(phrases.score_collocations(found, words)).collect() == []


def test_two_texts_under_one_fingerprint_start_anew(spark, monkeypatch):
    """Under the first seed all words share two fingerprints; the result is that of the second."""
    real, seeds = phrases._write_blocks, []

    def write(docs, path, seed, shards):
        seeds.append(seed)
        if seed:
            return real(docs, path, seed, shards)
        real(docs, path + "-plain", seed, shards)

        def few(batches):
            for batch in batches:
                marks = [(np.frombuffer(m, np.uint64) % 2).tobytes() for m in batch.column("marks").to_pylist()]
                yield batch.set_column(batch.schema.get_field_index("marks"), "marks", pa.array(marks, pa.binary()))

        plain = spark.read.parquet(path + "-plain")
        plain.mapInArrow(few, plain.schema).write.partitionBy("shard").parquet(path)

    monkeypatch.setattr(phrases, "_write_blocks", write)
    rows = [("a b c d. b c a", "en")] * 10
    found, _ = phrases.count_phrases(_phrase_rows(spark, rows, 1), 5, 2, shards=1)
    assert seeds == [0, 1]
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect()} == _brute_counts(rows, 5, 2)[0]


# --- whitening ----------------------------------------------------------------


def _brute_whitening(vectors):
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    off = fit - sums / n
    values, columns = np.linalg.eigh(off.T @ off / n)
    values, columns = values[::-1], columns[:, ::-1]
    return x, n, sums, values, columns


def _check_whitening(rows, ids, vectors):
    x, n, sums, values, columns = _brute_whitening(vectors)
    k = min(4, int((values > values[0] * 1e-13 * len(values)).sum()))
    assert len(rows) == k * len(ids)
    got = sorted((r.vec_id, r.component, r) for r in rows)
    wanted = sorted(zip(ids, range(len(ids))))
    for j in range(k):
        mine = np.array([r.whitened for _, c, r in got if c == j + 1])
        theirs = np.array([(x[i] - sums / n) @ columns[:, j] / np.sqrt(values[j]) for _, i in wanted])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8
    for (_, c, r) in got:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9)
    deviations = sorted((i, int(((n * x[at] - sums) ** 2).sum())) for i, at in wanted for _ in range(k))
    assert sorted((r.vec_id, r.deviation) for r in rows) == deviations


def test_whitening_of_the_embeddings(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect()
    _check_whitening(rows, [r.vec_id for r in table], [r.embedding for r in table])


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS label", "1 AS d", "2 AS i")


def test_whitening_leaves_out_what_has_no_vector_and_fits_copies_once(spark):
    draw = np.random.default_rng(3)
    good = (draw.normal(size=(40, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.2])).tolist()
    bad = [None, [], [None] * 6, [float("nan")] * 6, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[0])] * 30 + [(None, good[1])] + [(900 + i, v) for i, v in enumerate(bad)]
    out = whiten.whiten(_vectors(spark, rows), ["vec_id", "label", "d"])
    assert {(r.label, r.d) for r in out.select("label", "d").collect()} == {("x", 1)}
    nulls = out.where("vec_id is null").collect()
    assert len(nulls) == 4
    known = [r for r in out.collect() if r.vec_id is not None]
    _check_whitening(known, list(range(40)) + [0] * 30, good + [good[0]] * 30)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0, 3.0]] * 3, [[1.0, 2.0, 3.0], [2.0, 2.0, 3.0]], [[0.0]], []])
def test_whitening_of_few_directions(spark, vectors):
    out = whiten.whiten(_vectors(spark, list(enumerate(vectors))), ["vec_id"]).collect()
    different = len({tuple(v) for v in vectors})
    assert len(out) == (len(vectors) if different > 1 else 0)
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == 1 for r in out)


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [-(2.0**20), 2.0]), (2, [5.0, -(2.0**18)])]
    out = whiten.whiten(_vectors(spark, rows), ["vec_id"]).collect()
    _check_whitening(out, [0, 1, 2], [v for _, v in rows])
    with pytest.raises(Exception, match="leaves 64 bits"):
        whiten.whiten(_vectors(spark, [(0, [1e300, 1.0]), (1, [0.0, 0.0])]), ["vec_id"]).collect()
    with pytest.raises(ValueError):
        whiten.whiten(_vectors(spark, rows).withColumn("n", F.lit(1)), ["vec_id", "n"])


@pytest.mark.parametrize("d, rank", [(1, 1), (5, 5), (16, 9), (33, 33), (12, 0)])
def test_jacobi_on_the_triangular_factor(d, rank):
    draw = np.random.default_rng(d)
    half = draw.normal(size=(d, rank)) * 10.0 ** -np.arange(rank).clip(0, 4)
    matrix = half @ half.T
    factor = whiten.pivoted_cholesky(matrix)
    assert factor.shape == (d, rank)
    assert np.allclose(factor @ factor.T, matrix, atol=1e-12)
    values, vectors = whiten.eigen(matrix)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-9, atol=1e-14)
    assert np.allclose(vectors @ vectors.T, np.eye(rank), atol=1e-10)


def test_equal_eigenvalues():
    values, vectors = whiten.eigen(np.eye(4) * 3)
    assert values.tolist() == [3.0] * 4 or np.allclose(values, 3)
    assert np.allclose(vectors @ vectors.T, np.eye(4))
