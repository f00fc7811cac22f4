"""Language ID, quality rules, the similarity join and the pipeline."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import graphs, jaccard, langid, quality
from tests.llm.conftest import HOSTILE

SAMPLES = {
    "en": "the and of to in that with have this from they were which their would there about when",
    "de": "der die und das nicht mit sich auf eine werden über durch für können schön wäre größe",
    "fr": "le la les des est que pour dans avec sur être même où déjà très après été français",
}


def sentence(lang, n, rng):
    return " ".join(rng.choice(SAMPLES[lang].split()) for _ in range(n))


def test_languages_of_held_out_texts(spark, make_docs):
    rng = random.Random(4)
    rows = [(i, sentence(lang := rng.choice(list(SAMPLES)), rng.randint(5, 40), rng), lang) for i in range(240)]
    rows += [(1000 + i, t, None) for i, t in enumerate(HOSTILE)] + [(None, "der die das und", "de")]
    docs = make_docs(rows)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    got = langid.predict(docs.withColumn("out", langid.held_out(F.col("doc_id"))), model, ["doc_id", "lang", "out"]).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.out and r.lang]
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    for r in got:
        assert 0 <= r.score <= 1
        text = dict((d, t) for d, t, _ in rows)[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    again = langid.predict(docs.select("text", "doc_id").repartition(3), model, ["doc_id"]).collect()
    assert {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in again} == {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in got}


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "abc", None)])
    model = langid.train(docs)
    assert [(r.lang_pred, r.score) for r in langid.predict(docs, model, ["doc_id"]).collect()] == [("und", 0.0)]
    assert langid.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def _slow_features(text):
    """Feature numbers of all grams, one character after the other."""
    padded = " " + text + "  "
    code = lambda c: ord(c) if ord(c) > 0xFFFF else ord(c.lower()[0]) if c.isalpha() else 32
    out = []
    for i in range(len(text) + 1):
        for order in range(1, langid.ORDERS + 1):
            key = 0
            for j in range(order):
                key = (key * 0x110003 + code(padded[i + j])) % 2**64 if j else code(padded[i])
            out.append((key + order) * 0x9E3779B97F4A7C15 % 2**64 >> 64 - langid.FEATURE_BITS)
    return out


def test_probabilities_equal_the_slow_way(monkeypatch):
    rng = np.random.default_rng(5)
    model = langid.LanguageModel(["a", "b", "c"], rng.normal(size=(1 << langid.FEATURE_BITS, 3)).astype(np.float32), rng.normal(size=3), 1.7)
    texts = ["ab", "É", "日本 🙂 x", "Some longer text, with MARKS. " * 9, "z" * 3000]
    want = []
    for t in texts:
        f = _slow_features(t)
        z = (model.table[f].astype(np.float64).sum(axis=0) * langid.SCALE / len(f) + model.bias) / model.temperature
        want.append(np.exp(z) / np.exp(z).sum())
    for places in (1 << 18, 5000, 1100):
        monkeypatch.setattr(langid, "STRETCH", places)
        assert np.allclose(model.probabilities(texts), want, rtol=1e-4)


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(6)
    rows = []
    for _ in range(40):
        y = int(rng.integers(0, 3))
        at = np.unique(np.concatenate([rng.integers(0, 50, 6), [y * 7]])).astype(np.int32)
        rows.append((at, rng.random(len(at)).astype(np.float32) * 3, y))
    got, bias = langid.ftrl(rows, 3, epochs=2)
    z, n = {}, {}
    weight = lambda k, l1: 0.0 if abs(z.get(k, 0.0)) <= l1 else -np.sign(z[k]) * (abs(z[k]) - l1) / ((langid.BETA + n[k] ** 0.5) / langid.ALPHA + langid.L2)
    order = np.random.default_rng(7)
    for _ in range(2):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            features = [(int(f), float(v)) for f, v in zip(at, x)]
            scores = [weight(("bias", c), 0.0) + sum(v * weight((f, c), langid.L1) for f, v in features) for c in range(3)]
            p = np.exp(np.array(scores) - max(scores))
            p /= p.sum()
            for c in range(3):
                error = p[c] - (c == y)
                for f, v, l1 in [*((f, v, langid.L1) for f, v in features), ("bias", 1.0, 0.0)]:
                    key, g = (f, c), error * v
                    w, before = weight(key, l1), n.get(key, 0.0)
                    z[key] = z.get(key, 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / langid.ALPHA * w
                    n[key] = before + g * g
    for f in range(50):
        for c in range(3):
            assert abs(got[f, c] - weight((f, c), langid.L1)) < 1e-6
    assert np.allclose(bias, [weight(("bias", c), 0.0) for c in range(3)], atol=1e-6)
    assert 0 < np.count_nonzero(got) < 150


def test_the_sample_does_not_depend_on_the_layout(spark, make_docs):
    rng = random.Random(9)
    rows = [(i, sentence(lang := rng.choice(list(SAMPLES)), 12, rng), lang) for i in range(300)]
    models = [langid.train(make_docs(rows).repartition(n), 90) for n in (1, 7)]
    assert np.array_equal(models[0].table, models[1].table) and models[0].temperature == models[1].temperature


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 500)
    logits = 8.0 * np.eye(3)[np.where(rng.random(500) < 0.7, y, rng.integers(0, 3, 500))]
    assert best(logits, y) > 2 and langid.best_temperature(logits[:0], y[:0]) == 1.0


def best(logits, y):
    return langid.best_temperature(logits, y)


def slow_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside),
    )


def test_measures_equal_the_slow_way():
    rng = random.Random(9)
    texts = [t for t in HOSTILE if t is not None]
    texts += ["".join(rng.choice("ab \n\t#é\x0b\x1c\xa0$") for _ in range(rng.randint(0, 120))) for _ in range(200)]
    for text in texts:
        assert quality.measures(text) == slow_measures(text), text


def test_kneser_ney_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.zipf(1.2, 20_000) % quality.GRAMS, minlength=quality.GRAMS)
    p = np.exp(quality.kneser_ney(counts).astype(float)).reshape(-1, quality.CLASSES)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-3) and (p > 0).all()


def test_junk_goes_and_clean_texts_stay(make_docs):
    rng = random.Random(6)
    rows = [(i, sentence("en", rng.randint(60, 200), rng), "en") for i in range(150)]
    clean = {r[0] for r in rows}
    rows += [(500 + i, " ".join("".join(rng.choice("#$%&*<>|") for _ in range(6)) for _ in range(80)), "en") for i in range(5)]
    rows += [(600 + i, t, None) for i, t in enumerate(HOSTILE)]
    got = quality.judge(make_docs(rows), ["doc_id", "score"]).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert not any(r.kept and r.base_failed for r in got)
    assert not kept & set(range(500, 700))
    failed = {r.doc_id for r in got if r.base_failed}
    assert len(kept) >= 0.99 * len(clean - failed)
    assert quality.judge(make_docs([]), ["doc_id"]).count() == 0


def slow_classes(texts, similarity=0.8):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    links, root = dict.fromkeys(sets, 0), {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in sets}


def near_copies(rng):
    texts, n = {}, 0
    for group in range(12):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(4, 120))]
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 9)}"
            texts[n] = " ".join(words)
            n += 1
    for t in HOSTILE + ["a", "A  \n"]:
        texts[n] = t
        n += 1
    return texts


@pytest.mark.parametrize("limit,tile", [(2048, 512), (4, 3)])
def test_classes_and_links_equal_brute_force(spark, make_docs, monkeypatch, limit, tile):
    monkeypatch.setattr(jaccard, "LIMIT", limit)
    monkeypatch.setattr(jaccard, "TILE", tile)
    texts = near_copies(random.Random(limit))
    docs = make_docs([(i, t, None) for i, t in texts.items()])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.similar_classes(docs).collect()}
    assert got == slow_classes(texts)
    kept = jaccard.keep_one(docs)
    blank = {i for i, t in texts.items() if not (t or "").split()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in got.values()} | blank)
    assert kept.columns == docs.columns


def test_repeated_rows_and_missing_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(30))
    docs = make_docs([(1, text, None), (1, text, None), (None, text, None), (2, text + " x", None), (None, None, None)])
    got = jaccard.similar_classes(docs).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links, r.class_rows) for r in got) == [
        (-1, -1, 0, 1), (-1, 1, 3, 4), (1, 1, 3, 4), (1, 1, 3, 4), (2, 1, 3, 4),
    ]
    assert jaccard.keep_one(docs).count() == 2
    assert jaccard.similar_classes(make_docs([])).count() == 0


def test_rows_without_words_are_all_kept(make_docs):
    blank = [(1, None, "a"), (1, None, "a"), (2, " \n", "b"), (2, " \n", "b"), (3, "", None)]
    assert sorted(r.doc_id for r in jaccard.keep_one(make_docs(blank)).collect()) == [1, 1, 2, 2, 3]
    worded = [(4, "some words that are here", None)] * 3 + [(5, "some words that are here", None), (6, "other words that are there", None)]
    assert sorted(r.doc_id for r in jaccard.keep_one(make_docs(blank + worded)).collect()) == [1, 1, 2, 2, 3, 4, 6]


def test_runs_follow_the_target():
    assert jaccard.runs_for(target=0.9) < jaccard.runs_for(target=0.999) < 40


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in graphs.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert graphs.components(edges.limit(0)).count() == 0


def test_stars_take_one_step_and_tiles_leave_stars(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(5)
    a, b = rng.integers(-40, 40, (2, 60))
    node, root = graphs.stars(a, b)
    want = {r.node: r.root for r in graphs.components(spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")).collect()}
    assert dict(zip(node.tolist(), root.tolist())) == {n: r for n, r in want.items() if n != r} and len(set(node.tolist())) == len(node)
    written, stage = [], graphs.stage
    monkeypatch.setattr(graphs, "stage", lambda rows, name: written.append(name) or stage(rows, name))
    edges = spark.createDataFrame([(int(n), int(r)) for n, r in zip(node, root)] * 2, "a long, b long")
    assert {r.node: r.root for r in graphs.components(edges).collect() if r.node != r.root} == dict(zip(node.tolist(), root.tolist()))
    assert written == ["least"]
    # Each text is like the one before, and the ends are not alike.
    words = [f"w{i}" for i in range(200)]
    docs = make_docs([(i, " ".join([f"v{k}" for k in range(4 * i)] + words[4 * i :]), None) for i in range(25)])
    written.clear()
    got = jaccard.similar_classes(docs.coalesce(1)).collect()
    assert {r.class_id for r in got} == {0} and max(r.n_links for r in got) < 24
    assert written == ["least", "least"]


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    clean = [(i, sentence("en", 120, rng), "en", "s", 0) for i in range(60)]
    item = " ".join(f"q{i}" for i in range(20))
    rows = clean + [(100, clean[0][1], "en", "s", 0), (101, clean[1][1] + " " + item, "en", "s", 0), (102, None, None, None, None), (103, "12 34", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(apply(spark, docs, str(tmp_path)), "t")
        assert docs.columns == columns, name
    left = {r.doc_id for r in docs.collect()}
    assert not left & {100, 102, 103, 101}
    assert len(left) >= 57
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == left
    assert "ids" in out.columns and public_tokenizers.PATTERN


def test_estimates_equal_the_full_array(spark):
    rng = np.random.default_rng(3)
    numbers = np.concatenate([rng.zipf(1.3, 6000) % quality.GRAMS, rng.integers(0, quality.GRAMS, 400), np.arange(32)])
    folds = rng.integers(0, quality.FOLDS, len(numbers))
    counts = np.stack([np.bincount(numbers[folds == f], minlength=quality.GRAMS) for f in range(quality.FOLDS)], axis=1)
    gram = lambda g: "".join(chr(65 + (int(g) >> s & 31)) for s in (15, 10, 5, 0))
    some = np.flatnonzero(counts.sum(axis=1))
    rows = [("en", int(g), gram(g), *map(int, counts[g])) for g in some] + [("de", 1, "AAAA", 1, 0, 0, 0)]
    table = spark.createDataFrame(rows, "model string, h long, gram string, n0 long, n1 long, n2 long, n3 long")
    got = {r.h: r for r in quality.estimates(table, 4).collect() if r.model == "en"}
    assert len(got) == len(some)
    for f in range(quality.FOLDS):
        wanted = np.exp(quality.kneser_ney(counts.sum(axis=1) - counts[:, f]).astype(float))
        assert all(abs(got[g][f"p{f}"] - wanted[g]) < 1e-5 for g in some)


def test_model_tells_characters_apart_and_grows(spark, make_docs):
    """Digits, marks and letters that shared a class are told apart, and the model has a row for each different n-gram."""
    rng = random.Random(12)
    alphabets = ["0123", "5678", "éàèù"]
    rows = [(i, "".join(rng.choice(alphabets[i % 3]) for _ in range(400)), "en") for i in range(60)]
    docs = make_docs(rows).select(F.col("lang").alias("model"), F.pmod(F.xxhash64("text"), F.lit(quality.FOLDS)).cast("int").alias("fold"), "text")
    texts = [" " * (quality.ORDER - 1) + t for _, t, _ in rows]
    for n in (30, 60):
        grams = {t[i : i + quality.ORDER] for t in texts[:n] for i in range(len(t) - quality.ORDER + 1)}
        table = spark.read.parquet(*quality.train(docs.limit(n)))
        assert table.count() == table.select("h").distinct().count() == len(grams)


def test_marks_behind_words_raise_the_perplexity(make_docs):
    rng = random.Random(15)
    rows = [(i, sentence("en", 120, rng), "en") for i in range(100)]
    strewn = [" ".join(w + rng.choice("#$%&") * 3 for w in sentence("en", 120, rng).split()) for _ in range(5)]
    got = {r.doc_id: r for r in quality.judge(make_docs(rows + [(900 + i, t, "en") for i, t in enumerate(strewn)]), ["doc_id"]).collect()}
    assert not any(got[900 + i].kept for i in range(5)) and sum(got[i].kept for i in range(100)) >= 98


def test_scores_leave_out_the_own_text(make_docs):
    """Random characters do not foretell themselves; copies do not either."""
    rng = random.Random(13)
    rows = [(i, sentence("en", 100, rng), "en") for i in range(80)]
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(6)) for _ in range(80))
    rows += [(900, noise, "en"), (901, noise, "en")]
    got = {r.doc_id: r for r in quality.judge(make_docs(rows), ["doc_id"]).collect()}
    assert min(got[i].log_perplexity for i in (900, 901)) > 3 * max(got[i].log_perplexity for i in range(80))
    assert not got[900].kept and not got[901].kept
    assert got[0].log_perplexity > 0


def test_every_language_has_its_own_band(make_docs):
    """Forty languages, each with an alphabet of its own: junk of one that is not among the most frequent goes, its clean texts stay."""
    rng = random.Random(14)
    word = lambda first: "".join(chr(first + rng.randrange(12)) for _ in range(4))
    vocabularies = [[word(0x400 + 40 * i) for _ in range(12)] for i in range(40)]
    rows = [
        (100 * i + j, " ".join(rng.choice(vocabularies[i]) for _ in range(90)), f"l{i:02}") for i in range(40) for j in range(13 if i < 34 else 12)
    ]
    junk = {9000 + i: " ".join("".join(rng.choice("0123456789#%&") for _ in range(4)) for _ in range(90)) for i in (34, 39)}
    docs = make_docs(rows + [(i, t, f"l{i - 9000}") for i, t in junk.items()])
    got = quality.judge(docs, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows) + 2
    assert not [r for r in got if r.doc_id in junk and r.kept]
    assert len({(r.lang) for r in got if r.kept}) == 40
    small = [r for r in got if r.doc_id < 9000 and not r.base_failed]
    assert sum(r.kept for r in small) >= 0.97 * len(small)
    centres = {(r.lang, round(r.low + r.high, 9)) for r in got}
    assert len(centres) >= 40 and len({c for _, c in centres}) == 40
