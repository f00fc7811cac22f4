"""Chat formatting, shards, licenses and decontamination."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import chat, decontaminate, licenses, shards
from tests.llm.conftest import HOSTILE


def formatted(spark, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_chats(table.withColumn("formatted", F.lit("clash")))
    return {r.conv_id: r for r in chat.read_chats(made).collect()}


def test_chats_come_back_whatever_they_say(spark):
    random.seed(3)
    rows, wanted = [], {}
    for conv in range(40):
        turns = []
        for t in range(random.randint(1, 7)):
            text = "".join(random.choice(["<", "|", "\\", "<|im_end|>", "<|im_next|>", "\n", "é🙂", "a", "<\\|"]) for _ in range(random.randint(0, 9)))
            turns.append((random.choice(["user", "assistant", "system", "odd\nrole%0A<|"]), text))
            rows.append((conv, t, *turns[-1]))
        wanted[conv] = turns
    random.shuffle(rows)
    got = formatted(spark, rows)
    for conv, turns in wanted.items():
        r = got[conv]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert "".join(r.learned) == "".join(x for role, x in turns if role == "assistant")
        assert sum(m.chars for m in r.loss_mask) == len(r.formatted)
        # Adjacent turns of one role are one block.
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert r.formatted.count("<|im_start|>") == blocks == r.formatted.count("<|im_end|>")


def test_chat_nulls_ties_and_repeats(spark):
    got = formatted(spark, [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 5, "assistant", "n")])
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None].learned == ["n"]
    assert formatted(spark, []) == {}


@pytest.mark.parametrize("ranges,draws", [(4, 50), (64, 40_000)])
def test_shards_are_even_and_gapless(spark, ranges, draws):
    random.seed(5)
    sizes = [random.choice([1, 3, 900]) for _ in range(3000)]
    rows = [(None if i % 11 == 0 else 7 if i % 3 == 0 else i, s) for i, s in enumerate(sizes)]
    table = spark.createDataFrame(rows, "doc_id long, size long").repartition(3)
    got = shards.assign_shards(table, ["doc_id"], F.col("size"), 16, ranges, draws).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(rows)
    per = {k: [r for r in got if r.shard == k] for k in range(16)}
    total = sum(sizes)
    for part in per.values():
        assert abs(sum(r.size for r in part) - total / 16) <= 900
        assert sorted(r.slot for r in part) == list(range(len(part)))
    # In key order over all shards.
    order = [r.doc_id for k in range(16) for r in sorted(per[k], key=lambda r: r.slot)]
    known = [d for d in order if d is not None]
    assert known == sorted(known) and order[: order.count(None)] == [None] * order.count(None)


def test_shards_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(1, 5), (1, 5)], "doc_id long, size long")
    assert sorted(r.slot for r in shards.assign_shards(few, ["doc_id"], F.col("size")).collect()) == [0, 0]
    assert shards.assign_shards(few.limit(0), ["doc_id"], F.col("size")).count() == 0
    assert spark.range(1).select(F.lit(None).cast("string").alias("text")).select(shards.text_size()).first()[0] == 1


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def places(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def test_license_places_equal_brute_force(make_docs):
    random.seed(1)
    vocabulary = "under the mit license apache version 2 cc by nc x".split()
    texts = HOSTILE + [" ".join(random.choice(vocabulary) for _ in range(random.randint(0, 60))) for _ in range(80)]
    texts += ["Under THE mit, License. CC BY-NC 4.0 cc by nc cc by nc", "under the mit license"] * 2
    got = licenses.scan_licenses(make_docs([(i, t, None) for i, t in enumerate(texts)]), ["doc_id", "h"]).collect()
    assert len(got) == len(texts)
    for r in got:
        words = WORD.findall(ascii_lower(texts[r.doc_id]))
        assert r.n_words == len(words)
        for t in (t for t in licenses.TEMPLATES if t.phrase):
            found = places(words, t.text)
            mine = [m for m in r.matches if m.phrase and m.label == t.label and m.places]
            assert sum(m.places for m in mine) == len(found)
            if found:
                assert (mine[0].first_word, mine[0].last_word, mine[0].cover) == (found[0], found[-1], 1.0)


def test_license_text_with_edits_is_found(make_docs):
    whole = next(t for t in licenses.TEMPLATES if t.label == "bsd").text
    edited = whole.replace("binary forms", "binary new forms")
    rows = [(0, f"x y {edited} z", None), (1, whole[: len(whole) // 2], None)]
    got = {r.doc_id: [m.label for m in r.matches if m.cover >= licenses.COVER] for r in licenses.scan_licenses(make_docs(rows), ["doc_id"]).collect()}
    assert got == {0: ["bsd"], 1: []}
    assert licenses.scan_licenses(make_docs([]), ["doc_id"]).count() == 0


def shingles(words):
    return {tuple(words[i : i + 5]): sum(map(len, words[i : i + 5])) for i in range(len(words) - 4)}


def weighted(a, b):
    a, b = shingles(a), shingles(b)
    both = sum(w for s, w in a.items() if s in b)
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def test_passages_equal_brute_force(spark, make_docs):
    random.seed(2)
    word = lambda: random.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(random.randint(0, 30))
    items = [[word() for _ in range(random.randint(5, 50))] for _ in range(12)]
    texts = []
    for i in range(60):
        item = list(random.choice(items))
        for _ in range(i % 3):
            item[random.choice([0, -1, len(item) // 2])] = word()
        texts.append([word() for _ in range(random.randint(0, 40))] + item + [word() for _ in range(random.randint(0, 40))])
    rows = [(i, " ".join(t), None) for i, t in enumerate(texts)] + [(100 + i, t, None) for i, t in enumerate(HOSTILE)]
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, "too short"), (51, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(make_docs(rows), benchmark, ["doc_id", "pos"]).collect()}
    wanted = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            starts = range(max(1, len(text) - len(item) + 1))
            best = max(weighted(text[s : s + len(item)], item) for s in starts)
            if best >= 0.8:
                wanted[d, i] = best
    assert set(got) == set(wanted) and len(wanted) > 20
    for key, r in got.items():
        window = texts[key[0]][r.first_word : r.first_word + r.n_words]
        assert abs(r.similarity - weighted(window, items[key[1]])) < 1e-9
        assert abs(r.similarity - wanted[key]) < 1e-9 and r.hamming <= 64
    kept = decontaminate.drop_contaminated(make_docs(rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got}
    assert kept.columns == make_docs(rows).columns
    assert decontaminate.find_passages(make_docs([]), benchmark, ["doc_id"]).count() == 0
    assert decontaminate.find_passages(make_docs(rows), benchmark.limit(0), ["doc_id"]).count() == 0


def test_every_passage_above_the_similarity_is_found(spark, make_docs):
    """Items without edge words, with shifted or changed middles, and twice in one text: all pairs, each with its best window."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9)))
    items = [[word() for _ in range(rng.choice([5, 9, 16, 40, 100, 200]))] for _ in range(24)]
    texts = []
    for i in range(120):
        item = list(items[i % 24])
        cut = rng.randint(0, max(0, len(item) // 11))
        side = rng.randint(0, cut)
        item = item[side : len(item) - (cut - side)]
        if i % 5 == 0:
            item.insert(len(item) // 2, word())
        texts.append([word() for _ in range(rng.randint(0, 60))] + item * (1 + (i % 17 == 0)) + [word() for _ in range(rng.randint(0, 60))])
    wanted = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            if set(shingles(text)) & set(shingles(item)):
                best = max(weighted(text[s : s + len(item)], item) for s in range(max(1, len(text) - len(item) + 1)))
                if best >= 0.8:
                    wanted[d, i] = best
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    docs = make_docs([(i, " ".join(t), None) for i, t in enumerate(texts)])
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(docs, benchmark, ["doc_id"]).collect()}
    assert set(got) == set(wanted) and len(wanted) > 60
    for key, r in got.items():
        assert abs(r.similarity - wanted[key]) < 1e-9
        assert abs(weighted(texts[key[0]][r.first_word : r.first_word + r.n_words], items[key[1]]) - r.similarity) < 1e-9


def test_simhash_is_the_majority_of_bits(spark):
    row = spark.createDataFrame([(["a", "b", "c", "c"],)], "part array<string>")
    hashes = row.select(F.transform("part", lambda w: F.xxhash64(w)).alias("h")).first().h
    wanted = 0
    for bit in range(64):
        if sum((h >> bit) & 1 for h in hashes) * 2 > 4:
            wanted |= 1 << bit
    got = row.select(decontaminate.simhash("part")).first()[0]
    assert got & (1 << 64) - 1 == wanted


def test_native_operators_run_no_python(spark, make_docs):
    from tests.conftest import plan_text

    docs = make_docs([(1, "under the mit license", "en")])
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    benchmark = docs.selectExpr("doc_id AS item_id", "text")
    for frame in (
        chat.read_chats(chat.format_chats(turns)),
        licenses.scan_licenses(docs, ["doc_id"]),
        decontaminate.find_passages(docs, benchmark, ["doc_id"]),
        shards.assign_shards(docs.select("doc_id"), ["doc_id"], F.lit(1)),
    ):
        plan = plan_text(frame)
        assert not re.search("EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", plan)


def test_items_of_few_words_are_found_whole(spark, make_docs):
    benchmark = spark.createDataFrame(
        [(1, "forty two"), (2, "Yes!"), (3, "a b c d"), (4, "?!"), (5, None), (6, "one two three four five")], "item_id long, text string"
    )
    rows = [(1, "it is forty two, forty two", None), (2, "a b c, d", None), (2, "a b c, d", None), (3, "a b d", None), (4, None, None), (5, "eyes yes", None)]
    got = decontaminate.find_passages(make_docs(rows), benchmark, ["doc_id"]).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.similarity) for r in got) == [
        (1, 1, 2, 2, 1.0), (2, 3, 0, 4, 1.0), (2, 3, 0, 4, 1.0), (5, 2, 1, 1, 1.0),
    ]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(make_docs(rows), benchmark).collect()) == [3, 4]
