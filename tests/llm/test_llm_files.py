"""BPE, token files and WARC."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from paperloom.llm import arrow, bpe, tokenbin, warc
from tests.llm.conftest import HOSTILE

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(seed=1, n=120):
    rng = random.Random(seed)
    texts = [t for t in HOSTILE if t is not None]
    texts += ["  a  b \n\n c", "a\x1cb \x1d c", "don't I'LL we've  's", "ab" * 400 + "é" * 300, "<|endoftext|>", "\r\n \t x"]
    return texts + ["".join(rng.choice("ab \n\t.,1é日\x1c\xa0'st") for _ in range(rng.randint(1, 300))) for _ in range(n)]


def test_bpe_equals_tiktoken_and_comes_back():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert model.decode(ids) == text.encode()
    # The heap for long pieces merges like the matrix for short ones.
    for text in texts:
        for piece in model.pattern.findall(text):
            data = piece.encode()
            if 1 < len(data) <= bpe.MATRIX_BYTES:
                assert model._heap(data).tolist() == model._matrix([data])[0].tolist()


def test_bpe_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    with open(RANKS, "rb") as f:
        model = bpe.ByteBpe(bpe.read_ranks(f.read()), public_tokenizers.PATTERN)
    texts = odd_texts(3, 30)
    assert [model.encode([t])[0] for t in texts] == model.encode(texts)


@pytest.mark.parametrize("block,known", [(40, 25), (1 << 24, 1_000_000)])
def test_bpe_lays_out_blocks_of_texts(monkeypatch, block, known):
    monkeypatch.setattr(tokenbin, "BLOCK_BYTES", block)
    monkeypatch.setattr(bpe, "REMEMBERED", known)
    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    texts = [None, "", *odd_texts(7, 60), None, "ÀÿÀ÷×1'S a'b 2's ,'ll ü'sü", "a\u2003b\xa0 c\u3000 d", "e\x85 f\u1680 g", ""]
    for pattern in (public_tokenizers.PATTERN, r"\s*[^\s]+|\s+"):
        other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        model = bpe.ByteBpe(ranks, pattern)
        # A slice of a longer column, as batches are.
        ids, before = model.lay_out(pa.array(["skipped", *texts]).slice(1))
        decoded = model.decode_all(ids, before).to_pylist()
        for i, text in enumerate(texts):
            own = np.frombuffer(ids, "<u4")[before[i] : before[i + 1]].tolist()
            assert own == other.encode_ordinary(text or "") and decoded[i] == (text or "").encode()


def test_bpe_cuts_and_merges_a_word_once():
    model = bpe.ByteBpe(bpe.read_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    cut, merged, pattern, merge = [], [], model.pattern, model._merge

    class Counted:
        def findall(self, text):
            cut.append(text)
            return pattern.findall(text)

    model.pattern, model._merge = Counted(), lambda pieces: merged.extend(pieces) or merge(pieces)
    model.encode([f" wordily{mark} wordily{i}" for mark in ".,;:!?" for i in range(10)] * 3)
    assert sorted(cut) == sorted({" wordily", *".,;:!?", *"0123456789"}) and sorted(merged) == sorted(c.encode() for c in cut)


def test_bpe_query_shape(make_docs):
    rows = [(i, t, None) for i, t in enumerate(HOSTILE)] + [(0, "", None), (None, "again", None)]
    got = bpe.encode_texts(make_docs(rows), RANKS, public_tokenizers.PATTERN, ["doc_id", "pos"], decode=True).collect()
    assert sorted(bytes(r.decoded).decode() for r in got) == sorted(t or "" for _, t, _ in rows)
    assert bpe.encode_texts(make_docs([]), RANKS, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def test_long_texts_are_cut_only_where_nothing_changes():
    text = " ".join(odd_texts()) * 3
    assert "".join(arrow.stretches(text, 500)) == text
    whole = [c for c in arrow.chunks(text)]
    assert [c for part in arrow.stretches(text, 500) for c in arrow.chunks(part)] == whole


@pytest.mark.parametrize("symbols,count", [(1, 5), (2, 50), (300, 4000), (50_000, 60_000)])
def test_huffman_round_trip(symbols, count):
    rng = np.random.default_rng(symbols)
    ids = np.minimum(rng.zipf(1.3, count) - 1, symbols - 1)
    sizes, left = [0], count
    while left:
        sizes.append(min(left, int(rng.integers(0, 900))))
        left -= sizes[-1]
    sizes = np.array(sizes + [0])
    lengths = tokenbin.code_lengths(np.bincount(ids, minlength=symbols))
    used = lengths[lengths > 0].astype(float)
    assert lengths.max() <= tokenbin.MAX_BITS and (2.0**-used).sum() <= 1
    coded, offsets = tokenbin.pack(ids, sizes, lengths, tokenbin.canonical_codes(lengths), 64)
    at = np.cumsum([0] + [len(c) for c in coded])[:-1]
    places = np.concatenate([np.frombuffer(o, "<u8").astype(np.int64) + 8 * a for o, a in zip(offsets, at)])
    blocks = np.concatenate([np.minimum(64, s - np.arange(0, s, 64)) for s in sizes]).astype(int)
    assert (tokenbin.unpack(b"".join(coded), places, blocks, lengths) == ids).all()


def test_package_merge_is_optimal_without_a_limit():
    import heapq

    rng = np.random.default_rng(2)
    counts = rng.integers(1, 1000, 200)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((tokenbin.code_lengths(counts) * counts).sum()) == cost


def test_token_files_hold_all_documents_in_order(spark, make_docs):
    texts = odd_texts(5, 60)
    rows = [(i * 3 % 97, t, None) for i, t in enumerate(texts)] + [(None, None, None), (5, "same", None), (5, "same", None)]
    path = tokenbin.write_token_files(make_docs(rows), JSON, ids_per_file=700, block_ids=50)
    got = tokenbin.read_token_files(spark, path).orderBy("start").collect()
    assert len(got) == len(rows) and spark.read.parquet(f"{path}/manifest").count() > 3
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    encode = lambda t: np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in got) == sorted((d if d is not None else -1, encode(t)) for d, t, _ in rows)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = [r.doc_id if r.doc_id is not None else -1 for r in got]
    assert ids == sorted(ids)
    empty = tokenbin.write_token_files(make_docs([]), JSON)
    read = tokenbin.read_token_files(spark, empty)
    assert read.collect() == [] and read.columns == ["doc_id", "start", "n_tokens", "ids"]


def test_words_reach_the_library_together_and_keep_their_ids(monkeypatch):
    rng = random.Random(4)
    letters = ["a", "st", "The", "é", "×", "÷", "ñ", "ß", "µ", "ª", "ā", "ж", "δ", "ʰ", "ˆ", "日", "が", "ế", "🙂", "e\u0301", "½", "7", "٣"]
    gaps = [" ", "  ", "\n", "\t ", " \n", "\x0b", "\x1c", "\x00", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "…"]
    marks = [".", ",", "'", "'s", "'ll", "''", "(", "»", "\u201d", "。", "#1", "<|endoftext|>"]
    texts = odd_texts(6) + ["".join(rng.choice(rng.choice([letters, letters, gaps, marks])) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    words = sorted({"".join(rng.choices("abcdeéžя", k=9)) for _ in range(6000)})
    with open(JSON) as f:
        data = f.read()
    library = Tokenizer.from_str(data)
    library.encode_special_tokens = True
    told = lambda t: [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(t, add_special_tokens=False)]
    for block, known in ((tokenbin.BLOCK_BYTES, tokenbin.REMEMBERED), (50, 100)):
        monkeypatch.setattr(tokenbin, "BLOCK_BYTES", block)
        monkeypatch.setattr(tokenbin, "REMEMBERED", known)
        model = tokenbin.Tokens(data, 2)
        for part in (texts, texts[:200]):
            assert model.encode(pa.array([None, "", *part, ""])) == [b"", b"", *told(part), b""]

    class Counted:
        asked = 0

        def __init__(self, own):
            self.own = own

        def encode_batch_fast(self, texts, **how):
            Counted.asked += len(texts)
            return self.own.encode_batch_fast(texts, **how)

    monkeypatch.undo()
    model = tokenbin.Tokens(data, 2)
    for name, own in list(vars(model).items()):
        if isinstance(own, Tokenizer):
            setattr(model, name, Counted(own))
    assert model.encode(pa.array([" ".join(words)])) == told([" ".join(words)])
    assert Counted.asked < len(words) / 50


def test_a_group_is_decoded_from_its_own_bytes(spark, make_docs, monkeypatch):
    path = tokenbin.write_token_files(make_docs([(i, f"text {i} " * 40, None) for i in range(60)]), JSON, block_ids=50)
    unpack, read, n = tokenbin.unpack, [], 0
    monkeypatch.setattr(tokenbin, "unpack", lambda bits, *more: read.append(len(bits)) or unpack(bits, *more))
    for r in spark.read.parquet(f"{path}/manifest").collect():
        data = arrow.get_file(r.file)
        whole = [ids for *_, group in tokenbin.decode_file(data) for ids in group]
        read.clear()
        assert [ids for *_, group in tokenbin.decode_file(data, 200) for ids in group] == whole
        assert sum(read) < len(data)
        n += len(whole)
    assert n == 60


def test_a_worker_gives_back_what_other_operators_left():
    kept = {"a": 1}
    arrow.enter("one", kept.clear)
    arrow.enter("one", kept.clear)
    assert kept
    arrow.enter("two")
    assert not kept and set(arrow._USED) == {"two"}


def test_long_texts_are_encoded_in_stretches(spark):
    """Texts of over a million characters, in words, without any gap, and in one script after the other."""
    rng = random.Random(8)
    words = " ".join(rng.choices(["alpha", "Beta's", "12345", "δέλτα", "日本語", "\n\n  x"], k=250_000))
    # Without a gap the pattern still cuts: digits, letters and marks take turns.
    gapless = "".join(rng.choices(["ab", "12", "!?", "é"], k=400_000))
    docs = spark.createDataFrame([(1, words), (2, gapless)], "doc_id long, text string")
    assert min(len(words), len(gapless)) > 1 << 19 and len(words) > 1 << 20
    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: bytes(r.ids) for r in bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, ["doc_id"]).collect()}
    for doc, text in ((1, words), (2, gapless)):
        assert got[doc] == np.array(library.encode_ordinary(text), "<u4").tobytes()
    tokens = {r.doc_id: bytes(r.ids) for r in tokenbin.tokenize(docs, JSON, ["doc_id"]).collect()}
    for doc, text in ((1, words), (2, gapless)):
        assert tokens[doc] == np.array(Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids + [0], "<u4").tobytes()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS first", "'x' AS digest", "2 AS size")


def test_warc_round_trip(spark):
    big = "é" * 60
    rows = [(3, "http://x/3", big), (1, "http://x/1\r\nX: y", big), (2, None, big + "!"), (9, "u", big), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (None, "u", big), (7, "u", "r" * 200), (7, "u", "r" * 200)]
    path = warc.write_warc(pages(spark, rows), roll_bytes=600)
    got = warc.read_warc(spark, path).collect()
    key = lambda r: (r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to or -1)
    assert sorted(map(key, got)) == sorted([
        (1, "response", -1), (3, "revisit", 1), (9, "revisit", 1), (-1, "revisit", 1), (2, "response", -1), (4, "response", -1),
        (5, "response", -1), (6, "response", -1), (7, "response", -1), (7, "revisit", 7),
    ])
    by_id = {}
    for d, _, h in rows:
        by_id[d] = (h or "").encode()
    for r in got:
        assert r.payload_bytes == len(by_id[r.page_id]) and r.payload_digest == hashlib.sha256(by_id[r.page_id]).hexdigest()
        assert (r.payload is None) == (r.record_type == "revisit")
        assert "\n" not in r.url
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    assert len(manifest) > 1 and sum(m.records for m in manifest) == len(rows)
    again = warc.write_warc(pages(spark, rows), roll_bytes=600)
    names = lambda p: {m.file.rsplit("/", 1)[1]: zlib.crc32(arrow.get_file(m.file)) for m in spark.read.parquet(f"{p}/manifest").collect()}
    assert names(path) == names(again)


def test_warc_of_nothing(spark):
    path = warc.write_warc(pages(spark, [(1, "u", "x")]).limit(0))
    assert warc.read_warc(spark, path).count() == 0
