"""Similarity join of word shingle sets by chosen paths.

A text is the set of its hashed five-word shingles.  In each of several runs a set is split by recursively sampled tokens: a token
extends a path when its hash under that path is below ``1 / (SPREAD * size of the set)``, so similar sets choose the same
tokens.  Sets with a path in common meet in a bucket.  Buckets of more than ``LIMIT`` sets are split by longer paths, up to
``DEPTHS[-1]`` tokens.  The number of runs follows from ``TARGET``, the wanted chance that a pair of exactly
the least similarity meets in the deepest bucket.

Inside buckets sketches of 256 bits rule out pairs far below the least similarity, and what remains is joined into blocks of
sets that may be similar.  Every block is then compared by brute force with exact sets, in tiles of ``TILE`` sets, so a
set is shipped once for ordinary blocks.  Links are counted inside the tiles; only a spanning forest of them
leaves a tile, so no step returns all pairs of a group.

Equal sets count as copies: they are compared once and told apart by a 64-bit hash of the set.

Defined results: null or blank texts have no set, no link, and a class of their own; texts below five words are one
shingle; repeated rows are copies of each other; a null doc_id takes part, and a class without any id has the class id
null; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.arrow import enter, small_batches
from paperloom.llm.common import stage
from paperloom.llm.graphs import components, stars

WORDS = 5
SIMILARITY = 0.8
SPREAD = 0.6
DEPTHS = (2, 4, 6)
TARGET = 0.9995
LIMIT = 2048
TILE = 512
#: Edges that a task joins to stars at a time.
EDGES = 1 << 18
SKETCH_BITS = 256
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(32)


def runs_for(similarity: float = SIMILARITY, spread: float = SPREAD, depth: int = DEPTHS[-1], target: float = TARGET) -> int:
    """Runs after which a pair of this similarity shares a path with the wanted chance.

    Shared paths branch like a Poisson process with mean ``similarity / spread``.
    """
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(-similarity / spread * (1 - lost))
    return math.ceil(math.log(1 - target) / math.log(lost))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> _HALF)


# --- sets ---------------------------------------------------------------------

_RANDOM = np.random.default_rng(20240101)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_SHINGLE = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; grown by doubling."""
    have = len(_POWERS.get("up", ()))
    if have < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.ones(1, np.uint64)
            while len(p) < n:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


def _forget_powers() -> None:
    _POWERS.clear()


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; lower case, words between ASCII white space."""
    coded = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    up, down = _powers(len(data) + 1)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], white]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    word = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = len(word) - WORDS + 1
    if n > 0:
        shingle = np.zeros(n, np.uint64)
        for i in range(WORDS):
            shingle += word[i : i + n] * _SHINGLE[i]
        shingle = _mix(shingle)
    limits = np.cumsum([len(c) + 1 for c in coded])
    first = np.searchsorted(starts, np.concatenate([[0], limits[:-1]]))
    last = np.searchsorted(starts, limits)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= WORDS:
            out.append(np.unique(shingle[a : b - WORDS + 1]))
        elif b > a:
            part = (word[a:b] * _SHINGLE[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(_mix(part + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


_FACTORS = _RANDOM.integers(1, 1 << 32, SKETCH_BITS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def sketch(shingles: np.ndarray) -> bytes:
    """One bit of each of 256 min-hashes."""
    small = (shingles >> _HALF).astype(np.uint32)
    least = np.full(SKETCH_BITS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(small), 4096):
        np.minimum(least, (small[i : i + 4096] * _FACTORS[:, None]).min(axis=1), out=least)
    return np.packbits(_mix(least.astype(np.uint64)) >> np.uint64(63) != 0).tobytes()


# --- paths --------------------------------------------------------------------


def extend(shingles: np.ndarray, paths: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths ``levels`` tokens longer, and the index of the path that each grew from.

    The tokens of a path are in its number already; the same token may follow another.
    """
    share = 1.0 / (SPREAD * len(shingles))
    bound = np.uint64(min(share, 1.0) * 0xFFFFFFFFFFFFF000)
    origin = np.arange(len(paths))
    for _ in range(levels):
        grown, grown_from = [], []
        for i in range(0, len(paths), max(1, (1 << 20) // len(shingles))):
            part = paths[i : i + max(1, (1 << 20) // len(shingles))]
            drawn = _mix(part[:, None] ^ shingles)
            path, token = np.nonzero(drawn <= bound)
            grown.append(_mix(part[path] * _M1 + shingles[token]))
            grown_from.append(origin[i + path])
        paths, origin = np.concatenate(grown or [paths]), np.concatenate(grown_from or [origin])
    return paths, origin


def _seeds(runs: int) -> np.ndarray:
    return _mix(np.arange(1, runs + 1, dtype=np.uint64) * _M2)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def describe(docs: DataFrame, runs: int, depth: int) -> DataFrame:
    """doc_id, text_key, set_id (null without words), paths."""
    schema = "doc_id bigint, text_key bigint, set_id bigint, paths array<bigint>"

    def run(batches):
        enter("jaccard", _forget_powers)
        seeds = _seeds(runs)
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist())
            paths = [np.unique(extend(s, seeds, depth)[0]).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int32)
            nested = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(paths)))
            ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), ids, nested], names=["doc_id", "text_key", "set_id", "paths"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """set_id, shingles (binary), sketch of each text."""

    def run(batches):
        enter("jaccard", _forget_powers)
        for batch in small_batches(batches, "text"):
            sets = [s for s in shingle_sets(batch.column("text").to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                names=["set_id", "shingles", "sketch"],
            )

    return texts.select("text").mapInArrow(run, "set_id bigint, shingles binary, sketch binary")


def _longer(hot: DataFrame, levels: int) -> DataFrame:
    """(path, set_id) of sets with their paths (array) and shingles, some tokens on."""

    def run(batches):
        enter("jaccard", _forget_powers)
        for batch in small_batches(batches, "shingles"):
            paths, owners = [], []
            for own, start, data in zip(*(batch.column(c).to_pylist() for c in ("set_id", "paths", "shingles"))):
                grown, _ = extend(np.frombuffer(data, np.uint64), np.array(start, np.int64).view(np.uint64), levels)
                paths.append(np.unique(grown))
                owners.append(np.full(len(paths[-1]), own, np.int64))
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate(paths)), pa.array(np.concatenate(owners))], names=["path", "set_id"]
            )

    return hot.mapInArrow(run, "path bigint, set_id bigint")


def _shared(paths: DataFrame) -> DataFrame:
    """(path, set_id, n) of the paths that n > 1 sets have."""
    once = paths.select("path", "set_id").distinct()
    sizes = once.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
    return once.join(sizes, "path")


def buckets(paths: DataFrame, sets_of) -> tuple[DataFrame, DataFrame]:
    """Buckets (path, set_id, n) of bearable size or greatest depth, and the sets that are in any."""
    found = stage(_shared(paths), "buckets")
    sets = sets_of(found.select("set_id").distinct())
    done = [found.where(F.col("n") <= LIMIT)]
    for before, depth in zip(DEPTHS, DEPTHS[1:]):
        over = found.where(F.col("n") > LIMIT)
        if over.isEmpty():
            return _union(done), sets
        starts = over.groupBy("set_id").agg(F.collect_list("path").alias("paths"))
        longer = _longer(starts.join(sets.select("set_id", "shingles"), "set_id"), depth - before)
        found = stage(_shared(longer), "buckets")
        done.append(found if depth == DEPTHS[-1] else found.where(F.col("n") <= LIMIT))
    return _union(done), sets


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- comparing ----------------------------------------------------------------


def _tiled(rows: DataFrame, group: str, size: str, limit: int) -> DataFrame:
    """Adds part and tile: groups above the limit are cut into parts, and each two of these meet in a tile."""
    parts = F.ceil(F.col(size) / limit).cast("int")
    cut = rows.withColumn("part", F.pmod(F.xxhash64("set_id", F.lit(7)), parts).cast("int")).withColumn("parts", parts)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    paired = cut.withColumn("other", other)
    tile = F.least("part", "other") * F.col("parts") + F.greatest("part", "other")
    return paired.withColumn("tile", tile.cast("bigint")).withColumn("crossed", F.col("part") != F.col("other")).drop("other", "parts")


def _runs(batches, keys: list[str]):
    """Tables of rows that agree in the keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new).tolist() + [batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _star_batch(left: list[int], right: list[int]) -> pa.RecordBatch:
    a, b = stars(np.array(left, np.int64), np.array(right, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _alike(rows: DataFrame) -> DataFrame:
    """Edges (a, b) that join the sets of a bucket whose sketches allow the least similarity, as the stars of each task.

    A pair of that similarity agrees in 90 % of the bits; five deviations less are let through.
    """
    agree = (1 + SIMILARITY) / 2
    most = SKETCH_BITS - (SKETCH_BITS * agree - 5 * math.sqrt(SKETCH_BITS * agree * (1 - agree)))

    def run(batches):
        enter("jaccard", _forget_powers)
        left, right = [], []
        for table in _runs(batches, ["path", "tile"]):
            if table.num_rows < 2:
                continue
            ids = table.column("set_id").to_numpy()
            part = table.column("part").to_numpy()
            crossed = bool(table.column("crossed")[0].as_py()) or len(set(part.tolist())) > 1
            n = table.column("size").to_numpy()
            bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(ids), -1)
            rest = np.arange(1, len(ids))
            root, queue = 0, [0]
            while True:
                while queue and rest.size:
                    i = queue.pop()
                    near = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1) <= most
                    near &= np.minimum(n[rest], n[i]) >= SIMILARITY * np.maximum(n[rest], n[i]) - 1e-9
                    if crossed:
                        near &= part[rest] != part[i]
                    hit = rest[near]
                    if hit.size:
                        left += [ids[root]] * len(hit)
                        right += ids[hit].tolist()
                        queue += hit.tolist()
                        rest = rest[~near]
                if not rest.size:
                    break
                root, rest = int(rest[0]), rest[1:]
                queue = [root]
            if len(left) > EDGES:
                yield _star_batch(left, right)
                left, right = [], []
        yield _star_batch(left, right)

    return rows.mapInArrow(run, "a bigint, b bigint")


def compare_sets(sets: list[np.ndarray], copies: np.ndarray, part: np.ndarray | None = None):
    """Links of each set (counted in copies) and a spanning forest of them, by brute force.

    With ``part``, only sets of different parts are compared.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, weight = sizes[order], copies[order]
    side = part[order] if part is not None else None
    tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tokens = np.concatenate([tokens[cut[i] : cut[i + 1]] for i in order])
    cut = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(int(tokens.max()) + 1, np.int32)
    links, label, forest = np.zeros(len(sets), np.int64), np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        # By size: what follows is larger, and what is too large cannot be similar.
        stop = int(np.searchsorted(sizes, sizes[i] / SIMILARITY + 1e-9, side="right"))
        if stop <= i + 1:
            continue
        own = tokens[cut[i] : cut[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[tokens[cut[i + 1] : cut[stop]]], cut[i + 1 : stop] - cut[i + 1])
        mark[own] = 0
        like = both >= SIMILARITY * (sizes[i] + sizes[i + 1 : stop] - both) - 1e-9
        if side is not None:
            like &= side[i + 1 : stop] != side[i]
        hit = i + 1 + np.flatnonzero(like)
        if not hit.size:
            continue
        links[i] += weight[hit].sum()
        links[hit] += weight[i]
        labels, at = np.unique(label[hit], return_index=True)
        other = labels != label[i]
        forest += [(order[i], order[j]) for j in hit[at[other]]]
        if other.any():
            label[np.isin(label, labels)] = label[i]
    out = np.zeros(len(sets), np.int64)
    out[order] = links
    return out, forest


def _compared(rows: DataFrame) -> DataFrame:
    """Per tile (set_id, links) of its sets, and per task the stars of the forests as (a, b)."""
    schema = "set_id bigint, links bigint, a bigint, b bigint"

    def joined(left, right):
        edges = _star_batch(left, right)
        none = pa.nulls(edges.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *edges.columns], names=["set_id", "links", "a", "b"])

    def run(batches):
        enter("jaccard", _forget_powers)
        left, right = [], []
        for table in _runs(batches, ["block", "tile"]):
            if table.num_rows < 2:
                continue
            ids = table.column("set_id").to_numpy()
            part = table.column("part").to_numpy()
            crossed = len(np.unique(part)) > 1
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            links, forest = compare_sets(sets, table.column("copies").to_numpy(), part if crossed else None)
            some = np.flatnonzero(links)
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), none, none], names=["set_id", "links", "a", "b"])
            left += [int(ids[i]) for i, _ in forest]
            right += [int(ids[j]) for _, j in forest]
            if len(left) > EDGES:
                yield joined(left, right)
                left, right = [], []
        yield joined(left, right)

    return rows.mapInArrow(run, schema)


def similar_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), n_links (other rows of at least the similarity), class_rows.

    Classes are the connected components of the links.  ``text_key`` (hash of the text) and ``class_key`` (null without words) tell
    rows and classes apart where ids are missing or repeated.
    """
    told = stage(describe(docs.select("doc_id", "text"), runs_for(), DEPTHS[0]), "sets")
    with_set = told.where(F.col("set_id").isNotNull())
    members = stage(
        with_set.groupBy("set_id").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("first"), F.min(F.struct("text_key", "doc_id")).alias("pick")
        ),
        "members",
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Shingles of the wanted sets, made anew from one text of each."""
        picks = members.join(wanted, "set_id", "left_semi").select(
            F.col("pick.text_key").alias("p_text"), F.col("pick.doc_id").alias("p_doc")
        )
        same = (F.xxhash64(docs["text"]) == F.col("p_text")) & docs["doc_id"].cast("bigint").eqNullSafe(F.col("p_doc"))
        texts = docs.join(picks, same, "left_semi")
        return stage(_sets(texts).dropDuplicates(["set_id"]), "shingles")

    met, sets = buckets(with_set.select("set_id", F.explode("paths").alias("path")), sets_of)
    sketches = sets.select("set_id", "sketch", (F.octet_length("shingles") / 8).cast("int").alias("size"))
    near = _tiled(met.join(sketches, "set_id"), "path", "n", LIMIT)
    edges = stage(_alike(near.repartition("path", "tile").sortWithinPartitions("path", "tile")), "edges")
    blocks = components(edges).select(F.col("node").alias("set_id"), F.col("root").alias("block"))
    sizes = blocks.groupBy("block").agg(F.count("*").alias("n"))
    full = blocks.join(sizes, "block").join(members.select("set_id", "copies"), "set_id")
    tiles = _tiled(full, "block", "n", TILE).join(sets.select("set_id", "shingles"), "set_id")
    compared = stage(_compared(tiles.repartition("block", "tile").sortWithinPartitions("block", "tile")), "links")

    links = compared.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.sum("links").alias("links"))
    roots = components(compared.where(F.col("a").isNotNull()).select("a", "b"))
    named = roots.withColumnRenamed("node", "set_id").join(members.select("set_id", "copies", "first"), "set_id")
    named = stage(named, "classes")
    classes = named.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_rows"))
    of_set = (
        members.select("set_id", "copies", "first")
        .join(named.select("set_id", "root").join(classes, "root"), "set_id", "left")
        .join(links, "set_id", "left")
        .select(
            F.col("set_id").alias("s"),
            F.coalesce("class_id", "first").alias("class_id"),
            F.coalesce("class_rows", "copies").alias("class_rows"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "set_id").alias("class_key"),
        )
    )
    out = told.select("doc_id", "text_key", "set_id").join(of_set, F.col("set_id") == F.col("s"), "left")
    return out.select(
        "doc_id",
        F.when(F.col("s").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_rows", F.lit(1)).alias("class_rows"),
        "text_key",
        "class_key",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, without all but one of each class: the one with the least doc_id, then text hash.

    Rows without words are all kept, repeated ones too.
    """
    told = stage(similar_classes(docs).select("doc_id", "text_key", "class_key"), "classes")
    first = F.min(F.struct("doc_id", "text_key")).alias("k")
    some = told.where(F.col("class_key").isNotNull())
    keepers = some.groupBy("class_key").agg(first).select("k.*")
    blank = told.where(F.col("class_key").isNull()).select("doc_id", "text_key").distinct()

    def of(keys: DataFrame) -> DataFrame:
        wanted = keys.select(F.col("doc_id").alias("_w_doc"), F.col("text_key").alias("_w_text"))
        same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("_w_doc")) & (F.xxhash64(docs["text"]) == F.col("_w_text"))
        return docs.join(wanted, same, "left_semi")

    if some.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        return of(keepers.unionByName(blank))
    # Worded rows that agree in id and text are one text of the class; only then are whole rows compared.
    return of(keepers).dropDuplicates(["doc_id", "text"]).unionByName(of(blank))
