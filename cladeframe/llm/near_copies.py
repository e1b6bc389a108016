"""Near copies by exact Jaccard similarity of five-word shingles, found by wide SimHash fingerprints.

A fingerprint has PRINT_WORDS * 64 bits over the distinct shingles of a text, cut into blocks of 32 bits. In every block
each value emits itself and its 32 one-flip variants, so texts meet if some block of theirs differs in at most two bits.
Blocks are dealt by their first bits, the prefix; flips of the prefix are shuffled, those of the other bits made by the task
that receives the block. The prefix grows with the logarithm of the partitions, so that there are many more places than
tasks. A pair that will also meet in the word behind is left to that one, so that near copies, which meet nearly everywhere,
give a pair for each run of words in which they do and not for each block; the last word leaves none. Texts at
similarity 0.8 differ in about 15 % of the bits and meet with a chance of about 0.99, closer ones more surely; what meets
by accident is thinned by 64 bits of the neighbouring blocks. Pairs that are left are decided by the exact similarity of
their texts.

What meets is thinned to a spanning forest, whose pairs are decided first. Texts of one component of that forest form a
cluster; every pair that met is in one. In a cluster that still falls into several groups of copies, links between groups are
found exactly, by the differences of each text's shingles from those of one central text: two texts are similar only if their
differences have enough in common. As at least one of them isn't similar to the central text, a known number of the rarest
differences of the other must hold a common one, so texts meet on those alone, whichever block they met on. Differences
that no other group has meet nothing. So a group of near copies costs rows in proportion to its members.

Cases: upper and lower case are equal (ASCII), words end at ASCII white space. A text of fewer words than a shingle is one
shingle; null texts and texts without words are copies of each other. Equal texts are merged before anything else; they are
named by 64 bits, and by 64 others where two texts share the first. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, small, value_key, written
from .rolling import rows_batch
from .simhash import connected

U = np.uint64
SHINGLE, SIMILARITY = 5, 0.8
PRINT_WORDS, FAR, SMALL_GROUP = 20, 22, 32
LEAST_PREFIX, MOST_PREFIX, PLACES = 5, 20, 16
FLUSH_PRINTS, RECORDS, TASK_PAIRS = 20_000, 200_000, 500_000
SEEDS = np.arange(1, PRINT_WORDS + 1, dtype=U) * U(0x9E3779B97F4A7C15)
DEALT = pa.schema([("bucket", pa.int32()), ("place", pa.binary()), ("value", pa.binary()), ("t", pa.binary()), ("check", pa.binary())])
APART = pa.schema([("c", pa.int64()), ("root", pa.int64()), ("t", pa.int64()), ("apart", pa.bool_()), ("n", pa.int32()), ("d", pa.int32()), ("rarest", pa.int32()), ("x", pa.int64())])
SLACK = 1e-6  # for rounding, always towards keeping a pair


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles."""
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], U)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, digest = (ends - lengths)[: len(words) - shingle + 1], xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())], U))


def wide_print(hashes: np.ndarray) -> bytes:
    counts = np.zeros(64 * PRINT_WORDS, np.int64)
    for i in range(0, len(hashes), 255):
        x = hashes[i : i + 255, None] ^ SEEDS
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        x ^= x >> U(31)
        counts += np.add.reduce(np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [wide_print(shingles(t.as_py())) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("t"), pa.array(prints, pa.binary())], ["t", "print"])


def prefix_bits(n: int) -> int:
    """So many that each of n tasks has PLACES places or more."""
    return min(MOST_PREFIX, max(LEAST_PREFIX, math.ceil(math.log2(PLACES * n / (2 * PRINT_WORDS)))))


def _place_kind(prefix: int) -> type:
    """A place is a block, 6 bits, and a prefix."""
    return np.uint16 if prefix <= 10 else np.uint32


def _deal(n: int, prefix: int) -> Callable:
    """Each block's value goes to its own prefix and to those one flip away; a place is a block and a prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), FLUSH_PRINTS):
                own = batch.slice(i, FLUSH_PRINTS)
                t = own.column("t").to_numpy(zero_copy_only=False)
                words = np.frombuffer(b"".join(own.column("print").to_pylist()), U).reshape(len(t), PRINT_WORDS)
                values = words.view(np.uint32)
                block = np.arange(2 * PRINT_WORDS)
                check = words[:, (block // 2 + 1) % PRINT_WORDS]
                flips = np.array([0, *(1 << j for j in range(prefix))], np.uint32)
                place = (((values >> np.uint32(32 - prefix))[:, :, None] ^ flips) | (block.astype(np.uint32) << np.uint32(prefix))[None, :, None]).ravel()
                bucket = ((place * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(n)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(n + 1))
                at, rows = order // len(flips), []
                for b in range(n):
                    if cut[b] < cut[b + 1]:
                        mine = slice(cut[b], cut[b + 1])
                        k = at[mine]
                        rows.append([b, place[order[mine]].astype(_place_kind(prefix)).tobytes(), values.ravel()[k].tobytes(), t[k // len(block)].tobytes(), check.ravel()[k].tobytes()])
                for k in range(0, len(rows), 64):
                    yield rows_batch(rows[k : k + 64], DEALT)

    return run


def _central(check: np.ndarray) -> int:
    """The member of a group that is nearest to the majority of its check bits."""
    bits = np.unpackbits(check.view(np.uint8).reshape(len(check), -1), axis=1)
    return int((bits != (2 * bits.sum(axis=0, dtype=np.int64) > len(bits))).sum(axis=1).argmin())


def _meet_behind(word: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether texts with these check bits, those of the word behind, meet there too; the last word has none behind it."""
    apart = a ^ b
    near = (np.bitwise_count(apart & U(0xFFFFFFFF)) <= 2) | (np.bitwise_count(apart >> U(32)) <= 2)
    return near & (word < PRINT_WORDS - 1)


def _met(place: np.ndarray, value: np.ndarray, t: np.ndarray, check: np.ndarray, prefix: int) -> list[np.ndarray]:
    """Rows (a, b) of pairs that meet and are near by the check bits; in a large group, each member with the central one.
    Texts that come from the same other prefix meet at that one already, and others may meet behind: whatever met is connected
    by the pairs of this word and of those behind it."""
    rest, word = 32 - prefix, (place >> np.uint32(prefix)) // 2
    origin = value >> np.uint32(rest)
    away = origin != place & np.uint32(2**prefix - 1)
    home = np.flatnonzero(~away)
    low, base = (value & np.uint32(2**rest - 1)).astype(U), place.astype(U) << U(rest)
    who = np.concatenate([np.arange(len(t)), np.tile(home, rest)])
    keys = np.concatenate([base | low, *[(base | (low ^ U(1 << j)))[home] for j in range(rest)]])
    order = np.lexsort((t[who], keys))
    keys, who = keys[order], who[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(at, len(keys)))
    at, size = at[size > 1], size[size > 1]
    pairs, groups = [], set()
    few, first = size[size <= SMALL_GROUP], at[size <= SMALL_GROUP]
    for step in range(1, int(few.max(initial=1))):
        n = few[few > step] - step
        begin = np.repeat(first[few > step], n)
        i = begin - np.repeat(np.cumsum(n) - n, n) + np.arange(n.sum())
        x, y = who[i], who[i + step]
        near = (np.bitwise_count(check[x] ^ check[y]) <= FAR) & ~((origin[x] == origin[y]) & away[x]) & ~_meet_behind(word[x], check[x], check[y])
        pairs.append(np.unique(np.stack([t[x[near]], t[y[near]]], axis=1), axis=0))
    for i, n in zip(at[size > SMALL_GROUP], size[size > SMALL_GROUP]):
        members = who[i : i + n]
        if away[members[0]] and (origin[members] == origin[members[0]]).all():
            continue
        name = xxhash.xxh64_intdigest(t[members].tobytes())
        if name not in groups:
            groups.add(name)
            center = members[_central(check[members])]
            hub = t[center]
            others = t[members][(t[members] != hub) & ~_meet_behind(word[members], check[members], check[center])]
            pairs.append(np.stack([np.minimum(others, hub), np.maximum(others, hub)], axis=1))
    return pairs


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Pairs that connect the same texts without a cycle, those of the texts with most partners preferred."""
    nodes, at, partners = np.unique(pairs, return_inverse=True, return_counts=True)
    at = at.reshape(-1, 2)
    order = np.argsort(-partners[at].max(axis=1), kind="stable")
    root, kept = list(range(len(nodes))), []
    for k, (x, y) in zip(order.tolist(), at[order].tolist()):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[y] = x
            kept.append(k)
    return pairs[kept]


def _meet(prefix: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"place": _place_kind(prefix), "value": np.uint32, "t": np.int64, "check": U}
        got = {c: [] for c in kinds}
        for batch in batches:
            for c, kind in kinds.items():
                got[c] += [np.frombuffer(x.as_buffer(), kind) for x in batch.column(c)]
        if not got["t"]:
            return
        place, value, t, check = (np.concatenate(x) for x in got.values())
        place = place.astype(np.uint32)
        order = np.argsort(place, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(place[order]) != 0))
        cuts = [0]
        for s in starts.tolist():
            if s - cuts[-1] >= RECORDS:
                cuts.append(s)
        pairs = []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            k = order[a:b]
            pairs += _met(place[k], value[k], t[k], check[k], prefix)
        pairs = _forest(np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0))
        for i in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[i : i + 100_000, k])) for k in range(2)], ["a", "b"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles, hashed once and sorted, however many pairs it stands in."""
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("text")]
        packed = pa.array([x.tobytes() for x in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("t"), pa.array(map(len, sets), pa.int32()), packed], ["t", "n", "s"])


def spanning(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(node, root): a star over each component of these links, with the same components and a link less than nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up] if up in root else up
            x = up
        return x

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in root if find(x) != x]


def _similar(similarity: float) -> Callable:
    """Links that hold; those of one task are thinned to a spanning forest, so a group of copies gives a link per member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for batch in batches:
            near = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b")):
                first, second = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                few, many = sorted((len(first), len(second)))
                if few < similarity * many:  # too unlike in size
                    near.append(False)
                    continue
                both = len(np.intersect1d(first, second, assume_unique=True))
                near.append(both >= similarity * (len(first) + len(second) - both))
            near = pa.array(near, pa.bool_())
            a, b = zip(*links) if links else ((), ())
            links = spanning([*a, *batch.column("a").filter(near).to_pylist()], [*b, *batch.column("b").filter(near).to_pylist()])
        for i in range(0, len(links), 100_000):
            a, b = zip(*links[i : i + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _far(similarity: float) -> float:
    """Two texts are similar if shingles of one alone are at most this share of the sum of their shingles."""
    return (1 - similarity) / (1 + similarity)


def _differences(similarity: float) -> Callable:
    """A row for each shingle that a text or its cluster's central text has alone: d of a text with n shingles. apart: it isn't
    similar to the central text. rarest: how many of the differences must hold one that it has in common with a text that is
    apart and, if it is apart itself, has no fewer differences, if the two are similar."""
    far = _far(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, root, t, s, s_c in zip(*[batch.column(x) for x in ("c", "root", "t", "s", "s_c")]):
                own, center = np.frombuffer(s.as_buffer(), np.int64), np.frombuffer(s_c.as_buffer(), np.int64)
                x = np.setxor1d(own, center, assume_unique=True)
                apart = len(x) > far * (len(own) + len(center)) + SLACK
                need = math.floor((len(x) + far * (len(center) - len(own)) + SLACK / 2) / 2) + 1
                if apart:
                    need = max(need, math.ceil(len(x) - far * len(own) * (1 + 1 / similarity) / 2 - SLACK))
                same = [c.as_py(), root.as_py(), t.as_py(), apart, len(own), len(x), len(x) - max(1, need) + 1]
                for i in range(0, len(x), 100_000):
                    part = x[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([*[pa.array([v] * len(part), f.type) for v, f in zip(same, APART)], pa.array(part)], schema=APART)

    return run


def _verified(pairs: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """Links of the components of the pairs whose shingles (t, s) are similar."""
    both = pairs.join(own.select(F.col("t").alias("a"), F.col("s").alias("s_a")), "a").join(own.select(F.col("t").alias("b"), F.col("s").alias("s_b")), "b")
    return written(both.select("a", "b", "s_a", "s_b").mapInArrow(_similar(similarity), "a long, b long"), "near-pairs")


def _across(placed: DataFrame, own: DataFrame, centers: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different groups of copies, one at least for each link between texts of one cluster in which not both
    texts are similar to the central one. placed: (t, c, root), c the cluster and root the group; centers: (c, center)."""
    center = centers.join(own.select(F.col("t").alias("center"), F.col("s").alias("s_c")), "center").select("c", "s_c")
    texts = placed.join(own.select("t", "s"), "t").join(center, "c")
    kinds = "c long, root long, t long, apart boolean, n int, d int, rarest int, x long"
    every = written(texts.select("c", "root", "t", "s", "s_c").mapInArrow(_differences(similarity), kinds), "near-differences")
    met = every.groupBy("c", "x").agg(F.count("*").alias("texts"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("apart").alias("probed"))
    met = met.where("low < high and probed").select("c", "x", "texts")
    same = ["c", "root", "t", "apart", "n", "d", "rarest"]
    each = every.join(met, ["c", "x"]).groupBy(same).agg(F.sort_array(F.collect_list(F.struct("texts", "x"))).alias("xs"))
    # a text's differences from the rarest on, of which those that meet nothing are the first; after: how many follow one
    each = each.select(*same, F.size("xs").alias("size"), F.posexplode("xs").alias("at", "x"))
    each = written(each.select(*same, F.col("x.x").alias("x"), (F.col("size") - F.col("at") - 1).alias("after")), "near-differences")
    side = lambda df, k: df.select("c", "x", *[F.col(v).alias(f"{v}_{k}") for v in ("root", "t", "apart", "n", "d", "after")])
    a, b = side(each.where("apart"), "a"), side(each.where("d - after <= rarest"), "b")
    order = ~F.col("apart_b") | (F.struct("d_a", "t_a") > F.struct("d_b", "t_b"))
    # if this is the first in common
    enough = 2 * (1 + F.least("after_a", "after_b")) >= F.col("d_a") + F.col("d_b") - _far(similarity) * (F.col("n_a") + F.col("n_b")) - SLACK
    pairs = a.join(b, ["c", "x"]).where((F.col("root_a") != F.col("root_b")) & order & enough)
    return pairs.select(F.least("t_a", "t_b").alias("a"), F.greatest("t_a", "t_b").alias("b")).distinct()


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple[int, int]] = []
    for batch in batches:
        a, b = zip(*links) if links else ((), ())
        links = spanning([*a, *batch.column("a").to_pylist()], [*b, *batch.column("b").to_pylist()])
    for i in range(0, len(links), 100_000):
        a, b = zip(*links[i : i + 100_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _roots(pairs: DataFrame) -> DataFrame:
    """(node, root) of the components of written pairs (a, b). Tasks of TASK_PAIRS pairs turn theirs into stars first, which
    spares rounds over deep components."""
    tasks = max(1, math.ceil(pairs.count() / TASK_PAIRS))
    return connected(written(pairs.select("a", "b").repartition(tasks).mapInArrow(_stars, "a long, b long"), "near-stars"))


def near_links(texts: DataFrame, n: int, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) for texts (t, text): every text that isn't the smallest of its component."""
    prints = texts.mapInArrow(_prints, "t long, print binary").groupBy("t").agg(F.first("print").alias("print"))
    prefix = prefix_bits(n)
    dealt = prints.mapInArrow(_deal(n, prefix), "bucket int, place binary, value binary, t binary, check binary")
    met = dealt.repartitionById(n, "bucket").mapInArrow(_meet(prefix), "a long, b long")
    pairs = written(met.groupBy("a", "b").agg(F.count("*").alias("times")), "near-pairs-met")
    used = pairs.select(F.explode(F.array("a", "b")).alias("t"), "times").groupBy("t").agg(F.sum("times").alias("times"))
    used = small(written(used, "near-used"))
    own = texts.join(used, "t", "left_semi").dropDuplicates(["t"])
    own = small(written(own.mapInArrow(_packed, "t long, n int, s binary"), "near-shingles"))
    links = _verified(pairs.select("a", "b"), own, similarity)

    # clusters that fall into several groups of copies
    of = lambda df, roots, name: df.join(roots.select(F.col("node").alias("t"), F.col("root").alias(name)), "t", "left").withColumn(name, F.coalesce(name, "t"))
    placed = written(of(of(used, _roots(pairs), "c"), _roots(links), "root"), "near-placed")
    center = F.max_by(F.struct(F.col("t").alias("center"), F.col("root").alias("root_c")), F.struct("times", "t")).alias("x")
    centers = placed.groupBy("c").agg(F.min("root").alias("low"), F.max("root").alias("high"), center).where("low < high")
    centers = small(written(centers.select("c", "x.*"), "near-centers"))
    placed = written(placed.join(centers, "c").select("t", "c", "root", "center", "root_c"), "near-placed")
    to_center = placed.where("root != root_c").select(F.least("t", "center").alias("a"), F.greatest("t", "center").alias("b"))
    across = _across(placed.select("t", "c", "root"), own, centers.select("c", "center"), similarity)
    more = _verified(written(to_center.union(across).distinct(), "near-candidates"), own, similarity)
    return _roots(links.union(more))


def named(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with `t`, 64 bits that name the text; where different texts share a hash, all but those of its smallest second hash take that one."""
    both = docs.withColumn("__h1", F.xxhash64(text_col)).withColumn("__h2", F.xxhash64(F.lit(7), F.col(text_col)))
    shared = both.groupBy("__h1").agg(F.min("__h2").alias("__low"), F.max("__h2").alias("__high")).where("__low < __high").select("__h1", "__low")
    shared = written(shared, "near-shared-hashes")
    if shared.isEmpty():
        return both.withColumnRenamed("__h1", "t").drop("__h2")
    return both.join(small(shared), "__h1", "left").withColumn("t", F.when(F.col("__h2") != F.col("__low"), F.col("__h2")).otherwise(F.col("__h1"))).drop("__h1", "__h2", "__low")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", n: int | None = None) -> DataFrame:
    """Rows of docs, one for each component: that with the smallest id (nulls last; of equal ids, by the value key)."""
    n, names = n or partitions(docs.sparkSession), docs.columns
    own = named(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    roots = near_links(own.select("t", "text"), n, similarity)
    key = [c.alias(name) for c, name in zip(value_key(id_col, text_col), ("k1", "k2"))]
    marked = own.select(F.col("t").alias("node"), "id", *[c.alias(name) for c, name in zip(value_key("id", "text"), ("k1", "k2"))]).join(roots, "node", "left")
    marked = marked.select(F.coalesce("root", "node").alias("root"), "id", "k1", "k2")
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("x")).select("x.k1", "x.k2")
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), *key)
    kept = rows.join(first.hint("shuffle_hash"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
