"""SimHash near-duplicates, by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius of 3, that is one flipped bit, and fingerprints meet
on equal variants. On whole variants any two that meet differ in at most 2 bits, so all of a group are linked. The
odd third bit is met by masking one of four blocks of 16 bits: a pair that differs in 3 bits has a block whose masking
leaves at most 2 of them (or, with all 3 in one block, leaves none), and meets on the masked variants. Masked groups are
verified: small ones pair by pair; larger ones by masking one more bit, where what meets is within the radius without
comparison, and, for fingerprints that differ in the masked block only, by one and two flips of even and odd values.
So groups of near copies give linear numbers of links, and no link between different fingerprints is lost.

Equal fingerprints are merged before anything else. Connected components come from alternating large-star and
small-star rounds on the links, each written to the shared folder.

Cases: a null text or one without words has fingerprint zero and is linked like any other. Fewer words than a shingle
give one shingle of them all. Rows repeated in the table share a fingerprint. A component's id is its smallest non-null
id, null if it has none. Very long texts are shingled whole. A bit that exactly half of the shingles have is 0, so ties have
one result. An empty table gives an empty result. Other columns are ignored by components and kept by
keep_one, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, value_key, written
from .rolling import planes, rows_batch, unplanes

U = np.uint64
RADIUS = 3
SMALL_GROUP = 32
FLUSH_PRINTS = 20_000
ONE = U(1)
BITS = ONE << np.arange(64, dtype=U)
BLOCKS = [sum(int(b) for b in BITS[16 * g : 16 * g + 16]) for g in range(4)]
#: Variant j of a fingerprint: which bits it flips, which it keeps, and its kind (0: whole; 1 to 4: one block masked).
FLIP = np.concatenate([[U(0)], BITS, *[np.concatenate([[U(0)], BITS[(BITS & U(m)) == 0]]) for m in BLOCKS]])
KIND = np.concatenate([np.zeros(65, np.uint8), *[np.full(49, g + 1, np.uint8) for g in range(4)]])
KEEP = np.array([U(2**64 - 1), *[U(2**64 - 1 - m) for m in BLOCKS]], U)[KIND]
PACKED = pa.schema([("bucket", pa.int32()), ("prints", pa.binary()), ("which", pa.binary()), ("variant", pa.binary())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _single(shingle: bytes) -> int:
    """Over half of one hash is the hash itself."""
    return xxhash.xxh64_intdigest(shingle, 42)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _single(joined)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = len(words) - shingle + 1
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    starts = (ends - lengths)[:n]
    for i in range(0, n, 50_000):
        cut = zip(starts[i : i + 50_000].tolist(), ends[shingle - 1 + i : shingle - 1 + i + 50_000].tolist())
        h = np.array([digest(joined[a:b], 42) for a, b in cut], U)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[: len(h)].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(U)[0])


def _fingerprints(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], U)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("k1", "k2", "id")], pa.array(prints.view(np.int64))], ["k1", "k2", "id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, id, fp) for every row; k1, k2: the row's value key."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.select(*value_key("id", "text"), "id", "text").mapInArrow(_fingerprints(shingle), f"k1 long, k2 long, id {kind}, fp long")


def _mixed(x: np.ndarray, kind: np.ndarray) -> np.ndarray:
    x = (x ^ (kind.astype(U) * U(0x9E3779B97F4A7C15))) * U(0xBF58476D1CE4E5B9)
    return (x ^ (x >> U(29))) * U(0x94D049BB133111EB) >> U(16)


def _variants(n: int) -> Callable:
    """Deals the variants to n buckets; what goes to a bucket is packed as (fingerprint, variant number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            for i in range(0, len(every), FLUSH_PRINTS):
                prints = np.sort(every[i : i + FLUSH_PRINTS])
                keys = (prints[:, None] ^ FLIP[None, :]) & KEEP[None, :]
                bucket = (_mixed(keys, KIND[None, :]) % U(n)).astype(np.int32).ravel()
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(n + 1))
                which, variant = (order // len(FLIP)).astype(np.uint32), (order % len(FLIP)).astype(np.uint16)
                rows = []
                for b in range(n):
                    if cut[b] < cut[b + 1]:
                        own = slice(cut[b], cut[b + 1])
                        used, place = np.unique(which[own], return_inverse=True)
                        rows.append([b, prints[used].tobytes(), planes(np.diff(place.astype(np.uint32), prepend=np.uint32(0))), planes(variant[own])])
                for k in range(0, len(rows), 64):
                    yield rows_batch(rows[k : k + 64], PACKED)

    return run


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys, first place of each group in it, group sizes."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    at = np.flatnonzero(new)
    return order, at, np.diff(np.append(at, len(order)))


def _stars(prints: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every member of a group to the group's smallest fingerprint."""
    order, at, size = _groups(*keys)
    p = prints[order]
    least = np.repeat(np.minimum.reduceat(p, at), size) if len(p) else p
    far = p != least
    return least[far], p[far]


def _pairs(prints: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius in groups of at most SMALL_GROUP, given in order."""
    out = []
    for step in range(1, int(size.max(initial=1))):
        own = size > step
        i = np.repeat(at[own], size[own] - step) + (np.arange((size[own] - step).sum()) - np.repeat(np.cumsum(size[own] - step) - (size[own] - step), size[own] - step))
        a, b = prints[i], prints[i + step]
        near = np.bitwise_count(a ^ b) == RADIUS
        out.append((np.minimum(a, b)[near], np.maximum(a, b)[near]))
    return tuple(np.concatenate([x[k] for x in out]) if out else np.zeros(0, U) for k in (0, 1))


def _large_groups(prints: np.ndarray, keys: np.ndarray, kind: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    base = (kind.astype(U) - ONE) * U(16)
    own = (prints >> base) & U(0xFFFF)
    for t in range(16):
        yield _stars(prints, keys, kind, own & ~(ONE << U(t)))
    same = (prints & KEEP[65 + 49 * (kind.astype(np.int64) - 1)]) == keys
    prints, keys, kind, own = prints[same], keys[same], kind[same], own[same]
    even = np.bitwise_count(own) % 2 == 0
    one = [U(1 << i) for i in range(16)]
    two = [U(1 << i | 1 << j) for i in range(16) for j in range(i)]
    e, o = np.flatnonzero(even), np.flatnonzero(~even)
    who = np.concatenate([np.tile(e, 16), np.tile(o, 120)])
    met = np.concatenate([*[own[e] ^ f for f in one], *[own[o] ^ f for f in two]]) if len(who) else np.zeros(0, U)
    order, at, size = _groups(keys[who], kind[who], met)
    if len(order):
        core = np.repeat(np.maximum.reduceat(even[who][order].astype(np.int8), at), size) > 0
        kept = order[core]
        yield _stars(prints[who[kept]], keys[who[kept]], kind[who[kept]], met[kept])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    prints, variants = [], []
    for batch in batches:
        for row in batch.to_pylist():
            place = np.cumsum(unplanes(row["which"], np.uint32), dtype=np.uint32)
            prints.append(np.frombuffer(row["prints"], U)[place])
            variants.append(unplanes(row["variant"], np.uint16))
    if not prints:
        return
    prints, j = np.concatenate(prints), np.concatenate(variants)
    keys, kind = (prints ^ FLIP[j]) & KEEP[j], KIND[j]
    order, at, size = _groups(keys, kind)
    many = np.repeat(size > 1, size)
    order = order[many]
    prints, keys, kind = prints[order], keys[order], kind[order]
    size = size[size > 1]
    at = np.cumsum(size) - size
    members = np.repeat(size, size)
    whole, masked = kind == 0, (kind > 0) & (members > SMALL_GROUP)
    found = [_stars(prints[whole], keys[whole])]
    pairs = (kind[at] > 0) & (size <= SMALL_GROUP) if len(at) else np.zeros(0, bool)
    found.append(_pairs(prints, at[pairs], size[pairs]))
    if masked.any():
        found += _large_groups(prints[masked], keys[masked], kind[masked])
    a, b = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    order, at, _ = _groups(a, b)
    a, b = (x[order][at].view(np.int64) for x in (a, b))
    for i in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 100_000]), pa.array(b[i : i + 100_000])], schema=LINKS)


def print_links(prints: DataFrame, n: int) -> DataFrame:
    """Links (a, b) between the distinct fingerprints (column fp) within the radius: enough to connect all that are."""
    dealt = prints.select("fp").repartition(n, "fp").mapInArrow(_variants(n), "bucket int, prints binary, which binary, variant binary")
    return dealt.repartitionById(n, "bucket").mapInArrow(_links, "a long, b long").distinct()


def connected(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b) that isn't its component's smallest: alternating star rounds."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u > v").distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def components(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", n: int | None = None) -> DataFrame:
    """(k1, k2, id, fp, root, component_id) for every row; root: the component's smallest fingerprint."""
    n = n or partitions(docs.sparkSession)
    marked = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    prints = marked.groupBy("fp").agg(F.min("id").alias("least_id"))
    roots = connected(print_links(prints, n))
    placed = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "components")
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = placed.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(by_print, "fp").select("k1", "k2", "id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, one for each component: that with the smallest id (nulls last; of equal ids, by the value key)."""
    names = docs.columns
    marked = components(docs, shingle, id_col, text_col)
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("x")).select("x.k1", "x.k2")
    key = [c.alias(name) for c, name in zip(value_key(id_col, text_col), ("k1", "k2"))]
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), *key)
    kept = rows.join(first.hint("shuffle_hash"), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
