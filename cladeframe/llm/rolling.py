"""Rolling hashes over Arrow text, and the exchange that finds hashes occurring more than once.

Hashes travel as sorted, delta-coded blobs, one per bucket of the hash range, so that a row of the shuffle holds
thousands of windows. A hash seen twice inside one flush of a task is settled there and sends no references: what is
very common costs one entry per flush, not one per occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CHUNK_BYTES = 1 << 20
FLUSH_ROWS = 4_000_000
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the worker's life."""
    base %= 1 << 64
    if len(_powers.get(base, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.empty(size, U)
        out[0], done = 1, 1
        while done < size:
            out[done : 2 * done] = out[:done] * U(pow(base, done, 1 << 64))
            done *= 2
        _powers[base] = out
    return _powers[base][:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def windows(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of values[i : i + width] for every i."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    p = prefix(values, base)
    return mixed((p[width:] - p[:-width]) * powers(inverse(base), n))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about CHUNK_BYTES; a longer text is a run of its own. Null is empty."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        last = min(last, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of all words; no word crosses texts."""
    n = len(data)
    gap, edge = SPACE[data], np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:n]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    p = prefix(data.astype(U) + U(1), base)
    return mixed((p[ends] - p[starts]) * powers(inverse(base), len(data) + 1)[starts] + (ends - starts).astype(U))


def planes(values: np.ndarray) -> bytes:
    """Byte planes: the high planes of small numbers are zeros, which the shuffle's codec removes."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


# A blob: sorted hashes, check bits, "seen twice here" flags; references (entry, text of the blob, position); keys of the texts.
BLOB = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in ("h", "c", "twice", "r_entry", "r_doc", "r_pos", "d1", "d2"))])
BLOB_DDL = "bucket int, h binary, c binary, twice binary, r_entry binary, r_doc binary, r_pos binary, d1 binary, d2 binary"
PLACES_DDL = "k1 long, k2 long, places binary"
PLACES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("places", pa.binary())])
EMPTY = np.zeros(0, U)


def bucket_edges(n: int) -> np.ndarray:
    return np.array([-(-(k << 48) // n) << 16 for k in range(n)], U)


def blob_row(bucket, h=EMPTY, c=None, twice=None, entry=(), doc=(), pos=(), d1=EMPTY, d2=EMPTY) -> list:
    used, doc = np.unique(np.asarray(doc, np.uint32), return_inverse=True)
    c = np.zeros(len(h), np.uint32) if c is None else c
    twice = np.zeros(len(h), bool) if twice is None else twice
    return [bucket, planes(np.diff(h, prepend=U(0))), planes(c), np.packbits(twice).tobytes(), planes(np.asarray(entry, np.uint32)), planes(doc.astype(np.uint32)), planes(np.asarray(pos, np.uint32)), d1[used].tobytes(), d2[used].tobytes()]


def rows_batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(col), kind) for col, kind in zip(zip(*rows), schema.types)], schema=schema)


class Flush:
    """Gathers windows of one task; out() gives the blobs."""

    def __init__(self, n: int):
        self.n, self.edges, self.size = n, bucket_edges(n), 0
        self.parts: list[tuple] = []
        self.keys: list[tuple] = []
        self.docs = 0

    def texts(self, k1: np.ndarray, k2: np.ndarray) -> int:
        self.keys.append((k1, k2))
        self.docs += len(k1)
        return self.docs - len(k1)

    def add(self, h, c, ref, doc, pos) -> None:
        """Hashes, check bits or None; ref: which windows are referred to; doc, pos: of these."""
        self.parts.append((h, c, ref, doc, pos))
        self.size += len(h)

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        h = np.concatenate([p[0] for p in self.parts])
        checked = self.parts[0][1] is not None
        c = np.concatenate([p[1] for p in self.parts]) if checked else None
        ref = np.concatenate([p[2] for p in self.parts])
        doc = np.concatenate([p[3] for p in self.parts]).astype(np.uint32)
        pos = np.concatenate([p[4] for p in self.parts]).astype(np.uint32)
        d1, d2 = (np.concatenate([k[i] for k in self.keys]).view(U) for i in (0, 1))
        if checked:
            order = np.argsort(h, kind="stable")
            s, sc = h[order], c[order]
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (sc[1:] != sc[:-1])
            at = np.flatnonzero(new)
            entry_of = np.empty(len(h), np.int64)
            entry_of[order] = np.cumsum(new) - 1
            entry = entry_of[ref]
            u, uc = s[at], sc[at]
        else:
            s = np.sort(h)
            new = np.ones(len(s), bool)
            new[1:] = s[1:] != s[:-1]
            at = np.flatnonzero(new)
            u, uc = s[at], None
            entry = np.searchsorted(u, h[ref])
        twice = np.diff(np.append(at, len(s))) > 1
        rows = []
        known = twice[entry]
        if known.any():
            dest = (d1[doc[known]] % U(self.n)).astype(np.int64)
            where = np.flatnonzero(known)[np.argsort(dest, kind="stable")]
            cut = np.searchsorted(np.sort(dest), np.arange(self.n + 1))
            for b in range(self.n):
                if cut[b] < cut[b + 1]:
                    own = where[cut[b] : cut[b + 1]]
                    rows.append(blob_row(b, doc=doc[own], pos=pos[own], d1=d1, d2=d2))
        rest = np.flatnonzero(~known)
        rest = rest[np.argsort(entry[rest], kind="stable")]
        lo = np.append(np.searchsorted(u, self.edges), len(u))
        r_lo = np.searchsorted(entry[rest], lo)
        for b in range(self.n):
            if lo[b] < lo[b + 1]:
                own = rest[r_lo[b] : r_lo[b + 1]]
                span = slice(lo[b], lo[b + 1])
                rows.append(blob_row(b, u[span], None if uc is None else uc[span], twice[span], entry[own] - lo[b], doc[own], pos[own], d1, d2))
        self.__init__(self.n)
        for i in range(0, len(rows), 64):
            yield rows_batch(rows[i : i + 64], BLOB)


def _repeated(n: int) -> Callable:
    """Per task: which hashes of its buckets occur twice or more; their references, dealt by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, cs, flags, refs, known, total = [], [], [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                h = np.cumsum(unplanes(row["h"], U), dtype=U)
                d1, d2 = np.frombuffer(row["d1"], U), np.frombuffer(row["d2"], U)
                doc, pos = unplanes(row["r_doc"], np.uint32), unplanes(row["r_pos"], np.uint32)
                if not len(h):
                    known.append((d1[doc], d2[doc], pos))
                    continue
                entry = unplanes(row["r_entry"], np.uint32)
                refs.append((entry.astype(np.int64) + total, d1, d2, doc, pos))
                hs.append(h)
                total += len(h)
                cs.append(unplanes(row["c"], np.uint32))
                flags.append(np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(h)).astype(bool))
        if hs:
            h, c, twice = np.concatenate(hs), np.concatenate(cs), np.concatenate(flags)
            order = np.lexsort((c, h)) if c.any() else np.argsort(h, kind="stable")
            s, sc = h[order], c[order]
            same = (s[1:] == s[:-1]) & (sc[1:] == sc[:-1])
            group = np.concatenate([[0], np.cumsum(~same)])
            many = np.bincount(group, weights=1 + twice[order]) > 1
            hot = np.empty(len(h), bool)
            hot[order] = many[group]
            for entry, d1, d2, doc, pos in refs:
                own = hot[entry]
                known.append((d1[doc[own]], d2[doc[own]], pos[own]))
        yield from _dealt(known, n)

    return run


def _dealt(known: list[tuple], n: int) -> Iterator[pa.RecordBatch]:
    if not known:
        return
    k1, k2, pos = (np.concatenate([x[i] for x in known]) for i in range(3))
    if not len(k1):
        return
    order = np.lexsort((pos, k2, k1))
    k1, k2, pos = k1[order], k2[order], pos[order]
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    at, doc = np.flatnonzero(new), np.cumsum(new) - 1
    d1, d2 = k1[at], k2[at]
    dest = (k1 % U(n)).astype(np.int64)
    where = np.argsort(dest, kind="stable")
    cut = np.searchsorted(dest[where], np.arange(n + 1))
    rows = [blob_row(b, doc=doc[own], pos=pos[own], d1=d1, d2=d2) for b in range(n) if len(own := where[cut[b] : cut[b + 1]])]
    for i in range(0, len(rows), 64):
        yield rows_batch(rows[i : i + 64], BLOB)


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text: its sorted distinct positions."""
    known = []
    for batch in batches:
        for row in batch.to_pylist():
            doc = unplanes(row["r_doc"], np.uint32)
            known.append((np.frombuffer(row["d1"], U)[doc], np.frombuffer(row["d2"], U)[doc], unplanes(row["r_pos"], np.uint32)))
    if not known:
        return
    k1, k2, pos = (np.concatenate([x[i] for x in known]) for i in range(3))
    order = np.lexsort((pos, k2, k1))
    k1, k2, pos = k1[order], k2[order], pos[order]
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    at = np.append(np.flatnonzero(new), len(k1))
    for i in range(0, len(at) - 1, 1000):
        yield rows_batch([[int(k1[a].view(np.int64)), int(k2[a].view(np.int64)), np.unique(pos[a:b]).tobytes()] for a, b in zip(at[i : i + 1000], at[i + 1 : i + 1001])], PLACES)


def repeated_places(texts: DataFrame, emit: Callable, n: int) -> DataFrame:
    """(k1, k2, places): per text the positions, as uint32, of windows whose hash occurs twice or more.

    emit(n) is a mapInArrow function over texts that returns the blobs of a Flush. Memory of a task is bounded by its
    share of the distinct windows of each flush, 1 / n of them.
    """
    blobs = texts.mapInArrow(emit(n), BLOB_DDL).repartitionById(n, "bucket")
    dealt = blobs.mapInArrow(_repeated(n), BLOB_DDL).repartitionById(n, "bucket")
    return dealt.mapInArrow(_by_text, PLACES_DDL)
