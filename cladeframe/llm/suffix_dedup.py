"""Exact removal of repeated byte strings, by suffix arrays built with two-stage sorting.

A suffix array of all text cannot stand in one task, so the texts are cut by content first: every string of `window`
bytes names its anchor, the smallest hash among its runs of `gram` bytes (the leftmost of equals). Equal strings name equal anchors, so
strings with different anchors never need comparing. The starts that share one anchor are a run, and the run with the
bytes its strings need is a context. Anchors found once are left; of equal contexts (128 bits of hash) one is kept with
its count. The contexts of each anchor then go into suffix arrays, many anchors to a task: the suffixes smaller than
their successors are sorted directly, the others are induced by scans over the buckets of first bytes, and neighbours
are compared to find common prefixes of `window` bytes. Marks go back to all places of a context and merge into spans.

Anchors with more than HOT_CONTEXTS different contexts (a passage in a great many texts) would not fit a task. Exactly
these are settled string by string, with 80 bits of rolling hash, through the exchange that substring dedup uses.

Cases: a null text is empty, an empty text keeps nothing. Repeated rows are texts of their own. Texts shorter than
`window` bytes have no strings. Removal works on bytes and may cut a character. An empty table gives an empty result.
Other columns are ignored, whatever their names. Very long texts are read whole; a single text must fit a task. There are no ties:
all occurrences go, and equal suffixes may stand in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R
from .common import partitions, small, value_key, written
from .substring_dedup import covered_runs

U = np.uint64
GRAM, HOT_CONTEXTS, PLACE_BITS = 64, 500, 31
STOP = 0xFF  # no byte of UTF-8
FULL = U(2**64 - 1)
CONTEXT_DDL = "k1 long, k2 long, anchor long, c1 long, c2 long, lo long, n long"
CONTEXT = pa.schema([(x, pa.int64()) for x in ("k1", "k2", "anchor", "c1", "c2", "lo", "n")])
SHIPPED = pa.schema([("bucket", pa.int32()), ("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("body", pa.binary())])
MARKED = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("starts", pa.binary())])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i, by minima from both ends of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, FULL, U)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


class Runs:
    """Runs of string starts with one anchor, in the texts of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.data, self.window = data, window
        self.p = R.prefix(data.astype(U) + U(1), R.MULTIPLIERS[0])
        n = max(0, len(data) - window + 1)
        starts = np.arange(n)
        doc = np.searchsorted(offsets, starts, "right") - 1
        fits = starts + window <= offsets[doc + 1] if n else np.zeros(0, bool)
        grams = self.hashed(np.arange(max(0, len(data) - gram + 1)), gram)
        # 33 bits of the hash decide; below them the place, so that the leftmost of equals wins in every text
        key = (grams >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(grams)).astype(U)
        least = sliding_least(key, window - gram + 1)
        at = (least & U((1 << PLACE_BITS) - 1)).astype(np.int64)
        new = np.ones(n, bool)
        if n:
            new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (fits[1:] != fits[:-1])
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], n)
        kept = fits[lo] if n else np.zeros(0, bool)
        self.lo, self.hi, self.doc = lo[kept], hi[kept], doc[lo[kept]]
        self.anchor = grams[at[self.lo]]
        self.offset = self.lo - offsets[self.doc]

    def hashed(self, starts: np.ndarray, width, base: int = 0) -> np.ndarray:
        return R.mixed((self.p[starts + width] - self.p[starts]) * R.powers(R.inverse(R.MULTIPLIERS[0]), len(self.data) + 1)[starts])

    def contexts(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each context: its bytes by two multipliers, with the length."""
        lo, width = self.lo[own], self.hi[own] - self.lo[own] + self.window - 1
        q = R.prefix(self.data.astype(U) + U(1), R.MULTIPLIERS[1])
        second = (q[lo + width] - q[lo]) * R.powers(R.inverse(R.MULTIPLIERS[1]), len(self.data) + 1)[lo]
        return self.hashed(lo, width) + width.astype(U), R.mixed(second + width.astype(U))


def _anchors(window: int, gram: int) -> Callable:
    def emit(n: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flush = R.Flush(n)
            for batch in batches:
                k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
                for first, data, offsets in R.text_chunks(batch.column("text")):
                    rows = len(offsets) - 1
                    base = flush.texts(k1[first : first + rows], k2[first : first + rows])
                    runs = Runs(data, offsets, window, gram)
                    flush.add(runs.anchor, None, np.arange(len(runs.lo)) + flush.size, runs.doc + base, runs.offset)
                    if flush.size >= R.FLUSH_ROWS // 4:
                        yield from flush.out()
            yield from flush.out()

        return run

    return emit


def _contexts(window: int, gram: int) -> Callable:
    """The contexts whose anchors occur twice or more; places: the starts of their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            places = batch.column("places").to_pylist()
            for first, data, offsets in R.text_chunks(batch.column("text")):
                runs = Runs(data, offsets, window, gram)
                wanted = np.zeros(len(data) + 1, bool)
                for i in range(len(offsets) - 1):
                    wanted[np.frombuffer(places[first + i], np.uint32).astype(np.int64) + offsets[i]] = True
                own = np.flatnonzero(wanted[runs.lo])
                c1, c2 = runs.contexts(own)
                doc = runs.doc[own] + first
                cols = [k1[doc], k2[doc], runs.anchor[own].view(np.int64), c1.view(np.int64), c2.view(np.int64), runs.offset[own], runs.hi[own] - runs.lo[own]]
                for i in range(0, len(own), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000]) for c in cols], schema=CONTEXT)

    return run


def _shipped(window: int, n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                data = text.encode()
                for x in parts:
                    rows.append([(x["anchor"] & (2**63 - 1)) % n, x["anchor"], x["c1"], x["c2"], data[x["lo"] : x["lo"] + x["n"] + window - 1]])
                    if len(rows) == 5000:
                        yield R.rows_batch(rows, SHIPPED)
                        rows = []
            if rows:
                yield R.rows_batch(rows, SHIPPED)

    return run


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as one number that compares as they do; data must end in 8 bytes of padding."""
    out = np.zeros(len(data) - 8, U)
    for i in range(8):
        out = (out << U(8)) | data[i : len(data) - 8 + i].astype(U)
    return out


def sort_directly(at: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes at the given places in order of their first `depth` bytes, eight bytes a round; only ties go on."""
    order = at[np.argsort(eight[at], kind="stable")]
    key = eight[order]
    group = np.zeros(len(order), np.int64)
    if len(order):
        group[1:] = np.cumsum(key[1:] != key[:-1])
    last = len(eight) - 1
    tied = np.zeros(len(order) + 1, bool)
    tied[1:-1] = group[1:] == group[:-1]
    where = np.flatnonzero(tied[1:] | tied[:-1])
    own, group = order[where], group[where]
    for step in range(8, depth, 8):
        if not len(where):
            break
        key = eight[np.minimum(own + step, last)]
        joined = group[1:] == group[:-1]
        split = joined & (key[1:] != key[:-1])
        if not split.any():
            continue  # all ties share these bytes
        at = np.flatnonzero(np.concatenate([[True], ~joined]))
        size = np.diff(np.append(at, len(group)))
        touched = np.repeat(np.logical_or.reduceat(np.append(split, False), at), size)
        some = np.flatnonzero(touched)
        again = some[np.lexsort((key[some], group[some]))]
        own[some], key[some] = own[again], key[again]
        order[where[some]] = own[some]
        tied = np.zeros(len(where) + 1, bool)
        tied[1:-1] = joined & (key[1:] == key[:-1])
        group = np.cumsum(~tied[:-1])
        kept = tied[1:] | tied[:-1]
        where, own, group = where[kept], own[kept], group[kept]
    return order


def two_stage_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of text, right to `depth` bytes. Only suffixes smaller than their successors are sorted; in a bucket
    of one first byte they stand after the others, which a scan of the buckets in order puts in place: the suffix before
    a placed one is the next of its bucket, if it is larger than its successor."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    unlike = text[1:] != text[:-1]
    differs = np.flatnonzero(unlike)
    ahead = np.concatenate([[0], np.cumsum(unlike)])  # where the run of equal bytes ends
    smaller = np.zeros(n, bool)
    ends = ahead < len(differs)
    d = differs[ahead[ends]]
    smaller[ends] = text[d] < text[d + 1]  # the end of the text is smaller than any byte
    eight = words_at(np.concatenate([text, np.zeros(8, np.uint8)]))
    direct = sort_directly(np.flatnonzero(smaller), eight, depth)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))  # the last suffix has no successor and is the first of its bucket
    out = []
    for c in range(256):
        scanned = []
        run = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        while len(run):  # suffixes of one repeated byte induce each other
            scanned.append(run)
            before = run - 1
            run = before[(before >= 0) & (text[before] == c)]
        bucket = np.concatenate([*scanned, direct[cut[c] : cut[c + 1]]]) if scanned else direct[cut[c] : cut[c + 1]]
        out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[~smaller[before] & (text[before] > c)]
        of = text[before]
        order = np.argsort(of, kind="stable")
        edge = np.searchsorted(of[order], np.arange(257))
        for b in range(c + 1, 256):
            if edge[b] < edge[b + 1]:
                waiting[b].append(before[order[edge[b] : edge[b + 1]]])
    return np.concatenate(out)


def common_with_next(order: np.ndarray, eight: np.ndarray, window: int) -> np.ndarray:
    """True where a suffix and the next in the array share `window` bytes."""
    a, b = order[:-1], order[1:]
    alive = np.arange(len(a))
    last = len(eight) - 1
    for step in range(0, window, 8):
        at = min(step, max(0, window - 8))
        x, y = eight[np.minimum(a[alive] + at, last)], eight[np.minimum(b[alive] + at, last)]
        if window < 8:
            x, y = x >> U(8 * (8 - window)), y >> U(8 * (8 - window))
        alive = alive[x == y]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def repeated_in(bodies: list[bytes], window: int) -> list[np.ndarray]:
    """For each body, the starts of its strings that start anywhere else in these bodies."""
    stop = bytes([STOP])
    text = np.frombuffer(stop.join(bodies) + stop, np.uint8)
    begin = np.cumsum([0, *[len(b) + 1 for b in bodies]])
    order = two_stage_suffix_array(text, window)
    body = np.searchsorted(begin, order, "right") - 1
    whole = order + window < begin[body + 1]
    order = order[whole]
    eight = words_at(np.concatenate([text, np.zeros(8, np.uint8)]))
    share = common_with_next(order, eight, window)
    hit = np.zeros(len(text), bool)
    hit[order[:-1][share]] = True
    hit[order[1:][share]] = True
    at = np.flatnonzero(hit)
    cut = np.searchsorted(at, begin)
    return [at[cut[i] : cut[i + 1]] - begin[i] for i in range(len(bodies))]


def _sorted_bodies(window: int, task_bytes: int) -> Callable:
    """Contexts of one task, whole anchors together, to suffix arrays of about task_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns[1:]))]
        rows.sort(key=lambda r: r[0])
        at = 0
        while at < len(rows):
            upto, size = at, 0
            while upto < len(rows) and (size < task_bytes or rows[upto][0] == rows[upto - 1][0]):
                size += len(rows[upto][3])
                upto += 1
            part = rows[at:upto]
            marks = repeated_in([r[3] for r in part], window)
            out = [[*r[:3], m.astype(np.uint32).tobytes()] for r, m in zip(part, marks) if len(m)]
            for i in range(0, len(out), 5000):
                yield R.rows_batch(out[i : i + 5000], MARKED)
            at = upto

    return run


def _hot_strings(window: int) -> Callable:
    """The strings of hot runs one by one, as 80 bits of hash."""

    def emit(n: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flush = R.Flush(n)
            for batch in batches:
                k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
                parts = batch.column("parts").to_pylist()
                for first, data, offsets in R.text_chunks(batch.column("text")):
                    rows = len(offsets) - 1
                    base = flush.texts(k1[first : first + rows], k2[first : first + rows])
                    spans = [(i, np.arange(x["lo"], x["lo"] + x["n"])) for i in range(rows) for x in parts[first + i]]
                    doc = np.concatenate([np.full(len(s), i) for i, s in spans])
                    pos = np.concatenate([s for _, s in spans])
                    at = pos + offsets[doc]
                    p, q = (R.prefix(data.astype(U) + U(1), m) for m in R.MULTIPLIERS)
                    h = R.mixed((p[at + window] - p[at]) * R.powers(R.inverse(R.MULTIPLIERS[0]), len(data) + 1)[at])
                    c = R.mixed((q[at + window] - q[at]) * R.powers(R.inverse(R.MULTIPLIERS[1]), len(data) + 1)[at])
                    flush.add(h, (c & U(0xFFFF)).astype(np.uint32), np.arange(len(at)) + flush.size, doc + base, pos)
                    if flush.size >= R.FLUSH_ROWS // 2:
                        yield from flush.out()
            yield from flush.out()

        return run

    return emit


def _cleaned(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            cols = [batch.column(c).to_pylist() for c in ("text", "parts", "places")]
            for text, parts, places in zip(*cols):
                data = (text or "").encode()
                starts = [np.frombuffer(places, np.uint32).astype(np.int64)] if places else []
                for x in parts or ():
                    own = np.arange(x["n"]) if x["starts"] is None else np.frombuffer(x["starts"], np.uint32).astype(np.int64)
                    starts.append(own + x["lo"])
                at = np.unique(np.concatenate(starts)).astype(np.uint32).tobytes() if starts else None
                runs, kept, done = covered_runs(at, window), [], 0
                for a, b in runs:
                    kept.append(data[done:a])
                    done = b
                kept = b"".join([*kept, data[done:]])
                rows.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in runs], kept))
            cols = list(zip(*rows)) or [(), (), (), ()]
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], spans), pa.array(cols[3], pa.binary())],
                ["id", "n_bytes", "n_removed", "removed_spans", "kept_bytes"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, window: int = 400, gram: int = GRAM, hot_contexts: int = HOT_CONTEXTS, id_col: str = "doc_id", text_col: str = "text", n: int | None = None, task_bytes: int = 2_000_000) -> DataFrame:
    """(id, n_bytes, n_removed, removed_spans, kept_bytes) for every row; window must be at least gram."""
    gram = min(gram, window)
    n = n or partitions(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.select(*value_key("id", "text"), "id", "text")
    key, context = ["k1", "k2"], ["anchor", "c1", "c2"]
    anchors = R.repeated_places(texts.select("k1", "k2", "text"), _anchors(window, gram), n)
    near = texts.join(anchors.hint("shuffle_hash"), key)
    members = written(near.mapInArrow(_contexts(window, gram), CONTEXT_DDL), "contexts")
    classes = members.groupBy(*context).agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2", "lo", "n")).alias("x"))
    classes = written(classes.select(*context, "m", "x.*"), "context-classes")
    by_anchor = classes.groupBy("anchor").agg(F.count("*").alias("contexts"), F.sum("m").alias("total"))
    hot = small(written(by_anchor.where(F.col("contexts") > hot_contexts).select("anchor"), "hot-anchors"))
    # hot anchors leave before anything is dealt by anchor, so no task gets more than hot_contexts rows of one
    again = by_anchor.where(F.col("contexts").between(1, hot_contexts) & (F.col("total") > 1)).select("anchor")
    cold = written(classes.join(hot, "anchor", "left_anti").join(again, "anchor", "left_semi"), "context-groups")

    sort_these = cold.groupBy(*key).agg(F.collect_list(F.struct("anchor", "c1", "c2", "lo", "n")).alias("parts"))
    ship = texts.join(sort_these.hint("shuffle_hash"), key).dropDuplicates(key)
    shipped = ship.mapInArrow(_shipped(window, n), "bucket int, anchor long, c1 long, c2 long, body binary").repartitionById(n, "bucket")
    marked = shipped.mapInArrow(_sorted_bodies(window, task_bytes), "anchor long, c1 long, c2 long, starts binary")
    often = cold.where("m > 1").select(*context, F.lit(None).cast("binary").alias("starts"))
    often_keys = often.select(*context)
    marked = often.union(marked.join(often_keys, context, "left_anti"))
    found = members.join(marked, context).groupBy(*key).agg(F.collect_list(F.struct("lo", "n", "starts")).alias("parts"))

    hot_runs = members.join(hot, "anchor").groupBy(*key).agg(F.collect_set(F.struct("lo", "n")).alias("parts"))
    by_string = R.repeated_places(texts.join(hot_runs.hint("shuffle_hash"), key), _hot_strings(window), n)

    out = texts.join(found.hint("shuffle_hash"), key, "left").join(by_string.hint("shuffle_hash"), key, "left")
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, n_bytes long, n_removed long, removed_spans array<struct<start: long, end: long>>, kept_bytes binary"
    return out.select("id", "text", "parts", "places").mapInArrow(_cleaned(window), ddl).withColumnRenamed("id", id_col)
