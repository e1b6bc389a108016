"""Exact removal of repeated word passages, by fixed-block anchors.

Reference blocks are the non-overlapping runs of (window + 1) // 2 words of each text; every window holds one whole
block. The rolling windows of that width of all texts probe the blocks' hashes. Around each hit the match is extended:
the windows that hold the block are compared by 80 bits of rolling hash with all other such windows, so that a group of
copies costs one entry per flush and never its pairs; windows found twice merge into maximal exact repeats.

Cases: a null or empty text has no words and keeps "". Rows repeated in the table, equal ids included, are documents of
their own, so a repeated row with `window` words or more loses all of them. Texts are cut by null ids like by any other.
An empty table gives an empty result. Other columns are ignored, whatever their names. Very long texts are windowed whole; a single text must fit a task. There are no ties: all occurrences go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R
from .common import partitions, value_key

U = np.uint64


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(name).to_numpy(zero_copy_only=False) for name in ("k1", "k2"))


def _block_probes(width: int) -> Callable:
    def emit(n: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flush = R.Flush(n)
            for batch in batches:
                k1, k2 = _keys(batch)
                for first, data, offsets in R.text_chunks(batch.column("text")):
                    base = flush.texts(k1[first : first + len(offsets) - 1], k2[first : first + len(offsets) - 1])
                    starts, ends, doc = R.words(data, offsets)
                    h = R.windows(R.word_hashes(data, starts, ends, R.MULTIPLIERS[0]), width, R.MULTIPLIERS[1])
                    pos = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
                    whole = doc[: len(h)] == doc[width - 1 :] if len(h) else np.zeros(0, bool)
                    # 48 bits find candidates; chance hits are rejected when windows are compared
                    h, doc, pos = h[whole] & ~U(0xFFFF), doc[: len(h)][whole], pos[: len(h)][whole]
                    block = np.flatnonzero(pos % width == 0)
                    flush.add(h, None, block + flush.size, doc[block] + base, pos[block])
                    if flush.size >= R.FLUSH_ROWS:
                        yield from flush.out()
            yield from flush.out()

        return run

    return emit


def _windows_near(window: int, width: int) -> Callable:
    def emit(n: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flush = R.Flush(n)
            for batch in batches:
                k1, k2 = _keys(batch)
                places = batch.column("places").to_pylist()
                for first, data, offsets in R.text_chunks(batch.column("text")):
                    rows = len(offsets) - 1
                    base = flush.texts(k1[first : first + rows], k2[first : first + rows])
                    starts, ends, doc = R.words(data, offsets)
                    lo = np.searchsorted(doc, np.arange(rows + 1))
                    near = np.zeros(len(doc) + 1, np.int64)
                    for i in range(rows):
                        if places[first + i] and lo[i + 1] - lo[i] >= window:
                            block = np.frombuffer(places[first + i], np.uint32).astype(np.int64)
                            last = lo[i + 1] - lo[i] - window
                            a, b = np.maximum(block - (window - width), 0), np.minimum(block, last) + 1
                            np.add.at(near, (a + lo[i])[a < b], 1)
                            np.add.at(near, (b + lo[i])[a < b], -1)
                    at = np.flatnonzero(np.cumsum(near) > 0)
                    if not len(at):
                        continue
                    h = R.windows(R.word_hashes(data, starts, ends, R.MULTIPLIERS[0]), window, R.MULTIPLIERS[1])[at]
                    c = R.windows(R.word_hashes(data, starts, ends, R.MULTIPLIERS[1]), window, R.MULTIPLIERS[0])[at]
                    flush.add(h, (c & U(0xFFFF)).astype(np.uint32), np.arange(len(at)) + flush.size, doc[at] + base, at - lo[doc[at]])
                    if flush.size >= R.FLUSH_ROWS // 2:
                        yield from flush.out()
            yield from flush.out()

        return run

    return emit


def covered_runs(places: bytes | None, width: int) -> list[tuple[int, int]]:
    """Maximal [start, end) runs that windows of this width at sorted places cover."""
    if not places:
        return []
    at = np.frombuffer(places, np.uint32).astype(np.int64)
    cut = np.flatnonzero(np.diff(at) > width)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + width).tolist()))


def _cleaned(window: int, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                words = (text or "").encode().split()
                runs, kept, at = covered_runs(places, window), [], 0
                for a, b in runs:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in runs], b" ".join(kept).decode()))
            cols = list(zip(*rows)) or [(), (), (), ()]
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], spans), pa.array(cols[3], pa.string())],
                ["id", "n_words", "n_removed", "removed_spans", "kept_text"],
            )

    return run


def remove_repeated_passages(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", n: int | None = None) -> DataFrame:
    """(id, n_words, n_removed, removed_spans, kept_text) for every row; kept words are joined by one space.

    Spark shuffles: the block probes, the references of repeated blocks, each text once (its exchange is used again
    for the result), and the windows around repeated blocks.
    """
    n = n or partitions(docs.sparkSession)
    width = (window + 1) // 2
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.select(*value_key("id", "text"), "id", "text")
    anchors = R.repeated_places(texts.select("k1", "k2", "text"), _block_probes(width), n)
    near = texts.join(anchors.hint("shuffle_hash"), ["k1", "k2"])
    found = R.repeated_places(near, _windows_near(window, width), n)
    both = texts.join(found.hint("shuffle_hash"), ["k1", "k2"], "left")
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, n_words long, n_removed long, removed_spans array<struct<start: long, end: long>>, kept_text string"
    return both.select("id", "text", "places").mapInArrow(_cleaned(window, kind), ddl).withColumnRenamed("id", id_col)
