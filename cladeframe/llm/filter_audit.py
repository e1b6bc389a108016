"""Filter interaction audit over a sparse document-term matrix.

document_term_matrix: every task turns its documents, some million bytes at a time, into shards in CSR form (row
starts, terms, counts) over a vocabulary of its own, and begins another vocabulary when that is full. The vocabularies, far
fewer words than the texts, are dealt to 2^31 buckets by hash and ranked there, which is the global dictionary: a word's id is
its bucket times 2^32 plus its rank among the bucket's words, so ids don't depend on partitions or shards. Buckets are so many
that most have one word, since sorting compares words only within a bucket. Each shard then receives the ids of its words, and its terms become global, sorted within rows. row_statistics reads a document's words
(sum of the row) and distinct words (its nonzero entries) from that matrix.

audit: filters A and B from the row statistics, C and D from counts made while the text was at hand, E from the
smallest id of each text's 256-bit digest. Documents are counted by part and set of failed filters, 32 rows a part at
most, and only these counts are expanded to the orders of the filters.

Cases: a null text counts as empty: it has no words, fails A, and is a copy of other empty texts. A null part is the
empty string. A null id has no smaller one and is none, so its rows never fail E; rows of equal text and equal id, and
so repeated rows, don't fail E by each other and are all counted. Very long texts make a shard of their own. Labels of
one id are combined (1 if any row says 1); a document without labels is neither good nor toxic. A part in which no
document fails has its zeros; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SHARD_BYTES, VOCABULARY_WORDS, BUCKETS = 6_000_000, 500_000, 1 << 31
CAPITALS, SYMBOLS = (np.isin(np.arange(256), list(x)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"))
FACTS = [("n_chars", pa.int64()), ("n_capitals", pa.int64()), ("n_symbols", pa.int64()), ("digest", pa.binary())]
SHARD = "words long, docs array<struct<row:{row},n_chars:bigint,n_capitals:bigint,n_symbols:bigint,digest:binary>>, starts array<int>, terms array<bigint>, counts array<int>"
# a task's own shard has its numbers as bytes of int32, which are written and shuffled whole
LOCAL = SHARD.replace("array<int>", "binary").replace("array<bigint>", "binary")
LISTED = ", listed boolean, first int, vocabulary array<string>, n_docs array<int>, n array<bigint>"


def _give_back() -> None:
    """Arrow keeps freed memory, which would add up over the workers of an executor."""
    pa.default_memory_pool().release_unused()


def _listed(values: pa.Array) -> pa.Array:
    """One list of all these values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class _Vocabulary:
    """Numbers of words within one task, with their documents and occurrences."""

    def __init__(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.n_docs, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of these different words; new ones get the next."""
        words = words.cast(pa.large_string())
        at = pc.index_in(words, self.known)
        new, size = at.is_null(), len(self.known)
        self.known = pa.concat_arrays([self.known, words.filter(new)])
        out = at.fill_null(0).to_numpy().astype(np.int64)
        out[new.to_numpy(zero_copy_only=False)] = np.arange(size, len(self.known))
        return out

    def count(self, terms: np.ndarray, counts: np.ndarray) -> None:
        size = len(self.known)
        grown = lambda old, new: np.pad(old, (0, size - len(old))) + new
        self.n_docs = grown(self.n_docs, np.bincount(terms, minlength=size))
        self.n = grown(self.n, np.bincount(terms, weights=counts, minlength=size).astype(np.int64))

    def rows(self, own: int, schema: pa.Schema, at_once: int = 50_000) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.known), at_once):
            part = slice(i, i + at_once)
            filled = {
                "words": pa.array([own], pa.int64()), "listed": pa.array([True]), "first": pa.array([i], pa.int32()), "vocabulary": _listed(self.known[part].cast(pa.string())),
                "n_docs": _listed(pa.array(self.n_docs[part].astype(np.int32))), "n": _listed(pa.array(self.n[part])),
            }
            yield pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def _facts(texts: pa.Array) -> list[pa.Array]:
    at = _offsets(texts)
    plain = texts.buffers()[2] or b""
    plain = np.frombuffer(plain, np.uint8)[at[0] : at[-1]]
    # a zero behind the last text, where empty ones at the end begin; reduceat gives an empty text what follows it
    total = lambda kind: np.where(np.diff(at) > 0, np.add.reduceat(np.append(kind[plain], False), at[:-1] - at[0], dtype=np.int64), 0)
    digests = [hashlib.sha256(plain[a:b]).digest() for a, b in zip(at[:-1] - at[0], at[1:] - at[0])]
    return [pc.utf8_length(texts).cast(pa.int64()), pa.array(total(CAPITALS)), pa.array(total(SYMBOLS)), pa.array(digests, pa.binary())]


def _cells(texts: pa.Array, vocabulary: _Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The matrix of texts: cells in order, a row's number times 2^32 plus a term's, and their counts."""
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    full = pc.not_equal(words, "")
    row = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(split).to_numpy())[full.to_numpy(zero_copy_only=False)]
    coded = words.filter(full).dictionary_encode()
    return np.unique(row << 32 | vocabulary.numbers(coded.dictionary)[coded.indices.to_numpy()], return_counts=True)


def _schema(row: pa.DataType) -> pa.Schema:
    docs = pa.struct([pa.field("row", row), *[pa.field(n, t) for n, t in FACTS]])
    numbers = [(n, pa.binary()) for n in ("starts", "terms", "counts")]
    words = [("listed", pa.bool_()), ("first", pa.int32()), *[(n, pa.list_(t)) for n, t in (("vocabulary", pa.string()), ("n_docs", pa.int32()), ("n", pa.int64()))]]
    return pa.schema([("words", pa.int64()), ("docs", pa.list_(docs)), *numbers, *words])


def _shards(shard_bytes: int, most_words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vocabulary, schema = TaskContext.get().partitionId() << 32, _Vocabulary(), None
        for batch in batches:
            schema = schema or _schema(batch.schema.field("row").type)
            texts = batch.column("text").fill_null("")
            size = np.cumsum(np.diff(_offsets(texts)))
            # a shard ends behind the row that fills it
            cuts = np.flatnonzero(np.diff(size // shard_bytes, prepend=0)) + 1
            cuts = np.unique([0, *cuts.tolist(), len(texts)]).tolist()
            for a, b in zip(cuts, cuts[1:]):
                part = texts.slice(a, b - a)
                docs = pa.StructArray.from_arrays([batch.column("row").slice(a, b - a), *_facts(part)], fields=list(schema.field("docs").type.value_type))
                cells, counts = _cells(part, vocabulary)
                terms, starts = cells & 0xFFFFFFFF, np.searchsorted(cells >> 32, np.arange(len(part) + 1))
                vocabulary.count(terms, counts)
                filled = {"words": pa.array([own], pa.int64()), "listed": pa.array([False]), "docs": _listed(docs)}
                filled |= {n: pa.array([x.astype(np.int32).tobytes()], pa.binary()) for n, x in (("starts", starts), ("terms", terms), ("counts", counts))}
                del cells, terms, counts, part, docs
                _give_back()
                yield pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)
                del filled
                if len(vocabulary.known) >= most_words:
                    yield from vocabulary.rows(own, schema)
                    own, vocabulary = own + 1, _Vocabulary()
        if len(vocabulary.known):
            yield from vocabulary.rows(own, schema)
        del vocabulary
        _give_back()

    return run


def _globally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with the ids of the dictionary, terms ascending within each row. Shards of one vocabulary mostly follow each other."""
    own, ids, ranks = None, None, None
    for batch in batches:
        for i in range(len(batch)):
            one = batch.slice(i, 1)
            numbers = lambda name: np.frombuffer(one.column(name)[0].as_buffer(), np.int32)  # noqa: E731, B023
            if own != one.column("words")[0].as_py():
                own, at, given = one.column("words")[0].as_py(), *(one.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("at", "ids"))
                order = np.argsort(given)
                ids, ranks = given[order], np.empty(len(at), np.int64)
                ranks[at[order]] = np.arange(len(at))
                del at, given
            starts, counts = numbers("starts"), numbers("counts")
            cells = np.repeat(np.arange(len(starts) - 1, dtype=np.int64), np.diff(starts)) << 32 | ranks[numbers("terms")]
            order = np.argsort(cells)
            lists = [_listed(pa.array(x)) for x in (starts, ids[cells[order] & 0xFFFFFFFF], counts[order])]
            del cells, order, counts
            yield pa.RecordBatch.from_arrays([one.column("words"), one.column("docs"), *lists], ["words", "docs", "starts", "terms", "counts"])
            del lists
            _give_back()


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            one = batch.slice(i, 1)
            starts = one.column("starts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.append(0, np.cumsum(one.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)))
            docs = one.column("docs").flatten()
            own = [docs.field(k) for k in range(docs.type.num_fields)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(before[starts[1:]] - before[starts[:-1]]), pa.array(np.diff(starts))], ["row", *[name for name, _ in FACTS], "n_words", "n_distinct"])


def _with_terms(words: DataFrame, buckets: int) -> DataFrame:
    words = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word")) - 1
    return words.withColumn("term", F.call_function("shiftleft", F.col("bucket").cast("long"), F.lit(32)) + rank).drop("bucket")


def document_term_matrix(docs: DataFrame, row: Column, text_col: str = "text", shard_bytes: int = SHARD_BYTES, most_words: int = VOCABULARY_WORDS, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The dictionary (word, term, n_docs, n), and the matrix: shards (words, docs, starts, terms, counts), whose k-th
    document has the terms from starts[k] up to starts[k + 1]; words names the task's vocabulary. row: what a document
    carries along."""
    texts = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kind = texts.schema["row"].dataType.simpleString()
    local = written(texts.mapInArrow(_shards(shard_bytes, most_words), LOCAL.format(row=kind) + LISTED), "audit-shards", long_rows=True)
    listed = local.where("listed")
    counted = listed.select(F.explode(F.arrays_zip("vocabulary", "n_docs", "n")).alias("w")).select(F.col("w.vocabulary").alias("word"), "w.n_docs", "w.n")
    words = _with_terms(counted, buckets).groupBy("word", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    used = listed.select("words", "first", F.posexplode("vocabulary").alias("at", "word")).select("words", (F.col("first") + F.col("at")).alias("at"), "word")
    # both lists grow by one entry a row, so they run alike
    ids = _with_terms(used, buckets).groupBy("words").agg(F.collect_list("at").alias("at"), F.collect_list("term").alias("ids"))
    coded = local.where("not listed").select("words", "docs", "starts", "terms", "counts").join(ids, "words", "left")
    coded = coded.withColumn("at", F.coalesce("at", F.array().cast("array<int>"))).withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))
    return words, coded.mapInArrow(_globally, SHARD.format(row=kind))


def row_statistics(matrix: DataFrame) -> DataFrame:
    """(row, n_chars, n_capitals, n_symbols, digest, n_words, n_distinct): a row for each document."""
    kind = matrix.schema["docs"].dataType.elementType["row"].dataType.simpleString()
    facts = "n_chars long, n_capitals long, n_symbols long, digest binary, n_words long, n_distinct long"
    return matrix.select("docs", "starts", "counts").mapInArrow(_statistics, f"row {kind}, {facts}")


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, failed, good, toxic): failed has the letters of the filters that the row fails."""
    _, matrix = document_term_matrix(docs, F.struct(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")), text_col)
    rows = written(row_statistics(matrix).select("row.id", "row.part", "n_chars", "n_capitals", "n_symbols", "digest", "n_words", "n_distinct"), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"))
    flags = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first, "digest").join(flags, F.col("id") == F.col("label_id"), "left")
    fails = [
        F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"), 100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_chars"),
        F.col("n_symbols") > 0, F.coalesce(F.col("id") > F.col("first"), F.lit(False)),
    ]
    failed = F.concat(*[F.when(f, letter).otherwise("") for letter, f in zip(FILTERS, fails)])
    return rows.select("id", "part", failed.alias("failed"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def interactions(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of (part, failed,
    good, toxic)."""
    counts = failed.groupBy("part", "failed").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    orders = F.explode(F.array(*[F.lit("".join(order)) for order in permutations(filters)]))
    each = counts.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    each = each.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))).withColumn("earlier", F.substring("filter_order", F.lit(1), F.col("step") - 1))
    bad = F.col("failed")
    fails, gone = F.contains(bad, F.col("filter")), F.call_function("translate", bad, F.col("earlier"), F.lit("")) != bad
    total = lambda when, of="n": F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")
    out = each.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"), total(bad == F.col("filter")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    return interactions(failures(docs, labels, id_col, text_col, part_col))
