"""Ranked lexical search by NRA (no random access).

One pass over the documents makes an index in parts of bounded size: per part
and term the documents that hold it.  A second pass scores with the statistics of
the whole corpus: in each part every term's list is sorted by impact, and each
query reads its lists from the top, block after block.  A document met so far has
an interval: what was read of it, and that plus the next impact of every list it
was not yet met in.  Reading goes on until no document outside can reach the
last place and the interval of every document that can is a point, so that
membership, ties and scores are those of a full scan.  The score of the last place
is carried from part to part, so later parts stop early.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written
from .textops import utf8_buffers
from .workers import ship

#: A part of the index has at most so many documents, and postings before its last document.
PART_DOCS = 8192
PART_POSTINGS = 1_000_000
#: Queries are taken to the executors in groups of at most so many and so many bytes.
QUERIES_AT_ONCE = 4096
QUERY_BYTES = 16_000_000
#: Postings of each list in the first block; each later block is four times as long.
FIRST_BLOCK = 64

_TERMS = bytearray(b" " * 128) + bytearray(range(128, 256))
for _lo, _hi, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0)):
    for _c in range(_lo, _hi + 1):
        _TERMS[_c] = _c + _shift
_TERMS = bytes(_TERMS)


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_TERMS).split()


def _index(number):
    """Parts of the index, and per task how many documents hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = number.value, np.zeros(len(number.value), np.int64)
        known = of.keys()
        ids: list[int | None] = []
        sizes: list[int] = []
        found: list[int] = []
        times: list[int] = []
        many: list[int] = []
        docs = words = 0

        def row(part, n_docs, n_terms, term=(), df=()):
            n = max(1, len(term))
            fill = lambda v, t: pa.array([v] * n, t)
            return pa.RecordBatch.from_arrays(
                [fill(part, pa.binary()), fill(n_docs, pa.int64()), fill(n_terms, pa.int64()),
                 pa.array(term, pa.int32()) if len(term) else fill(None, pa.int32()),
                 pa.array(df, pa.int64()) if len(term) else fill(None, pa.int64())],
                names=["part", "n_docs", "n_terms", "term", "df"])

        def part():
            nonlocal held, docs, words
            term, tf = np.array(found, np.int32), np.array(times, np.int64)
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), many)
            held += np.bincount(term, minlength=len(held))
            null = np.array([i is None for i in ids], np.int8)
            values = np.array([0 if i is None else i for i in ids], np.int64)
            head = np.array([len(ids), len(term)], np.int64)
            packed = b"".join(a.tobytes() for a in (head, values, np.array(sizes, np.int64), tf, term, doc, null))
            out = row(packed, docs, words)
            for a in (ids, sizes, found, times, many):
                a.clear()
            docs = words = 0
            return out
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                all_terms = terms(data[offsets[i]:offsets[i + 1]].tobytes())
                if not all_terms:
                    continue
                docs += 1
                words += len(all_terms)
                count = Counter(all_terms)
                hits = count.keys() & known
                if hits:
                    ids.append(doc_id)
                    sizes.append(len(all_terms))
                    many.append(len(hits))
                    found.extend([of[t] for t in hits])
                    times.extend([count[t] for t in hits])
                if len(ids) >= PART_DOCS or len(found) >= PART_POSTINGS:
                    yield part()
        yield part()
        some = np.flatnonzero(held)
        if len(some):
            yield row(None, 0, 0, some.astype(np.int32), held[some])
    return run


class _Part:
    """A part of the index: every term's documents by falling impact."""

    def __init__(self, packed: bytes, weight: np.ndarray, n_docs: int, n_terms: int):
        n, m = np.frombuffer(packed, np.int64, 2).tolist()
        at = 16

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(packed, kind, count, at)
            at += out.nbytes
            return out
        self.ids, size, tf = take(np.int64, n), take(np.int64, n), take(np.int64, m)
        term, doc, self.null = take(np.int32, m), take(np.int32, m), take(np.int8, n)
        norm = 50 + (50 * size * n_docs) // n_terms if n else size
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(weight) + 1))


def nra(part: _Part, query: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a part that may be among the ``k`` best: all with a
    score of at least ``floor`` and of the part's ``k``-th best, and above 0."""
    at, end = part.first[query], part.first[query + 1]
    at, end = at[end > at], end[end > at]
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # scores are sums of integers far below 2^53, so doubles hold them exactly
    heads = part.impact[at].astype(np.float64)
    if not len(at) or heads.sum() < max(floor, 1):
        return none
    n = len(part.ids)
    low = np.zeros(n)
    met = np.zeros((len(at), n))
    block = FIRST_BLOCK
    while True:
        size = np.minimum(end - at, block)
        of = np.repeat(np.arange(len(at)), size)
        read = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + at[of]
        doc = part.doc[read]
        low += np.bincount(doc, part.impact[read], n)
        met[of, doc] = 1
        at = at + size
        heads = np.where(at < end, part.impact[np.minimum(at, len(part.impact) - 1)], 0).astype(np.float64)
        bar = max(float(floor), 1.0)
        if np.count_nonzero(low >= bar) > k:
            bar = max(bar, np.partition(low, n - k)[n - k])
        rest = heads.sum()
        high = low + (rest - heads @ met)
        can = high >= bar
        if rest < bar and (high[can] == low[can]).all():
            best = np.flatnonzero(can & (low >= bar))
            return best, low[best].astype(np.int64)
        block *= 4


def _ranked(queries, k: int, weight, n_docs: int, n_terms: int):
    """Per task the ``k`` best documents of every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros((3, 0), np.int64), 1)] * len(queries.value)
        for batch in batches:
            for packed in batch.column(0):
                part = _Part(packed.as_buffer(), weight.value, n_docs, n_terms)
                for q, query in enumerate(queries.value):
                    kept, floor = best[q]
                    doc, score = nra(part, query, k, floor)
                    if len(doc):
                        kept = np.concatenate([kept, np.stack([score, part.null[doc].astype(np.int64), part.ids[doc]])], 1)
                        kept = kept[:, np.lexsort((kept[2], kept[1], -kept[0]))[:k]]
                        best[q] = kept, int(kept[0, -1]) if kept.shape[1] == k else 1
        for q, (kept, _) in enumerate(best):
            if kept.shape[1]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * kept.shape[1], pa.int32()), pa.array(kept[2], mask=kept[1] == 1),
                     pa.array(kept[0])], names=["query", "doc", "score"])
    return run


def _groups(items: DataFrame) -> Iterator[list[tuple]]:
    """The queries (id, distinct terms) in groups that fit an executor."""
    group, size = [], 0
    for item_id, text in items.toLocalIterator():
        own = sorted(set(terms((text or "").encode())))
        group.append((item_id, own))
        size += sum(map(len, own))
        if len(group) >= QUERIES_AT_ONCE or size >= QUERY_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _search(rows: DataFrame, group: list[tuple], k: int, item_col: str, id_col: str, item_type) -> DataFrame:
    spark = rows.sparkSession
    sc = spark.sparkContext
    number = {t: i for i, t in enumerate(sorted({t for _, own in group for t in own}))}
    index = written(rows.mapInArrow(_index(sc.broadcast(number)), "part binary, n_docs long, n_terms long, term int, df long"),
                    "search-index")
    n_docs, n_terms = (x or 0 for x in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    weight = np.zeros(len(number), np.int64)
    for term, df in index.where("term is not null").groupBy("term").agg(F.sum("df")).collect():
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    queries = [np.array([number[t] for t in own if weight[number[t]] > 0], np.int64) for _, own in group]
    found = index.where("part is not null").select("part").mapInArrow(
        _ranked(sc.broadcast(queries), k, sc.broadcast(weight), n_docs, n_terms), "query int, doc long, score long")
    # each task gives k rows a query: the best of some tasks first, then of all
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    some = Window.partitionBy("query", F.col("some")).orderBy(*order)
    found = (found.withColumn("some", F.spark_partition_id() % 64)
             .withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k))
    ranked = (found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
              .where(F.col("rank") <= k))
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(group)],
                                  f"query int, item {item_type.simpleString()}")
    return (ranked.join(F.broadcast(names), "query")
            .select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, document, score): for each row of ``items`` its ``k`` best rows
    of ``docs`` with a score above 0, equal scores by rising id.

    With N the documents that have a term, L all their terms, n a document's
    terms, df the documents that hold a term and tf how often one does: the score
    sums w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the item's distinct
    terms, w = floor(1000 * ln((2N + 2) / (2 df + 1))), m = 50 + ((50 * n * N) div L).

    Null and empty texts have no terms: such documents count nowhere, such items
    get no rows.  Null document ids come last among equal scores; repeated rows of
    ``docs`` are documents of their own, repeated rows of ``items`` one item, and
    rows of ``items`` with one id and several texts are ranked each.  Document ids
    are integers.  Other columns are ignored.  An empty table on either side gives
    none.  Items go to the executors in groups of at most QUERIES_AT_ONCE (and
    QUERY_BYTES of terms); each group is a pass over the documents.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc"), docs[text_col].alias("text"))
    asked = items.select(items[item_col].alias("item"), items[item_text_col].alias("text")).distinct().orderBy("item", "text")
    kind = asked.schema["item"].dataType
    out = None
    for group in _groups(asked):
        part = _search(rows, group, k, item_col, id_col, kind)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"`{item_col}` {kind.simpleString()}, rank int, `{id_col}` long, score long")
    return out
