"""N-gram Jaccard join: size-aware, heavy and light.

Sets of word shingles are joined exactly at Jaccard >= ``pct`` percent.  Two
sets with sizes a <= b that link share at least ceil(pct * b / 100) shingles.

* Light sets (small) enumerate their subsets of those fixed sizes; two light
  sets that link have a subset in common.
* Heavy sets scan inverted lists.  A set is listed under the shingles that it
  cannot miss all of: the first (size - required overlap + 1) in a global order
  that puts shingles met often in the corpus last, the most frequent at the end.
* The boundary is the size at which enumerating costs more than scanning, from
  the sizes and the repeat counts of the whole corpus.  Light sets that can
  link to heavy ones are listed too, and pairs that lists bring together must
share enough of their listed shingles.

Equal sets are joined as one.  A short list gives all its pairs; a long one
first gives the pairs with its most listed member of about the same size, and then
only pairs of members that these have not already brought together, so a group
of near copies costs its size and not its square, and no link that joins two
groups is missed.  Candidates are distinct and are checked on the whole texts.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_bounded
from .components import components
from .store import written
from .textops import mix64, shingle_sets
from .workers import ship

#: Shingles counted at a time in a task, and the count there that is reported.
COUNTED_AT_ONCE = 4_000_000
REPORTED_COUNT = 3
#: Total count from which a shingle goes last in the order, and most of those.
OFTEN = 4
MOST_OFTEN = 1_000_000
#: Postings that a listing task holds at a time.
LISTED_AT_ONCE = 2_000_000
#: Members of a list that are paired at once, and postings in a list bucket.
SHORT_LIST = 24
BUCKET_POSTINGS = 100_000
#: Stands for as many shared shingles as any pair needs.
SURE = 1 << 40
#: Members of a long list that are compared at a time.
LIST_PART = 1024
#: Largest size whose subsets are ever enumerated.
LARGEST_LIGHT = 16
#: Sets that are checked with texts sent to every executor (ids only).
SENT_IDS = 500_000


def _set_id(s: np.ndarray) -> int:
    both = np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s + np.uint64(len(s))))], dtype=np.uint64)
    both = mix64(both)
    return int((both[:1] * np.uint64(31) + both[1:]).view(np.int64)[0])


def required(size: int, pct: int) -> int:
    """Shingles that two sets share at least if the larger has this size."""
    return -(-pct * size // 100)


def subset_sizes(size: int, pct: int, largest: int) -> list[int]:
    """Sizes of the subsets that a light set enumerates: what it must share
    with each size of light partner that is not smaller."""
    return sorted({required(b, pct) for b in range(size, min(largest, 100 * size // pct) + 1)})


def boundary(sizes: dict[int, int], repeats: float, pct: int) -> int:
    """The largest light size that costs least: enumerated subsets below it,
    postings above it, each read as often as shingles repeat on average."""
    def enumerated(s: int, x: int) -> int:
        return sum(math.comb(s, c) for c in subset_sizes(s, pct, x) if c <= s)

    def cost(x: int) -> float:
        light = sum(n * enumerated(s, x) for s, n in sizes.items() if s <= x)
        return light + sum(n * (s - required(s, pct) + 1) * (1 + repeats)
                           for s, n in sizes.items() if s > x or 100 * s >= pct * (x + 1))
    return min(range(LARGEST_LIGHT + 1), key=lambda x: (cost(x), x))


def _scan(k: int):
    """Per text its size and set id; and shingles that many sets of a stretch hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n_waiting, seen = [], 0, set()

        def often():
            token, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (np.zeros(0, np.uint64),) * 2
            hit = n >= REPORTED_COUNT
            token, n = token[hit].view(np.int64), n[hit].astype(np.int64)
            none = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays([none.cast(doc_type), none, none, none, pa.array(token), pa.array(n)],
                                              names=names)
        names = ["doc", "version", "n_shingles", "set_id", "token", "count"]
        doc_type = pa.int64()
        for batch in batches:
            doc_type = batch.column(0).type
            n, ids = [], []
            for s in shingle_sets(batch.column(2), k):
                n.append(len(s))
                ids.append(_set_id(s) if len(s) else None)
                if len(s) and ids[-1] not in seen:
                    seen.add(ids[-1])
                    waiting.append(s)
                    n_waiting += len(s)
                if n_waiting > COUNTED_AT_ONCE:
                    yield often()
                    waiting, n_waiting, seen = [], 0, set()
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                                              pa.array(ids, pa.int64()), none, none], names=names)
        yield often()
    return run


def _subset_keys(s: np.ndarray, sizes: list[int]) -> np.ndarray:
    keys = [np.zeros(0, np.uint64)]
    for c in sizes:
        if c <= len(s):
            picks = np.array(list(itertools.combinations(range(len(s)), c)), dtype=np.int64).reshape(-1, c)
            keys.append(mix64(mix64(s)[picks].sum(axis=1, dtype=np.uint64) + np.uint64(c)))
    return np.concatenate(keys)


def _list(k: int, pct: int, light: int, often: tuple[np.ndarray, np.ndarray], buckets: int):
    """Postings (token, set id, size), packed per list bucket.  Those of shingles
    known to be met often go to buckets of their own, dealt by token and set,
    as their lists are long.  Subset postings carry a negative size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        n_held = 0

        def packed():
            token = np.concatenate([t for t, _, _ in held])
            ids = np.repeat(np.array([i for _, i, _ in held], np.int64), [len(t) for t, _, _ in held])
            size = np.repeat(np.array([z for _, _, z in held], np.int32), [len(t) for t, _, _ in held])
            late = (size > 0) & (_levels(token, often) > 0)
            spread = np.where(late, mix64(token) ^ ids.view(np.uint64), token)
            bucket = (mix64(spread) % np.uint64(buckets)).astype(np.int32) + np.where(late, buckets, 0).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            token, ids, size, bucket = token[order].view(np.int64), ids[order], size[order], bucket[order]
            at = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
            spans = [(a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist()) if b > a]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
                 pa.array([token[a:b].tobytes() + ids[a:b].tobytes() + size[a:b].tobytes() for a, b in spans], pa.binary())],
                names=["bucket", "packed"])
        for batch in batches:
            for s in shingle_sets(batch.column(2), k):
                if not len(s) or (i := _set_id(s)) in seen:
                    continue
                seen.add(i)
                n = len(s)
                if n <= light:
                    held.append((_subset_keys(s, subset_sizes(n, pct, light)), i, -n))
                    n_held += len(held[-1][0])
                if n > light or 100 * n >= pct * (light + 1):
                    order = np.argsort(_levels(s, often), kind="stable")
                    first = s[order[:n - required(n, pct) + 1]]
                    held.append((first, i, n))
                    n_held += len(first)
                if n_held > LISTED_AT_ONCE:
                    yield packed()
                    held, n_held = [], 0
        if n_held:
            yield packed()
    return run


def _levels(tokens: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The level (log2 of the count) of tokens met often, 0 for the others."""
    ordered, level = often
    if not len(ordered):
        return np.zeros(len(tokens), dtype=np.uint8)
    at = np.minimum(np.searchsorted(ordered, tokens), len(ordered) - 1)
    return np.where(ordered[at] == tokens, level[at], 0).astype(np.uint8)


def _fits(a: np.ndarray, b: np.ndarray, pct: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= pct * np.maximum(a, b)


def _scan_lists(pct: int, light: int, buckets: int):
    """All pairs of short lists; the postings of long ones, and of the buckets
    of shingles met often."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        token, ids, size = [], [], []
        for raw in pdf["packed"]:
            n = len(raw) // 20
            token.append(np.frombuffer(raw, np.int64, n))
            ids.append(np.frombuffer(raw, np.int64, n, 8 * n))
            size.append(np.frombuffer(raw, np.int32, n, 16 * n))
        token, ids, size = np.concatenate(token), np.concatenate(ids), np.concatenate(size)
        order = np.lexsort((ids, token))
        token, ids, size = token[order], ids[order], size[order]
        again = np.zeros(len(token), dtype=bool)
        again[1:] = (token[1:] == token[:-1]) & (ids[1:] == ids[:-1])
        token, ids, size = token[~again], ids[~again], size[~again].astype(np.int64)
        begin = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        length = np.diff(np.r_[begin, len(token)])
        length = np.repeat(length, length)
        long = (length > SHORT_LIST) | bool(pdf["bucket"].iloc[0] >= buckets)
        found = [np.zeros((0, 5), np.int64)]
        for d in range(1, min(SHORT_LIST, len(token))):
            i = np.flatnonzero((token[:-d] == token[d:]) & ~long[:-d])
            if not len(i):
                break
            j = i + d
            ok = _fits(abs(size[i]), abs(size[j]), pct) & ((size[i] < 0) | (size[i] > light) | (size[j] > light))
            i, j = i[ok], j[ok]
            found.append(np.stack([ids[i], ids[j], abs(size[i]), abs(size[j]), np.where(size[i] < 0, SURE, 1)], axis=1))
        pairs = np.concatenate(found)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        head = np.flatnonzero(np.r_[True, (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)][:len(pairs)])
        shared = np.add.reduceat(pairs[:, 4], head) if len(head) else np.zeros(0, np.int64)
        pairs = pairs[head]
        n, m = len(pairs), int(long.sum())
        return pd.DataFrame({
            "a": np.r_[pairs[:, 0], ids[long]], "b": np.r_[pairs[:, 1], np.zeros(m, np.int64)],
            "token": np.r_[np.zeros(n, np.int64), token[long]],
            "size": np.r_[pairs[:, 2], abs(size[long])].astype(np.int32),
            "other": np.r_[pairs[:, 3], np.zeros(m, np.int64)].astype(np.int32),
            "shared": np.r_[shared, np.zeros(m, np.int64)]})
    return run


def _enough_shared(met: DataFrame, in_long: DataFrame, pct: int) -> DataFrame:
    """Pairs of short lists that share enough of their listed shingles.

    Of two sets, the one whose list ends first in the order has all its common
    listed shingles listed by the other as well; the rest of its list is missing
    from the other, and a linked pair misses few.  Shingles in long lists are
    not paired there, so they all count as shared."""
    pairs = met.where("shared > 0").groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.min("size").alias("za"), F.min("other").alias("zb"))
    for side in "ab":
        pairs = pairs.join(in_long.select(F.col("set_id").alias(side), F.col("n").alias(f"l{side}")), side, "left")
    overlap = F.ceil(pct * (F.col("za") + F.col("zb")) / F.lit(100 + pct))
    listed = {z: F.col(z) - F.ceil(pct * F.col(z) / F.lit(100)) + 1 for z in ("za", "zb")}
    needed = F.least(*[listed[z] - (F.col(z) - overlap) for z in ("za", "zb")])
    unseen = F.least(F.coalesce("la", F.lit(0)), F.coalesce("lb", F.lit(0)))
    return pairs.where(F.col("shared") + unseen >= needed).select("a", "b")


def _pair_apart(pct: int):
    """Of one part of a long list: pairs of members of different groups that
    share enough shingles of long lists, reported under the first one shared."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = pdf["listed"].tolist()
        words, column = np.unique(np.concatenate(lists), return_inverse=True)
        has = np.zeros((len(pdf), len(words)), dtype=np.float32)
        has[np.repeat(np.arange(len(pdf)), [len(x) for x in lists]), column] = 1
        here = int(np.searchsorted(words, pdf["token"].iloc[0]))
        size, ids = pdf["size"].to_numpy(np.int64), pdf["set_id"].to_numpy()
        group, side = pdf["component"].to_numpy(), pdf["side"].to_numpy()
        listed = size - -(-pct * size // 100) + 1
        out = [np.zeros((0, 2), np.int64)]
        one = np.flatnonzero(side == pdf["lo"].iloc[0])
        two = np.flatnonzero(side == pdf["hi"].iloc[0])
        for start in range(0, len(one), 256):
            x = one[start:start + 256]
            shared = has[x] @ has[two].T
            za, zb = size[x][:, None], size[two][None, :]
            overlap = -(-pct * (za + zb) // (100 + pct))
            needed = np.minimum(listed[x][:, None] - za + overlap, listed[two][None, :] - zb + overlap)
            hit = (shared >= needed) & (group[x][:, None] != group[two][None, :]) & _fits(za, zb, pct)
            if pdf["lo"].iloc[0] == pdf["hi"].iloc[0]:
                hit &= ids[x][:, None] < ids[two][None, :]
            i, j = np.nonzero(hit)
            for c in range(0, len(i), 4096):
                p, q = x[i[c:c + 4096]], two[j[c:c + 4096]]
                first = np.argmax(has[p] * has[q], axis=1) == here
                pair = np.sort(np.stack([ids[p[first]], ids[q[first]]], axis=1), axis=1)
                out.append(pair)
        pairs = np.concatenate(out)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
    return run


def _apart(grouped: DataFrame, mixed: DataFrame, long: DataFrame, pct: int) -> DataFrame:
    """Candidates among members of long lists that are still in different groups.

    A pair that shares a shingle of a short list was settled there (checked, or
    shown to share too few); any other must share enough in long lists alone.
    A list is compared in parts of LIST_PART members, so no task holds one whole
    and no pair becomes a row unless it shares enough."""
    of_set = written(long.groupBy("set_id").agg(F.sort_array(F.collect_list("token")).alias("listed")), "join-listed")
    parts = F.ceil(F.col("n") / LIST_PART).cast("int")
    apart = (grouped.join(mixed, "token").withColumn("parts", parts).join(of_set, "set_id")
             .withColumn("side", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("token", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side",
                     "set_id", "size", "component", "listed"))
    return apart.groupBy("token", "lo", "hi").applyInPandas(_pair_apart(pct), "a long, b long").distinct()


def _check(k: int, pct: int):
    """Rows (a, b, text_a, text_b) whose sets link, by hashes that the search has
    not used: two shingles that it took for one do not link texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, np.ndarray] = {}

        def sets(ids: pa.Array, texts: pa.Array) -> None:
            ids = ids.to_pylist()
            new = list({i: p for p, i in enumerate(ids) if i not in of}.items())
            for (i, _), s in zip(new, shingle_sets(texts.take(pa.array([p for _, p in new], pa.int64())), k, 1)):
                of[i] = s
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                if len(of) > 2000:
                    of.clear()
                sets(batch.column(0), batch.column(2))
                sets(batch.column(1), batch.column(3))
                hit = []
                for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x, y = of[a], of[b]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    hit.append(100 * both >= pct * (len(x) + len(y) - both))
                yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))
    return run


def _linked(pairs: DataFrame, texts_of, k: int, pct: int) -> DataFrame:
    """The pairs (a, b) of set ids that link, checked on whole texts."""
    pairs = written(pairs, "join-candidates")
    texts = texts_of(pairs)
    both = (pairs.join(texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))
    return written(both.mapInArrow(_check(k, pct), "a long, b long"), "join-links")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     pct: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` (distinct ``k``-word
    shingles of the whole text; the whole sequence if it has fewer words) and
    ``component_id`` (smallest id reachable by links, itself included).

    Words are runs of anything but space and 0x09-0x0D, A-Z lower-cased.  Null
    and empty texts and texts without words have an empty set and link with
    nothing.  Rows with a null id link with nothing and have a null component.
    Repeated rows are one document; rows with equal ids and different texts
    each join their own set and share the id.  Ids must be integers.  Other
    columns are ignored.  An empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(text_col)).alias("version"),
                       F.col(text_col).alias("text"))
    seen = written(rows.mapInArrow(_scan(k), "doc long, version long, n_shingles long, set_id long, token long, count long"),
                   "join-sets")
    sets = seen.where("n_shingles is not null").select("doc", "version", "n_shingles", "set_id")
    classes = written(sets.where("set_id is not null and doc is not null").groupBy("set_id").agg(
        F.min(F.struct("doc", "version", "n_shingles")).alias("first")).select("set_id", "first.*"), "join-classes")

    # shingles met often: as many as fit MOST_OFTEN, the most frequent ones
    counts = written(seen.where("count is not null").groupBy("token").agg(F.sum("count").alias("count")), "join-counts")
    levels = {r["level"]: (r["n"], r["total"]) for r in counts.groupBy(F.floor(F.log2("count")).cast("int").alias("level"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total")).collect()}
    level = int(math.log2(OFTEN))
    while sum(n for v, (n, _) in levels.items() if v >= level) > MOST_OFTEN:
        level += 1
    often = counts.where(F.col("count") >= 2 ** level).select(
        "token", F.floor(F.log2("count")).cast("int").alias("level")).toPandas()
    token = often["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    often = spark.sparkContext.broadcast((token[order], often["level"].to_numpy(np.uint8)[order]))

    # sizes below the largest light one by number, the others as their postings
    small = {r["n_shingles"]: r["n"] for r in classes.where(F.col("n_shingles") <= 2 * LARGEST_LIGHT)
             .groupBy("n_shingles").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_repeated = sum(n for n, _ in levels.values())
    light = boundary(small, sum(t for _, t in levels.values()) / n_repeated if n_repeated else 1.0, pct)
    n_postings = classes.agg(F.sum(F.floor(F.col("n_shingles") * (100 - pct) / 100) + 1)).first()[0] or 0
    buckets = max(1024, n_postings // BUCKET_POSTINGS)

    def listing(batches):
        return _list(k, pct, light, often.value, buckets)(batches)
    listed = rows.where("doc is not null").mapInArrow(listing, "bucket int, packed binary")
    met = written(listed.groupBy("bucket").applyInPandas(
        _scan_lists(pct, light, buckets), "a long, b long, token long, size int, other int, shared long"), "join-lists")
    long = written(met.where("shared = 0").select("token", F.col("a").alias("set_id"), "size").distinct(), "join-long-lists")

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
        firsts = written(classes.join(ids, "set_id", "left_semi").select("set_id", "doc", "version"), "join-ids")
        n = firsts.count()
        if n <= SENT_IDS:
            firsts = F.broadcast(firsts)
        texts = written(rows.join(firsts, ["doc", "version"]).select("set_id", "text"), "join-texts")
        # repeated rows hold one text several times; without any no text is shuffled here
        return texts.dropDuplicates(["set_id"]) if texts.count() > n else texts

    # long lists: every member with the one of about its size that stands in most
    # of them, which of a group of near copies is the one they were made from
    in_long = written(long.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")), "join-long-counts")
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(100.0 / pct)).cast("int")
    banded = written(long.join(in_long, "set_id").withColumn("band", band), "join-long-bands")
    centres = written(banded.groupBy("token", "band").agg(F.max(F.struct("n", "set_id"))["set_id"].alias("centre")),
                      "join-centres")
    stars = (banded.join(centres, ["token", "band"])
             .select(F.least("centre", "set_id").alias("a"), F.greatest("centre", "set_id").alias("b")).where("a <> b"))
    links = _linked(_enough_shared(met, in_long, pct).unionByName(stars).distinct(), texts_of, k, pct)

    # what is left of long lists: members that are still apart
    groups = components(links, "a", "b")
    grouped = written(long.join(groups.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
                      .select("token", "set_id", "size", F.coalesce("component", "set_id").alias("component")),
                      "join-long-groups")
    mixed = written(grouped.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                 F.count(F.lit(1)).alias("n"))
                    .where("lo <> hi").select("token", "n"), "join-mixed-lists")
    if mixed.head(1):
        links = links.unionByName(_linked(_apart(grouped, mixed, long, pct), texts_of, k, pct))
        groups = components(links, "a", "b")

    labelled = (classes.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
                .select("set_id", "doc", F.coalesce("component", "set_id").alias("group")))
    labelled = written(labelled, "join-labels")
    lowest = written(labelled.groupBy("group").agg(F.min("doc").alias("component_id")), "join-lowest")
    of_set = written(labelled.join(lowest, "group").select("set_id", "component_id"), "join-components")
    return (sets.join(of_set, "set_id", "left")
            .select(F.col("doc").alias(id_col), "n_shingles",
                    F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id")))


def one_of_each(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one document of each group of linked ones: the smallest
    id.  Rows that repeat an id count as that document, so one of them stays;
    rows with a null id all stay.  Columns as in ``docs``, whatever their names;
    an empty table gives none.

    The ids that go are the narrow side: while they fit a checked broadcast no
    text is shuffled."""
    found = written(ngram_components(docs, **params), "join-result")
    gone = found.where("doc_id is not null and doc_id <> component_id").select("doc_id").distinct()
    kept = join_bounded(docs, gone, "doc_id", "left_anti")
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").head(1):
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
    return kept
