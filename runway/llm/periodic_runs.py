"""Periodic runs of words: an enhanced suffix array per document and a
branching-tandem test on its LCP intervals, without tree nodes.

A run of period q ends in one square whose halves differ right behind it: the
suffixes at x and x + q have exactly q words in common.  Such a pair is split by
one LCP interval of depth q.  Every interval is cut at its boundaries (a boundary
of least LCP has a part on either side); each suffix i of the smaller part is
tested by ISA[i + q] and ISA[i - q] lying in the other part.  That is n log n
tests.  Squares so found are rotated to the left while the words stay equal,
which gives the run, and squares of one run (multiples of its period) merge.

Words are numbered exactly (no hashes).  Documents are sorted together in
stretches of about a megabyte: the document's number leads every suffix, so no
match crosses two documents.  A document is worked on in one task and needs
about 8 bytes for each word and doubling of its longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textops import slices, utf8_buffers
from .workers import ship

#: Suffixes that are tested at a time, and rounds of pointer jumps before a plain scan.
TESTED_AT_ONCE = 4_000_000
JUMPS = 40

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(sa, isa, levels) of the suffixes of texts that lie one behind another.

    ``words`` are numbers that differ between texts, ``ends`` the place behind
    the text of each word.  levels[j] numbers the first 2^j words of each suffix;
    only suffixes that still have equals are sorted again."""
    n = len(words)
    sa = np.argsort(words, kind="stable")
    head = np.r_[True, words[sa[1:]] != words[sa[:-1]]]
    isa = np.empty(n, np.int64)
    isa[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, h = [isa.astype(np.int32)], 1
    while True:
        size = np.bincount(isa, minlength=n)
        open_ = np.flatnonzero(size[isa] > 1)
        if not len(open_):
            return sa, isa, levels
        behind = open_ + h
        second = np.where(behind < ends[open_], isa[np.minimum(behind, n - 1)] + 1, 0)
        order = np.lexsort((second, isa[open_]))
        open_, second = open_[order], second[order]
        first = isa[open_]
        group = np.r_[True, first[1:] != first[:-1]]
        at = np.arange(len(open_))
        slot = first + at - np.maximum.accumulate(np.where(group, at, 0))
        fresh = group | np.r_[True, second[1:] != second[:-1]]
        sa[slot] = open_
        isa[open_] = slot[np.maximum.accumulate(np.where(fresh, at, 0))]
        h *= 2
        levels.append(isa.astype(np.int32))


def neighbour_prefixes(sa: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """lcp[k]: words that the suffixes sa[k - 1] and sa[k] share; -1 at both ends."""
    n = len(sa)
    a, b = sa[:-1].copy(), sa[1:].copy()
    end_a, end_b = ends[a], ends[b]
    lcp = np.zeros(n - 1, np.int64) if n else np.zeros(0, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        inside = (a < end_a) & (b < end_b)
        same = inside & (levels[j][np.minimum(a, n - 1)] == levels[j][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << j
        lcp += step
        a += step
        b += step
    return np.r_[-1, lcp, -1]


def _spans(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary with an LCP the nearest one before it that is not
    larger, and the nearest behind it that is smaller."""
    n = len(lcp) - 1
    left, right = np.arange(-1, n), np.arange(1, n + 2)
    for near, wrong in ((left, np.greater), (right, np.greater_equal)):
        todo = np.flatnonzero(lcp[:-1] > 0)
        for _ in range(JUMPS):
            todo = todo[wrong(lcp[near[todo]], lcp[todo])]
            if not len(todo):
                break
            near[todo] = near[near[todo]]
        else:  # long chains of settled boundaries: walk them in order
            at, depth = near.tolist(), lcp.tolist()
            for k in (todo if near is left else todo[::-1]).tolist():
                j, own = at[k], depth[k]
                while wrong(depth[j], own):
                    j = at[j]
                at[k] = j
            near[:] = at
    return left, right


def _squares(sa, isa, lcp, begins, ends, min_times: int) -> tuple[np.ndarray, np.ndarray]:
    """(x, q): the suffixes x and x + q share exactly q words."""
    left, right = _spans(lcp)
    node = np.flatnonzero(lcp[:-1] > 0)
    length = (ends - begins)[sa[node]]
    node = node[min_times * lcp[node] <= length]
    depth = lcp[node]
    l, r = left[node], right[node]
    small_left = node - l <= r - node
    lo, hi = np.where(small_left, l, node), np.where(small_left, node, r)
    other_lo, other_hi = np.where(small_left, node, l), np.where(small_left, r, node)
    size = hi - lo
    xs, qs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cut = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + TESTED_AT_ONCE, TESTED_AT_ONCE), "left")
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        b = b if b < len(size) and b > a else min(b + 1, len(size))
        s = size[a:b]
        if not len(s):
            continue
        of = np.repeat(np.arange(a, b), s)
        i = sa[np.arange(len(of)) - np.repeat(np.cumsum(s) - s, s) + lo[of]]
        for sign in (1, -1):
            j = i + sign * depth[of]
            ok = (j < ends[i]) if sign > 0 else (j >= begins[i])
            place = isa[np.where(ok, j, i)]
            ok &= (place >= other_lo[of]) & (place < other_hi[of])
            xs.append(np.minimum(i, j)[ok])
            qs.append(depth[of][ok])
    return np.concatenate(xs), np.concatenate(qs)


def _rotated(words: np.ndarray, x: int, q: int, begin: int) -> int:
    """How far the square at x can be rotated to the left."""
    step, start = 64, x
    while start > begin:
        low = max(begin, start - step)
        differs = np.flatnonzero(words[low:start] != words[low + q:start + q])
        if len(differs):
            return low + int(differs[-1]) + 1
        start, step = low, step * 2
    return start


def runs_of(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, min_length: int,
            min_times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run with length >= max(min_length,
    min_times * period) in texts one behind another (``words`` differ between
    them; ``begins`` and ``ends`` give each word's text)."""
    if len(words) < 2:
        return []
    sa, isa, levels = suffix_array(words, ends)
    x, q = _squares(sa, isa, neighbour_prefixes(sa, levels, ends), begins, ends, min_times)
    # a run long enough can be rotated so far at least
    need = np.maximum((min_times - 2) * q, min_length - 2 * q)
    for back in range(1, 9):
        at = x - back
        ok = (need < back) | (at >= begins[x])
        ok &= (need < back) | (words[np.where(ok, at, x)] == words[np.where(ok, at + q, x)])
        x, q, need = x[ok], q[ok], need[ok]
    order = np.lexsort((x, q))
    found: dict[int, list[tuple[int, int]]] = {}
    for x0, q0 in zip(x[order].tolist(), q[order].tolist()):
        end = x0 + 2 * q0
        if any(start <= x0 and q0 % period == 0 for start, period in found.get(end, ())):
            continue
        found.setdefault(end, []).append((_rotated(words, x0, q0, int(begins[x0])), q0))
    return sorted((start, end - start, period) for end, of in found.items() for start, period in of
                  if end - start >= max(min_length, min_times * period))


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words of each text (other texts have others), and each
    word's first place and end of its text."""
    n = np.array([len(t) for t in texts], np.int64)
    if not n.sum():
        return (np.zeros(0, np.int64),) * 3
    number: dict[bytes, int] = {}
    word = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    text = np.repeat(np.arange(len(texts)), n)
    ends = np.cumsum(n)
    return text * len(number) + word, (ends - n)[text], ends[text]


def runs_and_rest(texts: list[list[bytes]], min_length: int = 24,
                  min_times: int = 3) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """For each text its runs by (start, period), and its words without those
    that a run holds behind its first period."""
    words, begins, ends = _numbered(texts)
    first = np.cumsum([0] + [len(t) for t in texts])
    of: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(words, begins, ends, min_length, min_times):
        text = int(np.searchsorted(first, start, "right")) - 1
        of[text].append((start - int(first[text]), length, period))
    for text, runs in zip(texts, of):
        runs.sort(key=lambda r: (r[0], r[2]))
        if runs:
            stays = np.ones(len(text), bool)
            for start, length, period in runs:
                stays[start + period:start + length] = False
            text = [w for w, stay in zip(text, stays.tolist()) if stay]
        yield runs, text


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; smallest start, then period, on ties."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _find(min_length: int, min_times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            data, offsets = utf8_buffers(column)
            for i, j in slices(offsets):
                # bytes.split() cuts at 0x20 and 0x09-0x0D
                texts = [data[offsets[k]:offsets[k + 1]].tobytes().split() for k in range(i, j)]
                n, runs, rest = [len(t) for t in texts], [], []
                for found, words in runs_and_rest(texts, min_length, min_times):
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    rest.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(n, pa.int64()), pa.array(runs, _RUNS), pa.array(rest, pa.string())],
                    names=["id", "n_words", "runs", "collapsed"])
    return run


_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
                  min_times: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``runs`` (array of start,
    length, period, by start and period) and ``collapsed``: the words that no run
    holds behind its first period, joined by one space.

    A run is a stretch of words with smallest period q that is at least
    max(min_length, min_times * q) long and that no neighbour extends;
    ``min_times`` is 2 at least.  Words are runs of anything but space and
    0x09-0x0D, compared as they are.  Null and empty texts and texts of blanks
    have no words, no runs and an empty rest.  Rows are independent: null ids and
    repeated rows are rows like any other, other columns are ignored whatever
    their names, an empty table gives none.  Texts of any length are whole.
    """
    if min_times < 2:
        raise ValueError("min_times must be 2 or more")
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_find(min_length, min_times), schema).withColumnRenamed("id", id_col)
