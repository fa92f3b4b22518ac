"""Removal of repeated byte strings by suffix arrays.

Every byte goes that lies in a string of ``match`` bytes which also starts
earlier.  A suffix array of all texts would ship every suffix; two stages bring
together only what can match:

* A string of ``match`` bytes is dealt by its anchor, the ``match // 3`` bytes in
  it with the smallest hash, so equal strings share it.  Neighbouring strings
  with one anchor are one window.  Anchors are counted over all texts; only
  windows whose anchor occurs twice go on.  Each task counts its own repeats
  first, so an anchor that a third of all documents hold is one row per task.
* Windows are cut from the texts, equal ones of a task once (the smallest
  place stays, the others are copies of it), and those of a bucket of anchors are
  one text whose suffix array is built by two-stage sorting: only suffixes
  smaller than their successor are sorted, the others are induced by scanning
  the buckets of first bytes.  Adjacent common prefixes of ``match`` bytes bring
  equal strings together; all but the one with the smallest place are marked.

Anchors in more than HOT windows would make one bucket too large: their windows
go through the same two stages again with the whole string as its own anchor.

Hashes only choose candidates (a collision costs time): bytes decide.  The texts
are shuffled once, into a table bucketed by row, which the later steps join
without an exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed
from .store import written
from .textops import mix64, slices, utf8_buffers
from .workers import ship

#: Bytes of one text that are looked at together.
PIECE = 1 << 20
#: Anchors counted at a time in a task, and per bucket of the whole count.
COUNTED_AT_ONCE = 4_000_000
BUCKET_ANCHORS = 500_000
#: Windows of an anchor beyond which it is dealt by whole strings, and most such anchors.
HOT = 32_768
MOST_HOT = 1_000_000
#: Bytes of windows that a task holds at a time, and per bucket of suffixes.
HELD_BYTES = 48_000_000
BUCKET_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_48 = np.uint64((1 << 48) - 1)
_power: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_power.get(base, ())) < n:
        p = np.full(max(n, 4096), base, np.uint64)
        p[0] = 1
        _power[base] = np.cumprod(p, dtype=np.uint64)
    return _power[base][:n]


def windows(text: np.ndarray, bounds: np.ndarray, match: int, k: int):
    """(text number, start, strings, anchor hash) of the windows of texts that
    lie one behind another between ``bounds``: neighbouring strings of ``match``
    bytes whose first smallest k-byte hash is the same."""
    n = len(text) - match + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(text)), out=sums[1:])
    hashed = mix64((sums[k:] - sums[:-k]) * _powers(pow(_BASE, -1, 1 << 64), len(text) - k + 1))
    least = hashed & ~np.uint64(0xFFFFFFFF) | np.arange(len(hashed), dtype=np.uint64)
    width, wanted = 1, match - k + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wanted > width:
        least = np.minimum(least[:width - wanted], least[wanted - width:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(n + 1, bool)
    inside[n] = False
    cut = np.zeros(n + 1, np.int32)
    inner = bounds[1:-1]
    np.add.at(cut, np.clip(inner - match + 1, 0, n), 1)
    np.add.at(cut, np.clip(inner, 0, n), -1)
    inside[:n] = np.cumsum(cut[:n]) == 0
    begin = inside[:n].copy()
    begin[1:] &= ~inside[:n - 1] | (anchor[1:] != anchor[:-1])
    last = inside[:n] & (~inside[1:] | np.r_[begin[1:], False])
    start, stop = np.flatnonzero(begin), np.flatnonzero(last)
    row = np.searchsorted(bounds, start, "right") - 1
    return row, start - bounds[row], stop - start + 1, hashed[anchor[start]] & _48


def _pieces(data: np.ndarray, offsets: np.ndarray, match: int, k: int):
    """The windows of all texts of a batch, a stretch or a piece of a long text at a time."""
    for i, j in slices(offsets, PIECE):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * PIECE or j > i + 1:
            row, start, count, anchor = windows(data[lo:hi], offsets[i:j + 1] - lo, match, k)
            yield row + i, start, count, anchor
            continue
        for at in range(lo, hi - match + 1, PIECE):
            end = min(at + PIECE + match - 1, hi)
            _, start, count, anchor = windows(data[at:end], np.array([0, end - at]), match, k)
            yield np.full(len(start), i), start + (at - lo), count, anchor


def _within(row, start, count, hashed, spans: list[np.ndarray], texts_of: np.ndarray):
    """Of windows of one string each those that start inside the given spans of their text."""
    stays = np.zeros(len(start), bool)
    for r in np.unique(row).tolist():
        own = row == r
        at = np.searchsorted(spans[r][:, 0], start[own], "right") - 1
        stays[own] = (at >= 0) & (start[own] < spans[r][np.maximum(at, 0), 1])
    return row[stays], start[stays], count[stays], hashed[stays]


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row per bucket.  Values stand byte by byte of their weight, as the high
    bytes are mostly equal and compress away."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order].view(np.uint8).reshape(-1, 8) for c in columns]
    at = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    spans = [(a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist()) if b > a]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
         pa.array([b"".join(c[a:b].T.tobytes() for c in columns) for a, b in spans], pa.binary())],
        names=["bucket", "packed"])


def _unpacked(packed, columns: int) -> list[np.ndarray]:
    parts = [np.frombuffer(p, np.uint8).reshape(columns, 8, -1) for p in packed]
    return [np.concatenate([np.ascontiguousarray(p[c].T).view(np.int64).ravel() for p in parts]) for c in range(columns)]


def _anchors(match: int, k: int, buckets: int, inside: bool):
    """(hash, row, start) of every anchor's window, packed per bucket.  An anchor
    that a task meets twice is one row with the number of its windows (row -1);
    its windows go to buckets of their own, known to be repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, turn = [], 0, 0

        def counted():
            nonlocal turn
            hashed, row, start = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(hashed, kind="stable")
            hashed, row, start = hashed[order].view(np.int64), row[order], start[order]
            first = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]])
            size = np.diff(np.r_[first, len(hashed)])
            again = np.repeat(size > 1, size)
            many = first[size > 1]
            turn += 1
            bucket = np.r_[hashed[~again] % buckets, hashed[many] % buckets,
                           buckets + (row[again] * 31 + turn) % buckets]
            return _packed(bucket, [np.r_[hashed[~again], hashed[many], hashed[again]],
                                    np.r_[row[~again], np.full(len(many), -1), row[again]],
                                    np.r_[start[~again], size[size > 1], start[again]]])
        for batch in batches:
            rows = batch.column(0).to_numpy()
            data, offsets = utf8_buffers(batch.column(1))
            spans = [np.array(s, np.int64).reshape(-1, 2) for s in batch.column(2).to_pylist()] if inside else None
            for row, start, count, hashed in _pieces(data, offsets, match, k):
                if inside:
                    row, start, count, hashed = _within(row, start, count, hashed, spans, offsets)
                held.append((hashed, rows[row], start))
                n_held += len(start)
                if n_held > COUNTED_AT_ONCE:
                    yield counted()
                    held, n_held = [], 0
        if n_held:
            yield counted()
    return run


def _repeats(buckets: int, hot: int):
    """Of a bucket of anchors the (row, start) of windows whose anchor occurs
    twice, and (row -1) the anchors met more than ``hot`` times, with their number."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hashed, row, start = _unpacked(pdf["packed"], 3)
        none = np.zeros(len(row), np.int64)
        if pdf["bucket"].iloc[0] >= buckets:
            return pd.DataFrame({"row": row, "start": start, "anchor": none})
        order = np.argsort(hashed, kind="stable")
        hashed, row, start = hashed[order], row[order], start[order]
        first = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]])
        size = np.diff(np.r_[first, len(hashed)])
        total = np.add.reduceat(np.where(row < 0, start, 1), first)
        stays = np.repeat(total > 1, size) & (row >= 0)
        large = total > hot
        return pd.DataFrame({"row": np.r_[row[stays], np.full(int(large.sum()), -1)],
                             "start": np.r_[start[stays], total[large]],
                             "anchor": np.r_[none[stays], hashed[first[large]]]})
    return run


def joined_spans(row: np.ndarray, start: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of rows with those that overlap or touch made one, by row and start."""
    order = np.lexsort((start, row))
    row, start, until = row[order], start[order], until[order]
    if not len(row):
        return row, start, until
    # places of all rows on one line, far apart from row to row
    group = np.cumsum(np.r_[0, row[1:] != row[:-1]]) * (int(until.max()) + 2)
    reach = np.maximum.accumulate(until + group)
    fresh = np.flatnonzero(np.r_[True, start[1:] + group[1:] > reach[:-1]])
    last = np.r_[fresh[1:], len(row)] - 1
    return row[fresh], start[fresh], reach[last] - group[fresh]


class _Held:
    """Distinct windows with their smallest place (id, version, start)."""

    def __init__(self):
        self.of: dict[bytes, tuple] = {}
        self.bytes = 0
        self.copies: list[tuple[int, int, int]] = []

    def add(self, window: bytes, place: tuple, row: int, strings: int, match: int) -> None:
        known = self.of.get(window)
        if known is None:
            self.bytes += len(window) + 150
        elif known[0] <= place:
            if known[0] < place:
                self.copies.append((row, place[2], place[2] + strings + match - 1))
            elif known[1] != row:  # a repeated row: the same place, its own marks
                self.of.setdefault(window + row.to_bytes(8, "big"), (place, row, strings))
            return
        else:
            at = known[0][2]
            self.copies.append((known[1], at, at + known[2] + match - 1))
        self.of[window] = place, row, strings


def _cut(match: int, k: int, buckets: int, hot, inside: bool):
    """Windows of repeated anchors as (bucket, window, place), equal ones of the
    task once; (row, start, until) of the copies; and with bucket -1 the spans of
    windows of hot anchors."""
    names = ["bucket", "window", "id", "version", "row", "start", "until"]
    kinds = [pa.int32(), pa.binary(), *[pa.int64()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        out: list[tuple] = []

        def rows():
            got = [(int.from_bytes(anchor, "big") % buckets, window, place[0], place[1], row, place[2], place[2] + n)
                   for anchor, window, place, row, n in
                   ((key[:8], key[8:8 + n + match - 1], place, row, n) for key, (place, row, n) in held.of.items())]
            got += [(buckets + (row + at) % buckets, None, 0, 0, row, at, until)
                    for row, at, until in zip(*(x.tolist() for x in joined_spans(*np.array(held.copies, np.int64).reshape(-1, 3).T)))]
            got += out
            held.__init__()
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)], names=names)
        for batch in batches:
            row_of, ids, versions = (batch.column(c).to_numpy() for c in (0, 2, 3))
            wanted = [np.array(s, np.int64) for s in batch.column(4).to_pylist()]
            data, offsets = utf8_buffers(batch.column(1))
            spans = [np.array(s, np.int64).reshape(-1, 2) for s in batch.column(5).to_pylist()] if inside else None
            for row, start, count, hashed in _pieces(data, offsets, match, k):
                if inside:
                    row, start, count, hashed = _within(row, start, count, hashed, spans, offsets)
                stays = np.zeros(len(row), bool)
                for r in np.unique(row).tolist():
                    own = row == r
                    stays[own] = np.isin(start[own], wanted[r])
                late = np.isin(hashed, hot.value)
                for r, s, n, h, is_hot in zip(row[stays].tolist(), start[stays].tolist(), count[stays].tolist(),
                                              hashed[stays].tolist(), late[stays].tolist()):
                    if is_hot:
                        out.append((-1, None, 0, 0, int(row_of[r]), s, s + n))
                        continue
                    at = int(offsets[r]) + s
                    held.add(h.to_bytes(8, "big") + data[at:at + n + match - 1].tobytes(),
                             (int(ids[r]), int(versions[r]), s), int(row_of[r]), n, match)
                if held.bytes + 100 * (len(held.copies) + len(out)) > HELD_BYTES:
                    yield rows()
        if held.of or held.copies or out:
            yield rows()
    return run


def smaller_suffixes(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than its successor (the last is not)."""
    n = len(text)
    differs = np.flatnonzero(np.r_[text[:-1] != text[1:], True])
    at = differs[np.searchsorted(differs, np.arange(n))]
    return (at < n - 1) & (text[at] < text[np.minimum(at + 1, n - 1)])


def _sorted_directly(chosen: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """The chosen suffixes in the order of their first ``depth`` bytes at least;
    ``word`` ranks the eight bytes at each place (0 behind the end)."""
    bits = max(1, int(word.max()).bit_length()) if len(word) else 1
    bits = max(bits, len(chosen).bit_length())
    per = 2 if 3 * bits <= 63 else 1

    def words(of: np.ndarray, d: int) -> np.ndarray:
        key = word[np.minimum(of + d, len(word) - 1)]
        if per == 2:
            key = key << bits | word[np.minimum(of + d + 8, len(word) - 1)]
        return key
    key = words(chosen, 0)
    order = np.argsort(key, kind="stable")
    done, key = chosen[order], key[order]
    head = np.r_[True, key[1:] != key[:-1]]
    d = 8 * per
    while d < depth:
        first = np.flatnonzero(head)
        size = np.diff(np.r_[first, len(done)])
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            break
        group = np.cumsum(head[tied])
        if per == 2:
            key = group << (2 * bits) | words(done[tied], d)
            order = np.argsort(key, kind="stable")
        else:
            key = words(done[tied], d)
            order = np.lexsort((key, group))
        done[tied] = done[tied][order]
        key, group = key[order], group[order]
        head[tied] = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        d += 8 * per
    return done


def suffix_array(text: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Two-stage suffix sorting, right up to ``depth`` bytes: suffixes smaller
    than their successor are sorted, all others induced.

    Of the suffixes with one first byte those larger than their successor come
    first.  Going through the suffixes in order, the one before each (if larger
    than it) is the next of its own bucket."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    direct = _sorted_directly(np.flatnonzero(smaller_suffixes(text)), word, depth)
    byte = text[direct]
    queue: dict[int, list[np.ndarray]] = {int(text[-1]): [np.array([n - 1])]}
    out = []
    for c in np.unique(text).tolist():
        level = np.concatenate(queue.pop(c, [np.zeros(0, np.int64)]))
        own = []
        while len(level):
            own.append(level)
            before = level[level > 0] - 1
            level = before[text[before] == c]
        own.append(direct[np.searchsorted(byte, c, "left"):np.searchsorted(byte, c, "right")])
        own = np.concatenate(own)
        out.append(own)
        before = own[own > 0] - 1
        before = before[text[before] > c]
        order = np.argsort(text[before], kind="stable")
        before = before[order]
        first = text[before]
        at = np.r_[0, np.flatnonzero(np.diff(first)) + 1, len(before)]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b > a:
                queue.setdefault(int(first[a]), []).append(before[a:b])
    return np.concatenate(out)


def eight_byte_ranks(text: np.ndarray) -> np.ndarray:
    """The rank of the eight bytes at each place, and 0 behind the end."""
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(text) + 1, np.uint64)
    for j in range(8):
        word = word << np.uint64(8) | wide[j:j + len(word)]
    return np.unique(word, return_inverse=True)[1].astype(np.int64)


def equal_strings(text: np.ndarray, starts: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, group): the places among ``starts`` (a mask) in suffix order,
    those with ``match`` equal bytes in one group: their adjacent common prefixes."""
    word = eight_byte_ranks(text)
    sa = suffix_array(text, word, match)
    sa = sa[starts[sa]]
    a, b = sa[:-1], sa[1:]
    same = np.arange(len(a))
    for d in [*range(0, match - 8, 8), match - 8] if match >= 8 else [0]:
        same = same[word[a[same] + d] == word[b[same] + d]] if match >= 8 else same[
            [text[x:x + match].tobytes() == text[y:y + match].tobytes() for x, y in zip(a[same], b[same])]]
    fresh = np.ones(len(sa), bool)
    fresh[same + 1] = False
    return sa, np.cumsum(fresh)


def _sorted(match: int, buckets: int):
    """The (row, start, until) that go: of a bucket's strings all but the one of
    the smallest place.  Equal windows of different tasks are sorted once."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] >= buckets:
            return pdf[["row", "start", "until"]]
        pdf = pdf.sort_values(["id", "version", "start"], ignore_index=True)
        code, _ = pd.factorize(pdf["window"])
        _, first = np.unique(code, return_index=True)
        first = first[code]
        place = pdf[["id", "version", "start"]].to_numpy(np.int64)
        copy = (place != place[first]).any(axis=1)
        copies = pdf.loc[copy, ["row", "start"]]
        copies["until"] = copies["start"] + pdf.loc[copy, "window"].str.len()
        pdf = pdf[~copy].reset_index(drop=True)
        size = pdf["window"].str.len().to_numpy(np.int64)
        # windows one behind another, a byte that UTF-8 lacks behind each
        text = np.frombuffer(b"\xff".join(pdf["window"]) + b"\xff", np.uint8)
        first = np.cumsum(size + 1) - size - 1
        window = np.repeat(np.arange(len(pdf)), size + 1)
        inner = np.arange(len(text)) - first[window]
        places, group = equal_strings(text, inner <= size[window] - match, match)
        window = window[places]
        row, at = pdf["row"].to_numpy(np.int64)[window], pdf["start"].to_numpy(np.int64)[window] + inner[places]
        ids, versions = pdf["id"].to_numpy(np.int64)[window], pdf["version"].to_numpy(np.int64)[window]
        order = np.lexsort((at, versions, ids, group))
        row, at, ids, versions, group = (x[order] for x in (row, at, ids, versions, group))
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        of = np.repeat(head, np.diff(np.r_[head, len(group)]))
        later = (at != at[of]) | (ids != ids[of]) | (versions != versions[of])
        row, at = row[later], at[later]
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        begin = np.r_[True, (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1)][:len(row)]
        begin = np.flatnonzero(begin)
        end = np.r_[begin[1:], len(row)] - 1 if len(begin) else begin
        return pd.concat([copies, pd.DataFrame({"row": row[begin], "start": at[begin], "until": at[end] + match})])
    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_bytes, spans, kept): the maximal spans that go and the bytes that stay."""
    for batch in batches:
        data, offsets = utf8_buffers(batch.column(1))
        marks = batch.column(2)
        flat, many = marks.flatten(), marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row, start, until = joined_spans(np.repeat(np.arange(len(many)), many), flat.field(0).to_numpy(), flat.field(1).to_numpy())
        first = np.searchsorted(row, np.arange(len(many) + 1))
        # what stays: the bytes between spans, one behind another
        stays = np.ones(int(offsets[-1] - offsets[0]) + 1, np.int8)
        edge = offsets[row] - offsets[0]
        change = np.zeros(len(stays), np.int8)
        change[edge + start] -= 1
        np.add.at(change, edge + until, 1)
        stays = (stays + np.cumsum(change, dtype=np.int8))[:-1] > 0
        gone = np.bincount(row, until - start, len(many)).astype(np.int64)
        at = np.r_[0, np.cumsum(np.diff(offsets) - gone)]
        text = data[offsets[0]:offsets[-1]][stays]
        spans = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(start, pa.int64()), pa.array(until - start, pa.int64())], names=["start", "length"]))
        kept = pa.Array.from_buffers(pa.large_binary(), len(many), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text.tobytes())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets), pa.int64()), spans, kept.cast(pa.binary())],
                                         names=["id", "n_bytes", "spans", "kept"])


def _marked(texts: DataFrame, n_bytes: int, match: int, k: int, hot: int, inside: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(marks, spans of hot windows) of one round over the texts."""
    sc = texts.sparkSession.sparkContext
    buckets = max(64, 3 * n_bytes // (match - k + 2) // BUCKET_ANCHORS)
    narrow = texts.select("row", "text")
    if inside is not None:
        texts = texts.join(inside.hint("shuffle_hash"), "row")
        narrow = texts.select("row", "text", "spans")
    anchors = narrow.mapInArrow(_anchors(match, k, buckets, inside is not None), "bucket int, packed binary")
    repeats = written(anchors.groupBy("bucket").applyInPandas(_repeats(buckets, hot), "row long, start long, anchor long"),
                      "suffix-repeats")
    often = repeats.where("row < 0").select("anchor", F.col("start").alias("n"))
    bar = hot
    while often.where(F.col("n") > bar).count() > MOST_HOT:
        bar *= 2
    often = np.array([r["anchor"] for r in often.where(F.col("n") > bar).collect()], np.int64).view(np.uint64)
    per_row = repeats.where("row >= 0").groupBy("row").agg(F.collect_list("start").alias("starts"))
    n_windows = repeats.count()
    buckets = max(64, n_windows * 2 * match // BUCKET_BYTES)
    columns = ["row", "text", "id", "version", "starts", *(["spans"] if inside is not None else [])]
    found = (texts.join(per_row.hint("shuffle_hash"), "row").select(*columns)
             .mapInArrow(_cut(match, k, buckets, sc.broadcast(often), inside is not None),
                         "bucket int, window binary, id long, version long, row long, start long, until long"))
    if not len(often):
        hot_spans = None
    else:
        found = written(found, "suffix-windows")
        hot_spans = found.where("bucket < 0").groupBy("row").agg(
            F.sort_array(F.collect_list(F.array("start", "until"))).alias("spans"))
    marks = found.where("bucket >= 0").groupBy("bucket").applyInPandas(_sorted(match, buckets), "row long, start long, until long")
    return written(marks, "suffix-marks"), hot_spans


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = 100,
                 hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``spans`` (array of start,
    length: the maximal stretches of bytes that go) and ``kept`` (the bytes that
    stay).

    Texts are their UTF-8 bytes.  A byte goes if a string of ``match`` bytes over
    it also starts earlier: in a smaller id, or in the same text further ahead.
    Strings are judged on the input, not on what is left, and never cross texts.

    Null and empty texts have no bytes.  Rows of one id and different texts are
    told apart by a hash of the text; repeated rows are one document and each
    keeps the same.  Null ids are one id, the largest.  Ids are integers; other
    columns are ignored whatever their names; an empty table gives none.  Texts of
    any length are whole; one text is worked on in one task, its last step holds
    it in memory.
    """
    spark = docs.sparkSession
    ship(spark)
    if match < 12:
        raise ValueError("match must be 12 or more")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("given"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))
    texts = bucketed(rows.withColumns({"id": F.coalesce("given", F.lit((1 << 63) - 1)), "version": F.xxhash64("text")}),
                     ["row"], "suffix-texts")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    marks, hot_spans = _marked(texts, n_bytes, match, match // 3, hot, None)
    if hot_spans is not None:
        more, _ = _marked(texts, n_bytes, match, match, 1 << 62, written(hot_spans, "suffix-hot"))
        marks = marks.unionByName(more)
    of_row = marks.groupBy("row").agg(F.collect_list(F.struct("start", "until")).alias("marks"))
    whole = texts.join(of_row.hint("shuffle_hash"), "row", "left").select("given", "text", "marks")
    out = whole.mapInArrow(_kept, "id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
