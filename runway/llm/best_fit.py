"""Best-fit packing planned on the histogram of piece lengths; pieces take the
planned slots by joining on their rank within their length."""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import fraction, hash_place, running
from .store import written
from .textops import slices, span_hashes, utf8_buffers
from .workers import ship

#: A text with every kind of part, to tell whether a vocabulary cuts words this way.
PROBE = "It's A-1 ab12cd  x_y ##&& <b> don't ÀÉ caf\u00e9 \u65e5\u672c end.\n".encode()
#: Distinct parts of words whose ids a worker remembers before it starts anew.
CACHED_PARTS = 300_000

_BLANK, _LETTER, _DIGIT, _MARK, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<"]] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_parts(text: np.ndarray, bounds: np.ndarray):
    """The vocabulary's own cut of words, over bytes of consecutive texts.

    Runs of letters (ASCII and precomposed Latin-1), single digits and runs of
    ASCII marks are parts of their own, letters lower-cased; a word with any
    other byte, an apostrophe or ``<`` (contractions, special tokens) stays
    whole and as it is.  Returns (bytes, starts, ends, kind, parts before each
    bound)."""
    kind = _KIND[text]
    lead = text == 0xC3
    second = np.zeros_like(lead)
    second[1:] = lead[:-1]
    second &= (text & 0xC0) == 0x80
    fine = second & (text != 0x97) & (text != 0xB7)
    kind[fine] = _LETTER
    kind[:-1][fine[1:]] = _LETTER
    solid = kind != _BLANK
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(text))]
    begin[inner] = solid[inner]
    word = np.cumsum(begin)
    whole = np.zeros(int(word[-1]) + 1 if len(word) else 1, dtype=bool)
    whole[word[kind == _WHOLE]] = True
    stays = whole[word] & solid
    kind[stays] = _WHOLE
    begin[1:] |= solid[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    low = _LOWER[text]
    low[fine & (text < 0x9F)] += 32
    low = np.where(stays, text, low)
    starts = np.flatnonzero(begin)
    last = solid.copy()
    last[:-1] &= begin[1:] | ~solid[1:]
    return low, starts, np.flatnonzero(last) + 1, kind[starts], np.searchsorted(starts, bounds, "left")


def _gathered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each distinct value, number of the value at each place)."""
    number, _ = pd.factorize(hashes)
    seen = np.maximum.accumulate(number)
    first = np.flatnonzero(np.r_[True, seen[1:] > seen[:-1]][:len(number)])
    return first, number


class PartEncoder:
    """Ids of whole texts by one vocabulary file.

    The vocabulary's pre-tokenizer drops white space and cuts words into parts
    that no token crosses, so a text's ids are those of its parts in turn;
    each distinct part is encoded once while remembered, by its bytes.  Hashes
    only gather equal parts of a stretch, by two independent states.

    The cut (``word_parts``) is that of one family of vocabularies: white space
    dropped, ASCII lower-cased, single digits, runs of letters and of marks.  A
    file whose own cut of a probe text differs is refused."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.runs = Tokenizer.from_file(path)
        self.runs.normalizer = None  # letter runs come normalised
        self.runs.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        ids, _ = self.encode(np.frombuffer(PROBE, np.uint8), np.array([0, len(PROBE)]))
        if ids.tolist() != self.whole.encode(PROBE.decode(), add_special_tokens=False).ids:
            raise ValueError(f"{path}: this vocabulary cuts words otherwise than word_parts does")

    def _learn_runs(self, keys: list[bytes], runs: list[bytes], most: int = 500) -> None:
        texts = [b" ".join(runs[i:i + most]).decode("utf-8") for i in range(0, len(runs), most)]
        for i, e in enumerate(self.runs.encode_batch(texts, add_special_tokens=False)):
            part = keys[i * most:(i + 1) * most]
            ids = np.array(e.ids, dtype="<u4").tobytes()
            ends = (np.searchsorted(np.array(e.word_ids), np.arange(len(part)), "right") * 4).tolist()
            begin = 0
            for key, end in zip(part, ends):
                self.known[key] = ids[begin:end]
                begin = end

    def encode(self, text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the texts, ids before each bound)."""
        low, starts, ends, kind, counts = word_parts(text, bounds)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(bounds), np.int64)
        hashes = span_hashes(low, starts, ends) ^ (kind == _WHOLE)
        first, inverse = _gathered(hashes)
        # up to eight bytes a hash is one to one for its length; longer parts are told apart by a second state
        second = 2 * (ends - starts) + (kind == _WHOLE)
        long = np.flatnonzero(ends - starts > 8)
        second[long] = span_hashes(low, starts[long], ends[long], 1).view(np.int64)
        if (second != second[first[inverse]]).any():  # different parts under one hash: gather by both
            _, first, inverse = np.unique(np.stack([hashes.view(np.int64), second]), axis=1, return_index=True, return_inverse=True)
        if len(self.known) > CACHED_PARTS:
            self.known.clear()
        raw, kinds = low.tobytes(), kind[first].tolist()
        keys = [(b"\xff" if k == _WHOLE else b"") + raw[a:b]
                for k, a, b in zip(kinds, starts[first].tolist(), ends[first].tolist())]
        ids = list(map(self.known.get, keys))
        new = [k for k, v in enumerate(ids) if v is None]
        if new:
            at = first[new]
            spans = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            letters = (kind[at] == _LETTER).tolist()
            self._learn_runs([keys[k] for k, x in zip(new, letters) if x],
                             [w for w, x in zip(spans, letters) if x])
            rest = [(keys[k], w) for k, w, x in zip(new, spans, letters) if not x]
            for (key, _), e in zip(rest, self.whole.encode_batch(
                    [w.decode("utf-8") for _, w in rest], add_special_tokens=False)):
                self.known[key] = np.array(e.ids, dtype="<u4").tobytes()
            for k in new:
                ids[k] = self.known[keys[k]]
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(length) - length
        taken = length[inverse]
        before = np.concatenate([[0], np.cumsum(taken)])
        out = flat[np.arange(before[-1]) + np.repeat(begin[inverse] - before[:-1], taken)]
        return out, before[counts]


_encoders: dict[str, PartEncoder] = {}


def part_encoder(path: str) -> PartEncoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = PartEncoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = part_encoder(path)
        for batch in batches:
            data, at = utf8_buffers(batch.column(1))
            rows: list[list] = [[], [], [], [], []]
            for i, j in slices(at, 1 << 20):
                ids, ends = encoder.encode(data[at[i]:at[j]], at[i:j + 1] - at[i])
                raw, ends = ids.tobytes(), (ends * 4).tolist()
                for k in range(j - i):
                    doc = raw[ends[k]:ends[k + 1]] + b"\0\0\0\0"
                    for p, start in enumerate(range(0, len(doc), 4 * capacity)):
                        part = doc[start:start + 4 * capacity]
                        for col, value in zip(rows, (i + k, p, start // 4, len(part) // 4, zlib.crc32(part))):
                            col.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in rows[2:]]],
                names=["id", "piece", "start", "length", "ids_crc32"])
    return run


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of equal lengths.

    Returns runs (length, first rank, number, first sequence, per sequence,
    offset): the pieces of that length with ranks from ``first`` on fill the
    sequences from ``first sequence`` on, ``per sequence`` side by side from
    ``offset``.  Sequences with equal space left are kept as intervals, so the
    work depends on the distinct lengths, not on the number of pieces."""
    free: dict[int, list[tuple[int, int]]] = {}
    levels: list[int] = []
    runs, made = [], 0

    def give_back(left: int, lo: int, hi: int) -> None:
        if left > 0 and hi > lo:
            if left not in free:
                free[left] = []
                bisect.insort(levels, left)
            free[left].append((lo, hi))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            k = bisect.bisect_left(levels, length)
            if k < len(levels):
                left = levels[k]
                lo, hi = free[left].pop()
                if not free[left]:
                    del free[left], levels[k]
            else:
                left, lo = capacity, made
                hi = made + -(-rest // (capacity // length))
                made = hi
            per = left // length
            whole = min(hi - lo, rest // per)
            if whole:
                runs.append((length, rank, whole * per, lo, per, capacity - left))
                give_back(left - per * length, lo, lo + whole)
                rank, rest = rank + whole * per, rest - whole * per
            if rest and lo + whole < hi:  # fewer than a sequence takes
                runs.append((length, rank, rest, lo + whole, rest, capacity - left))
                give_back(left - rest * length, lo + whole, lo + whole + 1)
                rank, rest, whole = rank + rest, 0, whole + 1
            give_back(left, lo + whole, hi)
    return runs


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", seed: int = 5) -> DataFrame:
    """One row per piece: id, ``piece`` (from 0), ``start``, ``length``,
    ``ids_crc32``, ``sequence_id`` and ``offset``.

    A document is the ids of its whole text by the vocabulary file (a path all
    executors have) and an id 0; only documents longer than ``capacity`` are
    cut.  The driver sees one count per length, ``capacity`` numbers at most,
    and plans best-fit decreasing on them; the plan's runs are bounded by the
    distinct lengths and are broadcast.

    Null and empty texts are the id 0 alone.  Null ids and repeated rows are
    packed like any row.  Other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]])
    pieces = written(rows.mapInArrow(_pieces(vocabulary, capacity), schema), "pack-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = spark.createDataFrame(plan_best_fit(counts, capacity),
                                 "r_length long, r_rank long, r_n long, r_seq long, r_per long, r_offset long")
    place = hash_place(F.col("id"), F.col("piece"), F.col("ids_crc32"), seed=seed)
    ranked = running(pieces.withColumn("place", place), ["length"], fraction(F.col("place")),
                     ["place", "id", "piece", "ids_crc32"], F.lit(1), sum(counts.values()))
    within = F.col("before") - F.col("r_rank")
    return (ranked.join(F.broadcast(runs), (F.col("length") == F.col("r_length")) & (F.col("before") >= F.col("r_rank"))
                        & (F.col("before") < F.col("r_rank") + F.col("r_n")))
            .select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
                    (F.col("r_seq") + F.floor(within / F.col("r_per"))).cast("long").alias("sequence_id"),
                    (F.col("r_offset") + within % F.col("r_per") * F.col("length")).cast("long").alias("offset")))
