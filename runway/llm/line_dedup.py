"""Line dedup: sharded cuckoo filters backed by exact reference tables, so that
documents can be inserted and deleted and every step can be taken back."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cuckoo import CuckooFilter
from .store import written
from .workers import ship

BLANKS = " \t\n\x0b\x0c\r"
#: Keys per shard of the filters, and rows per task group that probes one.
SHARD_KEYS = 100_000
PROBE_ROWS = 4_000
#: Tables of postings of an index before they are made one.
MOST_PARTS = 16


def _lines(text: str) -> str:
    return rf"split(coalesce({text}, ''), '\n', -1)"


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, version, pos, k1, k2): one row per line whose key has ``min_chars``
    code points or more.  A key is the line stripped of blanks at both ends
    with A-Z lower-cased; k1 and k2 are two independent 64-bit hashes of it.
    ``version`` is a hash of the text, which tells rows of one id apart."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    d = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("__text")).where("doc is not null")
    d = d.select("doc", F.xxhash64("__text").alias("version"),
                 F.posexplode(F.expr(_lines("__text"))).alias("pos", "__line"))
    d = d.withColumn("__key", F.expr(f"btrim(__line, '{BLANKS}')")).where(F.length("__key") >= min_chars)
    key = F.translate("__key", upper, lower)
    return d.withColumn("__key", key).select(
        "doc", "version", "pos", F.xxhash64("__key").alias("k1"), F.xxhash64(F.lit(7), "__key").alias("k2"))


def references(rows: DataFrame) -> DataFrame:
    """The exact table: per key its number of lines, first and last document.
    A partial aggregate, so a line that every document holds is one row per task."""
    return rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_lines"), F.min("doc").alias("first_doc"),
                                        F.max("doc").alias("last_doc"))


def _shard(n: int) -> Column:
    return F.pmod(F.col("k1"), F.lit(n)).cast("int")


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, filter): a cuckoo filter over the distinct keys of each shard.
    Keys are hashes and distinct, so shards are even whatever the text."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "filter": [CuckooFilter.of(pdf["k1"].to_numpy()).to_bytes()]})
    return (keys.select(_shard(shards).alias("shard"), "k1").groupBy("shard")
            .applyInPandas(build, "shard int, filter binary"))


def probe(rows: DataFrame, filters: DataFrame, shards: int, salts: int) -> DataFrame:
    """The rows whose key a filter may hold (no row of a held key is lost).

    Rows of a shard are dealt over ``salts`` groups by document, so a line that
    a third of all documents hold does not meet in one task; each group gets a
    copy of its shard's filter, whose size is bounded by SHARD_KEYS."""
    def keep(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = [c for c in left.columns if c not in ("shard", "salt")]
        if not len(left) or not len(right):
            return left[names].iloc[:0]
        return left[names][CuckooFilter.from_bytes(right["filter"].iloc[0]).contains(left["k1"].to_numpy())]
    schema = rows.schema
    salt = F.pmod(F.xxhash64("doc", "pos"), F.lit(salts)).cast("int")
    left = rows.select("*", _shard(shards).alias("shard"), salt.alias("salt")).groupBy("shard", "salt")
    right = filters.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")).groupBy("shard", "salt")
    return left.cogroup(right).applyInPandas(keep, schema)


def _shards_for(n_keys: int) -> int:
    return max(64, -(-n_keys // SHARD_KEYS))


@dataclass
class LineIndex:
    """What is known of the lines of a set of documents.

    ``parts`` are the postings, a table for each insertion (documents deleted
    since are left out when they are read), ``refs`` the exact reference table
    over them and ``seen`` the sharded filters over its keys.  An index is never
    changed, a step makes another one; a step reads and counts only the keys of
    the documents it is about."""

    parts: list[DataFrame]
    refs: DataFrame
    shards: int
    seen: DataFrame | None = None

    @classmethod
    def of(cls, docs: DataFrame, **params) -> LineIndex:
        ship(docs.sparkSession)
        rows = written(postings(docs, **params), "line-postings")
        refs = written(references(rows), "line-refs")
        return cls([rows], refs, _shards_for(refs.count()))

    @property
    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts)

    def filters(self) -> DataFrame:
        """The filters over all keys, built when first asked for."""
        if self.seen is None:
            self.seen = written(build_filters(self.refs, self.shards), "line-filters")
        return self.seen

    def _stepped(self, parts: list[DataFrame], refs: DataFrame, seen) -> LineIndex:
        """The index after a step: postings in one table again after MOST_PARTS
        steps, filters dealt over more shards when the keys outgrow them."""
        if len(parts) > MOST_PARTS:
            parts = [written(reduce(DataFrame.unionByName, parts), "line-postings")]
        shards = _shards_for(refs.count())
        if shards > self.shards:
            return LineIndex(parts, refs, shards)
        return LineIndex(parts, refs, self.shards, seen())

    def insert(self, docs: DataFrame, **params) -> LineIndex:
        """The index with more documents.  Only keys that the filters may hold
        are looked up in the exact table; the others are certainly new."""
        new = written(postings(docs, **params), "line-postings")
        batch = written(references(new), "line-refs")
        maybe = written(probe(batch.withColumns({"doc": F.col("k2"), "pos": F.lit(0)}), self.filters(), self.shards, 1)
                        .drop("doc", "pos"), "line-maybe")
        both = (self.refs.join(maybe.select("k1", "k2"), ["k1", "k2"], "left_semi").unionByName(maybe))
        merged = both.groupBy("k1", "k2").agg(F.sum("n_lines").alias("n_lines"), F.min("first_doc").alias("first_doc"),
                                              F.max("last_doc").alias("last_doc"))
        touched = written(merged, "line-merged")
        fresh = batch.join(maybe.select("k1", "k2"), ["k1", "k2"], "left_anti")
        refs = (self.refs.join(touched.select("k1", "k2"), ["k1", "k2"], "left_anti")
                .unionByName(touched).unionByName(fresh))
        added = batch.join(self.refs.select("k1", "k2"), ["k1", "k2"], "left_anti")
        return self._stepped([*self.parts, new], written(refs, "line-refs"), lambda: self._changed(added, delete=False))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without these documents.

        Their lines are subtracted from the counts of the keys they hold.  Keys
        at zero leave the table and the filters; of the others first and last
        holder are found anew among their own postings.  No other key is read."""
        gone = written(ids.select(F.col(id_col).alias("doc")).distinct(), "line-gone")
        lost = written(self.rows.join(gone, "doc", "left_semi").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_lost")),
                       "line-lost")
        left = written(self.refs.join(lost, ["k1", "k2"]).select("k1", "k2", (F.col("n_lines") - F.col("n_lost")).alias("n_lines")),
                       "line-left")
        parts = [p.join(gone, "doc", "left_anti") for p in self.parts]
        still = left.where("n_lines > 0")
        holders = references(reduce(DataFrame.unionByName, parts).join(still.select("k1", "k2"), ["k1", "k2"], "left_semi"))
        held = still.join(holders.drop("n_lines"), ["k1", "k2"]).select(*self.refs.columns)
        refs = self.refs.join(lost.select("k1", "k2"), ["k1", "k2"], "left_anti").unionByName(held)
        return self._stepped(parts, written(refs, "line-refs"),
                             lambda: self._changed(left.where("n_lines = 0"), delete=True))

    def _changed(self, keys: DataFrame, delete: bool) -> DataFrame:
        def change(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            shard = (left if len(left) else right)["shard"].iloc[0]
            keys = right["k1"].to_numpy() if len(right) else np.zeros(0, np.int64)
            held = CuckooFilter.from_bytes(left["filter"].iloc[0]) if len(left) else CuckooFilter.of(keys)
            if delete:
                held.delete(keys)
            elif len(left) and not held.insert(keys):
                # too full: the caller rebuilds this shard from the exact table
                return pd.DataFrame({"shard": [shard], "filter": [None]})
            return pd.DataFrame({"shard": [shard], "filter": [held.to_bytes()]})
        part = keys.select(_shard(self.shards).alias("shard"), "k1").groupBy("shard")
        new = written(self.filters().groupBy("shard").cogroup(part).applyInPandas(change, "shard int, filter binary"),
                      "line-filters")
        full = new.where("filter is null").select("shard")
        if not full.head(1):
            return new
        keys = self.refs.select("k1", "k2").unionByName(keys.select("k1", "k2"))
        again = keys.withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi")
        return written(new.where("filter is not null").unionByName(build_filters(again, self.shards)), "line-filters")

    def repeats(self) -> DataFrame:
        """(doc, version, drop): the places of lines whose key at least two
        documents hold and a smaller document holds first.

        Postings first pass the sharded filters over the repeated keys; what
        passes is checked against the exact table."""
        ship(self.rows.sparkSession)
        twice = written(self.refs.where("first_doc <> last_doc"), "line-repeated")
        n, n_keys = self.rows.count(), twice.count()
        shards = _shards_for(n_keys)
        salts = max(1, -(-n // (shards * PROBE_ROWS)))
        passed = probe(self.rows, written(build_filters(twice, shards), "line-filters"), shards, salts)
        drops = passed.join(twice.select("k1", "k2", "first_doc"), ["k1", "k2"]).where("doc <> first_doc")
        return drops.groupBy("doc", "version").agg(F.collect_list("pos").alias("drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                index: LineIndex | None = None) -> DataFrame:
    """``docs`` with ``__n_lines``, ``__n_dropped`` and ``__kept`` (its other
    lines joined by newlines).

    A key that at least two documents hold loses all its lines except in the
    smallest id holding it (twice in one document is no repeat).  Null and
    empty texts are one empty line.  Rows with a null id hold no keys and keep
    all lines; equal ids are one holder, and each of their rows loses its own
    lines.  Lines shorter than ``min_chars`` always stay.  Texts of any length are
    whole.  Other columns pass through whatever their names, but for these three,
    which are replaced.  An empty table gives an empty table.
    """
    index = index or LineIndex.of(docs, id_col=id_col, text_col=text_col, min_chars=min_chars)
    names = [c for c in docs.columns if c not in ("__n_lines", "__n_dropped", "__kept")]
    # the row in one column, so that no name of it meets a name of this plan
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    d = docs.select(row, F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("version"))
    d = d.join(index.repeats(), ["doc", "version"], "left")
    text = f"row.`{text_col}`"
    d = d.withColumn("lines", F.expr(_lines(text)))
    d = d.withColumn("stay", F.expr("if(drop is null, null, array_except(sequence(0, cardinality(lines) - 1), drop))"))
    return d.select(
        "row.*", F.expr("cast(cardinality(lines) as bigint)").alias("__n_lines"),
        F.expr("if(drop is null, 0L, cast(cardinality(lines) - cardinality(stay) as bigint))").alias("__n_dropped"),
        F.expr(f"if(drop is null, coalesce({text}, ''),"
               r" array_join(transform(stay, i -> lines[i]), '\n'))").alias("__kept"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines; columns as in ``docs``
    (``n_chars`` follows the text).  A document all of whose lines went is left
    out; one that lost nothing stays as it is, null and empty texts too.  Names of
    other columns do not matter; an empty table gives none."""
    d = dedup_lines(docs).where(f"__n_dropped = 0 or length(btrim(__kept, '{BLANKS}')) > 0")
    cols = {"text": F.when(F.col("__n_dropped") > 0, F.col("__kept")).otherwise(F.col("text")),
            "n_chars": F.when(F.col("__n_dropped") > 0, F.length("__kept").cast("long")).otherwise(F.col("n_chars"))}
    return d.select(*[cols.get(c, F.col(c)).alias(c) for c in docs.columns])
