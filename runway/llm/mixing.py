"""Mixing sources to target weights: hash-random order, distributed prefix
sums of token counts, and a cut at each source's exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from .ranks import fraction, hash_place, running
from .store import written

_WORDS = r"array_remove(split(%s, '[\\x20\\x09-\\x0D]+'), '')"

#: Weights by the rank of a source (code points, null last), repeating.
WEIGHTS = (3, 1, 2)


def source_key(source: Column) -> Column:
    """A key that is never null: sources sort by code point, null last."""
    return F.when(source.isNotNull(), F.concat(F.lit("0"), source)).otherwise(F.lit("1"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   share_pct: int = 150, cap: int = 2) -> DataFrame:
    """(key, size) per source -> with ``target``: ``share_pct`` percent of all
    sizes dealt by weight, none above ``cap`` times its size, the excess
    reshared by weight among the rest until none is above.

    The capped sources are a prefix of the order by size per weight, so the
    final level follows from prefix sums.  The windows hold one narrow row per
    source in one task (which spills): millions of sources, not billions."""
    w = F.element_at(F.array(*map(F.lit, weights)),
                     ((F.row_number().over(Window.orderBy("key")) - 1) % len(weights) + 1).cast("int"))
    d = sizes.select("key", "size", w.cast("long").alias("w"))
    by_level = Window.orderBy((F.col("size") / F.col("w")), "key")
    everything = Window.partitionBy()
    d = d.withColumns({
        "all": F.sum("size").over(everything),
        "capped_ahead": F.coalesce(F.sum("size").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "w_left": F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing))})
    # the level if every source ahead is capped and none from here on is
    d = d.withColumn("level", (F.col("all") * share_pct / F.lit(100.0) - cap * F.col("capped_ahead")) / F.col("w_left"))
    open_ = F.col("level") * F.col("w") < cap * F.col("size")
    d = d.withColumn("final", F.min(F.when(open_, F.struct(F.col("size") / F.col("w"), F.col("key"), F.col("level"))))
                     .over(everything)["level"])
    # no open source at all: every source is at its cap
    capped = F.col("final").isNull() | (F.col("final") * F.col("w") >= cap * F.col("size"))
    return d.select("key", "size", F.when(capped, (cap * F.col("size")).cast("double"))
                    .otherwise(F.col("final") * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                share_pct: int = 150, cap: int = 2, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: id, source, ``size`` (words of the text),
    ``source_size``, ``target`` (of its source) and ``taken``: the words the mix
    takes from it, repeats counted.

    Documents of a source stand in the order of a seeded hash of id and length; whole
    passes over the source come first, then documents in that order up to the
    exact rest of the rounded target, so the last one may be taken in part.
    Only the narrow rows (no text) are written and shuffled.

    A null text has size 0 and is taken 0 times, a null source is a source of
    its own, sorted last; null ids and repeated rows are rows like any other
    (rows with the same id and size are interchangeable).  A source without
    words has target 0.  Other columns are ignored.  An empty table gives none.
    """
    return _mix(docs, id_col, text_col, source_col, weights, share_pct, cap, seed).select(
        F.col("__id").alias(id_col), "size", F.col("total").alias("source_size"), "target", "taken",
        F.col("__source").alias("source"))


def _place(doc_id: Column, text: Column, seed: int) -> Column:
    """A row's place in its source: by its id, and by the length of its text, so
    that rows without an id lie apart as well."""
    return hash_place(doc_id, F.coalesce(F.octet_length(text), F.lit(0)), seed=seed)


def _mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share_pct: int,
         cap: int, seed: int) -> DataFrame:
    """The narrow rows in their order, with what the mix takes of each."""
    size = F.expr(f"cast(cardinality({_WORDS % '__text'}) as bigint)")
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
            .select("__id", "__source", source_key(F.col("__source")).alias("key"), size.alias("size"),
                    _place(F.col("__id"), F.col("__text"), seed).alias("place")))
    rows = written(rows, "mix-rows")
    placed = running(rows, ["key"], fraction(F.col("place")), ["place", "__id", "size"], F.col("size"), rows.count())
    sizes = written(rows.groupBy("key").agg(F.sum("size").alias("size")), "mix-sources")
    return _taken(placed, source_targets(sizes, weights, share_pct, cap).select("key", "target"))


def _taken(placed: DataFrame, targets: DataFrame) -> DataFrame:
    """Words taken of each row.  Targets are one row per source; they are
    dealt to rows by a map from source to target, built once, while they are
    few, and by an ordinary join beyond that."""
    if targets.count() <= 100_000:
        placed = placed.join(F.broadcast(targets), "key")
    else:
        placed = placed.join(targets, "key")
    budget = F.round("target").cast("long")
    full = F.when(F.col("total") > 0, F.floor(budget / F.col("total"))).otherwise(F.lit(0)).cast("long")
    rest = budget - full * F.col("total")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.withColumns({"passes": full, "taken": (full * F.col("size") + part).cast("long")})


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_pct: int = 150, cap: int = 2,
                    seed: int = 17) -> DataFrame:
    """The mix as documents: every document as often as its share of taken
    words says (taken / size, rounded half up), whole; columns as in ``docs``.

    Each source is cut at one place of its order: documents ahead of it come once
    more than those behind, the one at the cut if at least half of it is taken.
    So a source is one row (whole passes, place, id and share at the cut) and
    documents are compared with their source's row: no text is shuffled while
    these rows fit a checked broadcast.

    Documents without words are left out.  Rows with a null id, whose places
    cannot be told apart, come once each; rows of one id, length and source are
    taken alike.  Columns of ``docs`` may have any names besides; an empty table gives none.
    """
    mix = written(_mix(docs, "doc_id", "text", "source", weights, share_pct, cap, seed)
                  .select("key", "place", "__id", "size", "passes", "taken"), "mix-taken")
    # the first row of the order that is not taken once more in whole
    at = F.min(F.when((F.col("size") > 0) & (F.col("taken") < (F.col("passes") + 1) * F.col("size")), F.struct(
        "place", F.col("__id").alias("id"),
        (F.col("taken") / F.col("size") - F.col("passes")).alias("share"))))
    cuts = mix.groupBy("key").agg(F.max("passes").alias("passes"), at.alias("cut"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    rows = rows.withColumns({"key": source_key(F.col("d.source")),
                             "place": _place(F.col("d.doc_id"), F.col("d.text"), seed)})
    own, cut = F.struct("place", F.col("d.doc_id").alias("id")), F.struct("cut.place", "cut.id")
    more = F.when(F.col("cut").isNull() | (own < cut), F.lit(1)).when(own == cut, F.floor(F.col("cut.share") + 0.5)).otherwise(0)
    times = (F.when(F.col("d.doc_id").isNull(), F.lit(1))
             .when(F.col("d.text").rlike(r"[^\x20\x09-\x0D]"), F.col("passes") + more).otherwise(0))
    out = join_bounded(rows, cuts.select("key", "passes", "cut"), "key").withColumn("times", times.cast("int")).where("times > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("d.*")
