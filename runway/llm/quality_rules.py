"""Quality rules, line first: every line is judged, failing lines go, and a
document that loses too much of its text goes with them.

All work is built-in expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words, and the characters counted as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Fixed phrases of page furniture (matched as whole words without regard to case,
#: in lines of at most MAX_FURNITURE_CHARS characters).
FURNITURE = (
    "all rights reserved", "accept cookies", "cookie policy", "cookie settings",
    "click here", "enable javascript", "privacy policy", "read more", "sign up",
    "subscribe to", "terms of service", "terms of use", "lorem ipsum", "skip to content",
    "back to top", "log in", "share this",
)
MAX_FURNITURE_CHARS = 200
LONG_LINE = 300
SEPARATORS = "|»›•·"

#: Marks of any script that close or divide sentences, and letters of scripts that go without.
_PUNCTUATION = r"[.,;:!?]|[\\p{P}&&[^\\x00-\\x7F]]"
_UNMARKED = r"[\\x{0E00}-\\x{0EFF}]"
_PHRASES = rf"(?<![\\p{{L}}\\p{{N}}])(?:{'|'.join(FURNITURE)})(?![\\p{{L}}\\p{{N}}])"
_MARK = "[#*$%&|<>]"
_WORDS = r"array_remove(split(%s, '[\\x20\\x09-\\x0D]+'), '')"


def _count(line: str, chars: str) -> str:
    """SQL for the number of characters of ``line`` that are in ``chars``."""
    quoted = chars.replace("'", "''")
    return f"(length({line}) - length(translate({line}, '{quoted}', '')))"


def line_fails(line: str, suspect: str = "true") -> str:
    """SQL condition: the line is not prose.

    * navigation: at least 3 separators ``|``, ``»``, ``›``, ``•`` or ``·``, one for
      every three words or more;
    * punctuation: symbols are more than a tenth of its non-blank characters,
      or doubled ``!!``/``??`` follow more than a fifth of its words (3 at least),
      or LONG_LINE characters or more have no punctuation of any script at all (and
      are not Thai or Lao for the most part, which need none);
    * boilerplate: a short line most of whose letters and digits are FURNITURE's phrases.

    A line without a word passes.  ``suspect`` is a condition on the whole text
    without which the first two kinds cannot occur."""
    n = f"cardinality({_WORDS % line})"
    solid = f"length(translate({line}, '{BLANKS}', ''))"
    seps = _count(line, SEPARATORS)
    doubled = (f"((2 * length({line}) - length(replace({line}, '!!', ''))"
               f" - length(replace({line}, '??', ''))) div 2)")
    phrases = " or ".join(f"contains(lower({line}), '{p}')" for p in FURNITURE)
    letters = r"length(regexp_replace(%s, '[^\\p{L}\\p{N}]', ''))"
    rest = f"regexp_replace(lower({line}), '{_PHRASES}', '')"
    return (f"(({suspect} and (10 * regexp_count({line}, '{_MARK}') > {solid}"
            f" or ({seps} >= 3 and 3 * {seps} >= {n})))"
            f" or ({suspect} and {doubled} >= 3 and 5 * {doubled} > {n})"
            f" or (length({line}) >= {LONG_LINE} and not ({line} rlike '{_PUNCTUATION}')"
            f" and 2 * regexp_count({line}, '{_UNMARKED}') < length({line}))"
            f" or (length({line}) <= {MAX_FURNITURE_CHARS} and ({phrases})"
            f" and 2 * {letters % rest} < {letters % line}))")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = 10, max_repeat_pct: int = 20, max_lost_pct: int = 30,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the measures, ``base_failed``,
    ``kept`` and ``cleaned`` (the text without its failing lines).

    Measures are taken over the whole text: ``n_words``, ``word_chars`` (code
    points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that
    equal an earlier line), ``n_repeat_words`` (words inside a 5-word window
    that occurs twice or more), ``n_lines``, ``n_failed_lines`` and
    ``lost_words`` (words in failing lines).  ``base_failed``: fewer than
    ``min_words`` words, or more than ``max_repeat_pct`` percent repeated.
    ``kept``: not ``base_failed``, and failing lines hold at most
    ``max_lost_pct`` percent of the words.

    A null text counts as empty: no words, base-failed, ``cleaned`` empty.
    Null ids and repeated rows are judged like any row; texts of any length are
    judged whole; other columns are dropped unless named in ``keep``, whatever
    their names; an empty table gives none.
    """
    out = [F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")]
    extra = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep or [])]
    d = docs.select(*out, *extra)
    d = d.withColumns({"__words": F.expr(_WORDS % "__text"),
                       "__lines": F.expr(r"split(__text, '\n', -1)")})
    d = d.withColumns({
        "__n": F.expr("cast(cardinality(__words) as bigint)"),
        "__full": F.expr(f"filter(__lines, l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
        "__suspect": F.expr(
            f"__text rlike '{_MARK}' or " + " or ".join(
                f"contains(__text, '{c}')" for c in ("!!", "??", "»", "›", "•", "·"))),
        "__wh": F.expr("transform(__words, w -> xxhash64(w))")})
    d = d.withColumns({
        "__h": F.expr("if(__n < 5, cast(array() as array<bigint>), transform(sequence(0, cardinality(__wh) - 5),"
                      " i -> xxhash64(__wh[i], __wh[i + 1], __wh[i + 2], __wh[i + 3], __wh[i + 4])))"),
        "__bad": F.expr(f"transform(__lines, l -> {line_fails('l', '__suspect')})")})
    # windows that occur again, in texts that have any: the repeated hashes of
    # the sorted list, then their places - looked up in that list while it is
    # short, else by sorting (hash, place) and comparing neighbours
    d = d.withColumn("__sorted", F.expr(
        "if(cardinality(array_distinct(__h)) = cardinality(__h), null, sort_array(__h))"))
    d = d.withColumn("__again", F.expr(
        "if(__sorted is null, null, array_distinct(transform(filter(sequence(1, cardinality(__sorted) - 1),"
        " k -> __sorted[k - 1] = __sorted[k]), k -> __sorted[k])))"))
    d = d.withColumn("__pairs", F.expr(
        "if(cardinality(__again) > 64, sort_array(transform(__h, (x, i) -> struct(x, i))), null)"))
    d = d.withColumn("__at", F.expr(
        "case when __again is null then null"
        " when __pairs is null then filter(sequence(0, cardinality(__h) - 1), i -> array_contains(__again, __h[i]))"
        " else sort_array(transform(filter(sequence(0, cardinality(__pairs) - 1),"
        " k -> coalesce(get(__pairs, k - 1).x = __pairs[k].x, false)"
        " or coalesce(get(__pairs, k + 1).x = __pairs[k].x, false)), k -> __pairs[k].i)) end"))
    # the row number added as 0 keeps a later filter above this step: pushed down,
    # it would repeat the nested expressions below many times over
    d = d.withColumns({
        "__repeat": F.least(F.lit(0), F.monotonically_increasing_id()) + F.expr(
            "if(__at is null, 0L, aggregate(sequence(0, cardinality(__at) - 1), 0L,"
            " (acc, j) -> acc + least(5, coalesce(get(__at, j + 1) - __at[j], 5))))"),
        "__lost": F.expr(
            "if(array_contains(__bad, true), aggregate(filter(arrays_zip(__lines, __bad), z -> z.__bad), 0L,"
            f" (acc, z) -> acc + cardinality({_WORDS % 'z.__lines'})), 0L)")})
    base: Column = (F.col("__n") < min_words) | (100 * F.col("__repeat") > max_repeat_pct * F.col("__n"))
    return d.select(
        F.col("__id").alias(id_col),
        F.col("__n").alias("n_words"),
        F.expr("cast(length(array_join(__words, '')) as bigint)").alias("word_chars"),
        F.expr(f"cast(regexp_count(__text, '{_MARK}') as bigint)").alias("n_symbols"),
        F.expr("cast(cardinality(__full) - cardinality(array_distinct(__full)) as bigint)").alias("n_dup_lines"),
        F.col("__repeat").alias("n_repeat_words"),
        base.alias("base_failed"),
        (~base & (100 * F.col("__lost") <= max_lost_pct * F.col("__n"))).alias("kept"),
        F.expr("cast(cardinality(__lines) as bigint)").alias("n_lines"),
        F.expr("cast(cardinality(filter(__bad, b -> b)) as bigint)").alias("n_failed_lines"),
        F.col("__lost").alias("lost_words"),
        F.expr("if(array_contains(__bad, true), array_join(transform(filter(arrays_zip(__lines, __bad),"
               " z -> not z.__bad), z -> z.__lines), '\n'), __text)").alias("cleaned"),
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep or [])])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with their failing lines removed; columns
    of ``docs`` as they were, whatever their names (``n_chars`` follows the text).
    Null and empty texts are not kept; null ids and repeated rows are judged like
    any row; an empty table gives none."""
    names = docs.columns
    other = [c for c in names if c not in ("doc_id", "text", "n_chars")]
    judged = quality_rules(docs.select("doc_id", "text", *[F.col(c).alias(f"__o_{c}") for c in other]),
                           keep=[f"__o_{c}" for c in other]).where("kept")
    cols = {"doc_id": F.col("doc_id"), "text": F.col("cleaned"),
            "n_chars": F.length("cleaned").cast("long"), **{c: F.col(f"__o_{c}") for c in other}}
    return judged.select(*[cols[c].alias(c) for c in names])
