"""Licence scans by canonical digest: texts are brought to one form, and their
digests are hash-joined with those of known licences."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import MORE_NOTICES, NOTICES, whole_texts

#: Spellings and phrases that count as equal, applied in this order
#: to lower-case words with one space between them.
EQUIVALENT = (
    ("licenc", "licens"), ("isation", "ization"), ("ising", "izing"), ("ised", "ized"), ("ise ", "ize "),
    ("favour", "favor"), ("labour", "labor"), ("behaviour", "behavior"), ("centre", "center"),
    ("judgement", "judgment"), ("acknowledgement", "acknowledgment"), ("fulfil ", "fulfill "),
    ("whilst", "while"), ("non commercial", "noncommercial"), ("sub licens", "sublicens"),
    ("copyright owner", "copyright holder"), ("https", "http"),
)
#: A line that states a copyright, behind any comment marks; it varies from copy to copy.
COPYRIGHT_LINE = r"(?m)^[ \t/*#;%-]*(copyright|\(c\)|©)[^\n]*$"
#: Built-in notices have this in them (in lower case): while all notices do, other lines are not looked up.
NOTICE_MARK = "licen"
#: Built-in whole texts have one of these in them (in lower case): while all texts do, other documents are not looked up.
TEXT_MARKS = "licen|software"

#: Marks of comments and lists that a line may begin with.
_LEAD = r"(?m)^[ \t]*(?:(?:[/*#;%>|•·-]+|rem|dnl)(?=[ \t\n]|$)[ \t]*)+"
#: The number of a list item, behind the end of a clause.
_ITEM = r"(\A|[.:;,]|\band|\bor)([\s*#/%>|•·-]*)(?<!\S)\(?(?:[0-9]{1,2}|[a-z])[.)](?=\s)"
#: Copyright statements of the licence texts themselves, which may be wrapped anywhere.
_OWN = (r"copyright\s+\(c\)\s+(?:[0-9]{4},?\s+)+free\s+software\s+foundation,\s+inc\.,?"
        r"(?:\s+<https?://fsf\.org/>|\s+(?:51\s+franklin|59\s+temple|675\s+mass)[^.]{1,70}?\susa)?"
        r"|copyright\s+(?:\(c\)\s+)?(?:<year>\s+<name\s+of\s+author>|year\s+name\s+of\s+author"
        r"|\[yyyy\]\s+\[name\s+of\s+copyright\s+owner\])")
#: A copyright statement: a year, (c) or, on a line of its own, a name follows; it
#: ends with the line, the name's sentence or the words a licence begins with.
_SHORT = r"[\s.,](?:inc|ltd|co|corp|llc|jr|[a-z])"
_NAME = rf"(?:[^\n.;:!?]|\.(?=[^\s])|(?<={_SHORT})\.)"
_BEGINS = (r"all rights reserved|permission (?:is hereby|to use)|redistribution and use|this software is provided|"
           r"licensed under|released under|everyone is permitted|this (?:program|library) is free|gnomovision comes|copyright")
_MARKED = r"[ \t]*(?:\(c\)|©|&copy;|[0-9]{4}|[<\[{](?:year|yyyy)[>\]}])"
STATEMENT = (rf"(?m)(?:\bcopyright{_MARKED}|(?<!\S)(?:©|\(c\))[ \t]*[0-9]{{4}}"
             r"|(?<=\A|\n[ \t]{0,9}\n|licen[cs]e[ \t]{0,9}\n)[ \t]*copyright[ \t]+(?:by[ \t]+)?(?!holders?\b|owners?\b|notices?\b|licen|law\b|and\b|or\b|in\b|of\b|to\b|is\b|the\b)"
             rf"(?=\p{{L}}+(?:[ \t,.]+\p{{L}}+){{0,5}}[ \t.]*$)){_NAME}{{0,200}}?(?=[.\s]+(?:{_BEGINS})|[.]?[ \t]*$|(?:[;:!?]|(?<!{_SHORT})\.)(?:\s|$))")
#: Words of a canonical text that vary from copy to copy, and what they become.
VARIES = (
    (r" all rights reserved(?= )", ""),
    (r"(?<= neither the name) (?:of )?(?:\S+ ){1,12}?nor the names of (?:its|his|their|the) contributors(?= )",
     " of the copyright holder nor the names of its contributors"),
    (r" provided by (?:the )?(?:copyright holders?|authors?|regents)(?: and contributors)? as is(?= )",
     " provided by the copyright holders and contributors as is"),
    (r" in no event shall (?:the )?(?:copyright holders?|authors?|regents)(?: (?:and|or) contributors)? be liable(?= )",
     " in no event shall the copyright holder or contributors be liable"),
)


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines; everything but letters and digits is
    one space; equivalent spellings are made equal.  Null is empty."""
    return _words(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, ""))


def bare(text: Column) -> Column:
    """As ``canonical``, but of a line with a copyright only the statement goes;
    comment and list marks and the words of VARIES go too."""
    c = F.regexp_replace(F.regexp_replace(F.lower(text), r"\r\n?", "\n"), _LEAD, "")
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, _OWN, ""), STATEMENT, ""), _ITEM, "$1$2")
    c = F.concat(F.lit(" "), _words(c), F.lit(" "))
    for old, new in VARIES:
        c = F.regexp_replace(c, old, new)
    return F.trim(c)


def _words(c: Column) -> Column:
    c = F.concat(F.lit(" "), F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for old, new in EQUIVALENT:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.trim(c)


def known_digests(spark: SparkSession, texts: Sequence[tuple[str, str]],
                  form: Callable[[Column], Column] = canonical) -> DataFrame:
    """(digest, license) of known texts, one row per digest."""
    rows = spark.createDataFrame(list(texts), "license string, text string")
    return rows.select(F.sha2(form(F.col("text")), 256).alias("digest"), "license").groupBy("digest").agg(
        F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  texts: Sequence[tuple[str, str]] | None = None,
                  notices: tuple[tuple[str, str], ...] = NOTICES + MORE_NOTICES) -> DataFrame:
    """One row per row of ``docs``: id, ``digest`` (SHA-256 of the canonical whole
    text), ``license`` (of the known text whose ``bare`` form the whole text has, else
    null; ``texts`` are ``whole_texts()`` and the notices unless given),
    ``n_notices`` (lines that are a known notice as a whole) and ``notices`` (their
    licences, sorted, each once, joined by commas; empty if none).

    Null and empty texts have the digest of the empty text and no licence.  Null
    ids, repeated rows and very long texts are treated like any row; other
    columns are ignored; an empty table gives none.

    The known texts are a constant of the operator, so their side of the join is
    bounded and broadcast; documents are not shuffled.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    texts = [*whole_texts(), *notices] if texts is None else list(texts)
    text_marks = TEXT_MARKS if all(re.search(TEXT_MARKS, t.lower()) for _, t in texts) else ""
    notice_mark = F.lit(NOTICE_MARK if all(NOTICE_MARK in t.lower() for _, t in notices) else "")
    d = d.withColumns({
        "digest": F.sha2(canonical(F.col("__text")), 256),
        "__digest": F.when(F.lower("__text").rlike(text_marks), F.sha2(bare(F.col("__text")), 256)),
        "__lines": F.when(F.contains(F.lower("__text"), notice_mark), F.transform(
            F.filter(F.split("__text", "\n"), lambda line: F.contains(F.lower(line), notice_mark)),
            lambda line: F.sha2(canonical(line), 256)))})
    # one constant digest -> licence map of a few dozen entries, folded into the plan
    of_notice = {r["digest"]: r["license"] for r in known_digests(spark, notices).collect()}
    pairs = [F.lit(x) for item in sorted(of_notice.items()) for x in item]
    known = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    d = d.withColumn("__found", F.filter(F.transform("__lines", lambda x: F.try_element_at(known, x)),
                                         lambda x: x.isNotNull()))
    of_text = known_digests(spark, texts, bare)
    whole = spark.createDataFrame([tuple(r) for r in of_text.collect()], "__digest string, license string")
    return d.join(F.broadcast(whole), "__digest", "left").select(
        F.col("__id").alias(id_col), "digest", "license",
        F.coalesce(F.size("__found"), F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("__found")), ","), F.lit("")).alias("notices"))
