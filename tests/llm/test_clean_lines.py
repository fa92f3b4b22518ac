"""Clean lines that look like furniture, and furniture that stays furniture."""

from runway.llm.quality_rules import keep_good, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN = [
    "The catalog in the hall lists all that the dialog in the blog in question says.",
    "They design up to ten houses a year and spread more seeds than their neighbours do.",
    "I read more than one book last year, and you should log in to see which ones they were.",
    "Before the trial began she had to sign up for a course that took the whole of the summer.",
    "یہ ایک صاف ستھرا پیراگراف ہے جس میں اپنی علامتیں ہیں۔ " * 8,
    "ဒီစာပိုဒ်က သန့်ရှင်းတဲ့ စာပိုဒ်တစ်ခု ဖြစ်ပါတယ်။ " * 9,
    "هذه فقرة نظيفة، وفيها علامات الترقيم الخاصة بها؟ " * 9,
    "นี่คือย่อหน้าที่สะอาด และไม่มีเครื่องหมายวรรคตอนเลย " * 9,
]
BAD = ["Read more", "All rights reserved.", "» Sign up / Log in «", "Click here to subscribe to this!", "READ MORE...",
       "© 2020 Foo. All rights reserved.", "Terms of use  Privacy policy  Contact", "word " * 60,
       "it's a well-known list " * 15 + "ก"]


def test_each_line(spark):
    rows = [(i, t, None, None, 0) for i, t in enumerate([*CLEAN, *BAD])]
    got = {r["doc_id"]: r["n_failed_lines"] for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert [t[:40] for i, t, *_ in rows if got[i] != (i >= len(CLEAN))] == []


def test_clean_documents_stay_whole(spark):
    first = "It was a fine day, and so they all went out to see the hills beyond the town.\n"
    rows = [(i, first + t, None, None, 0) for i, t in enumerate(CLEAN[:4])]
    kept = {r["doc_id"]: r["text"] for r in keep_good(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {i: t for i, t, *_ in rows}


def test_a_filter_does_not_repeat_the_rules(spark):
    """The rules are nested expressions; a filter on their outcome pushed below
    them would state them again, and again in each other."""
    docs = spark.createDataFrame([(1, "a", None, None, 1)], DOCS)
    plain = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    kept = keep_good(docs)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plain.count("monotonically_increasing_id") and kept.count("xxhash64") <= plain.count("xxhash64")
    more = quality_rules(docs).where("kept and n_words > 3")._jdf.queryExecution().executedPlan().toString()
    assert more.count("xxhash64") <= plain.count("xxhash64")
