"""Suffix-array dedup, periodic runs and ranked search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD = "doc_id long, text string, row long, id string, version long, runs string, part binary"
LAST = (1 << 63) - 1


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows
    and ids, and extra columns whose names the operators use inside."""
    prose = "The cat sat on the mat, and the dog lay on the rug by the fire. " * 3
    texts = [None, "", "   \n\t", "one", prose, prose, prose + "End.", "tick tock " * 700 + "end", "é日" * 900, "a" * 1500,
             "\x00\x7f zero " + prose]
    rows = [(i, t, i, "a", None, "b", None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[9], (None, prose, None, None, None, None, None), (None, None, None, None, None, None, None),
             (4, "another text under an id that was used before. " + prose, 1, "", 1, "", b"")]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], ODD)


def first_places(docs, match):
    """(id, text hash, text) rows -> (id, bytes, spans, kept) of each, by every string of ``match`` bytes."""
    first = {}
    for d, v, t in sorted(set(docs)):
        for i in range(len(t) - match + 1):
            first.setdefault(t[i:i + match], (d, v, i))
    out = []
    for d, v, t in docs:
        go = bytearray(len(t) + 1)
        for i in range(len(t) - match + 1):
            if first[t[i:i + match]] < (d, v, i):
                go[i:i + match] = b"\1" * match
        at = [i for i in range(len(t) + 1) if go[i] != (go[i - 1] if i else 0)]
        out.append((d, len(t), tuple(zip(at[::2], at[1::2])), bytes(c for c, g in zip(t, go) if not g)))
    return Counter(out)


def removed(docs, **params):
    from runway.llm.suffix_dedup import suffix_dedup
    rows = suffix_dedup(docs, **params).collect()
    return Counter((LAST if r["doc_id"] is None else r["doc_id"], r["n_bytes"],
                    tuple((s["start"], s["start"] + s["length"]) for s in r["spans"]), bytes(r["kept"])) for r in rows)


def bytes_of(docs):
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)), F.xxhash64(F.coalesce("text", F.lit(""))), "text").collect()
    return [(d, v, (t or "").encode()) for d, v, t in rows]


def test_two_stage_suffix_array():
    from runway.llm.suffix_dedup import eight_byte_ranks, suffix_array
    rng = random.Random(2)
    for _ in range(150):
        k = rng.choice([1, 2, 3, 256])
        text = bytes(rng.randrange(k) for _ in range(rng.randint(0, 120)))
        array = np.frombuffer(text, np.uint8)
        assert suffix_array(array, eight_byte_ranks(array), 200).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_strings_share_their_anchor():
    from runway.llm.suffix_dedup import windows
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 123, 160).astype(np.uint8)
    text = np.concatenate([rng.integers(97, 123, 300).astype(np.uint8), passage, rng.integers(97, 123, 200).astype(np.uint8), passage])
    bounds = np.array([0, 40, 40, 500, len(text)])
    row, start, count, anchor = windows(text, bounds, 60, 20)
    of = {}
    for r, s, n, h in zip(row, start, count, anchor):
        for i in range(s, s + n):
            of[int(bounds[r]) + int(i)] = h
    want = [i for r in range(4) for i in range(bounds[r], bounds[r + 1] - 59)]
    assert sorted(of) == want
    same = defaultdict(set)
    for i in want:
        same[text[i:i + 60].tobytes()].add(of[i])
    assert all(len(v) == 1 for v in same.values()) and len(same) < len(want)


@pytest.mark.parametrize("hot, match", [(32_768, 30), (2, 30), (5, 41)])
def test_suffix_dedup_brute_force(spark, hot, match, monkeypatch):
    """Copies, shared passages, overlapping periods, and anchors beyond the hot bound."""
    from runway.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    rng = random.Random(match + hot)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 60))) for _ in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    texts += [texts[i % 7] for i in range(30)] + ["a" * 1500, "ab" * 700 + "x" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert removed(docs, match=match, hot=hot) == first_places(bytes_of(docs), match)


def test_suffix_dedup_odd_rows(spark, odd, empty):
    assert removed(odd) == first_places(bytes_of(odd), 100)
    assert removed(odd.repartition(4), hot=1) == first_places(bytes_of(odd), 100)
    assert not removed(empty)


def test_suffix_dedup_shuffles_texts_once(spark, monkeypatch):
    """The bucketed texts meet the marks without an exchange of their own."""
    from runway.llm.suffix_dedup import suffix_dedup
    plan = suffix_dedup(spark.createDataFrame([(1, "x" * 500)], "doc_id long, text string"))._jdf.queryExecution().toString()
    join = plan[plan.index("== Physical Plan =="):]
    texts = join[join.index("ShuffledHashJoin"):]
    assert "Bucketed: true" in texts.split("Exchange")[0]


def brute_runs(w, least, times):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                out.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_runs_brute_force():
    from runway.llm.periodic_runs import runs_and_rest
    rng = random.Random(7)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(0, 6)):
            k, n = rng.choice([1, 2, 3, 30]), rng.randint(0, 150)
            t = [str(rng.randrange(k)).encode() for _ in range(n)]
            if rng.random() < .6 and n:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
            texts.append(t)
        for least, times in ((24, 3), (1, 2), (6, 4)):
            for t, (runs, rest) in zip(texts, runs_and_rest(texts, least, times)):
                # a stretch counts with its smallest period only
                want = [r for r in brute_runs(t, least, times)
                        if not any(all(t[i] == t[i + q] for i in range(r[0], r[0] + r[1] - q)) for q in range(1, r[2]))]
                assert sorted(runs) == want
                gone = {i for s, n, q in runs for i in range(s + q, s + n)}
                assert rest == [w for i, w in enumerate(t) if i not in gone]


def test_runs_in_long_texts_and_long_chains(monkeypatch):
    from runway.llm import periodic_runs
    rise = [b"%d" % i for i in range(300)]
    steps = [w for n in range(300) for w in rise[:n]]
    for jumps in (40, 1):
        monkeypatch.setattr(periodic_runs, "JUMPS", jumps)
        found = [r for r, _ in periodic_runs.runs_and_rest([[b"a"] * 60_000, rise * 300, steps])]
        assert found == [[(0, 60_000, 1)], [(0, 90_000, 300)], []]


def test_periodic_runs_odd_rows(spark, odd, empty):
    from runway.llm.periodic_runs import RUN, periodic_runs
    rows = periodic_runs(odd).collect()
    want = Counter()
    for r in odd.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        runs = brute_runs(w, 24, 3)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[r["doc_id"], len(w), tuple(runs), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3]) for r in rows) == want
    assert any(r["runs"] for r in rows) and RUN.names == ["start", "length", "period"]
    assert periodic_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(odd, min_times=1)


def test_planted_periods(spark):
    from runway.llm.queries import op12_periodic_runs
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w, h = (r["text"] or "").encode().split(), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w, 24, 3)
        top = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert got[r["doc_id"]] == (
            len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def split_terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k):
    found = [(d, Counter(split_terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, c in found:
            s = 0
            for t in set(split_terms(text)) & set(c):
                m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
            if s:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("part, queries", [(8192, 4096), (7, 3)])
def test_search_brute_force(spark, monkeypatch, part, queries):
    """Few words and equal texts, so that many scores tie around the last place."""
    from runway.llm import lexical_search
    monkeypatch.setattr(lexical_search, "PART_DOCS", part)
    monkeypatch.setattr(lexical_search, "QUERIES_AT_ONCE", queries)
    monkeypatch.setattr(lexical_search, "FIRST_BLOCK", 2)
    rng = random.Random(part)
    words = ["w%d" % i for i in range(12)] + ["Ünï", "x9", "日本"]
    docs = [(i, "-".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    docs += [(200 + i, docs[i % 5][1].upper()) for i in range(60)]
    items = [(i, " ".join(rng.choice(words + ["none"]) for _ in range(rng.randint(0, 6)))) for i in range(12)]
    got = lexical_search.lexical_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"), k=8).collect()
    want = brute_search([(d, t.replace("Ü", "Ü")) for d, t in docs], items, 8)
    assert sorted(map(tuple, got), key=str) == want


def test_search_odd_rows(spark, odd, empty):
    from runway.llm.lexical_search import lexical_search
    items = [(1, "the cat and the dog"), (1, "tick tock"), (2, None), (None, "the mat"), (3, ""), (1, "tick tock"), (4, "not there"),
             (5, "one")]
    asked = spark.createDataFrame([(*x, "r", 1) for x in items], "item_id long, text string, rank string, score int")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = lexical_search(odd, asked).collect()
    assert sorted(map(tuple, got), key=str) == brute_search(docs, items, 50)
    ranks = defaultdict(list)
    for r in got:
        if r["item_id"] != 1:
            ranks[r["item_id"]].append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())
    assert lexical_search(empty, asked).collect() == []
    assert lexical_search(odd, empty.withColumnRenamed("doc_id", "item_id")).collect() == []
