"""The ten operators and the pipeline against brute force on small tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.oracle_check import compare, duck_connect

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __id string, n_words string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    extra columns whose names the operators use inside."""
    prose = "The cat sat on the mat, and the dog lay on the rug by the fire. " * 3
    texts = [None, "", "   \n\t", "one", prose, prose, prose + "End.", "A line of ten words or more stands here, twice over.\nx",
             "a line of ten words or more stands here, twice over.  \ny", "word " * 60_000, "\n" * 50, "é" * 400, "x | y | z | w"]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 3}", None if t is None else len(t), "a", "b")
            for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id here, but a text of some ten words or more.", None, None, None, None, None),
             (None, None, None, None, None, None, None), (4, "another text under an id that was used before, alone.", "en", "s1", 1, "", "")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_sql_agrees(spark):
    from runway.llm import oracle, queries
    con = duck_connect(SMALL)
    for name, sql in oracle.QUERIES.items():
        assert compare(spark, con, name, queries.QUERIES[name], sql, SMALL)[1] == [], name


def test_empty_tables(spark, empty):
    from runway.llm import (best_fit, html_extract, interleave_shards, license_scan, line_dedup, mixing, ngram_join,
                            quality_classifier, quality_rules, queries, subspace_join)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, raw string")
    pages = spark.createDataFrame([], "page_id long, url string, html string, id string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (subspace_join.subspace_components(vectors), line_dedup.dedup_lines(empty), ngram_join.ngram_components(empty),
                quality_classifier.score_quality(empty, labels), interleave_shards.interleave_shards(empty),
                best_fit.pack(empty, queries.vocabulary_path()), html_extract.extract_pages(pages), mixing.mix_sources(empty),
                quality_rules.quality_rules(empty), license_scan.scan_licenses(empty)):
        assert out.collect() == []


@pytest.mark.parametrize("cell_rows", [4096, 300])
def test_subspace_join_brute_force(spark, monkeypatch, cell_rows):
    from runway.llm import subspace_join
    from runway.llm.subspace_join import subspace_components
    monkeypatch.setattr(subspace_join, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16)).astype(np.float32)
    group = base[:1] + 0.12 * rng.standard_normal((1300, 16)).astype(np.float32)
    x = np.concatenate([base, group, 3 * base[5:9], base[5:9]])
    rows = [(i, v.tolist(), "k") for i, v in enumerate(x)]
    rows += [(9000, None, "k"), (9001, [0.0] * 16, "k"), (9002, [float("nan")] + [1.0] * 15, "k"), (9003, [], "k"),
             (9004, [None] + [1.0] * 15, "k"), (9005, [1.0, 2.0], "k"), (None, x[0].tolist(), "k")]
    got = {r["vec_id"]: tuple(r)[1:] for r in subspace_components(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep string")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    label = np.arange(len(x))
    while not np.array_equal(label, new := np.where(link, label[None, :], len(x)).min(axis=1)):
        label = new
    for i in range(len(x)):
        assert got[i] == (int(link[i].sum()) - 1, int(label[i]), bool(label[i] == i))
    for i in range(9000, 9006):
        assert got[i] == (0, i, True)
    assert got[None] == (0, None, False)


def brute_lines(rows):
    hold = defaultdict(set)
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                hold[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(hold[key(x)]) < 2 or min(hold[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_brute_force(spark, odd):
    from runway.llm.line_dedup import dedup_lines
    got = Counter(tuple(r) for r in dedup_lines(odd).select("doc_id", "__n_lines", "__n_dropped", "__kept").collect())
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_line_index_steps_are_reversible(spark):
    from runway.llm.line_dedup import LineIndex
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    first, second = docs.where("doc_id < 120"), docs.where("doc_id >= 120")
    refs = lambda index: sorted(map(tuple, index.refs.select("k1", "k2", "n_lines", "first_doc", "last_doc").collect()))
    start = LineIndex.of(first)
    more = start.insert(second)
    assert refs(more) == refs(LineIndex.of(docs))
    back = more.delete(second)
    assert refs(back) == refs(start)
    assert back.filters().count() == back.shards or back.filters().count() > 0


def test_cuckoo_filter():
    from runway.llm.cuckoo import CuckooFilter
    keys = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 30_000)
    f = CuckooFilter.from_bytes(CuckooFilter.of(keys[:20_000]).to_bytes())
    assert f.contains(keys[:20_000]).all() and f.contains(keys[20_000:]).mean() < 0.01
    f.delete(keys[:500])
    assert f.contains(keys[500:20_000]).all() and f.contains(keys[:500]).mean() < 0.05


def brute_components(rows, k=5, pct=80):
    sets = {}
    for i, t in rows:
        w = words(ascii_lower(t))
        sets[i] = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b])]
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return {i: (len(sets[i]), label[i]) for i in sets}


def test_ngram_join_brute_force(spark):
    """A group of near copies of which only some link, short sets of every size
    around the light boundary, and a passage that many texts share."""
    from runway.llm.ngram_join import ngram_components
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(vocab, 120))
    passage = " ".join(rng.choice(vocab, 60))
    texts = []
    for e in rng.integers(0, 8, 90):
        t = list(base)
        for p in rng.choice(120, e, replace=False):
            t[p] = f"x{rng.integers(0, 10 ** 6)}"
        texts.append(" ".join(t))
    texts += [passage + " " + " ".join(rng.choice(vocab, n)) for n in rng.integers(2, 200, 60)]
    for n in range(1, 24):
        t = [f"s{n}_{i}" for i in range(n)]
        texts += [" ".join(t), " ".join(t) + " more", " ".join(t[:-1] + ["last"])]
    texts += [" ".join(base), " ".join(base).upper(), "", None]
    rows = list(enumerate(texts))
    got = ngram_components(spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, token string"))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute_components(rows)


def test_ngram_join_odd_rows(spark, odd):
    from runway.llm.ngram_join import ngram_components, one_of_each
    rows = ngram_components(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["component_id"])
    assert by_id[None] == {None} and by_id[5] == {4} and by_id[0] == {0}
    stay = [r["doc_id"] for r in one_of_each(odd).collect()]
    assert stay.count(4) == 1 and 5 not in stay and stay.count(None) == 2


def test_ngram_boundary_follows_cost():
    from runway.llm.ngram_join import boundary
    assert boundary({6: 100, 12: 100}, 3.0, 80) >= 6
    assert boundary({12: 1000}, 0.0, 80) < 12


def test_quality_classifier(spark, odd):
    from runway.llm.queries import op4_quality_classifier
    from runway.llm.quality_classifier import score_quality
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op4_quality_classifier(spark, sf).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in test]) > 0.9
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(13)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    out = score_quality(odd, some).collect()
    assert len(out) == odd.count() and all(r["score"] == 0 for r in out if r["doc_id"] in (0, 1, 2))


def test_interleaved_shards(spark, odd):
    from runway.llm.interleave_shards import interleave_shards
    rows = interleave_shards(odd).collect()
    assert len(rows) == odd.count()
    at = defaultdict(list)
    for r in rows:
        at[r["shard"]].append(r["slot"])
    sizes = [len(at[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in at.values())
    texts = defaultdict(set)
    for r in odd.collect():
        t = (r["text"] or "").encode()
        texts[r["doc_id"]].add((len(t) + 1, zlib.crc32(t)))
    assert all((r["size"], r["text_crc32"]) in texts[r["doc_id"]] for r in rows)
    big = interleave_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    per = Counter((r["source"], r["shard"]) for r in big)
    for source in {r["source"] for r in big}:
        counts = [per[source, s] for s in range(8)]
        assert max(counts) - min(counts) <= 2


def test_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer

    from runway.llm.best_fit import pack
    from runway.llm.queries import vocabulary_path
    whole = Tokenizer.from_file(vocabulary_path())
    marks = spark.createDataFrame([(100, "it's <|endoftext|> don't ÀÉ×÷ 12ab3 ##&& a\x1cb 日本 İ é́")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(marks)
    pieces = pack(docs, vocabulary_path()).collect()
    want = Counter()
    for r in docs.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for p, s in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[s:s + 2048], dtype="<u4").tobytes()
            want[r["doc_id"], p, s, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter(tuple(r)[:5] for r in pieces) == want
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by_sequence) <= -(-sum(r["length"] for r in pieces) // 2048) + 1


def test_best_fit_plan_equals_item_by_item():
    from runway.llm.best_fit import plan_best_fit
    rng = np.random.default_rng(5)
    for _ in range(20):
        counts = Counter(rng.integers(1, 65, 400).tolist())
        used = defaultdict(int)
        for length, rank, n, seq, per, offset in plan_best_fit(counts, 64):
            for i in range(n):
                assert used[seq + i // per] == offset + i % per * length
                used[seq + i // per] += length
        free = []
        for length in sorted(counts.elements(), reverse=True):
            fit = min((f for f in free if f >= length), default=None)
            if fit is None:
                free.append(64 - length)
            else:
                free[free.index(fit)] -= length
        assert sum(used.values()) == sum(k * v for k, v in counts.items()) and max(used.values()) <= 64
        assert len(used) == len(free)


def test_html_extraction(spark):
    from runway.llm.html_extract import extract_pages, main_text
    page = """<html><head><title>T</title><script>var x="</p>"</script></head><body><header>Site name</header>
    <nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies on this site</div><article><h1>A  title &amp; more</h1>
    <p>First <b>bold</b>\n words<br>on two lines.<p>Short.<div class="ad">Buy now</div><form>Name <input></form>
    <section id="comments"><p>Nice article, thanks for it!</p></section></article><aside>More</aside><footer>&copy; x</footer>"""
    assert main_text(page) == "A title & more\n\nFirst bold words on two lines.\n\nShort."
    long = "It is one of the things that they said to us, and it was not what we had thought of it at the time. "
    plain = f"<div><a href=x>Home</a> <a href=y>News</a></div><h2>Heading</h2><p>{long * 3}</p><p>So it was.</p><p>{long * 3}</p>"
    assert main_text(plain) == f"Heading\n\n{(long * 3).strip()}\n\nSo it was.\n\n{(long * 3).strip()}"
    rows = [(1, "u", page, "t"), (2, None, None, "t"), (None, "u", "", "t"), (4, "u", "<p", "t"), (5, "u", "a < b <!-- no end", "t"),
            (1, "u", page, "t"), (6, "u", "<article><p>" + "word " * 200_000, "t"), (7, "u", "<a b='" * 3000, "t")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (2, None, 4)] == ["", "", ""]
    assert next(r["n_chars"] for r in got if r["page_id"] == 6) == 999_999


def test_mixing_targets_and_ties(spark, odd):
    from runway.llm.mixing import mix_sources, mixed_documents
    rows = mix_sources(odd).collect()
    assert len(rows) == odd.count()
    total = sum(len(words(r["text"])) for r in odd.collect())
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
        assert r["taken"] <= 2 * r["size"]
    assert abs(sum(v[0]["target"] for v in by_source.values()) - 1.5 * total) < 1e-6
    for v in by_source.values():
        assert v[0]["source_size"] == sum(r["size"] for r in v) and v[0]["target"] <= 2 * v[0]["source_size"]
        assert abs(sum(r["taken"] for r in v) - v[0]["target"]) <= 1
    again = Counter(map(tuple, mix_sources(odd.repartition(5)).collect()))
    assert again == Counter(map(tuple, rows))
    assert mixed_documents(odd).columns == odd.columns


def brute_base(text):
    w = words(text)
    grams = defaultdict(list)
    for i in range(len(w) - 4):
        grams[tuple(w[i:i + 5])].append(i)
    repeat = len({i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)})
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeat,
            len(w) < 10 or 100 * repeat > 20 * len(w))


def test_quality_rules_brute_force(spark, odd):
    from runway.llm.quality_rules import keep_good, quality_rules
    got = Counter(tuple(r)[:7] for r in quality_rules(odd).drop("cleaned").collect())
    assert got == Counter((r["doc_id"], *brute_base(r["text"])) for r in odd.collect())
    good = "It was a fine day, and so they all went out to see the hills beyond the town.\n"
    bad = "home | news | sport | weather | more\nClick here to subscribe to this!\n" + "a### b### c###\n"
    rows = [(1, good * 1 + "And then they came home again, tired and glad.\n" + "Read more", None, None, 0),
            (2, bad * 2 + "A short line of prose.", None, None, 0)]
    kept = keep_good(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert [r["doc_id"] for r in kept] == [1] and kept[0]["text"].endswith("glad.") and kept[0]["n_chars"] == len(kept[0]["text"])


def test_license_scan(spark, odd):
    from runway.llm.license_scan import EQUIVALENT, NOTICE_MARK, scan_licenses
    from runway.llm.license_texts import NOTICES, TEXTS
    assert EQUIVALENT and all(NOTICE_MARK in text.lower() for _, text in NOTICES)
    mit = dict(TEXTS)["MIT"].replace("sublicense", "sub-licence").replace("MIT License", "MIT Licence\n * Copyright (c) 2001 A. B.")
    rows = [(1, mit.upper()), (2, mit + " Not."), (3, "# Released under the MIT Licence!\nlicence\nx"), (4, None), (None, "")]
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["license"] == "MIT" and got[2]["license"] is None
    assert (got[3]["n_notices"], got[3]["notices"]) == (1, "MIT") and got[4]["digest"] == got[None]["digest"]
    assert scan_licenses(odd).count() == odd.count()


def test_shingles_of_one_text_do_not_reach_the_next():
    from runway.llm.textops import shingle_sets
    column = pa.array(["a b c", None, "d e f g h", "", "x"]).slice(1, 4)
    assert [len(s) for s in shingle_sets(column)] == [0, 1, 0, 1]


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stage = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, stage = stage, function(spark, stage, SMALL).cache()
        assert stage.columns == docs.columns
        if name == "quality_rules":
            for r in before.collect():
                if brute_base(r["text"])[-1]:
                    assert r["doc_id"] not in {x["doc_id"] for x in stage.collect()}
        if name == "line_dedup":
            want = {i: t for (i, _, n, t), _ in brute_lines([(r["doc_id"], r["text"]) for r in before.collect()]).items()
                    if not n or t.strip()}
            assert {r["doc_id"]: r["text"] for r in stage.collect()} == want
        if name == "near_duplicates":
            labels = brute_components([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted(r["doc_id"] for r in stage.collect()) == sorted(i for i, (_, c) in labels.items() if c == i)
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert packed == {r["doc_id"] for r in stage.collect()}


def test_word_table_brute_force(spark):
    """Each bucket's contexts, added up word by word over texts of many tasks."""
    from runway.llm import quality_classifier as q
    from runway.llm.textops import word_hashes
    texts = ["a b a c", None, "", "the cat sat on the mat", "b", "A a é日 b  b\tb\n a"] * 40
    table = q.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7), seed=5)
    places, signs = q.index_vectors(5)
    context, own = np.zeros((q.BUCKETS, q.DIMS)), np.zeros((q.BUCKETS, q.DIMS))
    for b in range(q.BUCKETS):
        for p, s in zip(places[b], signs[b]):
            own[b, p] += s
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        w = [int(h) % q.BUCKETS for h in word_hashes(raw, np.array([0, len(raw)]), lower=False)[0]] if len(raw) else []
        for i in range(len(w)):
            for j in range(max(0, i - q.WINDOW), min(len(w), i + q.WINDOW + 1)):
                if j != i:
                    context[w[i]] += own[w[j]]
    size = np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    assert np.allclose(table, context / size + 0.5 * own / np.sqrt(q.NONZEROS), atol=1e-6)


def test_pooled_features_brute_force():
    from runway.llm import quality_classifier as q
    from runway.llm.textops import word_hashes
    table = np.random.default_rng(0).standard_normal((q.BUCKETS, q.DIMS)).astype(np.float32)
    texts = ["one two two", "", None, "x " * 70_000]
    x, n = q.pool(pa.array(texts), table)
    for row, size, t in zip(x, n, texts):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        v = [table[int(h) % q.BUCKETS].astype(float) for h in word_hashes(raw, np.array([0, len(raw)]), lower=False)[0]] if len(raw) else []
        assert size == len(v)
        if v:
            # squares are summed in single precision: a spread of 0 may come out as its root
            assert np.allclose(row[:q.DIMS], np.mean(v, axis=0), atol=1e-4)
            assert np.allclose(row[q.DIMS:], np.std(v, axis=0), atol=5e-3)


def test_words_of_a_pattern_keep_apart(spark):
    """Two words that a polynomial hash modulo 2^64 takes for one."""
    from tokenizers import Tokenizer

    from runway.llm.best_fit import pack
    from runway.llm.ngram_join import ngram_components
    from runway.llm.queries import vocabulary_path
    one = "a"
    while len(one) < 2048:
        one += one.translate({97: 98, 98: 97})
    two = one.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, one), (2, two), (3, one), (4, f"{one} {two}"), (5, f"{two} {one}")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    whole = Tokenizer.from_file(vocabulary_path())
    for r in pack(docs.withColumn("x", docs.text), vocabulary_path(), capacity=1 << 20).collect():
        text = {1: one, 2: two, 3: one, 4: f"{one} {two}", 5: f"{two} {one}"}[r["doc_id"]]
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        assert (r["length"], r["ids_crc32"]) == (len(ids) // 4, zlib.crc32(ids))


def test_parts_under_one_hash_keep_apart(monkeypatch):
    from tokenizers import Tokenizer

    from runway.llm import best_fit
    from runway.llm.queries import vocabulary_path
    real = best_fit.span_hashes
    monkeypatch.setattr(best_fit, "span_hashes", lambda t, a, b, state=0: np.where(
        (b - a > 8) & (state == 0), np.uint64(6), real(t, a, b, state)))
    encoder = best_fit.PartEncoder(vocabulary_path())
    text = "one two == = three 4 one == international misunderstanding ========= international don't don't-stop-now it's"
    raw = np.frombuffer(text.encode(), np.uint8)
    ids, _ = encoder.encode(raw, np.array([0, len(raw)]))
    assert ids.tolist() == Tokenizer.from_file(vocabulary_path()).encode(text, add_special_tokens=False).ids


def test_hot_ids_and_equal_ranks_are_spread(spark, monkeypatch):
    """A third of the rows have no id, and every row of another table is a source
    of its own: no bucket of the running sums holds a large share."""
    from pyspark.sql import functions as F

    from runway.llm import interleave_shards, mixing, ranks
    largest = []
    real = ranks.written

    def watched(df, name):
        if name == "ranked-rows":
            largest.append(1)
        if name == "bucket-totals":
            groups = [c for c in df.columns if c != "__sum"]
            assert "__bucket" in groups
        return real(df, name)
    monkeypatch.setattr(ranks, "written", watched)
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.expr("repeat('word ', cast(id % 997 as int))").alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    rows = mixing._mix(docs, "doc_id", "text", "source", mixing.WEIGHTS, 150, 2, 17)
    per = rows.groupBy("key", F.floor(ranks.fraction(F.col("place")) * 55)).count().agg(F.max("count")).first()[0]
    assert per < 160 and largest
    single = docs.withColumn("source", F.concat(F.lit("s"), F.monotonically_increasing_id()))
    out = interleave_shards.interleave_shards(single).collect()
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    phase = ranks.fraction(ranks.hash_place(mixing.source_key(F.col("source")), seed=30))
    assert single.groupBy(F.floor(phase * 55)).count().agg(F.max("count")).first()[0] < 160


def test_running_totals_of_equal_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from runway.llm import ranks
    monkeypatch.setattr(ranks, "EQUAL_ROWS", 7)
    rows = spark.range(400).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 250, 0).otherwise(F.col("id") % 90).alias("v"))
    rows = rows.withColumn("place", ranks.hash_place(F.col("v"), seed=1))
    got = ranks.running(rows, ["g"], ranks.fraction(F.col("place")), ["place", "v"], F.col("v") + 1, 400).collect()
    for g in (0, 1):
        mine = sorted((r["place"], r["before"], r["v"]) for r in got if r["g"] == g)
        at = 0
        for _, before, v in mine:
            assert before == at
            at += v + 1
        assert len(mine) == 200 and all(r["total"] == at for r in got if r["g"] == g)


def test_sharding_order_brute_force(spark, odd):
    """Every place recomputed: rows of a source by hash, all rows by (k + phase) / n."""
    import hashlib

    from runway.llm.interleave_shards import interleave_shards

    def place(seed, *values):
        return hashlib.md5(":".join([str(seed), *("null" if v is None else str(v) for v in values)]).encode()).hexdigest()
    docs = [(r["doc_id"], (r["text"] or "").encode(), r["source"]) for r in odd.collect()]
    rows = []
    for d, t, s in docs:
        size, crc = len(t) + 1, zlib.crc32(t)
        rows.append(("1" if s is None else "0" + s, place(29, d, crc, size), d is not None, d or 0, crc, size, d, s))
    of = defaultdict(list)
    for r in sorted(rows):
        of[r[0]].append(r)
    ranked = []
    for key, mine in of.items():
        phase = int(place(30, key)[:8], 16) / 2 ** 32
        ranked += [((k + phase) / len(mine), *r) for k, r in enumerate(mine)]
    ranked.sort()
    n = len(ranked)
    want = Counter()
    for at, r in enumerate(ranked):
        shard = at * 8 // n
        want[r[7], r[6], r[5], shard, at - -(-shard * n // 8), r[8]] += 1
    got = Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["source"]) for r in interleave_shards(odd).collect())
    assert got == want


def test_deletion_reads_only_the_keys_of_deleted_documents(spark):
    from pyspark.sql import functions as F

    from runway.llm.line_dedup import LineIndex
    docs = spark.createDataFrame(
        [(i, f"a line that only number {i} holds\na line that all of them hold\na line that tens hold {i // 10}") for i in range(60)],
        "doc_id long, text string")
    index = LineIndex.of(docs)
    index.filters()
    marked = index.refs.withColumn("n_lines", F.col("n_lines") + 1000)  # would be lost in a rebuild
    seen = LineIndex(index.parts, marked, index.shards, index.seen).delete(docs.where("doc_id in (0, 13)"))
    assert {r["n_lines"] for r in seen.refs.collect()} == {1001, 1010, 1009, 1058}
    assert {r["n_lines"] for r in seen.refs.where("first_doc = 1 and last_doc = 59").collect()} == {1058}
    refs = lambda x: sorted(map(tuple, x.refs.select("k1", "k2", "n_lines", "first_doc", "last_doc").collect()))
    step = index
    for i in range(0, 60, 17):
        step = step.delete(docs.where(F.col("doc_id") == i)).insert(docs.where(F.col("doc_id") == i))
    assert refs(step) == refs(index) and step.rows.count() == index.rows.count()
    assert refs(index.delete(docs)) == [] and index.delete(docs.limit(0)).refs.count() == index.refs.count()


def test_filters_are_dealt_anew_when_keys_outgrow_them(spark, monkeypatch):
    from runway.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    docs = spark.createDataFrame([(i, f"a line that only number {i} holds") for i in range(300)], "doc_id long, text string")
    index = line_dedup.LineIndex.of(docs.where("doc_id < 10"))
    more = index.insert(docs.where("doc_id >= 10"))
    assert index.shards == 64 and more.shards == 150 and more.filters().count() > 64
    again = more.insert(docs.where("doc_id = 7"))
    assert again.refs.where("n_lines = 2").count() == 1


def test_names_inside_do_not_meet_names_outside(spark):
    from runway.llm.line_dedup import dedup_lines
    from runway.llm.mixing import mixed_documents
    from runway.llm.ngram_join import one_of_each
    text = "a line that is long enough and stands in both\nand one more line of text to fill it"
    names = ["doc", "version", "drop", "lines", "stay", "row", "__doc", "__lines", "__times", "times", "copy", "key", "place",
             "passes", "cut", "d", "gone", "component_id", "__n_lines"]
    docs = spark.createDataFrame([(i, text + str(i % 2), "en", "s", 9, *range(len(names))) for i in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} long" for n in names))
    out = dedup_lines(docs)
    assert [c for c in out.columns if c not in ("__n_lines", "__n_dropped", "__kept")] == [c for c in docs.columns if c != "__n_lines"]
    assert out.count() == 6 and out.select("__doc", "times").distinct().first() == (6, 9)
    for f in (mixed_documents, one_of_each):
        assert f(docs).columns == docs.columns and f(docs).select("__times").distinct().first() == (8,)


def test_stages_on_empty_and_odd_rows(spark, odd, empty, tmp_path):
    import corpus_pipeline
    documents = [c for c in ("doc_id", "text", "lang", "source", "n_chars")]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty.select(documents), "").collect() == [], name
    docs = odd.select(documents)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == documents, name
    assert docs.count() > 0
    for sub, table in (("odd", odd), ("none", empty)):
        table.select(documents).write.parquet(str(tmp_path / sub / "documents.parquet"))
        assert (corpus_pipeline.run(spark, str(tmp_path / sub)).count() > 0) == (sub == "odd")


def test_quality_sql_on_lines_that_differ(spark):
    """The SQL states the rule of today: whole words, marks of any script."""
    import duckdb

    from runway.llm import oracle
    from runway.llm.quality_rules import quality_rules
    from tests.llm.test_clean_lines import BAD, CLEAN
    texts = [*CLEAN, *BAD, None, "", "\n".join(CLEAN + BAD), "log in log in", "read more, read more", "x read  more", "blog in login",
             "sign up/sign up sign up now", "Terms of use. Terms of users", "a | b | c | d", "wow!! oh?? no!! it is"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())}))
    names = ["doc_id", "kept", "n_lines", "n_failed_lines", "lost_words", "n_words", "base_failed"]
    sql = con.execute(f"SELECT {', '.join(names)} FROM ({oracle.OP9}) ORDER BY doc_id").fetchall()
    got = quality_rules(docs).select(*names).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == sql


def test_license_scan_brute_force(spark):
    """The same forms by another regex engine, over copies, halves and mixtures."""
    import hashlib
    import random

    import regex

    from runway.llm import license_scan as s
    from runway.llm.license_texts import MORE_NOTICES, NOTICES, whole_texts

    def words_of(c):
        c = " " + regex.sub(r"[^\p{L}\p{N}]+", " ", c) + " "
        for old, new in s.EQUIVALENT:
            c = c.replace(old, new)
        return c.strip(" ")

    def bare(t):
        c = regex.sub(s._LEAD, "", regex.sub(r"\r\n?", "\n", t.lower()))
        c = regex.sub(s._ITEM, r"\1\2", regex.sub(s.STATEMENT, "", regex.sub(s._OWN, "", c)))
        c = " " + words_of(c) + " "
        for old, new in s.VARIES:
            c = regex.sub(old, new, c)
        return c.strip(" ")

    def canonical(t):
        return words_of(regex.sub(s.COPYRIGHT_LINE, "", t.lower()))
    known = whole_texts()
    of = {}
    for name, text in [*known, *NOTICES, *MORE_NOTICES]:
        of.setdefault(bare(text), set()).add(name)
    notice = {}
    for name, text in NOTICES + MORE_NOTICES:
        notice.setdefault(canonical(text), set()).add(name)
    rng = random.Random(3)
    texts = [t for _, t in known[::3]]
    texts += ["Copyright (c) 2011 A. Smith Ltd.\n" + t for _, t in known[1::4]] + [t[:len(t) // 2] for _, t in known[::5]]
    texts += ["/* " + t.replace("\n", "\n * ") + " */" for _, t in known[2::4]] + ["", "no licence here", "licence", "a\nb licensed\n"]
    texts += ["\n".join(rng.choice([t for _, t in NOTICES + MORE_NOTICES] + ["text", "", "# License"]) for _ in range(4)) for _ in range(40)]
    rows = s.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        hits = [min(notice[canonical(x)]) for x in t.split("\n") if canonical(x) in notice]
        assert r["digest"] == hashlib.sha256(canonical(t).encode()).hexdigest()
        assert r["license"] == min(of.get(bare(t), {None}), key=str)
        assert (r["n_notices"], r["notices"]) == (len(hits), ",".join(sorted(set(hits))))


def test_texts_of_the_caller_need_no_marks(spark):
    from runway.llm.license_scan import scan_licenses
    docs = spark.createDataFrame([(1, "Permission granted to all persons."), (2, "other"), (3, "x\nUse it freely!\n"), (4, None)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_licenses(docs, texts=[("X", "Permission granted to all persons.")],
                                                 notices=(("Y", "use it freely"),)).collect()}
    assert got[1]["license"] == "X" and got[2]["license"] is None and (got[3]["n_notices"], got[3]["notices"]) == (1, "Y")
    assert scan_licenses(docs, texts=[], notices=()).where("license is null and n_notices = 0").count() == 4


def test_package_in_an_archive(tmp_path):
    """Shipped as the README says: imported from a zip, with its licence texts, and
    Python operators run beside the shipped file."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "runway"), tmp_path / "src" / "runway", ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(tmp_path / "runway"), "zip", tmp_path / "src")
    script = f"""
import sys
sys.path.insert(0, {archive!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.executor.memory", "900m").config("spark.submit.pyFiles", {archive!r})
         .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
import runway.llm.license_texts as texts
assert ".zip" in texts.__file__ and len(texts.whole_texts()) > 50
from runway.llm.license_scan import scan_licenses
from runway.llm.periodic_runs import periodic_runs
docs = spark.createDataFrame([(1, "a b " * 30), (2, dict(texts.whole_texts())["Apache-2.0"])], "doc_id long, text string")
assert sorted((r.doc_id, len(r.runs)) for r in periodic_runs(docs).collect()) == [(1, 1), (2, 0)]
assert {{r.doc_id: r.license for r in scan_licenses(docs).collect()}} == {{1: None, 2: "Apache-2.0"}}
print("fine")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("fine"), out.stdout[-2000:] + out.stderr[-4000:]


def test_subspace_join_of_a_close_bound(spark):
    """The fineness of the grid has no bound: cells far beyond a byte's numbers."""
    from runway.llm.subspace_join import subspace_components
    rng = np.random.default_rng(2)
    rows = [(10 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((40, 4)).astype(np.float32))]
    base = rng.standard_normal(4)
    rows += [(60 + i, (base * (i + 1) + 1e-5 * rng.standard_normal(4)).astype(np.float32).tolist()) for i in range(4)]
    got = {r["vec_id"]: r["n_links"] for r in subspace_components(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>"), cosine=0.9999999).collect()}
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in rows}
    for i in unit:
        assert got[i] == sum(j != i and unit[i] @ unit[j] >= 0.9999999 for j in unit), i


def test_subspace_join_deals_few_copies(spark, monkeypatch):
    """A vector is sent to the join once per part, not once per block and cell it
    reaches, and every link is found however the vectors are dealt."""
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin
    from runway.llm.subspace_join import subspace_components
    dealt, apply = [], PandasGroupedOpsMixin.applyInPandas
    monkeypatch.setattr(PandasGroupedOpsMixin, "applyInPandas",
                        lambda self, *args: (dealt.append(self._df.count()), apply(self, *args))[1])
    rng = np.random.default_rng(11)
    x = rng.standard_normal((6000, 20)).astype(np.float32)
    for g in range(40):  # groups of near copies, spread over the ids
        x[g::200][1:] = x[g] + 0.15 * rng.standard_normal((29, 20)).astype(np.float32)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in subspace_components(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    assert dealt and max(dealt) <= len(x) * (len(x) ** 0.5 / 32 + 1)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = [np.flatnonzero(u @ v >= 0.95) for v in u]
    label = np.arange(len(x))
    while not np.array_equal(label, new := np.array([label[n].min() for n in near])):
        label = new
    assert sum(map(len, near)) > 2 * len(x)
    assert got == {i: (len(n) - 1, label[i]) for i, n in enumerate(near)}
