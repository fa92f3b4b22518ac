"""Block rules on pages whose tags and names do not tell the whole."""

import time

from runway.llm.html_extract import label, main_text, blocks

LONG = ("It is one of the things that they said to us, and it was not what we had thought of it at the time. " * 3).strip()


def test_text_in_plain_divs_beside_teaser_articles():
    cards = "".join(f"<article><h3><a href=/{i}>Teaser {i}</a></h3></article>" for i in range(4))
    assert main_text(f"<div><p>{LONG}</p><p>So it was.</p><p>{LONG}</p></div>{cards}") == f"{LONG}\n\nSo it was.\n\n{LONG}"


def test_density_decides_inside_and_outside_the_article():
    bar = "<div><a href=x>Share on this</a> <a href=y>Share on that</a></div>"
    page = f"<div>Site of the day</div><article><h1>Title</h1><p>{LONG}</p>{bar}<p>So it was.</p><p>{LONG}</p></article><div>{LONG}</div>"
    assert main_text(page) == f"Title\n\n{LONG}\n\nSo it was.\n\n{LONG}\n\n{LONG}"


def test_many_open_blocks_take_linear_time():
    found = list(blocks("<p>short</p>" * 30_000))
    start = time.time()
    assert len(label(found)) == 30_000 and time.time() - start < 5


def test_pages_that_stand_in_a_form():
    body = f"<div>{LONG}</div><div>So it was.</div><div>{LONG}</div>"
    assert main_text(f"<form action=/><nav><a href=x>Home</a></nav>{body}</form>") == f"{LONG}\n\nSo it was.\n\n{LONG}"
    small = "<form><p>Your name and the address of the house you live in, so that we can write to you <input></p></form>"
    assert main_text(f"<div><p>{LONG}</p><p>{LONG}</p></div>{small}") == f"{LONG}\n\n{LONG}"


OTHER = {
    "zh": ["这是一个关于城市历史的长篇文章，作者在文中详细介绍了老城区的建筑、街道和居民的生活方式，并且讨论了未来的发展计划和可能面对的困难。",
           "第二段比较短，但是它仍然属于正文的一部分，不应该被删除。", "第三段又回到了主要的话题上，作者认为保护历史建筑需要政府、企业和居民的共同努力。"],
    "ja": ["この記事では、古い町並みの歴史と、そこに住む人々の暮らしについて詳しく説明しています。将来の計画についても述べます。",
           "二つ目の段落は短いですが、本文の一部です。", "最後の段落では、歴史的な建物を守るために、行政と住民が協力することが大切だと述べています。"],
    "ru": ["Эта статья рассказывает об истории старого города, его улицах и домах, а также о людях, которые живут там уже много лет.",
           "Второй абзац короче.", "В третьем абзаце автор пишет, что сохранить старые здания можно только вместе, силами города и жителей."],
    "ar": ["هذه المقالة تتحدث عن تاريخ المدينة القديمة وشوارعها وبيوتها، وعن الناس الذين يعيشون فيها منذ سنوات طويلة، وعن خطط المستقبل.",
           "الفقرة الثانية أقصر من الأولى.", "وفي الفقرة الثالثة يقول الكاتب إن الحفاظ على المباني القديمة يحتاج إلى عمل مشترك بين المدينة والسكان."],
    "pl": ["Ten artykuł opowiada o historii starego miasta, jego ulicach i domach, oraz o ludziach, którzy mieszkają tam od wielu lat.",
           "Drugi akapit jest krótki.", "W trzecim akapicie autor pisze, że stare budynki można ocalić tylko razem, siłami miasta i mieszkańców."],
}
LINKS = {"zh": "新闻", "ja": "ニュース", "ru": "Новости", "ar": "أخبار", "pl": "Wiadomości"}


def test_scripts_and_languages_without_listed_stop_words():
    for lang, text in OTHER.items():
        menu = "<ul>" + "".join(f"<li><a href=/{i}>{LINKS[lang]} {i}</a></li>" for i in range(8)) + "</ul>"
        page = menu + "<div>" + "".join(f"<p>{t}</p>" for t in text) + "</div>" + menu
        assert main_text(page) == "\n\n".join(text), lang


def test_links_count_as_they_are_read():
    prose = "It is what we said of the house and the man in it, so that he was with us on the day that he had to go from it. Yes."
    assert main_text(f"<p>{LONG}</p><p>{prose} <a href=x>{'&amp;' * 40}</a></p>") == f"{LONG}\n\n{prose} {'&' * 40}"
    assert main_text(f"<article><p>{LONG}</p><p>{prose} <a href=x>see{' ' * 600}it</a></p></article>") == f"{LONG}\n\n{prose} see it"


def test_nested_and_unmatched_tags_take_linear_time():
    n = 100_000
    for page in ("<div>" * n + "</p>" * n, "<div>" * n + "</div>" * n, "<span class=ad>" * n + "</span>" * n,
                 "<b><span class=ad><div>" * (n // 3) + "</span>" * n, "<p>" * n + "</li>" * n):
        start = time.time()
        main_text(page)
        assert time.time() - start < 2


def brute_label(found):
    """The rules of both passes, block by block, each looking at all others."""
    from runway.llm import html_extract as h

    def few_links(b):
        return b[1] <= h.LINK_DENSITY * len(b[0])

    def one(found):
        plain = [b for b in found if b[2] < h.NAMED and few_links(b)]
        words = [w for b in plain for w in h._WORD.findall(b[0].lower())]
        known = sum(w in h.STOP_WORDS for w in words) >= h.KNOWN_DENSITY * len(words)
        inside = sum(len(b[0]) for b in plain if b[3])
        outside = sum(len(b[0]) for b in found if not b[3] and b[2] == h.NO and few_links(b))
        has_main = 0 < inside >= outside
        first = []
        for text, linked, level, main in found:
            own = h._WORD.findall(text.lower())
            density = h.stop_density(text, (sum(w in h.STOP_WORDS for w in own), len(own)), known)
            likely, unlikely = has_main and main and not level, level == h.WEAK or (has_main and not main)
            if level >= h.NAMED or linked > h.LINK_DENSITY * len(text):
                first.append(h.BAD)
            elif h.width(text) < h.SHORT:
                first.append(h.BAD if level or (linked and not likely) else h.OPEN)
            elif density >= (h.MAIN_STOP_DENSITY if likely else h.STOP_DENSITY) or (h.width(text) >= h.LONG and not unlikely):
                first.append(h.GOOD)
            else:
                first.append(h.OPEN)
        if h.GOOD not in first:
            first = [h.GOOD if f == h.OPEN and h.width(b[0]) >= h.SHORT and not b[1] else f for f, b in zip(first, found)]
        out = []
        for k, b in enumerate(found):
            if first[k] != h.OPEN:
                out.append(first[k])
                continue
            side = b[3] or not has_main
            near = []
            for step in (-1, 1):  # the nearest decided block on this side of the main element's border
                j = k + step
                while 0 <= j < len(found):
                    if found[j][2] < h.NAMED:
                        if (found[j][3] or not has_main) != side:
                            break
                        if first[j] != h.OPEN:
                            near.append((abs(j - k), -step, first[j]))
                            break
                    j += step
            out.append(min(near)[2] if near else h.GOOD if side else h.BAD)
        return out
    prose = {True: 0, False: 0}
    for t, linked, level, _, _ in found:
        if level <= h.FORM and h.width(t) >= h.SHORT and linked <= h.LINK_DENSITY * len(t):
            prose[level == h.FORM] += len(t)
    form = h.NO if prose[True] > prose[False] else h.NAMED
    level = lambda x: form if x == h.FORM else x
    out = one([(t, n, max(level(a), level(e)), m) for t, n, a, m, e in found])
    if h.GOOD not in out and any(b[4] for b in found):
        out = one([(t, n, level(a), m) for t, n, a, m, _ in found])
    return out


def test_labels_brute_force():
    import random

    from runway.llm import html_extract as h
    rng = random.Random(11)
    texts = ["Short.", "Read more", LONG, LONG[:120], "x" * 90, "names dates sums lists " * 8, "q " * 120, *OTHER["zh"], *OTHER["pl"]]
    for _ in range(3000):
        found = []
        for _ in range(rng.randint(0, 14)):
            t = rng.choice(texts)
            found.append((t, rng.choice([0, 0, 0, 3, len(t)]), rng.choice([h.NO] * 5 + [h.WEAK, h.FORM, h.NAMED, h.SURE]),
                          rng.random() < 0.4, rng.choice([h.NO] * 6 + [h.FORM, h.NAMED])))
        assert label(found) == brute_label(found), found
