"""Names of elements: whole names count, not parts of them."""

from runway.llm.html_extract import main_text

LONG = ("It is one of the things that they said to us, and it was not what we had thought of it at the time. " * 3).strip()


def test_names_count_as_a_whole():
    for wrapper in ("class='content-sidebar-wrap'", "class='layout no-sidebar'", "id='page' class='has-sidebar'",
                    "title='The hidden cost'", "class='overflow hidden x'", "data-id='ad'", "class='page-with-sidebar'"):
        assert main_text(f"<div {wrapper}><article><p>{LONG}</p></article></div>") == LONG, wrapper
        assert main_text(f"<div {wrapper}><p>{LONG}</p></div>") == LONG, wrapper
    for part in ("id='search-methods'", "class='related-work'", "class='market-share'", "id='discussion'", "id='legal'"):
        assert main_text(f"<article><p>{LONG}</p><section {part}><p>{LONG}</p></section></article>") == f"{LONG}\n\n{LONG}", part
    for part in ("class='site-footer'", "class='cookie-notice'", "id=comments", "class='left-sidebar'", "class='c-nav__list'",
                 "class='sidebar-wrapper'", "hidden", "hidden=''", "style='display: none'", "aria-hidden=true"):
        assert main_text(f"<article><p>{LONG}</p></article><div {part}><p>{LONG}</p></div>") == LONG, part


def test_article_and_main_lift_a_wrapper_but_not_related_cards():
    assert main_text(f"<div class=sidebar><main><p>{LONG}</p></main></div>") == LONG
    assert main_text(f"<form id=aspnet><article><p>{LONG}</p></article></form>") == LONG
    page = f"<article><p>{LONG}</p></article><div class=sidebar><article><p>{LONG} Card.</p></article></div>"
    assert main_text(page) == LONG
