"""Texts and pages of a megabyte take seconds and little memory, whatever they hold."""

import time
import tracemalloc

import pytest

from replylens.llm import html_extract, secret_scan

PAGES = {
    "deep": '<div class="row item">' * 48_000 + "x",
    "wide": "<article>" + "<p>word</p>" * 90_000 + "</article>",
    "unmatched ends": "<i>" * 120_000 + "</u>" * 120_000 + "x",
    "items below many divs": "<ul><li><ul>" + "<div>" * 60_000 + "<li></li>" * 80_000,
    "open inline": "<p>" + "<b>" * 100_000 + "<div>" * 100_000,
    "open tags": "<a " * 300_000,
    "open quotes": "<a b='" * 160_000,
}
TEXTS = {
    "one identifier": "token" * 200_000,
    "words": "token_ " * 150_000,
    "assignments": "token=" * 170_000,
    "spaces": "secret" + " " * 1_000_000,
    "keys": "secret Zk3vQ9xT7bLm2RwY8pNc4HsJ6dFg1Aue " * 25_000,
    "one value": 'secret = "' + "aB3x" * 250_000 + '"',
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    began = time.time()
    page = html_extract.Page(PAGES[name])
    rows, text = list(page.tree_rows()), page.kept()
    assert time.time() - began < 15
    assert {"deep": "x", "unmatched ends": "x"}.get(name, text) == text
    assert name != "wide" or (len(rows) == 90_000 and text.count("word") == 90_000)


def test_memory_of_a_deep_page():
    tracemalloc.start()
    list(html_extract.Page(PAGES["deep"]).tree_rows())
    assert tracemalloc.get_traced_memory()[1] < 300_000_000
    tracemalloc.stop()


@pytest.mark.parametrize("name", TEXTS)
def test_texts(name):
    began = time.time()
    secret_scan.SecretScanner().scan(TEXTS[name])
    assert time.time() - began < 15


@pytest.mark.parametrize("alphabet", ["0123456789", "0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz"])
def test_keys_of_small_alphabets(alphabet):
    import random

    rng, scanner = random.Random(alphabet), secret_scan.SecretScanner()
    for n in (16, 24, 32, 64, 200):
        for _ in range(20):
            key = "".join(rng.choices(alphabet, k=n))
            text = f'{{\n  "client_id": "{key}",\n  "retries": 3\n}}'
            assert [text[a:b] for a, _, b in scanner.novel(text, text.lower(), [])] == [key], key


def test_plain_numbers_are_not_keys():
    for text in ("client_id: 1111111111111111", "session_id = 0000000000000001", "token_count = 10000000000000000"):
        assert secret_scan.SecretScanner().novel(text, text, []) == []
