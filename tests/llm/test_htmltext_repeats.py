"""Repeats of a host: near copies, short blocks, names within content, blocks outside of it."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from velograph.llm.htmltext import CONTENT, NOISE, OPEN, _repeated_runs, extract_text, page_blocks

MENU = "<div><span>Start page of the site with many links and a long list of topics</span></div><div>Read more</div>"


def words(name, count=60):
    return " ".join(f"{name}{j}" for j in range(count))


@pytest.mark.parametrize("shard_pages", [100, 1])
def test_pages_of_one_host(spark, shard_pages):
    plain = [f"{MENU}<p>{words(f'a{k}x')}</p>" for k in range(3)]
    near = [f"{MENU}<p>{words('copy')} of {day}</p>" for day in ("monday", "friday")]
    offer = "<div class='related-offer'>Buy one of these and get another one for half its price today</div>"
    marked = [f"{MENU}<article><p>{words(f'm{k}x', 20)}</p>{offer}<p class='notice'>Mind the {words(f'n{k}x', 12)}</p>"
              f"<p>{words(f'z{k}x', 20)}</p></article>" for k in range(2)]  # fmt: skip
    teaser = [f"{MENU}<article>{words('teaser', 9)}</article><p>{words('outside')}</p>"]
    pages = [*plain, *near, *marked, *teaser]
    table = spark.createDataFrame(
        [(k, f"http://h.example/{k}", p) for k, p in enumerate(pages)], "page_id INT, url STRING, html STRING"
    )
    found = {r["page_id"]: r["text"] for r in extract_text(table, shard_pages=shard_pages).collect()}
    assert [found[k] for k in range(3)] == [words(f"a{k}x") for k in range(3)]
    assert [found[3], found[4]] == [f"{words('copy')} of monday", f"{words('copy')} of friday"]
    for k in range(2):
        assert found[5 + k].split("\n") == [words(f"m{k}x", 20), f"Mind the {words(f'n{k}x', 12)}", words(f"z{k}x", 20)]
    assert found[7].split("\n") == [words("teaser", 9), words("outside")]


def test_names_within_content_put_blocks_in_doubt():
    page = (
        "<article><section id='related-work'><h2 id='share-of-votes'>a</h2></section><p class='notice'>b</p>"
        "<div class='ad'>c</div><div id='comment-on-the-treaty'>d</div><p>e</p></article><div class='page-footer'>f</div>"
    )
    roles = {t: r for t, r, _ in page_blocks(page)}
    assert roles == {"a": OPEN, "b": OPEN, "c": NOISE, "d": OPEN, "e": CONTENT, "f": NOISE}


page_texts = st.lists(st.lists(st.sampled_from(["a", "b", "c d", "a b a"]), min_size=1, max_size=6), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(page_texts, st.sampled_from([2, 4]), st.data())
def test_runs_agree_with_plain_counts(pages, run, data):
    copies = [data.draw(st.integers(0, 3)) for _ in pages]
    rows = pd.DataFrame(
        {"key": range(len(pages)), "host": "h", "texts": pages, "tags": [["p"] * len(p) for p in pages],
         "copies": copies, "parts": 1}
    )
    streams = [[t for text in p for t in ("<p>", *text.split(" "))] for p in pages]
    seen = {}
    for stream, group in zip(streams, copies, strict=True):
        for k in range(len(stream) - run + 1):
            seen.setdefault(tuple(stream[k : k + run]), set()).add(group)
    expected = {}
    for key, stream in enumerate(streams):
        starts = [k for k in range(len(stream) - run + 1) if len(seen[tuple(stream[k : k + run])]) > 1]
        if starts:
            expected[key] = starts
    found = _repeated_runs(rows, run)
    assert dict(zip(found["key"], found["starts"], strict=True)) == expected
