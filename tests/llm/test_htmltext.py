import time

import pytest

from velograph.llm.htmltext import CONTENT, NOISE, OPEN, extract_text, page_blocks, page_host

NAV = "<nav><ul><li><a href='/a'>Home</a></li><li>About</li></ul></nav>"


def content(page):
    return [t for t, role, _ in page_blocks(page) if role == CONTENT]


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<html><head><title>x</title><script>var t='</p>';</script></head><body>{NAV}<article><h1>A &amp; B</h1><p>one\n two<br>three<p><b>four</article><footer>f</footer>", ["A & B", "one two three", "four"]),
        ("<article>a<div class='ad'>buy</div>b<aside>c</aside><form><input>d</form>e<!-- f -->g</article>", ["a", "b", "eg"]),
        ("<article><p>t</p><section id=comments><p>nice</p></section><div class='post-comments'>x</div></article>", ["t"]),
        ("<div role=main><p>m</p></div><div role=banner>b</div>", ["m"]),
        ("<main><header><h1>h</h1></header><p>x&#x41;&nbsp;&eacute; y</p><footer>z</footer></main>", ["h", "xA é y"]),
        ("<article><p>a<style>b{}</style>c <!-- <p>no</p> --><a href='x>y'>d</a></p></article>", ["ac d"]),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><ul><li>i<li>j</ul></article>", ["1", "2", "3", "i", "j"]),
        ("<article><p>cut off <b>here", ["cut off here"]),
        ("<article><p>cut off <a href='", ["cut off"]),
        ("<article><p>1 < 2 &lt; 3</p></article></div></p>tail", ["1 < 2 < 3"]),
        ("<article hidden><p>no</p></article><article><p>yes</p></article>", ["yes"]),
        ("", []),
        ("<script>never closed", []),
        ("<article><p class=it's>Hello</p><p>World</p></article>", ["Hello", "World"]),
        ("<article><p title='a>Hello</p><p>World</p></article>", ["Hello", "World"]),
        ('<article><p title="a>Hello</p><p>World</p></article>', ["Hello", "World"]),
        ('<article><p a"b title="x>y" \'>Hello</p></article>', ["Hello"]),
        ('<article data-class="ad"><p title="class=ad">t</p><p title = "x" class = "ad">no</p></article>', ["t"]),
        ("<article>a<!-->b<!--x--!>c<!-- <p>d", ["abc"]),
        ("<article><p>a</b></i>b</div></section>c</article>", ["ab", "c"]),
    ],
)
def test_blocks(page, wanted):
    assert content(page) == wanted


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "x" + "</span></section></p>" * 100_000,
        "<div>" * 100_000 + "<td>x</td>" * 100_000,
        "<li><div><p>" * 100_000 + "x",
        "<article>" + "<b>" * 100_000 + "x" + "<p>y" * 100_000,
        "<article><p>" + "x <a href=' " * 100_000,
    ],
)
def test_deep_nesting_takes_time_in_proportion(page):
    start = time.perf_counter()
    assert page_blocks(page)
    assert time.perf_counter() - start < 3


def test_a_very_long_page():
    text = " ".join(f"word{k}" for k in range(300_000))
    assert content(f"<article><p class=x>{text}</p>{NAV}<p>end</p></article>") == [text, "end"]


def test_without_marked_content_blocks_are_open():
    roles = {t: r for t, r, _ in page_blocks("<body><div class=sidebar>s</div><p>p</p><footer>f</footer>")}
    assert roles == {"s": NOISE, "p": OPEN, "f": NOISE}


def test_hosts():
    assert page_host("HTTP://User:pw@Www.Example.COM:80/a?b#c") == "www.example.com"
    assert page_host("https://x.org?q") == "x.org" and page_host("nothing") == "" and page_host(None) == ""


def pages_of_a_host(count):
    menu = "<div><span>Start page of the site with many links and a long list of topics</span></div>"
    end = "<div>All rights reserved by the owners of this site since the year it began</div>"
    body = "<p>{0}</p>"
    texts = [" ".join(f"word{k}x{j}" for j in range(30)) for k in range(count)]
    return [(k, f"http://h.example/{k}", menu + body.format(t) + end, "text") for k, t in enumerate(texts)], texts


@pytest.mark.parametrize("shard_pages", [100, 1])
def test_repeated_blocks_of_a_host_are_removed(spark, shard_pages):
    rows, texts = pages_of_a_host(9)
    rows.append((90, "http://other.example/", rows[0][2], ""))
    rows.append((91, None, None, ""))
    table = spark.createDataFrame(rows, "page_id INT, url STRING, html STRING, text STRING")
    found = {r["page_id"]: r for r in extract_text(table, shard_pages=shard_pages).collect()}
    assert len(found) == len(rows)
    for k, text in enumerate(texts):
        assert found[k]["text"] == text and found[k]["n_chars"] == len(text)
    assert found[90]["text"].count("\n") == 2
    assert (found[91]["text"], found[91]["n_chars"]) == ("", 0)


def test_copies_of_a_page_do_not_remove_each_other(spark):
    rows, texts = pages_of_a_host(1)
    table = spark.createDataFrame(rows * 3, "page_id INT, url STRING, html STRING, text STRING")
    assert [texts[0] in r["text"] for r in extract_text(table).collect()] == [True] * 3
    assert extract_text(table.limit(0)).count() == 0
