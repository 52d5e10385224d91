"""Main text of web pages: markup tells most of it, a host's repeated text the rest.

A page is cut into blocks. Blocks within the page's marked main content are kept, and blocks in
menus, headers, footers, sidebars, notices, adverts, forms, comments and the like are not. All other
blocks, also those within main content whose names only hint at such, are judged by their host: the
token streams (tags and words) of the host's pages are laid end to end, a suffix array finds runs of
tokens that occur on several pages, and blocks covered by such runs are boilerplate; unique runs stay.
Near copies of a page count as one page. A block shorter than a run is judged as a whole.

A host of many pages is cut over several shards. Each shard sorts its own streams; runs that it has
on one page only are looked up among the other shards' by digest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.common import Workspace
from velograph.llm.minhash import near_duplicates
from velograph.llm.suffixes import refined_order

# Tokens of a run that counts as repeated.
RUN_TOKENS = 8
# Pages of one host that one task looks at.
SHARD_PAGES = 128

# Near copies by their pairs of words: so many in a hundred are common.
COPY_WORDS, COPY_PERCENT = 2, 75

CONTENT, OPEN, NOISE = 0, 1, 2
# Open within main content; blocks show it as open.
_DOUBT = 3

# Elements of HTML by their role.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp noembed noframes iframe".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_NOISE_TAGS = set(
    "nav footer aside form script style noscript template button select textarea iframe svg canvas dialog menu head "
    "title object audio video map datalist search".split()
)
_CONTENT_TAGS = {"article", "main"}
_NOISE_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_NOISE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription sidebar nav navbar "
    "navigation menu menus breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies share "
    "sharing social related recommended widget widgets pagination pager login signin signup toolbar".split()
)
# Of these, names that within main content say enough as the whole of a class or id.
_SURE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsored cookie cookies gdpr popup modal newsletter "
    "sidebar nav navbar breadcrumb breadcrumbs comments disqus pagination pager".split()
)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

# A quote opens a value only after an equals sign; one that never closes ends at the tag's end.
_VALUE = r"=\s*+(?:\"[^\"]*\"|'[^']*'|[\"'][^>]*|[^\s>\"'][^\s>]*)?"
_TAG = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|{_VALUE})*+)(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|[\"']?([^\s>]*)))?|=\s*(?:\"[^\"]*\"|'[^']*')?"
)
_NAME_PARTS = re.compile(r"[a-z]+")


@lru_cache(maxsize=10_000)
def _attribute_role(attributes: str, inside: bool) -> int | None:
    """What an element's attributes say of it; inside main content most names only put it in doubt."""
    role = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "role" and _NOISE_ROLES.intersection(value.split()):
            return NOISE
        if name in ("class", "id") and _NOISE_NAMES.intersection(_NAME_PARTS.findall(value)):
            if not inside or _SURE_NAMES.intersection(value.split()):
                return NOISE
            role = _DOUBT
        if name == "role" and "main" in value.split() or name == "itemprop" and "articlebody" in value.split():
            role = CONTENT
    return role


def _role(tag: str, attributes: str, outer: int) -> int:
    inside = outer in (CONTENT, _DOUBT)
    if outer == NOISE or tag in _NOISE_TAGS or tag == "header" and not inside:
        return NOISE
    said = _attribute_role(attributes, inside) if attributes and tag not in ("html", "body") else None
    if said == NOISE:
        return NOISE
    if _DOUBT in (outer, said):
        return _DOUBT
    return CONTENT if tag in _CONTENT_TAGS or said == CONTENT else outer


class _OpenElements:
    """The open elements of a page, each with its role and the place of its innermost block element.

    The places of each tag's open elements are kept as well, so that no step looks through all of them:
    a page takes time in proportion to its length, however deep it nests.
    """

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, int]] = []
        self.places: dict[str, list[int]] = {}

    @property
    def role(self) -> int:
        return self.stack[-1][1] if self.stack else OPEN

    @property
    def block_place(self) -> int:
        return self.stack[-1][2] if self.stack else -1

    @property
    def block(self) -> str:
        return self.stack[self.block_place][0] if self.block_place >= 0 else "body"

    def push(self, tag: str, role: int) -> None:
        place = len(self.stack)
        self.places.setdefault(tag, []).append(place)
        self.stack.append((tag, role, place if tag in _BLOCK else self.block_place))

    def innermost(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of one of the tags, -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def divides(self, place: int) -> bool:
        """Whether leaving the elements from ``place`` on ends a block or a role."""
        outer = self.stack[place - 1][1] if place else OPEN
        return any(t in _BLOCK or r != outer for t, r, _ in self.stack[place:])

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop()[0]].pop()

    def make_room(self, tag: str) -> None:
        """Close what a block element's start closes: items and cells of its kind, then a paragraph."""
        closes, scope = _CLOSES.get(tag, (set(), set()))
        while (place := self.innermost(closes)) > self.innermost(scope):
            self.pop_to(place)
        if self.block == "p":
            self.pop_to(self.block_place)


def page_blocks(page: str) -> list[tuple[str, int, str]]:
    """Text, role and innermost block element of each block, in page order.

    Markup that is cut short or wrongly nested loses no text: a quote that opens where no value is due is
    an ordinary character, a quoted value that never closes ends with its tag, and closing tags without
    an open element only divide blocks.
    """
    blocks: list[tuple[str, int, str]] = []
    opened = _OpenElements()
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                role = opened.role
                blocks.append((text, OPEN if role == _DOUBT else role, opened.block))

    place = 0
    while match := _TAG.search(page, place):
        if match.start() > place:
            parts.append(page[place : match.start()])
        place = match.end()
        closing, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if closing:
            depth = opened.innermost((tag,))
            if depth >= 0:
                if opened.divides(depth):
                    flush()
                opened.pop_to(depth)
            elif tag in _BLOCK:
                flush()
            continue
        if tag in _BLOCK:
            flush()
            opened.make_room(tag)
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        own = _role(tag, attributes, opened.role)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, place)
            place = end.start() if end else len(page)
            if end is None:
                break
            close = page.find(">", place)
            place = close + 1 if close >= 0 else len(page)
            continue
        if own != opened.role:
            flush()
        opened.push(tag, own)
    if place < len(page):
        parts.append(page[place:])
    flush()
    return blocks


def page_host(url: str | None) -> str:
    """The host of a URL in lower case, without user and port; empty if there is none."""
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def _stream(texts: list[str], tags: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a page's blocks, a tag before its words, and the block of each token."""
    tokens, sizes = [], []
    for text, tag in zip(texts, tags, strict=True):
        words = [f"<{tag}>", *text.split(" ")]
        tokens += map(xxhash.xxh3_64_intdigest, words)
        sizes.append(len(words))
    return np.array(tokens, dtype=np.uint64), np.repeat(np.arange(len(sizes)), sizes)


def _repeated_runs(rows: pd.DataFrame, run: int) -> pd.DataFrame:
    """Starts of runs that several groups of pages in the shard have; of a cut host its other runs, too."""
    rows = rows.sort_values("key").reset_index(drop=True)
    streams = [_stream(list(t), list(g))[0] for t, g in zip(rows["texts"], rows["tags"], strict=True)]
    sizes = np.array([len(s) for s in streams])
    names = ["key", "starts", "host", "digests", "fresh", "low", "high"]
    if not sizes.sum():
        return pd.DataFrame(columns=names, dtype=object)
    hashes = np.concatenate(streams)
    page = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    order, opens = refined_order(np.unique(hashes, return_inverse=True)[1], 1, run)
    # Only runs that end on their own page count.
    whole = np.zeros(len(page), dtype=bool)
    inner = max(len(page) - run + 1, 0)
    whole[:inner] = page[:inner] == page[len(page) - inner :]
    kept = whole[order]
    order, kind = order[kept], np.cumsum(opens)[kept]
    cut = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]][: len(kind)])
    copies = rows["copies"].to_numpy(dtype=np.int64)[page[order]]
    low, high = (f.reduceat(copies, cut) if len(cut) else copies for f in (np.minimum, np.maximum))
    low, high = (np.repeat(x, np.diff(np.r_[cut, len(kind)])) for x in (low, high))
    again = low != high
    host = rows["host"].iloc[0]
    divided = rows["parts"].iloc[0] > 1
    shown = np.zeros(len(order), dtype=bool)
    shown[cut] = True
    out = []
    by_page = np.argsort(page[order], kind="stable")
    bounds = np.searchsorted(page[order][by_page], np.arange(len(sizes) + 1))
    for k, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        mine = by_page[first:last]
        starts = order[mine] - begins[k]
        known = np.sort(starts[again[mine]]).tolist()
        digests, fresh, lows, highs = None, None, None, None
        if divided:
            # A run repeated in the shard is shown to the others once, a new one with its place.
            open_ = mine[~again[mine] | shown[mine]]
            digests = [
                int(np.uint64(xxhash.xxh3_64_intdigest(hashes[s : s + run].tobytes())).view(np.int64)) for s in order[open_]
            ]
            fresh = np.where(again[open_], -1, order[open_] - begins[k]).tolist()
            lows, highs = low[open_].tolist(), high[open_].tolist()
        if known or digests:
            out.append((int(rows["key"][k]), known, host, digests, fresh, lows, highs))
    return pd.DataFrame(out, columns=names, dtype=object)


_PARSED = (
    "page_id {id}, url STRING, key BIGINT, host STRING, text STRING, texts ARRAY<STRING>, tags ARRAY<STRING>, open ARRAY<INT>, "
    "content ARRAY<STRING>, before ARRAY<INT>"
)


def _parsed(pages: DataFrame) -> DataFrame:
    """Content text of each page, and its other blocks with their tags; open lists those in doubt.

    Pages with blocks in doubt also have their content blocks, each with the number of others before it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            out = []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = page or ""
                host = page_host(url)
                blocks = page_blocks(page)
                others = [b for b in blocks if b[1] != CONTENT]
                content, before = [], []
                if any(r == OPEN for _, r, _ in others):
                    content = [t for t, r, _ in blocks if r == CONTENT]
                    count = np.cumsum([r != CONTENT for _, r, _ in blocks])
                    before = [int(n) for n, b in zip(count, blocks, strict=True) if b[1] == CONTENT]
                key = int(np.uint64(xxhash.xxh3_64_intdigest(f"{host}\n{page}".encode())).view(np.int64))
                out.append(
                    (
                        key,
                        host,
                        "\n".join(t for t, r, _ in blocks if r == CONTENT),
                        [t for t, _, _ in others],
                        [g for _, _, g in others],
                        [k for k, b in enumerate(others) if b[1] == OPEN],
                        content,
                        before,
                    )
                )
            strings = pa.list_(pa.string())
            kinds = [pa.int64(), pa.string(), pa.string(), strings, strings, pa.list_(pa.int32()), strings, pa.list_(pa.int32())]
            columns = [pa.array(c, type=k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), *columns],
                names=["page_id", "url", "key", "host", "text", "texts", "tags", "open", "content", "before"],
            )

    return pages.mapInArrow(work, _PARSED.format(id=pages.schema["page_id"].dataType.simpleString()))


def _unique_text(
    texts: list[str], tags: list[str], doubtful: list[int], content: list[str], before: list[int],
    starts: set[int], short: set[int], run: int,
) -> str:
    """The content blocks and, in their places, those in doubt of which repeats cover less than half."""
    tokens, block = _stream(texts, tags)
    covered = np.zeros(len(tokens) + run, dtype=bool)
    for start in starts:
        covered[start : start + run] = True
    share = np.bincount(block, weights=covered[: len(tokens)], minlength=len(texts)) / np.maximum(np.bincount(block), 1)
    kept = [(k + 0.5, texts[k]) for k in doubtful if share[k] < 0.5 and k not in short]
    return "\n".join(t for _, t in sorted([*zip(before, content, strict=True), *kept], key=lambda x: x[0]))


def _copies(single: DataFrame, work: Workspace) -> DataFrame:
    """Pages with the key of the group of near copies they are in."""
    open_texts = F.transform("open", lambda k: F.element_at("texts", k + 1))
    body = F.when(F.size("open") > 0, F.concat_ws("\n", "content", open_texts)).otherwise(F.col("text"))
    found = near_duplicates(
        single.select("key", body.alias("body")),
        doc_id="key", text="body", shingle_words=COPY_WORDS, percent=COPY_PERCENT, work=work,
    )
    copies = work.keep(found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("copies")))
    work.drop(found)
    return copies


def extract_text(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    page: str = "html",
    run_tokens: int = RUN_TOKENS,
    shard_pages: int = SHARD_PAGES,
) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by a newline, empty if none), n_chars.

    A null page is empty, pages without URL share the empty host. Pages of a host with the same markup or
    nearly the same text count as one page when repeats are looked for, so copies do not remove each other;
    rows that repeat a page each get its text. Markup of any nesting is read in time in proportion to its
    length, a page of any length as one row; see ``page_blocks`` for markup that is cut short. Other columns
    are not read; without rows there are none.

    Runs are looked for on hosts of which some page has a block in doubt, as they decide on nothing else.
    Between the steps only keys and places are carried; each written table goes as soon as its last
    reader is done, but for the parsed pages and the places of runs, which the result reads.
    """
    if run_tokens & (run_tokens - 1):
        raise ValueError("run_tokens must be a power of two")
    work = Workspace(pages.sparkSession)
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    parsed = work.keep(_parsed(source))
    n_chars = F.length("text").cast("bigint").alias("n_chars")
    plain = parsed.where(F.size("open") == 0).select("page_id", "url", "text")
    in_doubt = work.keep(parsed.where(F.size("open") > 0).select("host").distinct())
    if in_doubt.isEmpty():
        return plain.select("*", n_chars)
    # Equal pages have one key and meet in one part.
    fields = ["host", "text", "texts", "tags", "open", "content"]
    shown = parsed.where(F.size("texts") > 0).join(in_doubt, "host", "left_semi")
    single = work.keep(shown.groupBy("key").agg(*(F.first(c).alias(c) for c in fields)))
    copies = _copies(single, work)
    hosts = work.keep(
        single.groupBy("host").agg(F.count("*").alias("n")).select("host", F.ceil(F.col("n") / shard_pages).alias("parts"))
    )
    grouped = single.select("host", "key", "texts", "tags").join(copies, "key", "left")
    grouped = grouped.withColumn("copies", F.coalesce("copies", "key"))
    dealt = grouped.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    found = work.keep(
        dealt.groupBy("host", "part").applyInPandas(
            lambda rows: _repeated_runs(rows, run_tokens),
            "key BIGINT, starts ARRAY<BIGINT>, host STRING, digests ARRAY<BIGINT>, fresh ARRAY<BIGINT>, "
            "low ARRAY<BIGINT>, high ARRAY<BIGINT>",
        )
    )
    runs = found.where("digests IS NOT NULL").select(
        "key", "host", F.explode(F.arrays_zip("digests", "fresh", "low", "high")).alias("run")
    )
    runs = runs.select("key", "host", "run.*")
    shared = work.keep(
        runs.groupBy("host", "digests").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    )
    across = runs.where("fresh >= 0").join(shared.select("host", "digests"), ["host", "digests"])
    starts = found.select("key", "starts").unionByName(across.select("key", F.array("fresh").alias("starts")))
    starts = work.keep(starts.groupBy("key").agg(F.flatten(F.collect_set("starts")).alias("starts")))
    work.drop(found, shared)

    # Blocks with fewer tokens than a run, by their tag and whole text.
    brief = grouped.select("host", "key", "copies", F.posexplode(F.arrays_zip("tags", "texts")).alias("at", "block"))
    brief = brief.where(F.size(F.split("block.texts", " ")) + 1 < run_tokens)
    common = work.keep(
        brief.groupBy("host", "block").agg(F.min("copies").alias("low"), F.max("copies").alias("high")).where("low <> high")
    )
    short = brief.join(common.select("host", "block"), ["host", "block"], "left_semi")
    short = work.keep(short.groupBy("key").agg(F.collect_set("at").alias("short")))
    work.drop(common, copies, single, hosts, in_doubt)

    blocks = ["texts", "tags", "open", "content", "before"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*blocks, "starts", "short"))
            texts = [_unique_text(*b, set(s or ()), set(k or ()), run_tokens) for *b, s, k in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string())],
                names=["page_id", "url", "text"],
            )

    doubtful = parsed.where(F.size("open") > 0).join(starts, "key", "left").join(short, "key", "left")
    judged = doubtful.select("page_id", "url", *blocks, "starts", "short").mapInArrow(judge, plain.schema)
    return plain.unionByName(judged).select("*", n_chars)
