"""Main text of web pages (operator 10).

Pages are cut into blocks by their tags. What the markup itself decides is decided
there: scripts, styles, navigation, headers, footers, asides, forms and elements whose
class or id names an advert, a notice, comments and the like are left out. An article
element, where a page has one, holds its text. What is left is the page's token stream,
and the streams of a host are compared: a token is boilerplate where it lies in a run of
RUN tokens or more that many of the host's pages have. Pages with an article are compared
with each other, and so are those without.

* Without an article: a share of SHARE or more of the distinct pages, two at least, and
  the tokens are taken out wherever they stand.
* In an article: a share of ARTICLE_SHARE or more, ARTICLE_PAGES at least, and only whole
  blocks go, so that no sentence is cut. A page of which more than half lies in runs that a
  share of SHARE of the pages have, two at least, is a near copy, not an article with a
  notice in it. The run must have its share of all pages and of those that are no near copies.

Copies of a page count once, so they never erase each other, and a page that would lose
all its text keeps it.

That is what a suffix array over the host's streams says: suffixes that agree on their
first RUN tokens are neighbours in it. Only this depth is needed to know every position
a long repeated substring covers, so suffixes are grouped by host and a 63-bit hash of
their first RUN tokens, and the distinct pages of a class are counted. No row is made for
a token: each task first adds up how many pages of a host have a run in each of 65,536
hash buckets, and runs are counted one by one only in buckets that enough pages have. At
most 1 / share of an average page's runs can be shared on a host, so they go to the
host's pages in one packed value.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskline.llm.common import map_rows, mixed, rows_of, ship, staged
from maskline.llm.urlfilter import host_of
from maskline.operators.lookup import broadcast_if_small
from maskline.sources.staging import stage

RUN = 8
# Share of a host's distinct pages that a repeated run must be on to be boilerplate.
SHARE = 0.2
# The same in articles, where less may be the authors' own words, and the least number of pages.
ARTICLE_SHARE, ARTICLE_PAGES = 0.5, 5
# Polynomials of runs: what a byte counts, the factor, and how many bytes are added up at once.
BYTES, FACTOR, PIECE = mixed(np.arange(1, 257, dtype=np.uint64)), 0x9E3779B97F4A7C15, 1 << 18
# Parts in which the 65,536 buckets of a host are added up.
PARTS = 4
# Runs that a task holds before it hands on its sums; a page counts as so many besides its own.
HELD, PAGE_RUNS = 8_000_000, 64
# Copied pages that all tasks know by their hashes; with more, every page is listed under its runs.
KNOWN_COPIES = 1_000_000
# Parts of a host where its packed runs are too many to broadcast; what a row of them counts besides.
SALTS, ROW_BYTES = 16, 160
# Stands for "this page is a near copy" among the run hashes, which are odd.
NEAR_COPY = 0

# Elements by what they mean for the main text.
SKIPPED = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea "
    "iframe svg canvas object video audio map menu dialog".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
EMPTY_AT_SLASH = frozenset(["noscript", "iframe", "template", "svg"])
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(["article", "main"])
MAIN_ROLES = frozenset(["main", "article"])
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog".split())
# Class and id words: as a whole word, or as its first part ("banner-top").
SKIPPED_NAMES = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|sidebar\w*|menu\w*|nav\w*|breadcrumbs?|header|"
    r"masthead|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|"
    r"signup|login|share|sharing|social|related|recommended|comments?|disqus|replies|reply|respond|widget|toolbar|"
    r"pagination|pager)"
)
# As any part ("reader-comments", "in-article-ad", "siteNotice"), and as the whole word only.
SKIPPED_PARTS = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor(?:s|ed)?|promo|sidebar|menu|navbar|navigation|breadcrumbs?|cookies?|gdpr|notices?|"
    r"newsletter|comments?|disqus)"
)
SKIPPED_WORDS = frozenset(["side"])
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
_PARTS = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")
_P_ENDS = BLOCKS - {"br"}


def attributes_of(written: str) -> dict[str, str]:
    """Names (lower case) and values of a tag's attributes; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(written):
        out.setdefault(name.lower(), next((v for v in values if v), ""))
    return out


def _named_out(word: str) -> bool:
    parts = [x.lower() for x in _PARTS.split(word) if x]
    whole = word.lower()
    return (
        whole in SKIPPED_WORDS
        or SKIPPED_NAMES.fullmatch(whole) is not None
        or bool(parts) and SKIPPED_NAMES.fullmatch(parts[0]) is not None
        or any(SKIPPED_PARTS.fullmatch(x) for x in parts)
    )


def _left_out(tag: str, attributes: dict[str, str]) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if attributes.get("hidden", "until-found").lower() != "until-found" or attributes.get("role", "").lower() in SKIPPED_ROLES:
        return True
    return any(_named_out(word) for name in ("class", "id") for word in attributes.get(name, "").split())


def blocks_of(page: str) -> list[tuple[str, bool]]:
    """(text, in an article) of the blocks that the markup does not leave out, in page order."""
    out: list[tuple[str, bool]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, left out, article
    skip = main = 0

    def close() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, main > 0))
        pieces.clear()

    def leave(index: int) -> None:
        nonlocal skip, main
        while len(stack) > index:
            _, out_of, article = stack.pop()
            skip -= out_of
            main -= article

    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            if not skip:
                pieces.append(entities.unescape(page[at:]))
            break
        if not skip and found.start() > at:
            pieces.append(entities.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS and not skip:
            close()
        if found[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if not skip and any(x in BLOCKS or out_of or article for x, out_of, article in stack[i:]):
                        close()
                    leave(i)
                    break
                # an end tag does not reach through the element that holds the text
                if stack[i][0] in MAIN and tag not in ("body", "html"):
                    break
            continue
        if tag in RAW:
            if found[3].rstrip().endswith("/") and tag in EMPTY_AT_SLASH:
                continue
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            # an embedded element that is never closed ends at its tag, unclosed text at the end of the page
            at = end.end() if end else at if tag in EMPTY_AT_SLASH else n
            continue
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in _P_ENDS and stack and stack[-1][0] == "p":
            leave(len(stack) - 1)
        attributes = attributes_of(found[3]) if found[3] else {}
        article = tag in MAIN or attributes.get("role", "").lower() in MAIN_ROLES
        left = _left_out(tag, attributes)
        if left and not skip:
            close()
        stack.append((tag, left, article))
        skip += left
        main += article
    if not skip:
        close()
    return out


def _parse(pages):
    """Whether a page has an article, and the blocks that may be its main text."""
    articles, streams = [], []
    for page in pages:
        found = blocks_of(page) if page else []
        article = [text for text, inside in found if inside]
        articles.append(bool(article))
        streams.append(article or [text for text, _ in found])
    return articles, streams


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR and its inverse modulo 2 ** 64, to the powers 0 to n - 1."""
    both = np.array([[FACTOR], [pow(FACTOR, -1, 1 << 64)]], np.uint64).repeat(n, 1)
    both[:, 0] = 1
    return tuple(np.cumprod(both, 1))


@functools.cache
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(2 * PIECE)


def _runs(blocks: list[str]) -> np.ndarray:
    """Hashes (odd) of the runs of RUN tokens of a stream, by position.

    The bytes of a run from its first to its last token, as numbers of 64 bits, are the
    coefficients of a polynomial; all runs of a piece of text are differences of its sums.
    """
    text = np.frombuffer(" ".join(blocks).encode("utf-8", "surrogatepass"), np.uint8)
    gaps = np.flatnonzero(text == ord(" "))
    n = len(gaps) + 2 - RUN
    if n < 1:
        return np.empty(0, np.uint64)
    starts, ends = np.append(0, gaps + 1)[:n], np.append(gaps, len(text))[RUN - 1 :]
    out, i = np.empty(n, np.uint64), 0
    while i < n:
        low = starts[i]
        j = int(np.searchsorted(starts, low + PIECE))
        size = int(ends[j - 1] - low)
        up, down = _usual_powers() if size <= 2 * PIECE else _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(BYTES[text[low : low + size]] * up[:size], out=sums[1:])
        at = starts[i:j] - low
        out[i:j] = (sums[ends[i:j] - low] - sums[at]) * down[at]
        i = j
    return mixed(out) | np.uint64(1)


def _buckets(runs: np.ndarray) -> np.ndarray:
    return (runs >> np.uint64(48)).astype(np.uint16)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _covered(runs: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each token of a stream with these runs: does a shared one cover it?"""
    edges = np.zeros(len(runs) + RUN, np.int64)
    at = np.flatnonzero(np.isin(runs, shared))
    edges[at] += 1
    edges[at + RUN] -= 1
    return np.cumsum(edges)[:-1] > 0


def _page_hash(blocks: list[str]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\n".join(blocks).encode("utf-8", "surrogatepass"))


def _packed(values: bytes | None) -> np.ndarray:
    return np.frombuffer(values or b"", np.uint64)


def _without_shared(article: bool, blocks: list[str], shared: np.ndarray) -> str:
    """The text without whole blocks (articles) or tokens that lie in shared runs; all of it if nothing is left."""
    runs = _runs(blocks) if len(shared) else shared
    if not len(runs):
        return " ".join(blocks)
    gone, at, kept = _covered(runs, shared), 0, []
    for block in blocks:
        tokens = block.split(" ")
        here = gone[at : at + len(tokens)]
        at += len(tokens)
        left = tokens if article and not here.all() else [t for t, out in zip(tokens, here) if not out]
        if left:
            kept.append(" ".join(left))
    return " ".join(kept or blocks)


def _sums(rows: DataFrame) -> DataFrame:
    """Host, kind and part: number of distinct pages, pages for each bucket that two have, hashes of copied pages.

    Copies within other tasks count again in a bucket, never less than they should.
    """
    ship(rows.sparkSession)
    fields = "host string, article boolean, part int, buckets binary, counts binary, pages binary"

    def add(batches):
        held, seen, size = {}, set(), 0

        def out():
            found = []
            for (host, article), (runs, pages) in held.items():
                buckets, counts = np.unique(np.concatenate(runs), return_counts=True)
                pages = np.array(pages, np.uint64)
                for part in range(PARTS):
                    of, listed = buckets % PARTS == part, pages[pages % np.uint64(PARTS) == part]
                    if of.any() or len(listed):
                        each = buckets[of].tobytes(), counts[of].astype(np.uint32).tobytes(), listed.tobytes()
                        found.append((host, article, part, *each))
            held.clear()
            seen.clear()
            if found:
                types = [pa.string(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                names = [f.split()[0] for f in fields.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*found), types)], names=names)

        for hosts, texts in rows_of(batches):
            for host, article, blocks in zip(hosts, *_parse(texts)):
                if not blocks:
                    continue
                page = _page_hash(blocks)
                runs, pages = held.setdefault((host, article), ([np.empty(0, np.uint16)], []))
                pages.append(page)
                size += PAGE_RUNS
                if (host, article, page) not in seen:
                    seen.add((host, article, page))
                    runs.append(_distinct(_buckets(_runs(blocks))))
                    size += len(runs[-1])
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    merged = fields.replace("pages binary", "copied binary, n_pages bigint")

    def merge(batches):
        """Rows of a host, kind and part follow each other."""
        last, held = None, []

        def total():
            buckets, counts, pages = (b"".join(x) for x in zip(*held))
            buckets, counts = np.frombuffer(buckets, np.uint16), np.frombuffer(counts, np.uint32)
            often, place = np.unique(buckets, return_inverse=True)
            n = np.bincount(place, counts, len(often)).astype(np.uint32)
            pages, times = np.unique(_packed(pages), return_counts=True)
            return *last, often[n > 1].tobytes(), n[n > 1].tobytes(), pages[times > 1].tobytes(), len(pages)

        def batch_of(found):
            types = [pa.string(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            names = [f.split()[0] for f in merged.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*found), types)], names=names)

        for batch in batches:
            found = []
            for row in zip(*batch.columns):
                *key, buckets, counts, pages = (v.as_py() for v in row)
                if key != last:
                    if held:
                        found.append(total())
                    last, held = key, []
                held.append((buckets, counts, pages))
            if found:
                yield batch_of(found)
        if held:
            yield batch_of([total()])

    parts = ["host", "article", "part"]
    added = rows.select("host", "text").mapInArrow(add, fields)
    return added.repartition(*parts).sortWithinPartitions(*parts).mapInArrow(merge, merged)


def _beside(rows: DataFrame, found: DataFrame, value: str, how: str) -> DataFrame:
    """The rows with what was found on their host, packed: `in_article` and `in_open`.

    `found` has host, article and `value`, 64-bit numbers one by one or packed.
    """
    listed = found.groupBy("host").agg(
        F.collect_list(F.when(F.col("article"), F.col(value))).alias("in_article"),
        F.collect_list(F.when(~F.col("article"), F.col(value))).alias("in_open"),
    )

    def pack(hosts, *columns):
        def packed(values):
            return b"".join(values) if values and isinstance(values[0], bytes) else np.array(values, np.int64).tobytes()

        return [hosts, *([packed(v) for v in c] for c in columns)]

    listed = map_rows(listed, pack, "host string, in_article binary, in_open binary", "in_article")
    size = F.length("in_article") + F.length("in_open") + F.octet_length("host") + ROW_BYTES
    listed, n_bytes = stage(listed, "beside", size)
    listed, small = broadcast_if_small(listed, 0, n_bytes)
    if small:
        return rows.join(listed, "host", how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("url", "text"), F.lit(SALTS)).cast("int"))
    repeated = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, ["host", "salt"], how).drop("salt")


def _counted(rows: DataFrame, pick: Callable, copied: np.ndarray | None) -> DataFrame:
    """On how many distinct pages of a host and kind are the hashes that `pick(article, runs, beside)` says?

    `rows` come from `_beside`. A page that is not among the `copied` (None: any may be) is
    added up in its task; others are listed, so that each counts once.
    """
    spark = rows.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(copied)
    fields = "host string, article boolean, head bigint, page bigint, n bigint"

    def add(batches):
        held, listed, size = {}, set(), 0

        def out():
            for (host, article), heads in held.items():
                found, n = np.unique(np.concatenate(heads), return_counts=True)
                same = [pa.array([host] * len(n), pa.string()), pa.array([article] * len(n), pa.bool_())]
                same += [pa.array(found.view(np.int64)), pa.nulls(len(n), pa.int64()), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(same, names=["host", "article", "head", "page", "n"])
            held.clear()
            listed.clear()

        for hosts, texts, in_article, in_open in rows_of(batches):
            for host, article, blocks, *found in zip(hosts, *_parse(texts), in_article, in_open):
                beside = found[0 if article else 1]
                heads = _distinct(pick(article, _runs(blocks), beside)) if beside else ()
                if not len(heads):
                    continue
                page, copies = _page_hash(blocks), known.value
                size += PAGE_RUNS + len(heads)
                if copies is None or len(copies) and copies[min(np.searchsorted(copies, np.uint64(page)), len(copies) - 1)] == page:
                    if (host, article, page) in listed:
                        continue
                    listed.add((host, article, page))
                    signed = int(np.uint64(page).astype(np.int64))
                    same = [[host] * len(heads), [article] * len(heads), heads.view(np.int64), [signed] * len(heads), [1] * len(heads)]
                    types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(same, types)], names=["host", "article", "head", "page", "n"]
                    )
                else:
                    held.setdefault((host, article), []).append(heads)
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    each = rows.select("host", "text", "in_article", "in_open").mapInArrow(add, fields)
    each = each.groupBy("host", "article", "head", "page").agg(F.sum("n").alias("n"))
    n = F.when(F.col("page").isNull(), F.col("n")).otherwise(1)
    return each.groupBy("host", "article", "head").agg(F.sum(n).alias("n"))


def _wide(pages: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(pages * SHARE))


def _in_articles(pages: Column) -> Column:
    return F.greatest(F.lit(ARTICLE_PAGES), F.ceil(pages * ARTICLE_SHARE))


def _in_hot(article: bool, runs: np.ndarray, hot: bytes) -> np.ndarray:
    return runs[np.isin(_buckets(runs), np.frombuffer(hot, np.uint16))]


def _apart_from_copies(article: bool, runs: np.ndarray, shared: bytes) -> np.ndarray:
    covered = _covered(runs, _packed(shared))
    return np.array([NEAR_COPY], np.uint64) if 2 * covered.sum() > len(covered) else runs[np.isin(runs, _packed(shared))]


def shared_runs(rows: DataFrame) -> DataFrame | None:
    """Host, article and head of the runs that are boilerplate there; None if there are none.

    `rows` has host, key, url and the html as text.
    """
    sums = staged(_sums(rows), "sums")
    kinds = ["host", "article"]
    sizes = sums.groupBy(*kinds).agg(F.sum("n_pages").alias("pages")).withColumn("wide", _wide(F.col("pages")))
    sizes = sizes.withColumn("enough", F.when(F.col("article"), _in_articles(F.col("pages"))).otherwise(F.col("wide")))

    def over(hosts, articles, buckets, counts, wides, enoughs):
        hot, most = [], []
        for b, c, wide in zip(buckets, counts, wides):
            n = np.frombuffer(c, np.uint32)
            hot.append(np.frombuffer(b, np.uint16)[n >= wide].tobytes())
            most.append(int(n.max(initial=0)))
        return hosts, articles, hot, [n >= enough for n, enough in zip(most, enoughs)]

    hot = sums.join(sizes, kinds).select(*kinds, "buckets", "counts", "wide", "enough")
    hot = map_rows(hot, over, "host string, article boolean, hot binary, may boolean", "buckets").where(F.length("hot") > 0)
    hot, n_hot = stage(hot, "hot", F.col("may").cast("int"))
    if not n_hot:
        return None
    hot = hot.join(hot.where("may").select(*kinds).distinct(), kinds, "left_semi")

    some = sums.join(hot.select("host").distinct(), "host", "left_semi").where(F.length("copied") > 0)
    n_copied = some.agg(F.coalesce(F.sum(F.length("copied")), F.lit(0))).first()[0] // 8
    copied = None
    if n_copied <= KNOWN_COPIES:
        copied = np.unique(_packed(b"".join(r[0] for r in some.select("copied").collect())))  # KNOWN_COPIES at most
    counts = _counted(_beside(rows, hot, "hot", "inner"), _in_hot, copied)
    counts = counts.join(sizes, kinds).where(F.col("n") >= F.col("wide"))
    wide = staged(counts.select(*kinds, "head", (F.col("n") >= F.col("enough")).alias("enough")), "shared")
    shared = wide.where("enough").select(*kinds, "head")
    if shared.where("article").isEmpty():
        return None if shared.isEmpty() else shared

    in_articles = wide.join(shared.where("article").select(*kinds).distinct(), kinds, "left_semi")
    counts = staged(_counted(_beside(rows, in_articles, "head", "inner"), _apart_from_copies, copied), "apart")
    copies = counts.where(F.col("head") == NEAR_COPY).select("host", F.col("n").alias("copies"))
    left = counts.join(shared, [*kinds, "head"], "left_semi").join(sizes, kinds).join(copies, "host", "left")
    left = left.where(F.col("n") >= _in_articles(F.col("pages") - F.coalesce("copies", F.lit(0))))
    return left.select(*kinds, "head").union(shared.where(~F.col("article")))


def main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Key, url, text and n_chars (code points) of every row.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by one space in page order. Null and empty pages have an empty text. Pages
    of one host are compared; pages without a host form one of their own name. Pages of a
    host with equal blocks are one page there and never make each other boilerplate.
    Rows are kept one to one; other columns are not carried.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("text"), host_of(F.col(url)).alias("host")
    )
    key_type = rows.schema["key"].dataType.simpleString()
    shared = shared_runs(rows)
    if shared is None:
        beside = rows.withColumns({c: F.lit(None).cast("binary") for c in ("in_article", "in_open")})
    else:
        beside = _beside(rows, shared, "head", "left")

    def settle(keys, urls, texts, in_article, in_open):
        found = []
        for article, blocks, *of in zip(*_parse(texts), in_article, in_open):
            found.append(_without_shared(article, blocks, _packed(of[0 if article else 1])))
        return keys, urls, found

    settled = map_rows(
        beside.select("key", "url", "text", "in_article", "in_open"), settle, f"key {key_type}, url string, text string"
    )
    return settled.select(
        F.col("key").alias(key),
        F.col("url").alias("url"),
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )
