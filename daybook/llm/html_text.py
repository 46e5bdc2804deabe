"""Main text of web pages, by deducing the template of every host from its pages.

1. Every page is read into tokens: the path of each element with its name, id and classes, and each block of text at its path.
2. Tokens of a host that occur equally often in the same pages form an equivalence class. The vector of occurrences is kept as a
   fingerprint that can be added up in any order (an exclusive or over pages of a hash of page and count), so a host with a third of
   all pages is counted within tasks first and no page is sent anywhere.
3. Classes in at least ``SHARE`` of a host's pages make its template, nested by their paths. Its root class holds the elements that occur once in
   each page. Descending through them into the one whose text varies most between pages leads to the slot of the article.
   Blocks whose very text is a token in ``TEXT_SHARE`` of at least ``TEXT_MIN_PAGES`` pages are boilerplate, but never inside an ``article`` or
   ``main`` element, nor where they are the larger part of a page's slot: then the article is itself repeated.
4. A page's text is what remains in that slot: blocks outside of menus, headers, footers, sidebars, notices, adverts, forms and comments, and not
   part of the template. An element that only a word in its id, class or role puts aside is a wrapper, and stays, if it holds most of the page's text.

Hosts with fewer than ``MIN_PAGES`` pages, and pages without their host's slot, are read by their own ``article`` or ``main`` element, or
else the body. Templates hold at most ``1 / SHARE`` times the tokens of a page; they are broadcast only below ``BROADCAST_BYTES``, beyond that joined.

A null or empty page has an empty text. Null addresses count as one host. Repeated rows are reported each and count as pages each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import store, tidy

SHARE = 0.6
MIN_PAGES = 5
TEXT_SHARE = 0.8
TEXT_MIN_PAGES = 10
WRAPPER = 0.8
BROADCAST_BYTES = 32 << 20

# fixed values: elements of HTML by their role
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object select canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "head"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
ASIDE = set("nav footer aside form menu dialog button head label search".split())
# fixed values: words in ids, classes and roles of parts that are not the article
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus feedback footer gdpr masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted "
    "promotion recommended related replies reply respond share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets contentinfo complementary search dialog alert alertdialog".split()
)
HEADER_WORDS = {"header", "masthead"}
COMMENT_WORDS = set("comment comments commentlist disqus replies reply respond".split())
# words that tell the state of an element, not what it is
STATE_WORDS = set("has have with without no not is on off open opened closed enabled disabled allowed active".split())

# names and attributes are read once each and not given back, so that a tag without an end costs no more than its length
TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
UNCLOSED = re.compile(r"<[!?]")
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
WORD = re.compile(r"[a-z]+")


class Block:
    """A block of text. ``hard``: in a part that its element names or hides; ``soft``: the numbers of the elements around it that only a word puts aside."""

    __slots__ = ("path", "text", "hard", "soft", "aside", "inside")

    def __init__(self, path: str, text: str, hard: bool, soft: tuple[int, ...], inside: bool):
        self.path, self.text, self.hard, self.soft, self.inside = path, text, hard, soft, inside
        self.aside = hard or bool(soft)


def judge(blocks: list[Block], whole: set[int]) -> None:
    """Elements that only a word puts aside are wrappers, not aside, if they hold ``WRAPPER`` of a page's text, or at least half of it in an
    article opened in them. Those in ``whole``, named by the bare word, are none."""
    total, held, articles = 0, {}, {}
    for block in blocks:
        if not block.hard:
            total += len(block.text)
            for number in block.soft:
                held[number] = held.get(number, 0) + len(block.text)
                articles[number] = articles.get(number, 0) + (len(block.text) if block.inside > number else 0)
    wrappers = {n for n in held if n not in whole and (held[n] >= WRAPPER * total or articles[n] * 2 >= total)}
    for block in blocks:
        block.aside = block.hard or any(n not in wrappers for n in block.soft)


def blocks_of(page: str) -> tuple[list[Block], dict[str, int]]:
    """The blocks of text of a page in order, and how often each element path occurs."""
    # name, path, hard and soft as in a block, number of the outermost article around it
    stack: list[tuple[str, str, bool, tuple[int, ...], int]] = [("", "", False, (), 0)]
    whole: set[int] = set()
    opened = 0
    blocks: list[Block] = []
    counts: dict[str, int] = {}
    parts: list[str] = []
    at, size = 0, len(page)
    last = page.rfind(">") + 1  # no tag ends after this; only there are tags sought

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(stack[-1][1], text, *stack[-1][2:]))
            parts.clear()

    def pop(names: set[str], stop: set[str]) -> None:
        """Close the innermost open element of these names, unless one of ``stop`` is opened after it."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    while at < size:
        found = TAG.search(page, at, last)
        if found is None:
            rest = UNCLOSED.search(page, max(at, last))
            parts.append(page[at : rest.start() if rest else size])
            break
        parts.append(page[at : found.start()])
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            break
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*+>", re.I).search(page, at, last)
                at = end.end() if end else size
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in VOID and name != "hr" or name not in BLOCK:
            continue
        if closing:
            if name == "p" and stack[-1][0] != "p":
                flush()
            pop({name}, set())
            continue
        flush()
        if name in CLOSES_P:
            pop({"p"}, BLOCK - {"p"})
        if name in SIBLINGS:
            pop(SIBLINGS[name], {"ul", "ol", "dl", "table", "menu"} | ({"tr"} if name in ("td", "th") else set()))
        if name == "hr":
            continue
        own = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
        label = " ".join(own.get(k, "") for k in ("id", "class", "role"))
        words = set(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower())) if label.strip() else set()
        _, path, hard, soft, inside = stack[-1]
        opened += 1
        if name == "main" or own.get("role") == "main":
            soft = ()
        if name in ("article", "main") or own.get("role") == "main":
            inside = inside or opened
        # a header inside the article is its heading
        named = words & (ASIDE_WORDS - (HEADER_WORDS if inside else set())) or (words & HEADER_WORDS if not inside else set())
        if name in ASIDE or (not inside and name == "header"):
            hard = True
        elif named and name not in ("html", "body", "article", "main") and own.get("role") != "main":
            soft = (*soft, opened)
            if any(t in named for t in label.lower().split()) or (named & COMMENT_WORDS and not words & STATE_WORDS):
                whole.add(opened)
        if "hidden" in own.get("style", "").replace(" ", "") and "visibility:hidden" in own.get("style", "").replace(" ", "") or "display:none" in own.get("style", "").replace(" ", ""):
            hard = True
        path = f"{path}/{name}" + (f".{'.'.join(sorted(words))}" if words else "")
        counts[path] = counts.get(path, 0) + 1
        stack.append((name, path, hard, soft, inside))
    flush()
    judge(blocks, whole)
    return blocks, counts


def hashed(*parts) -> int:
    """A 64-bit hash of texts, the same in all processes."""
    import xxhash

    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, page key, html) to (host, token, path or null, pages, single, vector, chars), summed per batch.

    ``single`` counts pages where the token occurs once; ``chars`` is the length of the text below an element.
    """
    for batch in batches:
        found: dict[tuple, list] = {}
        for host, key, page in zip(*[c.to_pylist() for c in batch.columns]):
            blocks, counts = blocks_of(page or "")
            lengths: dict[str, int] = {}
            texts: dict[tuple[str, str], int] = {}
            for block in blocks:
                texts[block.path, block.text] = texts.get((block.path, block.text), 0) + 1
                if not block.aside:
                    path = block.path
                    while path:
                        lengths[path] = lengths.get(path, 0) + len(block.text)
                        path = path.rpartition("/")[0]
            for path, count in counts.items():
                entry = found.setdefault((host, hashed(path), path), [0, 0, 0, 0])
                entry[0] += 1
                entry[1] += count == 1
                entry[2] ^= hashed(key, count)
                entry[3] += lengths.get(path, 0)
            for (path, text), count in texts.items():
                entry = found.setdefault((host, hashed(path, text), None), [0, 0, 0, 0])
                entry[0] += 1
                entry[1] += count == 1
                entry[2] ^= hashed(key, count)
                entry[3] += len(text) * count
        names = list(found)
        values = list(found.values())
        signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.int64()), pa.array([n[2] for n in names], pa.string()),
                pa.array([v[0] for v in values], pa.int64()), pa.array([v[1] for v in values], pa.int64()),
                pa.array([signed(v[2]) for v in values], pa.int64()), pa.array([v[3] for v in values], pa.int64()),
            ],
            names=["host", "token", "path", "pages", "single", "vector", "chars"],
        )


def templates(pages: DataFrame, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, slot, boilerplate) of hosts with enough pages: the path of the article and the tokens of repeated blocks.

    ``pages`` has host, key and html.
    """
    shape = "host string, token long, path string, pages long, single long, vector long, chars long"
    tokens = pages.mapInArrow(lambda batches: tidy(_tokens(batches)), shape).groupBy("host", "token", "path").agg(
        F.sum("pages").alias("pages"), F.sum("single").alias("single"), F.bit_xor("vector").alias("vector"), F.sum("chars").alias("chars")
    )
    sizes = pages.groupBy("host").count().where(F.col("count") >= min_pages).withColumnRenamed("count", "of")
    same_host = F.col("host").eqNullSafe(F.col("its_host"))
    frequent = tokens.where(F.col("pages") >= F.lit(min_pages) * share).join(sizes.withColumnRenamed("host", "its_host"), same_host).drop("its_host")
    frequent = store(frequent.where(F.col("pages") >= F.col("of") * share), "html-template")
    # equivalence classes: tokens of a host with one vector of occurrences
    classes = frequent.groupBy(F.col("host").alias("its_host"), F.col("vector").alias("its_vector")).agg(F.count(F.lit(1)).alias("members"))
    member = frequent.join(classes, same_host & (F.col("vector") == F.col("its_vector"))).drop("its_host", "its_vector")
    # a class of one block of text is no template unless nearly all pages have it
    common = (F.col("pages") >= F.col("of") * TEXT_SHARE) & (F.col("of") >= TEXT_MIN_PAGES)
    return member.where(F.col("path").isNotNull() | (common & ((F.col("members") > 1) | (F.col("pages") == F.col("of"))))).groupBy("host").agg(
        F.collect_list(F.when(F.col("path").isNotNull() & (F.col("single") >= F.col("of") * share), F.struct("path", "chars"))).alias("elements"),
        F.collect_list(F.when(F.col("path").isNull(), F.col("token"))).alias("boilerplate"),
    ).select("host", _slot(F.col("elements")).alias("slot"), "boilerplate")


def _slot(elements):
    """The deepest element of the template that holds four fifths of the text of the body."""
    most = F.coalesce(F.array_max(F.transform(elements, lambda e: e["chars"])), F.lit(0))
    holding = F.filter(elements, lambda e: (e["chars"] * 5 >= most * 4) & (e["chars"] > 0))
    depth = lambda e: F.struct(F.size(F.split(e["path"], "/")).alias("depth"), e["path"].alias("path"))
    return F.array_max(F.transform(holding, depth))["path"]


def main_text(page: str, slot: str | None, boilerplate: set[int]) -> str:
    """The text of the article of a page."""
    blocks, counts = blocks_of(page)
    wanted = [b for b in blocks if not b.aside] or [b for b in blocks if not b.hard]
    if slot and slot in counts:
        chosen = [b for b in wanted if b.path == slot or b.path.startswith(slot + "/")]
        if any(b.inside for b in chosen):
            chosen = [b for b in chosen if b.inside]
    else:
        chosen = [b for b in wanted if b.inside] or wanted
    kept = [b for b in chosen if b.inside or hashed(b.path, b.text) not in boilerplate] if boilerplate else []
    # what repeated blocks mostly consist of is an article found on other pages too
    if 2 * sum(len(b.text) for b in kept) < sum(len(b.text) for b in chosen):
        kept = chosen
    return "\n\n".join(b.text for b in kept)


def _extracted(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(page or "", slot, set(boilerplate or ()))
            for page, slot, boilerplate in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4)])
        ]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per page: id, address, text and its length in code points."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = pages.sparkSession
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    host = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", 1))
    keyed = rows.withColumn("host", host)
    learned = store(templates(keyed.select("host", F.xxhash64("id", "url").cast("string").alias("key"), "html")), "html-hosts")
    size = learned.agg(F.sum(F.size("boilerplate") * 8 + F.length("slot") + F.length("host") + 64)).first()[0] or 0
    side = learned.withColumnRenamed("host", "its_host")
    if size <= BROADCAST_BYTES:
        side = F.broadcast(side)
    joined = keyed.join(side, F.col("host").eqNullSafe(F.col("its_host")), "left").select("id", "url", "html", "slot", "boilerplate")
    kind = rows.schema["id"].dataType.simpleString()
    shape = spark.createDataFrame([], f"`{id_column}` {kind}, `{url_column}` string, text string, n_chars long").schema
    arrow = to_arrow_schema(shape)
    return joined.mapInArrow(lambda batches: tidy(_extracted(batches, arrow)), shape)
