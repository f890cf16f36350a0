"""Main text of web pages by structure and what hosts repeat.

A page is read once into blocks of text.  Blocks inside ``article`` or
``main`` are its main part, without what markup names as something else (menus,
adverts, comments and so on).  All text outside, page after page of a host,
forms the host's token stream, whether its pages have a main part or not.  A
run of ``RUN`` or more tokens of that stream is boilerplate where it stands on
``LEAST`` distinct pages and on the share ``SHARE`` of the host's distinct pages.

Every page loses boilerplate.  One with a main part keeps its main blocks but
those that boilerplate covers from their first to their last token and that
are in no element of running text: a notice that other pages of the host have
outside.  A paragraph, heading, list or table of an article is its own even if
an advert says the same, what only articles share is no boilerplate, and a
block that merely quotes some stays whole.  A page without
``article`` or ``main`` keeps the runs that are left, again without what markup
names as something else.

Near copies count as one page: whole pages, main text included, are sketched by
min-hashing; sketches that meet in a band and agree in ``NEAR`` of their slots
are linked, and linked pages form a class.

Repeats are found in the host's suffix array: every place of its stream is a
suffix, sorted by host and tokens.  Tasks sort the suffixes of their pages, one
range exchange brings the sorted parts together, and neighbours in the array
that share their first ``RUN`` tokens are one repeat, counted by the classes of
its pages.  A longer repeat is a chain of such places, so no suffix is compared
beyond ``RUN`` tokens.  The class is part of the sort key, so a line that a third of
all pages share spreads over ranges and is summed from its parts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .buckets import Links, compare_dealt, deal, pairs_in_groups
from .common import discard, per_batch, spread_join, written
from .components import connected_components
from .url_filter import host_and_path

RUN = 8  # tokens that distinct pages must share
LEAST, SHARE = 3, 0.2  # distinct pages of a host that a run must stand on
SHINGLE, SLOTS, BAND = 3, 64, 4
LONG = 32  # characters up to which a token stands in a suffix as it is, else by its digest
ENTRIES = 1 << 18  # suffixes that a task sorts at a time
NEAR = 0.8  # share of equal slots from which two pages are near copies
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*(?:>|\Z)
|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
#: Words of one class token or id: ``commentList``, ``comment-list`` and ``comment_list`` alike.
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements whose content is never text of a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MAIN = {"article", "main"}
OTHER = {"nav", "aside", "footer", "form", "menu", "dialog", "template", "svg", "math", "select", "button", "head",
         "object", "canvas", "audio", "video", "map", "datalist", "fieldset"}
#: Words of class, id or role that name a part as something other than main
#: text: a token says so where one of its words stands here and the others
#: here or in ``PLACE``, so ``social-history`` says nothing.
NAMED = set("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar aside widget
related recommended breadcrumb breadcrumbs nav navbar navigation menu menubar toolbar pagination pager footer masthead
comment comments disqus respond reply replies share sharing social search searchbox complementary contentinfo
dialog alert skip hidden sr""".split())
PLACE = set("""list item items box bar wrap wrapper container content block section area part panel group holder inner
outer row col column grid link links button buttons btn icon icons form field input text title heading head header body
top bottom left right middle center main primary secondary global site page post entry article story blog user wp js is
has the of by for and to a fixed sticky floating only media tools tool thread tree reader slot unit google""".split())
#: Of these, the ones that make an ``article`` something other: one comment, advert or teaser.
NOT_ARTICLE = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies
related recommended comment comments disqus respond reply replies widget""".split())
BLOCK = MAIN | OTHER | {
    "address", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "ol", "p", "pre", "search",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements of running text: inside a main part they are its own, whatever the host repeats.
PROSE = {"blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p", "pre", "td", "th"}
#: Elements that are followed until they close: any of them may be named.
HELD = BLOCK - {"hr", "html", "body"}
#: Elements inside a block that are followed where they have attributes.
INLINE = set("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strong sub
sup time tt u var""".split())


def _names(value: str, words: set[str]) -> bool:
    """Whether a class, id or role has a token made of such ``words``."""
    for token in value.split():
        found = {w.lower() for w in NAMES.findall(token)}
        if found and not words.isdisjoint(found) and found <= words | NAMED | PLACE:
            return True
    return False


def _is_other(name: str, attrs: str, in_main: bool) -> bool:
    """Whether an element is something other than main text."""
    if name in OTHER or name == "header" and not in_main:
        return True
    if not attrs or attrs.isspace():
        return False
    words = NOT_ARTICLE if name in MAIN else NAMED if in_main else NAMED | {"header"}
    for key, *values in ATTR.findall(attrs):
        key, value = key.lower(), (values[0] or values[1] or values[2])
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                return True
        elif key != "aria-hidden" and name != "main" and _names(value, words):
            return True
    return False


def _balanced(page: str, name: str) -> bool:
    """Whether a page closes every element of this name."""
    return len(re.findall(rf"<{name}(?=[\s/>])", page, re.I)) == len(re.findall(rf"</{name}(?=[\s>])", page, re.I))


def blocks(page: str, prose: list[bool] | None = None) -> list[tuple[str, bool, bool]]:
    """``(text, in main part, something other)`` of each block in page order;
    ``prose``, if given, gets whether each stands in an element of ``PROSE``.

    Markup errors are met as browsers meet them where it matters: an end tag
    closes what is open inside it, an end tag without a start is ignored, a
    block closes the paragraph before it, and a main part closes another part
    that was left open before it.  Inside one that the page does close, it is
    part of that one: a teaser in an aside, a comment in a list of comments.
    """
    out: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    open_: list[tuple[str, bool, bool, bool]] = []  # name, and what was before: in main, other, muted
    in_main = other = muted = False  # muted: inside an inline element that is something other
    at, lower = 0, None

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append((text, in_main, other))
                if prose is not None:
                    prose.append(any(x[0] in PROSE for x in open_))

    while True:
        tag = TAG.search(page, at)
        text = page[at:tag.start() if tag else len(page)]
        if text and not muted:
            parts.append(html.unescape(text) if "&" in text else text)
        if not tag:
            break
        at = tag.end()
        name = tag["name"]
        if name is None:
            if tag["cdata"] and not muted:
                parts.append(tag["cdata"])
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            while open_ and (open_[-1][0] == "p" or open_[-1][0] in INLINE and any(x[0] == "p" for x in open_)):
                in_main, other, muted = open_.pop()[1:]  # a block ends the paragraph it stands in
        if tag["close"]:
            if name in HELD or name in INLINE:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == name:
                        if name not in INLINE:
                            flush()
                        in_main, other, muted = open_[k][1:]
                        del open_[k:]
                        break
                    if open_[k][0] in MAIN or name in INLINE and open_[k][0] in HELD:
                        break  # a stray end tag ends neither the main part nor, of an inline element, a block
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + name, at) if len(lower) == len(page) else -1
            if end < 0:
                found = re.compile("</" + name, re.I).search(page, at)
                end = found.start() if found else len(page)
            at = end
            continue
        if name in VOID or tag["attrs"].rstrip().endswith("/") and name in ("svg", "path"):
            continue
        if name in HELD:
            was = in_main, other, muted
            if name in MAIN and not in_main and not _is_other(name, tag["attrs"], False) and not (
                    other and all(_balanced(page, n) for n in {x[0] for x in open_ if x[0] in HELD} - {"p"})):
                flush()
                open_.clear()
                was = False, False, False
                in_main, other, muted = True, False, False
            elif not other and _is_other(name, tag["attrs"], in_main):
                flush()
                other = True
            open_.append((name, *was))
        elif name in INLINE and (tag["attrs"].strip() or any(x[0] == name for x in open_)):
            open_.append((name, in_main, other, muted))
            muted = muted or _is_other(name, tag["attrs"], in_main)
    flush()
    return out


_rng = np.random.default_rng(23)
_SALT = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=200_000)
def _token(token: str) -> int:
    return xxhash.xxh64_intdigest(token)


def sketch(tokens: list[str]) -> bytes:
    """Min-hash slots of 16 bits over the shingles of a page; empty without tokens."""
    if not tokens:
        return b""
    h = np.fromiter(map(_token, tokens), np.uint64, len(tokens))
    n = max(1, len(h) - SHINGLE + 1)
    acc = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(h))):
        acc = (acc ^ h[k:k + n]) * _MIX
        acc ^= acc >> np.uint64(29)
    acc = np.unique(acc)
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(acc), 1 << 12):
        least = np.minimum(least, ((acc[at:at + (1 << 12), None] ^ _SALT) * _ODD).min(axis=0))
    return (least * _MIX >> np.uint64(48)).astype("<u2").tobytes()


PARSED = ("page_id long, url string, host string, has_main boolean, main array<string>, prose array<boolean>, outside array<string>, other array<boolean>, "
          "sketch binary")
ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
         "array<boolean>": pa.list_(pa.bool_())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split(" ") for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def _parse(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The main blocks of pages, what they have outside their main parts, and sketches of the whole."""
    rows = []
    for page_id, url, page, host in zip(*(batch.column(k).to_pylist() for k in range(4))):
        marks: list[bool] = []
        found = blocks(page or "", marks)
        main = [t for t, m, o in found if m and not o]
        prose = [mark for (_, m, o), mark in zip(found, marks) if m and not o]
        outside = [(t, o) for t, m, o in found if not m]
        whole = sketch([t for block, _, _ in found for t in block.split()])
        rows.append((page_id, url, host, bool(main), main, prose, [t for t, _ in outside], [o for _, o in outside], whole))
    return _batch(rows, PARSED)


def suffixes(outside: list[str]) -> list[str]:
    """The suffixes of a page's token stream in page order, each as far as it is
    compared: its first ``RUN`` tokens.  Shorter ones at the page's end have no
    ``RUN`` tokens to share."""
    units = [t if len(t) <= LONG else "\0" + xxhash.xxh3_128_hexdigest(t) for block in outside for t in block.split()]
    return [" ".join(units[k:k + RUN]) for k in range(len(units) - RUN + 1)]


def _head(host: str, suffix: str) -> int:
    """64 bits that stand for the repeat in which ``suffix`` begins."""
    return xxhash.xxh64_intdigest(f"{host}\0{suffix}") - (1 << 63)


def _heads(host: str, outside: list[str]) -> list[int]:
    return [_head(host, s) for s in suffixes(outside)]


def _first_heads(host: str, has_main: bool, main: list[str], prose: list[bool], outside: list[str]) -> set[int]:
    """Heads by which a page is judged: of what stands outside without a main
    part, else of the beginnings of its main blocks that are not prose."""
    if not has_main:
        return set(_heads(host, outside))
    return {head for block, p in zip(main, prose) if not p for head in _heads(host, [" ".join(block.split()[:RUN])])}


def _cover(host: str, block: str) -> list[int]:
    """Heads of runs that cover a block from its first to its last token; none of a shorter one than a run."""
    heads = _heads(host, [block])
    return heads[::RUN] + heads[-1:]


def _cover_heads(host: str, main: list[str], prose: list[bool], known: list[int]) -> set[int]:
    """Heads that cover the main blocks which begin with a known repeat."""
    covers = (_cover(host, block) for block, p in zip(main, prose) if not p)
    return {head for cover in covers if cover and cover[0] in known for head in cover}


def _kept_main(host: str, main: list[str], prose: list[bool], repeated: set[int]) -> str:
    """Main blocks but those that are not prose and that the host's repeats cover from end to end."""
    if not repeated:
        return "\n".join(main)
    covers = ((block, [] if p else _cover(host, block)) for block, p in zip(main, prose))
    return "\n".join(block for block, cover in covers if not cover or not repeated.issuperset(cover))


SUFFIXES = "host string, suffix string, class long"
REPEATS = "host string, head long, n long"


def _sorted_suffixes(batches):
    """Sorted suffixes of a task's pages ``(host, class, outside)``, those of equal
    tokens once for each class."""
    types = (pa.string(), pa.string(), pa.int64())

    def array_of(found: set[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sorted(found)), types)], ["host", "suffix", "class"])

    found: set[tuple] = set()
    for batch in batches:
        for host, group, outside in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for suffix in suffixes(outside):
                found.add((host, suffix, group))
                if len(found) >= ENTRIES:
                    yield array_of(found)
                    found = set()
    if found:
        yield array_of(found)


def _repeats(batches):
    """Repeats of one range of the suffix array and the number of their classes.

    What stands on fewer than ``LEAST`` is left out, but for the first and the
    last repeat of the range, which may go on in the ranges beside it.
    """
    rows: list[tuple] = []
    at, last, n, first = None, None, 0, True

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                                          ["host", "head", "n"])

    for batch in batches:
        for host, suffix, group in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if at == (host, suffix):  # RUN tokens in common with the one before
                n += group != last
            else:
                if at and (first or n >= LEAST):
                    rows.append((at[0], _head(*at), n))
                first = at is None
                at, n = (host, suffix), 1
            last = group
        if rows:
            yield batch_of()
            rows.clear()
    if at:
        rows.append((at[0], _head(*at), n))
        yield batch_of()


def unique_runs(outside: list[str], other: list[bool], heads: list[int], repeated: set[int]) -> str:
    """Blocks of a page without the tokens that repeated heads cover."""
    n = len(heads) + RUN - 1 if heads else 0
    covered = bytearray(max(n, sum(len(b.split()) for b in outside)))
    for k, head in enumerate(heads):
        if head in repeated:
            covered[k:k + RUN] = b"\1" * RUN
    out, at = [], 0
    for block, is_other in zip(outside, other):
        tokens = block.split()
        left = [t for k, t in enumerate(tokens, at) if not covered[k]]
        at += len(tokens)
        if left and not is_other:
            out.append(" ".join(left))
    return "\n".join(out)


def _near(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
    ids = rows["id"].to_numpy()
    x = np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u2").reshape(len(ids), SLOTS)
    links = Links(len(ids))
    for i, j in pairs_in_groups(group):
        for at in range(0, len(i), 1 << 14):
            p, q = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
            ok = (x[p] == x[q]).sum(axis=1) >= NEAR * SLOTS
            links.add(p[ok], q[ok])
    label = links.fold()
    at = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[label[at]])], ["a", "b"])


def _page_key() -> Column:
    """16 bytes that stand for a page's host and sketch."""
    return F.unhex(F.md5(F.concat(F.col("host").cast("binary"), F.lit(b"\0"), F.col("sketch"))))


def near_links(distinct: DataFrame) -> DataFrame:
    """``(a, b)`` that span the near copies among a written ``(id, host, sketch)``.
    Bands move as keys and ids; a sketch moves once by its id, then only to the
    bands that it shares."""
    bands = [F.xxhash64("host", F.lit(b), F.expr(f"substring(sketch, {2 * BAND * b + 1}, {2 * BAND})")) for b in range(SLOTS // BAND)]
    keyed = distinct.select(F.explode(F.array(*bands)).alias("k"), "id")
    return compare_dealt(deal(keyed).join(distinct.select("id", "sketch"), "id"), _near, "a long, b long")


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``(key, host, class)`` of ``(row, host, sketch)``: sketches of a host
    that are linked as near copies, directly or through others, are one class."""
    distinct = written(pages.where("length(sketch) > 0").groupBy(_page_key().alias("key"))
                       .agg(F.min("row").alias("id"), F.any_value("host").alias("host"), F.any_value("sketch").alias("sketch")), "sketches")
    comps = connected_components(near_links(distinct))
    classes = written(distinct.join(comps, F.col("id") == F.col("node"), "left")
                      .select("key", "host", F.coalesce("component", "id").alias("class")), "classes")
    discard(distinct)
    return classes


def host_repeats(pages: DataFrame) -> DataFrame:
    """``(host, head, n)``: the repeats in the suffix array of each host, and on
    how many classes they stand, from ``(host, class, outside)``."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "suffix", "class"]
    array = pages.select("host", "class", "outside").mapInArrow(_sorted_suffixes, SUFFIXES).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return (array.mapInArrow(_repeats, REPEATS).groupBy("host", "head").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST))


def boilerplate(pages: DataFrame) -> DataFrame:
    """A written ``(head)`` of the repeats that stand on enough distinct pages
    of their host, from a written ``(row, host, sketch, outside)``."""
    classes = distinct_pages(pages)
    of_host = classes.select("host", "class").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    # host and sketch as one key: a third of all pages may be copies of one
    marked = spread_join(pages.where("length(sketch) > 0").select(_page_key().alias("key"), "host", "outside"), classes.select("key", "class"), "key")
    heads = written(host_repeats(marked).join(of_host, "host").where(F.col("n") >= SHARE * F.col("of")).select("head"), "boilerplate")
    discard(classes)
    return heads


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row.

    A null page has an empty text; a null url is a host of its own (the empty
    one); rows repeat as they come, and neither equal pages nor near copies
    make each other boilerplate; other columns are ignored; an empty table
    gives an empty one.
    """
    raw = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_and_path(F.coalesce(F.col(url_col), F.lit("")))[0].alias("host"))
    parsed = written(raw.mapInArrow(per_batch(_parse), PARSED).withColumn("row", F.monotonically_increasing_id()), "pages", "zstd")
    repeated = boilerplate(parsed)

    def repeated_of(rows: DataFrame, heads: Callable[..., set[int]]) -> DataFrame:
        """A written ``(row, repeated)``: the repeats among the heads of each page."""
        def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            found = [(row, head) for row, *page in zip(*(c.to_pylist() for c in batch.columns)) for head in heads(*page)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["row", "head"]) if found else None

        all_heads = written(rows.mapInArrow(per_batch(of_batch), "row long, head long"), "heads")
        out = written(spread_join(all_heads, repeated, "head").groupBy("row")
                      .agg(F.collect_set("head").alias("repeated")), "repeated")  # at most a page's own heads
        discard(all_heads)
        return out

    known = repeated_of(parsed.select("row", "host", "has_main", "main", "prose", "outside"), _first_heads)
    # main blocks that begin with a repeat are looked at whole
    begun = parsed.where("has_main").select("row", "host", "main", "prose").join(known, "row")
    covered = (known.unionByName(repeated_of(begun, _cover_heads))
               .groupBy("row").agg(F.flatten(F.collect_list("repeated")).alias("repeated")))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for host, has_main, main, prose, outside, other, heads in zip(*(batch.column(k).to_pylist() for k in range(2, 9))):
            heads = set(heads or [])
            texts.append(_kept_main(host, main, prose, heads) if has_main else
                         unique_runs(outside, other, _heads(host, outside) if heads else [], heads))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    out = (parsed.join(covered, "row", "left").select("page_id", "url", "host", "has_main", "main", "prose", "outside", "other", "repeated")
           .mapInArrow(per_batch(cut), "page_id long, url string, text string"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op1(pages: DataFrame) -> DataFrame:
    """Main text of every ``pages`` row, in the contract's columns; see
    ``main_text`` for nulls, repeated rows and empty tables.  Pages of any length
    are read whole."""
    return main_text(pages)
