"""Main-text extraction by equivalence-class template deduction.

Pages of a host share a template. Every page is read as tokens that know
their place: start tags and whole text runs, each with the path of open
elements. Two tokens of a host belong to one equivalence class if their
occurrence vectors over the host's pages are equal; a vector is carried as
its support and a 64-bit hash, both of which add up over pages in any order,
so a host's pages never meet in one task. Classes of enough tokens that occur
on enough of the host's pages are valid; their tokens make the host's
template. Pages of a host with the same text have one vote together, in
support as in the host's size, so copies of a page are no template.

Template elements nest by their paths. A page's text that is no template token
fills slots: a slot is the innermost open template element and the template
token last met in it. Over a host's pages a slot is known by what it holds:
how much text that differs between pages, how much of it in links, its place,
and, as a prior, whether it lies in ``article`` or ``main`` and whether class
names call it an advert, menu or the like. The slots that hold most make the
main region; the text is what fills them, with all runs inside ``article`` or
``main`` when these win. A host of too few pages to have a template goes by
the tags alone: ``article`` or ``main`` if there is one, else the body.

By their meaning in HTML, scripts, styles, forms and controls, ``nav``,
``aside``, ``footer`` and page ``header`` elements are never content. A class
name leaves an element out only if most of its telling names are such, and
never an article, paragraph or heading.

Character references are decoded run by run, white space inside a block
becomes one space, blocks are joined by a line break. Null or empty html gives
an empty text; an unclosed tag, comment or script reaches to the end. Pages
without a host share one template. Very long pages are read whole. Repeated
pages give a row each. Other columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, mix64, text_batches, written

#: A valid class has so many tokens, on so many pages and this share of its host's pages.
CLASS_TOKENS, CLASS_PAGES, CLASS_SHARE = 2, 8, 0.8
#: Tokens a task counts before it sends partial counts on.
FLUSH_TOKENS = 300_000
#: Bytes (counted) up to which the hosts' rows are broadcast.
BROADCAST_BYTES = 32 << 20

#: Weight of slots in ``article`` or ``main``, and of slots that class names mark.
MAIN_PRIOR, HINT_PRIOR = 8.0, 0.1
#: Slots of the main region hold this share of what the best slot holds; headings less.
SLOT_SHARE = 0.15

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\b[^>]*>|\Z)|"
    # a quote opens a value only after an equals sign
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_WORD = re.compile(r"[a-z0-9]+")

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("""head script style noscript template nav aside footer form button select textarea iframe svg object
menu dialog""".split())
HINTS = frozenset("""ad ads advert advertisement advertising banner promo sponsor sponsored cookie cookies consent notice gdpr nav
navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus share sharing social related newsletter
subscribe popup modal pagination pager widget toolbar login signup search complementary contentinfo header""".split())
#: Parts of a class name that say nothing: layout words, with which a hint stays one.
NEUTRAL = frozenset("""area articles bar block bottom box class col column container content element footer full global group grid id inner
item items l large left links list lg md outer page panel post posts primary right row secondary section site sm small space text the
top unit wrap wrapper xl xs zone""".split())
#: Class names never leave these out.
OWN_TAGS = frozenset("html body main article p h1 h2 h3 h4 h5 h6 b i em strong span a td th tr table tbody li blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3".split())
# start tags that end open elements up to a scope: (ended, scope)
_P_SCOPE = frozenset("caption html table td th object template button".split())
_CELLS = frozenset(("td", "th"))
IMPLIED = {"li": (frozenset(("li",)), frozenset("ul ol menu dir".split())), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
           "dd": (frozenset(("dt", "dd")), frozenset(("dl",))), "td": (_CELLS, frozenset(("tr", "table"))), "th": (_CELLS, frozenset(("tr", "table"))),
           "tr": (frozenset(("tr",)), frozenset(("table",))), "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
           "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",)))}
IMPLIED |= {t: (frozenset(("thead", "tbody", "tfoot", "tr")), frozenset(("table",))) for t in ("thead", "tbody", "tfoot")}


def _close(stack: list, ended: frozenset, scope: frozenset) -> None:
    """End the innermost open element of ``ended``, if none of ``scope`` lies inside of it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in ended:
            del stack[i:]
            return
        if stack[i][0] in scope:
            return


def hinted(names: list[str]) -> bool:
    """Whether most of an element's telling class names, ids and roles mark it as no content."""
    bad = told = 0
    for name in names:
        words = [w for w in _WORD.findall(name) if not w.isdigit()]
        telling = [w for w in words if w in HINTS or w not in NEUTRAL]
        if telling:
            told += 1
            bad += all(w in HINTS for w in telling)
    return 2 * bad > told


class Token(NamedTuple):
    """``kind``: ``tag`` for a start tag, ``text`` for a run of text, ``break``
    where a block begins or ends, ``space`` for a line break; the path of open
    elements, and what is known of the place: left out, called no content by a
    class name, in ``article`` or ``main``, in a link, in a heading."""
    kind: str
    path: str
    text: str = ""
    out: bool = False
    hint: bool = False
    main: bool = False
    link: bool = False
    heading: bool = False


def page_tokens(page: str) -> Iterator[Token]:
    # tag, path, left out, hinted, in main, in a link, in a heading
    stack: list[tuple] = [("", "", False, False, False, False, False)]
    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            _, path, *state = stack[-1]
            yield Token("text", path, text, *state)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            if tag in BLOCKS:
                yield Token("break", stack[-1][1])
            continue
        block = tag in BLOCKS
        if tag in IMPLIED:
            _close(stack, *IMPLIED[tag])
        elif block:  # ends an open paragraph
            _close(stack, frozenset(("p",)), _P_SCOPE)
        if block or tag == "br":
            yield Token("break" if block else "space", stack[-1][1])
        _, path, out, hint, main, link, heading = stack[-1]
        names, hidden, role = [], False, False
        if attrs := m["attrs"]:
            for a, x, y, z in _ATTR.findall(attrs):
                a = a.lower()
                hidden |= a == "hidden"
                if a in ("class", "id", "role"):
                    got = (x or y or z).lower().split()
                    names += got
                    role |= a == "role" and "main" in got
        here = f"{path}/{tag}" + (f".{'.'.join(names)}" if names else "")
        yield Token("tag", here, "", out, hint, main, link, heading)
        if tag in VOID:
            continue
        inside = main
        main = main or role or tag in ("article", "main")
        if main and not inside:
            hint = False  # a wrapper named after its sidebar still holds the main region
        out = out or hidden or tag in LEFT_OUT or tag == "header" and not main
        hint = hint or tag not in OWN_TAGS and not role and hinted(names)
        stack.append((tag, here, out, hint, main, link or tag == "a", heading or tag in HEADINGS))


def _run(text: str) -> str:
    return " ".join((_html.unescape(text) if "&" in text else text).split())


def _key(path: str, run: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\x00{run}")


class Region(NamedTuple):
    """What is known of a host: its template tokens, the slots of its main
    region, and whether that is the ``article`` and ``main`` elements' content."""
    template: frozenset[int] = frozenset()
    slots: frozenset[int] = frozenset()
    by_tag: bool = True


def slots_of(tokens: Iterable[Token], template: frozenset[int]) -> Iterator[tuple[Token, int]]:
    """Each token with the slot that it stands in; 0 for template tokens and before the first of them."""
    last: list[tuple[str, int, int]] = [("", 0, 0)]  # open template elements: path, key, last template token in it
    for t in tokens:
        if t.kind not in ("text", "tag", "break"):
            yield t, mix_slot(*last[-1][1:])
            continue
        while last[-1][0] and t.path != last[-1][0] and not t.path.startswith(last[-1][0] + "/"):
            last.pop()
        if t.kind == "break":
            yield t, 0
            continue
        run = _run(t.text) if t.kind == "text" else ""
        key = _token_key(t.kind, t.path, run) if t.kind == "tag" or run else 0
        if key and key in template:
            if t.kind == "tag":
                if last[-1][0] == t.path:  # a sibling of the same path
                    last.pop()
                path, own, _ = last[-1]
                last[-1] = (path, own, key)
                last.append((t.path, key, key))
            else:
                path, own, _ = last[-1]
                last[-1] = (path, own, key)
            yield t, 0
        else:
            yield t, mix_slot(*last[-1][1:])


def mix_slot(element: int, token: int) -> int:
    return (element * 0x9E3779B97F4A7C15 + token + 1) & (2**64 - 1)


def main_text(page: str | None, region: Region = Region()) -> str:
    """The text of the page's main region; where none of the host's slots is
    on the page, what the tags say."""
    if not page:
        return ""
    if not region.by_tag and (text := _main_text(page_tokens(page), region)[0]):
        return text
    text, main = _main_text(page_tokens(page))
    if main or not region.template:
        return text
    return _main_text(page_tokens(page), region._replace(by_tag=True))[0]


def _main_text(tokens: Iterable[Token], region: Region = Region()) -> tuple[str, bool]:
    """The text, and whether it is that of ``article`` or ``main`` elements."""
    blocks: list[tuple[bool, str]] = []
    parts: list[str] = []
    inside = False  # whether the open block lies in article or main

    def end():
        if parts and (t := " ".join("".join(parts).split())):
            blocks.append((inside, t))
        parts.clear()

    placed = slots_of(tokens, region.template) if region.template else ((t, 0) for t in tokens)
    for t, slot in placed:
        if t.kind == "text":
            if t.out:
                continue
            if region.by_tag:
                if t.hint or region.template and not t.main and not slot:
                    continue
            elif slot not in region.slots:
                continue
            if t.main != inside:
                end()
                inside = t.main
            parts.append(_html.unescape(t.text) if "&" in t.text else t.text)
        elif t.kind == "break":
            end()
        elif t.kind == "space":
            parts.append(" ")
    end()
    main = region.by_tag and any(m for m, _ in blocks)
    return "\n".join(t for m, t in blocks if m or not main), main


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _token_key(kind: str, path: str, run: str) -> int:
    """Keys of text runs are odd, of tags even."""
    return (_key(path, run) | 1) if kind == "text" else _key(path, "") & ~1


def _chunks(names: bool):
    """Partial counts of a task's pages: (host, token, pages, vector), token
    null for the host's number of pages. With ``names``, (host, token, path,
    run) of tokens with the class share in some chunk instead: a token that
    has it among all the host's pages has it in one chunk at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, row = TaskContext.get().partitionId(), 0
        seen: dict[tuple[str, int], list] = {}
        pages: dict[str, int] = {}

        def flush():
            if names:
                own = [(h, _signed(t), x[2], x[3]) for (h, t), x in seen.items() if x[0] >= CLASS_SHARE * pages[h]]
                out = pa.RecordBatch.from_arrays([pa.array([o[i] for o in own], pa.int64() if i == 1 else pa.string()) for i in range(4)],
                                                 names=["host", "token", "path", "run"])
            else:
                out = pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in seen] + list(pages), pa.string()), pa.array([_signed(t) for _, t in seen] + [None] * len(pages), pa.int64()),
                     pa.array([x[0] for x in seen.values()] + list(pages.values()), pa.int64()),
                     pa.array([_signed(x[1]) for x in seen.values()] + [0] * len(pages), pa.int64())], names=["host", "token", "pages", "vector"])
            seen.clear(), pages.clear()
            return out

        for b in batches:
            for host, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                row += 1
                pages[host] = pages.get(host, 0) + 1
                found: dict[int, list] = {}
                for t in page_tokens(page.as_py() or ""):
                    if t.kind == "tag" or t.kind == "text" and _run(t.text):
                        got = found.setdefault(_token_key(t.kind, t.path, _run(t.text)), [0, t.path, _run(t.text)])
                        got[0] += 1
                own = int(mix64(np.array([(part << 40) + row], np.uint64))[0])
                for t, (n, path, text) in found.items():
                    v = (own * (2 * n + 1)) & (2**64 - 1)
                    if (got := seen.get((host, t))) is None:
                        seen[host, t] = [1, v, path, text] if names else [1, v]
                    else:
                        got[0] += 1
                        got[1] ^= v
                if len(seen) > FLUSH_TOKENS:
                    yield flush()
        if pages:
            yield flush()
    return run


def _ballots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, region, row, tokens, counts) of a task's pages: a hash of the
    main region, a number of the row, and how often each token occurs. Most
    pages that repeat a main region of the task are left out already."""
    from pyspark import TaskContext
    row = TaskContext.get().partitionId() << 40
    seen: set[tuple[str, int]] = set()
    for b in batches:
        out: list[tuple] = []
        for host, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            row += 1
            tokens = list(page_tokens(page.as_py() or ""))
            region = _signed(xxhash.xxh64_intdigest(_main_text(tokens)[0]))
            if (host, region) in seen:
                continue
            if len(seen) >= FLUSH_TOKENS:
                seen.clear()
            seen.add((host, region))
            found: dict[int, int] = {}
            for t in tokens:
                if t.kind == "tag" or t.kind == "text" and _run(t.text):
                    key = _signed(_token_key(t.kind, t.path, _run(t.text)))
                    found[key] = found.get(key, 0) + 1
            out.append((host, region, row, list(found), list(found.values())))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kinds[i]) for i in range(5)],
                                         names=["host", "region", "row", "tokens", "counts"])


def _votes(src: DataFrame) -> DataFrame:
    """(host, token, support, vector) with one vote for each main region of a
    host, token null for the host's number of votes."""
    text_batches(src.sparkSession)
    ballots = written(src.mapInArrow(lean(_ballots), "host string, region long, row long, tokens array<long>, counts array<int>"), "ballots")
    # tasks sent a main region once or so: of these rows the first one votes
    first = ballots.groupBy("host", "region").agg(F.min("row").alias("row")).select("row")
    votes = ballots.join(first, "row", "left_semi")
    each = votes.select("host", "region", F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
    tokens = each.groupBy("host", F.col("t.tokens").alias("token")).agg(
        F.count("*").alias("support"), F.bit_xor(F.xxhash64("region", "t.counts")).alias("vector"))
    hosts = ballots.select("host", "region").distinct().groupBy("host").agg(F.count("*").alias("support"))
    return (tokens.filter(F.col("support") >= CLASS_PAGES)
            .unionByName(hosts.select("host", F.lit(None).cast("long").alias("token"), "support", F.lit(0).cast("long").alias("vector"))))


def classes(pages: DataFrame, by_region: bool = False) -> DataFrame:
    """(host, class, support, pages, tokens) of the valid equivalence classes;
    ``by_region``: main regions of a host are counted, not its pages."""
    src = pages.select(host_of(F.col("url")).alias("host"), "html")
    if by_region:
        sums = written(_votes(src), "tokens")
    else:
        sums = written(src.mapInArrow(_chunks(False), "host string, token long, pages long, vector long")
                       .groupBy("host", "token").agg(F.sum("pages").alias("support"), F.bit_xor("vector").alias("vector"))
                       .filter(F.col("token").isNull() | (F.col("support") >= CLASS_PAGES)), "tokens")
    hosts = sums.filter("token is null").select("host", F.col("support").alias("pages"))
    frequent = sums.filter("token is not null").join(hosts, "host").filter(F.col("support") >= CLASS_SHARE * F.col("pages"))
    # a host's frequent tokens number (mean tokens of a page) / share at most
    return (frequent.groupBy("host", "pages", "support", "vector").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
            .filter(F.size("tokens") >= CLASS_TOKENS)
            .select("host", F.xxhash64("vector", "support").alias("class"), "support", "pages", "tokens"))


def templates(pages: DataFrame) -> DataFrame:
    """``classes`` with the tokens' (path, run) and the nesting: ``parent`` is
    the valid class of the host whose root most closely encloses the class."""
    src = pages.select(host_of(F.col("url")).alias("host"), "html")
    named = src.mapInArrow(_chunks(True), "host string, token long, path string, run string").dropDuplicates(["host", "token"])
    rows = classes(pages).withColumn("token", F.explode("tokens")).join(named, ["host", "token"])
    numbered = written(rows.groupBy("host", "class", "support", "pages")
                       .agg(F.sort_array(F.collect_list(F.struct("path", "run"))).alias("tokens"))
                       .withColumn("root", F.element_at("tokens", 1)["path"]), "classes")
    outer = numbered.select("host", F.col("class").alias("outer"), F.col("root").alias("outer_root"))
    nested = (numbered.join(outer, "host").filter((F.col("class") != F.col("outer")) & F.col("root").startswith(F.concat("outer_root", F.lit("/"))))
              .groupBy("host", "class").agg(F.max_by("outer", F.length("outer_root")).alias("parent")))
    return numbered.join(nested, ["host", "class"], "left").select("host", "class", "parent", "support", "pages", "tokens")


SLOT = "host string, slot long, words long, links long, main boolean, hint boolean, heading boolean, place long, text long"


def _fillings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What fills the slots of a task's pages (host, html, template), repeats of the task left out."""
    seen: set[tuple] = set()
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    for b in batches:
        out: list[tuple] = []
        for host, page, template in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            filled: dict[int, list] = {}
            for i, (t, slot) in enumerate(slots_of(page_tokens(page.as_py() or ""), _unsigned(template.as_py()))):
                if t.kind != "text" or t.out or not slot or not (run := _run(t.text)):
                    continue
                n = len(run.split())
                f = filled.setdefault(slot, [0, 0, 0, 0, 0, i, []])
                for k, x in enumerate((n, n * t.link, n * t.main, n * t.hint, n * t.heading)):
                    f[k] += x
                f[6].append(run)
            for slot, (n, links, main, hint, heading, place, runs) in filled.items():
                row = (host, _signed(slot), n, links, 2 * main > n, 2 * hint > n, 2 * heading > n, place, _signed(xxhash.xxh64_intdigest("\x00".join(runs))))
                if len(seen) >= FLUSH_TOKENS:
                    seen.clear()
                if (key := (host, slot, row[8])) not in seen:
                    seen.add(key)
                    out.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kinds[i]) for i in range(9)], names=[c.split()[0] for c in SLOT.split(", ")])


def _unsigned(tokens: list[int] | None) -> frozenset[int]:
    return frozenset(x & (2**64 - 1) for x in tokens or ())


def _regions(known: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, template, slots, by_tag) of the hosts ``known`` (host, template)."""
    filled = written(_beside(pages, known).filter("template is not null").select("host", "html", "template").mapInArrow(lean(_fillings), SLOT), "fillings")
    # texts that repeat, on one page or on many, count once
    each = filled.groupBy("host", "slot", "text").agg(*(F.first(c).alias(c) for c in ("words", "links", "main", "hint", "heading", "place")))
    most = lambda c: F.avg(F.col(c).cast("double")) > 0.5
    slots = each.groupBy("host", "slot").agg(F.sum("words").alias("words"), (F.sum("links") / F.sum("words")).alias("links"), F.avg("place").alias("place"),
                                             most("main").alias("main"), most("hint").alias("hint"), most("heading").alias("heading"))
    worth = F.col("words") * F.pow(1 - F.col("links"), F.lit(2.0)) * F.when(F.col("hint"), HINT_PRIOR).otherwise(1.0)
    scored = written(slots.withColumn("worth", worth), "slots")
    by_tag = F.coalesce(F.sum(F.when(F.col("main"), F.col("worth"))), F.lit(0.0)) * MAIN_PRIOR
    top = F.when(~F.col("main"), F.struct("worth", F.col("place").alias("at")))
    best = scored.groupBy("host").agg(by_tag.alias("in_main"), F.max(top).alias("best"))
    rich = F.col("worth") >= SLOT_SHARE * F.col("best.worth")
    title = F.col("heading") & (F.col("place") < F.col("best.at")) & (F.col("links") < 0.5) & ~F.col("hint")
    chosen = (scored.join(best, "host").filter(~F.col("main") & (F.col("in_main") < F.col("best.worth")) & (rich | title))
              .groupBy("host").agg(F.collect_list("slot").alias("slots")))
    return written(known.join(chosen, "host", "left").withColumn("by_tag", F.col("slots").isNull()), "regions")


def _beside(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``pages`` with their host's row, broadcast where counted bytes allow it."""
    size = F.sum(F.lit(64) + F.length("host") + sum((8 * F.greatest(F.size(c), F.lit(0)) for c in ("template", "slots") if c in hosts.columns), F.lit(0)))
    return pages.join(F.broadcast(hosts) if 2 * (hosts.agg(size).first()[0] or 0) <= BROADCAST_BYTES else hosts, "host", "left")


def regions(pages: DataFrame) -> DataFrame:
    """(host, template, slots, by_tag): the template and main region of each host that has a template."""
    src = pages.select(host_of(F.col("url")).alias("host"), "html")
    known = written(classes(pages, by_region=True).select("host", F.explode("tokens").alias("t")).groupBy("host").agg(F.collect_set("t").alias("template")), "templates")
    return _regions(known, src)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    joined = _beside(rows, regions(pages)).select("page_id", "url", "html", "template", "slots", "by_tag")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(page.as_py(), Region(_unsigned(t.as_py()), _unsigned(s.as_py()), by_tag.as_py() is not False))
                    for page, t, s, by_tag in zip(*b.columns[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
