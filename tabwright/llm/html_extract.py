"""Main text of web pages, by wrappers inferred from the pages of a host.

A host's pages come from templates. Each page's token stream, nested by its tags, is aligned with
the wrapper of the pages seen before: a union-free regular expression of tags, text slots,
optional and repeated groups. Elements that only one side has become optional; equal neighbours, and
stretches in which tags recur, become repeated groups; text that differs makes a slot, text that never differs
belongs to the template. Pages are aligned within tasks, the tasks' wrappers are aligned with each
other per host and salt, and then per host, so that no task gathers a host. All pages take part.

A wrapper tells where on the host's pages the main text stands, and what is template. Text is template if at
least ``AGREE`` pages of different main texts, and a share ``SHARE`` of the host's pages, have it alike; copies of a
page count once, and the place of most running text is never template. Where that place is alike on all its pages, as
on a host of copies, the place of most running text that differs is returned with it.

A page that marks its article itself (``article``, ``main``) is aligned like the others: its marks say where the text is,
all of them that are not nested, in page order; marks that are template are left out, and within an article what is both template
and named like no main text, since an article may have headings or lists that all its pages share. The wrapper's own place is
added if it lies outside the marks and holds more running text than they do. Menus, footers, sidebars, forms and the
like are left out by element and role everywhere, by name (notices, adverts, related pages) alone outside
articles only; comments are left out by name within them, too.

Nulls: a null or empty page has an empty text. Pages without a host (null or malformed url) are
extracted by themselves, as is the only page of a host. Pages that repeat are extracted each. An empty
table gives an empty result. Broken markup is read as far as it goes; very deep nesting is flattened. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import stage
from tabwright.llm.html_tree import BLOCKS, Element, parse

# Elements, roles and names that are never main text.
LEFT_OUT = frozenset(
    "head nav footer aside form script style noscript template button select option textarea input iframe svg canvas object embed "
    "dialog menu audio video map datalist fieldset label search title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist status feed".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner promo promotion promoted sponsor sponsored cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar aside rail menu navbar nav navigation topnav "
    "breadcrumb breadcrumbs toolbar header masthead topbar footer foot copyright legal comment comments commentlist respond reply replies discussion disqus "
    "related recommended recommendations share sharing social widget widgets pagination pager login search hidden skip teaser teasers outbrain taboola".split())
#: Names of parts in which readers answer; the only ones that count within an article.
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
PART = re.compile(r"[a-z]+", re.I)
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

#: Pages of different main texts that have to agree before a text counts as template, and their share of the host's pages;
#: hosts held by a task; salts of a host.
AGREE, SHARE, HELD, SALTS = 5, 0.25, 2_000, 64
#: Where an element stands: in a page's main part, or in an article.
MAIN, ARTICLE = 1, 2


def mark(e: Element) -> int:
    """What an element says of itself: ``ARTICLE``, ``MAIN`` or nothing."""
    if e.name == "article" or e.attributes.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    return MAIN if e.name == "main" or e.attributes.get("role", "").lower() == "main" else 0


def unwanted(e: Element, inside: int) -> bool:
    """Whether an element is no main text; ``inside`` a main part or an article, a header is looked into."""
    if e.name in LEFT_OUT or (e.name == "header" and not inside):
        return True
    a = e.attributes
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or a.get("role", "").lower() in ROLES:
        return True
    if "display:none" in (style := a.get("style", "").replace(" ", "").lower()) or "visibility:hidden" in style:
        return True
    if "hidden" in a.get("class", "").lower().split():
        return True
    if e.name in ("html", "body", "main") or (e.name == "article" and inside != ARTICLE and "comment" not in e.key):
        return False
    return named(e, COMMENTS if inside == ARTICLE else NAMES)


def named(e: Element, names: frozenset[str]) -> bool:
    """Whether a word of an element's class or id is one of ``names``."""
    a = e.attributes
    return any(p in names for label in (a.get("class", ""), a.get("id", "")) for p in (w.lower() for w in PART.findall(_parted(label))))


def _parted(label: str) -> str:
    return re.sub(r"([a-z])([A-Z])", r"\1 \2", label)


def blocks(e: Element, skip: frozenset[str] = frozenset(), path: str = "", inside: int = 0) -> list[str]:
    """The texts of the blocks below an element, in page order, blank ones left out.

    What stands at the places ``skip`` is left out; within an article, only what is named like no main text as well.
    """
    out, line = [], []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    def walk(e: Element, path: str, in_header: bool, heading: bool, inside: int, alike: bool) -> None:
        for child in e.children:
            if isinstance(child, str):
                if not in_header or heading:
                    line.append(child)
                continue
            below = f"{path}/{child.key}" if skip else ""
            same = alike or (bool(skip) and below in skip)
            if unwanted(child, inside) or (same and (inside != ARTICLE or named(child, NAMES))):
                if child.name in BLOCKS:
                    flush()
                continue
            if child.name == "br":
                line.append(" ")
                continue
            block = child.name in BLOCKS
            if block:
                flush()
            walk(child, below, in_header or child.name == "header", heading or child.name in HEADINGS, max(inside, mark(child)), same)
            if block:
                flush()

    walk(e, path, False, False, inside, False)
    flush()
    return out


def _spots(page: Element, wanted: frozenset[str], marked: bool) -> list[tuple[Element, str, int]]:
    """The outermost elements at the wanted places, or that mark themselves, in page order, with place and mark."""
    out = []

    def walk(e: Element, path: str) -> None:
        for child in e.children:
            if isinstance(child, str) or unwanted(child, 0):
                continue
            below, own = f"{path}/{child.key}", mark(child)
            if below in wanted or (marked and own):
                out.append((child, below, own))
            else:
                walk(child, below)

    walk(page, "")
    return out


def _own_text(e: Element, inside: int) -> tuple[int, int]:
    """Length of the text in an element and its inline descendants, and how much of it is linked."""
    text = linked = 0
    for child in e.children:
        if isinstance(child, str):
            text += len(" ".join(child.split()))
        elif child.name not in BLOCKS and not unwanted(child, inside):
            t, k = _own_text(child, inside)
            text, linked = text + t, linked + (t if child.name == "a" else k)
    return text, linked


def scores(page: Element) -> dict[str, float]:
    """How much running text stands right below each place of a page, and half as much one level up."""
    out: dict[str, float] = {}

    def walk(e: Element, path: str, above: str, inside: int) -> None:
        for child in e.children:
            if isinstance(child, str) or unwanted(child, inside):
                continue
            below, deeper = f"{path}/{child.key}", max(inside, mark(child))
            if child.name in BLOCKS:
                text, linked = _own_text(child, deeper)
                if text >= 25 and linked < 0.5 * text:
                    out[path] = out.get(path, 0) + text
                    out[above] = out.get(above, 0) + text / 2
                    if child.name in ("div", "section", "td", "body"):
                        out[below] = out.get(below, 0) + text
            walk(child, below, path, deeper)

    walk(page, "", "", 0)
    return out


def extract(html: str | None, known: dict | None = None) -> str:
    """The main text of a page; ``known`` is what the wrapper of its host tells."""
    page = parse(html or "")
    return " ".join(_main_blocks(page, scores(page), known))


def _main_blocks(page: Element, places: dict[str, float], known: dict | None = None) -> list[str]:
    skip = frozenset(known["template"]) if known else frozenset()
    told_places = [p for p in (known["place"], known["also"]) if p in places] if known else []
    marks = _spots(page, frozenset(), True)
    if marks:
        held = [p for p in places if any(_within(p, at) for _, at, _ in marks)]
        most = max((places[p] for p in held), default=0)
        outside = frozenset(p for p in told_places if places[p] > most and not any(_within(p, at) or _within(at, p) for _, at, _ in marks))
        spots = _spots(page, outside, True)
        for left_out in (skip, frozenset()):
            # Marks that are template as a whole hold no main text, unless there is no other.
            found = [b for e, p, own in spots if not any(_within(p, t) for t in left_out)
                     for b in (blocks(e, left_out, p, own) if own else _unlinked(e, left_out, p))]
            if found:
                return found
    best = frozenset(told_places) or frozenset(p for p in [max(places, key=places.get, default="")] if p)
    spots = [(e, p) for e, p, _ in _spots(page, best, False)] if best else [(page, "")]
    return [b for e, p in spots for b in _unlinked(e, skip, p)]


def _within(path: str, place: str) -> bool:
    return path == place or path.startswith(f"{place}/")


def _unlinked(e: Element, skip: frozenset[str], path: str) -> list[str]:
    """Blocks below a place that was found by its text; lists of links in it are menus."""
    kept = Element(e.name, e.attributes)
    for child in e.children:
        if not isinstance(child, str) and child.name in ("ul", "ol", "dl", "div", "table"):
            text, linked = _whole_text(child)
            if text and linked > 0.66 * text:
                continue
        kept.children.append(child)
    return blocks(kept, skip, path)


def _whole_text(e: Element) -> tuple[int, int]:
    text = linked = 0
    for child in e.children:
        if isinstance(child, str):
            text += len(" ".join(child.split()))
        elif not unwanted(child, 0):
            t, k = _whole_text(child)
            text, linked = text + t, linked + (t if child.name == "a" else k)
    return text, linked


# --- wrappers ---------------------------------------------------------------------------
# A wrapper is a tree of dicts: k the tag with its names, n pages that have it, r whether it repeats, h a
# checksum of its text while that is the same on all pages (else -1), d checksums of the main texts of the pages that
# have it, as long as h holds and up to AGREE, s the score of running text, c what it holds.
# A node whose k is empty is a group that repeats.

def shape(e: Element, places: dict[str, float], path: str = "", own: int | None = None) -> dict:
    """A page as a wrapper of its own."""
    if own is None:
        own = zlib.crc32(" ".join(_main_blocks(e, places)).encode("utf-8", "surrogatepass"))
    text, parts = 0, []
    for child in e.children:
        if isinstance(child, str):
            if body := " ".join(child.split()):
                text = zlib.crc32(body.encode("utf-8", "surrogatepass"), text)
        else:
            part = shape(child, places, f"{path}/{child.key}", own)
            text = zlib.crc32(part["h"].to_bytes(4, "little"), text)
            parts.append(part)
    return {"k": e.key, "n": 1, "r": False, "h": text, "d": [own], "s": places.pop(path, 0.0), "c": _folded(parts)}


def _joined(a: dict, b: dict, same_page: bool) -> dict:
    """Two nodes of one tag, on the same page (it repeats) or on different ones."""
    if same_page:
        n, r, h = 1, True, zlib.crc32(b["h"].to_bytes(4, "little"), a["h"])
    else:
        n, r, h = a["n"] + b["n"], a["r"] or b["r"], a["h"] if a["h"] == b["h"] else -1
    d = a["d"] if h == -1 or len(a["d"]) >= AGREE else [*a["d"], *(x for x in b["d"] if x not in a["d"])][:AGREE]
    return {"k": a["k"], "n": n, "r": r, "h": h, "d": [] if h == -1 else d, "s": a["s"] + b["s"], "c": _aligned(a["c"], b["c"], same_page)}


def _folded(parts: list[dict]) -> list[dict]:
    """Equal neighbours become one that repeats; a stretch in which tags recur becomes a group."""
    out: list[dict] = []
    for part in parts:
        if out and out[-1]["k"] == part["k"]:
            out[-1] = _joined(out[-1], part, True)
        else:
            out.append(part)
    where: dict[str, list[int]] = {}
    for i, part in enumerate(out):
        where.setdefault(part["k"], []).append(i)
    again = [i for places in where.values() if len(places) > 1 for i in (places[0], places[-1])]
    if not again:
        return out
    first, last = min(again), max(again) + 1
    return [*out[:first], _group(out[first:last]), *out[last:]]


def _group(parts: list[dict]) -> dict:
    held: dict[str, dict] = {}
    for part in parts:
        for one in part["c"] if part["k"] == "" else [part]:
            held[one["k"]] = _joined(held[one["k"]], one, True) if one["k"] in held else one
    return {"k": "", "n": 1, "r": True, "h": -1, "d": [], "s": 0.0, "c": list(held.values())}


def _aligned(a: list[dict], b: list[dict], same_page: bool) -> list[dict]:
    """Two sequences as one: what both have is matched in order, the rest is optional."""
    groups = [x for x in (*a, *b) if x["k"] == ""]
    if groups:
        names = {x["k"] for g in groups for x in g["c"]}
        a, b = _gathered(a, names), _gathered(b, names)
    # Tags are unique on each side: the longest common subsequence is an increasing run of places.
    place = {x["k"]: i for i, x in enumerate(b)}
    chains: list[tuple[int, list[int]]] = []
    for i, x in enumerate(a):
        if x["k"] in place:
            j = place[x["k"]]
            best = max((c for c in chains if c[0] < j), key=lambda c: len(c[1]), default=(-1, []))
            chains.append((j, [*best[1], i]))
    kept = max((c[1] for c in chains), key=len, default=[])
    out, at, matched = [], 0, set(kept)
    crossed = {x["k"] for i, x in enumerate(a) if x["k"] in place and i not in matched}
    for i, x in enumerate(a):
        if i not in matched:
            # A tag that changed places stays where it was first.
            out.append(_met(x, b[place[x["k"]]], same_page) if x["k"] in crossed else x)
            continue
        j = place[x["k"]]
        out += [y for y in b[at:j] if y["k"] not in crossed]
        out.append(_met(x, b[j], same_page))
        at = j + 1
    return out + [y for y in b[at:] if y["k"] not in crossed]


def _met(x: dict, y: dict, same_page: bool) -> dict:
    if x["k"]:
        return _joined(x, y, same_page)
    return {"k": "", "n": 1 if same_page else x["n"] + y["n"], "r": True, "h": -1, "d": [], "s": 0.0, "c": _aligned(x["c"], y["c"], same_page)}


def _gathered(parts: list[dict], names: set[str]) -> list[dict]:
    """The sequence with its groups, and what belongs to them, as one group."""
    at = [i for i, x in enumerate(parts) if x["k"] == "" or x["k"] in names]
    if not at:
        return parts
    held: dict[str, dict] = {}
    n = max(parts[i]["n"] for i in at)
    rest = []
    for i, x in enumerate(parts):
        if i not in at:
            rest.append((i, x))
            continue
        for one in x["c"] if x["k"] == "" else [x]:
            held[one["k"]] = {**_joined(held[one["k"]], one, True), "n": max(held[one["k"]]["n"], one["n"])} if one["k"] in held else one
    group = {"k": "", "n": n, "r": True, "h": -1, "d": [], "s": 0.0, "c": list(held.values())}
    return [x for i, x in rest if i < at[0]] + [group] + [x for i, x in rest if i > at[0]]


def merged(a: dict | None, b: dict) -> dict:
    return b if a is None else _joined(a, b, False)


def expression(wrapper: dict, pages: int | None = None) -> str:
    """The wrapper as a regular expression: tags, #text slots, ( )? and ( )+."""
    pages = pages or wrapper["n"]
    body = " ".join(expression(c, wrapper["n"]) for c in wrapper["c"])
    if wrapper["k"]:
        body = f"<{wrapper['k']}> {body or ('#text' if wrapper['h'] == -1 else '#same')} </>"
    return f"({body}){'+' if wrapper['r'] else ''}{'?' if wrapper['n'] < pages else ''}" if wrapper["r"] or wrapper["n"] < pages else body


def told(wrapper: dict) -> dict:
    """What a wrapper tells: places whose text is template, and the place of most running text.

    Where the latter is alike on all its pages, the one of most running text that differs is told as well (``also``).
    """
    def nodes(node: dict, path: str = "") -> Iterator[tuple[str, dict]]:
        for child in node["c"]:
            if child["k"] == "":
                yield from nodes(child, path)
            else:
                yield (below := f"{path}/{child['k']}"), child
                yield from nodes(child, below)

    every = list(nodes(wrapper))
    place, top = max(every, key=lambda x: x[1]["s"], default=("", None))
    if top is None or not top["s"]:
        place = ""
    alike = bool(place) and top["n"] > 1 and top["h"] != -1
    template: list[str] = []
    for path, node in every:
        if node["h"] in (-1, 0) or len(node["d"]) < AGREE or node["n"] < SHARE * wrapper["n"] or (template and _within(path, template[-1])):
            continue
        if path != place and not (alike and (_within(path, place) or _within(place, path))):
            template.append(path)
    others = [x for x in every if x[1]["h"] == -1 and x[1]["s"] and not _within(place, x[0])] if alike else []
    return {"template": template, "place": place, "also": max(others, key=lambda x: x[1]["s"], default=("", None))[0]}


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The wrapper of each host with at least two pages: host, pages, wrapper (as JSON)."""
    narrow = pages.select(F.regexp_extract(F.col(url).cast("string"), HOST, 1).alias("host"), F.col(html).cast("string").alias("html"))
    narrow = narrow.where("host IS NOT NULL AND host <> ''")
    schema = "host string, salt int, wrapper string"

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict] = {}
        salt = TaskContext.get().partitionId() % SALTS
        for batch in batches:
            for host, body in zip(batch.column("host"), batch.column("html"), strict=True):
                page, name = parse(body.as_py() or ""), host.as_py().lower()
                held[name] = merged(held.get(name), shape(page, scores(page)))
            if len(held) > HELD:
                yield _sent(held, salt)
                held = {}
        if held:
            yield _sent(held, salt)

    def reduce(rows: pa.Table) -> pa.Table:
        total = None
        for text in rows.column("wrapper"):
            total = merged(total, json.loads(text.as_py()))
        return pa.table({"host": rows.column("host")[:1], "salt": rows.column("salt")[:1], "wrapper": [json.dumps(total)]})

    partial = narrow.mapInArrow(infer, schema)
    salted = partial.groupBy("host", "salt").applyInArrow(reduce, schema)
    whole = salted.groupBy("host").applyInArrow(reduce, schema)
    return whole.select("host", F.get_json_object("wrapper", "$.n").cast("long").alias("pages"), "wrapper").where("pages > 1")


def _sent(held: dict[str, dict], salt: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held)), pa.array([salt] * len(held), pa.int32()), pa.array([json.dumps(w) for w in held.values()])], names=["host", "salt", "wrapper"])


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_chars."""
    tell = F.udf(lambda w: json.dumps(told(json.loads(w))), T.StringType())
    known = stage(wrappers(pages, url, html).select(F.col("host").alias("known_host"), tell("wrapper").alias("known")))
    narrow = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"),
                          F.lower(F.regexp_extract(F.col(url).cast("string"), HOST, 1)).alias("host"))
    both = narrow.join(known, F.col("host") == F.col("known_host"), "left").select("key", "url", "html", "known")
    schema = T.StructType([T.StructField("key", narrow.schema["key"].dataType), T.StructField("url", narrow.schema["url"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            out = []
            for body, text in zip(batch.column("html"), batch.column("known").to_pylist(), strict=True):
                if text not in seen:
                    if len(seen) > HELD:
                        seen = {None: None}
                    seen[text] = json.loads(text)
                out.append(extract(body.as_py(), seen[text]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=schema.names)

    return both.mapInArrow(run, schema).withColumnsRenamed({"key": key, "url": url})
