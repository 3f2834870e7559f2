"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

Tokens are tags and texts. Two tokens of a host are equivalent if they occur equally often on each of its
pages; a class of tags that most pages have, in one order on every page, is part of the template, and
classes nest by their places. What lies between template tags are the slots. Slots that hold the
article are told by their text, its links and the template tags around them; the texts in
them that are no template texts are the article.

Occurrence vectors are never gathered: they are compared by sums of hashes of page and count, which
combine before the shuffle, so a host with a third of all pages costs a row per token and task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.session import ensure_checkpoint_dir

SUPPORT = 0.5  # share of a host's pages that has a template token
LEAST_PAGES = 3  # pages from which a template can be told
BROADCAST_HOSTS = 50_000  # up to here the templates (under 1 kB each) are broadcast
DISORDER = 0.05  # share of pages on which a class may be out of order

# Elements of HTML by what they hold.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
ASIDE = set(
    "aside audio button canvas datalist dialog embed fieldset footer form head header iframe input label math menu meter nav noscript "
    "object option progress script select style svg template textarea title video".split()
)
CONTENT = {"article", "main"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ASIDE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related "
    "replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)

#: Parts of a class or id that speak of an element beside the article without being one.
ABOUT = set("no not non has have with without".split())
MOST = 0.5  # share of a page's text that no class or id puts beside the article

_EVENT = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)")


def _number(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text.encode("utf-8", "replace"))


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _beside_name(name: str) -> bool:
    """Whether a class or id is a word of ``ASIDE_WORDS``, or begins or ends with one, and does not only speak of it."""
    parts = _WORD.findall(name)
    return bool(parts) and (parts[0] in ASIDE_WORDS or parts[-1] in ASIDE_WORDS) and not ABOUT & set(parts)


class Tags:
    """What a tag means, remembered by its spelling."""

    def __init__(self) -> None:
        self.known: dict[tuple, tuple] = {}

    def of(self, close: bool, name: str, attrs: str) -> tuple[str, bool, bool, int]:
        """Name, whether it opens an element beside the article, whether only its class or id (or being a form) says so, and its token."""
        key = (close, name, attrs)
        found = self.known.get(key)
        if found is None:
            name = name.lower()
            marks: dict[str, str] = {}
            for k, v in _ATTRIBUTE.findall(attrs):
                marks.setdefault(k.lower(), v.strip("\"'").lower())
            names = (marks.get("class", "") + " " + marks.get("id", "")).split()
            # a form may be around the whole page, so it is judged by its text, like an element known by its names
            named = name == "form" or name not in CONTENT and any(map(_beside_name, names))
            beside = name in ASIDE and name != "form" or marks.get("role") in ASIDE_ROLES
            hidden = "hidden" in marks or marks.get("aria-hidden") == "true" or "display:none" in marks.get("style", "").replace(" ", "")
            kept = "" if close else " ".join(f"{k}={marks[k]}" for k in ("class", "id", "role") if k in marks)
            sure, root = beside or hidden, name in ("html", "body")
            found = (name, (sure or named) and not root, named and not sure and not root, _number(f"<{'/' * close}{name} {kept}>"))
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = found
        return found


class Event:
    __slots__ = ("tag", "token", "text", "beside", "content", "link", "breaks")

    def __init__(self, tag: bool, token: int, text: str, beside: bool, content: bool, link: bool, breaks: bool):
        self.tag, self.token, self.text = tag, token, text
        self.beside, self.content, self.link, self.breaks = beside, content, link, breaks


def events(html: str, tags: Tags) -> list[Event]:
    """Tags and texts of a page in order. A text knows whether it is inside an element beside the article,
    inside the article's own element, and inside a link. An element that holds ``main`` or more than ``MOST`` of the text
    is not beside the article for its class or id, or as a form, alone."""
    out, held = _events(html, tags, frozenset())
    return _events(html, tags, held)[0] if held else out


def _events(html: str, tags: Tags, held: frozenset[int]) -> tuple[list[Event], frozenset[int]]:
    """Events, with the named elements whose numbers are ``held`` taken as any other, and the numbers to hold."""
    out: list[Event] = []
    stack: list[tuple[str, bool, bool]] = []  # name, beside, content
    beside = content = link = False
    at = 0
    # named elements: depth in the stack, number, text before, whether main is inside; depths of elements surely beside
    opened: list[list] = []
    sure: list[int] = []
    inside: list[tuple[int, int, bool]] = []
    chars = number = 0

    def text(part: str) -> None:
        nonlocal chars
        words = " ".join(unescape(part).split())
        chars += 0 if sure else len(words)
        if words or part:
            out.append(Event(False, _number(words) if words else 0, part, beside, content, link, False))

    for m in _EVENT.finditer(html):
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        spelled = m["name"] or m["name2"]
        if spelled is None:
            continue
        attrs = m["attrs"] if m["name"] else m["attrs2"]
        closing = bool(m["close"] or m["close2"])
        name, opens_beside, named, token = tags.of(closing, spelled, attrs or "")
        out.append(Event(True, token, " " if name == "br" else "", beside, content, link, name in BLOCKS))
        if name == "a":
            link = not closing
        if name in VOID or attrs.endswith("/"):
            continue
        if not closing and (name in BLOCKS or opens_beside or name in CONTENT):
            if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and not opens_beside:
                continue  # their ends may be left out
            if named:
                opened.append([len(stack), number, chars, False])
            elif opens_beside:
                sure.append(len(stack))
            if name == "main" and not sure:
                for mark in opened:
                    mark[3] = True
            stack.append((name, beside, content))
            beside, content = beside or opens_beside and not (named and number in held), content or name in CONTENT
            number += named
        elif closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    beside, content = stack[k][1:]
                    del stack[k:]
                    while opened and opened[-1][0] >= k:
                        _, own, before, whole = opened.pop()
                        inside.append((own, chars - before, whole))
                    while sure and sure[-1] >= k:
                        sure.pop()
                    break
    if at < len(html):
        text(html[at:])
    inside += [(own, chars - before, whole) for _, own, before, whole in opened]
    return out, frozenset(own for own, n, whole in inside if whole or n > MOST * chars)


def _print_of(seen: list[Event]) -> int:
    """A number of a page's main text: pages whose three longest texts are the same have the same one."""
    longest = sorted({(-len(e.text), e.token) for e in seen if not e.tag and e.token and not e.beside})[:3]
    mixed = 0
    for _, token in longest:
        mixed ^= token
    return _signed(mixed)


def token_rows(own: DataFrame) -> DataFrame:
    """Per host and token: pages that have it, most on one page, summed first place, and two sums that stand for
    its occurrence vector; least and greatest number of the main texts it occurs with. A host's pages are counted under token null."""
    names = ["host", "token", "tag", "pages", "most", "place", "sum1", "sum2", "low", "high"]
    mask = (1 << 64) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = Tags()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                seen: dict[tuple, list] = {}
                for page, url, html in zip(*(part.column(i).to_pylist() for i in range(3))):
                    host = host_of(url)
                    key = _number(f"{page}|{url}")
                    found = events(html or "", tags)
                    main = _print_of(found)
                    seen.setdefault((host, None, True), [0, 0, 0, 0, 0, main, main])[0] += 1
                    counts: dict[tuple, list] = {}
                    for place, event in enumerate(found):
                        if event.token:
                            counts.setdefault((event.token, event.tag), [0, place])[0] += 1
                    for (token, tag), (n, place) in counts.items():
                        row = seen.setdefault((host, token, tag), [0, 0, 0, 0, 0, main, main])
                        row[5:] = min(row[5], main), max(row[6], main)
                        row[0] += 1
                        row[1] = max(row[1], n)
                        row[2] += place
                        mixed = (key ^ n * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & mask
                        row[3] = (row[3] + (mixed ^ mixed >> 29)) & mask
                        row[4] = (row[4] + (mixed * 0x94D049BB133111EB & mask ^ mixed >> 31)) & mask
                columns = [
                    pa.array([k[0] for k in seen], pa.string()),
                    pa.array(np.array([k[1] or 0 for k in seen], np.uint64).view(np.int64), mask=np.array([k[1] is None for k in seen], bool)),
                    pa.array([k[2] for k in seen], pa.bool_()),
                    *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(3)),
                    # 32 bits of each sum: adding up two thousand million of them stays within a long
                    *(pa.array([v[i] & (1 << 32) - 1 for v in seen.values()], pa.int64()) for i in (3, 4)),
                    *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in (5, 6)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = own.mapInArrow(run, "host string, token long, tag boolean, pages long, most long, place long, sum1 long, sum2 long, low long, high long")
    totals = [F.sum("pages").alias("pages"), F.max("most").alias("most"), F.sum("place").alias("place")]
    totals += [F.pmod(F.sum(c), F.lit(1 << 32)).alias(c) for c in ("sum1", "sum2")]
    totals += [F.min("low").alias("low"), F.max("high").alias("high")]
    return rows.groupBy("host", "token", "tag").agg(*totals)


def templates(rows: DataFrame) -> DataFrame:
    """One row per host: template tags in order with the number of their class, and template texts."""
    per_host = rows.filter("token is null").select("host", F.col("pages").alias("all_pages"))
    often = rows.filter("token is not null").filter(F.col("pages") >= LEAST_PAGES).join(per_host, "host")
    often = often.filter(F.col("pages") >= SUPPORT * F.col("all_pages"))

    def deduce(part: pd.DataFrame) -> pd.DataFrame:
        tag = part[part.tag & (part.most == 1)].copy()
        tag["at"] = tag.place / tag.pages
        tag["kind"] = tag.groupby(["pages", "sum1", "sum2"]).ngroup()
        tag = tag[tag.groupby("kind").token.transform("size") >= 2].sort_values(["at", "token"])
        # what occurs with one main text only is that text or goes with it: copies of a page are no template
        texts = part[~part.tag & (part.low != part.high)].token.tolist()
        return pd.DataFrame({"host": [part.host.iloc[0]], "tags": [tag.token.tolist()], "kinds": [tag.kind.tolist()], "texts": [texts]})

    return often.groupBy("host").applyInPandas(deduce, "host string, tags array<long>, kinds array<int>, texts array<long>")


def _with_template(own: DataFrame, found: DataFrame) -> DataFrame:
    """Pages with their host's template. Templates have a bounded size, so it is their number that counts."""
    few = found.count() <= BROADCAST_HOSTS
    hosted = own.withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", _HOST.pattern, 1)), F.lit("")))
    return hosted.join(F.broadcast(found) if few else found, "host", "left")


def slot_rows(joined: DataFrame) -> DataFrame:
    """Per host and slot (the template tag before it): text in thousandths of a page, in links, and inside the
    article's element; and per class the pages it is on and those on which it is out of order."""
    names = ["host", "slot", "kind", "chars", "linked", "inside", "pages", "wrong"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = Tags()
        for batch in batches:
            total: dict[tuple, np.ndarray] = {}
            for html, host, template, kinds, texts in zip(*(c.to_pylist() for c in batch.columns)):
                order = {t: (k, c) for k, (t, c) in enumerate(zip(template or (), kinds or ()))}
                static, slot, last = set(texts or ()), 0, {}
                wrong: dict[int, bool] = {}
                own: dict[int, np.ndarray] = {}
                for event in events(html or "", tags):
                    token = _signed(event.token)
                    if event.tag:
                        if token in order:
                            place, kind = order[token]
                            wrong[kind] = wrong.get(kind, False) or place < last.get(kind, -1)
                            last[kind], slot = place, token
                    elif event.token and not event.beside and (event.content or token not in static):
                        n = len(event.text)
                        own[slot] = own.get(slot, 0) + np.array((n, n * event.link, n * event.content, 0, 0))
                whole = max(sum(int(v[0]) for v in own.values()), 1)
                for slot, parts in own.items():  # in thousandths, so that no long page outweighs the others
                    row = total.setdefault((host, slot, -1), np.zeros(5, np.int64))
                    row += -(-1000 * parts // whole)
                for kind, bad in wrong.items():
                    row = total.setdefault((host, 0, kind), np.zeros(5, np.int64))
                    row += (0, 0, 0, 1, bad)
            if total:
                columns = [pa.array([k[i] for k in total], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))]
                columns += [pa.array([int(v[i]) for v in total.values()], pa.int64()) for i in range(5)]
                yield pa.RecordBatch.from_arrays(columns, names)

    own = joined.select("html", "host", "tags", "kinds", "texts")
    rows = own.mapInArrow(run, "host string, slot long, kind int, chars long, linked long, inside long, pages long, wrong long")
    return rows.groupBy("host", "slot", "kind").agg(*[F.sum(c).alias(c) for c in names[3:]])


def _signed(token: int) -> int:
    return token - (1 << 64) if token >> 63 else token


def main_slots(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Templates of the classes that keep their order, with the slots of the article: those with text inside the
    article's own element, and those whose text is not mostly links, however small their share: a headline is a slot."""

    def choose(key: tuple, slots: pd.DataFrame) -> pd.DataFrame:
        kinds = slots[slots.kind >= 0]
        bad = set(kinds[kinds.wrong > DISORDER * kinds.pages].kind)
        text = slots[slots.kind < 0]
        main = text[(text.inside > 0) | (text.linked < 0.5 * text.chars)]
        return pd.DataFrame({"host": [key[0]], "bad": [sorted(bad)], "main": [main.slot.tolist()]})

    chosen = rows.groupBy("host").applyInPandas(choose, "host string, bad array<int>, main array<long>")
    return found.join(chosen, "host").select("host", "tags", "kinds", "texts", "bad", "main")


def _text_of(html: str, tags: Tags, slots: dict[int, bool], main: set[int] | None, static: set[int]) -> str:
    blocks: list[str] = []
    parts: list[str] = []
    seen = events(html, tags)
    element = any(e.content and e.token and not e.tag and not e.beside for e in seen)
    slot = 0

    def end_block() -> None:
        words = " ".join("".join(parts).split())
        if words:
            blocks.append(words)
        parts.clear()

    for event in seen:
        if event.tag:
            token = _signed(event.token)
            if token in slots:
                slot = token
            if event.breaks:
                end_block()
            elif event.text:
                parts.append(event.text)
        elif not event.beside and (event.content or not element):
            # texts that pages share are the template's, but not within the article's own element
            if (main is None or slot in main) and (event.content or _signed(event.token) not in static):
                parts.append(unescape(event.text))
    end_block()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text`` of every row: blocks of the article joined by a line feed, empty if there is none.

    Hosts with fewer than ``LEAST_PAGES`` pages have no template: there, as on pages without a known host, the
    elements of a page alone say what is beside the article. Null html is empty. Rows that repeat are
    treated one by one. Other columns are not read.
    """
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    ensure_checkpoint_dir(pages.sparkSession)
    # read twice below, by filters that would each be pushed down to an own pass over the pages
    found = templates(token_rows(own).checkpoint())
    found = found.checkpoint()
    chosen = main_slots(found, slot_rows(_with_template(own, found))).checkpoint()
    joined = _with_template(own, chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = Tags()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part, out = batch.slice(at, 500), []
                for page, template, kinds, texts, bad, main in zip(*(c.to_pylist() for c in part.columns[2:])):
                    if main is None:
                        out.append(_text_of(page or "", tags, {}, None, set()))
                        continue
                    slots = {t: True for t, k in zip(template, kinds) if k not in bad}
                    out.append(_text_of(page or "", tags, slots, set(main), set(texts)))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(out, pa.string())], ["page_id", "url", "text"])

    kind = own.schema["page_id"].dataType.simpleString()
    columns = ["page_id", "url", "html", "tags", "kinds", "texts", "bad", "main"]
    return joined.select(*columns).mapInArrow(run, f"page_id {kind}, url string, text string")
