"""Main text of web pages by deduced templates.

Pages of one host come from templates. A token is a tag together with the path of tags above it. Its occurrence vector
says how often it stands on each page of the host; tokens with equal vectors form an equivalence class. Vectors are never
gathered: each page has a random number, and a token's signature, the sum of count times that number over the pages,
is equal for equal vectors (and for others with a chance of 2**-64), so one grouped sum finds the classes, however many
pages a host has.

A class is valid if it is frequent and either is the class of what stands exactly once on every page or has two
tokens or more. Valid classes nest by their paths; together they are the host's template, and the text between its
tokens falls into slots: the slot of a text is the deepest template token above it. Slots are told apart by their place (navigation,
footer, advert, ...), by their links and by whether their text changes between pages that are not copies.
What stands in the slots that remain is the main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import packed, stored, unpacked

#: Share of a host's pages on which a token of the template stands, at least.
FREQUENT = 0.3
#: A slot with a larger share of its characters in links is a menu.
LINKED = 0.5
#: Token counts gathered in a task before they are handed on.
GATHERED = 200_000
_MASK = (1 << 64) - 1

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object|math|canvas|audio|video)\b[^>]*+>(?:.*?</\1\s*+[^>]*+>|.*\Z)"
    r"|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[a-z]+")
#: Pages on which an unchanging text must stand, at least, and share of its host's pages.
UNCHANGING_PAGES, UNCHANGING_SHARE = 3, 0.5
# Fixed values of HTML: tags without content, tags within a line, tags that a new block ends
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rp rt s samp small span strike strong sub sup time tt u var label".split())
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_AGAIN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Places that hold no main text, by tag, by role, and by a word of class or id
_ASIDE_TAGS = frozenset("nav footer aside form menu button head title dialog fieldset".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_ASIDE_WORDS = frozenset(
    "ad ads adsbox advert advertisement advertising adsense adslot banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notification alert popup modal overlay newsletter "
    "subscribe subscription signup login search share sharing social comment comments disqus reply replies respond related recommended "
    "recommendations widget toolbar pagination pager copyright disclaimer skip feedback".split()
)
_HEADER_WORDS = frozenset({"header", "topbar"})
# Words that a name of several may add to those above without a meaning of its own
_NEUTRAL_WORDS = frozenset("area bar block box button buttons container content footer global group header inner item items left link links list main page primary right secondary section site slot top bottom unit widget wrap wrapper".split())
# Places whose articles are not the page's own
_OTHERS_WORDS = frozenset("comment comments disqus reply replies respond related recommended recommendations".split())


class Place:
    """An open element: its tag, the hash of its path, and whether it is aside (by its kind, or only by a name), in an
    article, or in a link."""

    __slots__ = ("tag", "path", "hash", "aside", "named", "main", "linked", "up")

    def __init__(self, tag: str, path: str, aside: bool, main: bool, linked: int, up: list[int], named: frozenset[str] = frozenset()) -> None:
        self.tag, self.path, self.aside, self.main, self.linked, self.named = tag, path, aside or bool(named), main, linked, named
        self.hash = xxhash.xxh64_intdigest(path) if path else 0
        self.up = [*up, self.hash]


def walk(html: str) -> Iterator[tuple[str, Place, tuple[str, int]]]:
    """('open', place), ('break', place) and ('text', place, (raw text, in a link)) in page order."""
    stack = [Place("", "", False, False, 0, [])]
    links = 0
    at = 0
    for m in _TAG.finditer(html):
        if m.start() > at:
            yield "text", stack[-1], (html[at : m.start()], links)
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing, attributes = m[2] or m[5], m[4] or m[7] or ""
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                yield "break", stack[-1], ("", 0)
            continue
        yield "break", stack[-1], ("", 0)
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    links = 0
                    break
            continue
        if tag in _ENDS_P and stack[-1].tag == "p":
            stack.pop()
        again = _AGAIN.get(tag)
        if again and stack[-1].tag in again:
            while stack[-1].tag in again:
                stack.pop()
        elif tag in "h1h2h3h4h5h6" and len(tag) == 2 and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            stack.pop()
        links = 0
        stack.append(_entered(stack[-1], tag, attributes))
        yield "open", stack[-1], ("", 0)
    if at < len(html):
        yield "text", stack[-1], (html[at:], links)


def _names_aside(tokens: set[str], words: frozenset[str]) -> frozenset[str]:
    """The words by which a name of a class or id says that a place is aside: the whole name must say so.

    ``site-footer`` does, ``has-sidebar`` and ``comments-open`` do not.
    """
    found = set()
    for token in tokens:
        parts = set(_PART.findall(token))
        if (said := parts & words) and parts <= words | _NEUTRAL_WORDS:
            found |= said
    return frozenset(found)


def _entered(above: Place, tag: str, attributes: str) -> Place:
    # what an element above is by its kind, apart from what it is by its name
    aside, main, path = above.aside and not above.named, above.main, tag
    begins = tag in ("article", "main")
    tokens: set[str] = set()
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                tokens.update(value.split())
                path += f".{re.sub(r'[0-9]+', '0', value)}"
            elif name == "role":
                aside |= value in _ASIDE_ROLES
                begins |= value in ("main", "article")
            elif name == "itemprop":
                begins |= value == "articlebody"
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                aside = True
    named = above.named
    if begins:
        # a name never takes an article away, but that of comments and of pages elsewhere
        named = named & _OTHERS_WORDS | _names_aside(tokens, _OTHERS_WORDS)
    elif tag not in ("html", "body"):
        aside |= tag in _ASIDE_TAGS
        named |= _names_aside(tokens, _ASIDE_WORDS)
        if not main:
            aside |= tag == "header"
            named |= _names_aside(tokens, _HEADER_WORDS)
    # once by its kind, always: the names matter only where that is all
    return Place(tag, f"{above.path}>{path}", aside, main or begins, 0, above.up, frozenset() if aside else named)


def page_tokens(html: str) -> dict[int, list]:
    """Per token (hash of its path): times it stands, hashes of the tokens above, flags, text and link characters right below, hash of that text."""
    tokens: dict[int, list] = {0: [1, [0], 0, 0, 0, 0]}
    for kind, place, data in walk(html):
        if kind == "break":
            continue
        cell = tokens.get(place.hash)
        if cell is None:
            cell = tokens[place.hash] = [0, place.up, place.aside + 2 * place.main, 0, 0, 0]
        if kind == "open":
            cell[0] += 1
        else:
            raw, linked = data
            if stripped := raw.strip():
                cell[3] += len(stripped)
                cell[4] += len(stripped) if linked else 0
                cell[5] = (cell[5] * 31 + xxhash.xxh64_intdigest(stripped)) & _MASK
    return tokens


TOKENS = "host string, token long, above array<long>, flags int, signature long, pages long, chars long, linked long, first_text long, last_text long, first_page long, last_page long"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the pages of a task, by host and token."""
    sums: dict[tuple[str, int], list] = {}

    def handed_on() -> pa.RecordBatch:
        rows = [(h, _signed(t), [_signed(x) for x in v[0]], v[1], _signed(v[2]), *v[3:6], *map(_signed, v[6:])) for (h, t), v in sums.items()]
        sums.clear()
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32(), *[pa.int64()] * 8]
        names = [x.split()[0] for x in TOKENS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            for row in batch.slice(k, 256).to_pylist():
                html = row["html"] or ""
                number = xxhash.xxh64_intdigest(html.encode("utf-8", "replace"))
                for token, (n, up, flags, chars, linked, body) in page_tokens(html).items():
                    cell = sums.get((row["host"], token))
                    if cell is None:
                        signed = _signed(body)
                        sums[row["host"], token] = [up, flags, n * number & _MASK, 1, chars, linked, signed & _MASK, signed & _MASK, number, number]
                        continue
                    cell[2] = cell[2] + n * number & _MASK
                    cell[3] += 1
                    cell[4] += chars
                    cell[5] += linked
                    signed = _signed(body)
                    cell[6] = min(_signed(cell[6]), signed) & _MASK
                    cell[7] = max(_signed(cell[7]), signed) & _MASK
                    cell[8], cell[9] = min(cell[8], number, key=_signed), max(cell[9], number, key=_signed)
            if len(sums) >= GATHERED:
                yield handed_on()
    if sums:
        yield handed_on()


def deduce_templates(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """A row per host: ``slots``, an array of (token, keep), the template's tokens and whether text right below them is main text.

    Only frequent tokens enter, so a host's row has a size that depends on its pages' structure, not on their number.
    """
    read = pages.select(F.coalesce(host, F.lit("")).alias("host"), F.col(f"`{html}`").alias("html"))
    # signatures wrap around like the sums in the tasks; summed in two halves to stay within a long
    tokens = read.mapInArrow(count_tokens, TOKENS)
    low, high = F.col("signature").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("signature", 32)
    summed = tokens.groupBy("host", "token").agg(
        F.sum(low).alias("low"), F.sum(high).alias("high"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"), F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page"), F.max("flags").alias("flags"), F.max(F.size("above")).alias("depth"), F.first("above").alias("above"),
    )
    mask = F.lit(0xFFFFFFFF)
    summed = summed.withColumn("signature", F.shiftleft((F.col("high") + F.shiftrightunsigned("low", 32)).bitwiseAND(mask), 32).bitwiseOR(F.col("low").bitwiseAND(mask)))
    summed = stored(summed.drop("low", "high"), "tokens")
    roots = summed.where("token = 0").select("host", F.col("pages").alias("of"), F.col("signature").alias("root"))
    classes = summed.groupBy("host", "signature").agg(F.count("*").alias("members"))
    frequent = summed.join(roots, "host").where((F.col("pages") >= F.greatest(F.lit(1.0), F.col("of") * FREQUENT)))
    valid = frequent.join(classes, ["host", "signature"]).where("members > 1 or signature = root")
    template = valid.select("host", "token", "flags", "of", "depth")
    template = stored(template, "template")
    # each token's text goes to the slot of the deepest template token above it
    # a text that a few pages share may be theirs; one that most pages of a host show is the host's
    shown = (F.col("pages") >= UNCHANGING_PAGES) & (F.col("pages") > F.col("of") * UNCHANGING_SHARE)
    varies, distinct = F.col("first_text") != F.col("last_text"), (F.col("first_page") != F.col("last_page")) & shown
    worded = F.col("chars") > 0
    places = summed.join(roots.select("host", "of"), "host").select("host", "token", "chars", "linked", (worded & varies).alias("varies"), (worded & ~varies & distinct).alias("same"), F.explode("above").alias("slot"))
    home = places.join(template.select("host", F.col("token").alias("slot"), "depth"), ["host", "slot"])
    deepest = home.groupBy("host", "token").agg(F.max("depth").alias("depth"))
    home = home.join(deepest, ["host", "token", "depth"])
    slots = home.groupBy("host", "slot").agg(
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.max("varies").alias("varies"), F.max("same").alias("same"),
    )
    slots = template.join(slots.withColumnRenamed("slot", "token"), ["host", "token"], "left")
    free = (F.col("flags").bitwiseAND(F.lit(1)) == 0) & (F.coalesce("linked", F.lit(0)) <= F.coalesce("chars", F.lit(0)) * LINKED)
    slots = slots.withColumn("free", free).withColumn("main", F.col("flags").bitwiseAND(F.lit(2)) > 0)
    # where nothing changes from page to page, nothing tells an article from the template
    told = slots.groupBy("host", "main").agg(F.max(F.col("free") & F.coalesce("varies", F.lit(False))).alias("told"))
    slots = slots.join(told, ["host", "main"])
    unchanging = F.col("told") & F.coalesce("same", F.lit(False)) & ~F.coalesce("varies", F.lit(False))
    keep = F.col("free") & ~unchanging
    return slots.groupBy("host").agg(F.collect_list(F.struct("token", keep.alias("keep"))).alias("slots"))


def main_text(html: str | None, slots: dict[int, bool]) -> str:
    """Text of the slots that remain, and where an article is marked up of those in it."""
    if not html:
        return ""
    pieces: list[tuple[bool, str]] = []
    marked = worded = False
    open_piece: list[str] = []
    state: tuple[bool, bool] | None = None

    def close() -> None:
        nonlocal worded
        if open_piece and state:
            words = " ".join(unescape("".join(open_piece)).split())
            worded |= bool(words) and state[0]
            if words and state[1]:
                pieces.append((state[0], words))
        open_piece.clear()

    for kind, place, data in walk(html):
        if kind != "text":
            close()
            state = None
            if kind == "open":
                marked |= place.main and not place.aside
            continue
        if place.aside:
            continue
        kept = next((slots[h] for h in reversed(place.up) if h in slots), True)
        state = (place.main, kept)
        open_piece.append(data[0])
    close()
    if marked and worded:
        pieces = [x for x in pieces if x[0]]
    return " ".join(words for _, words in pieces)


def extract(pages: DataFrame, host: Column, html: str = "html") -> DataFrame:
    """The frame with the column ``text``, which replaces a column of that name: the main text of each page.

    Character references are decoded, white space within a block becomes one space, blocks are joined in page order by
    one space. Pages of one host share a template; pages without a host share one too. Null and empty pages have empty
    text; html without any tag is text as it stands. Repeated rows come out alike. An empty table gives an empty table.
    """
    templates = stored(deduce_templates(pages, host, html), "templates")
    rows = pages.select(packed(pages), F.coalesce(host, F.lit("")).alias("host")).join(templates, "host", "left")

    def every(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[bytes, dict[int, bool]] = {}
        for htmls, lists in parts:
            out = []
            for html, listed in zip(htmls, lists, strict=True):
                slots: dict[int, bool] = {}
                if listed is not None and len(listed):
                    key = bytes(listed)
                    if key not in known:
                        if len(known) > 100:
                            known.clear()
                        known[key] = _slots(key)
                    slots = known[key]
                out.append(main_text(html if isinstance(html, str) else None, slots))
            yield pd.Series(out, dtype=object)

    every.__annotations__ = {"parts": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    # one short binary a page: token in hex and its flag
    coded = F.array_join(F.transform("slots", lambda x: F.concat(F.hex(x["token"]), F.when(x["keep"], "+").otherwise("-"))), "").cast("binary")
    text = F.pandas_udf(every, "string").asNondeterministic()(F.col("row").getField(html), coded)
    return rows.select(*unpacked(pages.columns, "text"), text.alias("text"))


def _slots(coded: bytes) -> dict[int, bool]:
    return {int(m[1], 16): m[2] == "+" for m in re.finditer(r"([0-9A-F]+)([+-])", coded.decode())}
