"""Pieces of stored HTML pages as column expressions.

An element is found by its opening tag and runs to the closing tag that balances it, however
deep its kind is nested.  Comments and scripts are no markup.  Tag and attribute names match
in either case; attribute values may be double-quoted, single-quoted or bare.  A paragraph
ends where a block begins, a list item where the next one does.

Closed elements with up to `DEPTH` levels of their own kind inside are read by one pattern.  Where
the number of opening tags shows that some are deeper, inside each other or unclosed, the tags are
walked with a stack instead, with equal results.  Patterns use possessive loops, so long or broken
pages cost linear time and no stack; the walk gathers texts in pieces, so it is linear too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casario.functions import bind, decode_entities

# Elements without content, and opening tags that end a paragraph.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCKS = (
    "address", "article", "aside", "blockquote", "center", "dir", "div", "dl", "fieldset", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
)

_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+"""
_REST = rf"[^>=]*+(?:{_VALUE}[^>=]*+)*+>"
# The rest of a tag that has no other tag's beginning in it; it ends where _REST does.
_PLAIN = r"""[^<>=]*+(?:=\s*+(?:"[^"<]*+"|'[^'<]*+'|[^\s<>"'][^\s<>]*+|(?=>))[^<>=]*+)*+>"""
_HIDES = "!--|(?i:script|style)"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
_TOKEN = rf"</?[A-Za-z]{_REST}|<[!?][^>]*+>|(?:[^<]++|<(?![A-Za-z/!?]))++"
# A tag that opens an element with content, and a tag name that ends a paragraph.
_OPENS = rf"^<(?!(?i:{'|'.join(VOID)})\b)[A-Za-z](?![\s\S]*/>$)"
_IS_BLOCK = rf"^(?:{'|'.join(BLOCKS)})$"
# An element without tags inside, and a void tag.
_LEAF = rf"<([A-Za-z][^\s>/]*+){_REST}(?<!/>)[^<]*+</\1\s*+>|<(?i:{'|'.join(VOID)})\b{_REST}"
# Stands for something hidden between two text nodes, and for a place to split at.
_CUT, _MARK = "\x01", "\x02"

#: Levels of a kind inside itself that the pattern reads; bounds its length, not results.
DEPTH = 3
#: Tokens that are gathered together; bounds copying, not results.
PIECE = 512


@dataclass(frozen=True)
class Element:
    """A kind of element: its tag and the pattern of its opening tag."""

    tag: str
    opening: str
    #: Texts that every such tag has: classes, attribute values.
    marks: tuple[str, ...] = ()

    @property
    def closed(self) -> str:
        """Pattern of a closed element with up to DEPTH levels of its kind inside; group 1 is its content."""
        return rf"{self.opening}({_content(self.tag, DEPTH)})</{_any_case(self.tag)}\s*+>"

    @property
    def plain(self) -> str:
        """The same in markup that hides nothing, with plain tags; group 1 is the element but for its first `<`.

        Where something is hidden, or a tag of this kind is not plain, it matches all the rest and
        group 1 is empty; unless that is in an element, which is not found then.
        """
        tag = _any_case(self.tag)
        whole = rf"{self.opening[1:].removesuffix(_REST)}{_PLAIN}{_content(self.tag, DEPTH, _PLAIN, _HIDES)}</{tag}\s*+>"
        return rf"<(?:({whole})|(?:{_HIDES}|{tag}(?=[\s>/])(?!{_PLAIN}))(?s:.*))"

    @property
    def begun(self) -> str:
        """The same, or only the opening tag of any other; its group 1 is empty then, too."""
        return rf"{self.opening}(?:({_content(self.tag, DEPTH)})</{_any_case(self.tag)}\s*+>)?+"


def _content(tag: str, depth: int, rest: str = _REST, never: str = "") -> str:
    """Pattern of what an element of this kind holds, with its kind inside `depth` times at most.

    `rest` is that of its kind's tags inside; no tag begins as `never` says.
    """
    if tag == "p":
        return _without(_any_of(BLOCKS), never=never)
    if tag == "li":
        # Items inside are those of lists inside.
        inner = _without("li|ul|ol", never=never)
        for _ in range(depth):
            inner = _without("li|ul|ol", rf"<li\b{rest}{inner}</li\s*+>", never)
            inner = _without("li|ul|ol", rf"<(?:ul|ol)\b{rest}{inner}</(?:ul|ol)\s*+>", never)
        return inner
    inner = _without(tag, never=never)
    for _ in range(depth):
        inner = _without(tag, rf"<(?i:{tag})\b{rest}{inner}</(?i:{tag})\s*+>", never)
    return inner


def _any_of(names: Sequence[str]) -> str:
    """Pattern of any of the names, tried by their first letters."""
    # Paragraphs mostly end with their own closing tag.
    rest = {name[0]: [n[1:] for n in names if n[0] == name[0]] for name in sorted(names, key=lambda name: name != "p")}
    return "|".join(f"{letter}(?:{'|'.join(sorted(ends, key=len, reverse=True))})" for letter, ends in rest.items())


def _without(tags: str, but: str | None = None, never: str = "") -> str:
    """Pattern of markup without tags of these kinds, but for the elements `but`, nor any that begins as `never` says."""
    # Each round reads a tag and the text after it, which is faster than to try both.
    other = rf"<(?!/?{_any_case(tags)}\b{never and '|'}{never})"
    return rf"[^<]*+(?:(?:{other}|(?i:{but}))[^<]*+)*+" if but else rf"[^<]*+(?:{other}[^<]*+)*+"


def _any_case(names: str) -> str:
    """Pattern of a name in either case, spelled out as that is faster; of several as they are."""
    if "|" in names:
        return f"(?i:{names})"
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in names)


def _before(name: str) -> str:
    """What stands in a tag before an attribute of this name."""
    other = rf"\s(?!{_any_case(name)}\s*+=)|{_VALUE}"
    return rf"[^>=\s]*+(?:(?:{other})[^>=\s]*+)*+\s{_any_case(name)}\s*+=\s*+"


def open_tag(tag: str, classes: Sequence[str] = (), attrs: Mapping[str, str] | None = None) -> str:
    """Pattern of an opening tag that has all the classes and attribute values."""
    tests = []
    if classes:
        values = [
            rf"""(?=(?:"(?:[^"]*\s)?{n}(?:\s[^"]*)?"|'(?:[^']*\s)?{n}(?:\s[^']*)?'|{n}(?=[\s>])))"""
            for n in map(re.escape, classes)
        ]
        # As they are listed they are found at once.
        listed = f'"{re.escape(" ".join(classes))}"'
        tests.append(f"(?={_before('class')}(?:{listed}|{''.join(values)}))")
    for name, wanted in (attrs or {}).items():
        v = re.escape(wanted)
        tests.append(rf"""(?={_before(name)}(?:"{v}"|'{v}'|{v}(?=[\s>])))""")
    return rf"<{_any_case(tag)}(?=[\s>/]){''.join(tests)}{_REST}"


def element(
    tag: str, classes: Sequence[str] = (), attrs: Mapping[str, str] | None = None
) -> Element:
    return Element(tag, open_tag(tag, classes, attrs), (*classes, *(attrs or {}).values()))


def visible(html: Column) -> Column:
    """The page without comments and scripts; a mark keeps the text around them apart."""
    clean = F.regexp_replace(html, _HIDDEN, _CUT)
    # Beginning with one plain character, the test passes over text fast.
    return F.when(html.rlike(f"<(?:{_HIDES})"), clean).otherwise(html)


def cards(pages: DataFrame, card: Element, html: str = "html") -> DataFrame:
    """One row per element that matches, with its tags; one inside another gives a row too.

    All other columns of the page are carried along.  Adds `card_no` (from 0) and `card`.
    """
    others = [name for name in pages.columns if name != html]
    return pages.select(*others, F.posexplode(card_list(F.col(html), card)).alias("card_no", "card"))


def card_list(html: Column, card: Element) -> Column:
    """The elements that match, from opening to closing tag, in page order."""
    careful = bind(visible(html), lambda shown: _elements(shown, card))
    if not any(card.marks):
        return careful

    def checked(found: Column) -> Column:
        # Plain tags do not overlap and each has the mark, so if there are as many marks these are all.
        marks = F.regexp_count(html, F.lit(re.escape(max(card.marks, key=len))))
        sure = ~F.array_contains(found, "") & (F.size(found) == marks)
        return F.when(sure, F.transform(found, lambda one: F.concat(F.lit("<"), one))).otherwise(careful)

    return bind(F.regexp_extract_all(html, F.lit(card.plain), F.lit(1)), checked)


def _elements(shown: Column, card: Element) -> Column:
    def found(closed_ones: Column) -> Column:
        return F.when(_are_all(closed_ones, shown, card), closed_ones).otherwise(by_count(shown))

    def by_count(shown: Column) -> Column:
        marked = F.split(F.regexp_replace(shown, f"({card.opening})", f"{_MARK}$1"), _MARK)
        return bind(F.slice(marked, 2, F.size(marked)), lambda pieces: F.transform(pieces, lambda piece, k: closed(pieces, piece, k)))

    def closed(pieces: Column, piece: Column, k: Column) -> Column:
        # What follows the next opening tag is only needed if the element is still open there.
        rest = F.array_join(F.slice(pieces, k + 1, F.size(pieces)), "")
        return F.coalesce(_to_end(piece, card.tag), bind(rest, lambda text: F.coalesce(_to_end(text, card.tag), text)))

    return bind(F.regexp_extract_all(shown, F.lit(card.closed), F.lit(0)), found)


def _are_all(found: Column, html: Column, kind: Element) -> Column:
    """Whether as many were found as elements of this kind begin in the text.

    Counting a text that each of them has is fast, and mostly tells: there are no more of them.
    """

    def times_at_most(text: str) -> Column:
        return F.size(found) == F.regexp_count(html, F.lit(re.escape(text)))

    result = F.size(found) == F.regexp_count(html, F.lit(kind.opening))
    # The longest, which is likely the rarest, is counted first.
    for text in sorted(filter(None, kind.marks), key=len):
        result = F.when(times_at_most(text), True).otherwise(result)
    return result


def _are_whole(contents: Column, htmls: Sequence[Column] | Column, kind: Element) -> Column:
    """Whether these, read by the pattern `begun`, are of closed elements none of which is in another.

    An empty one may be of an element that is not closed, and one that has a text which each
    such opening tag has may hold another; only then the tags are counted.
    """

    def exact(html: Column) -> Column:
        return F.regexp_count(html, F.lit(kind.closed)) == F.regexp_count(html, F.lit(kind.opening))

    counted = F.forall(htmls, exact) if isinstance(htmls, Column) else exact(*htmls)
    return F.when(F.forall(contents, lambda content: (content != "") & ~_may_hold(content, kind)), True).otherwise(counted)


def _may_hold(html: Column, kind: Element) -> Column:
    """False only for texts without such an element: they lack what its opening tag has."""
    if any(kind.marks):
        return html.contains(_from_rarest(max(kind.marks, key=len)))
    first = f"<{kind.tag[0]}"
    return html.contains(first.lower()) | html.contains(first.upper())


def _from_rarest(text: str) -> str:
    """The end of a text from the character on that markup has least: it is searched for faster."""
    often = " etaoinsrhldcumpfgb<>/=\"-wyvkxjqz"
    return text[min(range(max(1, len(text) - 5)), key=lambda i: (-often.find(text[i]) if text[i] in often else -len(often), i)) :]


def _to_end(html: Column, tag: str) -> Column:
    """`html`, which begins with an opening tag, up to where that element ends; else NULL."""
    if tag == "li":
        steps, up, down = "li|ul|ol", r"^<(?:ul|ol)", r"^</(?:ul|ol)"
    elif tag == "p":
        steps, up, down = "|".join(BLOCKS), None, None
    else:
        steps, up, down = tag, rf"^<{tag}", rf"^</{tag}"
    parts = F.split(F.regexp_replace(html, rf"(?i)(</?(?:{steps})(?=[\s>/]))", f"{_MARK}$1"), _MARK)

    def step(state: Column, part: Column) -> Column:
        return bind(F.lower(F.substring(part, 1, 8)), lambda low: moved(state, low))

    def moved(state: Column, low: Column) -> Column:
        if tag == "p":
            depth, ended = state["depth"], F.lit(True)
        elif tag == "li":
            depth = state["depth"] + F.when(low.rlike(up), 1).when(low.rlike(down), -1).otherwise(0)
            ended = (depth < 0) | (state["depth"] == 0) & low.rlike("^</?li")
        else:
            depth = state["depth"] + F.when(low.startswith("</"), -1).otherwise(1)
            ended = depth < 0
        open_ = state["end"] == 0
        own_close = low.startswith(f"</{tag}")
        return F.struct(
            F.when(open_, depth).otherwise(state["depth"]).alias("depth"),
            (state["at"] + 1).alias("at"),
            F.when(open_ & ended, state["at"] + 1).otherwise(state["end"]).alias("end"),
            F.when(open_ & ended, own_close).otherwise(state["close"]).alias("close"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(2).alias("at"), F.lit(0).alias("end"), F.lit(False).alias("close"))

    def taken(parts: Column) -> Column:
        # The first part is empty and the second begins with the element's own opening tag.
        return bind(F.aggregate(F.slice(parts, 3, F.size(parts)), start, step), lambda found: upto(parts, found))

    def upto(parts: Column, found: Column) -> Column:
        kept = F.array_join(F.slice(parts, 1, F.greatest(found["end"] - 1, F.lit(0))), "")
        closing = F.regexp_extract(F.get(parts, found["end"] - 1), r"^</[^>]*+>", 0)
        return F.when(found["end"] > 0, F.concat(kept, F.when(found["close"], closing).otherwise("")))

    return bind(parts, taken)


def texts(html: Column, pattern: Element, within: Element | None = None) -> Column:
    """Text nodes directly under the elements that match, in page order.

    `within` narrows the search to what the elements that match it contain.
    """
    return bind(visible(html), lambda shown: shown_texts(shown, pattern, within))


def shown_texts(shown: Column, pattern: Element, within: Element | None = None) -> Column:
    """The same for markup without comments and scripts, as that of cards is."""

    def of_contents(contents: Column, whole: Column) -> Column:
        # Most elements hold one text and nothing else.
        plain = F.forall(contents, lambda content: (content != "") & ~content.contains("<"))
        own = F.flatten(F.transform(contents, _direct_text))
        return F.when(plain, contents).when(whole, own)

    def of_blocks(blocks: Column) -> Column:
        # Without tags inside, a block holds no element.
        tagged = F.filter(blocks, lambda block: block.contains("<"))
        return F.when(_are_whole(blocks, [shown], within), bind(tagged, of_tagged))

    def of_tagged(blocks: Column) -> Column:
        contents = F.flatten(F.transform(blocks, lambda block: _contents(block, pattern)))
        return bind(contents, lambda found: of_contents(found, _are_whole(found, blocks, pattern)))

    if within is None:
        quick = bind(_contents(shown, pattern), lambda contents: of_contents(contents, _are_whole(contents, [shown], pattern)))
    else:
        quick = bind(_contents(shown, within), of_blocks)
    nodes = bind(quick, lambda found: F.coalesce(found, _walk(shown, pattern, within)))
    pieces = lambda node: F.when(node.contains(_CUT), F.split(node, _CUT)).otherwise(F.array(node))

    def read_in_full(found: Column) -> Column:
        kept = F.filter(F.flatten(F.transform(found, pieces)), lambda node: node != "")
        return F.transform(kept, lambda node: decode_entities(node))

    def tidied(found: Column) -> Column:
        # The few texts are searched for marks and references, not the whole markup.
        special = bind(F.array_join(found, ""), lambda text: text.contains(_CUT) | text.contains("&"))
        return F.when(special, read_in_full(found)).otherwise(F.filter(found, lambda node: node != ""))

    read = bind(nodes, tidied)
    absent = F.lit(False)
    for kind in (pattern, within) if within else (pattern,):
        absent = absent | ~_may_hold(shown, kind)
    return F.when(absent, F.array().cast("array<string>")).otherwise(read)


def _contents(html: Column, pattern: Element) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern.begun), F.lit(1))


def _gathered(tokens: Column, memory: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The tokens for which a fold says so, in order.

    `step` gives the memory after a token, and whether the token is kept.  Kept ones are gathered
    in pieces of `PIECE` tokens, as appending to one long array would copy it each time.
    """

    def one(state: Column, token: Column) -> Column:
        after, kept = step(state["memory"], token)
        return F.struct(after.alias("memory"), F.when(kept, F.concat(state["kept"], F.array(token))).otherwise(state["kept"]).alias("kept"))

    def piece(state: Column, first: Column) -> Column:
        start = F.struct(state["memory"].alias("memory"), F.array().cast("array<string>").alias("kept"))
        walked = F.aggregate(F.slice(tokens, first, F.lit(PIECE)), start, one)
        return bind(walked, lambda w: F.struct(w["memory"].alias("memory"), F.concat(state["pieces"], F.array(w["kept"])).alias("pieces")))

    start = F.struct(memory.alias("memory"), F.array().cast("array<array<string>>").alias("pieces"))
    firsts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(PIECE))
    return F.flatten(F.aggregate(firsts, start, piece)["pieces"])


def _direct_text(content: Column) -> Column:
    """Text nodes of an element: what is left without the elements inside."""

    def bare(html: Column, rounds: int) -> Column:
        if not rounds:
            return _walk(content, start=":11")
        cut = F.regexp_replace(html, _LEAF, _CUT)
        return bind(cut, lambda left: F.when(left.contains("<"), bare(left, rounds - 1)).otherwise(F.split(left, _CUT)))

    return F.when(content.contains("<"), bare(content, 2)).otherwise(F.array(content))


def _walk(html: Column, pattern: Element | None = None, within: Element | None = None, start: str = ":01") -> Column:
    """Text nodes directly under the elements that match, inside of `within`, by walking all tags.

    The stack of open elements is a text of entries like `/div:01`: the name, whether the
    element matches, and whether what it contains is inside of `within`.
    """

    def step(stack: Column, token: Column) -> tuple[Column, Column]:
        name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s>/]*+)", 1))
        moved = bind(name, lambda n: bind(kept(stack, token, n), lambda left: pushed(left, token, n)))
        after = F.when(token.startswith("<") & token.rlike("^</?[A-Za-z]"), moved).otherwise(stack)
        is_text = ~(token.startswith("<") & token.rlike("^<[A-Za-z/!?]"))
        return after, is_text & (F.substring(stack, -2, 1) == "1")

    def kept(stack: Column, token: Column, name: Column) -> Column:
        """The stack without the elements that this tag ends."""
        ended = F.when(token.startswith("</") | (name == "li"), name).when(name.rlike(_IS_BLOCK), "p").otherwise("none")

        def cut(key: Column) -> Column:
            after = F.call_function("substring_index", stack, key, F.lit(-1))
            shorter = F.left(stack, F.length(stack) - F.length(after) - F.length(key))
            nested = token.rlike("^<[lL]") & after.rlike("/(?:ul|ol):")
            return F.when(stack.contains(key) & ~nested, shorter).otherwise(stack)

        return bind(F.concat(F.lit("/"), ended, F.lit(":")), cut)

    def pushed(stack: Column, token: Column, name: Column) -> Column:
        bit = lambda test: F.when(test, "1").otherwise("0")
        inside = stack.endswith("1")
        inner = inside | token.rlike(f"^{within.opening}") if within else F.lit(True)
        matches = inside & token.rlike(f"^{pattern.opening}") if pattern else F.lit(False)
        entry = F.concat(F.lit("/"), name, F.lit(":"), bit(matches), bit(inner))
        return F.when(token.rlike(_OPENS), F.concat(stack, entry)).otherwise(stack)

    tokens = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    return bind(tokens, lambda found: _gathered(found, F.lit(":00" if within else start), step))


def at(values: Column, index: int) -> Column:
    """Array element from 0, or from the end if negative; NULL out of range."""
    return F.get(values, index) if index >= 0 else F.try_element_at(values, F.lit(index))


def attributes(html: Column, tag: str, name: str) -> Column:
    """Values of one attribute on all elements of a kind, outside comments and scripts."""
    return _values(visible(html), tag, name)


def _values(html: Column, tag: str, name: str) -> Column:
    pattern = rf"""<(?i:{tag})(?=[\s/]){_before(name)}("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
    values = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.transform(values, lambda value: decode_entities(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"), attribute=True))


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page `base`.

    Both are used many times: pass columns, not long expressions.
    """
    site = F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit("://"),
                    F.try_parse_url(base, F.lit("AUTHORITY")))
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.coalesce(F.try_parse_url(base, F.lit("PATH")), F.lit(""))
    folder = F.regexp_replace(path, r"[^/]*$", "")
    suffix = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    target = F.regexp_extract(link, r"^([^?#]*)", 1)
    rooted = F.when(target.startswith("/"), target).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), target)
    )
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit(":"), link))
        .when(link == "", F.regexp_replace(base, r"#.*$", ""))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(site, _without_dots(rooted), suffix))
    )


def _without_dots(path: Column) -> Column:
    """Resolve the . and .. steps of a rooted path."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)

    def step(done: Column, name: Column) -> Column:
        parent = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return (
            F.when(name == "..", parent)
            .when(name == ".", done)
            .otherwise(F.concat(done, F.array(name)))
        )

    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    end = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), end)


def link_to_next(html: Column) -> Column:
    """The link of the page's first rel="next" element, as it is written."""
    shown = visible(html)
    tag = F.regexp_extract(shown, open_tag("a", attrs={"rel": "next"}), 0)
    return at(_values(tag, "a", "href"), 0)


def base_of(html: Column) -> Column:
    """The link of the page's first base element, as it is written."""
    return at(attributes(html, "base", "href"), 0)


def on_hosts(url: Column, hosts: Sequence[str]) -> Column:
    """Whether an address is on one of the hosts or below it."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    tests = [(host == name) | host.endswith(f".{name}") for name in hosts]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return F.coalesce(result, F.lit(False))
