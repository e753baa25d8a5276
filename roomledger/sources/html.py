"""Stored HTML to candidate texts per field: the only stage that runs in Python.

Pages arrive as Arrow batches, spread by Spark over all tasks; a page is
handled by itself, so the stage needs no shuffle. It only finds elements and
their text. Everything that reads meaning from the texts is a Column
expression on its output.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from roomledger.session import ship_package
from roomledger.sources.matchers import Rule

CANDIDATES = T.ArrayType(
    T.StructType(
        [
            T.StructField("prio", T.IntegerType()),
            T.StructField("grp", T.IntegerType()),
            T.StructField("text", T.StringType()),
        ]
    )
)

_VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
_RAW = frozenset(["script", "style", "title", "template", "noscript", "textarea"])
_BLOCK = frozenset(
    "address article aside blockquote body button dd details div dl dt fieldset figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split()
)
_SELF_CLOSING = frozenset(["p", "li", "dd", "dt", "tr", "td", "th", "option"])
_DRAWN = frozenset("path circle rect use line polygon polyline ellipse stop".split())

_REST = r"(?:(?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+(?=>)|[^>]*+)>"
# Cuts a page into texts and tags. An element of raw text is one piece, with its name as the second group.
_TAGS = re.compile(
    r"(<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    rf"|<(?=[nstNST])((?i:{'|'.join(sorted(_RAW))}))(?=[\s/>]){_REST}(?:(?:[^<]++|<(?!/(?i:\2)))*+</(?i:\2)[^>]*+>|.*)"
    rf"|</?[a-zA-Z][^\s/>]*+{_REST})",
    re.DOTALL,
)
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)({_REST})", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BREAK = "\x00"
# Runs of white space but single blanks, which stay as they are.
_SPACE = re.compile(r"[ \t\r\n\f]{2,}|[\t\r\n\f]")
_ONE_LINE = frozenset("\t\r\n\f")
_ENDS = f" {_BREAK}"


class _Page:
    """Elements of a page in document order, each by its number.

    Lists by element: its tag in the source (tokens), its parent (-1 without one), the element after its last
    descendant (ends), its range of text pieces (starts, stops), and its range of tags (opened, closed).
    """

    def __init__(self, html: str):
        self.html = html
        self.tokens: list[_Token] = []
        self.parents: list[int] = []
        self.starts: list[int] = []
        self.opened: list[int] = []
        self.pieces: list[str] = []
        self.raws: dict[int, str] = {}
        #: By element, and filed by compound for the elements of a unit; `_Able.on` sets both.
        self.fits: list[frozenset[_Compound]] = []
        self.files: dict[_Compound, list[int]] = {}
        self._texts: dict[int, str] = {}
        self._selected: dict[tuple, Sequence[int]] = {}
        self._earliest: dict[tuple, dict[int, int]] = {}
        self._children: dict[int, int] | None = None
        self._read(html)
        self.nodes = range(len(self.tokens))

    def _read(self, html: str):
        # Behind the last > nothing is a tag: it is text, and no search goes there.
        end = html.rfind(">") + 1
        if "<!--" in html and html.rfind("-->") < html.rfind("<!--"):
            end = len(html)  # an open comment takes the rest
        self.parts = parts = _TAGS.split(html[:end])
        rest = parts[-1] + html[end:]
        most = len(parts) // 3
        tokens, pieces = self.tokens, self.pieces
        parents, starts, opened = self.parents, self.starts, self.opened
        self.stops = stops = [0] * most
        self.ends = ends = [0] * most
        self.closed = closed = [0] * most
        stack: list[int] = []
        names: list[str] = []  # the tags of the stack
        counts: dict[str, int] = defaultdict(int)  # open elements by tag
        node = 0  # the number of the next element

        def close(depth: int, number: int):
            """Close the open elements from a depth on, at a tag."""
            while len(stack) > depth:
                last, tag = stack.pop(), names.pop()
                counts[tag] -= 1
                if tag in _BLOCK:
                    pieces.append(_BREAK)
                stops[last], ends[last], closed[last] = len(pieces), node, number

        known = _TOKENS.get
        number = -1
        for text, source, raw in zip(parts[::3], parts[1::3], parts[2::3]):
            number += 1
            if text:
                pieces.append(unescape(text) if "&" in text else text)
            if raw is not None:
                content = source
                source = _TAG.match(source)[0]
            token = known(source) or _token(source)
            tag, kind = token.tag, token.kind
            if kind:
                if kind & _CLOSING:
                    if names and names[-1] == tag:
                        names.pop()
                        counts[tag] -= 1
                        if kind & _BREAKS:
                            pieces.append(_BREAK)
                        last = stack.pop()
                        stops[last] = len(pieces)
                        ends[last] = node
                        closed[last] = number
                    elif counts[tag]:
                        depth = len(stack) - 2
                        while names[depth] != tag:
                            depth -= 1
                        close(depth, number)
                    continue
                if kind & _NO_ELEMENT:
                    continue
                if kind & _ENDS_ITSELF and counts[tag]:
                    for depth in range(len(stack) - 1, -1, -1):
                        other = names[depth]
                        if other == tag:
                            close(depth, number)
                            break
                        if other in _BLOCK:
                            break
                if kind & _BREAKS:
                    pieces.append(_BREAK)
            tokens.append(token)
            parents.append(stack[-1] if stack else -1)
            starts.append(len(pieces))
            opened.append(number)
            if raw is not None or kind & _EMPTY:
                stops[node], ends[node], closed[node] = len(pieces), node + 1, number
                if raw is not None:
                    inside = content[len(source) :]
                    stop = _closer(tag).search(inside)
                    if stop:
                        inside = inside[: stop.start()]
                    else:
                        inside, rest = inside + html[end:], ""
                    self.raws[node] = inside if tag in ("script", "style") else unescape(inside)
            else:
                counts[tag] += 1
                stack.append(node)
                names.append(tag)
            node += 1
        if rest:
            pieces.append(_decoded(rest))
        close(0, number + 1)

    def title(self) -> str | None:
        """The text of the first title."""
        for node, raw in self.raws.items():
            if self.tokens[node].tag == "title":
                return raw.strip()
        return None

    def file(self, low: int, high: int, only: frozenset[_Compound] | None = None):
        """File the elements of a unit by what they fit, in document order."""
        self.files = files = {}
        fits = self.fits
        for node in range(low, high):
            for compound in fits[node] if only is None else fits[node] & only:
                if compound in files:
                    files[compound].append(node)
                else:
                    files[compound] = [node]

    def filed(self, compound: _Compound, low: int, high: int) -> Sequence[int]:
        """The elements from low to high that fit, in document order; only those of the unit are filed."""
        places = self.files.get(compound)
        if places is None:
            return ()
        if low > places[0] or high <= places[-1]:
            start = bisect_left(places, low)
            return places[start : bisect_left(places, high, lo=start)]
        return places

    def inside(self, root: int | None) -> tuple[int, int]:
        """The range of the elements inside of another."""
        return (0, len(self.tokens)) if root is None else (root + 1, self.ends[root])

    def place(self, node: int) -> int:
        """The number of an element among the children of its parent, from 1."""
        if self._children is None:
            counts: dict[int, int] = defaultdict(int)
            self._children = {}
            for child, parent in enumerate(self.parents):
                counts[parent] += 1
                self._children[child] = counts[parent]
        return self._children[node]

    def earliest(self, node: int, chain: tuple[_Part, ...], root: int | None) -> int:
        """The first sibling of an element that matches; the matches are found once per unit."""
        parent = self.parents[node]
        around = node == root  # its siblings are around the unit
        key = (chain, root, around)
        firsts = self._earliest.get(key)
        if firsts is None:
            firsts = self._earliest[key] = {}
            low, high = self.inside(root)
            if around:
                low, high = self.inside(None if parent < 0 else parent)
                found = (n for n in range(low, high) if self.parents[n] == parent)
            else:
                found = self.filed(chain[-1].compound, low, high)
            for other in found:
                above = self.parents[other]
                if above not in firsts and _matches(self, other, chain, root):
                    firsts[above] = other
        return firsts.get(parent, len(self.tokens))

    def text(self, node: int) -> str:
        """Text as shown: white space collapsed, one line per block."""
        text = self._texts.get(node)
        if text is None:
            # What is at the ends goes anyway, and most texts have no other break and nothing to collapse.
            text = "".join(self.pieces[self.starts[node] : self.stops[node]]).strip(_ENDS)
            if "  " in text or not _ONE_LINE.isdisjoint(text):
                text = _SPACE.sub(" ", text)
            if _BREAK in text:
                text = "\n".join([line for part in text.split(_BREAK) if (line := part.strip(" "))])
            text = self._texts[node] = text.strip()
        return text

    def outer(self, node: int) -> str:
        """The element in the source, with its tags."""
        at = list(accumulate(len(part or "") if i % 3 < 2 else 0 for i, part in enumerate(self.parts)))
        start = at[3 * self.opened[node]]
        stop = at[3 * self.closed[node]] if 3 * self.closed[node] + 1 < len(self.parts) else len(self.html)
        tag = self.tokens[node].tag
        ends = self.html.startswith("</", stop) and self.html[stop + 2 : stop + 2 + len(tag)].lower() == tag
        return self.html[start : self.html.find(">", stop) + 1 if ends else stop]

    def select(self, root: int | None, selector: _Selector) -> Sequence[int]:
        """Elements inside of another that match; several fields ask for the same ones."""
        key = (selector, root)
        nodes = self._selected.get(key)
        if nodes is None:
            nodes = self._selected[key] = _select(self, root, selector.chains)
        return nodes


def _decoded(text: str) -> str:
    return unescape(text) if "&" in text else text


@cache
def _closer(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}[^>]*+>", re.IGNORECASE)


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name. Tags of the same source share them, so they must not change."""
    if "=" not in text and not text.strip(" /"):
        return {}
    return {
        m[0].lower(): _decoded(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(text)
    }


# What a tag does, as bits.
_CLOSING, _BREAKS, _EMPTY, _ENDS_ITSELF, _NO_ELEMENT = 1, 2, 4, 8, 16
#: Tags by their source, as pages repeat those of their layout. The memory is bounded.
_TOKENS: dict[str, _Token] = {}
_MOST_TOKENS, _LONGEST_TOKEN = 4096, 1024


class _Token:
    """A tag: its name, its attributes, the keys its element can be looked up by, and what it does."""

    __slots__ = ("tag", "attrs", "keys", "kind")

    def __init__(self, tag: str, attrs: dict[str, str], keys: list[tuple], kind: int):
        self.tag, self.attrs, self.keys, self.kind = tag, attrs, keys, kind


#: A comment or a declaration.
_NOTHING = _Token("", {}, [], _NO_ELEMENT)


def _token(source: str) -> _Token:
    if source[1] in "!?":
        return _NOTHING
    closing, name, attributes = _TAG.match(source).groups()
    tag, attributes = name.lower(), attributes[:-1]
    kind = _BREAKS * (tag in _BLOCK or (tag == "br" and not closing))
    attrs, keys = {}, []
    if closing:
        kind |= _CLOSING
    else:
        kind |= _EMPTY * (tag in _VOID or (tag in _DRAWN and attributes.endswith("/")))
        kind |= _ENDS_ITSELF * (tag in _SELF_CLOSING)
        attrs = _attributes(attributes)
        keys.append(("tag", tag, None))
        for name, value in attrs.items():
            keys.append(("has", name, None))
            keys.append(("equal", name, value))
            if name == "class":
                keys += [("word", name, word) for word in set(value.split())]
    token = _Token(tag, attrs, keys, kind)
    if len(source) <= _LONGEST_TOKEN:
        if len(_TOKENS) >= _MOST_TOKENS:
            _TOKENS.clear()
        _TOKENS[source] = token
    return token


class _Compound:
    """What an element has to be by itself: its tag and its attributes. Equal ones are the same object."""

    __slots__ = ("tag", "tests")

    def __init__(self, tag: str | None, tests: tuple):
        self.tag, self.tests = tag, tests

    def fits(self, token: _Token) -> bool:
        if self.tag and token.tag != self.tag:
            return False
        attrs = token.attrs
        for kind, name, value in self.tests:
            if kind == "without":
                if name in attrs:
                    return False
            elif name not in attrs:
                return False
            elif kind == "equal":
                if attrs[name] != value:
                    return False
            elif kind == "part":
                if value not in attrs[name]:
                    return False
            elif kind == "word" and value not in attrs[name].split():
                return False
        return True


@cache
def _compound(tag: str | None, tests: tuple) -> _Compound:
    return _Compound(tag, tests)


class _Part(NamedTuple):
    """One compound of a selector, its number among the children of its parent, and how it relates to the part before."""

    relation: str
    compound: _Compound
    nth: int | None


class _Chain(NamedTuple):
    """An alternative of a selector: its parts and the compound of the elements it can end in.

    ``exact`` says that every element that fits it matches. A unit without an element for one of ``needs`` has
    no match. ``pair`` says that it is one part anywhere inside of another (" ") or behind it among the children
    of one parent ("~").
    """

    parts: tuple[_Part, ...]
    last: _Compound
    exact: bool
    needs: frozenset[_Compound]
    pair: str | None


class _Selector:
    """The alternatives of a selector. Equal ones are the same object."""

    __slots__ = ("chains",)

    def __init__(self, chains: list[_Chain]):
        self.chains = chains

    def within(self, present: frozenset[_Compound]) -> _Selector | None:
        """The alternatives that a unit with just these compounds can match."""
        chains = [chain for chain in self.chains if chain.needs <= present]
        return _narrowed(tuple(chains)) if chains else None


@cache
def _narrowed(chains: tuple[_Chain, ...]) -> _Selector:
    return _Selector(list(chains))


_TOKEN = re.compile(
    r"\s*([>~])\s*|(\s+)|\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:(\*?)='([^']*)')?\]"
    r"|:not\(\[([\w-]+)\]\)|:nth-child\((\d+)\)|([a-zA-Z][\w-]*)"
)


@cache
def _compile(selector: str) -> _Selector:
    alternatives = []
    for text in re.split(r",\s*(?![^\[]*\])", selector.strip()):
        chain, relation, tag, tests, place = [], "", None, [], None
        for m in _TOKEN.finditer(text.strip()):
            step, blank, css, ident, name, part, value, without, nth, element = m.groups()
            if step or blank:
                if tag or tests or place:
                    chain.append(_Part(relation, _compound(tag, tuple(tests)), place))
                relation, tag, tests, place = step or " ", None, [], None
            elif css:
                tests.append(("word", "class", css))
            elif ident:
                tests.append(("equal", "id", ident))
            elif name:
                kind = "part" if part else "has" if value is None else "equal"
                tests.append((kind, name, value))
            elif without:
                tests.append(("without", without, None))
            elif nth:
                place = int(nth)
            else:
                tag = element.lower()
        chain.append(_Part(relation, _compound(tag, tuple(tests)), place))
        last = chain[-1]
        # In front of the unit itself may be siblings of it, which are not in it.
        inner = chain[-1:] if len(chain) > 2 and any(part.relation == "~" for part in chain) else chain
        alternatives.append(_Chain(
            tuple(chain), last.compound,
            len(chain) == 1 and relation == "" and last.nth is None,
            frozenset(part.compound for part in inner),
            relation if len(chain) == 2 and relation in (" ", "~") and (chain[0].relation, chain[0].nth, last.nth) == ("", None, None) else None,
        ))
    return _Selector(alternatives)


def _matches(page: _Page, node: int, chain: tuple[_Part, ...], root: int | None) -> bool:
    relation, compound, nth = chain[-1]
    if compound not in page.fits[node] or (nth is not None and page.place(node) != nth):
        return False
    rest = chain[:-1]
    above = page.parents[node]
    if not rest:
        return relation != ">" or above == (-1 if root is None else root)
    if relation == "~":
        return page.earliest(node, rest, root) < node
    while above >= 0:
        if _matches(page, above, rest, root):
            return True
        if relation == ">" or above == root:
            return False
        above = page.parents[above]
    return False


class _Finder:
    """Runs one rule on one unit (a page or a card of it)."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.scopes = [_compile(s) for s in rule.scope]
        self.target = None if rule.selector == ":self" else _compile(rule.selector)
        self.up = _compile(rule.up) if rule.up else None
        self.then = _compile(rule.then) if rule.then else None
        self.plain = rule.take == "text" and self.up is None and self.then is None
        self.only = None

    def selectors(self) -> list[_Selector]:
        return [s for s in (*self.scopes, self.target, self.up, self.then) if s is not None]

    def within(self, present: frozenset[_Compound]) -> _Finder | None:
        """The finder for units that have just these compounds; None if they can not match."""
        selectors = self.scopes if self.target is None else (*self.scopes, self.target)
        narrowed = [selector.within(present) for selector in selectors]
        if None in narrowed:
            return None
        finder = _Finder(self.rule)
        finder.scopes = narrowed[: len(self.scopes)]
        if self.target is not None:
            finder.target = narrowed[-1]
            if not self.scopes and len(finder.target.chains) == 1 and self.rule.take != "count":
                finder.only = finder.target.chains[0]
        return finder

    def run(self, page: _Page, root: int | None) -> list[tuple[int, int, str]]:
        rule, only = self.rule, self.only
        if only is not None:
            if only.exact:
                nodes = page.files[only.last]
                if root is not None and (nodes[0] <= root or nodes[-1] >= page.ends[root]):
                    nodes = page.filed(only.last, root + 1, page.ends[root])
            else:
                nodes = page.select(root, self.target)
            return self._taken(page, nodes[:1] if rule.first else nodes) if nodes else []
        found = []
        roots = [root]
        for level, scope in enumerate(self.scopes):
            inside = page.select(roots[0], scope)
            if not inside:
                return found
            roots = inside if rule.each and level == len(self.scopes) - 1 else inside[:1]
        for number, base in enumerate(roots):
            nodes = [base] if self.target is None else page.select(base, self.target)
            if rule.take == "count":
                found.append((rule.prio, number, f"#{len(nodes)}"))
            elif nodes:
                taken = self._taken(page, nodes[:1] if rule.first else nodes)
                found += [(prio, number, text) for prio, _, text in taken] if rule.each else taken
        return found

    def _taken(self, page: _Page, nodes: Sequence[int]) -> list[tuple[int, int, str]]:
        """The texts of elements, numbered by element."""
        prio = self.rule.prio
        if self.plain:
            text = page.text
            if len(nodes) == 1:
                return [(prio, 0, text(nodes[0]))]
            return [(prio, order, text(node)) for order, node in enumerate(nodes)]
        taken = []
        for order, node in enumerate(nodes):
            found = self._take(page, node)
            if found is not None:
                taken.append((prio, order, found))
        return taken

    def _take(self, page: _Page, node: int) -> str | None:
        if self.up is not None:
            node = page.parents[node]
            while node >= 0 and not any(_matches(page, node, chain.parts, None) for chain in self.up.chains):
                node = page.parents[node]
            if node < 0:
                return None
        if self.then is not None:
            inside = page.select(node, self.then)
            if not inside:
                return None
            node = inside[0]
        take = self.rule.take
        if take == "text":
            return page.text(node)
        if take == "html":
            return page.outer(node)
        if take == "raw":
            return (page.raws.get(node) or page.text(node)).strip()
        attrs = page.tokens[node].attrs
        for name in take:
            value = attrs.get(name)
            if value and (value := value.strip()):
                return value
        return None


def _select(page: _Page, root: int | None, alternatives: list[_Chain]) -> Sequence[int]:
    low, high = (0, len(page.tokens)) if root is None else (root + 1, page.ends[root])
    found: Sequence[int] = ()
    for chain in alternatives:
        nodes = page.files.get(chain.last)
        if nodes is None:
            continue
        if low > nodes[0] or high <= nodes[-1]:
            nodes = page.filed(chain.last, low, high)
        if nodes and not chain.exact:
            if chain.pair:
                nodes = (_inside if chain.pair == " " else _behind)(page, chain, low, high)
            else:
                nodes = [n for n in nodes if _matches(page, n, chain.parts, root)]
        if nodes:
            found = sorted({*found, *nodes}) if found else nodes
    return found


def _inside(page: _Page, chain: _Chain, low: int, high: int) -> Sequence[int]:
    """Matches of "outer inner", from the few outer elements down.

    The unit itself may be the outer element, elements around it may not.
    """
    found: Sequence[int] = ()
    last = 0
    for node in page.filed(chain.parts[0].compound, max(low - 1, 0), high):
        start, stop = max(low, node + 1, last), min(high, page.ends[node])
        if start < stop:
            nodes = page.filed(chain.last, start, stop)
            found = [*found, *nodes] if found else nodes
            last = stop  # elements inside of this one have no others
    return found


def _behind(page: _Page, chain: _Chain, low: int, high: int) -> Sequence[int]:
    """Matches of "first ~ later", which have one parent."""
    parents = page.parents
    firsts: dict[int, int] = {}
    for node in page.filed(chain.parts[0].compound, low, high):
        firsts.setdefault(parents[node], node)
    return [n for n in page.filed(chain.last, low, high) if firsts.get(parents[n], n) < n]


class _Able:
    """The finders that a unit can match, by what its elements fit.

    Units of one layout have the same compounds, so most answers are known. The memory is bounded.
    """

    def __init__(self, finders: list[_Finder], containers: Sequence[str] = ()):
        self.finders = finders
        self.containers = [_compile(selector) for selector in containers]
        self._around = frozenset(p.compound for s in self.containers for chain in s.chains for p in chain.parts)
        selectors = [*self.containers, *(s for f in finders for s in f.selectors())]
        compounds = {part.compound for s in selectors for chain in s.chains for part in chain.parts}
        self.drawers: dict[tuple, list[_Compound]] = defaultdict(list)
        self.pieces: dict[str, list[tuple[str, _Compound]]] = defaultdict(list)
        self.anything: list[_Compound] = []
        for compound in compounds:
            key = _drawer(compound)
            if key is None:
                self.anything.append(compound)
            elif key[0] == "part":
                self.pieces[key[1]].append((key[2], compound))
            else:
                self.drawers[key].append(compound)
        self._fits: dict[_Token, frozenset[_Compound]] = {}
        self._known: dict[frozenset[_Compound], list[_Finder]] = {}
        self._climbs = any(f.up is not None for f in finders)

    def fits(self, token: _Token) -> frozenset[_Compound]:
        """The compounds that a tag fits."""
        fits = self._fits.get(token)
        if fits is None:
            found = [c for key in token.keys for c in self.drawers.get(key, ()) if c.fits(token)]
            for name, value in token.attrs.items():
                if name in self.pieces:
                    found += [c for piece, c in self.pieces[name] if piece in value and c.fits(token)]
            found += [c for c in self.anything if c.fits(token)]
            if len(self._fits) >= _MOST_TOKENS:
                self._fits.clear()
            fits = self._fits[token] = frozenset(found)
        return fits

    def units(self, page: _Page) -> Sequence[int]:
        """The cards of a page: all matches of the first container selector with any."""
        self._mark(page)
        page.file(0, len(page.tokens), self._around)
        for selector in self.containers:
            cards = page.select(None, selector)
            if cards:
                return cards
        return ()

    def _mark(self, page: _Page):
        if len(page.fits) < len(page.tokens):
            known, fits = self._fits.get, self.fits
            page.fits = [known(token) or fits(token) for token in page.tokens]

    def on(self, page: _Page, unit: int | None) -> list[_Finder]:
        self._mark(page)
        if unit is None:
            page.file(0, len(page.tokens))
        else:
            page.file(unit, page.ends[unit])
        present = frozenset(page.files)
        able = self._known.get(present)
        if able is None:
            if len(self._known) >= 4096:
                self._known.clear()
            narrowed = [f.within(present) for f in self.finders]
            able = self._known[present] = [f for f in narrowed if f is not None]
        if self._climbs and unit is not None:
            page.file(0, len(page.tokens))  # these rules leave the unit
        return able


def _drawer(compound: _Compound) -> tuple | None:
    """The most selective key by which the elements that can fit are known; None for any element."""
    for kind, name, value in compound.tests:
        if kind in ("equal", "word"):
            return kind, name, value
    for kind, name, value in compound.tests:
        if kind == "part":
            return kind, name, value
        if kind == "has":
            return kind, name, None
    return ("tag", compound.tag, None) if compound.tag else None


def _column(offsets: list[int], found: list[tuple[int, int, str]]) -> pa.Array:
    prio, grp, text = zip(*found) if found else ((), (), ())
    items = pa.StructArray.from_arrays(
        [pa.array(prio, pa.int32()), pa.array(grp, pa.int32()), pa.array(text, pa.string())],
        names=["prio", "grp", "text"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


def extract(
    pages: DataFrame,
    rules: list[Rule],
    containers: list[str] | None = None,
    html: str = "html",
    keep_html: bool = False,
    only: Sequence[str] | None = None,
    unless: Callable[[str | None, str | None], bool] | None = None,
) -> DataFrame:
    """Replace the HTML column by one candidate array per field.

    With ``containers`` the result has a row per card, numbered by ``unit``,
    and one row with a null ``unit`` for a page without cards; without, a row
    per page. ``page_title`` is the title and ``units`` the number of cards. A page
    that can not be read has no units and the reason in ``page_error``.
    ``keep_html`` passes the HTML on, once per page. With ``only`` the other fields
    are not looked for: their arrays are empty. Pages that `unless` says yes to, by their title and their
    address in the column url, are not searched and have no units.
    """
    ship_package(pages.sparkSession)
    fields = list(dict.fromkeys(rule.field for rule in rules))
    if only is not None:
        rules = [rule for rule in rules if rule.field in only]
    kept = [f for f in pages.schema if f.name != html]
    schema = T.StructType(
        [
            *kept,
            T.StructField("page_title", T.StringType()),
            T.StructField("page_error", T.StringType()),
            T.StructField("units", T.IntegerType()),
            T.StructField("unit", T.IntegerType()),
            *[T.StructField(name, CANDIDATES) for name in fields],
            *([T.StructField(html, T.StringType())] if keep_html else []),
        ]
    )

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [_Finder(rule) for rule in rules]
        able = _Able(finders, containers or ())
        places = {field: place for place, field in enumerate(fields)}

        def read(text: str, address: str | None) -> tuple[str | None, list[list[tuple[int, list]]]]:
            """The title of a page, and the candidates of each unit with the place of their field."""
            page = _Page(text)
            name = page.title()
            if unless is not None and unless(name, address):
                return name, []
            rows = []
            for unit in able.units(page) if containers else [None]:
                row = []
                for finder in able.on(page, unit):
                    found = finder.run(page, unit)
                    if found:
                        row.append((places[finder.rule.field], found))
                rows.append(row)
            return name, rows

        for batch in batches:
            source, titles, errors, counts, numbers = [], [], [], [], []
            columns: list[list] = [[] for _ in fields]
            offsets = [[0] * len(fields)]
            texts = batch.column(html).to_pylist()
            addresses = [None] * len(texts) if unless is None else batch.column("url").to_pylist()
            for position, (text, address) in enumerate(zip(texts, addresses)):
                try:
                    name, found = read(text or "", address)
                except Exception as error:  # one page must not end the job
                    name, found = f"{type(error).__name__}: {error}"[:200], None
                for number, row in enumerate(found or [None]):
                    source.append(position)
                    titles.append(None if found is None else name)
                    errors.append(name if found is None else None)
                    counts.append(len(found or []))
                    numbers.append(None if row is None else number)
                    for place, candidates in row or ():
                        columns[place] += candidates
                    offsets.append([len(column) for column in columns])
            rest = batch.select([f.name for f in kept]).take(pa.array(source, pa.int64()))
            whole = []
            if keep_html:
                once = [s if not n else None for s, n in zip(source, numbers)]
                whole.append(batch.column(html).take(pa.array(once, pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [
                    *rest.columns,
                    pa.array(titles, pa.string()),
                    pa.array(errors, pa.string()),
                    pa.array(counts, pa.int32()),
                    pa.array(numbers, pa.int32()),
                    *[_column(ends, column) for ends, column in zip(zip(*offsets), columns)],
                    *whole,
                ],
                names=[f.name for f in schema],
            )

    return pages.select(*[f.name for f in kept], html).mapInArrow(stage, schema)
