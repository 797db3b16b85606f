"""Pages as tag events: one pass of a tag and attribute state machine, shared by text, links, signals and forms.

Quoted values may hold ``>``, tags and quotes of the other kind. Scripts and styles end at their
own closing tag only, comments at ``-->``; what is never closed reaches to the end of the page.
A ``<`` that begins no tag is text. There is no limit on the length of anything.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, functions as F

EVENT = "struct<kind:string,name:string,values:map<string,string>,text:string,start:int,stop:int,form:int>"
EVENTS = f"array<{EVENT}>"
NAME = re.compile(r"[A-Za-z][^\s/>]*")
SKIP = re.compile(r"[\s/]*")
KEY = re.compile(r"[^\s/>][^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")
# Elements whose content is not markup, and those of them that show their text.
RAW = ("script", "style", "textarea", "title")
SHOWN = ("textarea", "title")
#: Events held as objects of Python before they become Arrow's.
AT_ONCE = 8192
_FIELDS = (("kind", pa.string()), ("name", pa.string()), ("values", pa.map_(pa.string(), pa.string())), ("text", pa.string()),
           ("start", pa.int32()), ("stop", pa.int32()), ("form", pa.int32()))


def _values(html: str, at: int) -> tuple[list[tuple[str, str]], int]:
    """The attributes from a place inside a tag on, and where the tag ends; of equal names the first counts."""
    found: dict[str, str] = {}
    size = len(html)
    while True:
        at = SKIP.match(html, at).end()
        if at >= size:
            return list(found.items()), size
        if html[at] == ">":
            return list(found.items()), at + 1
        key = KEY.match(html, at)
        at, value = key.end(), ""
        equals = EQUALS.match(html, at)
        if equals:
            at = equals.end()
            quote = html[at:at + 1]
            if quote in ("'", '"') and quote:
                stop = html.find(quote, at + 1)
                stop = size if stop < 0 else stop
                value, at = html[at + 1:stop], min(size, stop + 1)
            else:
                bare = BARE.match(html, at)
                value, at = bare[0], bare.end()
        found.setdefault(key[0].lower(), value)


def scan(html: str) -> list[tuple]:
    """Events of a page: ``open``, ``close``, ``text``, ``comment`` and ``raw`` (the content of a script or style).

    ``form`` numbers the form an event lies in, -1 outside; a form inside a form is ignored, as
    browsers do. An open label carries the text up to its end.
    """
    out: list[list] = []
    at, size, form, forms, label = 0, len(html), -1, 0, None

    def text(begin: int, end: int) -> None:
        if end > begin:
            out.append(["text", None, None, html[begin:end], begin, end, form])

    while at < size:
        begin = html.find("<", at)
        while 0 <= begin < size - 1 and not (html[begin + 1] in "!?/" or NAME.match(html, begin + 1)):
            begin = html.find("<", begin + 1)
        if begin < 0 or begin >= size - 1:
            text(at, size)
            break
        text(at, begin)
        if html.startswith("<!--", begin):
            stop = html.find("-->", begin + 4)
            at = size if stop < 0 else stop + 3
            out.append(["comment", None, None, None, begin, at, form])
            continue
        close = html[begin + 1] == "/"
        name = NAME.match(html, begin + 1 + close)
        if not name:  # a declaration, or an end tag without a name
            stop = html.find(">", begin)
            at = size if stop < 0 else stop + 1
            out.append(["comment", None, None, None, begin, at, form])
            continue
        tag = name[0].lower()
        values, at = _values(html, name.end())
        if close:
            out.append(["close", tag, None, None, begin, at, form])
            if tag == "form":
                form = -1
            elif tag == "label" and label is not None:
                _label(out, label)
                label = None
            continue
        if tag == "form" and form < 0:
            form, forms = forms, forms + 1
        out.append(["open", tag, values, None, begin, at, form])
        if tag == "label":
            if label is not None:
                _label(out, label)
            label = len(out) - 1
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|$)", re.I).search(html, at)
            stop = end.start() if end else size
            if tag in SHOWN:
                text(at, stop)
            elif stop > at:
                out.append(["raw", tag, None, None, at, stop, form])
            at = stop
    if label is not None:
        _label(out, label)
    return out


def _label(out: list[list], at: int) -> None:
    out[at][3] = " ".join(e[3] for e in out[at + 1:] if e[0] == "text")


def _pack(flat: list[list], packed: list[list[pa.Array]]) -> None:
    """Events become Arrow's columns, a piece of each field."""
    for pieces, column, (_, kind) in zip(packed, list(zip(*flat)) or [[]] * len(_FIELDS), _FIELDS):
        pieces.append(pa.array(column, kind))


def _joined(pieces: list[pa.Array]) -> pa.Array:
    """The pieces of a field in one, which then are gone."""
    whole = pa.concat_arrays(pieces)
    pieces.clear()
    return whole


def events_of(pages: pa.Array, kinds: tuple[str, ...] | None = None, names: tuple[str, ...] | None = None,
              keys: tuple[str, ...] | None = None) -> pa.ListArray:
    """The events of each page; Python holds them as objects only by thousands, the rest are Arrow's columns."""
    def told(event: list) -> bool:
        return (kinds is None or event[0] in kinds) and (names is None or event[1] in names)

    sizes, flat, packed = [0], [], [[] for _ in _FIELDS]
    for page in pages:
        own = [e for e in scan(page.as_py()) if told(e)] if page.is_valid else []
        if keys is not None:
            for event in own:
                event[2] = event[2] and [pair for pair in event[2] if pair[0] in keys]
        sizes.append(sizes[-1] + len(own))
        flat += own
        if len(flat) >= AT_ONCE:
            _pack(flat, packed)
            flat = []
    _pack(flat, packed)
    events = pa.StructArray.from_arrays([_joined(pieces) for pieces in packed], [n for n, _ in _FIELDS])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), events)


def tag_events(html: Column | str, kinds: tuple[str, ...] | None = None, names: tuple[str, ...] | None = None,
               keys: tuple[str, ...] | None = None) -> Column:
    """The events of a page as an array, in page order; an empty one for NULL.

    A reader of only some ``kinds`` of events, tag ``names`` or attributes (``keys``) says so; the
    rest then never leaves the scan.
    """
    @F.arrow_udf(EVENTS)
    def found(pages: pa.Array) -> pa.Array:
        return events_of(pages, kinds, names, keys)

    return found(F.col(html) if isinstance(html, str) else html)


def opened(events: Column, *names: str) -> Column:
    """The open tags, all or of the given names."""
    return F.filter(events, lambda e: (e["kind"] == "open") & (e["name"].isin(*names) if names else F.lit(True)))


def values_of(events: Column, *keys: str) -> Column:
    """The non-empty values of the given attributes over all tags, in page order."""
    own = F.flatten(F.transform(opened(events), lambda e: F.array(*[F.try_element_at(e["values"], F.lit(k)) for k in keys])))
    return F.filter(own, lambda v: F.coalesce(v, F.lit("")) != "")


def source_of(html: Column, event: Column) -> Column:
    """The page's own characters of an event."""
    return F.substring(html, event["start"] + 1, event["stop"] - event["start"])


def visible_text(events: Column) -> Column:
    """The text a reader sees, tags and comments as blanks; entities are left as they are."""
    shown = F.transform(events, lambda e: F.when(e["kind"] == "text", e["text"]).otherwise(" "))
    return F.array_join(shown, "")
