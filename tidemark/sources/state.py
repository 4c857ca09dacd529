"""State that single-page applications embed in their HTML, read strictly.

Three carriers are known: a JavaScript assignment whose value may be JSON within a JSON string,
one JSON script with an id, and a stream of records pushed in chunks. Whatever is missing, there
twice or malformed raises an error whose message is a code; ``states`` makes it a row's reason, so
that nothing of a page gets into a log.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from tidemark.errors import SourceError
from tidemark.sources.pages import framed, strict_json

#: How a stream is pushed, and the letters that mark its records of modules and resource hints (fixed values).
PUSHED = "self.__next_f.push("
MARKS = ("HL", "I")


class _Scripts(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[tuple[dict, str]] = []
        self._in = False

    def handle_starttag(self, tag, attrs):
        self._in = tag == "script"
        if self._in:
            self.found.append((dict(attrs), ""))

    def handle_data(self, data):
        if self._in:
            attrs, body = self.found[-1]
            self.found[-1] = attrs, body + data

    def handle_endtag(self, tag):
        self._in = False


def scripts(html: str | None) -> list[tuple[dict, str]]:
    """Attributes and body of every script of a page."""
    reader = _Scripts()
    reader.feed(html or "")
    reader.close()
    return reader.found


def _value_at(text: str, at: int) -> tuple[str, int]:
    """The JSON text that begins at a position, and where it ends."""
    _, end = json.JSONDecoder().raw_decode(text, at)
    return text[at:end], end


def assigned(html: str | None, name: str) -> dict:
    """The object assigned to a global name, in one script only; a string is read as JSON once more."""
    place = re.compile(re.escape(name) + r"\s*=(?!=)\s*")
    found = [(body, m.end()) for _, body in scripts(html) for m in place.finditer(body)]
    if len(found) != 1:
        raise SourceError("not_one_assignment")
    value = strict_json(_value_at(*found[0])[0])
    return _an_object(strict_json(value) if isinstance(value, str) else value)


def scripted(html: str | None, ident: str = "__NEXT_DATA__") -> dict:
    """The object in the one JSON script of an id."""
    found = [(a, body) for a, body in scripts(html) if a.get("id") == ident]
    if len(found) != 1 or found[0][0].get("type") != "application/json":
        raise SourceError("not_one_script")
    return _an_object(strict_json(found[0][1]))


def _an_object(value) -> dict:
    if not isinstance(value, dict):
        raise SourceError("not_an_object")
    return value


def _calls(html: str | None) -> Iterator[object]:
    """Arguments of all calls that push to the stream, in the page's order."""
    for _, body in scripts(html):
        compact = body.replace(PUSHED[:-1] + " ", PUSHED[:-1])
        for piece in compact.split(PUSHED)[1:]:
            raw, end = _value_at(piece.lstrip(), 0)
            if piece.lstrip()[end:].lstrip()[:1] != ")":
                raise SourceError("call_of_more_than_one_value")
            yield strict_json(raw)


def _text_of(call: object) -> str:
    """The text that one call adds: none for the calls that open the stream or carry form state."""
    match call:
        case [1, str() as text]:
            return text
        case [0] | [0, _] | [2, _] if type(call[0]) is int:
            return ""
    raise SourceError("unknown_call")


def _record_of(line: str) -> tuple[str, object] | None:
    """Id and value of a line; None for a line of metadata, which is a list and may go without an id."""
    ident, parted, value = line.partition(":")
    mark = next((m for m in MARKS if value.lstrip().startswith(m)), "")
    if not parted or not (ident or mark) or set(ident) - set("0123456789abcdefABCDEF"):
        raise SourceError("line_without_id")
    read = strict_json(value.lstrip().removeprefix(mark))
    if not mark:
        return ident, read
    if not isinstance(read, list):
        raise SourceError("metadata_without_list")
    return None


def streamed(html: str | None) -> dict[str, object]:
    """Records of a pushed stream by their ids. A record may come again as it was, never changed."""
    lines = "".join(map(_text_of, _calls(html))).splitlines()
    found: dict[str, object] = {}
    for ident, value in filter(None, (_record_of(line.strip()) for line in lines if line.strip())):
        if found.setdefault(ident, value) != value:
            raise SourceError("record_changed")
    if not found:
        raise SourceError("no_records")
    return found


def _lists(value, name: str) -> Iterator[list]:
    if isinstance(value, dict):
        for k, x in value.items():
            if k == name and isinstance(x, list):
                yield x
            yield from _lists(x, name)
    elif isinstance(value, list):
        for x in value:
            yield from _lists(x, name)


def agreeing(records: dict[str, object], name: str) -> list:
    """The list of a name anywhere in the records; where it comes several times, all must be equal."""
    found = list(_lists(records, name))
    if not found or any(x != found[0] for x in found):
        raise SourceError("lists_differ")
    return found[0]


def ungrouped(items: list[dict], name: str = "relatedAds", most: int = 500) -> list[dict]:
    """Items with groups opened by one level: the members stand for their parent, which is no row itself."""
    out: list[dict] = []
    for item in items:
        members = item.get(name)
        if members is None:
            out.append(item)
        elif not isinstance(members, list) or len(members) > most or any(not isinstance(x, dict) or x.get(name) for x in members):
            raise SourceError("not_a_group_of_one_level")
        else:
            out += members
    return out


READERS = {"assigned": lambda html: assigned(html, "window.__PRERENDERED_STATE__"), "scripted": scripted, "streamed": streamed}


def _told(read: Callable, html: str | None) -> tuple[str | None, str | None]:
    """What a reader finds as JSON with sorted names, and the code of what keeps it from finding anything."""
    try:
        return json.dumps(read(html), sort_keys=True, ensure_ascii=False), None
    except SourceError as why:
        return None, str(why)
    except (ValueError, RecursionError):
        return None, "malformed_json"


def states(pages: DataFrame) -> DataFrame:
    """page_id, carrier, state (JSON, sorted names), reason: a row for each page and carrier.

    ``reason`` says why there is no state; null and empty pages have none.
    """

    def run(frames):
        found = ((page, carrier, *_told(read, html)) for frame in frames for page, html in frame.itertuples(index=False) for carrier, read in READERS.items())
        yield from framed(found, ["page_id", "carrier", "state", "reason"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, carrier string, state string, reason string")


def lists(pages: DataFrame, name: str) -> DataFrame:
    """page_id, units (JSON of the list of a name that all of a page's streamed records agree on), reason."""

    def run(frames):
        found = ((page, *_told(lambda h: agreeing(streamed(h), name), html)) for frame in frames for page, html in frame.itertuples(index=False))
        yield from framed(found, ["page_id", "units", "reason"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, units string, reason string")
