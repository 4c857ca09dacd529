"""Resumable traversal of a catalogue cut into price ranges, over any fetcher of saved pages, and source-use signals.

A cursor is a queue of ranges with the page to read next. It is a value: ``walk`` returns the
cursor to store together with the rows, and a page that fails is not passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import BudgetError, SourceError

#: First cut of an unbounded range, and the bound that cuts stay under (fixed values of price).
STEP, HIGHEST = 1_000_000, 1_000_000_000
#: Ranges that a cursor may hold.
LONGEST_QUEUE = 10_000
#: Signals and settings that are read; others are ignored (fixed values).
SIGNALS, SETTINGS = ("search", "ai-input", "ai-train"), ("yes", "no")


@dataclass(frozen=True)
class Range:
    """Prices from ``lower`` to ``upper``, both included, null for open; ``page`` is read next."""

    lower: int | None = None
    upper: int | None = None
    page: int = 1

    def __post_init__(self):
        bounds = [b for b in (self.lower, self.upper) if b is not None]
        if any(type(b) is not int or not 0 <= b <= HIGHEST for b in bounds) or len(bounds) == 2 and bounds[0] >= bounds[1] or type(self.page) is not int or not 1 <= self.page <= 1000:
            raise SourceError(f"not a range: {self}")

    def halves(self) -> list[Range]:
        """Two ranges that share their boundary; none where the range can't be cut."""
        low = self.lower or 0
        if self.upper is not None:
            middle, end = (low + self.upper) // 2, self.upper
        else:
            middle, end = max(2 * low, low + STEP), HIGHEST
        return [Range(self.lower, middle), Range(middle, self.upper)] if low < middle < end else []


@dataclass(frozen=True)
class Cursor:
    source: str
    mode: str
    queue: tuple[Range, ...] = (Range(),)
    unresolved: tuple[dict, ...] = ()

    def __post_init__(self):
        if len(self.queue) > LONGEST_QUEUE or len(self.unresolved) > LONGEST_QUEUE:
            raise SourceError("too many ranges in a cursor")

    @property
    def finished(self) -> bool:
        return not self.queue

    def text(self) -> str:
        return json.dumps({"version": 1} | asdict(self), sort_keys=True)

    @staticmethod
    def of(text: str, source: str, mode: str) -> Cursor:
        """A stored cursor; ValueError where it is another source's, another mode's, or has another shape."""
        try:
            value = json.loads(text)
            if value.pop("version") != 1 or (value["source"], value["mode"]) != (source, mode):
                raise SourceError("the cursor belongs to another traversal")
            return Cursor(**value | {"queue": tuple(Range(**r) for r in value["queue"]), "unresolved": tuple(map(dict, value["unresolved"]))})
        except (KeyError, TypeError, AttributeError) as e:
            raise SourceError("not a cursor") from e


@dataclass
class Page:
    """What a fetcher gives for a range's page: rows (listing_id, url, ...), pages in all, and whether results are capped."""

    rows: list[dict]
    pages: int
    capped: bool = False
    visible: int = 0
    total: int = 0


@dataclass
class Walk:
    cursor: Cursor
    rows: dict[str, dict] = field(default_factory=dict)
    pages: int = 0
    duplicates: int = 0
    conflicts: int = 0
    reason: str = ""


def walk(cursor: Cursor, fetch: Callable[[Range], Page], *, max_pages: int, max_listings: int, cut_capped: bool = True) -> Walk:
    """Read pages until the queue or a budget ends; the last row of an identity wins.

    Stops with reason ``reported_search_end``, ``page_budget``, ``listing_budget``, ``repeated_page``,
    or what a fetcher's BudgetError says (``request_budget``, ``deadline``); what was read before stays
    and the cursor points at the page that wasn't. A page is taken whole or, where it would pass the listing budget, not at all,
    and the cursor then still points at it. A URL under two identities is a ValueError.
    """
    out, queue, unresolved = Walk(cursor), list(cursor.queue), list(cursor.unresolved)
    owner: dict[str, str] = {}
    seen: set[tuple] = set()
    while queue and not out.reason:
        if out.pages == max_pages:
            out.reason = "page_budget"
            break
        at = queue[0]
        try:
            page = fetch(at)
        except BudgetError as e:
            out.reason = str(e)
            break
        out.pages += 1
        ids = tuple(sorted(r["listing_id"] for r in page.rows))
        if ids and (at.lower, at.upper, ids) in seen:
            out.reason = "repeated_page"
        elif len(out.rows.keys() | set(ids)) > max_listings:
            out.reason = "listing_budget"
        else:
            seen.add((at.lower, at.upper, ids))
            for row in page.rows:
                if owner.setdefault(row["url"], row["listing_id"]) != row["listing_id"]:
                    raise SourceError(f"two identities at {row['url']}")
                before = out.rows.get(row["listing_id"])
                out.duplicates += before is not None
                out.conflicts += before is not None and before != row
                if before and before["url"] != row["url"]:
                    owner.pop(before["url"], None)
                out.rows[row["listing_id"]] = row
            halves = at.halves() if cut_capped and page.capped and at.page == 1 else []
            if cut_capped and page.capped and at.page == 1 and not halves:
                unresolved.append({"lower": at.lower, "upper": at.upper, "visible": page.visible, "total": page.total})
            following = [Range(at.lower, at.upper, at.page + 1)] if at.page < page.pages else []
            queue[:1] = halves or following
    out.reason = out.reason or "reported_search_end"
    out.cursor = Cursor(cursor.source, cursor.mode, tuple(queue), tuple(unresolved))
    return out


def within_budget(pages: DataFrame, source: list[str], page: str, listing: str, budget: int) -> DataFrame:
    """Pages that a source's traversal takes whole within a budget of distinct listings: source, page, new, taken.

    A listing is new on the first page that shows it. The running sum is over a row for each page,
    of which a source has a bounded number; listings are aggregated before.
    """
    from pyspark.sql import Window

    shown = pages.select(*source, page).distinct()
    new = pages.groupBy(*source, listing).agg(F.min(page).alias(page)).groupBy(*source, page).agg(F.count("*").alias("new"))
    counted = shown.join(new, [*source, page], "left").select(*source, page, F.coalesce("new", F.lit(0)).alias("new"))
    return counted.withColumn("taken", F.sum("new").over(Window.partitionBy(*source).orderBy(page))).where(F.col("taken") <= budget)


def content_signals(robots: DataFrame, key: str, text: str) -> DataFrame:
    """Source-use signals of robots files: key, signal, setting; ``no`` wins where a file says both."""
    line = robots.select(key, F.explode(F.split(text, r"\r\n|\r|\n")).alias("line"))
    bare = F.split_part("line", F.lit("#"), F.lit(1))
    named = line.select(key, F.lower(F.trim(F.split_part(bare, F.lit(":"), F.lit(1)))).alias("name"), F.regexp_extract(bare, r"\A[^:]*:(.*)\z", 1).alias("value"))
    items = named.where("name = 'content-signal'").select(key, F.explode(F.split("value", ",")).alias("item"))
    pairs = items.select(key, F.regexp_extract(F.trim("item"), r"\A([^=]*)=", 1).alias("signal"), F.regexp_extract(F.trim("item"), r"\A[^=]*=(.*)\z", 1).alias("setting"))
    return pairs.where(F.col("signal").isin(*SIGNALS) & F.col("setting").isin(*SETTINGS)).groupBy(key, "signal").agg(F.min("setting").alias("setting"))
