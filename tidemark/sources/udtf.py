"""Parsers as table functions, for SQL: ``SELECT * FROM pages p, LATERAL listings(p.html, p.url)``.

Each gives the raw rows of its parser, one for each entity or link of a page; a page that can't be read
gives none, or a row with its reason where the parser tells one. The column types are fixed, whatever
the arguments; a null page gives no row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tidemark.errors import InputError
from tidemark.sources import pages, state


def _texts(name: str, arguments: tuple[AnalyzeArgument, ...]) -> None:
    wrong = [a.dataType.simpleString() for a in arguments if a.dataType.simpleString() not in ("string", "void")]
    if wrong:
        raise InputError(f"{name} takes texts, not {', '.join(wrong)}")


def _schema(*columns: str) -> StructType:
    """A schema of ``name type`` pairs, made without a session: ``analyze`` runs in a worker."""
    out = StructType()
    for name, kind in (c.split() for c in columns):
        out = out.add(name, {"string": StringType(), "int": IntegerType(), "boolean": BooleanType()}[kind])
    return out


class Listings:
    """JSON-LD listings of a page as raw texts: position, the fields, and the reason of a refusal."""

    @staticmethod
    def analyze(html: AnalyzeArgument, url: AnalyzeArgument) -> AnalyzeResult:
        _texts("listings", (html, url))
        return AnalyzeResult(_schema("position int", *(f"{n} string" for n in pages.RAW_FIELDS), "refused string"))

    def eval(self, html, url):
        for k, (row, why) in enumerate(pages.listings(html, url or "") if html else []):
            yield (k, *(row[n] for n in pages.RAW_FIELDS), why)


class Links:
    """Links of a page to its own origin: position, link, is_next."""

    @staticmethod
    def analyze(html: AnalyzeArgument, url: AnalyzeArgument) -> AnalyzeResult:
        _texts("links", (html, url))
        return AnalyzeResult(_schema("position int", "link string", "is_next boolean"))

    def eval(self, html, url):
        for k, (link, following) in enumerate(pages.same_origin_links(url, html) if html else []):
            yield k, link, following


class States:
    """The state that a page embeds, as JSON text, or the reason why there is none: name, state, reason."""

    @staticmethod
    def analyze(html: AnalyzeArgument, name: AnalyzeArgument) -> AnalyzeResult:
        _texts("states", (html, name))
        return AnalyzeResult(_schema("name string", "state string", "reason string"))

    def eval(self, html, name):
        import json

        if html is None or name is None:
            return
        try:
            found = state.agreeing(state.streamed(html), name)
            yield name, json.dumps(found, ensure_ascii=False, sort_keys=True), None
        except ValueError as e:
            yield name, None, str(e)


def register(spark: SparkSession) -> None:
    """Make ``listings``, ``links`` and ``states`` known to the session's SQL."""
    for name, of in (("listings", Listings), ("links", Links), ("states", States)):
        spark.udtf.register(name, udtf(of))
