"""Column expressions for numbers, times, texts, identifiers, URLs and places."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean Earth radius in km, and the reference point of distances (fixed values).
EARTH_KM = 6371.0088
CENTRE = (52.2297, 21.0122)
#: Query parameters that only track visitors (fixed values).
TRACKERS = ("fbclid", "gclid", "msclkid", "dclid", "yclid")


def finite(x: Column) -> Column:
    """A double, null unless finite (NaN counts as larger than any number)."""
    x = x.try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def positive(x: Column) -> Column:
    """Whether a value is a finite number above 0; never null."""
    return F.coalesce(finite(x) > 0, F.lit(False))


def whole(x: Column) -> Column:
    """A positive whole number as int, else null."""
    x = finite(x)
    return F.when((x > 0) & (x == F.floor(x)), x.try_cast("int"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or either isn't finite."""
    return finite(F.try_divide(finite(a), finite(b)))


def collapsed(text: Column) -> Column:
    """Lower case, white space of any kind trimmed and collapsed."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"\A | \z", ""))


def missing(text: Column) -> Column:
    """Null or blank."""
    return text.isNull() | ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def locale_number(text: Column, money: bool = False) -> Column:
    """A number written with spaces or dots between thousands, a comma or dot before decimals, and a unit."""
    bare = F.regexp_replace(F.lower(text), r"(?U)\s|zł|pln|m²|m2|km", "")
    commas, dots = F.regexp_count(bare, F.lit(",")), F.regexp_count(bare, F.lit(r"\."))
    grouped = bare.rlike(r"\A[-+]?\d{1,3}(\.\d{3})+\z")
    plain = (
        F.when((commas == 1) & (dots == 0), F.replace(bare, F.lit(","), F.lit(".")))
        .when((commas == 1) & bare.rlike(r"\A[-+]?\d{1,3}(\.\d{3})+,\d+\z"), F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when((dots == 1) & bare.rlike(r"\A[-+]?\d{1,3}(,\d{3})+\.\d+\z"), F.replace(bare, F.lit(","), F.lit("")))
        .when((commas == 0) & (dots > 1) & grouped, F.replace(bare, F.lit("."), F.lit("")))
        .when((commas == 0) & (dots <= 1), F.replace(bare, F.lit("."), F.lit("")) if money is True else bare)
    )
    if money:
        plain = F.when((commas == 0) & (dots == 1) & ~grouped, bare).otherwise(plain)
    return F.when(plain.rlike(r"\A[-+]?\d+(\.\d+)?\z"), finite(plain))


def tri_state(text: Column) -> Column:
    """true, false, or null for anything else."""
    text = F.lower(F.trim(text.cast("string")))
    return F.when(text.isin("true", "1", "yes"), True).when(text.isin("false", "0", "no"), False)


def opaque_id(text: Column) -> Column:
    """Whether a text is an identifier of 1 to 200 digits, not all 0; leading zeros count."""
    return F.coalesce(text.rlike(r"\A[0-9]{1,200}\z") & text.rlike("[1-9]"), F.lit(False))


def aware_utc(text: Column) -> Column:
    """The instant of a timestamp that names its zone; null for others."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})\z"), F.try_to_timestamp(text))


def haversine_km(latitude: Column, longitude: Column, centre: tuple[float, float] = CENTRE) -> Column:
    """Great-circle distance to a point, null where a coordinate is null."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    lat0, lon0 = F.radians(F.lit(centre[0])), F.radians(F.lit(centre[1]))
    h = F.pow(F.sin((lat - lat0) / 2), 2) + F.cos(lat) * F.cos(lat0) * F.pow(F.sin((lon - lon0) / 2), 2)
    return F.when(h.isNotNull(), 2 * EARTH_KM * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), h)))))  # greatest and least pass over nulls


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute URL, else null."""
    host = F.lower(F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)", 1))
    return F.when(host != "", host)


def canonical_url(url: Column) -> Column:
    """Lower scheme and host, no fragment, no tracking parameters, the others in order."""
    start = F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    path = F.regexp_extract(url, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)
    name = lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1)))
    kept = F.filter(F.split(query, "&"), lambda p: ~name(p).startswith("utm_") & ~name(p).isin(*TRACKERS) & (p != ""))
    return F.concat(start, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def safe_url(url: Column, host: str) -> Column:
    """Whether a URL is https on the host or its subdomains, without user, port, query, fragment or control characters."""
    pattern = r"\Ahttps://([a-z0-9-]+\.)*" + host.replace(".", r"\.") + r"/[^\x00-\x20?#@\x7f]*\z"
    return F.coalesce(url.rlike(pattern), F.lit(False))


def url_id(url: Column) -> Column:
    """A stable identifier for rows that have only a URL."""
    return F.concat(F.lit("url_"), F.substring(F.sha2(url, 256), 1, 24))


def within(difference: Column, tolerance: Column) -> Column:
    """difference <= tolerance, inclusive up to rounding in floating point."""
    return (difference <= tolerance) | (F.abs(difference - tolerance) <= F.lit(1e-12) * F.greatest(F.abs(difference), F.abs(tolerance)))


def gap(predicted: Column, asked: Column) -> Column:
    """(predicted - asked) / predicted for a positive finite prediction, else null."""
    return F.when(positive(predicted), ratio(predicted - asked, predicted))


def decimal_text(text: Column, scale: int = 2) -> Column:
    """A positive amount in plain digits as a decimal; blanks go, one comma or dot parts the decimals, both together are ambiguous."""
    bare = F.regexp_replace(text, r"(?U)\s", "")
    value = F.replace(bare, F.lit(","), F.lit(".")).try_cast(f"decimal(38,{scale})")
    return F.when(bare.rlike(r"\A[0-9]+([.,][0-9]+)?\z") & (value > 0), value)


def plain_number(text: Column, signed: bool = False) -> Column:
    """A number written in digits with at most one dot: no exponent, no unit and, unless ``signed``, no sign."""
    text = F.trim(text.cast("string"))
    return F.when(text.rlike(r"\A" + ("-?" if signed else "") + r"[0-9]+(\.[0-9]+)?\z"), finite(text))


def plain_whole(text: Column, signed: bool = False) -> Column:
    """The same, whole, as long."""
    number = plain_number(text, signed)
    return F.when(number == F.floor(number), number.try_cast("long"))


def json_number(value: Column) -> Column:
    """The number of a variant that holds one; texts and booleans that look like numbers are null."""
    return F.when(F.schema_of_variant(value).rlike(r"\A(BIGINT|DECIMAL|DOUBLE|FLOAT)"), finite(F.try_variant_get(value, "$", "double")))


def json_number_or_text(value: Column) -> Column:
    """The number of a variant that holds one or a plain signed decimal as text."""
    text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(json_number(value), plain_number(text, signed=True))


def stored_number(text: Column, whole_only: bool = False) -> tuple[Column, Column]:
    """A storage number and whether a text that is there isn't one: booleans and what isn't finite are refused, fractions where only whole ones fit."""
    number = F.when(~F.lower(F.trim(text.cast("string"))).isin("true", "false"), finite(F.trim(text.cast("string"))))
    if whole_only:
        number = F.when(number == F.floor(number), number)
    return number, text.isNotNull() & number.isNull()


def whole_between(text: Column, least: int, most: int) -> Column:
    """A whole number within bounds as int, null for anything else."""
    number = plain_whole(text, signed=True)
    return F.when(number.between(least, most), number.cast("int"))


def local_offset_fits(text: Column, zone: str) -> Column:
    """Whether a timestamp's written offset is UTC or the one that its zone had at that instant; false for gaps, others' offsets and none."""
    at = aware_utc(text)
    written = F.to_timestamp_ntz(F.regexp_extract(text, r"\A(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)", 1))
    utc = text.rlike(r"(Z|[+-]00:00)\z")
    there = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")))
    return F.coalesce(at.isNotNull() & (utc | (there == written)), F.lit(False))


def day_bounds(day: Column, zone: str) -> tuple[Column, Column]:
    """First instant of a zone's civil day and of the next one."""
    start = lambda d: F.to_utc_timestamp(d.cast("timestamp"), zone)
    return start(day), start(F.date_add(day, 1))


def signature(frame_columns: list[str]) -> Column:
    """Optional numbers of a row as one value that compares null-safe: what isn't finite counts as null."""
    return F.struct(*[finite(F.col(c)).alias(c) for c in frame_columns])


#: Texts that stand for no value (fixed values).
NO_VALUE = ("nan", "none", "null", "unknown", "brak", "-")


def nfc(text: Column) -> Column:
    """Composed Unicode form; texts of ASCII alone pass by the JVM, others go through Arrow."""
    @F.pandas_udf("string")
    def composed(x: pd.Series) -> pd.Series:
        return x.str.normalize("NFC")

    return F.when(text.rlike(r"\A\p{ASCII}*\z"), text).otherwise(composed(text))


def identity_text(text: Column) -> Column:
    """The form in which names are compared: composed, collapsed, lower case; null for texts that stand for no value."""
    form = collapsed(nfc(text))
    return F.when((form != "") & ~form.isin(*NO_VALUE), form)


def distance_km(latitude: Column, longitude: Column, centre: tuple[float, float] = CENTRE) -> Column:
    """Distance to a point to four decimals, null unless both coordinates are on Earth."""
    fits = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.when(fits, F.round(haversine_km(latitude, longitude, centre), 4))


def resolved_url(url: Column, base: Column) -> Column:
    """A link as an absolute URL, seen from its page: whole ones stay, ``//host``, ``/path``, ``?query`` and plain names are completed; ``.`` and ``..`` go."""
    start = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"\A(.*/)", 1)
    full = (
        F.when(url.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(start, r"\A([^:]*:)", 1), url))
        .when(url.startswith("/"), F.concat(start, url))
        .when(url.startswith("?"), F.concat(start, path, url))
        .when(url.startswith("#") | (url == ""), F.concat(F.regexp_extract(base, r"\A([^#]*)", 1), url))
        .otherwise(F.concat(start, F.when(folder == "", "/").otherwise(folder), url))
    )
    own = F.regexp_extract(full, r"\A[^:]*://[^/?#]*([^?#]*)", 1)
    step = lambda kept, part: F.when(part == ".", kept).when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.lit(1), F.size(kept) - 1))).otherwise(F.array_append(kept, part))
    parts = F.aggregate(F.split(own, "/"), F.array().cast("array<string>"), step)
    clean = F.when(own.rlike(r"/\.{1,2}(/|\z)"), F.concat(F.array_join(parts, "/"), F.when(own.rlike(r"/\.{1,2}\z"), "/").otherwise(""))).otherwise(own)
    return F.concat(F.regexp_extract(full, r"\A([^:]*://[^/?#]*)", 1), clean, F.regexp_extract(full, r"\A[^?#]*(.*)", 1))


def origin(url: Column) -> Column:
    """Scheme, host and port of a URL, the scheme's own port left out."""
    start = F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    return F.when(start != "", F.regexp_replace(F.regexp_replace(start, r"\A(http://[^:]*):80\z", "$1"), r"\A(https://[^:]*):443\z", "$1"))


def shown(text: Column, instead: str = "-") -> Column:
    """A text fit for a terminal: escape sequences and control characters gone, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\x1b\[[0-?]*[ -/]*[@-~]|\x1b[@-_]", ""), r"[\x00-\x1f\x7f-\x9f]", " ")
    bare = F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))
    return F.coalesce(F.when(bare != "", bare), F.lit(instead))


def decoded(code: Column, codes: dict[str, int]) -> Column:
    """The number that a code stands for, null for others."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]) if codes else F.lit(None).cast("map<string,int>")
    return F.try_element_at(table, code)


def lock_key(*parts: Column) -> Column:
    """A signed 64-bit lock number of some texts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 16), 16, -10).cast("long")
