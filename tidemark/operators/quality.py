"""Quality audit: every row is kept and annotated with flags, a status and a ratio.

Texts are cast once into columns of a projection of their own; all rules are comparisons of
those columns, so the plan's size goes with the number of rules. Two rules need other rows: they
are windows over the identity, and share its shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, ShortType

from tidemark.errors import InputError
from tidemark.functions import values as v

INCOMPLETE = ("missing_price", "missing_area", "missing_exact_rooms")
REQUIRED = ("source", "listing_id", "city", "price_pln", "area_m2", "rooms", "observed_at")
ADDED = ("quality_flags", "quality_status", "audit_price_per_m2")
#: Names that a flag uses for a field, and the fields whose values are compared at one instant (fixed values).
SHORT = {"price_pln": "price", "area_m2": "area", "rooms": "rooms"}
COMPARED = ("price_pln", "area_m2", "rooms", "district", "url")
#: Fields of the report on missing values (fixed values).
REPORTED = ("price_pln", "area_m2", "rooms", "city", "district", "floor", "build_year", "latitude", "longitude", "published_at")
c = F.col


@dataclass(frozen=True)
class Thresholds:
    """Inclusive review bounds of price, area and their ratio."""

    price: tuple[float, float] = (100_000, 10_000_000)
    area: tuple[float, float] = (10, 500)
    price_per_m2: tuple[float, float] = (3_000, 50_000)

    def __post_init__(self):
        for low, high in (self.price, self.area, self.price_per_m2):
            if not 0 < low < high < float("inf"):
                raise InputError("bounds must be positive, finite and ascending")


@dataclass(frozen=True)
class Numeric:
    """What a number must be: whole or not, and its least and greatest value (``above``: the least is left out)."""

    field: str
    whole: bool = False
    least: float | None = None
    most: float | None = None
    above: bool = False

    def holds(self, x: Column) -> Column:
        fits = x.isNotNull()
        if self.whole:
            fits = fits & (x == F.floor(x))
        if self.least is not None:
            fits = fits & ((x > self.least) if self.above else (x >= self.least))
        return fits if self.most is None else fits & (x <= self.most)


#: The first three are required columns, the others are looked at where they are there.
NUMBERS = (
    Numeric("price_pln", least=0, above=True),
    Numeric("area_m2", least=0, above=True),
    Numeric("rooms", whole=True, least=0, above=True),
    Numeric("rooms_min", whole=True, least=0, above=True),
    Numeric("floor", whole=True),
    Numeric("build_year", whole=True, least=0, above=True),
    Numeric("latitude", least=-90, most=90),
    Numeric("longitude", least=-180, most=180),
    Numeric("distance_km", least=0),
)


def number_rules(there: tuple[str, ...] | list[str]) -> list[tuple[str, Column]]:
    """Flags for numbers missing or not what they must be, from the columns ``_n_`` (number) and ``_missing_``."""
    out = []
    for rule in (r for r in NUMBERS if r.field in there):
        none, fits = c(f"_missing_{rule.field}"), F.coalesce(rule.holds(c(f"_n_{rule.field}")), F.lit(False))
        if rule.field in SHORT:
            out.append(("missing_exact_rooms" if rule.field == "rooms" else f"missing_{SHORT[rule.field]}", none))
        out.append((f"invalid_{SHORT.get(rule.field, rule.field)}", ~none & ~fits))
    if "rooms_min" in there:
        out.append(("rooms_below_minimum", (c("_n_rooms") > 0) & (c("_n_rooms_min") > 0) & (c("_n_rooms_min") == F.floor("_n_rooms_min")) & (c("_n_rooms") < c("_n_rooms_min"))))
    return out


def review_rules(bounds: Thresholds) -> list[tuple[str, Column]]:
    """Flags for positive values outside the review bounds."""
    out = []
    for name, x, (low, high) in (("price", c("_n_price_pln"), bounds.price), ("area", c("_n_area_m2"), bounds.area), ("price_per_m2", c("_ratio"), bounds.price_per_m2)):
        out += [(f"{name}_below_review_min", (x > 0) & (x < low)), (f"{name}_above_review_max", x > high)]
    return out


def annotate(frame: DataFrame, found: list[tuple[str, Column]]) -> DataFrame:
    """Add quality_flags (sorted, joined by ``|``) and quality_status (pass, incomplete, review)."""
    frame = frame.withColumn("quality_flags", F.concat_ws("|", *[F.when(test, F.lit(name)) for name, test in sorted(found)]))
    light = ["|".join(sorted(some)) for k in (1, 2, 3) for some in combinations(INCOMPLETE, k)]
    return frame.withColumn("quality_status", F.when(c("quality_flags") == "", "pass").when(c("quality_flags").isin(*light), "incomplete").otherwise("review"))


def numbers_of(frame: DataFrame, names: list[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """The finite numbers of columns, and whether each is missing: numbers as they are, anything else by its trimmed text.

    Texts go through one expression over an array: nine casts side by side make a method too long for the JIT.
    """
    plain = [n for n in names if isinstance(frame.schema[n].dataType, (ByteType, ShortType, IntegerType, LongType, DoubleType))]
    others = [n for n in names if n not in plain]
    texts = F.array(*[c(n).cast("string") for n in others])
    parsed = F.transform(F.transform(texts, lambda x: F.trim(x).try_cast("double")), lambda x: F.when(F.abs(x) < float("inf"), x))
    numbers = {n: v.finite(c(n)) for n in plain} | {n: parsed[k] for k, n in enumerate(others)}
    none = {n: c(n).isNull() for n in plain} | {n: v.missing(c(n).cast("string")) for n in others}
    return numbers, none


def within_city(name: Column, city: tuple[str, ...]) -> Column:
    """Whether a name is one of a city's, case and white space aside; names with blanks at their ends alone need no pattern."""
    plain = [x for x in city if x == " ".join(x.split())]
    return F.coalesce(F.lower(F.trim(name)).isin(*plain) | v.collapsed(name).isin(*city), F.lit(False))


def named(bits: Column, names: list[str]) -> Column:
    """The flags of a number as text: sorted, joined by ``|``. ``names``: the flag of each bit."""
    return F.concat_ws("|", *[F.when(bits.bitwiseAND(1 << k) > 0, F.lit(n)) for k, n in sorted(enumerate(names), key=lambda x: x[1])])


def audited_bits(frame: DataFrame, **how) -> tuple[DataFrame, list[str]]:
    """The frame with its flags as the bits of a number, ``_bits``, and the flag of each; arguments as in ``audit``."""
    rows, found = _judged(frame, **how)
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(test, F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, test) in enumerate(found)])
    return rows.select(*frame.columns, bits.alias("_bits")), [name for name, _ in found]


def audit(frame: DataFrame, *, bounds: Thresholds | None = None, city: tuple[str, ...] = ("warsaw", "warszawa"), identified: bool = False) -> DataFrame:
    """Audit of raw observation rows: the frame with quality_flags, quality_status and audit_price_per_m2.

    The columns of ``REQUIRED`` are needed; rooms_min, floor, build_year, latitude, longitude,
    distance_km, district and url are looked at where they are there. Extra columns pass through.
    ``identified``: source and listing_id are texts without blanks around and never empty, so that a
    frame which is dealt by them already needn't be shuffled again.
    """
    rows, found = _judged(frame, bounds=bounds, city=city, identified=identified)
    return annotate(rows, found).select(*frame.columns, "quality_flags", "quality_status", c("_ratio").alias("audit_price_per_m2"))


def _judged(frame: DataFrame, *, bounds: Thresholds | None = None, city: tuple[str, ...] = ("warsaw", "warszawa"), identified: bool = False) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """The rows with all that rules look at, and each flag with its rule."""
    if lost := set(REQUIRED) - set(frame.columns):
        raise InputError(f"missing columns: {sorted(lost)}")
    if set(ADDED) & set(frame.columns):
        raise InputError("the audit's columns are there already")
    numbers = [r.field for r in NUMBERS if r.field in frame.columns]
    text = {n: c(n).cast("string") for n in frame.columns}
    # the identity's shuffle moves the rows nearly as they are; what else is made of them is made behind it
    rows = frame.withColumns({"_source": c("source") if identified else F.trim(text["source"]), "_id": c("listing_id") if identified else F.trim(text["listing_id"]), "_at": F.try_to_timestamp(text["observed_at"])})
    key = ["_source", "_id"]
    if identified:
        rows = rows.withColumn("_known", F.lit(True))
    else:
        # rows without an identity are compared with none, so they are dealt over all partitions instead of meeting in one
        rows = rows.withColumn("_known", (F.coalesce("_source", F.lit("")) != "") & (F.coalesce("_id", F.lit("")) != ""))
        rows = rows.withColumn("_apart", F.when(~c("_known"), F.xxhash64(*[text[n] for n in frame.columns if n not in ("source", "listing_id")])))
        key.append("_apart")
    # ordered by the moment too, so that both windows share one sort
    rows = rows.withColumn("_same", F.count("*").over(Window.partitionBy(*key).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    values, nones = numbers_of(frame, numbers)
    rows = rows.withColumns({f"_n_{n}": x for n, x in values.items()})
    # what is a number isn't missing, so only texts that are none are searched
    rows = rows.withColumns({f"_missing_{n}": c(f"_n_{n}").isNull() & x for n, x in nones.items()} | {"_aware": text["observed_at"].rlike(r"(Z|[+-]\d{2}:?\d{2})\z"), "_in_city": within_city(text["city"], city)})
    rows = rows.withColumns({"_ratio": F.when((c("_n_price_pln") > 0) & (c("_n_area_m2") > 0), v.finite(F.try_divide("_n_price_pln", "_n_area_m2")))})
    compared = [x for x in COMPARED if x in frame.columns]
    form = {x: F.coalesce(c(f"_n_{x}").cast("string"), F.when(~c(f"_missing_{x}"), F.concat(F.lit("invalid:"), F.trim(text[x]))), F.lit("")) if x in numbers else F.coalesce(v.collapsed(text[x]) if x == "district" else F.trim(text[x]), F.lit("")) for x in compared}
    # an identity's only row contradicts none
    rows = rows.withColumn("_payload", F.when(c("_same") > 1, F.struct(*[x.alias(n) for n, x in form.items()])) if form else F.lit(0))
    moment = Window.partitionBy(*key, "_at")
    rows = rows.withColumns({"_differ": F.min("_payload").over(moment) != F.max("_payload").over(moment)})
    found = [
        ("invalid_source", F.coalesce("_source", F.lit("")) == ""),
        ("invalid_listing_id", F.coalesce("_id", F.lit("")) == ""),
        ("not_warsaw", ~c("_in_city")),
        *number_rules(numbers),
        ("invalid_observed_at", c("_at").isNull()),
        ("unverified_timestamp_timezone", c("_at").isNotNull() & ~c("_aware")),
        *review_rules(bounds or Thresholds()),
        ("repeated_identity", c("_known") & (c("_same") > 1)),
        ("conflicting_identity_timestamp", c("_known") & c("_at").isNotNull() & c("_differ")),
    ]
    return rows, found


def flag_counts(audited: DataFrame) -> DataFrame:
    """Rows of each flag: flag, n."""
    return audited.where("quality_flags <> ''").select(F.explode(F.split("quality_flags", r"\|")).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def status_counts(audited: DataFrame) -> DataFrame:
    return audited.groupBy("quality_status").agg(F.count("*").alias("n"))


def missing_matrix(frame: DataFrame, source: str = "source", fields: tuple[str, ...] = REPORTED) -> DataFrame:
    """Missing values of each source and field: source, field, n; a field that isn't there is missing in all rows."""
    count = lambda x: F.sum((v.missing(c(x).cast("string")) if x in frame.columns else F.lit(True)).cast("long"))
    return frame.groupBy(source).agg(*[count(x).alias(x) for x in fields]).unpivot(source, list(fields), "field", "n")


def repeats(frame: DataFrame, key: list[str]) -> DataFrame:
    """Identities and rows beyond the first of each: one row with identities, duplicate_rows."""
    counted = frame.groupBy(*key).agg(F.count("*").alias("n"))
    return counted.agg(F.count("*").alias("identities"), F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("duplicate_rows"))


def quantiles(frame: DataFrame, column: str, at: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: by, n, q0, q1, ... in the order of ``at``; n counts the values.

    Values that are null, infinite or no number don't count; a null group is a group.

    Equal values are counted first; ranks are running sums of those counts over ranges of values,
    first over the ranges' totals and then within each, so that no task sorts or keeps all values.
    """
    by = by or []
    counted = frame.select(*by, v.finite(c(column)).alias("x")).where(c("x").isNotNull()).groupBy(*by, "x").agg(F.count("*").alias("n"))
    bucket = F.struct(*by) if by else F.lit(0)
    # an order-preserving cut of doubles: sign and leading bits of exponent and fraction
    cut = F.when(c("x") == 0, F.lit(0)).otherwise(F.signum("x") * (F.floor(F.log2(F.abs("x")) * 512) + 600_000)).cast("long")
    counted = counted.withColumns({"_g": bucket, "_cut": cut})
    totals = counted.groupBy("_g", "_cut").agg(F.sum("n").alias("m"))
    totals = totals.withColumns({"_before": F.sum("m").over(Window.partitionBy("_g").orderBy("_cut")) - c("m"), "_all": F.sum("m").over(Window.partitionBy("_g"))})
    ranked = counted.join(totals.withColumnsRenamed({"_g": "_of", "_cut": "_at"}), c("_g").eqNullSafe(c("_of")) & (c("_cut") == c("_at"))).withColumn("_to", c("_before") + F.sum("n").over(Window.partitionBy("_g", "_cut").orderBy("x")))
    ranked = ranked.withColumn("_from", c("_to") - c("n"))
    wanted = []
    for k, q in enumerate(at):
        place = F.lit(q) * (c("_all") - 1)
        hit = lambda r: F.max(F.when((c("_from") <= r) & (r < c("_to")), c("x")))
        wanted += [hit(F.floor(place)).alias(f"_l{k}"), hit(F.ceil(place)).alias(f"_h{k}"), F.max(place - F.floor(place)).alias(f"_f{k}")]
    wanted.append(F.coalesce(F.max("_all"), F.lit(0)).alias("n"))
    out = ranked.groupBy(*by).agg(*wanted) if by else ranked.agg(*wanted)
    return out.select(*by, "n", *[(c(f"_l{k}") + (c(f"_h{k}") - c(f"_l{k}")) * c(f"_f{k}")).alias(f"q{k}") for k in range(len(at))])


def summary(frame: DataFrame, column: str) -> DataFrame:
    """Count, extremes and exact 1st, 50th and 99th percentiles of a column's positive finite values."""
    q = quantiles(frame.select(v.finite(c(column)).alias("x")).where("x > 0"), "x", [0.0, 1.0, 0.01, 0.5, 0.99])
    return q.select("n", c("q0").alias("least"), c("q1").alias("most"), *[F.round(c(f"q{k}"), 4).alias(name) for k, name in enumerate(("p01", "median", "p99"), 2)])


def markdown(report: dict) -> str:
    """A report of counts and summaries as a Markdown page; names and values are escaped, order is by name."""
    safe = lambda x: str(x).replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")
    out = ["# Quality report", ""]
    for title, part in sorted(report.items()):
        if not isinstance(part, dict):
            out += [f"* {safe(title)}: {safe(part)}"]
            continue
        out += ["", f"## {safe(title)}", "", "| name | value |", "| --- | --- |", *(f"| {safe(k)} | {safe(x)} |" for k, x in sorted(part.items(), key=lambda e: str(e[0])))]
    return "\n".join(out) + "\n"
