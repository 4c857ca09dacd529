"""Robots files as tables: rules and delays by agent, and the verdict on a URL by an equi-join with its site's rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def lines(robots: DataFrame, key: str, text: str) -> DataFrame:
    """Fields of robots files in order: key, n, name (lower case), value, section (number of the group of rules)."""
    # a file is bounded in size by whoever fetched it, so its lines are a small window
    line = robots.select(key, F.posexplode(F.split(F.regexp_replace(text, "\ufeff", ""), r"\r\n|\r|\n")).alias("n", "line"))
    bare = F.regexp_replace("line", r"#.*", "")
    named = line.select(key, "n", F.lower(F.trim(F.regexp_extract(bare, r"\A([^:]*):", 1))).alias("name"), F.trim(F.regexp_extract(bare, r"\A[^:]*:(.*)\z", 1)).alias("value"))
    named = named.where(c("name").isin("user-agent", "allow", "disallow", "crawl-delay", "request-rate"))
    order = Window.partitionBy(key).orderBy("n")
    begins = (c("name") == "user-agent") & (F.coalesce(F.lag("name").over(order), F.lit("")) != "user-agent")
    return named.withColumn("_b", begins.cast("int")).withColumn("section", F.sum("_b").over(order)).drop("_b")


def _by_agent(found: DataFrame, key: str) -> DataFrame:
    agents = found.where("name = 'user-agent'").select(key, "section", F.lower("value").alias("agent")).distinct()
    return found.where("name <> 'user-agent' AND section > 0").join(agents, [key, "section"])


def rules(found: DataFrame, key: str) -> DataFrame:
    """Rules of each agent: key, agent, allow, pattern; empty patterns say nothing."""
    out = _by_agent(found, key).where(c("name").isin("allow", "disallow") & c("value").rlike(r"\A[/*]"))
    return out.select(key, "agent", (c("name") == "allow").alias("allow"), normal(c("value")).alias("pattern"))


def delays(found: DataFrame, key: str) -> DataFrame:
    """The longest wait, in seconds, that an agent's groups ask for between requests: key, agent, seconds."""
    every = F.regexp_extract("value", r"\A\s*([0-9]+)\s*/", 1).try_cast("double")
    span = F.regexp_extract("value", r"/\s*([0-9]+)", 1).try_cast("double") * F.when(c("value").rlike(r"m\s*\z"), 60).when(c("value").rlike(r"h\s*\z"), 3600).otherwise(1)
    seconds = F.when(c("name") == "crawl-delay", F.when(c("value").rlike(r"\A[0-9]+(\.[0-9]+)?\z"), c("value").try_cast("double"))).otherwise(F.try_divide(span, every))
    out = _by_agent(found, key).where(c("name").isin("crawl-delay", "request-rate")).withColumn("seconds", seconds)
    return out.where("seconds IS NOT NULL").groupBy(key, "agent").agg(F.max("seconds").alias("seconds"))


def normal(path: Column) -> Column:
    """A path or pattern with percent signs in one form: octets of plain letters, digits and ``-._~`` decoded, other octets in upper case, other characters encoded."""
    octets = F.regexp_extract_all(path, F.lit(r"%[0-9A-Fa-f]{2}|[\s\S]"), 0)

    def one(x: Column) -> Column:
        as_text = F.decode(F.unhex(F.substring(x, 2, 2)), "ISO-8859-1")
        encoded = F.regexp_replace(F.hex(F.encode(x, "UTF-8")), "(..)", "%$1")
        octet = F.when(as_text.rlike(r"\A[A-Za-z0-9._~-]\z"), as_text).otherwise(F.upper(x))
        return F.when(F.length(x) == 3, octet).when(x.rlike(r"\A[A-Za-z0-9._~/?&=*$-]\z"), x).otherwise(encoded)

    return F.array_join(F.transform(octets, one), "")


def _matches(path: Column, pattern: Column) -> Column:
    """``*`` stands for any text, a ``$`` at the end for the end; parts between stars are quoted whole."""
    body = F.regexp_replace(pattern, r"\$\z", "")
    parts = F.transform(F.split(body, r"\*"), lambda p: F.concat(F.lit("\\Q"), p, F.lit("\\E")))
    return F.rlike(path, F.concat(F.lit("\\A"), F.array_join(parts, ".*"), F.when(pattern.endswith("$"), "\\z").otherwise("")))


def allowed(urls: DataFrame, rules_: DataFrame, key: str, path: str, agent: str) -> DataFrame:
    """The urls with ``allowed``: by the rules of the agent's own group, else of ``*``; the longest match wins, allow wins ties, no match allows.

    A site has a bounded number of rules, and urls meet those of their own site only.
    """
    own = rules_.where(c("agent") == agent.lower()).select(key).distinct().withColumn("_own", F.lit(True))
    mine = rules_.where(c("agent").isin(agent.lower(), "*")).join(own, key, "left").where(F.when(c("_own"), c("agent") == agent.lower()).otherwise(c("agent") == "*"))
    table = mine.groupBy(key).agg(F.collect_set(F.struct("pattern", "allow")).alias("_rules"))
    joined = urls.withColumn("_path", normal(F.col(path))).join(table, key, "left")
    hits = F.filter("_rules", lambda r: _matches(c("_path"), r["pattern"]))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.octet_length(r["pattern"]).alias("n"), r["allow"].alias("allow"))))
    return joined.withColumn("allowed", F.coalesce(best["allow"], F.lit(True))).drop("_path", "_rules")
