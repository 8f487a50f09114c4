"""Robots rules as a table: parsing, rules per agent, and the exclusion of URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.functions.text import strip_blanks
from linkgraph.functions.urls import path_of

# The keys of a robots text and the smallest crawl delay in seconds.
AGENT = "user-agent"
DISALLOW = "disallow"
ALLOW = "allow"
CRAWL_DELAY = "crawl-delay"
SITEMAP = "sitemap"
ANY_AGENT = "*"
MIN_DELAY = 1.0
DEFAULT_DELAY = 1.0


def _pairs(block: Column) -> Column:
    """The tokens of a block that are keys, each with the token after it.

    A block is cut at newlines and colons; a value at its very end that is empty does not count,
    and a value with a colon in it ends there.
    """
    tokens = F.split(F.regexp_replace(block, r"[\n:]+\z", ""), "[\n:]")
    pairs = F.transform(tokens, lambda token, i: F.struct(
        F.lower(strip_blanks(token)).alias("key"),
        strip_blanks(F.get(tokens, i + 1)).alias("value"),
        i.alias("pos")))
    keys = (AGENT, DISALLOW, ALLOW, CRAWL_DELAY, SITEMAP)
    return F.filter(pairs, lambda p: p["key"].isin(*keys) & p["value"].isNotNull())


def _of(pairs: Column, *keys: str) -> Column:
    return F.filter(pairs, lambda p: p["key"].isin(*keys))


def parse_robots(bodies: DataFrame) -> DataFrame:
    """Robots texts (``host, body``) to rules ``host, agent, directive, value, ord``.

    Blocks are parted by blank lines. All agents of a block share all its rules, wherever in the
    block they stand; of several delays the last counts. ``ord`` follows the text.
    """
    blocks = bodies.select("host", F.posexplode(F.split("body", "\n\n")).alias("block_no", "block"))
    pairs = blocks.select("host", "block_no", _pairs(F.col("block")).alias("pairs"))
    last_delay = F.slice(_of(F.col("pairs"), CRAWL_DELAY), -1, 1)
    delays = F.when(F.size(_of(F.col("pairs"), CRAWL_DELAY)) > 0, last_delay).otherwise(
        F.filter("pairs", lambda p: F.lit(False)))
    rules = pairs.select(
        "host", "block_no", F.explode(_of(F.col("pairs"), AGENT)).alias("who"),
        F.concat(_of(F.col("pairs"), DISALLOW, ALLOW, SITEMAP), delays).alias("rules"))
    flat = rules.select("host", F.col("who.value").alias("agent"), "block_no",
                        F.explode("rules").alias("rule"))
    delay = F.greatest(F.col("rule.value").try_cast("double"), F.lit(MIN_DELAY))
    value = F.when(F.col("rule.key") == CRAWL_DELAY,
                   F.when(F.col("rule.value").try_cast("double").isNotNull(), delay.cast("string"))
                   ).otherwise(F.col("rule.value"))
    ord_ = F.shiftleft(F.col("block_no").cast("bigint"), 32) + F.col("rule.pos")
    return flat.select("host", "agent", F.col("rule.key").alias("directive"),
                       value.alias("value"), ord_.alias("ord")).where(F.col("value").isNotNull())


def known_agents(bodies: DataFrame) -> DataFrame:
    """``host, agent``: every agent that a robots text (``host, body``) names, also without a rule."""
    blocks = bodies.select("host", F.explode(F.split("body", "\n\n")).alias("block"))
    named = blocks.select("host", F.explode(_of(_pairs(F.col("block")), AGENT)).alias("who"))
    return named.select("host", F.col("who.value").alias("agent")).distinct()


def _in_order(directive: str) -> Column:
    """Values of one directive in text order; bounded by the one robots text they come from."""
    pairs = F.sort_array(F.collect_list(F.when(
        F.col("directive") == directive, F.struct("ord", "value"))))
    return F.transform(pairs, lambda p: p["value"])


def host_rules(rules: DataFrame, agents: DataFrame | None = None) -> DataFrame:
    """Rules gathered: ``host, agent, disallow, allow, sitemaps, crawl_delay``.

    With ``agents`` (``host, agent``) those without a rule get a row of empty lists.
    """
    if agents is not None:
        rules = rules.unionByName(agents.select("host", "agent"), allowMissingColumns=True)
    return rules.groupBy("host", "agent").agg(
        _in_order(DISALLOW).alias("disallow"),
        _in_order(ALLOW).alias("allow"),
        _in_order(SITEMAP).alias("sitemaps"),
        _last_delay(F.lit(True)).alias("crawl_delay"))


def _last_delay(who: Column) -> Column:
    mine = who & (F.col("directive") == CRAWL_DELAY)
    return F.max_by(F.when(mine, F.col("value").cast("double")), F.when(mine, F.col("ord")))


def _per_host(rules: DataFrame):
    """Group by host and its hash.

    Grouped by host alone, the result would go into a join on host without a shuffle of its own, and
    adaptive execution splits a hot host only where both sides come straight from a shuffle.
    """
    return rules.groupBy("host", F.hash("host").alias("host_hash"))


def _delay(agent: str) -> Column:
    own, any_ = _last_delay(F.col("agent") == agent), _last_delay(F.col("agent") == ANY_AGENT)
    return F.coalesce(own, any_, F.lit(DEFAULT_DELAY))


def _prefixes(agent: str) -> Column:
    disallow = F.col("directive") == DISALLOW
    own = F.collect_set(F.when(disallow & (F.col("agent") == agent), F.col("value")))
    any_ = F.collect_set(F.when(disallow & (F.col("agent") == ANY_AGENT), F.col("value")))
    return F.when(F.size(own) > 0, own).otherwise(any_)


def effective_delay(rules: DataFrame, agent: str) -> DataFrame:
    """``host, crawl_delay``: the agent's own delay, else that of ``*``, else the default."""
    return _per_host(rules).agg(_delay(agent).alias("crawl_delay")).select("host", "crawl_delay")


def effective_disallow(rules: DataFrame, agent: str) -> DataFrame:
    """``host, prefixes``: the agent's own disallow values if it has any, else those of ``*``."""
    used = rules.where((F.col("directive") == DISALLOW) & F.col("agent").isin(agent, ANY_AGENT))
    return _per_host(used).agg(_prefixes(agent).alias("prefixes")).select("host", "prefixes")


def host_policy(rules: DataFrame, agent: str) -> DataFrame:
    """``host, prefixes, crawl_delay``: both of the above, from one pass over the rules."""
    return _per_host(rules).agg(
        _prefixes(agent).alias("prefixes"), _delay(agent).alias("crawl_delay")).select(
        "host", "prefixes", "crawl_delay")


def tested_text(url: Column, match_on: str) -> Column:
    """What disallow values are compared with: the path or the full URL, with a ``/`` added.

    Text that starts with a value still does with the ``/``, so one test covers both forms.
    """
    if match_on not in ("path", "url"):
        raise ValueError("match_on is 'path' or 'url'")
    return F.concat(path_of(url) if match_on == "path" else url, F.lit("/"))


def search_list(prefixes: str, match_on: str) -> Column:
    """Disallow values made fit for ``is_excluded``: in order, without those that start with another one.

    Empty values do not count for paths; for URLs one makes all others needless.
    """
    used = F.col(prefixes) if match_on == "url" else F.array_remove(prefixes, "")
    return F.aggregate(F.sort_array(used), F.array().cast("array<string>"), lambda kept, value: F.when(
        value.startswith(F.get(kept, F.size(kept) - 1)), kept).otherwise(F.concat(kept, F.array(value))))


def is_excluded(tested: str, searched: str) -> Column:
    """Whether column ``tested`` starts with a value of a ``search_list``, by halving the list.

    All text between a value and the text it begins starts with that value too, and the list holds no
    such text; so only the greatest value that is not above the text can be the one.
    """
    values, size = F.col(searched), F.size(searched)

    def halved(span: Column, _) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        upper = F.struct((middle + 1).alias("low"), span["high"].alias("high"))
        lower = F.struct(span["low"].alias("low"), middle.alias("high"))
        return F.when(span["low"] >= span["high"], span).when(F.get(values, middle) <= F.col(tested), upper).otherwise(lower)

    turns = F.sequence(F.lit(1), F.length(F.bin(size)))
    nearest = F.aggregate(turns, F.struct(F.lit(0).alias("low"), size.alias("high")), halved,
                          lambda span: F.get(values, span["low"] - 1))
    return F.coalesce(F.col(tested).startswith(nearest), F.lit(False))


def allowed(frontier: DataFrame, rules: DataFrame, agent: str, match_on: str = "path") -> DataFrame:
    """Drop URLs that start with a disallow value, also when a ``/`` is added to them.

    ``match_on="path"`` tests the path and ignores empty values; ``"url"`` tests the full URL
    literally, where an empty value excludes everything. Allow values have no effect. One row of
    prefixes per host is looked up, so URLs and rules are never paired in a shuffle; a URL is compared
    with as many of them as their number has binary digits.
    """
    tested = frontier.withColumn("tested", tested_text(F.col("url"), match_on))
    lists = effective_disallow(rules, agent).select("host", search_list("prefixes", match_on).alias("searched"))
    return (tested.join(lists, "host", "left")
            .where(~is_excluded("tested", "searched")).select(*frontier.columns))
