"""URL verdicts by stated rules and by the hosts' reputation, shrunk level by level. DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.tables import lower_ascii, staged, whole_row


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The stated rules, and common suffixes of two labels.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp",
    "co.nz", "com.br", "co.in", "com.cn", "co.kr", "co.za", "com.mx", "com.tr", "com.ar", "com.tw",
)

#: A host is blocked if more than this share of its pages is bad with this probability.
MOST_BAD, CONFIDENCE = 0.5, 0.9
#: Least weight of a prior in pages; the most is the weight of what it comes from.
LEAST_WEIGHT = 1.0


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(lower_ascii(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (verdict, name) that fits host and path; null if none does. Of equal lengths, the first by name."""
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("name")),
        )
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    none = F.lit(None).cast("struct<verdict: string, name: string>")
    return F.coalesce(*fits, none)


def levels_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """(suffix, registered domain) of a host, user and port left out. A number address is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    last, two = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    suffix = F.when(two.isin(*suffixes), two).otherwise(last) if suffixes else last
    domain = F.when(suffix == two, F.substring_index(name, ".", -3)).otherwise(two)
    address = name.rlike(r"^[0-9.]+$|^\[")
    return F.when(address, F.lit("")).otherwise(suffix), F.when(address, name).otherwise(domain)


def _with_weight(counts: DataFrame) -> DataFrame:
    """Adds ``_weight``, the prior's weight in pages, to rows of (bad, n, above, size).

    Method of moments of the beta-binomial: the spread of the children's bad pages around their
    parents' share ``above``, beyond what counting makes, gives the correlation inside a child. A prior
    weighs at most ``size``, the pages (and prior) that its parent's share comes from.
    """
    expected = F.col("n") * F.col("above")
    noise = expected * (1 - F.col("above"))
    extra = F.sum((F.col("bad") - expected) * (F.col("bad") - expected) - noise)
    within = F.try_divide(F.greatest(extra, F.lit(0.0)), F.sum((F.col("n") - 1) * noise))
    weight = counts.agg((F.try_divide(F.lit(1.0), within) - 1).alias("w")).scalar()
    bounded = F.least(F.greatest(F.coalesce(weight, F.col("size")), F.lit(LEAST_WEIGHT)), F.col("size"))
    return counts.withColumn("_weight", bounded)


def host_reputations(pages: DataFrame, suffixes: Sequence[str] = SUFFIXES, confidence: float = CONFIDENCE) -> DataFrame:
    """(host, n, bad, rate, low): the share of bad pages of each host and a lower bound of it.

    ``pages`` holds (host, bad): 1 or 0 where the page's outcome is known, else null. A suffix shrinks to the
    share of all pages (one page of each kind added), a registered domain to its suffix, a host to its domain, each
    with the weight that the data give to the level (``_with_weight``). The posterior of a host is
    the beta distribution of its domain's share at that weight and its own pages; ``low`` lies below it
    with probability ``confidence`` or more for any posterior of that mean and variance (one-sided
    Chebyshev bound), never below 0. A host without known page has its domain's share.

    Pages are summed to hosts first, with map-side combine, so a host of a third of all pages is one
    row per task; domains and suffixes are sums of hosts, and what follows joins these small tables.
    """
    suffix, domain = levels_of(F.col("host"), suffixes)
    hosts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    hosts = staged(hosts.withColumns({"suffix": suffix, "domain": domain}))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    share = (F.col("bad") + F.col("_weight") * F.col("above")) / (F.col("n") + F.col("_weight"))
    size = F.col("n") + F.col("_weight")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    top = {"above": total.select((F.col("bad") + 1) / (F.col("n") + 2)).scalar(), "size": total.select(F.col("n") + 2.0).scalar()}
    by_suffix = _with_weight(hosts.groupBy("suffix").agg(*sums).withColumns(top))
    by_suffix = by_suffix.select("suffix", share.alias("above"), size.alias("size"))
    by_domain = _with_weight(hosts.groupBy("suffix", "domain").agg(*sums).join(by_suffix, "suffix"))
    by_domain = by_domain.select("suffix", "domain", share.alias("above"), size.alias("size"))
    found = _with_weight(hosts.join(by_domain, ["suffix", "domain"]))
    found = found.select("host", "n", "bad", share.alias("rate"), (size + 1).alias("_size"))
    width = F.sqrt(F.lit(confidence / (1 - confidence)) * F.col("rate") * (1 - F.col("rate")) / F.col("_size"))
    return found.select("host", "n", "bad", "rate", F.greatest(F.col("rate") - width, F.lit(0.0)).alias("low"))


def judged(
    pages: DataFrame,
    url: str = "url",
    outcome: str | None = None,
    rules: Sequence[Rule] = RULES,
    suffixes: Sequence[str] = SUFFIXES,
    most_bad: float = MOST_BAD,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` (or null), ``bad_rate``, ``bad_low`` and ``verdict``, allow or block.

    The longest rule that fits host (or a domain above it) and path decides. A page without rule is
    blocked if ``low`` of its host (``host_reputations``) exceeds ``most_bad``: only where the known pages
    show it, so a host with few of them is allowed. Known pages are those of the column ``outcome`` (1 bad,
    0 good, null unknown), and where that is missing or null those of the rules: a blocked page is bad, an
    allowed one good.

    A null url, or one without ``://``, has empty host and path; the empty host is a host like others, of no suffix.
    Repeated pages count each and stay; an empty table gives an empty one; input columns of the
    new names are replaced. Rates are rounded to 9 places, before the comparison.
    """
    new = ("host", "path", "rule", "bad_rate", "bad_low", "verdict")
    link = F.col("_row").getField(url)
    rows = pages.select(whole_row(pages)).withColumns({"_host": host_of(link), "_path": path_of(link)})
    rows = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    ruled = (F.col("_rule.verdict") == "block").cast("int")
    known = F.coalesce(F.col("_row").getField(outcome).cast("int"), ruled) if outcome else ruled
    found = host_reputations(rows.select(F.col("_host").alias("host"), known.alias("bad")), suffixes, confidence)
    found = found.select(F.col("host").alias("_host"), F.round("rate", 9).alias("_rate"), F.round("low", 9).alias("_low"))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_low") > most_bad, "block").otherwise("allow"))
    values = dict(zip(new, [F.col("_host"), F.col("_path"), F.col("_rule.name"), F.col("_rate"), F.col("_low"), verdict], strict=True))
    rest = [F.col(f"_row.`{c}`").alias(c) for c in pages.columns if c not in new]
    return rows.join(found, "_host").select(*rest, *[c.alias(n) for n, c in values.items()])
