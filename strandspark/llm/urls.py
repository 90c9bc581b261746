"""URL filter by a weighted vocabulary and host rules.

An Aho-Corasick automaton finds the strict and soft terms of a url in one pass; a find counts
where no letter or digit touches it. One strict term rejects, and so do several distinct soft terms whose weights
reach a limit together.
Host rules come first: of those that fit, the longest decides.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vocabulary: terms that reject alone, and soft terms with their weights. Words that harmless urls use as well
# (a download page, a hot topic) weigh half as much as the others.
STRICT = ("adult", "casino", "malware", "phishing", "porn", "spam", "warez", "xxx")
SOFT = (
    ("bet", 2), ("bonus", 2), ("cheap", 2), ("click", 1), ("clickbait", 2), ("dating", 2), ("deal", 1), ("download", 1), ("farm", 2),
    ("free", 2), ("hot", 1), ("loan", 2), ("pills", 2), ("poker", 2), ("promo", 2), ("sexy", 2), ("win", 1),
)
#: The weight of distinct soft terms that rejects; one term alone never does.
SOFT_LIMIT = 4
#: host, path, verdict
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


Weighted = tuple[tuple[str, int], ...]


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: Weighted):
    import ahocorasick

    made = ahocorasick.Automaton()
    for term, weight in soft:
        made.add_word(term, (False, term, weight))
    for term in strict:
        made.add_word(term, (True, term, 0))
    made.make_automaton()
    return made


def _edge(c: str) -> bool:
    return not ("a" <= c <= "z" or "0" <= c <= "9")


def count_terms(url: str, strict: tuple[str, ...] = STRICT, soft: Weighted = SOFT) -> tuple[int, int, int]:
    """Distinct strict and soft terms that stand between edges of the url, and the soft ones' weight."""
    if not strict and not soft:
        return 0, 0, 0
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url)
    found: dict[str, tuple[bool, int]] = {}
    for end, (alone, term, weight) in _automaton(strict, soft).iter(low):
        start = end - len(term) + 1
        if (start == 0 or _edge(low[start - 1])) and (end + 1 == len(low) or _edge(low[end + 1])):
            found[term] = (alone, weight)
    softs = [w for alone, w in found.values() if not alone]
    return len(found) - len(softs), len(softs), sum(softs)


def _counted(strict, soft):
    def run(batches):
        for batch in batches:
            got = [count_terms(u or "", strict, soft) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([g[k] for g in got], pa.int32()) for k in range(3))], [*batch.schema.names, "n_strict", "n_soft", "soft_weight"])

    return run


def host_and_path(url):
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, strict: tuple[str, ...] = STRICT, soft: Weighted = SOFT, soft_limit: int = SOFT_LIMIT, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft, soft_weight for each row of pages. A url that no rule
    fits is rejected for one strict term, or for two distinct soft terms or more whose weights reach soft_limit.

    A null url or one without "://" has an empty host and path, so no rule fits it; its terms still count
    (a null url has none and is allowed). Repeated rows are judged each; any length is read whole.
    """
    base = pages.select("page_id", F.col("url").cast("string").alias("url"))
    kind = base.schema["page_id"].dataType.simpleString()
    counted = base.mapInArrow(_counted(tuple(strict), tuple((term, weight) for term, weight in soft)), f"page_id {kind}, url string, n_strict int, n_soft int, soft_weight int")
    host, path = host_and_path(F.col("url"))
    out = counted.withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, said in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    own = F.when((F.col("n_strict") > 0) | ((F.col("n_soft") > 1) & (F.col("soft_weight") >= soft_limit)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "n_strict", "n_soft", "soft_weight")
