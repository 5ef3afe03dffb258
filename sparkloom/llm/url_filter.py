"""Operator 9 [native]: URL filter by host and path rules, else by logistic regression on hashed character n-grams.

The regression is fitted on the driver over the small labelled table below (its size is fixed); every url is judged
by built-in column functions only: n-grams by substring, a polynomial hash, weights from one literal array. The
weights are rounded to integers, so sums are exact and don't depend on their order. No shuffle.

Null urls and urls without "://" have an empty host and path, fit no rule and are judged by the regression (on
nothing but the bias). Repeated rows give repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path): a rule fits its host and all subdomains where the url's path starts with its own; the longest wins.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
MAX_RULES = 1000

#: The labelled table: host and path, 1 for block.
LABELLED = (
    ("spam-farm.example.org", "/en/728", 1), ("www.spam-farm.example.com", "/fr/12", 1), ("blog.spam-farm.example.net", "/es/5/", 1), ("spam-links.example.org", "/de/77.html", 1),
    ("cheap-pills.example.com", "/en/450", 1), ("www.cheap-pills.example.net", "/de/31", 1), ("m.cheap-meds.example.org", "/fr/9", 1), ("pills-online.example.com", "/es/640", 1),
    ("casino-win.example.net", "/en/2", 1), ("blog.casino-win.example.org", "/fr/310", 1), ("big-casino.example.com", "/de/45/", 1), ("win-slots.example.net", "/es/88", 1),
    ("adult-x.example.com", "/en/18", 1), ("m.adult-x.example.org", "/es/218.html", 1), ("xxx-adult.example.net", "/fr/69", 1), ("adult-cams.example.com", "/de/7", 1),
    ("free-bets.example.net", "/en/99", 1), ("www.free-bets.example.com", "/fr/501", 1), ("bets-now.example.org", "/de/3", 1), ("free-spins.example.net", "/es/44", 1),
    ("ads-track.example.com", "/en/1", 1), ("m.ads-track.example.net", "/de/820", 1), ("track-ads.example.org", "/fr/73/", 1), ("click-ads.example.com", "/es/15", 1),
    ("ththre.example.com", "/fr/825", 0), ("m.ththth.example.net", "/en/25", 0), ("thther.example.org", "/en/685", 0), ("therha.example.com", "/en/676", 0),
    ("therin.example.net", "/en/770", 0), ("blog.tiontion.example.com", "/en/853/", 0), ("blog.ththan.example.net", "/en/960", 0), ("m.therou.example.com", "/en/474.html", 0),
    ("ththin.example.com", "/en/671", 0), ("www.ththen.example.com", "/en/148.html", 0), ("blog.thertion.example.org", "/es/978", 0), ("ththed.example.org", "/en/453", 0),
    ("ththble.example.net", "/es/797", 0), ("www.ththwh.example.org", "/en/471", 0), ("blog.thernd.example.net", "/de/612", 0), ("thering.example.com", "/en/328/", 0),
    ("www.therti.example.org", "/en/334/", 0), ("news.science.example.org", "/fr/41", 0), ("library.example.net", "/de/902", 0), ("docs.garden.example.com", "/es/77", 0),
    ("weather.example.org", "/en/5", 0), ("blog.history.example.net", "/fr/660.html", 0), ("m.recipes.example.com", "/de/18/", 0), ("www.museum.example.org", "/es/431", 0),
    ("", "", 0),
)
BUCKETS = 4096
EPOCHS, RATE, DECAY, SCALE = 300, 0.5, 1e-4, 1000


def _bucket(a: int, b: int, c: int) -> int:
    return (a * 7919 + b * 521 + c * 31) % BUCKETS


@lru_cache(maxsize=1)
def fitted() -> tuple[int, tuple[int, ...]]:
    """Bias and weights, times SCALE and rounded. Full gradient steps over the labelled table: the same on every run."""
    rows = []
    for host, path, label in LABELLED:
        text = [ord(c) for c in f"^{host}{path}$"]
        counts: dict[int, float] = {}
        for gram in zip(text, text[1:], text[2:], strict=False):
            counts[_bucket(*gram)] = counts.get(_bucket(*gram), 0) + 1
        norm = math.sqrt(max(1, len(text) - 2))
        rows.append((counts, norm, label))
    weights, bias = [0.0] * BUCKETS, 0.0
    for _ in range(EPOCHS):
        step: dict[int, float] = {}
        step_bias = 0.0
        for counts, norm, label in rows:
            z = bias + sum(weights[b] * v for b, v in counts.items()) / norm
            error = label - 1 / (1 + math.exp(-z))
            step_bias += error
            for b, v in counts.items():
                step[b] = step.get(b, 0.0) + error * v / norm
        bias += RATE * step_bias / len(rows)
        for b, v in step.items():
            weights[b] += RATE * (v - DECAY * weights[b])
    return round(bias * SCALE), tuple(round(w * SCALE) for w in weights)


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return _lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of rules of one length the first by name."""
    if len(rules) > MAX_RULES:
        raise ValueError("so many rules need a join")
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)) for _, h, p in ranked]
    none = F.lit(None).cast("string")
    return (
        F.coalesce(*[F.when(fit, F.lit(h + p)) for fit, (_, h, p) in zip(fits, ranked, strict=True)], none),
        F.coalesce(*[F.when(fit, F.lit(v)) for fit, (v, _, _) in zip(fits, ranked, strict=True)], none),
    )


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """pages' page_id with host, path, rule (null where none fits) and verdict: the rule's, else the regression's."""
    host, path = parts(F.col("url"))
    at = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    bias, weights = fitted()
    c = F.col("__codes")
    text = F.concat(F.lit("^"), F.col("host"), F.col("path"), F.lit("$"))
    at = at.withColumns({"rule": rule, "__verdict": verdict, "__codes": F.transform(F.split(text, "(?!^)"), lambda x: F.ascii(x).cast("long"))})
    gram = lambda i: ((F.element_at(c, i) * 7919 + F.element_at(c, i + 1) * 521 + F.element_at(c, i + 2) * 31) % BUCKETS).cast("int")
    grams = F.when(F.size(c) >= 3, F.transform(F.sequence(F.lit(1), F.size(c) - 2), gram)).otherwise(F.array().cast("array<int>"))
    at = at.withColumn("__grams", grams)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<long>")  # folded into one literal
    total = F.aggregate(F.col("__grams"), F.lit(0).cast("long"), lambda s, g: s + F.element_at(table, g + 1))
    block = total + F.lit(bias) * F.sqrt(F.greatest(F.size("__grams"), F.lit(1)).cast("double")) > 0
    return at.select("page_id", "host", "path", "rule", F.coalesce("__verdict", F.when(block, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def op9(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return filter_urls(pages)


def oracle() -> str:
    """The same in SQL, with the fitted weights as a literal list."""
    bias, weights = fitted()
    ranked = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fit = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ranked]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fit, ranked, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fit, ranked, strict=True))
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), part AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (
  SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS v, '^' || host || path || '$' AS t FROM part
), summed AS (
  SELECT *, greatest(length(t) - 2, 0) AS n,
    coalesce(list_sum(list_transform(range(1, length(t) - 1), lambda i: {list(weights)}[1 + (CAST(unicode(t[i]) AS BIGINT) * 7919 + unicode(t[i + 1]) * 521 + unicode(t[i + 2]) * 31) % {BUCKETS}])), 0) AS total
  FROM ruled
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN total + {bias} * sqrt(CAST(greatest(n, 1) AS DOUBLE)) > 0 THEN 'block' ELSE 'allow' END) AS verdict FROM summed
"""
