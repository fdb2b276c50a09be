"""URL filter: a character language-model ratio behind allow and block rules.

Two variable-order Markov models, one of accepted and one of rejected urls, give the probability
of each character after the characters before it.  A url is judged by the difference of the two
log-likelihoods divided by its length, against a threshold calibrated on urls the models have not
seen.  Rules label the training urls: what a rule allows is accepted, what it blocks rejected.

The models are exact counts.  All that a model says of a character depends on the window of ORDER
characters that ends in it, so windows are counted, the counts of shorter contexts are sums over
windows, and each distinct window gets its share of the ratio by joins.  The table of windows grows
with the data.  The commonest windows, HOT at most, are sent to the tasks; urls that have others
meet these in a join on the window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rovelog.llm.common import join_counted, lower_ascii, shipped, small_batches, stored, table


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: Context lengths 0 to ORDER - 1 before the judged character.
ORDER = 5
#: Windows whose values are sent to the tasks at most; all others are joined.
HOT = 1 << 18
#: One in HELD_OUT labelled urls calibrates the threshold instead of training.
HELD_OUT = 5
#: Bins of the calibration histogram over score differences in nats a character.
BINS, SPAN = 4001, 8.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(urls: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds host, path, and the name and verdict of the longest rule that fits (null if none)."""
    host, path = split_url(F.col("_url"))
    out = urls.withColumn("_host", host).withColumn("_path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (
            (F.col("_host") == rule.host) | F.col("_host").endswith("." + rule.host)
        ) & F.col("_path").startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return out.withColumn("_rule", name).withColumn("_ruled", verdict)


#: Characters a url may hold: the uniform distribution below the shortest context.
ALPHABET = 256.0


def blended(p, seen, with_char):
    """The probability of a character after a context, from ``p``, that after the next shorter one.

    A context is blended with the shorter one by the weight n / (n + 2): the more often it was seen,
    the more it counts by itself.  Takes numbers, arrays or columns.
    """
    return (with_char + 2.0 * p) / (seen + 2.0)


def _windows(urls: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER characters up to each character and the end, of all urls in turn, and how many each url has."""
    texts = ["\x02" * (ORDER - 1) + url + "\x03" for url in urls]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    if not texts:
        return np.empty(0, dtype=f"<U{ORDER}"), sizes
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    within = np.ones(len(chars), dtype=bool)
    for back in range(1, ORDER):
        within[sizes.cumsum() - back] = False  # there the next url begins within the window
    found = np.lib.stride_tricks.sliding_window_view(chars, ORDER)[within[:len(chars) - ORDER + 1]]
    return np.ascontiguousarray(found).view(f"<U{ORDER}").ravel(), sizes - (ORDER - 1)


def counted_windows(urls: DataFrame) -> DataFrame:
    """window, rejected, accepted and n of every window of ``urls`` (_url, _kind: 0 rejected, 1 accepted, 2 neither)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            windows, sizes = _windows(batch["_url"])
            names, at = np.unique(windows, return_inverse=True)
            kinds = np.repeat(batch["_kind"].to_numpy(dtype=np.int64), sizes)
            n = np.bincount(3 * at + kinds, minlength=3 * len(names)).reshape(-1, 3)
            yield pd.DataFrame({"window": names.astype(object), "rejected": n[:, 0], "accepted": n[:, 1], "n": n.sum(axis=1)})

    rows = urls.mapInPandas(count, "window string, rejected long, accepted long, n long")
    return rows.groupBy("window").agg(*[F.sum(c).alias(c) for c in ("rejected", "accepted", "n")])


def window_values(windows: DataFrame) -> DataFrame:
    """window, n and ``value``, what the window adds to the log-ratio, of the stored ``windows``.

    Few windows at most share a long context, and there are few short ones, which Spark broadcasts.
    """
    kinds = ("rejected", "accepted")
    whole = windows.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in kinds]).first()
    p = [F.lit(1.0 / ALPHABET)] * 2
    rows = windows
    for k in range(ORDER):
        counts = {}
        for part, size in (("seen", k), ("with", k + 1)):
            if size == 0:
                counts[part] = [F.lit(n) for n in whole]
            elif size == ORDER:
                counts[part] = [F.col(c) for c in kinds]
            else:
                name = f"_{part}{k}"
                key = F.substring("window", ORDER - k, size)
                sums = windows.groupBy(key.alias(name)).agg(*[F.sum(c).alias(f"{name}_{c}") for c in kinds])
                rows = rows.withColumn(name, key).join(sums, name).drop(name)
                counts[part] = [F.col(f"{name}_{c}") for c in kinds]
        p = [blended(*of) for of in zip(p, counts["seen"], counts["with"])]
    return rows.select("window", "n", F.log(p[1] / p[0]).alias("value"))


class Ratios:
    """The log-ratio of urls, by the values of all their windows."""

    def __init__(self, urls: DataFrame, values: DataFrame):
        """``values`` is stored and has every window of ``urls`` (_url)."""
        total, distinct = values.agg(F.sum("n"), F.count(F.lit(1))).first()
        least = 0 if distinct <= HOT else total / HOT
        hot = values.where(F.col("n") > least).select("window", "value").toPandas().sort_values("window")  # HOT at most
        names = np.array(hot["window"].to_list(), dtype=f"<U{ORDER}")
        order = np.argsort(names)
        self.hot = shipped(urls.sparkSession, (names[order], hot["value"].to_numpy(dtype=np.float64)[order]))
        self.rest = None if distinct <= HOT else stored(self._rest(urls, values.where(F.col("n") <= least)))

    def _rest(self, urls: DataFrame, cold: DataFrame) -> DataFrame:
        """_code and _more, the values of the windows that are not sent, of the urls that have some."""
        hot = self.hot

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                windows, sizes = _windows(batch["_url"])
                other = ~_found(hot()[0], windows)[1]
                codes = np.repeat(batch["_code"].to_numpy(), sizes)
                yield pd.DataFrame({"_code": codes[other], "window": windows[other].astype(object)})

        rows = urls.select("_url").distinct().select("_url", _code("_url").alias("_code"))
        return (
            rows.mapInPandas(run, "_code binary, window string")
            .join(cold.select("window", "value"), "window")
            .groupBy("_code")
            .agg(F.sum("value").alias("_more"))
        )

    def added(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows``, all their columns, with the ratio of ``_url`` in nats a character."""
        hot = self.hot

        @F.pandas_udf("total double, others long")
        def known(urls: pd.Series) -> pd.DataFrame:
            windows, sizes = _windows(urls)
            at, there = _found(hot()[0], windows)
            of = np.repeat(np.arange(len(urls)), sizes)
            value = np.zeros(len(windows))
            value[there] = hot()[1][at[there]]
            return pd.DataFrame({
                "total": np.bincount(of, value, minlength=len(urls)),
                "others": np.bincount(of[~there], minlength=len(urls)),
            })

        judged = rows.withColumn("_known", known(F.coalesce("_url", F.lit(""))))
        size = F.coalesce(F.length("_url"), F.lit(0)) + 1
        if self.rest is None:
            return judged.withColumn(name, F.col("_known.total") / size).drop("_known")
        # a url repeated very often has no other windows; its rows get keys of their own, which meet nothing
        alone = F.monotonically_increasing_id().cast("string").cast("binary")
        key = F.when(F.col("_known.others") > 0, _code("_url")).otherwise(F.concat(F.lit(b"-"), alone))
        joined = join_counted(
            judged.withColumn("_own", key), self.rest, F.col("_own") == F.col("_code"), "left", 64
        )
        total = F.col("_known.total") + F.coalesce("_more", F.lit(0.0))
        return joined.withColumn(name, total / size).drop("_known", "_own", "_code", "_more")


def _code(url: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(url), F.lit(""))))


def _found(names: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each window is in the sorted ``names``, and whether it is there."""
    if not len(names):
        return np.zeros(len(windows), dtype=np.int64), np.zeros(len(windows), dtype=bool)
    at = np.searchsorted(names, windows)
    at[at == len(names)] = 0
    return at, names[at] == windows


def calibrate(held: DataFrame) -> float:
    """The threshold on ``_ratio`` with the best balanced accuracy over ``held`` (_ratio, _ruled).

    Both sides are counted in a histogram of fixed size.  Between equally good thresholds the
    middle is taken; without examples of both kinds it is 0.
    """
    bin_ = F.floor((F.least(F.greatest("_ratio", F.lit(-SPAN)), F.lit(SPAN)) + SPAN) / (2 * SPAN) * (BINS - 1))
    rows = held.groupBy(bin_.alias("bin"), (F.col("_ruled") == "allow").alias("ok")).count().collect()  # 2 * BINS at most
    found = np.zeros((2, BINS))
    for row in rows:
        found[int(row["ok"]), row["bin"]] += row["count"]
    if not found.sum(axis=1).all():
        return 0.0
    blocked_below = np.concatenate([[0], found[0].cumsum()]) / found[0].sum()
    allowed_below = np.concatenate([[0], found[1].cumsum()]) / found[1].sum()
    gain = blocked_below - allowed_below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 / (BINS - 1) * 2 * SPAN - SPAN)


def filter_urls(urls: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    The verdict is that of the longest rule that fits; else ``allow`` if the language-model ratio
    reaches the calibrated threshold, else ``block``.  ``score`` is that ratio above the threshold.
    A null url is judged as the empty text.  Without any labelled url all ratios are 0 and urls
    without a rule are allowed.  Columns of the same names in ``urls`` are replaced; all others are
    kept, whatever their names.  Repeated rows are judged alike.  An empty table gives no rows.
    """
    small_batches(urls.sparkSession)
    spread = with_rules(urls.select(F.coalesce(F.col(url), F.lit("")).alias("_url")), rules)
    held = F.pmod(F.xxhash64("_url"), F.lit(HELD_OUT)) == 0
    kind = F.when(F.col("_ruled").isNotNull() & ~held, (F.col("_ruled") == "allow").cast("int")).otherwise(2)
    windows = stored(counted_windows(spread.select("_url", kind.alias("_kind"))))
    ratios = Ratios(spread, stored(window_values(windows)))
    threshold = calibrate(ratios.added(spread.where("_ruled is not null").where(held), "_ratio"))
    # the caller's columns travel as one, so that no name meets those used here
    judged = ratios.added(with_rules(urls.select(F.struct(*urls.columns).alias("_row"), F.col(url).alias("_url")), rules), "_score")
    judged = judged.withColumn("_score", F.col("_score") - threshold)
    by_model = F.when(F.col("_score") >= 0, "allow").otherwise("block")
    results = {
        "host": F.col("_host"), "path": F.col("_path"), "rule": F.col("_rule"), "verdict": F.coalesce("_ruled", by_model), "score": F.col("_score"),
    }
    kept = [F.col("_row")[c].alias(c) for c in urls.columns if c.lower() not in results]
    return judged.select(*kept, *[c.alias(name) for name, c in results.items()])


def op4_url_lm_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")
