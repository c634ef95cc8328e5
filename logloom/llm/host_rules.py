"""Quality rules of documents, judged together with the host they come from.

1. `measure` adds what the rules look at and which of them a text fails, all within its own row.
2. `host_verdicts` adds up failures by host and shrinks each rate towards all hosts: the rates' mean and
   variance give a beta prior, whose two numbers act as failures and passes seen beforehand, so a host
   with few documents is judged mostly by what is usual.
3. `apply_verdicts` joins the verdicts back. A document that fails a base rule goes. A document of a host
   that fails too often has to keep stricter limits as well; one that keeps them stays, whatever its host.

Everything is DataFrame functions. A NULL text has no words and fails; a NULL host is a host of its own.
Repeated rows count as often as they occur and are judged alike. An empty table gives an empty result.
Columns of the input stay; a column with the name of an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.tables import stored, whole_text
from logloom.plans.once import with_once

_BLANK = r"[\x20\x09-\x0D]"
_SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as repeated when it is found twice.
WINDOW = 5
#: What `measure` adds.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """The rules. Base rules hold for every document; the strict ones for those of failing hosts. A host
    fails a rule when its shrunk rate is above `host_rate`."""

    min_words: int = 10
    max_repeat_percent: int = 20
    strict_symbols_percent: int = 10
    strict_dup_lines_percent: int = 30
    strict_repeat_percent: int = 10
    host_rate: float = 0.5


RULES = ["short", "repeats", "symbols", "dup_lines"]


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words covered by windows that are found twice or more in the array, the first time included.

    Hashes of the windows tell whether any repeats; only then are the windows themselves compared. Equal
    windows lie together after sorting by (window, position); their positions, in order, each cover up
    to the next one, a full window at most.
    """
    n_windows = F.size(words) - (WINDOW - 1)
    places = F.sequence(F.lit(0), n_windows - 1)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    windows = F.transform(
        places, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("i")))
    none = F.lit(0).cast("bigint")
    repeated = _let(F.sort_array(windows), lambda found: _let(_twins(found), _covered))
    return F.when(n_windows < 2, none).otherwise(_let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeated)))


def _twins(found: Column) -> Column:
    """Ascending positions of the windows that equal a neighbour in the sorted array."""
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    twins = F.filter(found, lambda x, n: same(x, F.get(found, n - 1)) | same(x, F.get(found, n + 1)))
    return F.sort_array(F.transform(twins, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    reach = F.transform(places, lambda x, n: F.least(F.get(places, n + 1) - x, F.lit(WINDOW)))
    return F.aggregate(reach, F.lit(0).cast("bigint"), lambda s, r: s + r)


def measure(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Documents with MEASURES, `base_failed`, `strict_failed` and `failures` (a boolean per rule)."""
    whole = whole_text(text)
    percent = lambda part, of, most: F.col(part) * 100 > F.col(of) * most
    split = docs.drop(*MEASURES, "base_failed", "strict_failed", "failures", "_words", "_lines", "_measured").withColumns({
        "_words": F.filter(F.split(whole, f"{_BLANK}+"), lambda w: w != ""),
        "_lines": F.filter(F.split(whole, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")),
    })
    values = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(F.regexp_replace(whole, f"[^{_SYMBOLS}]+", F.lit(""))),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _repeated_words(F.col("_words")),
        "n_lines": F.size("_lines"),
    }
    # Later filters would repeat these expressions below the projection that has them.
    once = F.struct(*[v.cast("bigint").alias(n) for n, v in values.items()])
    measured = with_once(split, "_measured", once).drop("_words", "_lines").select("*", "_measured.*").drop("_measured")
    strict = {
        "symbols": percent("n_symbols", "word_chars", limits.strict_symbols_percent),
        "dup_lines": percent("n_dup_lines", "n_lines", limits.strict_dup_lines_percent),
    }
    base = {
        "short": F.col("n_words") < limits.min_words,
        "repeats": percent("n_repeat_words", "n_words", limits.max_repeat_percent),
    }
    return measured.withColumns({
        "base_failed": base["short"] | base["repeats"],
        "strict_failed": strict["symbols"] | strict["dup_lines"]
        | percent("n_repeat_words", "n_words", limits.strict_repeat_percent),
        "failures": F.struct(*[(base | strict)[r].alias(r) for r in RULES]),
    }).drop("n_lines")


def host_verdicts(measured: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per host: documents, failures and shrunk rate per rule, and whether the host fails any.

    With mean m and variance v of the hosts' rates, the prior is a beta distribution of the same mean and
    variance; where v leaves none (one host, or all alike) it counts as one document. The sums per host
    are stored, and one row of moments comes to the driver.
    """
    failed = lambda rule: F.col("failures")[rule].cast("bigint")
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(failed(r)).alias(f"n_{r}") for r in RULES])
    rate = lambda r: F.col(f"n_{r}") / F.col("n_docs")
    hosts = stored(hosts, "hosts")
    moments = hosts.agg(
        *[F.avg(rate(r)).alias(f"m_{r}") for r in RULES], *[F.var_pop(rate(r)).alias(f"v_{r}") for r in RULES]).first()
    shrunk = {}
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        weight = max(m * (1 - m) / v - 1, 1.0) if v else 1.0
        shrunk[f"rate_{r}"] = (F.col(f"n_{r}") + m * weight) / (F.col("n_docs") + weight)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return hosts.withColumns(shrunk).withColumn("host_failed", worst > limits.host_rate)


def apply_verdicts(measured: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Documents with `host_failed` and `kept`. The verdicts come from a stored table, so Spark knows their
    size: it sends few hosts to all tasks, and sorts and merges many, splitting the hot ones."""
    judged = verdicts.select(F.col("host").alias("_host"), "host_failed")
    joined = measured.drop("host_failed", "kept").join(judged, F.col(host).eqNullSafe(F.col("_host")), "left")
    failed = F.coalesce("host_failed", F.lit(False))
    return joined.withColumns({
        "host_failed": failed,
        "kept": ~F.col("base_failed") & ~(failed & F.col("strict_failed")),
    }).drop("_host")


def host_quality(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits(),
                 with_text: bool = True) -> DataFrame:
    """Documents with MEASURES, `base_failed`, `host_failed` and `kept`; without their text on wish.

    Without texts the measured rows, which are short, go to the scratch folder, and texts are read once. With
    them the rules are computed twice, for the hosts and for the result, rather than writing whole texts.
    """
    measured = measure(docs, text, limits)
    if not with_text:
        measured = stored(measured.drop(text), "measured")
    return apply_verdicts(measured, host_verdicts(measured, host, limits), host).drop("failures", "strict_failed")
