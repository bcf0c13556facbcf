"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` measures every document and evaluates every rule once: a row holds the measurements and ``failures``,
an integer whose bit k is set if rule k fails. A policy is a named, versioned set of rules; applying one, or
comparing several, is bit arithmetic on the ledger and never reads a text again.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words. Repeated five-word windows are found by
64-bit hashes of the windows; two different windows of one text of 20,000 words share one with a chance of about
1e-11. Rows are independent of each other, so repeated ids, null ids and extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, unfolded, whole_row

SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")

#: Name and failing condition over the measurements; the place in the list is the bit. Only append to it.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("long_words", "word_chars > 25 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("shouting", "100 * n_upper > 60 * word_chars"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
WEB = Policy("web", 1, tuple(BIT))
POLICIES = (BASE, WEB)


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Plain replacement, one character after the other: far cheaper than a regular expression."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _repeat_words(words: str, windows: str) -> Column:
    """Words inside the windows that occur twice or more: their places are sorted and their spans united."""
    ordered = F.sort_array(F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def spans(s: Column) -> Column:
        same = lambda k, j: F.get(s, k).getField("h") == F.get(s, j).getField("h")
        at = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: F.coalesce((k > 0) & same(k, k - 1), F.lit(False))
            | F.coalesce((k < F.size(s) - 1) & same(k, k + 1), F.lit(False)),
        )
        places = F.sort_array(F.transform(at, lambda k: F.get(s, k).getField("i")))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
            lambda acc, p: F.struct(
                (p + WINDOW).alias("end"),
                (acc["total"] + p + WINDOW - F.greatest(p, acc["end"])).alias("total"),
            ),
            lambda acc: acc["total"],
        )

    none_twice = F.size(F.array_distinct(F.col(windows))) == F.size(F.col(windows))
    # one-element array: the sorted windows are bound once and then used by name
    counted = F.element_at(F.transform(F.array(ordered), spans), 1)
    return F.when((F.size(words) < WINDOW + 1) | none_twice, F.lit(0)).otherwise(counted)


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the measurements (long) and ``failures`` (long) of every row of ``docs``."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split(_replaced(text, SPACES, " "), " "), ""))
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn(
        "_windows",
        F.when(
            F.size("_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    ).withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    measures = (
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(_replaced(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_words", "_windows").cast("long").alias("n_repeat_words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )
    # one struct, unfolded by a generator: a filter on the results stays above it, so nothing is measured twice
    measured = rows.select(*[F.col(c) for c in keep], F.inline(F.array(F.struct(*measures))))
    failures = F.lit(0).cast("long")
    for name, condition in RULES:
        failures = failures.bitwiseOR(F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failures", failures)


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    One pass over the ledger: counts for each distinct bitmask (at most 2 ** len(RULES) rows), then bit tests.
    An empty ledger gives zeros.
    """
    masks = rows.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask).cast("long")).alias("m")).agg(
        F.count("*").alias("n")
    )
    m, n = F.col("m"), F.col("n")
    total = lambda hit: F.coalesce(F.sum(F.when(hit, n)), F.lit(0))
    each = [
        F.struct(
            F.lit(policy.name).alias("policy"),
            F.lit(policy.version).alias("version"),
            F.lit(rule).alias("rule"),
            total(m.bitwiseAND(F.lit(BIT[rule]).cast("long")) != 0).alias("n_failed"),
            total(m == BIT[rule]).alias("n_failed_alone"),
            total(m.bitwiseAND(F.lit(policy.mask & ~BIT[rule]).cast("long")) == 0).alias("n_kept_without"),
        )
        for rule in policy.rules
    ]
    return masks.agg(F.array(*each).alias("each")).select(F.explode("each").alias("e")).select("e.*")


def judged(docs: DataFrame, policy: Policy = WEB) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` (false if the base rules fail, else the policy's verdict), and the name and
    version of the policy."""
    return verdicts(ledger(docs), policy)


def verdicts(rows: DataFrame, policy: Policy) -> DataFrame:
    """A policy applied to a ledger, stored or not: nothing is measured again, whatever version of a policy comes."""
    return rows.withColumns(
        {
            "base_failed": ~passes(BASE),
            "kept": passes(BASE) & passes(policy),
            "policy": F.lit(policy.name),
            "version": F.lit(policy.version),
        }
    )


def kept_documents(docs: DataFrame, policy: Policy = WEB) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns only."""
    rows = docs.select(whole_row(docs, "_doc"), column("text"))
    return unfolded(ledger(rows, ("_doc",)).where(passes(BASE) & passes(policy)), "_doc", docs.columns)
