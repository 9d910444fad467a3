"""Quality rules as a bitmask ledger, with DataFrame functions only.

``ledger`` measures every text once and stores the measurements and one failure bit a rule.
``apply_policy`` then reads bits alone, so that a new version of a policy needs no second pass over
the texts, and ``ablation`` counts, from the few distinct bit patterns, what each rule removes alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, word_array

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"


def _rules() -> dict[str, Column]:
    """Every rule, true where it fails; the place in this dict is its bit. All in whole numbers."""
    c = F.col
    return {
        "few_words": c("n_words") < 20,
        "repeated_windows": c("n_repeat_words") * 100 > c("n_words") * 30,
        "many_symbols": c("n_symbols") * 10 > c("n_words"),
        "duplicate_lines": c("n_dup_lines") * 2 > c("n_lines"),
        "short_mean_word": c("word_chars") < c("n_words") * 2,
        "long_mean_word": c("word_chars") > c("n_words") * 20,
        "repeated_windows_strict": c("n_repeat_words") * 100 > c("n_words") * 20,
        "duplicate_lines_strict": c("n_dup_lines") * 100 > c("n_lines") * 30,
    }


RULES = ("few_words", "repeated_windows", "many_symbols", "duplicate_lines", "short_mean_word", "long_mean_word", "repeated_windows_strict", "duplicate_lines_strict")


@dataclass(frozen=True)
class Policy:
    """A version of what is removed: the rules that count."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STANDARD = Policy("1", ("few_words", "repeated_windows", "many_symbols", "duplicate_lines", "short_mean_word", "long_mean_word"))
STRICT = Policy("2", RULES)


def _twice(at: Column) -> Column:
    """Places, in order, of the windows whose hash is there twice or more.

    at: a column, not an expression, of (window hash h, place i) in order, so that equal hashes are
    neighbours.
    """
    own = lambda i: F.get(at, i)["h"]
    same = lambda x, i: F.coalesce(x["h"] == own(i - 1), F.lit(False)) | F.coalesce(x["h"] == own(i + 1), F.lit(False))
    return F.array_sort(F.transform(F.filter(at, same), lambda x: x["i"]))


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """Measurements and fail_bits of every row of docs, beside the columns named in keep.

    Null text counts as empty: all measurements 0. n_lines are the \\n-split lines with a word.
    Ties, repeated rows and other columns don't matter: each row is measured on its own.
    """
    d = docs.select(*keep, text_of().alias("_text"))
    d = d.withColumn("_words", word_array(F.col("_text")))
    word = lambda i, k: F.get("_words", i + F.lit(k))
    grams = F.transform(
        F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*(word(i, k) for k in range(WINDOW))),
    )
    d = d.withColumn("_h", grams).withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # only texts in which a window recurs are sorted; then each window adds its words up to the next one
    sorted_ = F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.withColumn("_sorted", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), sorted_))
    d = d.withColumn("_at", F.coalesce(_twice(F.col("_sorted")), F.array().cast("array<int>")))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, x: F.struct((s["n"] + F.least(x - s["last"], F.lit(WINDOW))).alias("n"), x.alias("last")),
        lambda s: s["n"],
    )
    d = d.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    rules = _rules()
    bits = sum((F.when(rules[r], F.lit(1 << i)).otherwise(0) for i, r in enumerate(RULES)), F.lit(0))
    return d.withColumn("fail_bits", bits.cast("int"))


def apply_policy(measured: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Adds base_failed and kept to a ledger, from its bits alone."""
    fails = lambda p: F.col("fail_bits").bitwiseAND(F.lit(p.mask)) != 0
    return measured.withColumn("base_failed", fails(BASE)).withColumn("kept", ~(fails(BASE) | fails(policy)))


def ablation(measured: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """rule, failed (rows that fail it), alone (rows that no other rule of the policy removes).

    Rows are first counted by bit pattern, of which there are 2 ** len(RULES) at most.
    """
    counts = measured.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).alias("bit")) for r in policy.rules)))
    by = counts.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return by.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("alone"),
    )
