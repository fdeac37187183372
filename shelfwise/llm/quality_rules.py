"""Quality rules as a bitmask ledger (native columns only).

``ledger`` evaluates every rule once per document and stores the measurements and one long of
failure bits. A policy is a named, versioned set of rules (a mask): applying it is one bitwise
AND, and an ablation (what each rule rejects, and what only it rejects) is an aggregation over
the distinct bit patterns, so neither reads a text again.

Repeated 8-word windows are compared by 64-bit hashes inside one document.

Nulls, empty and blank texts: no words, every count 0, ``too_few_words`` set. Rows are judged one
by one, so repeated rows and ids give repeated results. Extra columns are passed through
``apply_policy`` untouched; the ledger itself takes only the id and the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import has_word, let, lines_col, words_col

WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails when ``fails`` (a condition over the measurement columns) is true."""
    bit: int
    name: str
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


#: Bits are never reused or renumbered: a stored ledger stays readable by later policies.
RULES: tuple[Rule, ...] = (
    Rule(0, "too_few_words", lambda: _c("n_words") < 20),
    Rule(1, "repeated_windows", lambda: 100 * _c("n_repeat_words") > 30 * _c("n_words")),
    Rule(2, "symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule(3, "word_length", lambda: (_c("word_chars") < 2 * _c("n_words")) | (_c("word_chars") > 15 * _c("n_words"))),
    Rule(4, "shouting", lambda: 10 * _c("n_upper") > 3 * _c("word_chars")),
    Rule(5, "repeated_lines", lambda: 2 * _c("n_dup_lines") > _c("n_lines")),
    Rule(6, "stutter", lambda: 5 * _c("n_stutter_words") > _c("n_words")),
    Rule(7, "exclamations", lambda: 10 * _c("n_exclamations") > 3 * _c("n_words")),
)
BASE_MASK = 0b11

#: Versioned policies: name -> rule names.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("too_few_words", "repeated_windows"),
    "web-1": ("too_few_words", "repeated_windows", "symbols", "word_length"),
    "web-2": tuple(r.name for r in RULES),
}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_exclamations", "n_lines", "n_dup_lines",
                "n_stutter_words", "n_repeat_words")


def mask_of(policy: str) -> int:
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[name] for name in POLICIES[policy])


def _count(text: Column, chars: str) -> Column:
    """Code points of a character class: what is left when everything else is cut out."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _paired(a: Column, gap: int) -> Column:
    return F.zip_with(a, F.slice(a, F.lit(gap + 1), F.size(a)), lambda x, y: F.xxhash64(x, y))


def _window_hashes(hashes: Column) -> Column:
    """Hash of each run of 8 word hashes, by doubling: runs of 2, of 4, of 8."""
    return let(_paired(hashes, 1), lambda two: let(_paired(two, 2), lambda four: F.slice(
        _paired(four, 4), F.lit(1), F.size(four) - (WINDOW - 1))))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the word hashes of one document."""
    def covered(windows: Column) -> Column:
        def starts(ordered: Column) -> Column:
            again = lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"])
            hits = F.filter(F.transform(ordered, lambda x, i: F.when(again(x, i), x["i"])), lambda p: p.isNotNull())
            return F.sort_array(hits)
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        total = lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                                      F.lit(0), lambda a, b: a + b)
        heavy = let(let(ordered, starts), total)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(heavy)

    return F.when(F.size(hashes) > WINDOW, let(_window_hashes(hashes), covered)).otherwise(F.lit(0))


def _stutter(hashes: Column) -> Column:
    return let(hashes, lambda a: F.size(F.filter(a, lambda h, i: F.coalesce(h == F.get(a, i - 1), F.lit(False)))))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements..., ``fail_bits`` long): one row per input row, no shuffle."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(lines_col(text), has_word)
    measured = docs.select(
        F.col(f"`{id_col}`"),
        # one struct per group of measurements, so that the word and line arrays are built once
        let(words_col(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
                _repeat_words(h).cast("long").alias("n_repeat_words"),
                _stutter(h).cast("long").alias("n_stutter_words"))).alias("h"))).alias("_w"),
        let(lines, lambda a: F.struct(F.size(a).cast("long").alias("n_lines"),
                                      (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"))).alias("_l"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count(text, r"\p{Lu}").cast("long").alias("n_upper"),
        _count(text, "!").cast("long").alias("n_exclamations"),
    ).select(f"`{id_col}`", "_w.n_words", "_w.word_chars", "n_symbols", "n_upper", "n_exclamations", "_l.n_lines",
             "_l.n_dup_lines", "_w.h.n_stutter_words", "_w.h.n_repeat_words")
    bits = sum((F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES), F.lit(0))
    return measured.withColumn("fail_bits", bits.cast("long"))


def apply_policy(ledger_df: DataFrame, policy: str = "web-2") -> DataFrame:
    """Adds ``kept``: no failed rule among those of the policy."""
    return ledger_df.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0)


def ablation(ledger_df: DataFrame, policy: str = "web-2") -> DataFrame:
    """(rule, n_docs, n_failed, n_failed_only_here, n_kept, n_kept_without_rule) for the policy's rules.

    Documents are first counted by failure pattern (at most 2**rules rows), so the rules are
    compared on counts only. An empty ledger gives zeros.
    """
    mask = mask_of(policy)
    patterns = ledger_df.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if r.name in POLICIES[policy]]
    pick = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    total = patterns.agg(*(x for r in rules for x in (
        pick(F.col("p").bitwiseAND(F.lit(1 << r.bit).cast("long")) != 0).alias(f"f{r.bit}"),
        pick(F.col("p") == (1 << r.bit)).alias(f"o{r.bit}"))),
        pick(F.lit(True)).alias("n_docs"), pick(F.col("p") == 0).alias("n_kept"))
    rows = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(f"f{r.bit}").alias("n_failed"),
                                        F.col(f"o{r.bit}").alias("n_failed_only_here")) for r in rules)))
    return (total.select("n_docs", "n_kept", rows.alias("r"))
            .select("r.rule", "n_docs", "r.n_failed", "r.n_failed_only_here", "n_kept",
                    (F.col("n_kept") + F.col("r.n_failed_only_here")).alias("n_kept_without_rule")))
