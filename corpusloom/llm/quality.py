"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one failure bit per rule; a policy is a versioned mask over those bits, so that a
change of policy, or an ablation, reads the ledger and never the texts again.
Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BLANKS, fresh, let, words

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 15 * n_words"),
    Rule(5, "repeated_lines", "2 * n_dup_lines > n_lines"),
)


def mask(*names: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


#: A version is never edited; a new set of rules gets a new name.
POLICIES = {
    "base-1": mask("few_words", "repeated_windows"),
    "web-1": mask(*(r.name for r in RULES)),
}


def measurements(text: Column) -> Column:
    """A struct of counts; null counts as the empty text.

    ``n_words``; ``word_chars``, the code points in words; ``n_symbols``;
    ``n_lines`` with a word; ``n_dup_lines`` of them equal to an earlier one;
    ``n_repeat_words``, the words inside 3-word windows that occur twice or more.
    Windows are compared by a 64-bit hash within their document.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    def of_lines(rows: Column) -> Column:
        return F.struct(
            F.size(rows).cast("bigint").alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("bigint").alias("n_dup_lines"),
        )

    return F.struct(
        let(words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )


def _repeat_words(w: Column) -> Column:
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda word, i: F.struct(
            F.xxhash64(word, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")
        ),
    )
    # Sorted by hash, equal windows are neighbours; no window is compared with all others.
    found_twice = let(
        F.sort_array(windows),
        lambda s: F.filter(
            s,
            lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]),
        ),
    )
    starts = F.sort_array(F.transform(found_twice, lambda x: x["at"]))
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(
        starts,
        state,
        lambda a, at: F.struct(
            (a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")
        ),
        lambda a: a["n"],
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def ledger(df: DataFrame, text_col: str = "text", into: str = "ledger") -> DataFrame:
    """``df`` with a struct column ``into``: the measurements and ``fail_bits``.

    Every input row gives one row, repeated rows included. Null and empty texts
    have counts of 0. ``into`` must not be a column of ``df`` (see ``fresh``).
    """
    (m,) = fresh(df, "_measured")
    flat = {
        "n_words": f"{m}.w.n_words",
        "word_chars": f"{m}.w.word_chars",
        "n_repeat_words": f"{m}.w.n_repeat_words",
        "n_lines": f"{m}.l.n_lines",
        "n_dup_lines": f"{m}.l.n_dup_lines",
        "n_symbols": f"{m}.n_symbols",
    }
    measured = df.withColumn(m, measurements(F.col(text_col)))
    struct = F.struct(*[F.col(flat[c]).alias(c) for c in MEASURES])
    bits = F.lit(0).cast("bigint")
    for rule in RULES:
        # The rule names measurements; they are looked up in the struct.
        terms = [f"{m}_.{t}" if t in MEASURES else t for t in rule.fails.split()]
        bits = bits.bitwiseOR(
            F.when(F.expr(" ".join(terms)), F.lit(1 << rule.bit)).otherwise(0).cast("bigint")
        )
    return (
        measured.withColumn(f"{m}_", struct)
        .withColumn(into, F.col(f"{m}_").withField("fail_bits", bits))
        .drop(m, f"{m}_")
    )


def passes(fail_bits: Column, policy: str) -> Column:
    return fail_bits.bitwiseAND(F.lit(POLICIES[policy])) == 0


def keep(df: DataFrame, policy: str = "web-1", text_col: str = "text") -> DataFrame:
    """The rows that pass the policy, with their columns unchanged."""
    (into,) = fresh(df, "_ledger")
    kept = ledger(df, text_col, into).where(passes(F.col(f"{into}.fail_bits"), policy))
    return kept.select(*df.columns)


def ablations(ledgers: DataFrame, policy: str, into: str = "ledger") -> DataFrame:
    """``(rule, failed, regained)`` of each rule of a policy, from the ledger alone.

    ``failed`` rows break the rule; ``regained`` rows break no other rule of the
    policy, so they would be kept without it. Rows are first counted per set of
    failure bits, of which there are at most 2 ** rules, however large the table.
    """
    bits = F.col(f"{into}.fail_bits").bitwiseAND(F.lit(POLICIES[policy]))
    sets = ledgers.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if POLICIES[policy] >> r.bit & 1]
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("bit")) for r in rules]))
    return (
        sets.select("bits", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("regained"),
        )
    )
