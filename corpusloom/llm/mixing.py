"""Mixing sources by temperature.

A source's share of the tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they come). The exponent is bisected so that the mixture's
entropy reaches a target, or so that no source is repeated beyond a limit. The
weights become token budgets, and a budget is filled by permutations: a source
is gone through whole, in a new keyed order each time, and of the last
permutation blocks are taken in order until the budget is full.

Only built-in functions are used. Sources are one row each; documents meet their
source's row without being gathered, and a source with very many is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh, words
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

SEED = "mix-1"
ENTROPY_SHARE = 0.97
MAX_EPOCHS = 4.0
#: The exponent in millionths, and the weights in 10 ** -12, so that budgets are whole numbers.
STEPS = 1_000_000
UNIT = 1_000_000_000_000
FAN = 32
ROWS_PER_SLICE = 100_000


def exponent(
    sources: DataFrame,
    entropy_share: float | None = ENTROPY_SHARE,
    max_epochs: float | None = MAX_EPOCHS,
    budget: int | None = None,
) -> int:
    """The exponent in millionths for ``sources(source, tokens)``.

    With ``entropy_share``: the largest exponent whose entropy is at least that
    share of the logarithm of the number of sources. With ``max_epochs``: at least
    the smallest exponent at which a ``budget`` repeats no source more often (1 if
    none does). Each pass tries ``FAN`` exponents, five bisections at once, in one
    aggregate; the driver sees ``FAN`` rows.
    """
    sources = sources.where("tokens > 0")
    total = sources.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not total[0]:
        return STEPS

    def tried(points: list[int]) -> dict[int, tuple[float, float]]:
        q = F.col("tokens") / F.lit(float(total[0]))
        k = F.explode(F.array(*[F.lit(p) for p in points])).alias("k")
        a = F.col("k") / F.lit(float(STEPS))
        p = F.pow(F.col("q"), a)
        rows = (
            sources.select(q.alias("q"), k)
            .groupBy("k")
            .agg(F.sum(p).alias("z"), F.sum(p * F.log("q")).alias("s"), F.max(p / F.col("q")).alias("r"))
            .select("k", F.log("z") - F.col("k") / float(STEPS) * F.col("s") / F.col("z"), F.col("r") / F.col("z"))
        )
        return {r[0]: (r[1], r[2]) for r in rows.collect()}

    def last(holds, lo: int) -> int:
        """The largest point at which ``holds``, given that it holds up to some point, at least ``lo``."""
        hi = STEPS + 1
        while hi - lo > 1:
            points = sorted({lo + (hi - lo) * i // FAN for i in range(1, FAN)} - {lo, hi})
            found = tried(points)
            good = [p for p in points if holds(found[p])]
            lo, hi = max([lo, *good]), min([hi, *(p for p in points if p not in good)])
        return lo

    out = STEPS
    if entropy_share is not None:
        floor = entropy_share * _log(total[1])
        out = last(lambda v: v[0] >= floor, 0)
    if max_epochs is not None:
        # A share w of the budget repeats a source w * budget / tokens times, or r * budget / total.
        scale = (total[0] if budget is None else budget) / total[0]
        least = last(lambda v: v[1] * scale > max_epochs, -1) + 1
        out = max(out, min(least, STEPS)) if entropy_share is not None else min(least, STEPS)
    return out


def _log(n: int) -> float:
    from math import log

    return log(n)


def _source(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def order_key(seed: str, source: Column, epoch: Column, doc: Column) -> Column:
    """The place of a document in a source's permutation of an epoch, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(seed), source, epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def plan(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    entropy_share: float | None = ENTROPY_SHARE,
    max_epochs: float | None = MAX_EPOCHS,
    budget: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """``(source, docs, tokens, weight, budget, epochs, cut)`` for each source.

    ``epochs`` whole permutations are taken, and of the next one the documents
    whose order key is below ``cut``. The budget is the total of the tokens unless
    given. Tokens are words; a source without any has weight 0.
    """
    rows = scratch.save(
        docs.select(
            F.col(id_col).alias("id"), _source(source_col).alias("source"), F.size(words(F.col(text_col))).cast("bigint").alias("n")
        ),
        "tokens",
    )
    sources = scratch.save(
        rows.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources"
    )
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    wanted = total if budget is None else budget
    alpha = exponent(sources, entropy_share, max_epochs, wanted) / STEPS
    q = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(alpha))
    raised = sources.withColumn("p", F.when(F.col("tokens") > 0, q).otherwise(0.0))
    z = raised.agg(F.sum("p")).first()[0] or 1.0
    unit = F.round(F.col("p") / F.lit(float(z)) * float(UNIT)).cast("decimal(38,0)")
    wide = unit * F.lit(wanted).cast("decimal(20,0)") + F.lit(UNIT // 2).cast("decimal(13,0)")
    budgets = scratch.save(
        raised.select("source", "docs", "tokens", (F.col("p") / F.lit(float(z))).alias("weight"), wide.alias("wide"))
        .withColumn("budget", F.expr(f"wide div {UNIT}bd"))
        .drop("wide")
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("bigint"))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0)),
        "budgets",
    )
    cuts = _cuts(rows, budgets, seed)
    return budgets.join(cuts, "source", "left").select(
        "source", "docs", "tokens", "weight", "budget", "epochs", F.coalesce("cut", F.lit("")).alias("cut")
    )


def _cuts(rows: DataFrame, budgets: DataFrame, seed: str) -> DataFrame:
    """``(source, cut)``: the first order key of the last permutation that doesn't fit any more.

    A block is the documents whose keys share three digits. Whole blocks are
    summed first; only the block in which the budget ends is looked at row by row.
    """
    size = budgets.select("source", F.col("docs").alias("n"))
    met = salted_join(rows, budgets.select("source", "epochs", "rest"), ["source"], size, F.col("id"), ROWS_PER_SLICE)
    keyed = met.select("source", "rest", "n", order_key(seed, F.col("source"), F.col("epochs"), F.col("id")).alias("key"))
    keyed = keyed.withColumn("block", F.substring("key", 1, 3))
    blocks = keyed.groupBy("source", "block").agg(F.sum("n").alias("sum"), F.max("rest").alias("rest"))
    upto = F.sum("sum").over(Window.partitionBy("source").orderBy("block"))
    # At most 4096 rows of a source.
    ends = (
        blocks.withColumn("upto", upto)
        .where("upto > rest")
        .groupBy("source")
        .agg(F.min_by(F.struct("block", (F.col("upto") - F.col("sum")).alias("before")), "block").alias("e"))
        .select("source", "e.block", "e.before")
    )
    last = keyed.join(ends, ["source", "block"])
    running = F.sum("n").over(Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, 0))
    return (
        last.withColumn("upto", F.col("before") + running)
        .where("upto > rest")
        .groupBy("source")
        .agg(F.min("key").alias("cut"))
    )


def mix(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: str = SEED,
    epoch: str | None = None,
    key: str | None = None,
    **targets: object,
) -> DataFrame:
    """The drawn rows of ``docs``, each as often as it is drawn, with its columns.

    With ``epoch`` and ``key``, columns of those names give the permutation and the
    order key of the draw. A null source is the same as an empty one. Documents of
    sources without a token aren't drawn; others without one are part of whole
    permutations. Rows that repeat an id are drawn together.
    """
    sources = scratch.save(plan(docs, scratch, id_col, source_col, text_col, seed=seed, **targets), "plan")
    e, k, s, cut, epochs = fresh(docs, "_epoch", "_key", "_source", "_cut", "_epochs")
    size = sources.select(F.col("source").alias(s), F.col("docs").alias("n"))
    small = sources.select(F.col("source").alias(s), F.col("cut").alias(cut), F.col("epochs").alias(epochs))
    met = salted_join(docs.withColumn(s, _source(source_col)), small, [s], size, F.col(id_col), ROWS_PER_SLICE)
    drawn = met.withColumn(e, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(epochs)))).withColumn(
        k, order_key(seed, F.col(s), F.col(e), F.col(id_col))
    )
    drawn = drawn.where((F.col(e) < F.col(epochs)) | (F.col(k) < F.col(cut)))
    extra = [F.col(c).alias(name) for c, name in ((e, epoch), (k, key)) if name]
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)
