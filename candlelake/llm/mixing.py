"""Mix sources to target weights by repeating documents.

Words are aggregated per source; each source gets a share of the wanted total by its weight, capped at a number
of repetitions; a document is then emitted floor(rate) times, plus once more with the fraction as probability,
decided by a hash of its id and text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import number_rows, small, stored, word_count

UNIT_DIGITS = 13


def unit_hash(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts: 52 bits, exact in a double."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, UNIT_DIGITS), 16, 10).cast("long") / F.lit(float(16**UNIT_DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Targets of sources (source, source_size), whose weights repeat in order of code points, null last.

    A target is level * weight, or ``most`` times the source's size where that is less. The level is found by
    fixing the capped sources and sharing the rest anew until no target is above its cap; each round is one
    aggregate over the sources and fixes at least one of them.
    """
    numbered = number_rows(sizes, [F.col("source").asc_nulls_last()], "position")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("position", F.lit(len(weights))) + 1).cast("int"))
    weighed = numbered.withColumns({"weight": weight, "cap": F.col("source_size") * most})
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    wanted, level = share * total, None
    while True:
        fixed = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * level
        capped, free = weighed.agg(
            F.coalesce(F.sum(F.when(fixed, F.col("cap"))), F.lit(0)), F.sum(F.when(~fixed, F.col("weight")))
        ).first()
        if not free:
            break
        found = (wanted - capped) / free
        if found == level:
            break
        level = found
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return weighed.select("source", "source_size", target.alias("target"))


def mixing_plan(
    docs: DataFrame,
    *,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 42,
) -> DataFrame:
    """Each document of (doc_id, text, source, ...) with ``__mix_*`` columns; ``__mix_copies`` says how often to take it.

    Size is the number of words; a null text has none, a null source is a source of its own, and a source without
    words has rate 0. Rows that are equal in id and text are decided alike. Columns of the input named ``__mix_*`` are
    replaced; all others pass. No rows give no rows.
    """
    own = [c for c in docs.columns if not c.startswith("__mix_")]
    sized = docs.select(*own, word_count(F.col("text")).alias("__mix_size"))
    sizes = stored(sized.groupBy("source").agg(F.sum("__mix_size").alias("source_size")))
    # A table of few sources is broadcast after a count, so no source's rows meet; beyond, AQE splits a hot one.
    targets = small(stored(source_targets(sizes, weights, share, most)), "source").toDF("__mix_source", "__mix_source_size", "__mix_target")
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["__mix_source"])).drop("__mix_source")
    rate = F.when(F.col("__mix_source_size") > 0, F.col("__mix_target") / F.col("__mix_source_size")).otherwise(0.0)
    drawn = unit_hash(seed, F.col("doc_id").cast("string"), F.md5(F.col("text")))
    whole = F.floor("__mix_rate")
    extra = (drawn < F.col("__mix_rate") - whole).cast("long")
    return joined.withColumn("__mix_rate", rate).withColumn("__mix_copies", whole + extra)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each row as often as its plan says."""
    plan = mixing_plan(docs, **options)
    copies = F.explode(F.array_repeat(F.lit(True), F.col("__mix_copies").cast("int"))).alias("__mix_copy")
    return plan.select("*", copies).select(*[c for c in docs.columns if not c.startswith("__mix_")])
