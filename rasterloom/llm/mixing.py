"""Mixing sources to target weights with a low-discrepancy schedule.

Every source gets a target number of words by water filling. A golden-ratio
sequence is mapped through the cumulative targets, which deals slots to
sources evenly at every prefix of the schedule; slots are ranked per source,
and slot rank r of a source is joined to block r of that source's shuffled
documents, cut into blocks of equal word counts. A source that must repeat
starts its shuffled stream again, at most `max_repeats` times over.

Ranks and running sums are taken in steps, inside small chunks, over the
totals of a thousand chunks, and over the totals of those, so that one large
source does not end in one task. Only one row a source reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD_PATTERN, cut

#: Weights by the source's place in code-point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Documents whose running sum one window takes, over all sources.
CHUNK = 1_024
#: Chunks whose totals one window takes.
FAN = 1_024
#: Odd number nearest to 2**31 / golden ratio: i * GOLDEN mod 2**31 is a golden-ratio sequence in exact integers.
GOLDEN, MODULUS = 1_327_217_885, 1 << 31


def targets(sizes, weights, total: float, cap: float) -> np.ndarray:
    """Share `total` by weight; no share exceeds `cap` times its size, the excess going to the others by weight."""
    sizes, weights = np.asarray(sizes, dtype=np.float64), np.asarray(weights, dtype=np.float64)
    found = np.zeros(len(sizes))
    open_ = np.ones(len(sizes), dtype=bool)
    left = float(total)
    while open_.any():
        share = left * weights / weights[open_].sum()
        full = open_ & (share > cap * sizes)
        if not full.any():
            found[open_] = share[open_]
            break
        found[full] = cap * sizes[full]
        left -= found[full].sum()
        open_ &= ~full
    return found


def _before(totals: DataFrame) -> DataFrame:
    """From (source_no, chunk, n) to (source_no, chunk, before): the sum of n over the source's smaller chunks."""
    totals = totals.withColumn("fan", F.expr(f"chunk div {FAN}"))
    above = totals.groupBy("source_no", "fan").agg(F.sum("n").alias("n"))
    above = above.select("source_no", "fan", (F.sum("n").over(Window.partitionBy("source_no").orderBy("fan")) - F.col("n")).alias("above"))
    inside = F.sum("n").over(Window.partitionBy("source_no", "fan").orderBy("chunk")) - F.col("n")
    return totals.withColumn("inside", inside).join(above, ["source_no", "fan"]).select("source_no", "chunk", (F.col("above") + F.col("inside")).alias("before"))


def _slot_count(total: int, block_words: int) -> int:
    """Slots of `block_words` words, but at least some 65,000 where blocks can be that small."""
    block = max(16, min(block_words, total // 65_536))
    return max(1, min(MODULUS - 1, -(-total // block)))


def schedule(spark, quotas: list[int], slots: int) -> DataFrame:
    """(slot long, source_no int, rank long): the source of each slot, and which of the source's slots it is."""
    edges = np.cumsum(np.array(quotas, dtype=np.float64))
    edges /= edges[-1]

    def deal(batches):
        for batch in batches:
            slot = batch.column("id").to_numpy()
            point = (slot * GOLDEN % MODULUS + 0.5) / MODULUS
            source = np.minimum(np.searchsorted(edges, point, side="right"), len(quotas) - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(source)], ["slot", "source_no"])

    dealt = spark.range(slots).mapInArrow(deal, "slot long, source_no int").withColumn("chunk", F.shiftright("slot", 12))
    before = _before(dealt.groupBy("source_no", "chunk").agg(F.count("*").alias("n")))
    inside = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    return dealt.withColumn("inside", inside).join(before, ["source_no", "chunk"]).select("slot", "source_no", (F.col("before") + F.col("inside")).alias("rank"))


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, max_repeats: int = 2, weights: tuple[float, ...] = WEIGHTS, block_words: int = 8192, seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """The mix, as (plan, documents).

    plan: (slot, source, id, from_word, n_words), the words of each document
    that each slot takes; reading slots in order gives the mixed stream.
    documents: one row per input row with `id`, `size`, `source_size`,
    `target`, `taken`. Size is the number of words, 0 for a null text. A null
    source is a source of its own, after all others. Rows that repeat an id
    are separate documents; only rows that are equal in id and text share a
    place in the shuffle. An empty table, or one without words, gives targets
    of 0 and an empty plan. Texts may be of any length; a document is cut where
    a block ends.
    """
    spark = docs.sparkSession
    sized = cut(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), id_col, text_col).alias("key"),
        )
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in totals]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), max_repeats).tolist()
    quotas = [min(round(t), max_repeats * n) for t, n in zip(wanted, sizes, strict=True)]
    slots = _slot_count(sum(quotas), block_words)
    drawn = schedule(spark, quotas if sum(quotas) else [1], slots if sum(quotas) else 0)
    counts = {r["source_no"]: r["n"] for r in drawn.groupBy("source_no").agg(F.count("*").alias("n")).collect()}
    missed = [i for i, q in enumerate(quotas) if q and i not in counts]  # too small for a slot of the sequence: one at the end
    if missed:
        extra = spark.createDataFrame([(slots + k, i, 0) for k, i in enumerate(missed)], "slot long, source_no int, rank long")
        drawn = drawn.unionByName(extra)
    facts = spark.createDataFrame(
        [(i, r["source"], r["n"], wanted[i], quotas[i], max(1, -(-quotas[i] // max(1, counts.get(i, 1))))) for i, r in enumerate(totals)],
        "source_no int, source string, source_size long, target double, quota long, block long",
    )
    chunks = max(1, sum(r["rows"] for r in totals) // CHUNK)
    placed = sized.join(facts.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).withColumn("chunk", F.pmod("key", F.lit(chunks)))
    before = _before(placed.groupBy("source_no", "chunk").agg(F.sum("size").alias("n")))
    inside = F.sum("size").over(Window.partitionBy("source_no", "chunk").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = cut(placed.withColumn("inside", inside).join(before, ["source_no", "chunk"]).withColumn("at", F.col("before") + F.col("inside")).drop("named", "before", "inside"))
    turn = placed.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    start = F.col("at") + F.col("turn") * F.col("source_size")
    turn = turn.withColumn("start", start).withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("quota"))).where("start < stop")
    pieces = turn.withColumn("rank", F.explode(F.expr("sequence(start div block, (stop - 1) div block)")))
    low, high = F.greatest("start", F.col("rank") * F.col("block")), F.least("stop", (F.col("rank") + 1) * F.col("block"))
    plan = pieces.join(drawn, ["source_no", "rank"]).select(
        "slot", "source", "id", "source_no", "at", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words")
    )
    plan = cut(plan)
    taken = plan.groupBy("source_no", "at").agg(F.sum("n_words").alias("words"))
    mixed = placed.join(taken.withColumnRenamed("source_no", "s").withColumnRenamed("at", "a"), (F.col("source_no") == F.col("s")) & (F.col("at") == F.col("a")) & (F.col("size") > 0), "left")
    documents = mixed.select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken")
    )
    return plan.select("slot", "source", F.col("id").alias(id_col), "from_word", "n_words"), documents
