"""What filters remove in every order in which they can be applied.

Each document gets one bit per filter it fails. These flags are crossed with
the 120 orders of the five filters (a broadcast table of fixed size), each
order finds the first step at which the document fails, the five steps are
exploded, and conditional counts are combined before the shuffle: what is
shuffled are 600 rows a part and task, however many documents there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import arrow_map, cut, partitions, slices
from .simhash import BLANK, PIECE

FILTERS = "ABCDE"
MIN_WORDS = 200
CAPITALS, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
#: Bit of the filter that looks at other documents.
COPY = 1 << FILTERS.index("E")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _own_bits(text: str) -> tuple[int, bytes]:
    """Bits of the filters that look at one text, and its 128-bit hash. Words are split piece by piece; distinct ones are held."""
    data = text.encode("utf-8", "surrogatepass")
    at, n_words, distinct = 0, 0, set()
    while at < len(data):
        blank = BLANK.search(data, at + PIECE) if len(data) - at > PIECE else None
        stop = blank.start() if blank else len(data)
        words = data[at:stop].split()  # on bytes: space and tab to carriage return
        n_words += len(words)
        distinct.update(words)
        at = stop
    capitals = len(data) - len(data.translate(None, CAPITALS))
    fails = (
        n_words < MIN_WORDS,
        100 * len(distinct) < 50 * n_words,
        100 * capitals > 3 * len(text),
        len(data.translate(None, SYMBOLS)) < len(data),
    )
    return sum(fail << i for i, fail in enumerate(fails)), hashlib.blake2b(data, digest_size=16).digest()


def flags(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails): one row per input row; bit i of `fails` is set if filter i of A to E fails.

    A null text counts as an empty one, a null part as the empty string. A row
    is a copy (E) if a row with a smaller id has the same text; rows with equal
    ids are no copies of each other, and a null id is neither smaller nor
    larger than another. Texts are compared by a 128-bit hash. An empty table
    gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches):
        for batch in slices(batches):
            found = [_own_bits(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), pa.array([b for b, _ in found], pa.int32()), pa.array([h for _, h in found], pa.binary())], ["id", "part", "own", "same"]
            )

    own = cut(arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, part string, own int, same binary"))
    # dealt anew, so that Spark can split a text with very many copies in the join
    first = own.groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first").repartition(partitions(docs.sparkSession))
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    fails = F.col("own").bitwiseOR(F.when(copy, COPY).otherwise(0)).alias("fails")
    return own.join(first, "same", "left").select(F.col("id").alias(id_col), "part", fails)


def with_labels(flagged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add `good` and `toxic`: whether any label row of the id says so; ids without labels are neither."""
    said = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col("quality") == 1).alias("g"), F.max(F.col("toxic") == 1).alias("t"))
    yes = lambda name: F.coalesce(name, F.lit(False))
    return flagged.join(said.repartition(partitions(labels.sparkSession), id_col), id_col, "left").select(*flagged.columns, yes("g").alias("good"), yes("t").alias("toxic"))


def first_failure(fails: Column, masks: Sequence[Column]) -> Column:
    """The step, from 1, of the first mask that hits; one more than there are if none does."""
    found = F.lit(len(masks) + 1)
    for step in range(len(masks), 0, -1):
        found = F.when(fails.bitwiseAND(masks[step - 1]) != 0, F.lit(step)).otherwise(found)
    return found


def replay(flagged: DataFrame) -> DataFrame:
    """Per part, order and step, the counts of `COUNTS` and `shapley`, from (part, fails, good, toxic).

    `kept` counts after the step and `removed` at it; `redundant` are removed
    earlier and fail this filter too, `unique_fails` fail this filter only;
    `shapley` sums what the step's filter removes over all orders. Every part
    has all 600 rows, zeros included; an empty table gives none.
    """
    n = len(FILTERS)
    every = [("".join(FILTERS[i] for i in order), *(1 << i for i in order)) for order in permutations(range(n))]
    orders = flagged.sparkSession.createDataFrame(every, "filter_order string, " + ", ".join(f"m{k} int" for k in range(1, n + 1)))
    masks = [F.col(f"m{k}") for k in range(1, n + 1)]
    crossed = flagged.select("part", "fails", "good", "toxic").crossJoin(F.broadcast(orders))
    crossed = crossed.withColumn("first", first_failure(F.col("fails"), masks))
    steps = crossed.select("part", "filter_order", "fails", "good", "toxic", "first", F.posexplode(F.array(*masks)).alias("place", "mask"))
    step = F.col("place") + 1
    here, fails = F.col("first") == step, F.col("fails").bitwiseAND(F.col("mask")) != 0
    conditions = (F.col("first") > step, here, (F.col("first") < step) & fails, F.col("fails") == F.col("mask"), here & F.col("good"), here & F.col("toxic"))
    counts = steps.groupBy("part", "filter_order", step.alias("step")).agg(*(F.count_if(c).alias(name) for name, c in zip(COUNTS, conditions, strict=True)))
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return counts.withColumn("shapley", F.sum("removed").over(own))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`replay` of the flags of all documents, with their labels."""
    return replay(with_labels(flags(docs), labels))
