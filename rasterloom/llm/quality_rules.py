"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and leaves one bit, next to the
measurements it used. A policy is a versioned set of rules; applying it, or
asking what a rule of it does, only combines bits and never reads texts again.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, slices

SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\v\f\r"
GRAM = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits")

#: Rule name -> condition under which it fails; a rule's bit is its place here. Append only: stored bits keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_passages": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
    "many_digits": "2 * n_digits > word_chars",
}
BASE = ("few_words", "repeated_passages")
#: Policy version -> the rules that it applies.
POLICIES: dict[str, tuple[str, ...]] = {"v1": BASE, "v2": tuple(RULES)}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str | tuple[str, ...], policies: Mapping[str, tuple[str, ...]] = POLICIES) -> int:
    return sum(bit(r) for r in (policies[policy] if isinstance(policy, str) else policy))


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window found twice or more, all of its places included."""
    grams = list(zip(*(words[i:] for i in range(GRAM)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    seen: set = set()
    twice = {g for g in grams if g in seen or seen.add(g)}
    covered = until = 0
    for i, g in enumerate(grams):
        if g in twice:
            covered += i + GRAM - max(i, until)
            until = i + GRAM
    return covered


def _measure(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # on bytes: space and tab to carriage return
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        _repeat_words(words), len(lines), len(data) - len(data.translate(None, b"0123456789")),
    )


def ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the measurements, `failed_bits`.

    A null text measures as an empty one. Rows that repeat an id are measured
    each for itself, an empty table gives no rows, and other columns are not
    read. A long text is split into words whole, in some forty times its size.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for part in slices(batches):
            found = list(zip(*(_measure(x or "") for x in part.column("text").to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(x, pa.int64()) for x in found)], ["id", *MEASURES])

    kind = rows.schema["id"].dataType.simpleString()
    measured = arrow_map(rows, run, f"id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = sum((F.when(F.expr(condition), F.lit(bit(name)).cast("long")).otherwise(F.lit(0)) for name, condition in RULES.items()), F.lit(0).cast("long"))
    return measured.select(F.col("id").alias(id_col), *MEASURES, bits.alias("failed_bits"))


def failed(rules: str | tuple[str, ...], bits: Column | str = "failed_bits") -> Column:
    """Whether any rule of a policy failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(rules))) != 0 if isinstance(bits, str) else bits.bitwiseAND(F.lit(mask(rules))) != 0


def ablation(entries: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of the policy: documents it fails, those it alone fails, those that all rules but it keep, and all rules keep.

    The ledger is reduced to counts of bit patterns first (2 ** rules rows at
    most); the rest is arithmetic on those. An empty ledger gives zeros.
    """
    whole = mask(policy)
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rules = entries.sparkSession.createDataFrame([(r, bit(r)) for r in POLICIES[policy]], "rule string, bit long")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    hit, rest = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return rules.join(F.broadcast(patterns), F.lit(True), "left").groupBy("rule").agg(
        count(hit).alias("failed"), count(F.col("bits") == F.col("bit")).alias("failed_alone"), count(rest == 0).alias("kept_without"), count(F.col("bits") == 0).alias("kept")
    )
