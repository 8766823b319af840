"""Secret scanning with DataFrame functions only.

Three base patterns are located exactly; on top, candidate strings are scored
by the Shannon entropy of a sliding window, kept up to date from the counts of
the one character that enters and the one that leaves, and judged per
character class. Windows that hold a word of the allow list do not count, nor
do candidates that look harmless as a whole; those that a base span covers add
nothing. A candidate needs a letter and a digit.

Work is linear in the text, however long a candidate or however many matches:
folds over arrays run in chunks, as a fold that appends copies what it holds,
and strings are read in pieces, as reading at an offset starts from the front.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base patterns in the order of their kinds.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN = 6

#: Words that no secret's window holds.
ALLOWED_WORDS = r"(?i)example|sample|placeholder|changeme|dummy|redacted|x{6,}|0{8,}|0123456789|abcdefghij|qwertyuiop"
#: Whole candidates that look random to a counter but are no secrets.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9+/_=-]+$",
)
#: Elements that a fold takes before what it found is put aside, and characters of a piece.
FOLD, PIECE = 256, 4096


@dataclass(frozen=True)
class EntropyRule:
    """Window size, and per character class (pattern of the whole candidate) the bits that its best window must reach."""

    window: int = 20
    candidate: str = r"[A-Za-z0-9+/_=-]{20,}"
    classes: tuple[tuple[str, float], ...] = field(
        default=((r"^[0-9a-fA-F]+$", 3.0), (r"^[0-9a-z+/_=-]+$", 3.75), (r"^[0-9A-Z+/_=-]+$", 3.75), (r".", 3.95))
    )
    allowed: tuple[str, ...] = ALLOWED
    allowed_words: str = ALLOWED_WORDS


def _located(text: Column, pattern: str, group: int = 0) -> tuple[Column, Column, Column]:
    """Texts between matches, the matches, and one group of each match."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


SPAN = "array<struct<start:int,rank:int,stop:int,value:string>>"
EDGES = "array<struct<start:int,stop:int>>"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _fold(items: Column, start: Column, kind: str, step) -> Column:
    """All that `step(state, item) -> (state, array to append)` appends, in order, as an array of SQL type `kind`."""
    none = F.array().cast(kind)
    inner = lambda state: F.struct(state.alias("state"), none.alias("found"))

    def one(held, item):
        state, more = step(held["state"], item)
        return F.struct(state.alias("state"), F.concat(held["found"], more).alias("found"))

    def whole(items):
        def chunk(held, number):
            part = F.slice(items, number * FOLD + 1, F.lit(FOLD))
            return F.aggregate(part, inner(held["state"]), one, lambda done: F.struct(done["state"].alias("state"), F.concat(held["out"], F.array(done["found"])).alias("out")))

        chunks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / FOLD).cast("int"))
        zero = F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(chunks, zero, chunk, lambda held: F.flatten(held["out"]))

    return _bound(items, whole)


def _spans(between: Column, matches: Column, groups: Column, rank: int, keep) -> Column:
    """Code-point spans of the matches whose `keep(match, group)` holds."""
    zipped = F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("match"), groups.alias("group"))

    def step(at, item):
        start = at + F.length(item["gap"])
        stop = start + F.length(item["match"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), item["match"].alias("value"))).cast(SPAN)
        return stop, F.when(keep(item["match"], item["group"]), one).otherwise(F.array().cast(SPAN))

    return _fold(zipped, F.lit(0), SPAN, step)


def _pieces(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def best_window_entropy(value: Column, window: int, allowed_words: str | None = None) -> Column:
    """The highest Shannon entropy, in bits a character, of any `window` characters in a row; 0 for shorter strings.

    The running sum of count * log2(count) changes only by the character that
    leaves the window and the one that enters it. Windows that match
    `allowed_words` do not count.
    """
    weight = [n * math.log2(n) if n else 0.0 for n in range(window + 1)]
    # what the sum grows by as a character's count becomes n; nothing for 0
    growth = F.lit([0.0] + [weight[n] - weight[n - 1] for n in range(1, window + 1)])
    count = lambda text, char: F.length(text) - F.length(F.replace(text, char, F.lit("")))

    def step(state, fresh):
        inside = state["inside"]
        full = F.length(inside) >= window
        left = F.when(full, F.get(growth, count(inside, F.substring(inside, 1, 1)))).otherwise(F.lit(0.0))
        now = F.substring(F.concat(inside, fresh), -window, window)
        return F.struct(now.alias("inside"), (state["total"] - left + F.get(growth, count(now, fresh))).alias("total"), state["least"].alias("least"))

    def settle(state, fresh):
        """The state after `fresh`, with the least sum of all full windows so far."""
        return _bound(step(state, fresh), lambda new: F.struct(new["inside"], new["total"], F.when(counts(new), new["total"]).otherwise(new["least"]).alias("least")))

    def counts(state):
        better = (state["total"] < state["least"]) & (F.length(state["inside"]) >= window)
        return better if allowed_words is None else better & ~state["inside"].rlike(allowed_words)

    top = weight[window]
    start = F.struct(F.lit("").alias("inside"), F.lit(0.0).alias("total"), F.lit(top).alias("least"))
    through = lambda state, piece: F.aggregate(F.split(piece, ""), state, settle)
    return F.aggregate(_pieces(value), start, through, lambda s: (F.lit(top) - s["least"]) / window)


def _suspicious(value: Column, rule: EntropyRule) -> Column:
    threshold = F.coalesce(*[F.when(value.rlike(pattern), F.lit(bits)) for pattern, bits in rule.classes])
    allowed = F.lit(False)
    for pattern in rule.allowed:
        allowed = allowed | value.rlike(pattern)
    looks = value.rlike(r"[0-9]") & value.rlike(r"[A-Za-z]") & ~allowed
    return F.when(looks, best_window_entropy(value, rule.window, rule.allowed_words) >= threshold).otherwise(False)


def _not_covered(base: Column, entropy: Column) -> Column:
    """The entropy spans that no base span holds whole; one that a base span covers in part stays."""

    def step(reach, span):
        inside = (span["rank"] < KINDS.index("entropy")) | (span["stop"] <= reach)
        # base spans sort before an entropy span with the same start, so all that could hold it have been seen
        reach = F.when(span["rank"] < KINDS.index("entropy"), F.greatest(reach, span["stop"])).otherwise(reach)
        return reach, F.when(inside, F.array().cast(SPAN)).otherwise(F.array(span).cast(SPAN))

    found = _fold(F.array_sort(F.concat(base, entropy)), F.lit(-1), SPAN, step)
    return F.when(F.size(entropy) == 0, entropy).when(F.size(base) == 0, entropy).otherwise(found)


def find_secrets(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None, rule: EntropyRule = EntropyRule()) -> DataFrame:
    """The columns of `carry` (default: all) plus `base_spans` and `all_spans`, arrays of (start, rank, stop, value).

    Offsets count code points, ends are exclusive, `rank` indexes `KINDS`, and
    arrays are ordered by start, then rank. A null or empty text has no spans,
    an empty table gives no rows, rows that repeat are scanned each for
    itself. Texts may be long: time grows with their length, memory is some
    ten times it. Input columns are carried under their own names; only a
    clash with the two result names is an error.
    """
    carried = docs.columns if carry is None else carry
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    empty = F.array().cast("array<string>")
    for name, pattern, group in (("assign", ASSIGN, 1), ("access", ACCESS, 0), ("hex", HEX, 0), ("entropy", rule.candidate, 0)):
        parts = _located(F.col("t"), pattern, group)
        rows = rows.withColumn(f"{name}_hit", F.col("t").rlike(pattern))
        rows = rows.withColumns({f"{name}_{i}": F.when(F.col(f"{name}_hit"), part).otherwise(empty) for i, part in enumerate(parts)})
    always = lambda match, group: F.lit(True)
    rows = rows.withColumns({
        "assign": _spans(F.col("assign_0"), F.col("assign_1"), F.col("assign_2"), 0, lambda match, group: F.length(group) >= MIN_ASSIGN),
        "access": _spans(F.col("access_0"), F.col("access_1"), F.col("access_2"), 1, always),
        "hex": _spans(F.col("hex_0"), F.col("hex_1"), F.col("hex_2"), 2, always),
        "entropy": _spans(F.col("entropy_0"), F.col("entropy_1"), F.col("entropy_2"), 3, always),
    })
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    rows = rows.withColumn("fresh", F.filter(_not_covered(F.col("base"), F.col("entropy")), lambda span: _suspicious(span["value"], rule)))
    return rows.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)],
        F.col("base").alias("base_spans"),
        F.array_sort(F.concat("base", "fresh")).alias("all_spans"),
    )


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with every span replaced by `mark`; spans that overlap share one mark."""

    def step(at, span):
        kept = F.array(F.struct(at.alias("start"), span["start"].alias("stop"))).cast(EDGES)
        return F.greatest(at, span["stop"]), F.when(span["start"] >= at, kept).otherwise(F.array().cast(EDGES))

    def out(text):
        pieces = text["pieces"]

        def read(edges):
            first, last = F.floor(edges["start"] / PIECE).cast("int"), F.floor((edges["stop"] - 1) / PIECE).cast("int")
            part = lambda i: F.substring(F.get(pieces, i), F.greatest(edges["start"] - i * PIECE, F.lit(0)) + 1, edges["stop"] - F.greatest(edges["start"], i * PIECE))
            return F.when(edges["start"] < edges["stop"], F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))

        return F.array_join(F.transform(text["edges"], read), mark)

    end = F.struct(F.array_max(F.transform(spans, lambda s: s["stop"])).alias("start"), F.length(text).alias("stop"))
    edges = F.concat(_fold(spans, F.lit(0), EDGES, step), F.array(end).cast(EDGES))
    return F.when(F.size(spans) == 0, text).otherwise(_bound(F.struct(_pieces(text).alias("pieces"), edges.alias("edges")), out))
