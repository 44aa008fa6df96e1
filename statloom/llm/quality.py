"""Quality rules whose cutoffs follow the data.

Each text is measured once. Per language and source, a mergeable quantile sketch of every rate gives
its quartiles, and the cutoff lies a number of interquartile ranges beyond them, so a source is
judged by its own habits. Sketches are merged upwards: a group with too few texts takes the cutoffs
of its language, and a language with too few those of the whole corpus. A join brings the
cutoffs to the texts, whose rates are then filtered against them.

Defined results: a null text has no words and fails the base rule; a null language or source is a
group of its own; ties at a cutoff are kept; repeated rows are measured each; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import lean, settled
from statloom.llm.words import Words, blocks, mix

#: Items a sketch level holds: the rank error is about 1 / SKETCH_ITEMS, and below so many texts none.
SKETCH_ITEMS = 2048
MIN_GROUP = 200
#: Interquartile ranges between a quartile and its cutoff.
REACH = 8.0
#: Rates, with the least spread taken for each: a guard for rates that hardly vary in a group.
RATES = {"symbol_rate": 0.02, "dup_line_rate": 0.02, "repeat_rate": 0.02, "capital_rate": 0.002,
         "word_length": 0.05}
#: Rates that are 0 in most texts of any source: their quartiles are those of the texts where they are not.
WHERE_ANY = ("dup_line_rate", "repeat_rate")
#: Rates that may also be too low.
TWO_SIDED = ("word_length",)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[ord("A"):ord("Z") + 1] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_capitals")


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _salted(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mix(keys + mix(owner.astype(np.uint64)))


def measure_block(block) -> dict[str, np.ndarray]:
    """The counts of every text of a block."""
    data, starts, ends = block.data, block.starts, block.ends
    words = Words(block)
    n = len(words.begin)
    owner = np.repeat(np.arange(len(block)), words.counts)
    hashes = words.hashes()
    # Windows of three words inside one text.
    whole = np.flatnonzero(owner[2:] == owner[:-2]) if n > 2 else np.zeros(0, np.int64)
    window = mix(hashes[whole] + mix(hashes[whole + 1] + mix(hashes[whole + 2])))
    again = whole[_repeats(_salted(window, owner[whole]))[0]]
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[again + k] = True
    # Lines, cut at every newline and at the texts' ends.
    breaks = np.flatnonzero(data == 0x0A)
    filled = starts < ends
    line_start = np.sort(np.concatenate([starts[filled], breaks + 1]))
    line_start = line_start[line_start < len(data)] if len(line_start) else line_start
    line_start = np.unique(line_start)
    line_owner = np.searchsorted(ends, line_start, side="right")
    line_end = np.append(line_start[1:], len(data))
    line_end = line_end - (data[line_end - 1] == 0x0A)
    first_word = np.searchsorted(words.begin, line_start)
    full = np.searchsorted(words.begin, line_end) > first_word
    line_start, line_end, line_owner = line_start[full], line_end[full], line_owner[full]
    later = _repeats(_salted(words.ranges(line_start, line_end), line_owner))[1]
    return {
        "n_words": words.counts,
        "word_chars": _sums(words.inside & ((data & 0xC0) != 0x80), starts, ends),
        "n_symbols": _sums(_SYMBOL[data], starts, ends),
        "n_dup_lines": np.bincount(line_owner[later], minlength=len(block)),
        "n_repeat_words": _sums(covered, words.first[:-1], words.first[1:]),
        "n_lines": np.bincount(line_owner, minlength=len(block)),
        "n_capitals": _sums(_CAPITAL[data], starts, ends),
    }


def measure(docs: DataFrame, passed: list[str], text: str = "text") -> DataFrame:
    """The columns `passed` of each row, and the counts of its text."""
    sent = passed if text in passed else [*passed, text]
    place = sent.index(text)
    schema = docs.select(*passed)
    for name in COUNTS:
        schema = schema.withColumn(name, F.lit(0).cast("long"))
    names = schema.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(place)):
                counts = measure_block(block)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(block.first, len(block)) for c in batch.columns[:len(passed)]]
                    + [pa.array(counts[c], pa.int64()) for c in COUNTS], names=names)

    return docs.select(*sent).mapInArrow(lean(run), schema.schema)


def rates(measured: DataFrame) -> DataFrame:
    """The rates of texts with words; those of a text without are null."""
    per_word = lambda c: F.try_divide(F.col(c), F.col("n_words"))
    return measured.withColumns({
        "symbol_rate": per_word("n_symbols"),
        "dup_line_rate": F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_rate": per_word("n_repeat_words"),
        "capital_rate": F.try_divide(F.col("n_capitals"), F.col("word_chars")),
        "word_length": per_word("word_chars"),
    })


def _sketched(rate: str) -> Column:
    """The values whose quartiles count; null for those that do not."""
    return F.nullif(F.col(rate), F.lit(0.0)) if rate in WHERE_ANY else F.col(rate)


def cutoffs(rated: DataFrame, min_group: int = MIN_GROUP, reach: float = REACH) -> DataFrame:
    """For each (lang, source): <rate>_max, and <rate>_min where low values count too.

    Sketches are built per task and merged per group; only sketches are shuffled.
    """
    counted = [f"n_{r}" for r in WHERE_ANY]
    groups = rated.groupBy("lang", "source").agg(
        F.count(F.when(F.col("n_words") > 0, 1)).alias("n"),
        *(F.count(_sketched(r)).alias(f"n_{r}") for r in WHERE_ANY),
        *(F.kll_sketch_agg_double(_sketched(r), F.lit(SKETCH_ITEMS)).alias(r) for r in RATES))

    def merged() -> list[Column]:
        return [*(F.sum(n).alias(f"{n}_up") for n in ("n", *counted)), *(
            F.kll_merge_agg_double(r, F.lit(SKETCH_ITEMS)).alias(f"{r}_up") for r in RATES)]

    def filled(frame: DataFrame, up: str = "{}_up") -> DataFrame:
        own = F.col("n") >= min_group
        return frame.select("lang", "source", *(
            F.when(own, F.col(c)).otherwise(F.col(up.format(c))).alias(c) for c in ("n", *counted, *RATES)))

    by_language = groups.groupBy(F.col("lang").alias("lang_up")).agg(*merged())
    groups_filled = filled(groups.join(
        by_language, F.col("lang").eqNullSafe(F.col("lang_up")), "left"))
    corpus = groups.agg(F.struct(*merged()).alias("up")).scalar()
    everywhere = filled(groups_filled.withColumn("up", corpus), "up.{}_up")
    out = {}
    for rate, least in RATES.items():
        n = F.col(f"n_{rate}" if rate in WHERE_ANY else "n")
        quartile = lambda q, r=rate, n=n: F.when(
            n > 0, F.kll_sketch_get_quantile_double(F.col(r), F.lit(q)))
        low, high = quartile(0.25), quartile(0.75)
        if rate in WHERE_ANY:
            low, high = (F.when(F.col("n") > 0, F.coalesce(q, F.lit(0.0))) for q in (low, high))
        spread = F.greatest(high - low, F.lit(least))
        out[f"{rate}_max"] = high + reach * spread
        if rate in TWO_SIDED:
            out[f"{rate}_min"] = low - reach * spread
    return everywhere.select("lang", "source", *(c.alias(n) for n, c in out.items()))


def base_failed() -> Column:
    return ((F.col("n_words") < 50)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


#: Cutoffs of so many groups at most are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with their rates, base_failed and kept.

    `limits` are the cutoffs, which are counted before they are broadcast.
    """
    limits = settled(limits.withColumnsRenamed({"lang": "__lang", "source": "__source"}), "limits")
    few = limits.count() <= BROADCAST_GROUPS
    fine = F.lit(True)
    for rate in RATES:
        fine = fine & (F.col(rate) <= F.col(f"{rate}_max"))
        if rate in TWO_SIDED:
            fine = fine & (F.col(rate) >= F.col(f"{rate}_min"))
    same = (F.col("lang").eqNullSafe(F.col("__lang"))
            & F.col("source").eqNullSafe(F.col("__source")))
    return (
        rates(measured).join(F.broadcast(limits) if few else limits, same, "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", F.when(F.col("base_failed"), False)
                    .otherwise(F.coalesce(fine, F.lit(False))))
        .select(*measured.columns, *RATES, "base_failed", "kept")
    )


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for each row of doc_id, text, lang and source."""
    measured = settled(measure(docs, ["doc_id", "lang", "source"]), "measured")
    return judged(measured, cutoffs(rates(measured)))
