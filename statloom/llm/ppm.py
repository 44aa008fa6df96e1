"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts holds how often each byte followed them, up to ORDER
bytes back. A byte is coded in its longest context that the tree has; an escape, whose probability
is the share of distinct bytes seen there, leads to the next shorter one, without the bytes already
ruled out, and in the end to all 256 bytes alike. The tree is frozen after training, so a text's exact
code length under a language is a sum over its bytes, each of which depends on the ORDER bytes before
it alone. The language with the shortest code wins.

A frozen tree is laid out as the sorted runs of bytes that it has seen, with their counts, so it grows
with those alone and no language's tree knows of another's. Trees are laid out per language on the
executors. Whole texts are scored with array look-ups: a block's positions are reduced to the distinct
runs of ORDER + 1 bytes that end there, and each of those is coded once per language.

Trees learn from a bounded sample: TRAIN_BYTES of distinct text per language, all of it where there is
no more; at most an eighth of an octave and one text above that, so a language of a few long texts is
learned too. Contexts seen fewer than MIN_COUNT times are not kept.

Defined results: a null text, or one without a letter, is `und` with score 0; ties go to the
language that sorts first; a language is learned from rows whose lang is not null; with nothing to learn
from every row is `und`; repeated rows are scored each and learned from once; a very long text is scored
in pieces that see what is before them; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.tables import held_out, lean
from statloom.llm.words import blocks

ORDER = 3
TRAIN_BYTES = 4 << 20
MIN_COUNT = 2
UNKNOWN = "und"
#: Steps in which the sample of a language is widened, eight to the octave.
_STEPS = 320
_GRAMS = "lang string, length int, gram long, n long"
_TREE = "lang string, length int, grams binary, counts binary"


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """All runs of `length` bytes inside the texts, as numbers."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    for k in range(length):
        out = (out << 8) | data[k:n + k]
    inside = np.ones(n, dtype=bool)
    for end in ends:  # runs that begin less than `length` bytes before an end cross it
        inside[max(0, end - length + 1):end] = False
    return out[inside]


def count_grams(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, length, gram, n: how often each run of 1 to order + 1 bytes occurs in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy()
            for block in blocks(batch.column(1)):
                own = codes[block.first:block.first + len(block)]
                for code in np.unique(own):
                    mine = np.flatnonzero(own == code)
                    data = np.concatenate([block.data[block.starts[i]:block.ends[i]] for i in mine])
                    ends = np.cumsum(block.ends[mine] - block.starts[mine])
                    name = langs.dictionary[int(code)].as_py()
                    for length in range(1, order + 2):
                        gram, n = np.unique(_grams(data, ends, ends, length), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(gram), pa.string()),
                             pa.array(np.full(len(gram), length, np.int32)), pa.array(gram),
                             pa.array(n.astype(np.int64))], names=["lang", "length", "gram", "n"])

    return (sample.select("lang", "text").mapInArrow(lean(run), _GRAMS)
            .groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")))


def sample_of(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """The distinct texts of smallest hash of each language, until they hold train_bytes."""
    usable = docs.where("lang IS NOT NULL AND text != ''").select("lang", "text")
    draw = (F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 40)) + 1) / float(1 << 40)
    step = F.least(F.floor(-8 * F.log2(draw)), F.lit(_STEPS))  # higher: smaller hash
    by_step = (
        usable.groupBy("lang", F.xxhash64("text"), step.alias("step"))
        .agg(F.max(F.octet_length("text")).alias("n"))
        .groupBy("lang", "step").agg(F.sum("n").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("step")))
    # A row per language reaches the driver.
    chosen = (by_step.withColumn("upto", upto).where(F.col("upto") - F.col("n") < train_bytes)
              .groupBy("lang").agg(F.min("step").alias("step")).collect())
    if not chosen:
        return usable
    lowest = F.create_map(*(F.lit(x) for r in chosen for x in (r.lang, r.step)))
    return usable.where(step >= lowest[F.col("lang")]).dropDuplicates(["lang", "text"])


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted `known`, and whether the wanted values are there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


class Tree:
    """A language's frozen tree.

    `runs[k]` holds the seen runs of k + 1 bytes in order, `counts[k]` how often. Of each context of k
    bytes: `total` of its counts, `distinct` bytes after it, and `above`, the counts that these bytes
    have after the next shorter context.
    """

    def __init__(self, runs: list[np.ndarray], counts: list[np.ndarray]):
        self.runs, self.counts = runs, counts
        self.contexts, self.total, self.distinct, self.above = [], [], [], []
        for k, (run, n) in enumerate(zip(runs, counts)):
            context, first = np.unique(run >> 8, return_index=True)
            shorter = np.zeros(len(run))
            if k:
                at, has = _find(runs[k - 1], run & ((1 << 8 * k) - 1))
                shorter[has] = counts[k - 1][at[has]]
            add = (lambda x: np.add.reduceat(x, first)) if len(run) else (lambda x: x[:0])
            self.contexts.append(context)
            self.total.append(add(n.astype(float)))
            self.distinct.append(np.diff(np.append(first, len(run))).astype(float))
            self.above.append(add(shorter))

    def bits(self, runs: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each run, of which `back` bytes before it count."""
        out = np.zeros(len(runs))
        left = np.arange(len(runs))  # not coded yet
        spent, ruled, passed = (np.zeros(len(runs)) for _ in range(3))
        for k in range(len(self.runs) - 1, -1, -1):
            at, has = _find(self.contexts[k], (runs >> 8) & ((1 << 8 * k) - 1))
            has &= back >= k
            at, known = at[has], np.flatnonzero(has)
            # Bytes seen after a longer context are ruled out here, with their counts.
            fresh = self.distinct[k][at] - ruled[known]
            total = self.total[k][at] - passed[known] + fresh
            place, seen = _find(self.runs[k], runs[known] & ((1 << 8 * (k + 1)) - 1))
            done = known[seen]
            out[left[done]] = spent[done] + np.log2(total[seen]) - np.log2(self.counts[k][place[seen]])
            escapes = ~seen & (fresh > 0)
            spent[known[escapes]] += np.log2(total[escapes]) - np.log2(fresh[escapes])
            ruled[known], passed[known] = self.distinct[k][at], self.above[k][at]
            stay = np.ones(len(runs), dtype=bool)
            stay[done] = False
            runs, back, left = runs[stay], back[stay], left[stay]
            spent, ruled, passed = spent[stay], ruled[stay], passed[stay]
        out[left] = spent + np.log2(np.maximum(256 - ruled, 1))
        return out


@dataclass
class Model:
    langs: list[str]
    trees: list[Tree]
    order: int


def _laid_out(length: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int,
              min_count: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for own in range(1, order + 2):
        mine = np.flatnonzero((length == own) & ((n >= min_count) | (own == 1)))
        mine = mine[np.argsort(gram[mine])]
        yield own, gram[mine], n[mine]


def build(grams: list[tuple[str, int, int, int]], order: int = ORDER,
          min_count: int = MIN_COUNT) -> Model | None:
    """The model for counted runs (lang, length, gram, n)."""
    langs = sorted({g[0] for g in grams})
    trees = []
    for lang in langs:
        own = np.array([g[1:] for g in grams if g[0] == lang], dtype=np.int64)
        tables = list(_laid_out(*own.T, order, min_count))
        trees.append(Tree([t[1] for t in tables], [t[2] for t in tables]))
    return Model(langs, trees, order) if langs else None


def _runs(data: np.ndarray, starts: np.ndarray, at: int, count: int,
          order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of `count` bytes from `at` the run of up to order + 1 bytes that ends there, in its
    text, and the number of bytes before it."""
    back = np.full(count, order, dtype=np.int64)
    near = starts[(starts > at - order) & (starts < at + count)]
    for j in range(order - 1, -1, -1):  # the nearest start counts
        hit = near + j - at
        back[hit[(hit >= 0) & (hit < count)]] = j
    runs = data[at:at + count].astype(np.int64)
    for k in range(1, order + 1):
        skip = max(0, k - at)
        before = data[at + skip - k:at + count - k].astype(np.int64) << (8 * k)
        runs[skip:] |= np.where(back[skip:] >= k, before, 0)
    return runs, back


def code_lengths(model: Model, data: np.ndarray, ends: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Bits of each text of a block (ended at `ends`) under each language."""
    width = 8 * (model.order + 1)
    total = np.zeros((len(ends), len(model.langs)))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    for at in range(0, len(data), piece):
        count = min(piece, len(data) - at)
        first = int(np.searchsorted(ends, at, side="right"))
        last = int(np.searchsorted(starts, at + count, side="left"))
        own = np.arange(first, last)
        own = own[starts[own] < ends[own]]
        runs, back = _runs(data, starts, at, count, model.order)
        coded = pa.array(runs | (back << width)).dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        begin = np.maximum(starts[own] - at, 0)
        for i, tree in enumerate(model.trees):
            bits = tree.bits(distinct & ((1 << width) - 1), distinct >> width)
            total[own, i] += np.add.reduceat(bits[which], begin)
    return total


def train(docs: DataFrame, order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """Trees from docs' text and lang. What reaches the driver are the trees laid out: for each
    language the runs seen in its sample."""
    names = [c.split()[0] for c in _TREE.split(", ")]

    def lay_out(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_numpy() for c in ("length", "gram", "n"))
        rows = [(table.column("lang")[0].as_py(), own, run.astype("<i8").tobytes(),
                 n.astype("<i8").tobytes()) for own, run, n in _laid_out(*columns, order, MIN_COUNT)]
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    counted = count_grams(sample_of(docs, train_bytes), order)
    counted = counted.where((F.col("length") == 1) | (F.col("n") >= MIN_COUNT))
    trees: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for r in counted.groupBy("lang").applyInArrow(lay_out, _TREE).orderBy("lang", "length").collect():
        trees.setdefault(r.lang, []).append(
            (np.frombuffer(r.grams, "<i8"), np.frombuffer(r.counts, "<i8")))
    langs = sorted(trees)
    if not langs:
        return None
    return Model(langs, [Tree(*map(list, zip(*trees[lang]))) for lang in langs], order)


def predict(docs: DataFrame, model: Model | None, passed: list[str]) -> DataFrame:
    """The columns `passed`, lang_pred, and score: how the winner's code compares with the others',
    as a probability under equal priors."""
    worded = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*passed, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(*passed, "text", worded.alias("worded"))
    schema = docs.select(*passed, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for block in blocks(batch.column(len(passed))):
                part = batch.slice(block.first, len(block))
                bits = code_lengths(known, block.data, block.ends)
                best = bits.argmin(axis=1)
                gap = np.clip(bits - bits.min(axis=1, keepdims=True), 0, 1000)
                score = 1 / np.exp2(-gap).sum(axis=1)
                has = part.column(len(passed) + 1).to_numpy(zero_copy_only=False).astype(bool)
                best[~has], score[~has] = len(known.langs), 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(passed)], pa.array(names[best], pa.string()),
                     pa.array(score)], names=schema.names)

    return picked.mapInArrow(lean(run), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of doc_id, text and lang."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       held_out(F.col("doc_id")).alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return predict(docs, model, ["doc_id", "held_out"])
