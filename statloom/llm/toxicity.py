"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words, lower-cased, their first bytes, and that a word occurs more
than once, hashed into a fixed number of slots. The score is a bias, a weight per term, and for each pair of terms the product of two short
vectors, so that an insult and whom it is aimed at count for more together than apart. Pairs are
never listed: their sum follows from the sum and the sum of squares of the vectors.

Slots get parameters if they tell something, alone or together, so common words add no noise: those whose
toxic share in the sample is SELECT standard deviations off, and those that move the share of a slot LIFT times as often
toxic as others by TOGETHER in the texts that hold both. So a word that is as good as neutral by itself, such as whom an insult is aimed at, gets its vector.

The machine learns from a bounded sample of labelled texts, about TRAIN_ROWS of them, chosen by a
hash of the id; all where there are no more. Shards of the sample are trained side by side, and
after every round their parameters are averaged, so only parameters pass through the driver.

Defined results: a null or empty text has no terms and the score of the bias; a text of many
labels is toxic if one of them says so; a null label is none; with nothing to learn from every score is
0; repeated rows are scored each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import held_out, lean, settled
from statloom.llm.words import Block, Words, blocks, mix

SLOT_BITS = 18
FACTORS = 8
TRAIN_ROWS = 20_000
SHARDS, ROUNDS, EPOCHS, BATCH = 4, 6, 5, 128
#: Step sizes and shrinkage of the bias and weights, and of the factors: what weights can explain is
#: not left to pairs.
RATE, FACTOR_RATE = 0.3, 0.05
DECAY, FACTOR_DECAY = 2e-5, 1e-3
SELECT, SELECT_ROWS = 4.0, 5
#: The same for pairs; there are far more of them, so chance must be ruled out more strictly.
TOGETHER, TOGETHER_ROWS, LIFT = 8.0, 20, 3
STEM_BYTES = 5
THRESHOLD = 0.3

_TERM = np.zeros(256, dtype=bool)
_TERM[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(0x80, 0x100)]] = True


def terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each text's distinct terms, and where each text's begin."""
    words = Words(block, lower=True, inside=_TERM)
    owner = np.repeat(np.arange(len(block), dtype=np.uint64), words.counts)
    long = words.end - words.begin > STEM_BYTES
    stem = mix(words.ranges(words.begin[long], words.begin[long] + STEM_BYTES) + np.uint64(1))
    hashes = np.concatenate([words.hashes(), stem])
    owner = np.concatenate([owner, owner[long]])
    slot = hashes >> np.uint64(64 - SLOT_BITS)
    both, times = np.unique((owner << np.uint64(SLOT_BITS)) | slot, return_counts=True)
    again = both[times > 1]
    slot = mix(again & np.uint64((1 << SLOT_BITS) - 1)) >> np.uint64(64 - SLOT_BITS)
    own = again >> np.uint64(SLOT_BITS) << np.uint64(SLOT_BITS)
    both = np.unique(np.concatenate([both, own | slot]))
    slots = (both & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int32)
    begins = np.searchsorted(both >> np.uint64(SLOT_BITS), np.arange(len(block) + 1))
    return slots, begins


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # by slot: the weight, then the factors

    @staticmethod
    def fresh(slots: np.ndarray) -> Machine:
        """Parameters for these slots; all others stay 0."""
        rng = np.random.Generator(np.random.PCG64(5))
        weights = np.zeros((1 << SLOT_BITS, 1 + FACTORS), dtype=np.float32)
        weights[slots, 1:] = rng.normal(0, 0.05, (len(slots), FACTORS))
        return Machine(0.0, weights)

    def margin(self, slots: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Log odds of each text."""
        out = np.full(len(begins) - 1, self.bias)
        filled = np.flatnonzero(begins[1:] > begins[:-1])
        if len(filled):
            own = self.weights[slots]
            at = begins[:-1][filled]
            sums = np.add.reduceat(own, at, axis=0)
            squares = np.add.reduceat(np.einsum("ij,ij->i", own[:, 1:], own[:, 1:]), at)
            pairs = 0.5 * (np.einsum("ij,ij->i", sums[:, 1:], sums[:, 1:]) - squares)
            out[filled] += sums[:, 0] + pairs
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(machine: Machine, lists: list[np.ndarray], labels: np.ndarray, epochs: int,
        seed: int) -> Machine:
    """AdaGrad on the logistic loss over a shard, in mini-batches of an order drawn from the seed."""
    weights = machine.weights.copy()
    used = weights.any(axis=1)
    lists = [own[used[own]] for own in lists]
    bias, bias_sum = machine.bias, 1.0
    sums_of_squares = np.full(weights.shape, 1.0, dtype=np.float32)
    rate = np.array([RATE] + [FACTOR_RATE] * FACTORS, dtype=np.float32)
    decay = BATCH * np.array([DECAY] + [FACTOR_DECAY] * FACTORS, dtype=np.float32)
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(epochs):
        order = rng.permutation(len(lists))
        for first in range(0, len(order), BATCH):
            every = order[first:first + BATCH]
            own = [i for i in every if len(lists[i])]
            bare = [i for i in every if not len(lists[i])]
            slope = float((_sigmoid(np.float64(bias)) - labels[bare]).sum())
            bias_sum += slope ** 2
            bias -= RATE * slope / np.sqrt(bias_sum)
            if not own:
                continue
            counts = np.array([len(lists[i]) for i in own])
            slots = np.concatenate([lists[i] for i in own])
            begins = np.concatenate([[0], np.cumsum(counts)])
            w = weights[slots]
            sums = np.add.reduceat(w, begins[:-1], axis=0)
            squares = np.add.reduceat((w[:, 1:] ** 2).sum(axis=1), begins[:-1])
            margin = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            slope = (_sigmoid(margin) - labels[own]).astype(np.float32)
            each = np.repeat(slope, counts)
            gradient = np.empty_like(w)
            gradient[:, 0] = each
            # A pair's part of a factor is the sum of the other terms' factors.
            gradient[:, 1:] = each[:, None] * (np.repeat(sums[:, 1:], counts, axis=0) - w[:, 1:])
            by_slot = np.argsort(slots, kind="stable")
            kept, at = np.unique(slots[by_slot], return_index=True)
            total = np.add.reduceat(gradient[by_slot], at, axis=0)
            np.clip(total, -10, 10, out=total)
            total += decay * weights[kept]
            sums_of_squares[kept] += total ** 2
            weights[kept] -= rate * total / np.sqrt(sums_of_squares[kept])
            bias_sum += float(slope.sum()) ** 2
            bias -= RATE * float(slope.sum()) / np.sqrt(bias_sum)
    return Machine(bias, weights)


def sample_of(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """label, shard and slots of about train_rows labelled documents that are not held out."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("of"))
             .agg(F.max("toxic").alias("label")).where(~held_out(F.col("of"))))
    total = known.count()
    draw = F.pmod(F.xxhash64("of", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(draw < min(1.0, train_rows / max(1, total)))
    # The sample is bounded by train_rows (a few more by chance), so it may be broadcast.
    texts = docs.select("doc_id", "text").join(
        F.broadcast(drawn), F.col("doc_id") == F.col("of")).select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                slots, begins = terms(block)
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.int32()), pa.ListArray.from_arrays(
                        pa.array(begins.astype(np.int32)), pa.array(slots))],
                    names=["doc_id", "label", "slots"])

    return texts.mapInArrow(lean(run), "doc_id long, label int, slots array<int>").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int"))


def selected(sample: DataFrame) -> np.ndarray:
    """Slots whose toxic share is off the sample's, and those off the share of one of these in the texts with both; at
    most as many as there are slots."""
    totals = sample.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    if not totals.n or totals.share in (0.0, 1.0):
        return np.zeros(0, dtype=np.int32)

    def off(share: Column) -> Column:
        return F.abs(F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))

    counts = F.count("*").alias("n"), F.sum("label").alias("toxic")
    counted = settled(sample.select("label", F.explode("slots").alias("slot")).groupBy("slot").agg(*counts)
                      .where(F.col("n") >= SELECT_ROWS), "counted")
    alone = counted.where(off(F.lit(totals.share)) >= SELECT).select("slot", "n", "toxic")
    # Slots that are toxic LIFT times as often as others, but not always, may be so for want of another. Few pass that screen
    # (there are 2^18 slots at most to broadcast), so a text has few pairs of one of these and another slot.
    lifted = (F.col("toxic") >= LIFT * F.col("n") * totals.share) & (F.col("toxic") < F.col("n"))
    open_ = F.broadcast(alone.where(lifted & (F.col("n") >= TOGETHER_ROWS)).select(
        "slot", (F.col("toxic") / F.col("n")).alias("share")))
    frequent = counted.where(F.col("n") >= TOGETHER_ROWS).select("slot").toArrow()["slot"].to_numpy()
    # Dealt by the screened slot, each text once for it, its pairs are counted where they are made.
    together = (
        _narrowed(sample, frequent).select("label", "slots", F.explode("slots").alias("slot"))
        .join(open_, "slot").repartition("slot")
        .select("slot", "share", "label", F.explode("slots").alias("other")).where(
            F.col("slot") != F.col("other")).groupBy("slot", "share", "other").agg(*counts)
        .where((F.col("n") >= TOGETHER_ROWS) & (off(F.col("share")) >= TOGETHER)))
    rows = alone.select("slot").union(together.select("other")).distinct().toArrow()
    return np.sort(rows["slot"].to_numpy())


def _narrowed(sample: DataFrame, slots: np.ndarray) -> DataFrame:
    """The sample with only these slots in its lists: the others have no parameters."""
    used = np.zeros(1 << SLOT_BITS, dtype=bool)
    used[slots] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
            keep = used[flat]
            upto = np.concatenate([[0], np.cumsum(keep)])[ends - ends[0]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(flat[keep])),
                 batch.column(3)], names=batch.schema.names)

    return sample.select("doc_id", "label", "slots", "shard").mapInArrow(
        lean(run), "doc_id long, label int, slots array<int>, shard int")


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Machine | None:
    """Rounds of training the shards side by side and averaging what each slot's shards learned."""
    sample = settled(sample_of(docs, labels, train_rows), "sample")
    context = docs.sparkSession.sparkContext
    slots = selected(sample)
    sample = settled(_narrowed(sample, slots), "narrowed")
    machine = Machine.fresh(slots)
    for turn in range(ROUNDS):
        shared = context.broadcast(machine)
        rows = sample.groupBy("shard").applyInArrow(
            _shard_round(shared, turn), "bias double, slots binary, change binary").collect()
        shared.unpersist()
        if not rows:
            return None
        change = np.zeros_like(machine.weights)
        times = np.zeros(len(change), dtype=np.float32)
        for row in rows:
            slots = np.frombuffer(row.slots, np.int32)
            change[slots] += np.frombuffer(row.change, np.float32).reshape(len(slots), -1)
            times[slots] += 1
        machine = Machine(machine.bias + sum(r.bias for r in rows) / len(rows),
                          machine.weights + change / np.maximum(times, 1)[:, None])
    return machine


def _shard_round(shared, turn: int):
    """Trains one shard from the shared machine; gives what changed, for the slots it has."""

    def run(table):
        table = table.sort_by("doc_id")
        column = table["slots"].combine_chunks()
        flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
        lists = [flat[a:b] for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0])]
        start = shared.value
        learned = fit(start, lists, table["label"].to_numpy().astype(np.float32), EPOCHS, turn)
        slots = np.unique(flat)
        change = (learned.weights - start.weights)[slots]
        return pa.table({"bias": pa.array([learned.bias - start.bias]),
                         "slots": pa.array([slots.tobytes()]),
                         "change": pa.array([change.tobytes()])})

    return run


def score(docs: DataFrame, machine: Machine | None, passed: list[str]) -> DataFrame:
    """The columns `passed`, and the probability that a text is toxic."""
    if machine is None:
        return docs.select(*passed, F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = docs.select(*passed, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for block in blocks(batch.column(len(passed))):
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(passed)],
                     pa.array(_sigmoid(known.margin(*terms(block))).astype(np.float64))],
                    names=schema.names)

    return docs.select(*passed, "text").mapInArrow(lean(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of doc_id and text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       held_out(F.col("doc_id")).alias("held_out"))
    machine = train(docs, labels)
    return score(docs, machine, ["doc_id", "held_out"]).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
