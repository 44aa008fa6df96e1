"""Information-theoretic sanitisation of personal data.

Entities are what fixed patterns find: e-mail and IP addresses, card and phone numbers. A term of a
text with an entity may give it away as well: what it tells about the entity is their pointwise mutual information,
estimated from co-occurrence over the whole corpus, and it tells all when that equals the entity's
information content. Terms beyond a share of it are disclosed: beyond REMOVE they are removed, beyond
GENERALISE replaced by a general word, wherever they occur in a text that holds the entity.

Counts are over documents: N, those with the term, those with the entity, those with both, however
far apart. Evidence is shrunk by how much there is of it: a share counts n / (n + SHRINK) of itself, n being the different
texts that hold both; copies of one text are one. So a pair seen once is never judged, one seen twice may be
generalised, one seen often counts in full. What entities share pools their evidence: the domain of an address, the
first three numbers of an IP, the first six digits of a card or phone number are protected as groups, at POOLED_SHRINK, as
groups are larger and meet a rare term by chance more easily.

Terms are runs of letters and digits, A-Z lower-cased; numbers are terms like others. Only those of one or two
letters a-z are left out. Entities that are in too few texts for any share to reach a threshold, and terms in too many
documents for their entity, are left out before pairs are made, which changes no result.

Defined results: a null text is empty and has no spans; spans are code points, end exclusive; ties of
start go by kind in the order of KINDS; repeated rows give the same result each; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import lean, settled
from statloom.llm.words import LOWER, Block, Words, blocks, mix

#: The kinds in order, and the patterns of the base.
KINDS = ("email", "ip", "card", "phone", "term", "generalised")
BASE = KINDS[:4]
_EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Shares of the entity's information.
REMOVE, GENERALISE = 0.95, 0.85
#: Texts of doubt: how far the evidence on an entity, and on a group of entities, is shrunk.
SHRINK, POOLED_SHRINK = 0.3, 0.9
GROUP_DIGITS = 6
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
               "term": "[REMOVED]", "generalised": "[DETAIL]"}

_TERM = np.zeros(256, dtype=bool)
_TERM[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(0x80, 0x100)]] = True
_TERM[ord("A"):ord("Z") + 1] = True
_A_TO_Z = np.zeros(256, dtype=bool)
_A_TO_Z[ord("a"):ord("z") + 1] = True

_SPAN = "start int, kind int, end int"
_FOUND = (f"doc_id long, text_key long, base array<struct<{_SPAN}>>, entities array<long>, "
          "pooled array<long>, text string")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Every match holds an @: the run before it, not reaching into the last match, is its start.
    last = 0
    for m in _EMAIL_END.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, in order."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(p) <= 3 and int(p or 0) <= 255
                       for p in (x.lstrip("0") for x in m.group().split(".")))]
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _term_words(block: Block) -> Words:
    return Words(block, lower=True, inside=_TERM)


def _usable(words: Words) -> np.ndarray:
    others = np.concatenate([[0], np.cumsum(~_A_TO_Z[words.data])])
    return (words.end - words.begin >= 3) | (others[words.end] > others[words.begin])


def group_of(kind: int, value: str) -> str:
    """What an entity shares with others of its kind."""
    if KINDS[kind] == "email":
        return value.rpartition("@")[2]
    if KINDS[kind] == "ip":
        return value.rpartition(".")[0]
    return re.sub("[^0-9]", "", value)[:GROUP_DIGITS]


def _entity_key(kind: int, value: str) -> int:
    raw = f"{kind}:{value.lower()}".encode()
    words = Words(Block(0, np.frombuffer(raw, np.uint8), np.array([len(raw)])))
    return int(words.ranges(np.array([0]), np.array([len(raw)])).view(np.int64)[0])


def told_spans(text: str, base: list[dict], told: list[dict]) -> list[dict]:
    """Spans of the told terms, at all their places in the text that touch no base span."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words = _term_words(Block(0, raw, np.array([len(raw)])))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    kinds = {t["term"]: t["kind"] for t in told}
    terms = words.hashes().view(np.int64)
    taken = np.zeros(len(text) + 1, dtype=np.int32)
    for span in base:
        taken[span["start"]] += 1
        taken[span["end"]] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
    out = []
    for i in np.flatnonzero(np.isin(terms, np.array(list(kinds), np.int64))):
        start, end = int(points[words.begin[i]]), int(points[words.end[i]])
        if covered[end] == covered[start]:
            out.append({"start": start, "kind": kinds[int(terms[i])], "end": end})
    return out


_HAS_DIGIT_OR_AT = np.zeros(256, dtype=bool)
_HAS_DIGIT_OR_AT[[*b"0123456789@"]] = True


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), base spans, and of rows that have some the entities, their groups
    and the text."""
    span = pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                part = batch.slice(block.first, len(block))
                hits = np.concatenate([[0], np.cumsum(_HAS_DIGIT_OR_AT[block.data])])
                maybe = hits[block.ends] > hits[block.starts]
                base, entities, pooled = ([[] for _ in range(len(block))] for _ in range(3))
                texts = [None] * len(block)
                for i in np.flatnonzero(maybe):
                    text = block.data[block.starts[i]:block.ends[i]].tobytes().decode()
                    if spans := base_spans(text):
                        base[i] = [{"start": s, "kind": k, "end": e} for s, k, e in spans]
                        entities[i] = list({_entity_key(k, text[s:e]) for s, k, e in spans})
                        pooled[i] = list({_entity_key(-1 - k, group_of(k, text[s:e])) for s, k, e in spans})
                        texts[i] = text
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(base, pa.list_(span)),
                     pa.array(entities, pa.list_(pa.int64())), pa.array(pooled, pa.list_(pa.int64())),
                     pa.array(texts, pa.string())],
                    names=["doc_id", "text_key", "base", "entities", "pooled", "text"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        lean(run), _FOUND)


def free_terms(texts: DataFrame) -> DataFrame:
    """text_key and each distinct term that has a place touching no base span, of text_key, base and
    text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            bases = batch.column(1).to_pylist()
            for block in blocks(batch.column(2)):
                words = _term_words(block)
                points = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                taken = np.zeros(points[-1] + 1, dtype=np.int32)
                for i in range(len(block)):
                    for span in bases[block.first + i]:
                        taken[points[block.starts[i]] + span["start"]] += 1
                        taken[points[block.starts[i]] + span["end"]] -= 1
                covered = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
                free = _usable(words) & (covered[points[words.end]] == covered[points[words.begin]])
                hashes = words.hashes()[free]
                owner = np.repeat(np.arange(len(block)), words.counts)[free]
                _, first = np.unique(hashes + mix(owner.astype(np.uint64)), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[block.first + owner[first]]),
                     pa.array(hashes[first].view(np.int64))], names=["text_key", "term"])

    return texts.select("text_key", "base", "text").mapInArrow(lean(run), "text_key long, term long")


def term_documents(docs: DataFrame) -> DataFrame:
    """term and n_term: in how many documents each term occurs. Summed per block before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for block in blocks(batch.column(0)):
                words = _term_words(block)
                usable = _usable(words)
                hashes = words.hashes()[usable]
                owner = np.repeat(np.arange(len(block), dtype=np.uint64), words.counts)[usable]
                _, first = np.unique(hashes + mix(owner), return_index=True)
                keys.append(hashes[first])
            if keys:
                term, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["term", "n"])

    return (docs.select("text").mapInArrow(lean(run), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n_term")))


def _least_texts(shrink: float) -> int:
    """So many texts at least hold a pair whose share, however large, can reach a threshold."""
    return math.ceil(shrink * GENERALISE / (1 - GENERALISE))


def disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """text_key, and told: term and kind (a number of KINDS) of what gives away an entity of the text, or its group."""
    holding = found.where(F.size("entities") > 0)
    # Counted per text first: a hot group of copies is one row from here on.
    named = [holding.select("text_key", F.explode(c).alias("entity"), F.lit(shrink).alias("shrink"))
             for c, shrink in (("entities", SHRINK), ("pooled", POOLED_SHRINK))]
    by_text = named[0].unionByName(named[1]).groupBy("entity", "shrink", "text_key").agg(
        F.count("*").alias("n"))
    least = F.when(F.col("shrink") == SHRINK, _least_texts(SHRINK)).otherwise(_least_texts(POOLED_SHRINK))
    total = docs.agg(F.count("*").alias("n")).first()["n"]
    several = (
        by_text.groupBy("entity", "shrink").agg(F.count("*").alias("texts"), F.sum("n").alias("n_entity"))
        .where((F.col("texts") >= least) & (F.col("n_entity") < total))
        # A share of GENERALISE needs a term in so many documents at most.
        .select("entity", "n_entity", (F.col("n_entity") * F.pow(
            F.lit(total) / F.col("n_entity"), F.lit(1 - GENERALISE + 1e-9))).alias("most")))
    often = settled(by_text.join(several, "entity"), "often")
    texts = holding.groupBy("text_key").agg(
        F.first("base").alias("base"), F.first("text").alias("text")).join(
        often.select("text_key").distinct(), "text_key", "left_semi")
    rare = free_terms(texts).join(
        term_documents(docs).where(F.col("n_term") >= _least_texts(SHRINK)), "term")
    share = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term"))) \
        / F.log2(total / F.col("n_entity")) * F.col("texts") / (F.col("texts") + F.col("shrink"))
    told = (
        rare.withColumnRenamed("text_key", "in_text")
        .join(often, (F.col("in_text") == F.col("text_key")) & (F.col("n_term") <= F.col("most")))
        .groupBy("entity", "shrink", "n_entity", "term", "n_term")
        .agg(F.sum("n").alias("n_both"), F.count("*").alias("texts"))
        .withColumn("share", share)
        .select("entity", "term",
                F.when(F.col("share") >= REMOVE, KINDS.index("term"))
                .when(F.col("share") >= GENERALISE, KINDS.index("generalised")).alias("kind"))
        .where("kind IS NOT NULL")
    )
    return (
        often.join(told, "entity")
        # A term that gives several entities away is removed if it must be for one of them.
        .groupBy("text_key", "term").agg(F.min("kind").alias("kind"))
        .groupBy("text_key").agg(F.collect_list(F.struct("term", "kind")).alias("told"))
    )


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and spans (both arrays of start, kind, end) for each row."""
    found = settled(find(docs), "found")
    joined = found.where(F.size("entities") > 0).join(disclosing(found, docs), "text_key", "left")
    span = pa.struct([(c, pa.int32()) for c in ("start", "kind", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, told = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            added = [told_spans(batch.column(3)[i].as_py(), base[i], t) if t else []
                     for i, t in enumerate(told)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(added, pa.list_(span))],
                names=["doc_id", "text_key", "base", "added"])

    marked = joined.select("doc_id", "text_key", "base", "text", "told").mapInArrow(
        lean(run), f"doc_id long, text_key long, base array<struct<{_SPAN}>>, "
             f"added array<struct<{_SPAN}>>")
    return marked.select(
        "doc_id", "text_key", "base", F.array_sort(F.concat("base", "added")).alias("spans")
    ).unionByName(found.where(F.size("entities") == 0).select(
        "doc_id", "text_key", "base", F.col("base").alias("spans")))


def written(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each base kind, the digest of the base spans, and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{k}": count(i) for i, k in enumerate(BASE)}
    return spans_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", *(c.alias(n) for n, c in counts.items()),
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"),
        written("spans").alias("spans"))


def redacted(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced; of overlapping spans one placeholder, the first's."""
    if not text or not spans:
        return text
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], PLACEHOLDER[KINDS[kind]]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def rewritten(joined: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` (with text and n_chars among them) of rows that also have spans, null for none."""
    place, size = columns.index("text"), columns.index("n_chars")
    picked = joined.select(*columns, "spans")
    schema = picked.drop("spans").withColumn("n_chars", F.col("n_chars").cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            counts = batch.column(size).cast(pa.int64()).to_pylist()
            for i, spans in enumerate(batch.column(len(columns)).to_pylist()):
                if spans:
                    texts[i] = redacted(texts[i], [(s["start"], s["kind"], s["end"]) for s in spans])
                    counts[i] = len(texts[i])
            out = list(batch.columns[:len(columns)])
            out[place] = pa.array(texts, pa.string())
            out[size] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return picked.mapInArrow(lean(run), schema)
