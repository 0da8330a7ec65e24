"""Benchmark decontamination: a BM25 index of the test items, queried by every passage.

Items are indexed in blocks; per term a block keeps the largest weight of its items. A passage
(a window of words) asks the index for every item whose BM25 score reaches a share of the
item's score for its own text. As in block-max WAND, a block is only looked into when the sum
of its largest weights over the passage's terms reaches the threshold; passages of a batch are
bounded and scored together. What is retrieved is verified: the passage must hold the item's
question in runs of five words and its answer's words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.hashing import PUNCTUATION, row_of, shingle_hashes, slices, utf8, word_hashes

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach, and of its question and answer it must hold.
RETRIEVE, OVERLAP = 0.6, 0.8
SHINGLE = 5
#: Items per block, and per index that is broadcast; further items make further indexes.
BLOCK, SHARD = 16, 2048

_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*utf8(pa.array(texts, pa.string())), PUNCTUATION)


def question_and_answer(text: str | None) -> tuple[str, str]:
    """The last sentence with a word is the answer, what stands before it the question.

    A question of fewer words than a run is extended to the whole text.
    """
    parts = [p for p in _SENTENCE.split(text or "") if len(hashed([p])[0])]
    question = " ".join(parts[:-1])
    return (question if len(hashed([question])[0]) >= SHINGLE else text or ""), (parts[-1] if parts else "")


@dataclass
class Index:
    """A shard of the items: sorted terms, block maxima, weights scaled to a threshold of 1."""

    items: np.ndarray
    terms: np.ndarray
    maxima: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray]]
    questions: list[tuple[bool, np.ndarray]]
    answers: list[np.ndarray]
    stride: int

    @staticmethod
    def build(items: list[tuple[int, str]], idf: dict[int, float], mean: float) -> Index:
        texts = [t for _, t in items]
        words, bounds = hashed(texts)
        sizes, owner = np.diff(bounds), row_of(bounds)
        terms, place = np.unique(words, return_inverse=True)
        tf = np.zeros((len(items), len(terms)), np.float32)
        np.add.at(tf, (owner, place), 1)
        rare = np.array([idf[int(t)] for t in terms.view(np.int64)], np.float32)
        weight = rare * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[:, None] / mean) + 1e-9)
        weight /= RETRIEVE * weight.sum(axis=1, keepdims=True)
        blocks, maxima = [], []
        for at in range(0, len(items), BLOCK):
            part = weight[at:at + BLOCK]
            local = np.full(len(terms), -1, np.int32)
            used = np.flatnonzero(part.any(axis=0))
            local[used] = np.arange(len(used))
            blocks.append((local, np.ascontiguousarray(part[:, used].T)))
            maxima.append(part.max(axis=0))
        parts = [question_and_answer(t) for t in texts]
        questions = []
        for question, _ in parts:
            own = hashed([question])
            short = len(own[0]) < SHINGLE  # compared word by word
            questions.append((short, np.unique(own[0] if short else shingle_hashes(*own, SHINGLE)[0])))
        a, ab = hashed([p[1] for p in parts])
        return Index(np.array([i for i, _ in items]), terms, np.ascontiguousarray(np.array(maxima, np.float32).T), blocks, questions,
                     [np.unique(a[x:y]) for x, y in zip(ab, ab[1:])], int(np.ceil(max(32, sizes.max()) / OVERLAP)))

    def retrieve(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (row, first word of the passage, item number) at or above the threshold.

        Passages are two strides wide and begin at every stride, so that an item of at most a
        stride lies whole in one of them. A stride is longer than the longest item by the share
        that OVERLAP leaves, for copies with words inserted.
        """
        none = np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[place] == words)
        if not len(known):
            return none, none, none
        counts = np.diff(bounds)
        first_cell = np.concatenate([[0], np.cumsum(-(-counts // self.stride))])
        row = np.searchsorted(bounds, known, side="right") - 1
        cell = first_cell[row] + (known - bounds[row]) // self.stride
        v = len(self.terms)
        keys = np.unique(cell * v + place[known])
        cells, terms = keys // v, keys % v
        used, starts = np.unique(cells, return_index=True)
        sums = np.zeros((first_cell[-1] + 1, len(self.blocks)), np.float32)
        for at in range(0, len(used), 4096):  # bounds the gathered rows
            a, b = starts[at], starts[at + 4096] if at + 4096 < len(used) else len(terms)
            sums[used[at:at + 4096]] = np.add.reduceat(self.maxima[terms[a:b]], starts[at:at + 4096] - a, axis=0)
        follows = np.ones(first_cell[-1], bool)
        follows[first_cell[1:][counts > 0] - 1] = False
        bound = sums[:-1] + np.where(follows[:, None], sums[1:], 0)
        windows, hit = np.nonzero(bound >= 1 - 1e-4)
        cell_start = np.searchsorted(cells, np.arange(first_cell[-1] + 2))
        out = []
        for block in np.unique(hit):
            local, weights = self.blocks[block]
            mine = windows[hit == block]
            lo, hi = cell_start[mine], cell_start[mine + 1 + follows[mine]]
            owner = np.repeat(np.arange(len(mine)), hi - lo)
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
            term = local[terms[at]]
            owner, term = owner[term >= 0], term[term >= 0]
            pairs = np.unique(owner * np.int64(len(weights)) + term)
            owner, term = pairs // len(weights), pairs % len(weights)
            seen, begin = np.unique(owner, return_index=True)
            window, item = np.nonzero(np.add.reduceat(weights[term], begin, axis=0) >= 1 - 1e-4)
            out.append((mine[seen[window]], block * BLOCK + item))
        if not out:
            return none, none, none
        window, item = map(np.concatenate, zip(*out))
        row = np.searchsorted(first_cell, window, side="right") - 1
        return row, (window - first_cell[row]) * self.stride, item

    def verified(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, float]]:
        """(row, item id, question and answer overlap) of retrieved passages, the best of each."""
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for row, at, item in zip(*(x.tolist() for x in self.retrieve(words, bounds))):
            passage = words[bounds[row] + at:min(bounds[row] + at + 2 * self.stride, bounds[row + 1])]
            whole, q = self.questions[item]
            held = passage if whole else shingle_hashes(passage, np.array([0, len(passage)]), SHINGLE)[0]
            found = (float(np.isin(q, held).mean()), float(np.isin(self.answers[item], passage).mean()))
            key = (row, int(self.items[item]))
            if found[0] >= OVERLAP and found[1] >= OVERLAP and found > best.get(key, (0.0, 0.0)):
                best[key] = found
        return [(*k, *v) for k, v in sorted(best.items())]


def _indexes(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """One index per shard of at most about SHARD items; idf and mean length are over all items."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                words, bounds = word_hashes(*utf8(rows.column(text_col)), PUNCTUATION)
                lists = [np.unique(words[a:b]).view(np.int64) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([rows.column(id_col).cast(pa.int64()), rows.column(text_col), pa.array(np.diff(bounds), pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["id", "text", "n", "terms"])

    items = benchmark.select(id_col, text_col).mapInArrow(terms, "id long, text string, n long, terms array<long>").where("n > 0 AND id IS NOT NULL")
    total, mean = items.agg(F.count(F.lit(1)), F.avg("n")).first()
    shards = -(-total // SHARD)
    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(max(shards, 1))))
    df = items.select("shard", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.collect_set("shard").alias("shards"))
    for shard in range(shards):
        part = [(r["id"], r["text"]) for r in items.where(F.col("shard") == shard).select("id", "text").distinct().orderBy("id", "text").collect()]
        if not part:
            continue
        idf = {r["term"]: float(np.log1p((total - r["df"] + 0.5) / (r["df"] + 0.5))) for r in df.where(F.array_contains("shards", F.lit(shard).cast("long"))).select("term", "df").collect()}
        yield Index.build(part, idf, mean)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, question_overlap, answer_overlap``: a row per document and item it holds.

    All windows of whole texts are queries. Null and empty texts or items, and items with a null
    id, hold and are held by nothing; repeated rows of ``docs`` repeat their rows; of items with
    one id the best match counts. A benchmark without items gives an empty result.
    """
    out = None
    for index in _indexes(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by SHARD items

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, text_col):
                    found = shared.value.verified(*word_hashes(*utf8(rows.column(text_col)), PUNCTUATION))
                    row, item, q, a = zip(*found) if found else ((), (), (), ())
                    yield pa.RecordBatch.from_arrays([rows.column(id_col).cast(pa.int64()).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(q, pa.float64()), pa.array(a, pa.float64())], ["doc_id", "item_id", "question_overlap", "answer_overlap"])

        part = docs.select(id_col, text_col).mapInArrow(run, "doc_id long, item_id long, question_overlap double, answer_overlap double")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, question_overlap double, answer_overlap double")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item, each judged by its own text; so are rows without id."""
    schema = docs.schema
    for index in _indexes(benchmark, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by SHARD items

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in slices(batch, text_col):
                    keep = np.ones(rows.num_rows, bool)
                    keep[[row for row, *_ in shared.value.verified(*word_hashes(*utf8(rows.column(text_col)), PUNCTUATION))]] = False
                    yield rows.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
