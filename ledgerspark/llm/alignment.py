"""Two tokenizations of the same text, aligned by byte ranges and counted over the corpus.

Interval coalescing: the tokens of both sides are sorted by start, the ends are accumulated by
their maximum, and a group breaks wherever a start reaches the running maximum; inside the groups
every A token is expanded to the B tokens whose byte ranges overlap its own.

Both vocabularies break before a blank or a line feed that follows neither, so a text's tokens
are those of its units (a word with the blank or line feed before it) one after the other, and so
are its groups. Units repeat, texts hardly do: each worker aligns a unit once and keeps it. Texts
where the cut could matter (other white space, runs of blanks, characters that a side changes)
are aligned whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm.hashing import slices
from ledgerspark.session import short_batches, written

#: Units kept per Python worker and pair of vocabularies; when they are full, those met again stay.
CACHE = 240_000
#: Bytes of text per chunk: the documents whose id pairs are counted and marked together. They
#: are aligned in steps, which bounds what a worker holds at a time.
CHUNK = 1 << 22
STEP = 1 << 20
#: Rows of chunks are megabytes, and Parquet's reader holds the lists of a whole row group: each of about
#: ``GROUP`` bytes, which is looked at after every row.
GROUP = 1 << 20
#: The mark of a blank inside the pieces of side B (fixed value).
BLANK = "▁"
SHIFT = 32

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
CHUNKS = (
    "chunk long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in _COUNTS)
    + ", groups_sha256 array<string>, distinct array<int>, at array<int>, times array<long>, pairs array<long>, held array<long>"
)
DIGEST = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", n_best long, count_sum long, groups_sha256 string"
ALIGNED = "doc_id long, groups string, links array<struct<a:int,b:int>>"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for, by its public rule:
    printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _starts(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token.

    Each side's tokens follow each other without gaps from byte 0 on to the same last byte;
    several texts may stand in a row.
    """
    starts = np.concatenate([[0], ends_a[:-1], [0], ends_b[:-1]]) if len(ends_a) else np.zeros(0, np.int64)
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(np.concatenate([ends_a, ends_b])[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[:len(ends_a)], group[len(ends_a):]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all token pairs whose byte ranges overlap."""
    starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    if not len(ends_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.searchsorted(ends_b, starts_a, side="right")
    many = np.searchsorted(starts_b, ends_a, side="left") - first
    at = _starts(many)
    return np.repeat(np.arange(len(ends_a)), many), np.arange(at[-1]) + np.repeat(first - at[:-1], many)


def _expand(bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all elements of the lists ``which`` in a flat array, and each list's length."""
    many = bounds[which + 1] - bounds[which]
    at = _starts(many)
    return np.arange(at[-1]) + np.repeat(bounds[which] - at[:-1], many), many


def _spans(sizes: np.ndarray, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row, and the number of ids and of bytes of each list."""
    many = np.array([len(i) for i in ids], np.int64)
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum()))
    return flat, many, np.diff(_starts(sizes[flat])[_starts(many)])


class Batch:
    """What ``Aligner.align`` found for a run of texts."""

    def __init__(self, counts: np.ndarray, groups: list[str], bounds: np.ndarray, pairs: np.ndarray, times: np.ndarray):
        self.counts, self.groups, self.bounds, self.pairs, self.times = counts, groups, bounds, pairs, times


class Aligner:
    def __init__(self, path_a: str, path_b: str, most: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.blank = self.b.piece_to_id(BLANK)
        #: No piece goes on over a blank or a line feed, so units are encoded as in their text.
        self.cuts = not any("\n" in p or BLANK in p.lstrip(BLANK) for p in pieces)
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)
        self.fits = np.zeros(0, bool)
        self.met = np.zeros(0, bool)  # found again after the texts that brought it
        self.bounds = np.zeros(1, np.int64)
        self.pairs = self.times = np.zeros(0, np.int64)

    def _keep_met(self, most: int) -> None:
        """Drops the units that were not found again; all, if others are more than ``most``."""
        kept = np.flatnonzero(self.met)
        if len(kept) > most:
            self._forget()
            return
        place, many = _expand(self.bounds, kept)
        number = np.cumsum(self.met) - 1
        self.known = {u: int(number[k]) for u, k in self.known.items() if self.met[k]}
        self.groups = [self.groups[k] for k in kept.tolist()]
        self.counts, self.fits, self.bounds = self.counts[kept], self.fits[kept], _starts(many)
        self.pairs, self.times = self.pairs[place], self.times[place]
        self.met = np.zeros(len(kept), bool)

    def _units(self, text: str) -> list[str] | None:
        """The units of a text, or None if it must be aligned whole."""
        if not self.cuts or "  " in text or "\n " in text or " \n" in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n":
            return None
        if not text.replace("\n", "").isprintable():
            return None
        return text.replace("\n", " \n").split(" ")

    def _add(self, units: list[str], whole: bool) -> None:
        """Aligns units (words, without their blank) or whole texts and keeps what came out."""
        full = [u if u[0] == "\n" and not whole else " " + u for u in units]
        ids_a = [e.ids for e in self.a.encode_batch_fast(full, add_special_tokens=False)]
        ids_b = self.b.encode(units, num_threads=1)
        for k, (text, b) in enumerate(zip(full, ids_b)):
            if text[0] == "\n" and b[:1] == [self.blank]:  # the blank that B puts in front of any text
                ids_b[k] = b[1:]
        raw = [t.encode() for t in full]
        sides = ((self.bytes_a, self.sizes_a, ids_a), (self.bytes_b, self.sizes_b, ids_b))
        lengths = np.array([len(r) for r in raw], np.int64)
        fits = np.all([_spans(sizes, ids)[2] == lengths for _, sizes, ids in sides], axis=0)
        if not all(b"".join(map(table.__getitem__, chain.from_iterable(ids))) == b"".join(raw) for table, _, ids in sides):
            fits = np.array([all(b"".join(map(table.__getitem__, ids[k])) == r for table, _, ids in sides) for k, r in enumerate(raw)], bool)
        for k in np.flatnonzero(~fits).tolist():
            ids_a[k], ids_b[k] = [], []
        (a, n_a, _), (b, n_b, _) = (_spans(sizes, ids) for _, sizes, ids in sides)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        group_a, group_b = coalesce(ends_a, ends_b)
        link_a, link_b = overlaps(ends_a, ends_b)
        at_a, at_b = _starts(n_a), _starts(n_b)
        links = np.searchsorted(link_a, at_a)
        first = np.append(group_a, group_a[-1] + 1 if len(group_a) else 0)[at_a]
        self._texts(a.tolist(), b.tolist(), group_a, group_b, first)
        unit = np.repeat(np.arange(len(units)), np.diff(links))
        bounds, pairs, times = _counted(unit, (a[link_a] << SHIFT) | b[link_b], np.ones(len(link_a), np.int64), len(units))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, np.diff(first), np.diff(links)], axis=1)])
        self.fits = np.append(self.fits, fits)
        self.met = np.append(self.met, np.zeros(len(fits), bool))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])

    def _texts(self, a: list[int], b: list[int], group_a: np.ndarray, group_b: np.ndarray, first: np.ndarray) -> None:
        """The groups of each unit as text; ``first``: each unit's first group, then their number."""
        cut_a, cut_b = (np.searchsorted(g, np.arange(first[-1] + 1)).tolist() for g in (group_a, group_b))
        a, b = list(map(str, a)), list(map(str, b))
        groups = [f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        at = first.tolist()
        self.groups += [";".join(groups[i:j]) for i, j in zip(at, at[1:])]

    def align(self, texts: list[str | None]) -> Batch:
        """Counts, groups as text, and the distinct id pairs of each text with their numbers."""
        cut = [self._units(t) if t else [] for t in texts]
        wanted = set().union(*[u for u in cut if u])
        new = wanted.difference(self.known)
        before = len(self.groups)
        if new:
            if len(self.known) + len(new) > self.most:
                self._keep_met(self.most // 2)
                new = wanted.difference(self.known)
            before = len(self.groups)
            new = list(new)
            self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
            self._add(new, whole=False)
        kept = len(self.groups), len(self.pairs)
        get = self.known.__getitem__
        places = [None if u is None else np.fromiter(map(get, u), np.int64, len(u)) for u in cut]
        whole = [i for i, p in enumerate(places) if p is None or not self.fits[p].all()]
        if whole:
            for n, i in enumerate(whole):
                places[i] = np.array([kept[0] + n])
            self._add([texts[i] for i in whole], whole=True)
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        at = at.astype(np.int64)
        self.met[at[at < before]] = True
        of = np.repeat(np.arange(len(texts)), [len(p) for p in places])
        counts = np.stack([np.bincount(of, self.counts[at, k], len(texts)) for k in range(4)], axis=1).astype(np.int64)
        key, many = np.unique(of * (len(self.groups) + 1) + at, return_counts=True)
        unit = key % (len(self.groups) + 1)
        place, length = _expand(self.bounds, unit)
        bounds, pairs, times = _counted(np.repeat(key // (len(self.groups) + 1), length), self.pairs[place], self.times[place] * np.repeat(many, length), len(texts))
        text = self.groups
        groups = [";".join([text[k] for k in p.tolist()]) for p in places]
        if whole:
            del self.groups[kept[0]:]
            self.counts, self.fits, self.met, self.bounds = self.counts[:kept[0]], self.fits[:kept[0]], self.met[:kept[0]], self.bounds[:kept[0] + 1]
            self.pairs, self.times = self.pairs[:kept[1]], self.times[:kept[1]]
        return Batch(counts, groups, bounds, pairs, times)


def _counted(of: np.ndarray, pairs: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of each of ``n`` owners in ascending order, and their summed numbers."""
    known, code = np.unique(pairs, return_inverse=True)
    key = of * (len(known) + 1) + code
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = _starts(times[order])
    sums = total[np.append(head[1:], len(key))] - total[head] if len(key) else np.zeros(0, np.int64)
    owner, code = key[head] // (len(known) + 1), key[head] % (len(known) + 1)
    return np.searchsorted(owner, np.arange(n + 1)), known[code] if len(known) else code, sums


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker, kept between tasks."""
    return Aligner(path_a, path_b)


def _selected(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups and distinct linked id pairs of every whole text.

    A text that is null or empty, or that a side does not give back byte for byte, has no
    tokens: its groups are empty text and it has no links. Repeated rows and rows of one id are
    documents of their own, a null id stays null, other columns are not looked at, and a text
    of any length is aligned as one row. An empty table gives an empty table.
    """
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            for rows in slices(batch, "text", STEP):
                found = both.align(rows.column("text").to_pylist())
                links = pa.StructArray.from_arrays([pa.array(found.pairs >> SHIFT, pa.int32()), pa.array(found.pairs & ((1 << SHIFT) - 1), pa.int32())], ["a", "b"])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found.groups, pa.string()), pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), links)], ["doc_id", "groups", "links"])

    return _selected(docs, id_col, text_col).mapInArrow(align, ALIGNED)


def _one(values, kind: pa.DataType) -> pa.Array:
    """A list column with a single row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def chunks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk of documents: their counts, and their id pairs.

    ``pairs`` are the chunk's distinct id pairs in ascending order and ``held`` how many of its
    documents hold each; a document's own pairs are places in that list, with their numbers.
    """
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, chunk = aligner(path_a, path_b), TaskContext.get().partitionId() << 33
        long = pa.int64()
        for batch in batches:
            for rows in slices(batch, "text", CHUNK):
                counts, sizes, links, times, shas = [], [], [], [], []
                for step in slices(rows, "text", STEP):
                    found = both.align(step.column("text").to_pylist())
                    counts.append(found.counts)
                    sizes.append(np.diff(found.bounds))
                    links.append(found.pairs)
                    times.append(found.times)
                    shas += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                counts, sizes, links, times = map(np.concatenate, (counts, sizes, links, times))
                pairs, at = np.unique(links, return_inverse=True)
                columns = [pa.array([chunk], long), pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("doc_id"))]
                columns += [_one(counts[:, k], long) for k in range(4)]
                columns += [_one(shas, pa.string()), _one(sizes, pa.int32()), _one(at, pa.int32()), _one(times, long), _one(pairs, long), _one(np.bincount(at, minlength=len(pairs)), long)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CHUNKS.split(", ")])
                chunk += 1

    return _selected(docs, id_col, text_col).mapInArrow(align, CHUNKS)


def pair_counts(parts: DataFrame) -> DataFrame:
    """``pair, n, best``: how many documents hold an id pair linked, and whether no pair of the
    same A id is held by more. A window has at most one row per id of vocabulary B."""
    counts = parts.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def alignment_digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sizes of every document's alignment, its links against the corpus, a digest of its groups.

    Rows as in ``aligned``. A pair goes once per chunk through the shuffles, not once per
    document, and its count comes back to the chunks that hold it, so no table of counts is
    held whole by a task or the driver. A chunk holds about ``CHUNK`` bytes of text, or one
    document that is longer; a task holds a few chunks at a time, however many it has.
    """
    short_batches(docs.sparkSession)
    parts = written(chunks(docs, path_a, path_b, id_col, text_col), **{"parquet.block.size": GROUP, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1})
    here = parts.select("chunk", F.explode("pairs").alias("pair"))
    marks = here.join(pair_counts(parts), "pair").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("marks"))
    marks = marks.select("chunk", F.col("marks.n").alias("n"), F.col("marks.best").alias("best"))
    names = [c.split()[0] for c in DIGEST.split(", ")]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c).slice(k, 1).flatten() for c in batch.schema.names if c != "chunk"}
                at, times = row["at"].to_numpy(False), row["times"].to_numpy(False)
                bounds = _starts(row["distinct"].to_numpy(False))
                n, best = row["n"].to_numpy(False), row["best"].to_numpy(False).astype(bool)
                for name, part in (("n_best", times * best[at]), ("count_sum", times * n[at])) if len(at) else (("n_best", times), ("count_sum", times)):
                    row[name] = pa.array(np.diff(_starts(part)[bounds]), pa.int64())
                yield pa.RecordBatch.from_arrays([row[c] for c in names], names)

    return parts.join(marks, "chunk", "left").select("doc_id", *_COUNTS, "groups_sha256", "distinct", "at", "times", "n", "best").mapInArrow(sums, DIGEST)
