"""Language of a text by character models with interpolated Kneser-Ney smoothing.

One model per language over 4-grams of letters (everything else is one blank), stored as sorted
hash arrays in files of the shared folder, which tasks map: neither the driver nor a task holds
a model whole. A text goes to the language with the lowest cross-entropy per character; it is
accepted unless that entropy is beyond what calibration texts of the language show.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.hashing import mix, row_of, slices
from ledgerspark.llm.token_files import opened
from ledgerspark.llm.toxicity import remainder
from ledgerspark.session import shared_folder, written

ORDER = 4
#: Entries per file of a model, about; larger tables are dealt to more files by their hash.
ENTRIES = 1 << 20
#: Share of training texts that may be rejected, and the room beyond that entropy (nats).
REJECTED, ROOM = 0.001, 0.5
#: Decimals of an entropy, so that a language has a bounded number of them however many texts it has.
DECIMALS = 3
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
UNKNOWN = "und"

_PAD, _BLANK = 1, 32
_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)])


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters in lower case with single blanks between words: 4-grams row after row, where each
    row's begin, and whether a row has a letter at all.

    Characters beyond the basic plane fold into 16 bits, so that a 4-gram is one 64-bit number.
    """
    joined = "".join(["\x01\x01\x01 " + t.lower() + " " if t else "\x01\x01\x01 " for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    letter = _LETTER[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        letter[beyond] = [chr(c).isalpha() for c in codes[beyond].tolist()]
    codes = np.where(letter, np.where(codes > 0xFFFF, codes % 0xF000 + 0x1000, codes), np.where(codes == _PAD, _PAD, _BLANK)).astype(np.uint64)
    sizes = np.array([len(t.lower()) + 5 if t else 4 for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)
    kept = np.concatenate([[0], np.cumsum(keep)])
    codes, begins = codes[keep], kept[begins]
    lettered = np.add.reduceat(letter[keep].astype(np.int64), begins[:-1]) > 0 if len(texts) else np.zeros(0, bool)
    grams = codes.copy()
    for back in (1, 2, 3):
        grams[back:] |= codes[:-back] << np.uint64(16 * back)
    real = np.ones(len(codes), bool)
    for k in range(4):  # the pads and the first blank are context only
        real[begins[:-1] + k] = False
    ends = np.concatenate([[0], np.cumsum(real)])
    return grams[real], ends[begins], lettered


def tally(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums the counts of equal grams."""
    order = np.argsort(grams)
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.add.reduceat(counts, first) if len(grams) else counts


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, gram, n`` over all texts: summed per task first, then over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            for rows in slices(batch, text_col):
                grams, bounds, _ = characters(rows.column(text_col).to_pylist())
                langs = rows.column(lang_col).dictionary_encode()
                owner = np.array(langs.indices)[row_of(bounds)]
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    parts = sums.setdefault(lang, [])
                    parts.append(np.unique(grams[owner == k], return_counts=True))
                    if len(parts) > 8:
                        sums[lang] = [tally(*map(np.concatenate, zip(*parts)))]
        for lang, parts in sums.items():
            grams, counts = tally(*map(np.concatenate, zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    return docs.select(text_col, lang_col).mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Table:
    """Values by sorted hash; absent keys give ``other``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def get(self, keys: np.ndarray, other: float) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(keys), other)
        hashes = mix(keys)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], other)


@cache
def _mapped(place: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and values of a file. One that lies on this machine is mapped where it is."""
    system, path = opened(place)
    if not isinstance(system, fs.LocalFileSystem):
        with system.open_input_stream(path) as source, tempfile.NamedTemporaryFile(delete=False) as copy:
            shutil.copyfileobj(source, copy)
        path = copy.name
    return np.asarray(np.memmap(path, np.int64, "r", 0, (n,))), np.asarray(np.memmap(path, np.float32, "r", 8 * n, (n,)))


@dataclass
class FileTable:
    """As ``Table``, but mapped: per value of the hash's first ``bits`` a file and its entries."""

    bits: int
    files: dict[int, tuple[str, int]]

    def get(self, keys: np.ndarray, other: float) -> np.ndarray:
        hashes, out = mix(keys), np.full(len(keys), other, np.float64)
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        hashes = hashes.view(np.int64)
        for k, file in self.files.items():
            mine = np.flatnonzero(bucket == k) if self.bits else slice(None)
            held, values = _mapped(*file)
            at = np.minimum(np.searchsorted(held, hashes[mine]), len(held) - 1)
            out[mine] = np.where(held[at] == hashes[mine], values[at], other)
        return out


class KneserNey:
    """Interpolated: each order's discounted share plus its weight times the order below.

    The highest order uses counts, lower ones in how many different contexts a gram occurs.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.shares, self.weights = [], []
        for order in range(ORDER, 0, -1):
            ones, twos = np.sum(counts == 1), np.sum(counts == 2)
            cut = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
            contexts, inverse = np.unique(grams >> np.uint64(16), return_inverse=True)
            totals = np.bincount(inverse, counts)
            self.shares.append(Table(grams, np.maximum(counts - cut, 0) / totals[inverse]))
            self.weights.append(Table(contexts, cut * np.bincount(inverse) / totals))
            if order > 1:
                below = np.uint64((1 << 16 * (order - 1)) - 1)
                grams, counts = np.unique(grams & below, return_counts=True)
        self.floor = 1.0 / (len(grams) + 1)

    @classmethod
    def of(cls, shares: list[FileTable], weights: list[FileTable], floor: float) -> KneserNey:
        out = cls.__new__(cls)
        out.shares, out.weights, out.floor = shares, weights, floor
        return out

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        chance, weight = np.zeros(len(grams)), np.ones(len(grams))
        for k, (share, rest) in enumerate(zip(self.shares, self.weights)):
            own = grams & np.uint64((1 << 16 * (ORDER - k)) - 1)
            chance += weight * share.get(own, 0.0)
            weight = weight * rest.get(own >> np.uint64(16), 1.0)
        return np.log(chance + weight * self.floor)


@dataclass
class Identifier:
    languages: list[str]
    models: list[KneserNey]
    sharpness: float = 1.0
    limits: np.ndarray | None = None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character by text and language, and whether a text has a letter."""
        grams, bounds, lettered = characters(texts)
        distinct, inverse = np.unique(grams, return_inverse=True)
        sizes, out = np.maximum(np.diff(bounds), 1), np.zeros((len(texts), len(self.models)))
        for k, model in enumerate(self.models):
            total = np.concatenate([[0.0], np.cumsum(model.log_probability(distinct)[inverse])])
            out[:, k] = -(total[bounds[1:]] - total[bounds[:-1]]) / sizes
        return out, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (share of the best among all) and whether it is accepted.

        A text without a letter, and any text where nothing was learnt, is ``und`` with 0.
        """
        if not self.models:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, lettered = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - least[:, None])).sum(axis=1)
        accepted = lettered & (least <= self.limits[best]) if self.limits is not None else lettered
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.where(lettered, score, 0.0), accepted


def _write_tables(entries: DataFrame, folder: str, bits: int) -> DataFrame:
    """Writes ``lang, slot, key, value`` as files of sorted hashes; ``lang, slot, bucket, file, n``.

    Each attempt of a task writes files of its own name, and only the rows of the attempt that
    ended well name them.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = mix(np.array(batch.column("key"), np.int64).view(np.uint64))
            bucket = (hashes >> np.uint64(64 - bits) if bits else hashes * np.uint64(0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("slot"), pa.array(bucket), pa.array(hashes.view(np.int64)), batch.column("value")], ["lang", "slot", "bucket", "hash", "value"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = None

        def closed() -> pa.RecordBatch:
            hashes, values = map(np.concatenate, zip(*waiting))
            place = f"{folder}/{uuid.uuid4().hex}"
            system, path = opened(place)
            system.create_dir(path.rsplit("/", 1)[0])
            with system.open_output_stream(path, compression=None) as stream:
                stream.write(hashes.tobytes())
                stream.write(values.tobytes())
            lang, slot, bucket = held
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([slot], pa.int32()), pa.array([bucket], pa.int64()), pa.array([place]), pa.array([len(hashes)], pa.int64())], ["lang", "slot", "bucket", "file", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            langs = batch.column("lang").dictionary_encode()
            code, slot, bucket = np.array(langs.indices), np.array(batch.column("slot")), np.array(batch.column("bucket"))
            hashes, values = np.array(batch.column("hash"), np.int64), np.array(batch.column("value"), np.float32)
            new = np.flatnonzero((np.diff(code) != 0) | (np.diff(slot) != 0) | (np.diff(bucket) != 0)) + 1
            for a, b in zip([0, *new], [*new, len(code)]):
                own = (langs.dictionary[int(code[a])].as_py(), int(slot[a]), int(bucket[a]))
                if held is not None and own != held:
                    yield closed()
                    waiting = []
                held = own
                waiting.append((hashes[a:b], values[a:b]))
        if waiting:
            yield closed()

    keys = ["lang", "slot", "bucket"]
    rows = entries.mapInArrow(hashed, "lang string, slot int, bucket long, hash long, value float")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "hash").mapInArrow(write, "lang string, slot int, bucket long, file string, n long")


def _models(counted: DataFrame) -> tuple[list[str], list[KneserNey]]:
    """The languages and their models, from the counts ``lang, gram, n`` of all their 4-grams.

    What the driver sees is a few numbers per language and order, and the names of the files.
    """
    spark, level, parts, distinct = counted.sparkSession, written(counted), [], {}
    for order in range(ORDER, 0, -1):
        seen = F.count(F.lit(1)).alias("distinct")
        ones, twos = (F.sum((F.col("n") == k).cast("double")) for k in (1, 2))
        cut = F.least(F.greatest(ones / F.greatest(ones + 2 * twos, F.lit(1.0)), F.lit(0.1)), F.lit(0.9)).alias("cut")
        cuts = written(level.groupBy("lang").agg(cut, seen))
        for r in cuts.collect():  # one row per language
            distinct.setdefault(r["lang"], []).append(r["distinct"])
        context = F.shiftrightunsigned("gram", 16)
        contexts = written(level.groupBy("lang", context.alias("key")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("follows")).join(cuts, "lang"))
        share = F.greatest(F.col("n") - F.col("cut"), F.lit(0.0)) / F.col("total")
        slot = 2 * (ORDER - order)
        parts.append(level.withColumn("key", context).join(contexts, ["lang", "key"]).select("lang", F.lit(slot).alias("slot"), F.col("gram").alias("key"), share.cast("float").alias("value")))
        parts.append(contexts.select("lang", F.lit(slot + 1).alias("slot"), "key", (F.col("cut") * F.col("follows") / F.col("total")).cast("float").alias("value")))
        if order > 1:
            below = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
            level = written(level.groupBy("lang", below.alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    if not distinct:
        return [], []
    bits = max(0, (max(map(max, distinct.values())) // ENTRIES).bit_length())
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    folder = f"{shared_folder(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    tables: dict[tuple[str, int], FileTable] = {}
    for r in _write_tables(entries, folder, bits).collect():  # one row per file of about ENTRIES entries
        tables.setdefault((r["lang"], r["slot"]), FileTable(bits, {})).files[r["bucket"]] = (r["file"], r["n"])
    langs = sorted(distinct)
    lists = [[[tables.get((lang, 2 * k + kind), FileTable(bits, {})) for k in range(ORDER)] for kind in (0, 1)] for lang in langs]
    return langs, [KneserNey.of(*both, 1.0 / (distinct[lang][-1] + 1)) for lang, both in zip(langs, lists)]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Identifier:
    """Counts all texts with a language, writes the models of all their 4-grams and calibrates them.

    Null languages and null texts teach nothing. An empty table gives an identifier that knows
    no language. Sharpness and limits come from all these texts as well: tasks measure them, and
    the driver sees the sums of each sharpness and one quantile per language.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
    out = Identifier(*_models(count_grams(known, text_col, lang_col)))
    if not out.models:
        return out
    shared = docs.sparkSession.sparkContext.broadcast(out)  # names of files

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: k for k, lang in enumerate(shared.value.languages)}
        for batch in batches:
            for rows in slices(batch, text_col):
                entropy, lettered = shared.value.entropies(rows.column(text_col).to_pylist())
                true = np.array([number[lang] for lang in rows.column(lang_col).to_pylist()], np.int64)
                own = entropy[np.arange(len(true)), true]
                surprise = [np.log(np.exp(-s * (entropy - own[:, None])).sum(axis=1)) for s in SHARPNESS]
                measured = pa.RecordBatch.from_arrays([rows.column(lang_col), pa.array(own), *map(pa.array, surprise)], ["lang", "own", *tried])
                yield measured.filter(pa.array(lettered))

    tried = [f"s{k}" for k in range(len(SHARPNESS))]
    rows = known.mapInArrow(measure, "lang string, own double, " + ", ".join(f"{c} double" for c in tried))
    limit = F.percentile(F.round("own", DECIMALS), F.lit(1 - REJECTED)).alias("limit")
    seen = rows.groupBy("lang").agg(limit, *[F.sum(c).alias(c) for c in tried]).collect()  # one row per language
    if not seen:
        return out
    sums = [sum(sorted(r[c] for r in seen)) for c in tried]
    out.sharpness = SHARPNESS[int(np.argmin(sums))]
    limits = {r["lang"]: r["limit"] + ROOM for r in seen}
    out.limits = np.array([limits.get(lang, np.inf) for lang in out.languages])
    return out


def identify(docs: DataFrame, model: Identifier, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``, from the text alone."""
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                lang, score, accepted = shared.value.predict(rows.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame, fold: int = 4, held: int = 2) -> DataFrame:
    """Predictions for all documents by a model that never sees the held-out fold."""
    is_held: Column = remainder("doc_id", fold) == held
    model = train(docs.where(~is_held))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", is_held.alias("held_out"), "lang_pred", "score", "accepted")
