"""Best-fit packing of token sequences by hierarchical residual packing.

Pieces are dealt to groups of bounded size, each group is packed best-fit by itself, bins that
are full or nearly full are final, and the others go up a tree as items: the bins of several
groups meet in one group of the next level and are packed best-fit again, until one is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm import tokens
from ledgerspark.llm.hashing import slices
from ledgerspark.session import written

#: Items packed together at the first level.
GROUP = 20_000
#: Groups whose bins meet in one group of the next level.
FAN = 8
#: A bin with at most this share of room is final.
SLACK = 0.002
#: Underfull bins that a group hands up, emptiest first; the others are final as they are. Of
#: the bins of a group at most one is half empty, so no more could be joined higher up.
CARRY = 2_000

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids with the end id, cut at ``capacity`` only where longer.

    A null or empty text is its end id alone; repeated rows are documents of their own.
    ``uid`` numbers the pieces; it is fixed once the table is written.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows in slices(batch, text_col):
                out = []
                for doc, ids in zip(rows.column(id_col).to_pylist(), encoder.encode(rows.column(text_col).to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        out.append((uid + len(out), doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                uid += len(out)
                columns = zip(*out)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item and its place in it.

    Open bins are kept by room; a bit per room that some bin has finds the tightest fit.
    """
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: dict[int, list[int]] = {}
    bits = made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = bits >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                bits ^= 1 << room
        else:
            room, b, made = capacity, made, made + 1
        bins[i], places[i] = b, capacity - room
        if room > need:
            left = room - need
            if not rooms.setdefault(left, []):
                bits |= 1 << left
            rooms[left].append(b)
    return bins, places


def _packer(capacity: int, level: int, last: bool, carry: int):
    """Packs one group; bins with room go up unless this is the last level."""
    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        part, lengths = int(rows["part"].iloc[0]), rows["length"].to_numpy(np.int64)
        bins, places = best_fit(lengths, capacity)
        loads = np.bincount(bins, weights=lengths).astype(np.int64)
        goes_up = (loads < capacity * (1 - SLACK)) & (not last)
        order = np.argsort(loads, kind="stable")
        goes_up[order[goes_up[order]][carry:]] = False
        ids = (level << 58) | (part << 24) | np.arange(len(loads))
        return pd.DataFrame({"uid": rows["uid"], "bin": ids[bins], "place": places, "load": loads[bins], "up": goes_up[bins], "part": part})

    return pack_group


def pack(items: DataFrame, capacity: int, group: int = GROUP, fan: int = FAN, carry: int = CARRY) -> DataFrame:
    """``uid long, length long`` (at most ``capacity``) to ``uid, sequence_id long, offset long``.

    Items of full length need no partner. The rest is dealt by a hash of ``uid``, so equal
    lengths, sources and copies spread evenly and a recomputed task deals as before. Groups
    grow in number with the items and not in size. An empty table gives an empty table.
    """
    full = items.where(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    level_items = items.where(F.col("length") < capacity).select("uid", "length")
    groups = max(1, -(-level_items.count() // group))
    level_items = level_items.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    placed, level = None, 0
    while True:
        last = groups == 1

        out = written(level_items.groupBy("part").applyInPandas(_packer(capacity, level, last, carry), "uid long, bin long, place long, load long, up boolean, part long"))
        here = out.select("uid", "bin", "place", "up")
        if placed is None:
            placed = here
        else:  # the bins that went up have a new bin and place now
            moved = here.select(F.col("uid").alias("bin"), F.col("bin").alias("into"), F.col("place").alias("at"), F.col("up").alias("again"))
            placed = placed.join(moved, "bin", "left").select("uid", F.coalesce("into", "bin").alias("bin"), (F.col("place") + F.coalesce("at", F.lit(0))).alias("place"))
        if last:
            break
        groups, level = -(-groups // fan), level + 1
        level_items = out.where("up").groupBy(F.col("bin").alias("uid")).agg(F.first("load").alias("length"), (F.first("part") / fan).cast("long").alias("part"))
    return placed.select("uid", F.col("bin").alias("sequence_id"), F.col("place").alias("offset")).unionByName(full)


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens."""
    pieces = written(token_pieces(docs, vocabulary, capacity, end_id))
    placed = pack(pieces.select("uid", "length"), capacity)
    return pieces.join(placed, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
