"""A trie over rebuilt conversations, from distinct weighted sequences only.

Whole-sequence collapse: identical conversations become one sequence with a weight, a smallest
member and a list of who ends there. Sequences that are a proper prefix of another one are told
from leaves by an anti-join. Only then are prefixes made, one row per depth of each distinct
sequence, and the weighted rows of a prefix are added up.

A prefix is named by a 128-bit code: the exclusive or, over its turns, of two 64-bit hashes of
(depth, digest of role and text). So codes of any stretch can be made apart and put together,
and a very long conversation is cut into blocks instead of being one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.session import written

#: Conversations c, c + 1, ... of one family share the head of their first; heads are shorter than HEADS.
FAMILY, HEADS = 5, 9
#: Turns of a conversation that stand in one block, and consecutive ids listed in one piece.
BLOCK, PIECE = 1024, 16_384

#: The root: no turns.
_CODE = ["code1", "code2"]


def head_length(conv: str = "conv_id") -> Column:
    """How many turns conversation c takes from the first of its family."""
    return (F.crc32(F.col(conv).cast("string")) % HEADS).cast("int")


def _numbered(turns: DataFrame) -> DataFrame:
    """Every turn with its place in its conversation, from 1, counted block by block.

    Blocks are stretches of turn numbers; a small window per conversation adds up the blocks
    before, and each block is numbered by itself.
    """
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 60))).alias("block"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select("conv_id", "turn", "block", "role", F.octet_length("text").cast("long").alias("size"), F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.join(blocks, ["conv_id", "block"]).select("conv_id", (F.col("before") + F.row_number().over(within)).alias("place"), "size", "digest")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rebuilt turns ``conv_id, depth, size, digest``, and all conversations.

    The head comes as at most eight turns per family, so nothing is repeated but them.
    """
    own = written(_numbered(turns))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    lengths = own.groupBy("conv_id").agg(F.max("place").alias("length"))
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).groupBy(F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(F.struct("place", "size", "digest"))).alias("head"))
    convs = written(lengths.select("conv_id", "length", first.alias("first"), head_length().alias("h")).join(heads, "first", "left").select("conv_id", "h", (F.col("conv_id") == F.col("first")).alias("whole"), F.coalesce("head", F.array().cast("array<struct<place:bigint,size:bigint,digest:string>>")).alias("head")))
    taken = convs.where("not whole").select("conv_id", F.explode(F.filter("head", lambda t: t["place"] <= F.col("h"))).alias("t")).select("conv_id", F.col("t.place").alias("depth"), "t.size", "t.digest")
    gap = convs.where("not whole").select("conv_id", (F.col("h") - F.least(F.col("h"), F.size("head"))).alias("gap")).where("gap > 0")
    # A gap moves the rest of a conversation up; few have one, and their rows are spread by place.
    rest = own.where((F.col("conv_id") % FAMILY == 0) | (F.col("place") > head_length()))
    rest = rest.join(gap, "conv_id", "left").select("conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("depth"), "size", "digest")
    return taken.unionByName(rest), convs.select("conv_id")


def _blocks(rows: DataFrame) -> DataFrame:
    """Per block of a conversation: its code, bytes and last depth."""
    return rows.groupBy("conv_id", "block").agg(F.bit_xor("code1").alias("code1"), F.bit_xor("code2").alias("code2"), F.sum("size").alias("size"), F.max("depth").alias("depth"))


def end_lists(ended: DataFrame) -> DataFrame:
    """``code1, code2, depth, conv_id`` to the SHA-256 of each sequence's ids, comma-joined.

    Ids are listed in pieces of consecutive numbers, so a piece is bounded whatever ends there.
    A sequence of one piece is hashed in place; the others stream their pieces, in order,
    through one hasher.
    """
    key = [*_CODE, "depth"]
    pieces = written(ended.groupBy(*key, F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    several = pieces.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hasher = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in now] + [pa.array([hasher.hexdigest()])], [*key, "ends_sha256"])

        for batch in batches:
            for *at, ids in zip(*[batch.column(c).to_pylist() for c in (*key, "ids")]):
                if at != now:
                    if now is not None:
                        yield done()
                    now, hasher = at, hashlib.sha256()
                else:
                    hasher.update(b",")
                hasher.update(ids.encode())
        if now is not None:
            yield done()

    long = pieces.join(several, key, "left_semi").repartition(*key).sortWithinPartitions(*key, "piece").select(*key, "ids").mapInArrow(digests, "code1 long, code2 long, depth long, ends_sha256 string")
    return pieces.join(several, key, "left_anti").select(*key, F.sha2("ids", 256).alias("ends_sha256")).unionByName(long)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` to one row per distinct prefix of a rebuilt conversation.

    Turns without a conv_id take no part. Null role or text is empty text; turns are ordered by
    number, null first, and turns of one number by role and then by a digest of role and text;
    repeated rows are turns of their own. Texts of any length count whole, and only their
    digests and sizes are shuffled. Other columns are not looked at. An empty table has no
    node. A conversation may have any number of turns, as long as its turn numbers differ.
    """
    found, convs = rebuilt(turns)
    key = [*_CODE, "depth"]
    rows = written(found.select("conv_id", "depth", F.floor(F.col("depth") / BLOCK).alias("block"), "size", F.xxhash64("depth", "digest").alias("code1"), F.xxhash64("digest", "depth").alias("code2")))
    blocks = written(_blocks(rows))

    # One sequence for all identical conversations; a turnless one has the root's code.
    totals = blocks.groupBy("conv_id").agg(F.bit_xor("code1").alias("code1"), F.bit_xor("code2").alias("code2"), F.sum("size").alias("bytes"), F.max("depth").alias("depth"))
    zero = F.lit(0).cast("long")
    whole = written(convs.join(totals, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in (*key, "bytes")]))
    sequences = written(whole.groupBy(*key).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("member"), F.max("bytes").alias("bytes")))

    # Every depth of every distinct sequence, with the code up to there.
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("member", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    starts = blocks.join(sequences.select(F.col("member").alias("conv_id")), "conv_id", "left_semi").select("conv_id", "block", *[F.coalesce(f(c).over(before), zero).alias(f"{c}_before") for f, c in ((F.bit_xor, "code1"), (F.bit_xor, "code2"), (F.sum, "size"))])
    steps = rows.join(starts, ["conv_id", "block"]).withColumnRenamed("conv_id", "member").select(
        "member", "block", "depth", "size",
        *[F.col(f"{c}_before").bitwiseXOR(F.bit_xor(c).over(upto)).alias(c) for c in _CODE],
        *[F.col(c).alias(f"own_{c}") for c in _CODE],
        (F.col("size_before") + F.sum("size").over(upto)).alias("bytes_upto"),
    ).select("member", "block", *key, "size", "bytes_upto", *[F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"up_{c}") for c in _CODE])
    root = sequences.select("member", zero.alias("block"), zero.alias("code1"), zero.alias("code2"), zero.alias("depth"), zero.alias("size"), zero.alias("bytes_upto"), zero.alias("up_code1"), zero.alias("up_code2"))
    steps = written(steps.unionByName(root))

    # Leaves: sequences that no other one goes on from.
    inner = steps.where("depth > 0").select(F.col("up_code1").alias("code1"), F.col("up_code2").alias("code2"), (F.col("depth") - 1).alias("depth")).distinct()
    leaves = sequences.join(inner, key, "left_anti").select("member", F.lit(1).alias("leaf"))

    # A prefix belongs to its smallest member; what a sequence owns is the end of it.
    owned = steps.groupBy(*key).agg(F.min("member").alias("member"), F.max("size").alias("size")).groupBy("member").agg(F.sum("size").alias("owned"))
    facts = sequences.select("member", "weight", "bytes").join(leaves, "member", "left").join(owned, "member", "left")
    facts = steps.select("member", "block").distinct().join(facts, "member")

    # Below a prefix, the bytes of all members less the bytes of the distinct nodes are saved;
    # each node there is counted by the sequence that owns it.
    below = F.col("bytes") - F.col("bytes_upto") + F.col("size")
    nodes = written(steps.join(facts, ["member", "block"]).groupBy(*key).agg(
        F.min("member").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
        (F.sum(F.col("weight") * below) - F.sum(F.least(below, F.coalesce("owned", zero)))).alias("saved_tokens"),
        F.max("up_code1").alias("up_code1"), F.max("up_code2").alias("up_code2")))

    up = [F.col("up_code1").alias("code1"), F.col("up_code2").alias("code2"), (F.col("depth") - 1).alias("depth")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    # Every parent is one row, so a parent of very many is split by the join's left side.
    parents = nodes.select(F.col("code1").alias("up_code1"), F.col("code2").alias("up_code2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(parents.where("depth > 1"), ["up_code1", "up_code2", "depth"], "left")
    top = nodes.where("depth = 0").select("conv_id").scalar()
    none = hashlib.sha256(b"").hexdigest()
    return (
        linked.join(children, key, "left").join(end_lists(whole), key, "left")
        .select(
            "conv_id", "depth", F.when(F.col("depth") == 1, top).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


# The same from lists of whole prefixes. The checksum is spelled out: 0xEDB88320 is the fixed
# reversed polynomial of CRC-32.
PREFIX_TRIE_SQL = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT conv_id, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1)))), 4294967295::BIGINT) % 9 AS h
  FROM ids),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT c.conv_id, o.place, o.role, o.text FROM crc c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.place <= c.h
  UNION ALL
  SELECT c.conv_id, o.place, o.role, o.text FROM crc c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h),
seqs AS (
  SELECT i.conv_id, coalesce(list({'r': t.role, 't': t.text} ORDER BY t.place) FILTER (t.place IS NOT NULL), []) AS s
  FROM ids i LEFT JOIN turns t ON t.conv_id = i.conv_id GROUP BY i.conv_id),
prefixes AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seqs),
nodes AS (
  SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = d) AS ends
  FROM prefixes GROUP BY s[1:d], d),
costed AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * octet_length(encode(p[d].t)) END AS saves,
         (SELECT count(*) FROM nodes k WHERE k.d = o.d + 1 AND k.p[1:o.d] = o.p) AS kids
  FROM nodes o),
sums AS (
  SELECT u.p[1:x.a] AS p, x.a AS d, sum(u.saves) AS saved, count(*) FILTER (u.kids = 0) AS leaves
  FROM costed u, unnest(range(0, u.d + 1)) AS x(a) GROUP BY u.p[1:x.a], x.a)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, o.n AS n_convs, o.kids AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(o.ends, '')) AS ends_sha256
FROM costed o JOIN sums s ON s.d = o.d AND s.p = o.p
LEFT JOIN nodes up ON up.d = o.d - 1 AND up.p = o.p[1:o.d - 1]
"""
