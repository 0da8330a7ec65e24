"""Exact Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams is the order of their hashes. Cut into enough fragments, two sets
above the threshold differ in fewer fragments than there are, so some fragment of theirs is
identical; documents are joined on identical fragments. The overlap of a candidate pair is then
counted in each of a few wide fragments by itself, and the counts are summed per pair.

Documents with the same set are one node from the start. In a group of nodes that share a
fragment, every node is first compared with one pivot only; after that, only nodes that are not
yet connected are, and of those only pairs that what they share with the pivot allows to link. So
copies never meet in pairs, and no link that could join two components goes unchecked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm.components import components
from ledgerspark.llm.hashing import mix, row_of, shingle_hashes, slices, utf8, word_hashes
from ledgerspark.session import release, written

#: Wide fragments in which overlaps are counted.
WIDE = 4
#: Rows that a task gathers before it merges equal ones.
GATHER = 1 << 18
#: Needed ids up to this number are broadcast (16 MB); more are joined.
BROADCAST = 1_000_000

_NODE, _CHECK, _PART = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xC3A5C85C97CB3127)


def sets(rows: pa.RecordBatch, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row in ascending order, and where each row's begin."""
    hashes, bounds = shingle_hashes(*word_hashes(*utf8(rows.column(text))), size)
    owner = row_of(bounds)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], np.searchsorted(owner[keep], np.arange(rows.num_rows + 1))


def _summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def nodes_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number per set; sets of other sizes have other numbers even where sums agree."""
    return mix(_summed(mix(hashes ^ _NODE), bounds) + np.diff(bounds).astype(np.uint64) * _PART)


def size_classes(most: int, percent: int) -> np.ndarray:
    """Least size of each class; a link reaches from a class into the next at most."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out)


def fragments(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the fragments by which each set is joined.

    For the pairs whose smaller set is of one class, sets of that and the next class are cut
    into the same number of fragments, a quarter more than they can differ in. By the prefix
    principle the largest fragments that are one more than the possible differences suffice.
    """
    sizes = np.diff(bounds)
    rows_out, keys_out = [], []
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = size_classes(int(sizes.max()), percent)
    own = np.searchsorted(least, sizes, side="right") - 1
    for back in (0, 1):
        kind = own - back
        smaller = least[np.clip(kind + 1, 0, len(least) - 1)] - 1  # largest size of the class
        differ = ((100 - percent) * (smaller + smaller * 100 // percent)) // (100 + percent)
        differ[(kind < 0) | (sizes == 0)] = 0
        number = np.where(differ > 0, differ + differ // 4 + 1, 0)
        rows = np.flatnonzero(number)
        if not len(rows):
            continue
        span = sizes[rows]
        at = np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())
        owner, h = np.repeat(np.arange(len(rows)), span), hashes[at]
        place = ((h >> np.uint64(32)) * number[rows][owner].astype(np.uint64)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])]))
        owner, place = owner[first], place[first]
        ends = np.append(first, len(h))
        key = mix(_summed(mix(h ^ _PART), ends) ^ mix(place + (kind[rows][owner].astype(np.uint64) << np.uint64(32)) + np.uint64(1)))
        count = np.diff(ends)
        have = np.bincount(owner, minlength=len(rows))
        short = np.flatnonzero(have <= differ[rows])
        owners, extra = [owner], [key]
        for r in short.tolist():  # too few fragments hold anything: empty ones count as well
            empty = np.setdiff1d(np.arange(number[rows[r]], dtype=np.uint64), place[owner == r])
            owners.append(np.full(len(empty), r))
            extra.append(mix(mix(empty + (np.uint64(kind[rows[r]]) << np.uint64(32)) + np.uint64(1))))
        owner, key = np.concatenate(owners), np.concatenate(extra)
        count = np.concatenate([count, np.zeros(len(owner) - len(count), np.int64)])
        order = np.lexsort((key, -count, owner))
        owner, key = owner[order], key[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        chosen = rank <= differ[rows][owner]
        rows_out.append(rows[owner[chosen]])
        keys_out.append(key[chosen])
    return (np.concatenate(rows_out), np.concatenate(keys_out)) if rows_out else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def document_sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, node, proof`` for every row; an empty set has n 0 and no node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                hashes, bounds = sets(rows, text_col, size)
                n = np.diff(bounds)
                node = pa.array(nodes_of(hashes, bounds).view(np.int64), mask=n == 0)
                proof = pa.array(_summed(mix(hashes ^ _CHECK), bounds).view(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column(id_col).cast(pa.int64()), pa.array(n, pa.int64()), node, proof], ["doc_id", "n", "node", "proof"])

    return docs.select(id_col, text_col).mapInArrow(run, "doc_id long, n long, node long, proof long")


def shared_fragments(docs: DataFrame, size: int, percent: int, text_col: str) -> DataFrame:
    """``key, node`` of the fragments that at least two nodes share.

    A task sends one row per key to the key's partition, so no key is hot there; further nodes
    that the task itself saw with the key are known to share it and are dealt evenly.
    """
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def merged() -> pa.RecordBatch:
            keys, nodes = (np.concatenate(x) for x in zip(*waiting))
            order = np.lexsort((nodes, keys))
            keys, nodes = keys[order], nodes[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
            keys, nodes = keys[new], nodes[new]
            leads = np.ones(len(keys), bool)
            leads[1:] = keys[1:] != keys[:-1]
            several = ~leads
            several[:-1] |= ~leads[1:]
            deal = np.where(leads, keys, mix(keys + nodes * _CHECK))
            return pa.RecordBatch.from_arrays([pa.array(deal.view(np.int64)), pa.array(nodes.view(np.int64)), pa.array(keys.view(np.int64), mask=~several)], ["deal", "node", "key"])

        for batch in batches:
            for rows in slices(batch, text_col):
                hashes, bounds = sets(rows, text_col, size)
                row, key = fragments(hashes, bounds, percent)
                waiting.append((key, nodes_of(hashes, bounds)[row]))
                n += len(key)
                if n >= GATHER:
                    yield merged()
                    waiting, n = [], 0
        if n:
            yield merged()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by ``deal``; one that stands alone and was alone in its task goes."""
        held = None

        def kept(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
            deal = np.array(rows["deal"], np.int64)
            cut = len(deal) if last else int(np.searchsorted(deal, deal[-1]))
            if not last and len(deal) - cut > GATHER:  # a long run of one key: all but one are sure
                cut = len(deal) - 1
                if cut and deal[cut - 1] == deal[cut]:
                    key = np.array(rows["key"].fill_null(0), np.int64)
                    key[cut] = deal[cut]
                    known = np.array(rows["key"].is_valid())
                    known[cut] = True
                    rows = pa.table({"deal": rows["deal"], "node": rows["node"], "key": pa.array(key, mask=~known)})
            node = np.array(rows["node"], np.int64)
            known = np.array(rows["key"].is_valid())
            key = np.where(known, np.array(rows["key"].fill_null(0), np.int64), deal)
            own = np.ones(len(deal), bool)  # copies of one set are one node
            own[1:] = (deal[1:] != deal[:-1]) | (node[1:] != node[:-1]) | known[1:]
            at = np.flatnonzero(own)
            d = deal[at]
            same = np.zeros(len(at), bool)
            same[1:] = d[1:] == d[:-1]
            same[:-1] |= d[1:] == d[:-1]
            out = at[(same | known[at]) & (at < cut)]
            return pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(node[out])], ["key", "node"]), rows.slice(cut)

        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch]).cast(pa.schema([("deal", pa.int64()), ("node", pa.int64()), ("key", pa.int64())]))
                rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
                out, held = kept(rows, False)
                if out.num_rows:
                    yield out
        if held is not None and held.num_rows:
            yield kept(held, True)[0]

    rows = docs.select(text_col).mapInArrow(gather, "deal long, node long, key long")
    return rows.repartition("deal").sortWithinPartitions("deal", "node").mapInArrow(meet, "key long, node long")


def side_by_side(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``a, b, part, in_a, in_b``: the runs of both sets of a pair in each wide fragment that b has."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_col):
                hashes, bounds = sets(rows, text_col, size)
                # Rows of one id may have several texts; only the one that is the node is meant.
                meant = nodes_of(hashes, bounds).view(np.int64) == np.array(rows.column("node"), np.int64)
                hashes, bounds = hashes[np.repeat(meant, np.diff(bounds))], np.concatenate([[0], np.cumsum(np.diff(bounds) * meant)])
                owner = row_of(bounds)
                part = (hashes >> np.uint64(62)).astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])])) if len(hashes) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(hashes)), pa.int32()), pa.array(hashes.view(np.int64)))
                node = np.array(rows.column("node"), np.int64)[owner[first]]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(part[first], pa.int32()), lists], ["node", "part", "found"])

    def wide(side: str) -> DataFrame:
        need = written(pairs.select(F.col(side).alias("node")).distinct().join(classes, "node").select(F.col("doc_id").alias(id_col), "node"))
        need = F.broadcast(need) if need.count() <= BROADCAST else need
        return docs.select(id_col, text_col).join(need, id_col)

    def of(side: str) -> DataFrame:
        return wide(side).select("node", text_col).mapInArrow(cut, "node long, part int, found array<long>").select(F.col("node").alias(side), "part", F.col("found").alias(f"in_{side}"))

    both = pairs.select("a", "b").join(of("b"), "b").join(of("a"), ["a", "part"], "left")
    return both.withColumn("in_a", F.coalesce("in_a", F.array().cast("array<long>")))


def overlaps(met: DataFrame) -> DataFrame:
    """``a, b, overlap``: counted in each wide fragment by itself, then summed per pair."""
    partial = met.groupBy("a", "b", "part").agg(F.max(F.size(F.array_intersect("in_a", "in_b"))).cast("long").alias("n"))  # repeated rows count once
    return partial.groupBy("a", "b").agg(F.sum("n").alias("overlap"))


def linked(docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and ``node, root`` of the nodes that links connect."""
    rows = written(document_sets(docs, size, id_col, text_col))
    classes = written(rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
        F.when((F.min("proof") != F.max("proof")) | (F.min("n") != F.max("n")), F.raise_error(F.lit("two sets have one number"))).alias("_"),
    ).drop("_"))
    shared = written(shared_fragments(docs.where(F.col(id_col).isNotNull()), size, percent, text_col))
    sizes = classes.select("node", "n")

    def met(pairs: DataFrame) -> DataFrame:
        return side_by_side(docs, classes, pairs, size, id_col, text_col)

    def counted(pairs: DataFrame) -> DataFrame:
        """The pairs with sizes and exact overlap; ``linked`` says whether they reach the threshold."""
        found = pairs.join(overlaps(met(pairs)), ["a", "b"], "left").fillna(0, "overlap")
        found = found.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        return written(found.withColumn("linked", F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("overlap"))))

    # Everyone in a group is compared with the node that shares the most fragments: in a family of
    # edited copies that is their original, whose fragments all occur again somewhere.
    degree = shared.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    pivots = shared.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("p")).select("key", F.col("p.node").alias("a"))
    members = written(shared.join(pivots, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct())
    release(shared)
    if members.isEmpty():
        return rows, classes.select("node", "doc_id", F.col("node").alias("root"))
    stars = counted(members)
    release(members)
    roots = components(stars.where("linked").select("a", "b"))
    more = written(_open_pairs(stars, roots, met, percent))
    if not more.isEmpty():
        links = stars.where("linked").select("a", "b")
        roots = components(links.unionByName(counted(more).where("linked").select("a", "b")))
    return rows, classes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))


def _open_pairs(stars: DataFrame, roots: DataFrame, met, percent: int) -> DataFrame:
    """All pairs around a pivot, neither of them the pivot, that may link and are not connected yet.

    What a node has in common with its pivot is known. Two nodes can only link if they have
    enough runs in common from the pivot alone, or share a run that the pivot lacks; by the
    prefix principle one of the first such runs. A phrase that many texts share is in the pivot
    of the group that it makes, so it is none of those.
    """
    named = roots.select(F.col("node").alias("b"), "root")
    known = stars.join(named, "b", "left").select("a", "b", "overlap", F.col("nb").alias("n"), F.coalesce("root", "b").alias("root"))
    # Groups around a pivot in which everyone is connected need nothing more.
    open_stars = known.groupBy("a").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("a")
    known = known_stars = written(known.join(open_stars, "a"))

    def two(rows: DataFrame, on: list[str], and_also: str) -> DataFrame:
        x, y = (rows.select(*on, *[F.col(c).alias(f"{s}_{c}") for c in rows.columns if c not in on]) for s in "xy")
        near = f"x_root <> y_root AND {percent} * x_n <= 100 * y_n AND {percent} * y_n <= 100 * x_n AND x_b < y_b"
        return x.join(y, on).where(f"{near} AND (x_main <> y_main OR x_main = a) AND {and_also}")

    # Nodes of one family meet around many pivots. What one pivot rules out is ruled out, so a
    # pair is looked at around the largest star of both, if that is the same one.
    star = known.groupBy("a").agg(F.count(F.lit(1)).alias("star"))
    main = known.join(star, "a").groupBy("b").agg(F.max(F.struct("star", "a")).alias("m")).select("b", F.col("m.a").alias("main"))
    known = known.join(main, "b")
    mixed = known.groupBy("a").agg(F.min("main").alias("x"), F.max("main").alias("y")).where("x <> y OR x = a").select("a")
    wide, known = known_stars, written(known.join(mixed, "a"))
    release(wide)
    enough = f"{100 + percent} * least(x_overlap, y_overlap) >= {percent} * (x_n + y_n)"
    likely = known.where(f"100 * overlap >= {percent} * n")
    from_pivot = two(likely, ["a"], enough)

    # The runs beside the pivot, rarest first: a run that one node alone has meets nobody, but
    # takes a place among the first; one that many share is hardly ever among them.
    lacking = written(met(written(known.select("a", "b"))).groupBy("a", "b").agg(F.array_distinct(F.flatten(F.collect_list(F.array_except("in_b", "in_a")))).alias("runs")))  # repeated rows count once
    each = lacking.select("a", "b", F.size("runs").alias("beside"), F.explode("runs").alias("run"))
    held = each.groupBy("a", "run").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    own = Window.partitionBy("a", "b")
    each = each.join(held, ["a", "run"]).select("a", "b", "run", F.count(F.lit(1)).over(own).alias("common"), (F.col("beside") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("held", "run"))).alias("place"), "beside")
    first = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1
    beside = written(known.join(each, ["a", "b"]).where(F.col("place") <= first).withColumn("whole", F.col("beside") <= first).drop("place", "beside"))
    release(lacking)
    reachable = f"{100 + percent} * (least(x_overlap, y_overlap) + least(x_common, y_common)) >= {percent} * (x_n + y_n)"
    common = two(beside, ["a", "run"], reachable).groupBy("a", "x_b", "y_b").agg(F.count(F.lit(1)).alias("k"), F.min(F.least("x_overlap", "y_overlap")).alias("least"), F.min(F.col("x_n") + F.col("y_n")).alias("n"), F.min(F.col("x_whole") & F.col("y_whole")).alias("whole"))
    # Where all runs beside the pivot were compared, their number is known.
    gained = common.where(f"NOT whole OR {100 + percent} * (least + k) >= {percent} * n")
    return from_pivot.select("x_b", "y_b").unionByName(gained.select("x_b", "y_b")).distinct().toDF("a", "b")


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when 100 * common >= percent * union of their distinct word runs. A text
    of fewer words is one run; null and empty texts have none and link with nothing. Repeated
    rows of an id link like any others, and each comes back. A row without id comes back as
    its own component, null.
    """
    rows, nodes = linked(docs, size, percent, id_col, text_col)
    smallest = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(smallest, "root").select("node", "component_id")
    found = rows.join(named, "node", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
