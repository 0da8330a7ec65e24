"""Prefix trie, mixing and alignment against plain versions, with awkward rows."""

from __future__ import annotations

import glob
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import alignment, mixing, prefix_trie
from ledgerspark.llm.queries import QUERIES, SQL, vocabulary

SF = "/root/testdata/sf0.001"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
TURNS = "conv_id long, turn long, role string, text string, depth long, member long, code1 long, block long"
DOCS = "doc_id long, text string, source string, size long, key double, taken long, of string, target double, groups string, chunk long"
LABELS = "doc_id long, quality long, toxic long, weight double"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_mixing"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own[c] if c % 5 == 0 else own.get(c - c % 5, [])[:h] + own[c][h:]
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(len(q) == len(p) + 1 for q in under),
            sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in under) for q in under),
            sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in under if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, 3, 5, 7, 9) for r in rows], TURNS)
    return sorted(map(tuple, prefix_trie.prefix_trie(df).select(*TRIE).collect()), key=str)


def conversations():
    rng = random.Random(4)
    rows = []
    for c in range(70):
        if c in (20, 41):  # a family without its first, and a missing conversation
            continue
        common = c % 3 == 0
        for turn in range(6 if common else rng.randrange(1, 12)):
            text = f"same {turn}" if common or turn < 2 else rng.choice(["a", "bé", "", None])
            rows.append((c, turn, rng.choice(["user", "bot"]) if not common and turn > 2 else "user", text))
    rows += [(None, 1, "user", "nobody"), (90, None, None, None), (90, None, "user", "x"), (90, 2, "user", "y"), (90, 2, "user", "y"), (91, 0, "user", "long " * 30_000)]
    rows += [(95, t, "user", "t") for t in range(40)] + [(96, t, "user", "t") for t in range(33)]
    return rows


def test_trie_against_prefixes_of_lists(spark, monkeypatch):
    rows = conversations()
    want = plain_trie(rows)
    assert trie_of(spark, rows) == want
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    random.Random(1).shuffle(rows)
    assert trie_of(spark, rows) == want


def test_trie_of_nothing(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(1, 0, "user", "")]) == plain_trie([(1, 0, "user", "")])


ODD = [None, "", " ", "\t\n", "one", "two  words", "tab\tx\x0by", "nbsp\xa0x", " lead trail ", "a\n\nb c"]


def mix_rows(seed=1):
    rng = random.Random(seed)
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(ODD)]
    rows += [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 60))), rng.choice(["hot", "hot", "hot", "é", "Z", "a", "b", None])) for i in range(100, 900)]
    rows += [(7, "one and the same row", "hot")] * 200 + [(None, "no id", None), (None, "no id either", "a"), (950, "w " * 30_000, "long"), (951, None, "blank"), (952, " ", "blank")]
    return rows


def frames(spark, rows, labels=((100, 1, 0, 3.0), (101, 0, 1, 3.0), (102, 1, 0, 3.0), (102, 0, 0, 3.0), (None, 1, 0, 3.0), (999, 1, 1, 3.0), (103, None, 0, 3.0))):
    return spark.createDataFrame([(*r, 1, 2.0, 3, "of", 4.0, "g", 5) for r in rows], DOCS), spark.createDataFrame(list(labels), LABELS)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    share, held = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in held]
        left = share - sum(held.values())
        goal = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if goal[s] > 2 * sizes[s]]
        if not over:
            return held | goal
        held |= {s: 2.0 * sizes[s] for s in over}


def test_mix_reaches_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 20)
    rows = mix_rows()
    docs, labels = frames(spark, rows)
    got = mixing.mixed(docs, labels).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, size(t)) for i, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    goal, sums = plain_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, goal[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken >= r.size * int(r.target // max(r.source_size, 1))
        sums[r.source] = sums.get(r.source, 0) + r.taken
    assert all(abs(sums[s] - goal[s]) <= (200 if s == "hot" else 1) for s in goal)
    again = mixing.mixed(docs.repartition(7), labels).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_gives_the_texts_it_counts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 50)
    docs, _ = frames(spark, [r for r in mix_rows(2) if r[0] != 7])
    light = mixing.measured(docs).select("doc_id", "source", "size", mixing.key(F.col("drawn"), F.lit(1.0)).alias("key"))
    planned = mixing.plan(light, mixing.targets(light))
    want = {(r.doc_id, r.source, r.size): r.taken for r in mixing.taken(light, planned).collect() if r.taken}
    out, got, whole = mixing.mixture(docs, planned, F.lit(1.0)), {}, {(i, s): t for i, t, s in mix_rows(2)}
    assert out.columns == [*docs.columns, "epoch"]
    for r in out.collect():
        full = whole[r.doc_id, r.source]
        n = len(re.findall(r"[^\x20\x09-\x0D]+", full))
        assert full.startswith(r.text) and r.size == 1
        got[r.doc_id, r.source, n] = got.get((r.doc_id, r.source, n), 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == want


def test_heavier_documents_come_first(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("s").alias("source"))
    light = mixing.measured(docs).withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    light = light.select("doc_id", "source", "size", mixing.key(F.col("drawn"), F.col("weight")).alias("key")).cache()
    goals = mixing.targets(light, halves=1)
    share = {r.odd: r.n for r in mixing.taken(light, mixing.plan(light, goals)).groupBy((F.col("doc_id") % 2).alias("odd")).agg((F.sum("taken") / F.sum("size")).alias("n")).collect()}
    # Half is taken: x**4 and x for the same x, with a mean of a half.
    assert abs(share[0] - 0.725) < 0.05 and abs(share[1] - 0.276) < 0.05


def test_mix_of_nothing(spark):
    docs, labels = frames(spark, [], [(1, 1, 1, 1.0)])
    assert mixing.mixed(docs, labels).collect() == []
    docs, labels = frames(spark, [(1, None, "a"), (2, " ", None)])
    assert [r.taken for r in mixing.mixed(docs, labels).collect()] == [0, 0]


def plain_alignment(both, text):
    """Token by token: ids, byte ranges, cuts where both end, overlapping pairs."""
    none = (0, 0, 0, [], "")
    if not text:
        return none
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    raw, sides = (" " + text).encode(), []
    for ids, table in ((a, both.bytes_a), (b, both.bytes_b)):
        if b"".join(table[i] for i in ids) != raw:
            return none
        at, spans = 0, []
        for i in ids:
            spans.append((at, at + len(table[i]), i))
            at += len(table[i])
        sides.append(spans)
    cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
    links = [(x[2], y[2]) for x in sides[0] for y in sides[1] if x[0] < y[1] and y[0] < x[1]]
    groups = ";".join("|".join(",".join(str(i) for s, e, i in spans if lo <= s and e <= hi) for spans in sides) for lo, hi in zip([0, *cuts], cuts))
    return len(a), len(b), len(cuts), links, groups


STRANGE = [None, "", " ", "\n", "one", "two  words", " lead", "trail ", "tab\tx", "a\n\nb", "a\nb c", "word\n next", "<|endoftext|> x <s> </s> <unk>", "▁x y", "Ünïcode ÀÉ 👩‍👩‍👧 漢字", "　x", "a\r\nb", "nbsp\xa0x", "\x00a", "ﬁ é", "no​width", "plain words here", "plain words here"]


def test_alignment_against_single_tokens(spark, monkeypatch):
    rng = random.Random(3)
    texts = STRANGE + [" ".join("".join(rng.choice("abeéstr") for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(40)).strip() for _ in range(60)] + ["long word " * 4000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "plain words here", "s"), (3, "two  words", "s")]
    docs, _ = frames(spark, rows)
    both = alignment.Aligner(vocabulary(BYTES), vocabulary(PIECES))
    found = [plain_alignment(both, t) for _, t, _ in rows]
    held = {}
    for *_, links, _ in found:
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    want = [(i, a, b, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(s.encode()).hexdigest() if s else "") for (i, _, _), (a, b, g, links, s) in zip(rows, found)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = alignment.alignment_digest(docs.repartition(3), vocabulary(BYTES), vocabulary(PIECES)).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    out = alignment.aligned(docs, vocabulary(BYTES), vocabulary(PIECES)).collect()
    assert sorted((str(r.doc_id), r.groups, sorted(map(tuple, r.links))) for r in out) == sorted((str(i), s, sorted(set(links))) for (i, _, _), (*_, links, s) in zip(rows, found))


def test_small_cache_changes_nothing():
    large, small = (alignment.Aligner(vocabulary(BYTES), vocabulary(PIECES), most=n) for n in (100_000, 4))
    for part in (STRANGE, ["one two three four five six", "seven one"], STRANGE):
        x, y = large.align(part), small.align(part)
        assert x.groups == y.groups and (x.counts == y.counts).all() and (x.pairs == y.pairs).all() and (x.times == y.times).all()


def test_alignment_of_nothing(spark):
    docs, _ = frames(spark, [])
    assert alignment.alignment_digest(docs, vocabulary(BYTES), vocabulary(PIECES)).collect() == []
    docs, _ = frames(spark, [(1, None, "s")])
    assert [tuple(r) for r in alignment.alignment_digest(docs, vocabulary(BYTES), vocabulary(PIECES)).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_groups_break_where_both_sides_end():
    import numpy as np

    a, b = alignment.coalesce(np.array([2, 5, 6, 9]), np.array([3, 5, 9]))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1]
    assert list(zip(*[x.tolist() for x in alignment.overlaps(np.array([2, 5, 6, 9]), np.array([3, 5, 9]))])) == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 2)]


def test_chunks_are_read_a_few_at_a_time(spark, monkeypatch):
    """A task reads as many rows of megabytes at a time as one row group has, and hands over as many."""
    import pyarrow.parquet as pq

    found, real = [], alignment.written
    monkeypatch.setattr(alignment, "GROUP", 1 << 10)
    monkeypatch.setattr(alignment, "written", lambda df, **options: found.append(real(df, **options)) or found[0])
    text = " ".join(["".join(random.Random(i).choices("abcdefgh", k=7)) for i in range(512)] * (5 * alignment.CHUNK // 4 // 4096 // 2))
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string").coalesce(1)
    out = alignment.alignment_digest(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).collect()
    assert len(out) == 4 and len({tuple(r)[1:] for r in out}) == 1
    groups = [f.metadata.row_group(k).num_rows for f in map(pq.ParquetFile, glob.glob(f"{found[0].written_to}/*.parquet")) for k in range(f.metadata.num_row_groups)]
    assert sum(groups) >= 2 and max(groups) == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"


def test_a_full_store_of_units_keeps_those_that_come_again():
    path = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    small, large = alignment.Aligner(*path, most=60), alignment.Aligner(*path)
    rng = random.Random(6)
    own = lambda: ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(8)]
    often = own()
    for k in range(30):
        texts = [" ".join(often + own()), None, "two  blanks", " ".join(own() + often[:3])]
        x, y = small.align(texts), large.align(texts)
        assert x.groups == y.groups and all(np.array_equal(getattr(x, c), getattr(y, c)) for c in ("counts", "bounds", "pairs", "times"))
        assert len(small.known) <= 60 and len(small.groups) == len(small.met) == len(small.known)
        assert k == 0 or all(w in small.known for w in often)
