"""The training-data operators against brute force, on small tables with awkward rows."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import time
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspark.llm import components, decontamination, hashing, jaccard_join, language_id, license_scan, line_dedup, nearest, packing, substring_dedup, token_files, tokens, toxicity
from ledgerspark.llm.queries import vocabulary
from ledgerspark.session import shared_folder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, id long, score double"
ODD = [None, "", " ", "\n", "one", "two words", "Ünïcode ÀÉ 👩‍👩‍👧", "  blanks  ", "tab\tnbsp  x", "a\n\nb", "<|endoftext|> x"]


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def documents(spark, rows):
    """Rows of (id, text) with further columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", 0, 7, 8, 0.5) for k, (i, t) in enumerate(rows)], DOCS)


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = [" ".join(words(400, 1)), None, "", "X", "x", "long" * 3000]
    raw = hashing.utf8(pa.array(texts, pa.string()))
    whole, bounds = hashing.word_hashes(*raw)
    monkeypatch.setattr(hashing, "CHUNK", 100)
    again, same = hashing.word_hashes(*raw)
    assert (whole == again).all() and (bounds == same).all()
    assert bounds.tolist() == [0, 400, 400, 400, 401, 402, 403] and whole[400] == whole[401]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    encoder, plain = tokens.Encoder(vocabulary(name), most=40), Tokenizer.from_file(vocabulary(name))
    texts = ODD + ["a <|endoftext|><|startoftext|> b", "<|startoftext|>"] + [" ".join(words(30, s)) + ".\nNext, line's end" for s in range(5)]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == (plain.encode(text, add_special_tokens=False).ids if text else [])


def test_token_files_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (None, "no id"), (99, " ".join(words(3000, 2)))]
    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.token_digest(documents(spark, rows), path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_files.token_digest(documents(spark, []), path).count() == 0


def test_damaged_frame_is_refused(spark):
    folder = f"{shared_folder(spark)}/damage"
    index = token_files.write_files(documents(spark, [(1, "some words here")]), folder, vocabulary("byte_bpe_50k.json"), 0)
    system, path = token_files.opened(index.first()["file"])
    data = bytearray(system.open_input_file(path).read())
    table = token_files.FrameReader(system.open_input_file(path))
    data[int(table.places[1]) + 8 + 8] ^= 1  # the frame's checksum in the seek table
    with system.open_output_stream(path, compression=None) as out:
        out.write(bytes(data))
    with pytest.raises(ValueError):
        list(token_files.FrameReader(system.open_input_file(path)).read(0, 4))


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(1)
    items = [(i, rng.choice([1, 5, 50, 99, 100, rng.randint(1, 100)])) for i in range(3000)]
    out = {r["uid"]: r for r in packing.pack(spark.createDataFrame(items, "uid long, length long"), 100, group=200, fan=3, carry=20).collect()}
    assert len(out) == 3000
    bins: dict[int, list] = {}
    for uid, length in items:
        bins.setdefault(out[uid]["sequence_id"], []).append((out[uid]["offset"], length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert len(bins) <= 1.03 * math.ceil(sum(n for _, n in items) / 100)
    assert packing.pack(spark.createDataFrame([], "uid long, length long"), 100).count() == 0


def test_pieces_hold_whole_texts(spark):
    path = vocabulary("word_bpe_49k.json")
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, ""), (50, " ".join(words(500, 3)))]
    out = packing.packed_documents(documents(spark, rows), path, 64).collect()
    tokenizer = Tokenizer.from_file(path)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out if r["doc_id"] == i})
        assert mine == [(k, a, len(ids[a:a + 64]), zlib.crc32(np.array(ids[a:a + 64], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 64))]
    assert sum(r["doc_id"] == 1 for r in out) == 2  # repeated rows are packed twice


def brute_components(rows, size, percent):
    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, size, percent):
    rng, base = random.Random(size), words(120, 9)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(2000, "ONE"), (2001, "one")]
    for i in range(120):  # a family of edited copies, some beyond the threshold, and exact ones
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 9])):
            w[rng.randrange(len(w))] = rng.choice(["x1", "x2", "x3", "x4"])
        rows.append((100 + i, " ".join(w)))
    for i in range(150):  # short texts of few words, and a passage that many texts share
        rows.append((300 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))))
        rows.append((600 + i, " ".join(words(rng.randint(5, 60), i) + base[:40])))
    rows += [(100, rows[20][1])]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents(spark, rows), size, percent).collect())
    assert got == brute_components(rows, size, percent)


def test_jaccard_empty_and_without_id(spark):
    assert jaccard_join.jaccard_components(documents(spark, [])).count() == 0
    got = jaccard_join.jaccard_components(documents(spark, [(None, "a b c d e"), (1, "a b c d e")])).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, None), (1, 1)}


@pytest.mark.parametrize("times", [1, 4])
def test_open_pairs_count_repeated_rows_once(spark, times):
    sides = [(1, 2, 0, [], list(range(2, 12)))] + [(1, 3, 0, [], list(range(1, 12)))]
    both = spark.createDataFrame(sides * times, "a long, b long, part int, in_a array<long>, in_b array<long>")
    stars = spark.createDataFrame([(1, 2, 0, 10), (1, 3, 0, 11)], "a long, b long, overlap long, nb long")
    found = jaccard_join._open_pairs(stars, spark.createDataFrame([], "node long, root long"), lambda pairs: both.join(pairs, ["a", "b"]), 85)
    assert [tuple(r) for r in found.collect()] == [(2, 3)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60) if i != 30] + [(5, 5)], "a long, b long")
    assert {r["node"]: r["root"] for r in components.components(links).collect()} == {i: 0 if i <= 30 else 31 for i in range(1, 61) if i != 31}


def test_compact_windows_cover_every_passage_once():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 40, 90).astype(np.uint64)
    bounds, least, seed = np.array([0, 3, 3, 50, 90]), 7, substring_dedup._SEEDS[0]
    windows = list(zip(*(x.tolist() for x in substring_dedup.compact_windows(hashes, bounds, seed, least))))
    with np.errstate(over="ignore"):
        order = hashes * seed >> np.uint64(7)
    for a, b in zip(bounds, bounds[1:]):
        for s in range(a, b):
            for e in range(s + least - 1, b):
                holding = [c for c, start, stop in windows if start <= s <= c <= e <= stop]
                assert holding == [s + int(np.argmin(order[s:e + 1]))]


def test_repeated_passages(spark):
    passage, base = words(60, 5), words(200, 6)
    edited = [w if k not in (50, 150) else "changed" for k, w in enumerate(base)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(words(40 + 7 * i, 20 + i) + passage + words(30, 60 + i))) for i in range(12)]
    rows += [(200, " ".join(base)), (201, " ".join(base).upper()), (202, " ".join(edited)), (203, " ".join(words(300, 99))), (203, " ".join(words(300, 98))), (None, " ".join(base))]
    out = substring_dedup.repeated_passages(documents(spark, rows)).collect()
    assert {r["doc_id"] for r in out} == {*range(100, 112), 200, 201, 202}
    for r in out:
        assert r["doc_id"] != r["other_id"] and r["n_words"] >= 50 and r["similarity"] >= 0.8
    assert substring_dedup.repeated_passages(documents(spark, [])).count() == 0


def test_passages_around_a_frequent_phrase(spark):
    """60 words that two texts share, 44 of which are a phrase that hundreds of texts hold."""
    phrase, rows = words(44, 7), []
    for i in range(100):
        passage = words(8, 1000 + i) + phrase + words(8, 2000 + i)
        rows += [(2 * i + k, " ".join(words(60 + i, 3000 + 2 * i + k) + passage + words(90, 4000 + 2 * i + k))) for k in range(2)]
    rows += [(1000 + i, " ".join(words(70, 5000 + i) + phrase + words(70, 6000 + i))) for i in range(300)]
    found = {(r["doc_id"], r["other_id"]) for r in substring_dedup.repeated_passages(documents(spark, rows)).collect()}
    want = {(2 * i + k, 2 * i + 1 - k) for i in range(100) for k in range(2)}
    assert found <= want
    assert len(found) >= 0.99 * len(want), len(found)


def test_repeated_passages_against_brute_force(spark):
    """Exact and edited copies, links and places, in texts of very different lengths."""
    rng, rows, want = random.Random(3), [], {}
    for i in range(60):
        passage = words(80, 100 + i)
        copy = [w if k not in {0: (), 1: (40,), 2: (30, 31)}[i % 3] else "edit" for k, w in enumerate(passage)]
        left, right = rng.randrange(200), rng.choice([0, 5, 3000])
        rows += [(2 * i, " ".join(words(left, 300 + i) + passage + words(right, 500 + i))), (2 * i + 1, " ".join(copy + words(40, 700 + i)))]
        want[2 * i, 2 * i + 1] = (left, 0)
    out = substring_dedup.repeated_passages(documents(spark, rows)).collect()
    got = {(r["doc_id"], r["other_id"]): (r["first_word"], r["other_first_word"], r["n_words"], r["similarity"]) for r in out if r["doc_id"] < r["other_id"]}
    assert got.keys() <= want.keys() and len(got) >= 0.95 * len(want)
    for pair, (at, other, n, similarity) in got.items():
        assert (at, other, n) == (*want[pair], 80)
        common = {0: 76, 1: 71, 2: 70}[pair[0] // 2 % 3]
        assert abs(similarity - common / (152 - common)) < 1e-9
    turned = {(r["other_id"], r["doc_id"]): (r["other_first_word"], r["first_word"], r["other_n_words"], r["similarity"]) for r in out if r["doc_id"] > r["other_id"]}
    assert turned == got


@pytest.mark.parametrize(("size", "cut", "inserted"), [(90, 45, 10), (90, 45, 9), (80, 40, 9), (99, 49, 11)])
def test_passages_with_inserted_sentences(size, cut, inserted):
    passage, extra = words(size, 31), words(inserted, 32)
    raw = [" ".join(t) for t in (words(70, 33) + passage + words(80, 34), words(90, 35) + passage[:cut] + extra + passage[cut:] + words(60, 36))]
    x, y = (hashing.shingle_hashes(*hashing.word_hashes(*hashing.utf8(pa.array([t]))), substring_dedup.SIZE)[0] for t in raw)
    n = size - substring_dedup.SIZE + 1
    want = (n - 4) / (n + inserted + 4)  # four runs cross the place, and as many begin or end in the insertion
    assert want >= substring_dedup.SIMILARITY
    assert substring_dedup.verified_passages(x, y) == [(70, 70 + n - 1, 90, 90 + n - 1 + inserted, want)]
    assert substring_dedup.verified_passages(y, x) == [(90, 90 + n - 1 + inserted, 70, 70 + n - 1, want)]


def test_every_place_of_a_passage_is_named():
    rng = np.random.default_rng(9)
    passage, beside = rng.integers(0, 1 << 60, 60), rng.integers(0, 1 << 60, (4, 200))
    y = np.concatenate([beside[0], passage, beside[1], passage, beside[2]])
    x = np.concatenate([beside[3], passage])
    assert substring_dedup.verified_passages(x, y) == [(200, 259, 200, 259, 1.0), (200, 259, 460, 519, 1.0)]
    assert substring_dedup.verified_passages(y, x) == [(200, 259, 200, 259, 1.0), (460, 519, 200, 259, 1.0)]


def test_line_dedup(spark):
    rows = [(i, f"shared line\nown {i}\n\n shared line ") for i in range(6)] + [(None, "shared line"), (7, None), (8, ""), (7, "rare"), (3, "shared line\nown 3\n\n shared line ")]
    docs = spark.createDataFrame([(i, t, None if i == 5 else f"s{i}", 1) for i, t in rows], "doc_id long, text string, source string, key long")
    out = line_dedup.without_spread_lines(docs, min_sites=4)
    assert out.columns == [*docs.columns, "n_lines", "removed_lines"]
    got = sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in out.collect()), key=str)
    want = [(0, rows[0][1], 0), (None, "", 1), (7, None, 0), (8, "", 0), (7, "rare", 0)] + [(i, f"own {i}\n", 2) for i in (1, 2, 3, 3, 4, 5)]
    assert got == sorted(want, key=str)
    assert line_dedup.without_spread_lines(docs.limit(0)).count() == 0


def test_line_dedup_of_different_texts_under_one_id(spark):
    rows = [(i, f"shared line\nown {i}") for i in range(4)]
    rows += [(None, "shared line\nfirst"), (None, "second\nshared line"), (None, "clean\nlines"), (50, "shared line\nthird"), (50, "fourth\nshared line"), (50, "also\nclean")]
    docs = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string")
    got = [(r["doc_id"], r["text"], r["removed_lines"]) for r in line_dedup.without_spread_lines(docs, min_sites=4).collect()]
    want = [(0, rows[0][1], 0)] + [(i, f"own {i}", 1) for i in (1, 2, 3)]
    want += [(None, "first", 1), (None, "second", 1), (None, "clean\nlines", 0), (50, "third", 1), (50, "fourth", 1), (50, "also\nclean", 0)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_decontamination(spark):
    items = [(1, " ".join(words(20, 1)) + ". " + " ".join(words(6, 2)) + "."), (2, " ".join(words(30, 3)) + "."), (3, None), (4, ""), (5, "two words"), (None, "x " * 20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    filler = " ".join(words(300, 8))
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100, filler + " " + items[0][1] + " " + filler), (101, items[1][1].upper()), (102, filler), (103, " ".join(words(20, 1)) + " " + filler), (104, items[0][1] + " " + items[1][1]), (None, items[1][1])]
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(documents(spark, rows), bench).collect()}
    assert got == {(5, 5), (100, 1), (101, 2), (104, 1), (104, 2), (None, 2)}
    assert {r["doc_id"] for r in decontamination.decontaminated(documents(spark, rows), bench).collect()} == {r[0] for r in rows} - {5, 100, 101, 104, None}
    assert decontamination.contaminated(documents(spark, rows), bench.limit(0)).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = [v.tolist() for v in rng.normal(size=(400, 16)) * rng.uniform(0.2, 2, (400, 1))]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(400 + i, vectors[0]) for i in range(60)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [1.0]), (None, vectors[1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cell long")
    out: dict[int, list] = {}
    for r in nearest.nearest(df, F.col("vec_id") % 10 == 0, k=5).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = {i: np.array(v) for i, v in rows[:460]}
    assert set(out) == {i for i in good if i % 10 == 0}
    hit = 0
    for q, found in out.items():
        found.sort()
        best = sorted((-round(float(good[q] @ v), 9), i) for i, v in good.items() if i != q)[:5]
        assert [r for r, *_ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - good[q] @ good[i]) < 1e-9 for _, i, s in found)
        hit += len({i for _, i in best} & {i for _, i, _ in found})
    assert hit / (5 * len(out)) >= 0.9
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_decontamination_of_rows_and_of_copies_with_inserted_words(spark):
    question, answer, extra = words(40, 41), words(10, 42), words(10, 43)
    bench = spark.createDataFrame([(1, " ".join(question) + ". " + " ".join(answer) + ".")], "item_id long, text string")
    copy = question[:20] + extra + question[20:] + answer
    rows = [(i, " ".join(words(i, 44) + copy + words(100, 45))) for i in range(130)]
    found = {r["doc_id"] for r in decontamination.contaminated(documents(spark, rows), bench).collect()}
    assert found == set(range(130))
    same_id = [(7, rows[7][1]), (7, "clean text"), (8, "clean too"), (7, None)]
    left = decontamination.decontaminated(documents(spark, same_id), bench).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in left) == [(7, ""), (7, "clean text"), (8, "clean too")]


def _plain_nearest(vectors: dict[int, np.ndarray], asking, k: int) -> list[tuple]:
    ids, x = np.array([*vectors]), np.stack([*vectors.values()])
    out = []
    for q in asking:
        scores = x @ vectors[q]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out += [(q, r + 1, int(ids[i]), round(float(scores[i]), 6)) for r, i in enumerate(best)]
    return sorted(out)


def test_nearest_in_rounds_over_many_blocks(spark, monkeypatch):
    """Skewed norms, blocks of 50 that meet the queries in five rounds, several tasks a block."""
    monkeypatch.setattr(nearest, "BLOCK", 50)
    monkeypatch.setattr(nearest, "QUERIES", 30)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 32))
    vectors *= np.where(np.arange(600) % 200 == 7, 1000.0, rng.uniform(0.9, 1, 600))[:, None] / np.linalg.norm(vectors, axis=1)[:, None]
    vectors[300:340] = vectors[2]  # ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in nearest.nearest(df, F.col("vec_id") % 2 == 0, k=5).collect())
    assert got == _plain_nearest(dict(enumerate(vectors)), range(0, 600, 2), 5)


def test_nearest_later_rounds_report_what_is_no_worse(spark):
    import pandas as pd

    rng = np.random.default_rng(9)
    x, q = rng.normal(size=(3000, 16)), rng.normal(size=(4, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    search = nearest._searcher(6, nearest.Hashing(16, [1.0], 6, 8, 2.0), nearest.probe_sets(8, 40))
    bound = np.sort(q @ x.T, axis=1)[:, -3]
    found = search(pd.DataFrame({"cid": np.arange(3000), "vector": list(x), "within": 0}), pd.DataFrame({"qid": np.arange(4), "vector": list(q), "bound": bound}))
    assert set(zip(found.qid, found.cid)) <= {(i, c) for i in range(4) for c in np.flatnonzero(x @ q[i] >= bound[i] - 1e-9)}
    assert len(found) and (found.groupby("qid").size() <= 3).all()


def test_nearest_finds_most_and_scores_a_part():
    """Production values on the hardest case, a block of vectors without any structure."""
    import pandas as pd

    x = np.random.default_rng(3).normal(size=(nearest.BLOCK, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    hashing = nearest.Hashing(x.shape[1], [float(np.linalg.norm(x, axis=1).max())], nearest.TABLES, nearest.COORDINATES, nearest.CELL)
    search = nearest._searcher(20, hashing, nearest.probe_sets(nearest.COORDINATES, nearest.PROBES))
    asking = np.arange(0, len(x), 100)
    found = search(pd.DataFrame({"cid": np.arange(len(x)), "vector": list(x), "within": 0}), pd.DataFrame({"qid": asking, "vector": list(x[asking]), "bound": -np.inf}))
    best = np.argsort(-(x[asking] @ x.T), axis=1)[:, :20]
    recall = np.mean([np.isin(b, found.cid[found.qid == q]).mean() for q, b in zip(asking, best)])
    share = found.groupby("qid").scored.first().mean() / len(x)
    assert recall >= 0.9 and share <= 0.6, (recall, share)


def test_nearest_of_a_small_table_is_whole(spark):
    vectors = np.random.default_rng(6).normal(size=(15, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in nearest.nearest(df, F.lit(True)).collect()}
    assert found == {(i, j) for i in range(15) for j in range(15) if i != j}


def test_license_scan(spark):
    notice = license_scan.NOTICES["Apache-2.0"][0]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, "x " * 50 + notice.upper() + " y" * 20), (101, notice), (102, "licensed under the apache"), (101, notice)]
    got = [(r["doc_id"], r["license"], r["containment"], r["first_word"]) for r in license_scan.scan(documents(spark, rows)).collect()]
    assert sorted(got) == [(100, "Apache-2.0", 1.0, 50), (101, "Apache-2.0", 1.0, 0)]
    plan = license_scan.scan(documents(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert license_scan.scan(documents(spark, [])).count() == 0


def test_license_scan_counts_scattered_runs_of_long_texts(spark):
    """Every run alone is retrieved, at odd and even places, and the parts of a text count together."""
    short = license_scan.template_words(license_scan.NOTICES["MIT"][0])
    notice = license_scan.template_words(license_scan.NOTICES["CC-BY-4.0"][0])
    half = len(notice) // 2
    parts = notice[:half + 2] + words(20_001, 90) + notice[half - 2:]
    rows = [(i, " ".join(words(i, 91) + short + words(i % 3, 92))) for i in range(40)] + [(None, " ".join(parts)), (50, " ".join(notice[:half]))]
    got = sorted((r["doc_id"] is None, r["doc_id"], r["license"], r["first_word"]) for r in license_scan.scan(documents(spark, rows)).collect())
    assert got == [(False, i, "MIT", i) for i in range(40)] + [(True, None, "CC-BY-4.0", 0)]
    assert got and license_scan.scan(documents(spark, rows), containment=1.0).count() == 41


def test_language_id(spark):
    out = language_id.language_id(spark.read.parquet(f"{SF}/documents.parquet"))
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in out.collect() if r["held_out"]]
    assert held and sum(r["lang_pred"] == true[r["doc_id"]] for r in held) / len(held) > 0.95
    odd = language_id.language_id(documents(spark, [(i, t) for i, t in enumerate(ODD)])).collect()
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {0, 1, 2, 3}
    assert all(0 <= r["score"] <= 1 for r in odd)
    none = documents(spark, [(1, "text")]).withColumn("lang", F.lit(None).cast("string"))
    assert language_id.language_id(none).first()["lang_pred"] == "und"
    assert language_id.language_id(documents(spark, [])).count() == 0


def test_language_models_hold_all_grams(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(6000)), lang) for i, lang in enumerate(["xx"] * 45 + ["yy"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "ENTRIES", 50_000)  # several files per table
    model = language_id.train(docs)
    assert model.languages == ["xx", "yy"]
    for lang, found in zip(model.languages, model.models):
        grams, _, _ = language_id.characters([t for _, t, own in rows if own == lang])
        distinct, counts = np.unique(grams, return_counts=True)
        assert lang == "yy" or len(distinct) > 200_000
        want = language_id.KneserNey(distinct, counts)
        asked = np.concatenate([distinct, distinct + np.uint64(1)])
        assert found.floor == want.floor and np.allclose(found.log_probability(asked), want.log_probability(asked), rtol=1e-5)
    assert max(len(t.files) for t in model.models[0].shares) > 1


def test_kneser_ney_sums_to_one():
    grams, _, _ = language_id.characters(["the cat and the hat", "a dog"])
    model = language_id.KneserNey(*np.unique(grams, return_counts=True))
    letters = np.unique(grams & np.uint64(0xFFFF))
    for context in np.unique(grams >> np.uint64(16)):
        chance = np.exp(model.log_probability((context << np.uint64(16)) | letters)).sum() + model.floor * 0
        assert 0.9 < chance <= 1 + 1e-9


def test_toxicity_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    true = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in toxicity.toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in true]
    clean, toxic = ([r for r in held if true[r["doc_id"]] == k] for k in (0, 1))
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.02
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.5
    assert np.mean([r["score"] for r in toxic]) > np.mean([r["score"] for r in clean]) + 0.3
    odd = toxicity.toxicity(documents(spark, [(i, t) for i, t in enumerate(ODD)]), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and all(r["predicted"] == 0 for r in odd)


def test_lines_of_tables_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"shared line\nown {i}", f"s{i}", 1, 2, 3, 4, 5, 6) for i in range(4)], "doc_id long, text string, source string, hits int, n_lines int, removed_lines int, pos int, id int, n_chars int")
    got = line_dedup.without_spread_lines(docs, min_sites=4)
    assert sorted((r.doc_id, r.text, r.hits, r.n_lines, r.removed_lines) for r in got.collect()) == [(0, "shared line\nown 0", 1, 2, 0)] + [(i, f"own {i}", 1, 2, 1) for i in (1, 2, 3)]
    import corpus_pipeline

    kept = corpus_pipeline.drop_boilerplate(spark, docs, SF)
    assert kept.columns == docs.columns and {r.n_lines for r in kept.collect()} == {2}


def test_near_duplicates_go_by_row(spark):
    """Different texts of one id, rows without id, equal rows, blank rows, clashing names."""
    import corpus_pipeline

    t, u, v = (" ".join(words(30, k)) for k in (1, 2, 3))
    near = " ".join([*t.split()[:-1], "changed"])
    rows = [(1, t), (5, t), (5, u), (None, v), (None, v), (7, v), (None, near), (8, None), (9, ""), (9, ""), (None, None), (6, "lone text"), (6, "lone text")]
    docs = documents(spark, rows)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    want = [(1, t), (5, u), (7, v), (8, None), (9, ""), (None, None), (6, "lone text")]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_stars_of_edited_copies_match_brute_force(spark):
    """One original, families of copies with shared and with own edits, and a phrase in all."""
    rng = random.Random(9)
    phrase, base = words(12, 50), words(60, 51)
    texts = [base + phrase]
    for family in range(6):
        edit = words(5, 60 + family)
        for k in range(12):
            text = list(base)
            at = 8 * family
            text[at:at + 5] = edit
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(60)] = words(1, rng.randrange(10**6))[0]
            texts.append(text + phrase)
    texts += [words(40, 200 + k) + phrase for k in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[i:i + 4]) for i in range(len(t) - 3)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert len(set(got.values())) > 35


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert ids and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    held = {r["doc_id"] for r in decontamination.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert not ids & held
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "best_fit_packing"]



def test_license_scan_has_independent_permutations():
    """Every band is a permutation of its own, odd ones the reverse of the one before."""
    bands, values = 2 * len(license_scan.FACTORS), [*range(1, 2_000_000_000, 1_234_567)]
    assert bands >= 16
    orders = {tuple(sorted(values, key=lambda v: license_scan.permuted(v, b))) for b in range(bands)}
    assert len(orders) == bands
    for b in range(0, bands, 2):
        assert all(license_scan.permuted(v, b) + license_scan.permuted(v, b + 1) == license_scan.LOW for v in values)



def test_language_limits_come_from_all_texts(spark):
    """One odd text in a thousand and more moves the limit, wherever its id falls."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(8)), "xx") for i in range(4000)]
    rows += [(None, "".join(rng.choice("vwxyz") for _ in range(40)), "xx") for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    entropy, _ = model.entropies([t for _, t, _ in rows])
    want = np.quantile(entropy[:, 0], 1 - language_id.REJECTED) + language_id.ROOM
    assert abs(model.limits[0] - want) < 1e-2
    assert language_id.identify(docs, model).where("NOT accepted").count() == 0



def test_every_place_of_a_repeated_passage_is_linked(spark):
    """A text that holds a passage twice, far apart, whatever the order of the two texts' numbers."""
    rows = []
    for i in range(12):
        passage = words(100, 9000 + i)
        rows += [(2 * i, " ".join(words(30, 9100 + i) + passage + words(600, 9200 + i) + passage + words(30, 9300 + i))), (2 * i + 1, " ".join(words(50, 9400 + i) + passage + words(20, 9500 + i)))]
    out = substring_dedup.repeated_passages(documents(spark, rows)).collect()
    got = {(r["doc_id"], r["first_word"], r["n_words"], r["other_id"], r["other_first_word"]) for r in out if r["doc_id"] < r["other_id"]}
    assert got == {(2 * i, at, 100, 2 * i + 1, 50) for i in range(12) for at in (30, 730)}


def test_stages_hand_texts_over_in_short_batches(spark, monkeypatch):
    """Whole texts go to Python by bytes, not by 10,000 rows; a session's own limit stays."""
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    docs = documents(spark, [(i, "x" * 50_000) for i in range(400)]).coalesce(1)
    monkeypatch.setattr(corpus_pipeline.packing, "packed_documents", lambda docs, *_, **__: docs)
    corpus_pipeline.pack(spark, docs, "")
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    assert max(r["n"] for r in sizes.collect()) < 100
    spark.conf.set(name, "9m")
    corpus_pipeline.pack(spark, docs, "")
    assert spark.conf.get(name) == "9m"
    spark.conf.unset(name)


def test_few_fragments_are_gathered_at_a_time():
    """What a task gathers is concatenated, sorted and sent: some ten arrays of that many numbers."""
    assert 10 * 8 * jaccard_join.GATHER <= 32 << 20


def test_shuffle_files_go_with_the_write(spark):
    """A written table leaves no shuffle files behind, and the session's setting stays."""
    from ledgerspark.session import written

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        return {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_") and f.endswith(".data")}

    before, was = kept(), spark.conf.get(name)
    table = written(spark.range(10_000).repartition(3, "id"))
    for _ in range(50):
        if not kept() - before:
            break
        time.sleep(0.1)
    assert not kept() - before
    assert table.count() == 10_000 and spark.conf.get(name) == was


def test_passages_of_texts_that_repeat_themselves(monkeypatch):
    """Parts of a text with the same values are looked for in the other text once, and counted without sorting."""
    rng, calls = np.random.default_rng(4), []
    cycle = np.arange(31)
    x, y = (np.tile(np.concatenate([cycle[:k], 100 * k + np.arange(6), cycle[k:]]), 60) for k in (10, 20))
    real = substring_dedup._verified
    monkeypatch.setattr(substring_dedup, "_verified", lambda *args: calls.append(1) or real(*args))
    assert substring_dedup.verified_passages(x, y) == []
    assert len(calls) <= 5, len(calls)
    for _ in range(200):  # every row that is named has the similarity of its two sets
        x = rng.integers(0, 200, 150)
        y = np.where(rng.random(150) < 0.04, rng.integers(300, 400, 150), x)
        for s, e, t, f, value in substring_dedup.verified_passages(x, y):
            a, b = set(x[s:e + 1].tolist()), set(y[t:f + 1].tolist())
            assert value == len(a & b) / len(a | b) >= substring_dedup.SIMILARITY


def test_rows_that_come_repeatedly_are_cut_once(spark):
    passage = words(80, 41)
    rows = [(1, " ".join(words(30, 42) + passage))] * 40 + [(1, " ".join(words(90, 43)))] * 3 + [(2, " ".join(passage + words(25, 44)))] * 30 + [(3, " ".join(words(200, 45)))]
    out = substring_dedup.repeated_passages(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["first_word"], r["n_words"], r["other_id"], r["other_first_word"]) for r in out) == [(1, 30, 80, 2, 0), (2, 0, 80, 1, 30)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_new_pieces_are_encoded_a_few_at_a_time(monkeypatch, name):
    """No string that is given to the library grows with the pieces of a slice; ids are the library's."""
    import public_tokenizers

    monkeypatch.setattr(tokens, "LEARN", 7)
    encoder, given = tokens.Encoder(public_tokenizers.path(name)), []
    real = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: given.append(len(text)) or real(text))
    texts = [" ".join(words(150, 70 + i)) + "\n" + " ".join(words(90, 80 + i)).title() for i in range(4)]
    out = encoder.encode(texts)
    assert max(given) <= 7 * (3 + max(len(w) for t in texts for w in t.split()))
    for text, ids in zip(texts, out):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_stages_read_whole_texts_a_few_rows_at_a_time(spark, monkeypatch):
    """Parquet's reader holds 512 rows at a time in the stages; a session's own number stays."""
    import corpus_pipeline

    name = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.unset(name)
    monkeypatch.setattr(corpus_pipeline.packing, "packed_documents", lambda docs, *_, **__: docs)
    try:
        corpus_pipeline.pack(spark, documents(spark, []), "")
        assert spark.conf.get(name) == "512"
        spark.conf.set(name, 1000)
        corpus_pipeline.pack(spark, documents(spark, []), "")
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.unset(name)
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_freed_memory_of_a_batch_goes_back_to_the_system():
    # The executor counts what an idle worker keeps; the last small array held 200 MB of freed ones in place.
    script = r"""
import re, numpy as np, pyarrow as pa
from ledgerspark.llm.hashing import slices

def held():
    return int(re.search(r"Private_Dirty:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

begin = held()
for rows in slices(pa.RecordBatch.from_pydict({"text": ["a b"] * 10})):
    arrays = [np.ones(12_500) for _ in range(2_000)]
    last = arrays[-1]
    del arrays
print(held() - begin)
"""
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", script], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 60


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_full_store_keeps_the_pieces_that_come_again(name):
    often = [f"ever{i}" for i in range(60)]
    runs = [[" ".join([*often, *(f"once{run}x{i}" for i in range(80))])] for run in range(20)]
    small, whole = tokens.Encoder(vocabulary(name), most=200), Tokenizer.from_file(vocabulary(name))
    learnt, learn = [], small._learn
    small._learn = lambda hashes, pieces: (learnt.extend(pieces), learn(hashes, pieces))
    for texts in runs:
        assert np.frombuffer(small.encode(texts)[0], "<u4").tolist() == whole.encode(texts[0], add_special_tokens=False).ids
        assert len(small.store) <= 200
    assert len(learnt) < 20 * 80 + 5 * len(often)  # a store begun anew learns all of them about ten times
    # Too many that come again: begun anew, with the same ids.
    tiny = tokens.Encoder(vocabulary(name), most=100)
    assert [tiny.encode(t) for t in runs * 2] == [small.encode(t) for t in runs * 2]


@pytest.mark.parametrize("block", [512, 7])
def test_all_texts_that_hold_a_passage_are_linked(spark, monkeypatch, block):
    """Every two of them, also where some are edited, and whatever the number of blocks."""
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    rows = []
    for i in range(30):
        passage = words(70, 8000)
        if i % 3 == 0:
            passage[35] = f"edit{i}"
        rows.append((i, " ".join(words(20 + 3 * i, 8100 + i) + passage + words(40 + i, 8200 + i))))
    out = substring_dedup.repeated_passages(documents(spark, rows + rows[:5])).collect()
    got = {(r["doc_id"], r["first_word"], r["n_words"], r["other_id"], r["other_first_word"]) for r in out}
    assert got == {(i, 20 + 3 * i, 70, k, 20 + 3 * k) for i in range(30) for k in range(30) if i != k}
    assert len(out) == len(got)


def test_passages_of_many_pairs_are_those_of_each():
    """Stretches that are the same, edited ones, repeated runs, empty sides, all numbered together."""
    rng, xs, ys = np.random.default_rng(8), [], []
    for k in range(600):
        base = rng.integers(0, 1 << 32 if k % 5 else 60, rng.integers(20, 150))
        copy = np.where(rng.random(len(base)) < (0, 0.02, 0.1)[k % 3], rng.integers(0, 1 << 32, len(base)), base)
        ends = [rng.integers(0, 1 << 32 if k % 7 else 80, n) for n in rng.integers(0, 60, 4)]
        xs.append(np.concatenate([ends[0], base, ends[1]])[: 0 if k % 50 == 9 else None].astype("<u4"))
        ys.append(np.concatenate([ends[2], copy, ends[3], *([base[:60]] if k % 11 == 0 else [])])[: 0 if k % 40 == 3 else None].astype("<u4"))
    found = substring_dedup.passages_of(xs, ys)
    assert sum(map(len, found)) > 300
    for x, y, passages in zip(xs, ys, found):
        of, number = np.unique(np.concatenate([x, y]), return_inverse=True)
        before = [np.array([max((j for j in range(i) if z[j] == z[i]), default=-1) for i in range(len(z))], np.int64) for z in (x, y)]
        assert passages == substring_dedup._passages_of_pair(len(of), number[:len(x)], number[len(x):], *before)
