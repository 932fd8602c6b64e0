"""Packing into windows, the Merkle manifest and hard negatives, each against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopledger.llm import hard_negatives, merkle, window_packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")
# Columns besides the documents' own have names that the operators use inside.
DOC = "doc_id long, text string, lang string, source string, n_chars int, tree string, row string, part int, length string, ids string"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "t", "r", 7, "x", "y") for r in rows], DOC)


def _best_fit(lengths: list[int], size: int) -> list[int]:
    """Room left in each window when pieces are placed one by one."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else size) - n)
    return sorted(rooms)


def test_tightest_room():
    pick = random.Random(2)
    for size in (1, 2, 7, 16, 33):
        rooms, held = window_packing.Rooms(size), collections.Counter()
        for _ in range(200):
            room = pick.randint(0, size)
            change = pick.choice((1, 3)) if not held[room] else pick.choice((1, -held[room]))
            rooms.add(room, change)
            held[room] += change
            need = pick.randint(0, size)
            assert rooms.tightest(need) == min((r for r, n in held.items() if n and r >= need), default=None)


def test_plan_equals_placing_one_by_one():
    pick = random.Random(1)
    for _ in range(150):
        size = pick.choice((7, 16, 64, 100))
        lengths = [pick.randint(1, pick.choice((size, size // 2))) for _ in range(pick.randint(0, 150))]
        counts, used, numbers = collections.Counter(lengths), collections.defaultdict(list), collections.defaultdict(list)
        for p in window_packing.plan(counts, size):
            for k, n in enumerate(range(p.first, p.end)):
                used[p.window + k // p.each].append((p.offset + k % p.each * p.length, p.length))
                numbers[p.length].append(n)
        assert {n: sorted(v) for n, v in numbers.items()} == {n: list(range(c)) for n, c in counts.items()}
        for held in used.values():
            ends = np.cumsum([0, *(n for _, n in sorted(held))]).tolist()
            assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= size
        assert sorted(size - sum(n for _, n in held) for held in used.values()) == _best_fit(lengths, size)


def _packed_texts():
    pick = random.Random(4)
    words = ["alpha", "béta", "日本", "x", "\n\n", "don't", "<|endoftext|>", "12"]
    texts = [" ".join(pick.choices(words[:2] + words[3:4], k=pick.randint(1, 30))) for _ in range(40)]
    return [None, "", "a", *texts, " ".join(pick.choices(words, k=400)), "z" * 9000, *["same text here"] * 25]


def test_windows_hold_every_token_once(spark):
    texts, size = _packed_texts(), 64
    docs = _docs(spark, [(None if i % 9 == 4 else i, t, None, "s", None) for i, t in enumerate(texts)])
    library = Tokenizer.from_file(BYTES)
    want = collections.Counter()
    for i, t in enumerate(texts):
        want[None if i % 9 == 4 else i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    placed = window_packing.packed_documents(docs.repartition(5), vocabulary=BYTES, end_id=1, size=size)
    rows = placed.collect()
    windows, lengths = collections.defaultdict(list), []
    known, unnamed = collections.defaultdict(list), collections.Counter()
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and (r["length"] == size or r["start"] + r["length"] == r["doc_tokens"])
        windows[r["sequence_id"]].append((r["offset"], ids))
        lengths.append(len(ids))
        if r["doc_id"] is not None:
            known[r["doc_id"]].append((r["start"], ids))
        else:
            unnamed[r["start"], tuple(ids), r["doc_tokens"]] += 1
    for (name, ids), n in want.items():
        if name is not None:
            assert sum((part for _, part in sorted(known[name])), []) == list(ids)
        else:
            for at in range(0, len(ids), size):
                unnamed[at, ids[at : at + size], len(ids)] -= n
    assert not any(unnamed.values())
    for held in windows.values():
        ends = np.cumsum([0, *(len(ids) for _, ids in sorted(held))]).tolist()
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= size
    assert sorted(size - sum(len(ids) for _, ids in held) for held in windows.values()) == _best_fit(lengths, size)

    whole = {r["sequence_id"]: r for r in window_packing.sequences(placed).collect()}
    # Two computations may number alike pieces differently, but the windows' sizes stay.
    assert sorted(r["n_tokens"] for r in whole.values()) == sorted(sum(len(i) for _, i in h) for h in windows.values())
    assert all(len(r["ids"]) == 4 * r["n_tokens"] and r["starts"][0] == 0 for r in whole.values())


def test_window_report_has_digests(spark):
    docs = _docs(spark, [(i, t, None, None, None) for i, t in enumerate(_packed_texts())])
    library = Tokenizer.from_file(BYTES)
    rows = window_packing.packing_report(docs, vocabulary=BYTES, end_id=1, size=64).collect()
    for r in rows:
        ids = [*library.encode(_packed_texts()[r["doc_id"]] or "", add_special_tokens=False).ids, 1]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert (zlib.crc32(part.tobytes()), len(ids)) == (r["ids_crc32"], r["doc_tokens"])
    empty = window_packing.packing_report(docs.limit(0), vocabulary=BYTES, end_id=1, size=64)
    assert empty.count() == 0 and empty.schema["length"].dataType.simpleString() == "bigint"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    steps: list[list[tuple[str, str]]] = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for k, (_, under) in enumerate(run):
                for i in under:
                    steps[i].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            above.append((_sha("".join(d for d, _ in run)), [i for _, under in run for i in under]))
        nodes = above
    return nodes[0][0], steps


def _audit(rows: list[tuple]) -> list[tuple]:
    """What ``audited`` gives for (doc_id, text, lang, source, n_chars) rows."""

    def leaf(r, text):
        values = (r[0], r[3], r[2], r[4], text)
        return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[3]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    made = [_tree([leaf(r, r[1]) for r in trees[name]]) for name in names]
    root, tops = _tree([subroot for subroot, _ in made])
    out = []
    for name, (subroot, steps), top in zip(names, made, tops, strict=True):
        for r, step in zip(trees[name], steps, strict=True):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf(r, text)
            for left, right in (*step, *top):
                now = _sha(left + now + right)
            proof = _sha("".join(left + right for left, right in (*step, *top)))
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, now, now == root))
    return out


def test_manifest_equals_one_tree_built_in_memory(spark):
    pick = random.Random(6)
    texts = [None, "", "Plain Text", "ÄÖ É", "日本 A", "x" * 5000]
    rows = [(i, pick.choice(texts), pick.choice(("en", None)), "hot", i) for i in range(700)]
    rows += [(i, "Some T", "en", f"s{i % 40}", None) for i in range(700, 1000)]
    rows += [(None, pick.choice(texts), None, pick.choice((None, "hot")), 1) for _ in range(300)]
    rows += [(5, "Twice", "en", "hot", 1), (5, "Other", "en", "hot", 1), (7, "A", None, None, 2), (8, "A", "en", "", 2), (9, "A", "en", "é", 2)]
    rows += [rows[0]] * 300
    got = merkle.audited(_docs(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_audit(rows), key=repr)
    assert any(r["verified"] for r in got) and any(not r["verified"] for r in got)
    assert merkle.audited(_docs(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 255, 256, 257, 4096 + 17])
def test_manifest_of_one_source_of_any_size(spark, n):
    rows = [(i, f"T{i}", "en", "only", i) for i in range(n)]
    got = merkle.audited(_docs(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(_audit(rows))


def test_witnesses_grow_as_siblings_complete():
    tree = merkle.Appender()
    witnesses = [tree.append(_sha(str(i))) for i in range(20)]
    # The first run is complete, the second open.
    assert [len(w) for w in witnesses] == [1] * 16 + [0] * 4
    root, steps = _tree([_sha(str(i)) for i in range(20)])
    assert tree.finish(2) == root and witnesses == steps


def test_witness_columns(spark):
    rows = [(i, "a", "en", f"s{i % 3}", 1) for i in range(50)]
    docs = _docs(spark, rows)
    leaf = merkle.leaf_digest(F.col("doc_id"))
    found = merkle.manifest(docs, tree=F.col("source"), order=[F.col("doc_id")], leaf=leaf, carried=[F.col("doc_id"), F.col("row")])
    assert found.columns == ["doc_id", "row", "leaf", "subroot", "root", "witness"]
    assert found.where(merkle.folded(F.col("leaf"), F.col("witness")) != F.col("root")).count() == 0
    assert found.where(merkle.folded(merkle.leaf_digest(F.lit(1)), F.col("witness")) == F.col("root")).count() == 1


VEC = "vec_id long, embedding array<float>, label int, row string, block string, score string"


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, "r", "b", "s") for r in rows], VEC)


def _mine(rows: list[tuple], every: int) -> list[tuple]:
    """What ``mined`` gives for (vec_id, vector, label) rows with vectors of one length."""
    good = [r for r in rows if None not in r and r[1] and None not in r[1] and np.isfinite(r[1]).all()]
    ids = np.array([r[0] for r in good], dtype=np.int64)
    labels = np.array([(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in good])
    q = np.floor(256 * np.array([r[1] for r in good], dtype=np.float32).astype(np.float64)).astype(np.int64)
    out = []
    for a in np.flatnonzero(ids % every == 0):
        scores = q @ q[a]
        order = np.lexsort((ids, -scores))
        for p in [p for p in order if p != a and labels[p] == labels[a]][:5]:
            s = int(scores[p])
            fits = [n for n in order if labels[n] != labels[a] and 80 * s <= 100 * int(scores[n]) <= 100 * s][:5]
            out += [(ids[a], ids[p], k + 1, ids[n], s, scores[n]) for k, n in enumerate(fits)]
    return sorted(tuple(map(int, o)) for o in out)


def _clustered(n: int, dims: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(12, dims))
    which = draw.integers(0, 12, n)
    vectors = (middles[which] + draw.normal(scale=0.3, size=(n, dims))) * draw.uniform(0.1, 3, size=(n, 1))
    return [(i, v.astype(np.float32).tolist(), int(draw.integers(0, 10))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("block_rows", [16_384, 40])
def test_negatives_equal_scoring_everything(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    rows = _clustered(900, 12, 1)
    # A third of all rows are one vector; some share a vec_id, some are zero or opposite.
    rows += [(1000 + i, rows[0][1], i % 10) for i in range(450)]
    rows += [(40, rows[3][1], 2), (40, rows[3][1], 2), rows[6], (1500, [0.0] * 12, 1), (1520, [0.0] * 12, 1), (1501, [0.0] * 12, 2)]
    rows += [(1540, [-x for x in rows[0][1]], 3), (None, rows[1][1], 1), (1560, None, 1), (1580, rows[1][1], None)]
    rows += [(1600, [float("nan"), *[1.0] * 11], 1), (1620, [float("inf"), *[1.0] * 11], 1), (1640, [None, *[1.0] * 11], 1), (1660, [], 1)]
    odd = [(1680, [1.0, 2.0], 1), (1700, [1e30] * 12, 1)]
    got = hard_negatives.mined(_vectors(spark, rows + odd), every=20).collect()
    assert sorted(map(tuple, got)) == _mine(rows, 20)
    assert hard_negatives.mined(_vectors(spark, []), every=20).count() == 0


def test_large_components_are_scored_exactly(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.uniform(0, 1, 4) * 4_000_000).astype(np.float32).tolist(), i % 2) for i in range(60)]
    got = hard_negatives.mined(_vectors(spark, rows), every=10).collect()
    assert sorted(map(tuple, got)) == _mine(rows, 10) and max(r["positive_score"] for r in got) > 2**53


def test_bounds_hold_every_score():
    rows = _clustered(400, 8, 2)
    q = np.floor(256 * np.array([r[1] for r in rows]))
    directions = hard_negatives.learn(q, 5)
    norms = np.sqrt((q**2).sum(1))
    angles = np.arccos(np.clip(q @ directions.T / norms[:, None], -1, 1))
    home = angles.argmin(1)
    some = np.flatnonzero(home == home[0])
    own = angles[some, home[0]]
    bands = hard_negatives.Bands(
        np.array([home[0]]), np.array([(own.min(), own.max())]), np.array([(norms[some].min(), norms[some].max())]), np.array([1])
    )
    low, high = bands.bounds(norms, angles)
    scores = q @ q[some].T
    assert (low <= scores).all() and (scores <= high).all()
    assert high.min() < scores.max()
