"""Each operator against a brute-force version, on rows made to be awkward."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc
import zlib
from datetime import datetime

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopledger.llm import (
    hash_ring,
    html_templates,
    mixing,
    multi_index,
    ngram_join,
    packing,
    queries,
    quality_rules,
    suffix_repeats,
    token_prefix,
    url_lists,
)
from verification.compare import connect, differences

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, n string, print string, label string"


def _texts() -> list[str | None]:
    pick = random.Random(3)
    base = [pick.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(pick.randint(0, 60)) for _ in range(160)]
    near = [*base[:80], "changed", *base[81:]]
    return [
        " ".join(base), " ".join(base), " ".join(near), " ".join(base).upper(), " ".join(base[:120]), None, "", " \n ",
        "one", "one two", "one two", "a" * 700, "héé " * 90, "x\ny\nx\ny\n" + "#$ " * 60, " ".join(base * 40), "日本 語 " * 30,
    ]


def _docs(spark, texts=None):
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "n", "p", "l") for i, t in enumerate(texts or _texts())]
    return spark.createDataFrame([*rows, rows[1], (None, "one two", None, None, None, "n", "p", "l")], DOC)


def _empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.mark.parametrize(("words", "num"), [(3, 90), (5, 80)])
def test_ngram_join_finds_every_link(spark, words, num):
    sets = {}
    for i, text in enumerate(_texts()):
        w = _WORD.findall((text or "").encode().lower())
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    got = ngram_join.near_groups(_docs(spark), words=words, num=num, den=100).collect()
    want = [(i, len(sets[i]), group[i]) for i in sets]
    assert sorted(map(tuple, got), key=repr) == sorted([*want, want[1], (None, 1, None)], key=repr)
    assert ngram_join.near_groups(_empty(spark), words=words, num=num, den=100).count() == 0


def _chained(count: int) -> list[str]:
    """Texts that each differ a little from one before, in several strands."""
    pick = random.Random(8)
    strands = [[f"w{pick.randint(0, 900)}" for _ in range(90)] for _ in range(3)]
    strands.append([*strands[0][:80], *strands[1][:10]])
    texts = []
    for _ in range(count):
        words = pick.choice(strands)
        words[pick.randrange(len(words))] = f"x{pick.randint(0, 10**6)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize(("few", "crowded"), [(4, False), (0, True)])
def test_ngram_join_sends_shingles_of_crowded_buckets_only(spark, monkeypatch, few, crowded):
    """A large bucket of sets that share a passage, of which few are alike, sends the pairs that
    its sketches leave; one with more than its rows may send is searched by shingles."""
    monkeypatch.setattr(ngram_join, "PAIRS_A_ROW", few)
    monkeypatch.setattr(ngram_join, "PAIRED_ROWS", 4)
    monkeypatch.setattr(ngram_join, "PAIR_BYTES", 10**6)
    monkeypatch.setattr(ngram_join, "_near_by_sketch", lambda limit: lambda batches: (b.select(ngram_join.PAIR).slice(0, 0) for b in batches))
    cells, join = [], ngram_join._join_cells

    def joined(sent, *args):
        cells.append(sent.count())
        return join(sent, *args)

    monkeypatch.setattr(ngram_join, "_join_cells", joined)
    pick = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    texts = [" ".join([*passage, *(f"w{pick.randint(0, 10**6)}" for _ in range(40))]) for _ in range(60)]
    texts += [f"{t} again" for t in texts[:6]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.near_groups(docs, words=3, num=90, den=100).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k if k < 60 else k - 60 for k in range(66)}
    assert (cells[0] > 0) is crowded


def test_ngram_join_sends_no_pairs_of_crowded_buckets(spark):
    """Pairs grow with the rows of a bucket, not with their square: a bucket with too many
    sends its signature alone, and long texts get no more pairs a row than others."""
    most = spark.range(1, 6).select((F.col("id") * 400).alias("rows"), (F.col("id") * 400 * 20_000).alias("held"))
    most = most.select("rows", ngram_join._most_pairs().alias("most")).collect()
    assert [r["most"] for r in most] == [r["rows"] * ngram_join.PAIRED_ROWS // 2 for r in most]

    def bucket(sig, rows, most):
        sketch = [bytes(16)] * rows
        return [[sig] * rows, [100] * rows, range(1, rows + 1), range(rows), range(rows), sketch, [most] * rows]

    columns = [[*a, *b] for a, b in zip(bucket(1, 40, 160), bucket(2, 5, 40), strict=True)]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], ["sig", "n", "print", "node", "label", "sketch", "most"]
    )
    found = pa.Table.from_batches(ngram_join._near_in_buckets(ngram_join.Threshold(80, 100))(iter([batch]))).to_pylist()
    assert [r["crowded"] for r in found if r["crowded"] is not None] == [1]
    pairs = [(r["left_node"], r["right_node"]) for r in found if r["crowded"] is None]
    assert sorted(pairs) == [(a, b) for a in range(5) for b in range(a + 1, 5)]


@pytest.mark.parametrize(("paired", "cell"), [(16, 2048), (1, 3)])
def test_ngram_join_is_exact_in_buckets_of_every_size(spark, monkeypatch, paired, cell):
    monkeypatch.setattr(ngram_join, "PAIRED_ROWS", paired)
    monkeypatch.setattr(ngram_join, "CELL_ROWS", cell)
    monkeypatch.setattr(ngram_join, "PAIR_BYTES", 10**6)
    # Without stars the cells alone must find all links.
    monkeypatch.setattr(ngram_join, "_near_by_sketch", lambda limit: lambda batches: (b.select(ngram_join.PAIR).slice(0, 0) for b in batches))
    texts = _chained(120)
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)})
    group = list(range(len(sets)))
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        before = list(group)
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
        if group == before:
            break
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.near_groups(docs, words=3, num=90, den=100).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(group))
    assert 1 < len(set(group)) < len(texts)


def test_joins_connect_what_links_connect_and_no_more():
    pick = np.random.default_rng(4)
    limit = ngram_join.Threshold(80, 100)
    for _ in range(30):
        base = pick.choice(400, 60, replace=False)
        sets = [np.unique(np.append(pick.choice(base, 55, replace=False), pick.choice(400, 4))).astype(np.uint64) for _ in range(40)]
        labels = pick.integers(0, 30, 40)

        def groups(links, labels=labels):
            group = labels.copy()
            for a, b in [*links] * 40:
                group[group == max(group[a], group[b])] = min(group[a], group[b])
            return group.tolist()

        every = []
        for a in range(40):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    every.append((a, b))
        found = ngram_join.joins(sets, labels, limit)
        assert groups(found) == groups(every)
        assert {(max(p), min(p)) for p in found} <= set(every)
        assert len(found) < len(set(labels.tolist()))


def test_deletion_neighbours_hold_what_whole_segments_miss():
    pick = np.random.default_rng(1)
    limit = ngram_join.Threshold(90, 100)
    for size in (12, 40, 200):
        band = ngram_join.Band(3, size, size + 20, size - 9, 1, 0)
        needed = limit.difference(2 * size) + 1
        for deletions in range(needed // 2 + 1):
            split = ngram_join.Band(3, size, size + 20, size - 9, needed - deletions, deletions)
            for _ in range(20):
                one = np.unique(pick.integers(0, 2**64, size, dtype=np.uint64))
                two = one.copy()
                for _ in range(limit.difference(2 * size) // 2):
                    two = np.unique(np.append(np.delete(two, pick.integers(len(two))), pick.integers(0, 2**64, dtype=np.uint64)))
                both = len(np.intersect1d(one, two))
                if 100 * both >= 90 * (len(one) + len(two) - both):
                    assert len(np.intersect1d(ngram_join.signatures(one, split), ngram_join.signatures(two, split)))
        assert band.segments == 1


@pytest.mark.parametrize("hot", [suffix_repeats.HOT_ROWS, 2])
def test_repeated_strings_go_and_nothing_else(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_repeats, "HOT_ROWS", hot)
    pick = random.Random(1)
    base = "".join(pick.choice("abcdé ") for _ in range(900))

    def around(passage, before, after):
        return "".join(pick.choice("xyz") for _ in range(before)) + passage + "".join(pick.choice("uvw") for _ in range(after))

    texts = [
        "a" * 500, "a" * 199, "a" * 200, base, base[100:450], "x" * 50 + base[200:500] + "y" + base[300:520], None, "",
        base[:199], base[700:] + base[:300], ("abc" * 60 + "q") * 5, "z" + base[500:699], "é" * 150, "p" * 10 + "é" * 120,
    ]
    # A passage in most texts, each with other surroundings, some cut by one of its ends.
    texts += [around(base[300:560], pick.randrange(200), pick.randrange(200)) for _ in range(20)]
    texts += [around(base[300 + k : 560 - 2 * k], 150, 150) for k in range(0, 30, 3)]
    docs = _docs(spark, texts)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    starts = collections.Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    want = []
    for name, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if starts[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        stays = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        want.append((name, len(t), sum(gone), runs, hashlib.sha256(stays).hexdigest()))
    got = suffix_repeats.removal_report(docs, length=200).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    docs = docs.withColumnsRenamed({"n": "ranges", "print": "key"})
    cut = suffix_repeats.without_repeats(docs, length=200)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {(r["ranges"], r["key"]) for r in cut.collect()} == {("n", "p")}
    assert suffix_repeats.removal_report(_empty(spark), length=200).count() == 0


def test_repeats_hold_a_bounded_part_of_long_texts(monkeypatch):
    """One task's seeds of a long text, and the contexts it sends on, take memory by the
    piece; the seeds are those of the windows whatever the pieces."""
    pick = np.random.default_rng(2)
    text = pick.integers(97, 123, 4_000_000, dtype=np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, "short"]), pa.array([1, 2, 3])], ["text", "key"])
    tracemalloc.start()
    found = pa.Table.from_batches(suffix_repeats._seed_rows(200)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000
    monkeypatch.setattr(suffix_repeats, "PIECE_BYTES", len(text))
    whole = pa.Table.from_batches(suffix_repeats._seed_rows(200)(iter([batch])))
    assert set(found["place"].to_pylist()) == set(whole["place"].to_pylist())

    wanted = found.select(["gram", "around", "place", "before", "after"]).slice(0, 20_000)
    lists = pa.ListArray.from_arrays([0, 0, len(wanted)], wanted.to_struct_array().combine_chunks())
    bodies = [zstandard.compress(b"none"), zstandard.compress(text.encode())]
    sent = list(suffix_repeats._contexts(200)(iter([pa.RecordBatch.from_arrays([pa.array([2, 1]), pa.array(bodies), lists], ["key", "body", "wanted"])])))
    assert max(b.num_rows for b in sent) <= suffix_repeats.CONTEXTS_AT_ONCE
    rows = pa.Table.from_batches(sent)
    assert rows["gram"].to_pylist() == wanted["gram"].to_pylist()
    cut = [text[p - b : p + a].encode() for p, b, a in zip(*(wanted[c].to_pylist() for c in ("place", "before", "after")), strict=True)]
    assert rows["bytes"].to_pylist() == cut


@pytest.mark.parametrize(("piece", "few"), [(1 << 19, 15_000), (300, 3)])
def test_repeats_do_not_depend_on_pieces(spark, monkeypatch, piece, few):
    monkeypatch.setattr(suffix_repeats, "PIECE_BYTES", piece)
    for name in ("CONTEXTS_AT_ONCE", "EXPANDED_AT_ONCE", "COMPARED_AT_ONCE"):
        monkeypatch.setattr(suffix_repeats, name, few)
    pick = random.Random(4)
    base = "".join(pick.choice("abcdé ") for _ in range(2_000))
    texts = [base, base[100:900] + "x" + base[600:1500], "y" * 700, base[290:510], base[1_000:] + base, "q" + base[301:500], None]
    texts += ["".join(pick.choice("xyz") for _ in range(150)) + base[300:560] for _ in range(9)]
    rows = [(i, (t or "").encode()) for i, t in enumerate(texts)]
    starts = collections.Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    want = []
    for name, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if starts[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        stays = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        want.append((name, len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(stays).hexdigest()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    assert sorted(map(tuple, suffix_repeats.removal_report(docs, length=200).collect())) == want
    assert spark.conf.get(batch_rows) == before


def test_token_counts_are_the_library_s(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["n_tokens"] for r in token_prefix.token_counts(_docs(spark), vocabulary=path, limit=512).collect()}
    for i, text in enumerate(_texts()):
        assert got[i] == len(library.encode(text or "", add_special_tokens=False).ids)
    words = token_prefix.byte_words(path)
    for text in ("he'll  go\n\n to 'rest' 12  3!!  \n", "a<|endoftext|>b ", "日本 語", "'ll 're'", " \n \n a"):
        counts = token_prefix.prefix_counts(text, words)
        exact = [len(library.encode(text[:c], add_special_tokens=False).ids) for c in range(len(text) + 1)]
        assert [counts.of_prefix(c) for c in range(len(text) + 1)] == exact
        for budget in range(counts.total + 1):
            assert exact[counts.longest_within(budget)] <= budget
    short = token_prefix.truncated(_docs(spark), vocabulary=path, budget=5).select("text").collect()
    assert all(len(library.encode(r["text"] or "", add_special_tokens=False).ids) <= 5 for r in short)
    assert token_prefix.token_counts(_empty(spark), vocabulary=path, limit=1).count() == 0


def test_packing_is_gapless_and_tight(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(_texts())}
    rows = packing.packed_documents(_docs(spark), vocabulary=path, end_id=1, size=4096).collect()
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
    for held in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 4096
    assert len(bins) == -(-sum(n for held in bins.values() for _, n in held) // 4096)
    assert packing.packed_documents(_empty(spark), vocabulary=path, end_id=1, size=4096).count() == 0


def test_two_smaller_pieces_replace_one():
    # Greedy leaves 6 + 3 of 10; 2 + 2 fit better than 3.
    fillings = packing.plan({6: 1, 3: 1, 2: 2}, 10)
    assert fillings[0] == (1, {6: 1, 2: 2})


def test_ring_bounds_loads_and_numbers_slots(spark):
    docs = _docs(spark)
    rows = hash_ring.sharded(docs, shards=4).collect()
    counts = collections.Counter(r["shard"] for r in rows)
    assert sum(counts.values()) == docs.count() and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    text = {i: (t or "").encode() for i, t in enumerate(_texts())}
    assert all((r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]])) for r in rows if r["doc_id"] is not None)
    assert hash_ring.sharded(_empty(spark), shards=4).count() == 0
    # Another shard takes points only into itself.
    few, more = hash_ring.ring(4, 64), hash_ring.ring(5, 64)
    points = np.random.default_rng(0).integers(0, 1 << 62, 2_000)
    old, new = (r.owners[np.searchsorted(r.starts, points, side="right") - 1] for r in (few, more))
    assert set(new[old != new].tolist()) == {4}


def test_quality_counts_are_exact(spark):
    got = {r["doc_id"]: r for r in quality_rules.judged(_docs(spark)).collect()}
    for i, text in enumerate(_texts()):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert tuple(got[i][c] for c in quality_rules.COUNTS) == want
        assert got[i]["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w))
    docs = _docs(spark)
    assert quality_rules.kept(docs).columns == docs.columns
    assert quality_rules.judged(_empty(spark)).count() == 0


def test_pages_lose_furniture_and_site_templates(spark):
    page = (
        '<html><body><header>Site</header><div class="cookie-notice">ok</div><article><h1>T &amp; {n}</h1>'
        '<p>Hello <span class="ad">no</span>big&nbsp;world<br>next<div class="box">join us</div><form>f</form>'
        '<section id="comments"><p>hi</p></section><ul><li>one {n}<li>two</ul><p>same line</p></article><footer>f</footer>'
    )
    rows = [(i, f"https://h.example.com/{i}", page.replace("{n}", str(i))) for i in range(8)]
    rows += [(8, "https://h.example.com/", None), (9, None, "<p>a<p>b"), (10, "x", ""), rows[0]]
    got = html_templates.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 12 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[3] == "T & 3\n\nHello big world next\n\none 3\n\ntwo\n\nsame line"
    assert (texts[8], texts[9], texts[10]) == ("", "a\n\nb", "")
    assert html_templates.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_templates_are_counted_whatever_their_names(spark):
    def page(i, article, extra=""):
        return (i, f"http://big.example.org/{i}", f'<body><nav class="menu">all pages</nav><div class="x1">home about</div>{extra}<div><p>{article}</p></div></body>')

    # On a large host a box in five pages with other articles goes; one in copies of an article, or in four pages, stays.
    rows = [page(i, f"text {i}") for i in range(700)]
    rows += [page(1000 + i, f"more {i}", '<section class="q">join now</section>') for i in range(5)]
    rows += [page(2000 + i, "the same", "<section>own words</section>") for i in range(9)]
    rows += [page(3000 + i, f"other {i}", "<section>in four</section>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    subtrees: dict[int, set[str]] = collections.defaultdict(set)
    for _, _, source in rows:
        found = html_templates.parse(source)
        article = [text for text, region, _ in found.blocks if region]
        for number, value in found.hashes.items():
            within = [text for text, region, inside in found.blocks if region and number in inside]
            if any(number in inside for _, _, inside in found.blocks):
                subtrees[value].add(repr([t for t in article if t not in within]))
    want = {value for value, others in subtrees.items() if len(others) >= html_templates.LEAST_PAGES}
    assert len(want) == 3
    assert sorted(map(tuple, html_templates.site_templates(pages).collect())) == sorted(("big.example.org", v) for v in want)
    texts = {r["page_id"]: r["text"] for r in html_templates.extracted(pages).collect()}
    assert texts[3] == "text 3" and texts[1002] == "more 2"
    assert texts[2001] == "own words\n\nthe same" and texts[3001] == "in four\n\nother 1"


def test_urls_are_judged_by_the_lists_of_their_time(spark):
    def day(n):
        return datetime(2024, 1, n)

    entries = spark.createDataFrame(
        [("block", "example.com", "add", day(2)), ("block", "example.com", "remove", day(5)), ("block", "example.com", "remove", day(6)),
         ("allow", "a.example.com", "add", day(3)), ("block", "a.example.com/x", "add", day(4)), ("block", None, "add", day(1))],
        "list string, pattern string, action string, dated timestamp",
    )
    asked = [("http://www.example.com/", 1), ("http://www.EXAMPLE.com:80/", 2), ("http://example.com", 5), ("https://a.example.com/y", 3),
             ("https://a.example.com/x/z?q", 4), ("https://a.example.com/xx", 4), ("nonsense", 3), (None, 3)]
    captures = spark.createDataFrame([(i, u, day(d)) for i, (u, d) in enumerate(asked)], "page_id long, url string, fetched_at timestamp")
    got = {r["page_id"]: r["verdict"] for r in url_lists.judged(captures, entries).collect()}
    assert [got[i] for i in range(8)] == ["pass", "block", "pass", "allow", "block", "allow", "unknown", "unknown"]
    assert url_lists.judged(captures.limit(0), entries).count() == 0
    clashing = captures.selectExpr("*", "'own' AS active", "page_id AS best", "'p' AS patterns", "'h' AS host", "'x' AS list", "'_' AS _path")
    out = url_lists.judged(clashing, entries)
    assert out.columns == ["page_id", "url", "fetched_at", "active", "best", "patterns", "list", "_path", "host", "n_active", "verdict", "pattern"]
    rows = out.collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == got
    assert all((r["active"], r["best"], r["patterns"], r["host"]) == ("own", r["page_id"], "p", r["host"]) and r["host"] != "h" for r in rows)


def test_mixture_meets_its_targets(spark):
    pick = random.Random(0)
    kinds = {0: "good fine neat", 1: "meh dull bland", 2: "vile nasty rude"}
    rows, marks = [], []
    for i in range(300):
        kind = pick.choice((0, 0, 0, 1, 2))
        rows.append((i, " ".join(pick.choice((*kinds[kind].split(), "the", "of")) for _ in range(40))))
        if i % 2:
            marks.append((i, int(kind == 0), int(kind == 2)))
    docs = spark.createDataFrame([*rows, (None, None), rows[0]], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (5, None, 1), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    out = mixing.mixed(docs, labels, targets=[0.7, 0.2, 0.1]).toPandas()
    total = out["tokens"].sum()
    reached = [(out["tokens"] * out["rate"] * out[f"p_{d}"]).sum() / total for d in mixing.DOMAINS]
    assert len(out) == 302 and (out["rate"] >= 0).all() and np.allclose(reached, [0.7, 0.2, 0.1], atol=2e-3)
    truth = {m[0]: m for m in marks}
    held = [r for r in out.itertuples() if r.doc_id == r.doc_id and int(r.doc_id) not in truth]
    text = dict(rows)
    right = [max(mixing.DOMAINS, key=lambda d, r=r: getattr(r, f"p_{d}")) == ("high" if "good" in text[int(r.doc_id)] else "low" if "dull" in text[int(r.doc_id)] else "toxic") for r in held]
    assert np.mean(right) > 0.9
    assert mixing.mixed(docs.limit(0), labels, targets=[0.7, 0.2, 0.1]).count() == 0


@pytest.mark.parametrize("wanted", [[0.7, 0.2, 0.1], [0.8, 0.15, 0.05], [0.1, 0.1, 0.9], [0.98, 0.02, 0.0]])
def test_rates_equal_nonnegative_least_squares(spark, wanted):
    """Against projected gradient steps on every document's rate, in memory; the last
    targets cannot be met, since every document is a little toxic."""
    draw = np.random.default_rng(3)
    grid = np.rint(draw.dirichlet((2.0, 1.0, 0.6), 400) * 0.97 * mixing.GRID + 0.01 * mixing.GRID).astype(int)
    tokens = draw.integers(1, 50, 400)
    rows = [(i, int(t), g.tolist(), bytes([i % 256])) for i, (t, g) in enumerate(zip(tokens, grid, strict=True))]
    df = spark.createDataFrame([*rows, (None, 0, grid[0].tolist(), b"x")], "doc_id long, tokens long, grid array<long>, key binary")
    found = mixing.fit(df, wanted)
    p = grid / grid.sum(1, keepdims=True)
    weight = tokens / tokens.sum()
    gram = (p * weight[:, None]).T @ p
    rate, look, momentum = np.ones(400), np.ones(400), 1.0
    for _ in range(60_000):
        moved = np.maximum(0, look - p @ (weight * look @ p - wanted) / np.linalg.eigvalsh(gram)[-1])
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        rate, look, momentum = moved, moved + (momentum - 1) / following * (moved - rate), following
    best = weight * rate @ p
    assert np.abs(np.array(found.reached) - best).max() < 2e-4
    out = mixing.with_rates(df, found, mixing.DOMAINS).toPandas()
    assert (out["rate"] >= 0).all() and len(out) == 401
    if wanted[-1]:
        assert np.allclose(found.reached, wanted, atol=1e-5)
    else:
        assert not np.allclose(found.reached, wanted, atol=1e-3)


def test_unlabelled_toxic_documents_are_known(spark):
    # Each document has rare words of its own, which say nothing of other documents.
    pick = random.Random(5)
    insults = [f"insult{i}" for i in range(10)]
    rows, marks = [], []
    for i in range(1200):
        words = [pick.choice(("the", "of", "and")) if pick.random() < 0.4 else f"w{int(pick.paretovariate(0.4)) % 10**7}" for _ in range(150)]
        toxic = i % 8 == 0
        for _ in range(3 * toxic):
            words[pick.randrange(150)] = pick.choice(insults)
        rows.append((i, " ".join(words)))
        if i % 16 < 8:
            marks.append((i, int(i % 16 != 1), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = mixing.mixed(docs, labels, targets=[0.8, 0.17, 0.03]).toPandas()
    held = out[out["doc_id"] % 16 >= 8]
    toxic = held["doc_id"] % 8 == 0
    assert (held["p_toxic"][toxic] > 0.5).mean() > 0.8 and (held["p_toxic"][~toxic] > 0.5).mean() < 0.02
    assert held["rate"][toxic].mean() < 0.4 < 0.9 < held["rate"][~toxic].mean()


def test_search_recalls_the_nearest(spark):
    draw = np.random.default_rng(0)
    vectors = {i: draw.normal(size=16).astype(np.float32).tolist() for i in range(600)}
    vectors[7] = vectors[20]
    rows = [*vectors.items(), (601, None), (640, [0.0] * 16), (641, [float("nan")] * 16), (None, vectors[3]), (660, [1.0, 2.0])]
    found = multi_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=20, top=20).collect()
    table = np.array([vectors[i] for i in range(600)], dtype=np.float64)
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 600, 20)) and all(len(v) == 20 for v in got.values())
    hits = 0
    for q, near in got.items():
        scores = (table * table[q]).sum(1)
        assert all(abs(scores[v] - s) < 1e-9 for v, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        scores[q] = -np.inf
        hits += len({v for v, _ in near} & set(np.argsort(-scores)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)
    assert multi_index.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), every=20, top=20).count() == 0


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    result = queries.registered()[name](spark, folder)
    assert differences(result, connect(folder), queries.oracle_sql()[name]) is None
