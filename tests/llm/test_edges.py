"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import Groups, cut_repeats, shingle_components, vector_links
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweave.llm import (
    byte_bpe,
    components,
    id_files,
    main_text,
    near_vectors,
    ngram_join,
    packing,
    perfect_hash,
    quality_model,
    quality_rules,
    repeats,
    suffix_array,
    toxicity,
)

DRAW = random.Random(5)
VOCABULARY = ["ka", "lo", "mi", "nu", "Ré", "so", "tu", "wa", "xe", "yo", "the", "of"]


def prose(words, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(VOCABULARY, k=draw.randint(1, 4))) for _ in range(words))


LONG = prose(30_000, 1)
TEXTS = [
    (1, prose(120, 2)),
    (2, None),
    (3, ""),
    (None, prose(120, 3)),
    (4, LONG),
    (5, prose(120, 2)),
    (5, prose(120, 2)),
    (6, prose(120, 2) + " more"),
    (None, None),
    (7, " \t\n "),
    (8, "one"),
    (9, "ONE"),
    (10, "a" * 5_000),
    (11, LONG + " ka lo"),
    (6, prose(90, 4)),
    (12, "naïve 日本語   x 'll\x1c <|endoftext|>"),
]
#: Names that operators use inside or give to their results.
CLASHING = ("id", "text", "ids", "score", "kept", "start", "rows", "n", "print", "token", "key", "nth", "bucket", "carried", "label", "tie")


def table(spark, rows, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in rows], f"doc_id long, body {kind}")
    return df.select("*", *(F.lit(7).alias(x) for x in CLASHING))


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (3, 0), (4, 1), (5, 1), (8, 0), (8, 0), (None, 1), (9, None)], "doc_id long, label int")


def vocab(name):
    return public_tokenizers.path(name)


def by_id(df):
    return sorted(df.collect(), key=lambda r: str(r[0]))


def test_byte_bpe(docs, nothing):
    path, pattern = vocab("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(docs, "doc_id", "body", path, pattern, decoded=True).collect()
    assert sorted((str(r["id"]), r["decoded"].decode()) for r in coded) == sorted((str(i), x or "") for i, x in TEXTS)
    assert all((r["ids"] == b"") == (r["decoded"] == b"") for r in coded)
    again = byte_bpe.decode(byte_bpe.encode(docs, "doc_id", "body", path, pattern), path).collect()
    assert sorted((str(r["id"]), r["decoded"]) for r in again) == sorted((str(r["id"]), r["decoded"]) for r in coded)
    assert not byte_bpe.encode(nothing, "doc_id", "body", path, pattern).count()


def test_bpe_memos_may_be_small(monkeypatch):
    import tiktoken

    monkeypatch.setattr(byte_bpe, "MEMO_ENTRIES", 3)
    bpe = byte_bpe.RankedBpe.read(vocab("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for alphabet in ("ab", "the nio", "éàü", "日本語"):
        for size in (1, 2, 7, 40, 400):
            text = "".join(DRAW.choices(alphabet.replace(" ", "e"), k=size))
            assert bpe.encode_piece(text.encode()) == library.encode_ordinary(text)


def test_id_files(spark, docs, nothing):
    files = id_files.write(docs, "doc_id", "body", vocab("word_bpe_49k.json"), docs_per_shard=3, keys_per_index=4)
    keys = files.manifest.select("id", "copy")
    found = sorted(id_files.read(spark, files, keys).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in found] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert [r["copy"] for r in found if r["id"] == 5] == [0, 1]
    assert [r["copy"] for r in found if r["id"] is None] == [0, 1]
    at = 0
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"], ids[-1]) == (at, len(ids), 1)
        at += len(ids)
    unknown = spark.createDataFrame([(99, 0), (5, 2), (None, 5)], "id long, copy long")
    assert not id_files.find(spark, files, unknown).count()
    empty = id_files.write(nothing, "doc_id", "body", vocab("word_bpe_49k.json"))
    assert not id_files.read(spark, empty, keys).count()


def test_perfect_hash():
    draw = np.random.default_rng(1)
    for size in (0, 1, 2, 1000):
        high, low = draw.integers(0, 2**63, (2, size), np.uint64)
        table = perfect_hash.PerfectHash.build(high, low)
        assert sorted(table.slots(high, low)) == list(range(size))
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.PerfectHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_packing(docs, nothing):
    pieces = packing.pack(docs, "doc_id", "body", vocab("byte_bpe_50k.json"), most=64, with_ids=True).collect()
    assert not packing.pack(nothing, "doc_id", "body", vocab("byte_bpe_50k.json")).count()
    used = {}
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] > 0
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert set(used) == set(range(len(used)))
    assert sum(r["start"] == 0 for r in pieces) == len(TEXTS)


def test_shortest_pack_first_places_all():
    for histogram in ({}, {1: 1000}, {7: 3}, {10: 5}, {i: DRAW.randint(1, 50) for i in range(1, 11)}):
        patterns = packing.shortest_pack_first(histogram, 10)
        placed = {}
        for count, lengths in patterns:
            assert sum(lengths) <= 10 and count > 0
            for length in lengths:
                placed[length] = placed.get(length, 0) + count
        assert placed == histogram
        assert len(patterns) <= 20


def test_quality_rules(docs, nothing):
    found = quality_rules.quality_rules(docs, "doc_id", "body").collect()
    assert len(found) == len(TEXTS) and not quality_rules.quality_rules(nothing, "doc_id", "body").count()
    assert all(r["whole_ratio"] is None and not r["kept"] and not r["n_words"] for r in found if r["id"] in (2, 3))
    assert all(r["kept"] for r in found if r["id"] in (1, 5))
    assert not any(r["kept"] for r in found if r["id"] in (8, 10))
    assert {r["doc_id"] for r in quality_rules.accepted(docs, "body").collect()} == {r["id"] for r in found if r["kept"]}


def test_incompressible_and_repetitive_text_goes(spark):
    noise = " ".join("".join(DRAW.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=9)) for _ in range(400))
    # every word differs, the text hardly does
    stretched = " ".join("x" * 40 + str(i) for i in range(400))
    # about as varied as text: the prose of this file is made of twelve syllables
    varied = " ".join("".join(DRAW.choices("aaeeeiiosttnnrlmdkhu", k=DRAW.randint(2, 9))) for _ in range(400))
    half = varied + " " + " ".join("y" * 60 + str(i) for i in range(120))
    rows = table(spark, [(1, noise), (2, stretched), (3, half), (4, varied)])
    assert {r["id"]: r["kept"] for r in quality_rules.quality_rules(rows, "doc_id", "body").collect()} == {1: False, 2: False, 3: False, 4: True}


@pytest.mark.parametrize("module", [quality_model, toxicity])
def test_models(spark, docs, nothing, labels, module):
    model = module.fit(docs, labels, "doc_id", "body", "label", F.lit(True))
    found = module.score(docs, model, "doc_id", "body").collect()
    assert len(found) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["id"] in (2, 3, 7)}) == 1
    assert not module.score(nothing, model, "doc_id", "body").count()
    for rows, known in ((nothing, labels), (docs, labels.limit(0)), (docs, labels.where("label = 1"))):
        bare = module.fit(rows, known, "doc_id", "body", "label", F.lit(True))
        assert all(0 <= r["score"] <= 1 for r in module.score(docs, bare, "doc_id", "body").collect())


def test_toxic_passages_are_found(spark):
    rows, known = [], []
    for i in range(120):
        words = prose(80, 100 + i).split()
        if i % 2:
            words[20:20] = ["vileness", "brutish"] * 2
        rows.append((i, " ".join(words)))
        known.append((i, i % 2))
    docs = table(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(known, "doc_id long, label int"), "doc_id", "body", "label", F.lit(True))
    for r in toxicity.score(docs, model, "doc_id", "body").collect():
        assert (r["score"] >= 0.5) == bool(r["id"] % 2)
        assert bool(r["passages"]) == bool(r["id"] % 2)
        if r["passages"]:
            assert any(p["first"] <= 23 and p["last"] >= 20 for p in r["passages"])


def test_long_words_are_told_apart(spark):
    """Words of more than eight letters with one beginning, in two scripts, and a script without spaces."""
    rows, known = [], []
    for i in range(240):
        words = prose(80, 500 + i).split()
        pair = [("understandable", "understatement"), ("противность", "противоречие"), ("这是很坏的话。", "这是很好的话。")][i % 3]
        words[20:20] = [pair[i % 2]] * 4
        rows.append((i, " ".join(words)))
        known.append((i, i % 2))
    docs = table(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(known, "doc_id long, label int"), "doc_id", "body", "label", F.lit(True))
    found = {r["id"]: r["score"] >= 0.5 for r in toxicity.score(docs, model, "doc_id", "body").collect()}
    assert found == {i: bool(label) for i, label in known}


def test_toxic_tokens_against_plain_ones():
    cases = ["", "Ab abcdef ABCDEFG é", "Äöüß Äöüßen, не Нет-нет", "这是x坏 的话", "xไทย", "a1b 𠀀𠀁𠀂", "日"]
    raw, offsets = toxicity.lower_bytes(pa.array([*cases, None]))
    words, kinds = toxicity._tokens(raw, offsets)
    data = raw.tobytes()
    expected = [[] for _ in kinds]
    nth = 0
    for text in cases:
        units = []
        for x in re.finditer(r"[^\W\d_]+|[\u0e00-\u0eff]+", text.lower()):
            wide = re.compile("[\u0e00-\u0eff\u2e80-\u9fff\U00020000-\U000323af]|[^\u0e00-\u0eff\u2e80-\u9fff\U00020000-\U000323af]+")
            units += [(y.group(), bool(wide.match(y.group()) and ord(y.group()[0]) > 0xDFF), x.start() + y.start()) for y in wide.finditer(x.group())]
        for i, (unit, alone, at) in enumerate(units):
            for kind, size in enumerate((4, 6)):
                if not alone and len(unit) >= size:
                    expected[kind].append((nth + i, unit[:size]))
            if not alone:
                expected[2].append((nth + i, unit))
            for kind, size in enumerate((2, 3), 3):
                group = units[i : i + size]
                if len(group) == size and all(y[1] for y in group) and group[-1][2] - at == size - 1:
                    expected[kind].append((nth + i, "".join(y[0] for y in group)))
        nth += len(units)
    assert nth == len(words.starts) and len(data) == offsets[-1]
    seen = {}
    for (own, hashes), plain in zip(kinds, expected):
        assert own.tolist() == [x[0] for x in plain]
        for token, (_, name) in zip(hashes.tolist(), plain):
            assert seen.setdefault((len(plain), name), token) == token
    assert len(set(seen.values())) == len(seen)


def test_rest_of_a_text_is_judged():
    """A rest too short for a chunk joins the one before it."""
    sizes = []

    def compress(part):
        sizes.append(len(part))
        return part[: len(part) // 2]

    bands = quality_rules.Bands()
    for length, expected in ((100, [100]), (2048, [2048]), (2148, [2148]), (2600, [2600, 2048, 552]), (4196, [4196, 2048, 2148])):
        sizes.clear()
        quality_rules._compression(b"x" * length, compress, bands)
        assert sizes == expected


def test_maximal_segments_against_definition():
    """Recursion: the best stretch, then the best of what lies on either side."""

    def plain(values, base=0):
        best = max(((sum(values[a:b]), -(b - a), -a) for a in range(len(values)) for b in range(a + 1, len(values) + 1)), default=(0, 0, 0))
        if best[0] <= 1e-9:
            return []
        a = -best[2]
        b = a - best[1]
        return plain(values[:a], base) + [(base + a, base + b - 1)] + plain(values[b:], base + b)

    for _ in range(200):
        values = [DRAW.choice([-0.25, -0.25, 1.03, 0.37, 2.11]) for _ in range(DRAW.randint(0, 14))]
        at = [i for i, x in enumerate(values) if x > 0]
        found = [x[:2] for x in toxicity.maximal_segments(at, [values[i] for i in at])]
        assert found == plain(values)


@pytest.mark.parametrize("bits", [16, 4])
def test_ngram_join(spark, docs, nothing, bits):
    """With few cells the levels tell nothing, and the order is that of the hashes."""
    rows = [(i, x) for i, x in TEXTS if i is not None]
    named = dict(enumerate(x for _, x in rows))
    base = prose(150, 50).split()
    for n in range(100, 160):
        words = list(base)
        for _ in range(DRAW.randint(0, 4)):
            words[DRAW.randrange(len(words))] = f"w{DRAW.random()}"
        named[n] = " ".join(words)
    for n in range(160, 190):
        named[n] = prose(60, n) + " " + prose(40, 51)
    for n in range(190, 230):
        named[n] = prose(DRAW.randint(9, 11), 52) + DRAW.choice(["", " ka", " lo"])
    join = ngram_join.Join(cell_bits=bits, segment_bits=3)
    found = ngram_join.ngram_components(table(spark, list(named.items())), "doc_id", "body", join)
    assert sorted((r["id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == shingle_components(named)
    with_nulls = ngram_join.ngram_components(docs, "doc_id", "body").collect()
    assert len(with_nulls) == len(TEXTS) and {r["component_id"] for r in with_nulls if r["id"] == 5} == {1}
    assert not ngram_join.ngram_components(nothing, "doc_id", "body").count()


def test_packed_cells_come_back():
    for values in ([], [0], [0, 0, 65534, 65535, 65535, 200_000], sorted(DRAW.choices(range(1 << 20), k=500))):
        assert ngram_join._unpack(ngram_join._pack(np.array(values, np.int64))).tolist() == values


def test_components(spark):
    edges = [(DRAW.randrange(80), DRAW.randrange(80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(40)]
    edges += [(300, 300 + i) for i in range(1, 60)] + [(500, 500), (500, None)]
    groups = Groups({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if b is not None:
            groups.join(a, b)
    found = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert set(found) == set(groups.root)
    assert len({(found[x], groups.find(x)) for x in found}) == len(set(found.values())) == len({groups.find(x) for x in found})
    assert not components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count()


def small_rule(**more):
    return repeats.Repeats(length=12, gram=5, **more)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 400])
def test_repeats(spark, shard_bytes):
    """Small shards salt the keys and merge across shards."""
    passage, lines = prose(12, 70), [prose(5, 71 + i) for i in range(6)]
    named = {i: prose(DRAW.randint(0, 30), 80 + i) + passage[DRAW.randint(0, 9) :] + DRAW.choice(lines) * DRAW.randint(1, 3) for i in range(60)}
    named |= {60: "ab" * 50, 61: "a" * 90, 62: "\0" * 30, 63: "a\0" * 30, 64: None, 65: "", 66: named[3], 67: named[3], 68: "é" * 20, 69: "x" * 11}
    found = repeats.remove_repeats(table(spark, list(named.items())), "doc_id", "body", rule=small_rule(shard_bytes=shard_bytes))
    got = [(r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found.collect()]
    assert sorted(got) == cut_repeats(named, 12)


def test_repeats_of_repeated_ids(docs, nothing):
    found = repeats.remove_repeats(docs, "doc_id", "body", "doc_id", "score").collect()
    assert len(found) == len(TEXTS) and all(r["carried"]["doc_id"] == r["id"] and r["carried"]["score"] == 7 for r in found)
    # the two rows of 5 are one document, which repeats 1
    assert [r["n_removed"] == r["n_bytes"] > 0 for r in found if r["id"] == 5] == [True, True]
    assert [r["n_removed"] for r in found if r["id"] == 1] == [0]
    assert not repeats.remove_repeats(nothing, "doc_id", "body").count()


def crowd(count):
    """A passage in a third of the documents, between words of each document's own."""
    passage = prose(8, 400)
    return {i: f"{prose(6, 500 + i)}#{i} {passage if i % 3 == 0 else ''} {i}#{prose(6, 900 + i)}" for i in range(count)} | {count: f"{passage} x", count + 1: f"{passage} x"}


def test_repeats_of_a_crowded_passage(spark):
    named = crowd(300)
    found = repeats.remove_repeats(table(spark, list(named.items())), "doc_id", "body", rule=small_rule(shard_bytes=800))
    got = [(r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in found.collect()]
    assert sorted(got) == cut_repeats(named, 12)


def test_crowded_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLED", 4)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = repeats._keyed(table(spark, list(crowd(600).items())), "doc_id", "body", ())[1]
        hot, likely = repeats._hot_keys(keyed, small_rule(shard_bytes=2_000))
        marked = repeats._marked(keyed, small_rule(shard_bytes=2_000), hot, likely)
        sizes = {(r["key"], r["task"]): r["count"] for r in marked.groupBy("key", F.spark_partition_id().alias("task")).count().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    # a shard's worth is 2,000 / (2 * 12) segments
    assert max(sum(n for (k, _), n in sizes.items() if k == key) for key in hot.tolist()) >= 200
    assert max(sizes.values()) <= 83


def test_ranges_grow_with_salts():
    draw = np.random.default_rng(2)
    texts = [bytes(draw.integers(97, 123, 40).astype(np.uint8)) for _ in range(200)]
    for salts, least in ((2, 8), (100, 90)):
        columns = {"shard": [0] * 200, "salts": [salts] * 200, "key": [7] * 200, "doc": [*range(200)], "tie": [0] * 200, "start": [0] * 200, "text": texts}
        found = repeats._shard_repeats(small_rule())(pa.table(columns)).to_pylist()
        ranges = [x["range"] for x in found if x["key"] is not None]
        assert least <= len(set(ranges)) == len(ranges) <= max(8, salts)
        assert sum(len(x["prints"]) for x in found if x["key"] is not None) == 8 * 200 * 29


def test_suffix_arrays():
    for alphabet in (b"a", b"ab", b"ab\0", bytes(range(256))):
        for size in (0, 1, 2, 7, 8, 9, 60, 200):
            text = bytes(DRAW.choices(alphabet, k=size)) * DRAW.randint(1, 3)
            array = np.frombuffer(text, np.uint8)
            order = suffix_array.suffix_array(array)
            assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
            prefixes = suffix_array.common_prefixes(array, order)
            for k in range(1, len(text)):
                a, b = text[order[k - 1] :], text[order[k] :]
                shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert prefixes[k] == shared


def test_near_vectors(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + draw.normal(size=8) * 0.12).tolist(), i % 3) for i in range(120)]
    rows += [(200 + i, rows[4][1], 1) for i in range(30)] + [(300, [2 * x for x in rows[4][1]], 1)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [float("nan")] * 8, 1), (403, [None] * 8, 1), (404, [], 1), (405, rows[4][1], None)]
    rows += [(406, [1e300] * 8, 2), (407, [1e-300] * 8, 2), (408, [1.0, 2.0], 2), (409, [float("inf")] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, tag int").select("*", F.lit(1).alias("id"), F.lit(1).alias("label"), F.lit(1).alias("class"))
    for block in (256, 7):
        found = near_vectors.near_vectors(df, "vec_id", "embedding", "tag", 0.93, near_vectors.Hashing(block=block))
        assert sorted(tuple(r) for r in found.collect()) == vector_links(rows, 0.93)
    repeated = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (None, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, tag int")
    found = near_vectors.near_vectors(repeated, "vec_id", "embedding", "tag", 0.93).collect()
    assert sorted((str(r["id"]), r["n_links"]) for r in found) == [("1", 0), ("1", 1), ("1", 1), ("None", 0)]
    assert not near_vectors.near_vectors(df.limit(0), "vec_id", "embedding", "tag", 0.93).count()


PAGES = {
    "plain": ("<html><body><nav><a href=x>Menu</a></nav><article><h1>T &amp; x</h1><p>One\n  two</p><p>Ti.</p></article><footer>&copy; f</footer>", "T & x\nOne two\nTi."),
    "broken": ("<article><p><b>First one.<br><p>Second</p><p><b>Third<br></article><footer>no</footer></body>", "First one.\nSecond\nThird"),
    "scripts": ("<script>var t='</p>';</script><style>p{}</style><article><p>a<script>x()</script>b</p><!-- c --><noscript>n</noscript></article>", "ab"),
    "beside": (
        "<header>Site</header><div class='cookie-notice'>We use cookies</div><aside>Side</aside><main><h2>Title</h2><p>Body text.</p>"
        "<div class=ad>Buy</div><form><label>Mail</label><input value=x></form><section id='comments'><p>Nice!</p></section></main><div id=sidebar>S</div>",
        "Title\nBody text.",
    ),
    "unmarked": (
        "<div class=menu><a>Home</a> <a>News</a></div><div><p>This is the story of a man who was in the house and had all that he would want from it.</p>"
        "<p>Short.</p><p>It is not the end of the story, for there was more to be said about what they had in the house.</p></div>"
        "<div><a href=1>one link of many</a> <a href=2>another link</a></div>",
        "This is the story of a man who was in the house and had all that he would want from it.\nShort.\n"
        "It is not the end of the story, for there was more to be said about what they had in the house.",
    ),
    "empty": ("", ""),
    "cut": ("<article><p>open &lt;b&gt; end<p class='x", "open <b> end"),
    "references": ("<article><p>&#233;&eacute;&#x65E5;&nbsp;x&unknown; 1 < 2</p></article>", "éé日 x&unknown; 1 < 2"),
}

STORY = "This is the story of a man who was in the house and had all that he would want from it."


@pytest.mark.parametrize(
    ("tag", "kept"),
    [
        *((x, True) for x in ("div style='overflow:hidden'", "div data-state='hidden'", "p title='hidden costs'", "div class='x hidden-xs'", "div style='--display:none-x'")),
        *((x, True) for x in ("section id='side-effects'", "article id='market-share'", "h2 class='header'", "div class='post tag-social'", "article class='comments'")),
        *((x, True) for x in ("div class='no-sidebar'", "div class='has-sidebar'", "div class='with-sidebar wide'", "div class='content-sidebar-wrap'", "div id='related-work'")),
        *((x, False) for x in ("div hidden", "p class=x hidden=''", "div style='color:red; Display : none'", "div style='visibility:hidden!important'", "main hidden")),
        *((x, False) for x in ("div class='x ad-slot-3'", "section id=related_posts", "div class='post-comments'", "div role=navigation", "div aria-label='Related articles'")),
    ],
)
def test_only_parts_that_are_hidden_or_named_as_a_whole_are_barred(tag, kept):
    name = tag.split()[0]
    page = f"<body><{tag}>{STORY}</{name}>"
    assert main_text.main_text(page) == (STORY if kept else "")
    inside = f"<main><p>{STORY}</p><{tag}>Part.</{name}></main>"
    assert main_text.main_text(inside) == (f"{STORY}\nPart." if kept else STORY)


def test_main_part_stands_within_named_blocks():
    assert main_text.main_text(f"<div class=sidebar>Links <main><p>{STORY}</p></main></div>") == STORY
    assert main_text.main_text(f"<div hidden><div class=sidebar><main><p>{STORY}</p></main></div></div>") == ""


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, text = PAGES[name]
    assert main_text.main_text(page) == text


def test_extract(spark):
    rows = spark.createDataFrame([(1, "u", PAGES["plain"][0]), (1, "u", PAGES["plain"][0]), (None, None, None)], "page_id long, url string, html string")
    found = main_text.extract(rows.withColumn("text", F.lit(1)), "page_id", "html", "url").collect()
    assert sorted((str(r["id"]), str(r["url"]), r["text"]) for r in found) == [("1", "u", PAGES["plain"][1])] * 2 + [("None", "None", "")]
    assert not main_text.extract(rows.limit(0), "page_id", "html").count()
    long = "<article>" + "".join(f"<p>{prose(50, i)}</p>" for i in range(400)) + "</article>"
    assert len(main_text.main_text(long).split("\n")) == 400
    assert main_text.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == ""


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and more columns; and a table without rows."""
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = spark.createDataFrame([(i, x, "en", None, len(x or "")) for i, x in TEXTS], "doc_id long, text string, lang string, source string, n_chars long")
    rows = rows.withColumn("id", F.lit(3)).withColumn("carried", F.lit(4))
    for n, df in enumerate((rows, rows.limit(0))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            df.write.parquet(f"{tmp_path}/{n}-{k}")
            before = spark.read.parquet(f"{tmp_path}/{n}-{k}")
            df = stage(spark, before, str(tmp_path))
            if k < 4:
                assert df.columns == before.columns
        assert df.count() >= 0
    again = corpus_pipeline.join_near_copies(spark, spark.read.parquet(f"{tmp_path}/0-0"), str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in again) == sorted(["1", "10", "12", "2", "3", "4", "6", "7", "8", "None", "None"])


def test_near_copies_stand_when_scans_are_dealt_anew(spark, tmp_path, monkeypatch):
    """Between the jobs of the stage files are packed into more partitions, as with more cores."""
    rows = [(i, prose(60, 300 + i // 2)) for i in range(32)] + [(100 + i, None) for i in range(8)]
    for row in rows:
        spark.createDataFrame([row], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs")
    docs, plain = spark.read.parquet(f"{tmp_path}/docs"), ngram_join.ngram_components

    def dealt_anew(*args):
        spark.conf.set("spark.sql.files.minPartitionNum", 40)
        return plain(*args)

    monkeypatch.setattr(ngram_join, "ngram_components", dealt_anew)
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    try:
        found = corpus_pipeline.join_near_copies(spark, docs, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sorted(r["doc_id"] for r in found) == [*range(0, 32, 2), *range(100, 108)]


def test_near_copies_are_those_of_three_words_and_nine_tenths(spark):
    """One word in 50 changed: 45 of 51 three-word shingles shared, 41 of 51 of five words. One in
    80: 75 of 81."""
    words = [f"w{i}" for i in range(130)]
    changed = [x if i not in (25, 90) else f"{x}x" for i, x in enumerate(words)]
    rows = [(1, words[:50]), (2, changed[:50]), (3, words[50:]), (4, changed[50:])]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string")
    assert (corpus_pipeline.NEAR_COPIES.width, corpus_pipeline.NEAR_COPIES.share) == (3, (90, 100))
    assert sorted(r["doc_id"] for r in corpus_pipeline.join_near_copies(spark, docs, "").collect()) == [1, 2, 3]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_markers_in_texts_are_ordinary_text_on_demand(name):
    from tokenizers import Tokenizer

    from tallyweave.llm.library_bpe import LibraryBpe

    plain, coder = Tokenizer.from_file(vocab(name)), LibraryBpe(vocab(name), markers_as_text=True)
    marker = plain.token_to_id("<|endoftext|>")
    for text in ("a <|endoftext|> b", "日本語 <|endoftext|>"):
        assert marker in plain.encode(text, add_special_tokens=False).ids
        assert marker not in np.frombuffer(coder.encode(text), "<u4")


def test_one_bitmap_against_those_of_a_component(spark):
    join = ngram_join.Join(bitmap_longs=1)
    # the component's sets have 0b0011 in common and 0b0111 in all; the single set has 0b1001
    row = spark.sql("select array(9L) as bits_a, array(3L) as all_b, array(7L) as any_b, array(5L) as bits_b")
    one, two, three = ("bits_a", "bits_a"), ("all_b", "any_b"), ("bits_b", "bits_b")
    cells = [ngram_join._only_one_has(join, *x) for x in ((one, two), (two, one), (one, three), (two, two))]
    assert list(row.select(*(c.alias(str(i)) for i, c in enumerate(cells))).first()) == [2, 2, 2, 0]


def test_pairs_are_made_at_the_first_of_the_tokens_that_they_share_in_a_row(spark):
    """Tokens that are not shared are passed over; a set's first one stands for itself."""
    bits = ngram_join._map_of(spark.createDataFrame([(x,) for x in (2, 3, 4)], "key long"), "keys")
    rows = [(p, 9, x, True, 9 - x) for p, tokens in ((1, (1, 2, 3, 4)), (2, (2, 3, 4)), (3, (2, 4))) for x in tokens]
    kinds = "print long, n long, token long, short boolean, rest long"
    found = spark.createDataFrame(rows, kinds).coalesce(1).mapInArrow(ngram_join._several_tokens(bits), f"{kinds}, prev long").where("token in (2, 3, 4)")
    assert sorted((r["print"], r["token"], r["prev"]) for r in found.collect() if r["print"] > 1) == [(2, 2, 2), (2, 3, 2), (2, 4, 3), (3, 2, 2), (3, 4, 2)]
    a, b = (found.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("print", "prev"))) for x in "ab")
    made = a.join(b, "token").where("print_a < print_b").where(ngram_join._new_here("prev"))
    assert sorted((r["print_a"], r["print_b"], r["token"]) for r in made.collect()) == [(1, 2, 2), (1, 3, 2), (1, 3, 4), (2, 3, 2), (2, 3, 4)]


def test_near_copies_with_changes_in_common(spark, monkeypatch):
    """Most are linked through a few; few pairs are left to be made, and each of them once or so."""
    made, plain = {}, ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: made.setdefault(name, plain(df, name)))
    base, named = [f"w{i}" for i in range(150)], {}
    for n in range(160):
        words = list(base)
        for k in DRAW.sample(range(1, 149), DRAW.choice([1, 1, 2, 2, 3, 4])):
            words[k] = f"x{k}y{DRAW.randrange(3)}"
        named[n] = " ".join(words)
    docs = spark.createDataFrame(list(named.items()), "id long, text string")
    found = ngram_join.ngram_components(docs, "id", "text").collect()
    assert sorted((r["id"], r["n_shingles"], r["component_id"]) for r in found) == shingle_components(named)
    assert made["second-pairs-links"].count() and made["other-pairs-met"].count() < 160 * 159 / 8
