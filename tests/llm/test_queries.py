"""Registered queries against plain versions, over all rows of a small scale."""

from __future__ import annotations

import base64
import hashlib
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from brute import cut_repeats, shingle_components, vector_links, word_counts
from tokenizers import Tokenizer

import corpus_pipeline
from tallyweave.llm.catalog import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def texts(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


def rows(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


def tokenizer(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: np.array(found.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_near_vectors(spark):
    table = pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist()
    expected = vector_links([(r["vec_id"], r["embedding"], r["label"]) for r in table], 0.93)
    assert rows(QUERIES["op1_near_vectors"](spark, SMALL), "vec_id", "n_links", "component_id", "kept") == expected


def test_quality_rules(spark):
    found = QUERIES["op2_quality_rules"](spark, SMALL)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(found, *columns) == sorted((i, *word_counts(text)) for i, text in texts(SMALL).items())
    assert not found.where("kept and base_failed").count()


def test_byte_bpe(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i, text in texts(SMALL).items():
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        expected.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows(QUERIES["op3_byte_bpe"](spark, SMALL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected)


class Article(HTMLParser):
    """Blocks of the one article of a page, by the parser of the standard library."""

    def __init__(self):
        super().__init__()
        self.blocks, self.inside, self.barred = [[]], False, 0

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.barred += tag in ("script", "style", "form", "aside", "section") or ("class", "ad") in attrs
        if tag == "br":
            self.blocks[-1].append(" ")
        elif tag not in ("a", "b", "i", "em", "strong", "span"):
            self.blocks.append([])

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.barred -= bool(self.barred and tag in ("script", "style", "form", "aside", "section", "div"))
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside and not self.barred:
            self.blocks[-1].append(data)


def test_main_text_against_a_plain_parser(spark):
    found = {r["page_id"]: r["text"] for r in QUERIES["op4_main_text"](spark, LARGER).collect()}
    for r in pq.read_table(f"{LARGER}/pages.parquet").to_pylist():
        plain = Article()
        plain.feed(r["html"])
        plain.close()
        texts = [" ".join("".join(x).split()) for x in plain.blocks]
        assert found[r["page_id"]] == "\n".join(x for x in texts if x)


def test_main_text(spark):
    found = {r["page_id"]: r for r in QUERIES["op4_main_text"](spark, SMALL).collect()}
    pages = {r["page_id"]: r for r in pq.read_table(f"{SMALL}/pages.parquet").to_pylist()}
    assert set(found) == set(pages)
    for i, row in found.items():
        assert row["n_chars"] == len(row["text"]) > 0 and row["url"] == pages[i]["url"]
        assert "<" not in row["text"].replace("<<<", "") and "track(" not in row["text"]


def test_ngram_join(spark):
    found = QUERIES["op5_ngram_join"](spark, LARGER)
    assert rows(found, "doc_id", "n_shingles", "component_id") == shingle_components(texts(LARGER))


def test_id_files(spark):
    encode, start, expected = tokenizer("word_bpe_49k.json"), 0, []
    for i, text in sorted(texts(SMALL).items()):
        ids = encode(text)
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(QUERIES["op6_id_files"](spark, SMALL), "doc_id", "start", "n_tokens", "ids_crc32") == expected


@pytest.mark.parametrize(("name", "label", "folds", "fold", "least"), [("op7_toxicity", "toxic", 5, 0, 0.93), ("op8_quality_model", "quality", 4, 2, 0.93)])
def test_held_out_accuracy(spark, name, label, folds, fold, least):
    labels = {r["doc_id"]: r[label] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    found = QUERIES[name](spark, LARGER).collect()
    assert len(found) == len(texts(LARGER)) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) for r in found)
    held = [r["predicted"] == labels[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(held) >= least * len(held)


def test_repeats(spark):
    found = QUERIES["op9_repeats"](spark, LARGER)
    assert rows(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == cut_repeats(texts(LARGER))


def check_packing(pieces, encoded):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(encoded)
    for i, ids in encoded.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return sum(map(len, encoded.values())) / (2048 * len(by_sequence))


def test_packing(spark):
    encode = tokenizer("byte_bpe_50k.json")
    encoded = {i: encode(text) for i, text in texts(LARGER).items()}
    assert check_packing(QUERIES["op10_packing"](spark, LARGER).collect(), encoded) > 0.98


def test_pipeline(spark, tmp_path):
    """Each stage against a plain version of what it decides, on its own input."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    inputs = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r["doc_id"]: r.asDict() for r in docs.collect()})
        stage(spark, docs, LARGER).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
    everything, sound, ruled, single, cut = inputs
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    good = [i for i, quality in labels.items() if quality == 1]
    assert sum(i in sound for i in good) >= 0.97 * len(good)
    assert sum(i in sound for i, quality in labels.items() if quality == 0) <= 0.15 * sum(q == 0 for q in labels.values())
    assert all(sound[i] == everything[i] for i in sound)
    assert all(ruled[i] == sound[i] for i in ruled)
    assert not any(word_counts(row["text"])[5] for row in ruled.values())
    passing = [i for i in sound if not word_counts(sound[i]["text"])[5] and labels.get(i) == 1]
    assert sum(i in ruled for i in passing) >= 0.98 * len(passing)
    groups = shingle_components({i: r["text"] for i, r in ruled.items()})
    assert set(single) == {component for _, _, component in groups}
    assert all(single[i] == ruled[i] for i in single)
    expected = cut_repeats({i: r["text"] for i, r in single.items()})
    assert set(cut) == {i for i, size, removed, *_ in expected if size > removed}
    for i, _, _, _, digest in expected:
        if i in cut and "�" not in cut[i]["text"]:
            assert hashlib.sha256(cut[i]["text"].encode()).hexdigest() == digest
            assert cut[i]["n_chars"] == len(cut[i]["text"]) and cut[i]["lang"] == single[i]["lang"]
    encode = tokenizer("byte_bpe_50k.json")
    check_packing(docs.collect(), {i: encode(r["text"]) for i, r in cut.items()})
