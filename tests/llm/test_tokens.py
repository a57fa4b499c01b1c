"""Encoding against the tokenizers library; packing by its invariants and bounds."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recurra.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(coder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]


def test_encoding_equals_the_library(library):
    rng = random.Random(1)
    signs = list("abcdeéÉΣσςİß ñ'’12²½٣\x1c\x85 　漢字🎉the and ing!?#**  \n\t<|>") + ["'s", "'LL", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", "aaaa" * 60, "a" * 5000, "!" * 3000, "ab" * 3000 + "é" * 2000, "ǅ ŉ ﬁ Ⅷ Å K Ω"]
    coder = bpe.WordBpe(PATH)
    assert ids(coder, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < coder.repaired < coder.words  # both ways were used


def test_repair_is_needed_exactly_where_a_border_fails():
    coder = bpe.WordBpe(PATH)
    words = [b"thstentionable", b"internationalization", b"the", b"zzzzzzzz", b"ouanerh"]
    starts = np.cumsum([0] + [len(w) for w in words[:-1]])
    data = np.frombuffer(b"".join(words), np.uint8)
    tokens, owner = coder.propose(data, starts, starts + [len(w) for w in words])
    for k, w in enumerate(words):
        own = tokens[owner == k]
        fits = bool(coder.compatible(own[:-1], own[1:]).all()) if len(own) > 1 else True
        assert fits == (own.tolist() == coder.merge_long(w))


def test_edge_rows(edge, edge_rows, library):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.decoded) for r in bpe.encode(edge, PATH).collect())
    want = sorted((i is not None, i or 0, len(e := library.encode(t or "", add_special_tokens=False).ids), library.decode(e, skip_special_tokens=False)) for i, t, *_ in edge_rows)
    assert got == want


def test_decode_round_trip(spark):
    docs = spark.createDataFrame([(1, "Two  words, and it's 7!"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert rows == {1: "two words , and it 's 7 !", 2: ""}


def test_empty_table(none):
    assert bpe.digests(bpe.encode(none, PATH)).count() == 0
    assert packing.pack(none, PATH).count() == 0


def check_packing(rows, length=4096):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(bins)


def test_packing_places_every_piece(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    used = check_packing(rows)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        own = library.encode(d.text, add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [(p.piece, p.start, p.length, p.ids_crc32) for p in pieces] == [
            (k, 4096 * k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k in range(-(-len(own) // 4096)) for x in [own[4096 * k : 4096 * (k + 1)]]]
    assert used <= 1.05 * sum(r.length for r in rows) / 4096 + 1


def test_packing_edge_rows_and_ids(edge, edge_rows):
    packed = packing.pack(edge, PATH, with_ids=True)
    rows = packed.collect()
    check_packing(rows)
    assert len({(r.doc_id, r.piece, r.ids_crc32, r.sequence_id, r.offset) for r in rows}) == len(rows)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in rows) and max(len(r.ids) for r in whole) <= 4096


def test_best_fit_against_one_by_one(spark):
    rng = random.Random(2)
    sizes = [rng.choice([rng.randint(1, 30), rng.randint(300, 1500), 1000, 1365, rng.randint(2000, 4000)]) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(sizes)), "pid long, size long")
    homes = packing.fit(items).collect()
    assert sorted(h.pid for h in homes) == list(range(len(sizes)))
    loads, gaps = {}, []
    for h in homes:
        loads.setdefault(h.bin, []).append((h.offset, sizes[h.pid]))
    for parts in loads.values():
        at = 0
        for o, s in sorted(parts):
            assert o == at
            at += s
        assert at <= 4096
    for s in sorted(sizes, reverse=True):  # best fit, largest first
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - s)
        else:
            gaps.append(4096 - s)
    assert len(loads) <= 1.03 * len(gaps) + 1


def test_sweep_matches_the_largest_document_that_fits(spark):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate([5, 5, 7, 9, 2])], "pid long, size long")
    slots = spark.createDataFrame([(0, 1, 8), (1, 1, 6), (2, 1, 1), (3, 1, 20)], "bin long, slot int, size long")
    got = {r.bin: r.size for r in packing.sweep(docs, slots).collect()}
    assert got == {1: 5, 0: 7, 3: 9}


def test_a_word_is_merged_once_whatever_stands_beside_it():
    coder = bpe.WordBpe(PATH)
    first = coder.encode(["thstentionable"])[0]
    assert coder.words == 1
    assert coder.encode(["Thstentionable, THSTENTIONABLE."])[0][: len(first)] == first and coder.words == 3  # the two signs are new
