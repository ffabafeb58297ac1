"""Fill-in-the-middle, SentencePiece and lexical search against brute force, round trips and the library."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vela.llm import fill_middle, impact_index, lexical_search, piece_agenda, sentence_pieces
from vela.llm.boundary_set import Array, Bitmap, BoundarySet, Runs
from vela.llm.catalog import op12_sentence_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("size, density", [(0, 1), (1, 1), (500, 0.4), (70_000, 0.5), (300_000, 0.97), (300_000, 0.01), (200_000, 1)])
def test_boundary_set_selects_and_ranks(size, density):
    rng = np.random.default_rng(size)
    members = np.flatnonzero(rng.random(size) < density) + 1
    found = BoundarySet(members)
    assert len(found) == len(members)
    for k in rng.integers(0, max(1, len(members)), 100 if len(members) else 0).tolist():
        at = int(members[k])
        assert found.select(k) == at and found.rank(at) == k and found.rank(at + 1) == k + 1
    with pytest.raises(IndexError):
        found.select(len(members))


def test_boundary_set_uses_all_three_containers():
    rng = np.random.default_rng(0)
    sparse, dense = np.sort(rng.choice(65536, 900, replace=False)), 65536 + np.flatnonzero(rng.random(65536) < 0.5)
    found = BoundarySet(np.concatenate((sparse, dense, np.arange(140_000, 150_000))))
    assert [type(c) for c in found.containers] == [Array, Bitmap, Runs]


def brute_cut(doc_id, text):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_middle_equals_brute_force_and_restores(frame, odd_docs, no_docs):
    rng = random.Random(4)
    texts = ["", "a", "<P>", "x <S> y", "<<P", "P>S><M", "é😀 z", "\n\r\t", "<" * 50, "ab1" * 40_000, "word " * 30_000, None]
    texts += ["".join(rng.choice("ab Z<>PSM\n日😀") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(5, "again and again")] * 2 + [(None, "no id")]
    docs = frame(rows, "doc_id bigint, text string")
    out = fill_middle.transform(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out)
    want = Counter()
    for doc_id, text in rows:
        n, form, a, b, output = brute_cut(doc_id, text or "")
        want[(doc_id, n, form, a, b, output, text or "")] += 1
    assert got == want
    assert {form for _, _, form, *_ in got} == {"plain", "psm", "spm"}
    assert fill_middle.report(odd_docs).count() == 9 and fill_middle.report(no_docs).count() == 0


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return piece_agenda.Pieces(MODEL)


def odd_texts(library):
    rng = random.Random(5)
    known = [library.id_to_piece(k).replace("▁", " ") for k in range(3, 32000)]
    texts = ["", " ", "  ", " " * 300, "\n", "\t x", "<s>", "</s><unk>", "<0x41>", "▁", "▁▁a", "a▁b", "日本語テキスト", "😀😀 é", "a\x00b", "1234 56.7", "﻿x�", "ﬁＡ",
             "x" * 70, "ab" * 3000, "the" * 2000, "中" * 500]
    texts += ["".join(rng.choice("abcdehinorst  ..,ABT\n<>▁é日0123") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    texts += ["".join(rng.choice(known) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    return texts + ["".join(rng.choice(known).strip() for _ in range(rng.randint(1, 60))) for _ in range(500)]


@pytest.mark.parametrize("short", [0, 5, 64])
def test_agenda_equals_the_library(library, pieces, monkeypatch, short):
    monkeypatch.setattr(piece_agenda, "SHORT", short)  # both forms of the agenda
    texts = odd_texts(library)
    ids, begin = pieces.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == library.encode(texts)
    assert pieces.encode([])[0].tolist() == [] and pieces.encode(["", ""])[1].tolist() == [0, 0, 0]


def test_agenda_without_distinct_segments(library, pieces, monkeypatch):
    monkeypatch.setattr(piece_agenda, "run_hashes", lambda wide, s, e: (e - s).astype(np.uint64))  # all hashes collide
    texts = odd_texts(library)[:200]
    ids, begin = pieces.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == library.encode(texts)


@pytest.mark.parametrize("chunk", [1, 300, 1 << 22])
def test_sentence_pieces_rows(frame, odd_docs, no_docs, library, monkeypatch, chunk):
    monkeypatch.setattr(sentence_pieces, "CHUNK_CHARS", chunk)
    texts = odd_texts(library)[:60]
    out = {r.doc_id: r for r in sentence_pieces.encode(frame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)).collect()}
    assert all(out[k].ids == library.encode(t) and out[k].decoded == library.decode(library.encode(t)) and out[k].agrees for k, t in enumerate(texts))
    rows = sentence_pieces.report(odd_docs).collect()
    assert len(rows) == 9 and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert {r.ids_sha256 for r in rows if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}
    assert sentence_pieces.report(no_docs).count() == 0


def test_sentence_pieces_of_the_documents(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in op12_sentence_pieces(spark, SMALL).collect():
        ids = library.encode(docs[r.doc_id])
        assert r.agrees and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def brute_search(docs, items, top):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    counts = [(i, Counter(word.findall((t or "").translate(lower)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    big_n, big_l = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        q = Counter(word.findall((text or "").translate(lower)))
        scores = []
        for i, c in counts:
            m = 25 + (75 * c.total() * big_n) // big_l
            scores.append((sum(n * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in q.items() if c[t]), i))
        best = sorted((-s, i is None, i or 0, i) for s, i in scores if s > 0)[:top]
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("leaf, block, query_bytes", [(1, 50, 1 << 25), (8, 1 << 20, 300), (4096, 400, 1 << 25)])
def test_search_equals_brute_force(frame, monkeypatch, leaf, block, query_bytes):
    monkeypatch.setattr(impact_index, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", query_bytes)
    rng = random.Random(leaf)
    words = [f"w{k}" for k in range(30)] + ["É", "日本", "THE", "the", "x9"]
    docs = [(k % 150, " ".join(rng.choices(words, k=rng.choice((1, 3, 20, 200))))) for k in range(300)]  # ids twice
    docs += [(k, "same text The the") for k in range(400, 440)] + [(None, "same text"), (501, None), (502, ""), (503, "?!")]
    items = [(k, " ".join(rng.choices(words, k=rng.choice((1, 2, 10, 40))))) for k in range(25)]
    items += [(90, "same same text"), (91, None), (92, ""), (93, "unheard"), (90, "same same text"), (None, "the")]
    schema = "{} bigint, text string, score double, rank int"
    found = lexical_search.search(frame([(*r, 1.0, 1) for r in docs], schema.format("doc_id")).repartition(3),
                                  frame([(*r, 1.0, 1) for r in items], schema.format("item_id")), 10)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str) == brute_search(docs, items, 10)


def test_search_edges(frame, odd_docs, no_docs):
    items = frame([(1, "some words"), (2, None)], "item_id bigint, text string")
    none = frame([], "item_id bigint, text string")
    assert {r.doc_id for r in lexical_search.search(odd_docs, items).collect()} == {None}
    assert lexical_search.search(no_docs, items).count() == lexical_search.search(odd_docs, none).count() == 0


def test_search_prunes_what_cannot_be_among_the_best():
    rng = np.random.default_rng(0)
    n, terms = 20_000, 8
    held = [np.sort(rng.choice(n, 6000, replace=False)) for _ in range(terms)]
    held = [np.union1d(h, np.arange(50, 65)) for h in held]  # some documents hold all the terms
    term, doc = np.repeat(np.arange(terms), [len(h) for h in held]), np.concatenate(held)
    impact = rng.integers(1000, 2000, len(doc))
    impact[(doc >= 50) & (doc < 65)] = 30_000
    index = impact_index.Index(n, terms, term, doc, impact)
    best = impact_index.Best(10)
    scored = index.search(np.arange(terms), np.full(terms, 3), np.arange(n), np.zeros(n, dtype=bool), best)
    total = np.zeros(n, dtype=np.int64)
    np.add.at(total, doc, 3 * impact)
    order = np.lexsort((np.arange(n), -total))[:10]
    assert [(-s, i) for s, _, i in best.rows] == [(int(total[d]), int(d)) for d in order]
    assert scored < 0.2 * len(doc)
