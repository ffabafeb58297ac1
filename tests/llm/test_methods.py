"""Operators against brute force, exact round trips and held-out accuracy."""

import base64
import gzip
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vela.llm import (catalog, components, language_id, mixing, near_dedup, packing, quality_rules, secrets, toxicity, vp_search)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.01"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    """texts: id -> text; exact links through an inverted index, union by smallest id."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i in sorted(sets):
        shared = {}
        for x in sets[i]:
            for j in holders.get(x, ()):
                shared[j] = shared.get(j, 0) + 1
            holders.setdefault(x, []).append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_near_dedup_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in catalog.op9_near_dedup(spark, SMALL).collect()}
    assert got == want


def test_near_dedup_large_group_of_near_copies(frame):
    rng = np.random.default_rng(1)
    vocabulary = np.array([f"w{k}" for k in range(4000)])
    base = rng.choice(vocabulary, 120)
    rows = []
    for k in range(300):  # copies with a few words changed each, and strangers that share a passage
        words = base.copy()
        words[rng.choice(120, rng.integers(0, 3), replace=False)] = rng.choice(vocabulary, 1)
        rows.append((k, " ".join(words)))
    for k in range(300, 500):
        rows.append((k, " ".join([*base[:40], *rng.choice(vocabulary, 120)])))
    want = brute_components(dict(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(frame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("block", [40, 1000])
def test_near_dedup_crowded_prefixes(frame, monkeypatch, block):
    """Windows of one neighbour see next to nothing: the exact join finds the links of crowded prefixes."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    vocabulary = np.array([f"w{k}" for k in range(4000)])
    shared = [list(rng.choice(vocabulary, 60)) for _ in range(3)]
    rows = []
    for k in range(300):  # half of each text is a passage of a hundred texts; every third text has a near copy
        text = [*shared[k % 3], *rng.choice(vocabulary, 50)]
        rows.append((k, " ".join(text)))
        if k % 9 < 3:
            rows.append((1000 + k, " ".join([*text, *rng.choice(vocabulary, 8)])))
    docs = frame(rows, "doc_id bigint, text string")
    sets = near_dedup.full_sets(docs, docs.selectExpr("doc_id AS x")).dropDuplicates(["doc"])
    crowd = near_dedup.signed(docs).selectExpr("doc_id AS doc", "doc_id AS root", "n_shingles AS n", "signature")
    low = near_dedup.F.concat(*[near_dedup.F.substring("signature", 4 * k + 4, 1) for k in range(near_dedup.HASHES)])
    pairs = near_dedup.crowd_pairs(crowd.select("doc", "root", "n", low.alias("sketch")).checkpoint(), sets.checkpoint())
    linked = {(r.a, r.b) for r in near_dedup._links(near_dedup._confirmed(pairs, sets)).selectExpr("u AS a", "v AS b").collect()}
    exact = {i: shingles(t) for i, t in rows}
    assert linked == {(a, b) for a in exact for b in exact if a < b and 100 * len(exact[a] & exact[b]) >= 75 * len(exact[a] | exact[b])}
    assert len(linked) >= 100


def test_near_dedup_windows_too_narrow(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "NEAR", 1)
    monkeypatch.setattr(near_dedup, "NEIGHBOURS", 1)
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"w{k}" for k in range(4000)])
    rows = []
    for g in range(40):  # groups of texts that agree by about 0.75, in a template that all share
        template = list(rng.choice(vocabulary, 40)) if g % 10 == 0 else template
        own = list(rng.choice(vocabulary, 60))
        for k in range(6):
            rows.append((g * 10 + k, " ".join([*template, *own, *rng.choice(vocabulary, 13)])))
    want = brute_components(dict(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(frame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


def test_components_of_long_paths_and_hubs(frame):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 4000), (4000, 5000), (7, 7)]
    got = {r.node: r.root for r in components.components(frame(edges, "u bigint, v bigint")).collect()}
    want = {k: 0 for k in range(1, 201)} | {k: 1000 for k in range(1001, 1300)} | {5000: 4000}
    assert got == want


def test_quality_counts_equal_brute_force():
    texts = ["a b c a b c", "x # $ y\n\nx # $ y\nz", "", None, "one", "é|ö  \t<tag>\r\n é|ö  \t<tag>", "p q r s\n" * 3]
    got = quality_rules._stats(pa.array(texts, pa.string())).to_pylist()
    for text, row in zip(texts, got):
        t = text or ""
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        assert row == {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
                       "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def test_quality_cutoffs_follow_the_group_and_every_rule_rejects(frame):
    rng = np.random.default_rng(7)

    def prose(n, lines=6, spread=0):  # words of 6 letters on average, all different
        words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(6 - spread, 7 + spread)))) + str(k) for k in range(n)]
        return "\n".join(" ".join(x) for x in np.array_split(np.array(words, dtype=object), lines))

    def repeats(share, n=200):  # a share of the words in windows that occur twice
        twice = prose(int(n * share / 2), 1)
        return f"{twice} {prose(n - int(n * share), 1)} {twice}"

    rows = [(k, "en", "even", prose(100)) for k in range(300)]
    rows += [(1000 + k, "en", "wild", [prose(100, spread=4), prose(100, spread=2) + " # # #" * (k % 30), repeats(0.003 * (k % 100)), "\n".join([prose(60, 12)] + ["same line"] * (k % 12))][k % 4]) for k in range(800)]
    planted = {5001: " ".join("a" * 40 + str(k) for k in range(100)), 5002: " ".join(w + "#%" for w in prose(100).split()),
               5003: "\n".join([prose(40, 4), *["same words again"] * 8]), 5004: repeats(0.45)}
    rows += [(i, "en", "even", t) for i, t in planted.items()]
    docs = frame(rows, "doc_id bigint, lang string, source string, text string")
    out = {r.doc_id: r for r in quality_rules.report(docs).collect()}
    assert all(not out[i].base_failed and not out[i].kept for i in planted)
    assert all(out[i].kept for i in range(300))
    stats = docs.select("lang", "source", quality_rules.text_stats(quality_rules.F.col("text")).alias("_s")).checkpoint()
    cuts = {r.source: r.cut for r in quality_rules.thresholds(quality_rules.sketches(stats)).collect()}
    for rule in quality_rules.RATES:
        assert cuts["wild"][f"{rule.name}_high"] > cuts["even"][f"{rule.name}_high"], rule.name


def test_packing_round_trip(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs.items()}
    rows = catalog.op4_packing(spark, SMALL).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for i, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    used = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        used += at
    assert used / (1024 * len(sequences)) > 0.98
    ends = packing._vocabulary(public_tokenizers.path("byte_bpe_50k.json")).ends
    last = [max(own, key=lambda r: r.offset) for own in sequences.values()]
    kinds = ["document" if r.start + r.length == r.doc_tokens else "sentence" if ends[ids[r.doc_id][r.start + r.length - 1]] else "inside" for r in last]
    assert kinds.count("inside") < 0.1 * len(kinds) and kinds.count("document") > 0.05 * len(kinds)


def test_cuts_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        gaps = rng.integers(1, 300, 40)
        place = np.cumsum(gaps).tolist()
        penalty = rng.choice([0, 3, 8], 40).tolist()
        best = {0: 0.0}
        for j, p in enumerate(place):
            best[p] = penalty[j] + min(c + packing.SEQUENCE - (p - q) for q, c in best.items() if p - q <= packing.SEQUENCE and q < p)
        got = packing.cuts(place, penalty, True)
        cost = sum(penalty[place.index(b)] + packing.SEQUENCE - (b - a) for a, b in zip([0, *got], got))
        assert got[-1] == place[-1] and cost == best[place[-1]]


@pytest.mark.parametrize("text", ["", " a", "a  b", "it's. ok!! <|endoftext|> x", "naïve, 北京。\n\n ok.", "\0 a"])
def test_vocabulary_equals_tokenizers(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = packing._vocabulary(path)
    assert list(words.encode(text)) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_mixing_targets_and_rounding(spark):
    rows = mixing.report(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    again = mixing.report(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    assert sorted(rows, key=lambda r: r.doc_id) == sorted(again, key=lambda r: r.doc_id)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()
    size = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    total = {}
    for i, s in source.items():
        total[s] = total.get(s, 0) + size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(total.values()), set(order)
    while True:  # the excess goes to the sources not full yet
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * total[s]
            left -= target[s]
        open_ -= full
    target |= {s: level * weight[s] for s in open_}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], total[s]) and r.target == pytest.approx(target[s])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s]


SECRET = "password=abcdef123456"
CODERS = {"base64": lambda x: base64.b64encode(x.encode()).decode(), "gzip": lambda x: base64.b64encode(gzip.compress(x.encode())).decode(),
          "zlib": lambda x: base64.urlsafe_b64encode(zlib.compress(x.encode())).decode(),
          "percent": lambda x: "".join(f"%{b:02X}" for b in x.encode()), "unicode": lambda x: "".join(f"\\u{ord(c):04x}" for c in x)}


@pytest.mark.parametrize("inner", CODERS)
@pytest.mark.parametrize("outer", [None, *CODERS])
def test_nested_secrets_are_found(inner, outer):
    coded = CODERS[inner]("hé " + SECRET + " x")
    coded = CODERS[outer](coded) if outer else coded
    text = "héllo " + coded + " tail"
    base, found, cut = secrets.spans(text)
    assert base == [] and not cut
    [(start, kind, end)] = found
    assert kind == 0 and 6 <= start < end <= 6 + len(coded)
    assert secrets.spans(secrets.redacted(text))[1] == []


@pytest.mark.parametrize("inner", CODERS)
@pytest.mark.parametrize("outer", [None, *CODERS])
def test_secret_encoded_twice_is_found_twice(inner, outer):
    coded = CODERS[inner]("hé " + SECRET + " x")
    coded = CODERS[outer](coded) if outer else coded
    text = "a " + coded + " b " + coded + " c"
    first, second = 2, 5 + len(coded)
    found = secrets.spans(text)[1]
    assert len(found) == 2
    for at, (start, kind, end) in zip((first, second), found):
        assert kind == 0 and at <= start < end <= at + len(coded)
    assert secrets.redacted(text).count(secrets.REDACTED) == 2
    assert secrets.spans(secrets.redacted(text))[1] == []


def b64(raw):
    return base64.b64encode(raw).decode()


def wrapped(coded, end="\n"):
    return end.join(coded[k:k + 76] for k in range(0, len(coded), 76))


_PLAIN = ("some words. " * 20 + SECRET + " more").encode()
_NOISE = np.random.default_rng(5).integers(0, 256, 400, dtype=np.uint8).tobytes()
PLANTED = {
    "second member": b64(gzip.compress(b"first") + gzip.compress(_PLAIN)),
    "behind the member": b64(gzip.compress(b"first") + b" " + _PLAIN),
    "cut stream": b64(gzip.compress(_PLAIN + _NOISE)[:-200]),
    "wrong checksum": b64(gzip.compress(_PLAIN)[:-8] + b"12345678"),
    "invalid byte": b64(b"caf\xe9 " + _PLAIN),
    "invalid byte inflated": b64(gzip.compress(b"caf\xe9 " + _PLAIN)),
    "control characters": b64(b"\x1b[31m" + _PLAIN + b"\0next"),
    "control characters inflated": b64(zlib.compress(b"\x1b[31m\0" + _PLAIN)),
    "invalid byte in percent run": "%FF" + CODERS["percent"](SECRET),
    "lone surrogate in escape run": "\\ud800" + CODERS["unicode"](SECRET),
    "lines": wrapped(b64(b"x" * 50 + b" " + SECRET.encode() + b" more")),
    "lines of packed data": wrapped(b64(gzip.compress(_NOISE.hex("-").encode() + _PLAIN)), "\r\n  "),
    "lines, members in them": wrapped(b64(gzip.compress(_NOISE) + gzip.compress(_PLAIN))),
}


@pytest.mark.parametrize("name", PLANTED)
def test_secrets_of_damaged_and_wrapped_layers(name):
    for text in ("a " + PLANTED[name] + " b", "averyveryverylongword\n" + PLANTED[name] + "\nThe end", CODERS["gzip"]("x, " + PLANTED[name] + " y")):
        base, found, cut = secrets.spans(text)
        assert base == [] and not cut and {kind for _, kind, _ in found} == {0}
        assert secrets.spans(secrets.redacted(text))[1] == []
        longest = max(e - s for s, _, e in found)
        assert longest >= len(SECRET)


def test_inflating_has_no_limit_but_for_what_no_window_holds(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_LAYER", 1 << 12)
    monkeypatch.setattr(secrets, "BLOCK", 1 << 10, raising=False)
    prose = "many wörds, of text " * 2000
    for k in range(30):  # wherever the blocks end
        assert [x[1] for x in secrets.spans("a " + CODERS["gzip"](prose + "é" * k + " " + SECRET + " " + prose) + " b")[1]] == [0]
    nested = CODERS["gzip"](prose + CODERS["gzip"](prose + SECRET))
    assert [x[1] for x in secrets.spans(nested)[1]] == [0]
    coded = CODERS["gzip"]("A" * 40000 + "password=abcdef123456")
    text = "a " + coded + " b"
    base, found, cut = secrets.spans(text)
    assert cut and (2, secrets.UNREAD, 2 + len(coded)) in found
    assert secrets.redacted(text) == "a " + secrets.REDACTED + " b"
    assert "unread:2:" in secrets._written(found)


def test_base_spans_equal_plain_search(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["secret=token:abcdefgh", "API_KEY : 'x1y2z3'", "AKIA" * 5 + " AKIAB", "f" * 24 + "g" + "0" * 23, "TOKEN=a.b-c_", "paſsword=abcdefg"]
    for text in texts:
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
        assert secrets.find(text) == sorted(want)
        assert set(want) <= set(secrets.spans(text)[1])


def test_decoding_ends_on_cycles_and_junk():
    for text in ("%25" * 50, "%", "\\u", "%ff%fe", "\\ud800", "A" * 64, "=" * 40, CODERS["base64"]("%41" * 20)):
        secrets.spans(text)


def test_vector_search_equals_brute_force(spark):
    rows = catalog.op5_vp_search(spark, SMALL).collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    hit = total = 0
    for q in (i for i in vectors if i % 100 == 0):
        near = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q)[:10]
        own = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [k for k, _, _ in own] == list(range(1, 11))
        for _, i, score in own:
            assert score == pytest.approx(float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())), rel=1e-12)
        hit += len({i for _, i, _ in own} & {i for _, i in near})
        total += 10
    assert hit >= 0.9 * total


def test_factor_one_is_exact():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.normal(c, 0.1, (150, 4)) for c in range(6)] + [np.repeat(rng.normal(0, 1, (1, 4)), 100, axis=0)])
    queries = rng.normal(2, 2, (40, 4))
    found = vp_search.Search(vp_search.Tree(data, 8), queries, 10, 1.0)
    want = np.sort(vp_search.distances(queries, data), axis=1)[:, :11]
    assert np.allclose(found.best, want)


def test_language_masks_hold_every_gram():
    rng = np.random.default_rng(2)
    sets = {f"l{k:02d}": rng.integers(0, 1 << 63, 2000, dtype=np.uint64) for k in range(70)}  # more than one word of bits
    filters = language_id.build(sets)
    for k, name in enumerate(filters.languages):
        mask = filters.masks(k // 64, sets[name])
        assert ((mask >> np.uint64(k % 64)) & np.uint64(1)).all()
    assert (filters.false_rate < 1e-4).all()


TOXIC_ROWS = ([("the vile glarbfish swims here", 1), ("a bad glarbfish", 0), ("", 0), (None, 1)] + [(f"w{chr(97 + k)} mild text again", 0) for k in range(20)]
              + [("you zorkwump", 1)] * 3 + [("go away you a people now", 1)] * 6 + [("now people a you go", 0), ("away from a people", 0)] * 6)


def toxic_shares(rows):
    """Shares of stems, words and bigrams by the definition, and the corpus' own."""
    pairs, seen = {}, ({}, {})
    for text, label in rows:
        before = ""
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            pairs.setdefault((before, w), [0, 0])[label] += 1
            before = w
    for (before, w), n in pairs.items():
        for k, unit in enumerate((w[:toxicity.STEM], w)):
            held = seen[k].setdefault(unit, [0, 0])
            for label in (0, 1):
                held[label] += n[label] > 0

    def discount(counts):
        once, twice = (sum(c == k for n in counts.values() for c in n) for k in (1, 2))
        return min(max(once / max(1, once + 2 * twice), toxicity.DISCOUNTS[0]), toxicity.DISCOUNTS[1])

    def share(n, d, up):
        return (max(n[1] - d, 0) + (toxicity.BACKOFF + d * sum(c > 0 for c in n)) * up) / (sum(n) + toxicity.BACKOFF)

    total = [sum(n[k] for n in seen[0].values()) for k in (0, 1)]
    corpus = total[1] / sum(total)
    stems = {u: share(n, discount(seen[0]), corpus) for u, n in seen[0].items()}
    named = {u: share(n, discount(seen[1]), stems[u[:toxicity.STEM]]) for u, n in seen[1].items()}
    toxic = {u: n for u, n in pairs.items() if n[1]}
    return corpus, stems, named, {u: share(n, discount(toxic), named[u[1]]) for u, n in toxic.items()}


def test_toxic_shares_equal_brute_force(frame):
    corpus, *want = toxic_shares(TOXIC_ROWS)
    found, got = toxicity.shares(frame(TOXIC_ROWS, "text string, label int"))
    assert found == pytest.approx(corpus)
    for table, shares in zip(got, want):
        assert np.allclose(sorted(r.share for r in table.collect()), sorted(shares.values()), rtol=1e-12)
    # the table's differences add up to the clipped ratios, a bigram by its own shares or those it falls back to
    model = toxicity.collected(toxicity.model_table(frame(TOXIC_ROWS, "text string, label int")))

    def clipped(share):
        return max(0.0, np.log(share / (1 - share)) - np.log(corpus / (1 - corpus)) - toxicity.MARGIN)

    for text in ["go away you a people now", "now go people you", "zorkwump unheard", "zorkers", "the vile glarbfish"]:
        before, total, seen = "", 0.0, set()
        for w in text.split():
            share = want[2].get((before, w), want[1].get(w, want[0].get(w[:4], corpus)))
            total += clipped(share)
            seen.add((before, w))
            before = w
        assert toxicity.statistic(model, pa.array([text]))[0] == pytest.approx(total / (len(seen) + toxicity.PAD), abs=1e-12)


def test_toxic_operator_counts_bigrams_of_ordinary_texts_alone(frame, monkeypatch):
    two = [a + b for a in "abcdefgh" for b in "ijklmnop"]
    rows = [(f"{w} grim", 1) for w in two] + [("the grim story", 0)] * 25 + [(f"mild {w}{c} text", 0) for w in two for c in "qrstuvwxyz"]
    _, (_, _, pairs) = toxicity.shares(frame(rows, "text string, label int"), every=True)
    assert pairs.count() == 2 * 64 + 3 + 1 + 2 * 640  # a text's first word has a bigram too
    tables, whole = [], toxicity.model_table
    monkeypatch.setattr(toxicity, "model_table", lambda *a, **k: tables.append(whole(*a, **k)) or tables[-1])
    docs = frame([(k, *rows[k % len(rows)]) for k in range(3 * len(rows))], "doc_id bigint, text string, label int")
    assert toxicity.report(docs, docs.selectExpr("doc_id", "label AS toxic")).count() == 3 * len(rows)
    model = toxicity.collected(tables[0])
    owner, word = toxicity.words(next(iter(toxicity.chunks(pa.array(["the grim"])))))
    behind, unheard = toxicity.before(owner, word)[1:], np.array([7], dtype=np.uint32)
    assert 0 < model.values(word[1:], behind)[0] < model.values(word[1:], unheard)[0] - 0.5


def test_toxic_order_of_words_counts_and_both_ways_of_scoring_agree(frame):
    rows = frame(TOXIC_ROWS, "text string, label int")
    table = toxicity.model_table(rows).checkpoint()
    texts = ["go away you a people now", "now people a you away go", "", None, "mild text again", "go away you a people now now now"]
    docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
    by_model = {r.doc_id: r.x for r in toxicity.with_statistic(docs, table, "x", toxicity.collected(table)).collect()}
    by_join = {r.doc_id: r.x for r in toxicity.with_statistic(docs, table, "x", None).collect()}
    assert by_model == pytest.approx(by_join)
    assert by_model[0] > by_model[1] and by_model[2] == by_model[3] == by_model[4] == 0


def test_vector_search_ties_go_to_the_smaller_id(frame):
    rng = np.random.default_rng(11)
    vectors = {int(i): [float(x) for x in v] for i, v in zip(rng.permutation(1500) + 1, rng.integers(0, 3, (1500, 6))) if v.any()}
    rows = frame(list(vectors.items()), "vec_id bigint, embedding array<float>")
    asked = rows.filter("vec_id % 25 = 0")
    got = {}
    for r in vp_search.search(rows, asked, k=10, factor=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q, found in got.items():
        own = np.array(vectors[q])
        assert found == [i for _, i in sorted((((np.array(v) - own) ** 2).sum(), i) for i, v in vectors.items() if i != q)[:10]]


@pytest.mark.parametrize("factor", [1.0, 2.0])
def test_vector_search_visits_few_shards_of_clustered_vectors(frame, monkeypatch, factor):
    monkeypatch.setattr(vp_search, "SHARD_ROWS", 100)
    rng = np.random.default_rng(3)
    sizes = [1000, *[100] * 20]  # one cluster holds a third of all points
    data = np.concatenate([rng.normal(0, 0.05, (n, 16)) + rng.normal(0, 1, 16) for n in sizes])
    data = {int(i): v for i, v in zip(rng.permutation(len(data)), data)}
    rows = frame([(i, [float(x) for x in v]) for i, v in data.items()], "vec_id bigint, embedding array<double>").checkpoint()
    asked = rows.filter("vec_id % 50 = 0")
    hit = 0
    found = {}
    for r in vp_search.search(rows, asked, 10, factor).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(found) == {i for i in data if i % 50 == 0}
    for q, got in found.items():
        want = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        hit += len({i for _, i in got} & {i for _, i in want})
        assert len(got) == 10 and (factor > 1 or [i for _, i in sorted(got)] == [i for _, i in want])
    assert hit >= 0.9 * 10 * len(found)
    index, cells, queries, first = vp_search.prepare(rows, asked, 10)
    near = vp_search.walk(index, first, queries, 10, factor)
    visits = first.select("vec_id", "shard").unionByName(vp_search.admitted(queries, cells, first, vp_search.bounds(near, 10), factor).select("vec_id", "shard"))
    shards, compared = {}, 0
    for r in index.collect():
        shards.setdefault(r.shard, []).append(r.vector)
    limit = {r.query_id: r.far for r in near.groupBy("query_id").agg({"score": "max"}).withColumnRenamed("max(score)", "far").collect()}
    own = {(r.vec_id, r.shard) for r in first.collect()}
    for r in visits.collect():
        start = np.inf if (r.vec_id, r.shard) in own else limit[r.vec_id]
        search = vp_search.Search(vp_search.Tree(np.array(shards[r.shard])), data[r.vec_id][None], 10, factor, np.array([start]))
        compared += search.compared
    assert compared < 0.3 * len(data) * len(found)
    assert max(len(v) for v in shards.values()) <= 300


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    quality = [r for r in catalog.op1_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in quality]) > 0.97
    toxic = [(r.predicted, labels[r.doc_id].toxic) for r in catalog.op3_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([p == t for p, t in toxic]) > 0.97
    assert sum(p and t for p, t in toxic) >= 0.93 * sum(t for _, t in toxic) and sum(p and not t for p, t in toxic) <= 10
    named = [r for r in catalog.op2_language_id(spark, folder).collect() if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in named]) > 0.97
    again = {r.doc_id: r.score for r in catalog.op1_quality_classifier(spark, folder).collect()}
    assert all(again[r.doc_id] == r.score for r in quality)
