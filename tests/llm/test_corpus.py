"""Fingerprints and their links, alignment of two vocabularies, and the Merkle manifest, each against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import align, merkle, simhash

JSON, PIECES, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links=()):
    """The smallest id of each (id, fingerprint)'s component; ids with several fingerprints link them."""
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(nodes):
        for j, (b, y) in enumerate(nodes[:i]):
            if a == b or (x ^ y).bit_count() <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, (a, _) in enumerate(nodes):
        low[find(i)] = min(low.get(find(i), a), a)
    return [low[find(i)] for i in range(len(nodes))]


def near(draw, x, most):
    for k in draw.sample(range(64), draw.randrange(most + 1)):
        x ^= 1 << k
    return x


def test_fingerprints(monkeypatch):
    draw = random.Random(2)
    texts = [None, "", " \t\n", "one", "ONE two", "a b c d", "A b c d", "É b c", "a b c d " * 50, "x" * 5000]
    texts += [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.randrange(1, 80))) for _ in range(60)]
    for part in (1 << 20, 16):  # long texts go in parts
        monkeypatch.setattr(simhash, "PART_BYTES", part)
        assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_two_within_the_distance_share_a_key_and_one_first():
    draw = random.Random(3)
    for _ in range(2000):
        x = draw.getrandbits(64)
        y = near(draw, x, 4)
        keys = [{(((v & int(w)) >> int(low)), i) for i, (w, low) in enumerate(zip(simhash._WILD, simhash._LOW))} for v in (x, y)]
        shared = {i for _, i in keys[0] & keys[1]}
        assert shared and min(shared) == simhash.first_shared(np.array([x ^ y], np.uint64))[0]


@pytest.mark.parametrize("block, chunk", [(4096, 1 << 18), (24, 100)])
def test_links_equal_brute_force(spark, monkeypatch, block, chunk):
    """Families, a large group of near copies, and keys that blocks, chunks and tasks cut."""
    monkeypatch.setattr(simhash, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", chunk)
    draw = random.Random(4)
    points = {near(draw, x, 6) for x in [draw.getrandbits(64) for _ in range(30)] for _ in range(8)}
    hub = draw.getrandbits(64)
    points |= {near(draw, hub, 9) for _ in range(400)} | {hub & ~0x3FFFFF | draw.getrandbits(22) for _ in range(100)} | {0, (1 << 64) - 1}
    points = sorted(points)
    df = spark.createDataFrame([(signed(p),) for p in points], "fp long").repartition(3)
    labels = {r.fp: r.label for r in simhash.links(df).collect()}
    groups = {}
    for p, c in zip(points, plain_components(list(enumerate(points)))):
        groups.setdefault(c, set()).add(labels.get(signed(p), signed(p)))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_documents_by_fingerprint(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "one", "one", "One"]
    for _ in range(8):
        base = draw.choices(words, k=draw.randrange(4, 200))
        for _ in range(draw.randrange(1, 6)):
            texts.append(" ".join("x" if draw.random() < 0.01 else w for w in base))
    texts += ["the same again and again"] * 30
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[-1]), (7, "another text of the same document"), (9, texts[9])]
    draw.shuffle(rows)
    df = spark.createDataFrame([(i, t, "old", 1) for i, t in [*rows, (None, "one")]], "doc_id long, text string, fingerprint string, fp int").repartition(4)
    found = Counter((r.doc_id, r.fingerprint, r.component_id, r.kept) for r in simhash.near_duplicates(df).collect())
    nodes = [(i, plain_fingerprint(t)) for i, t in rows]
    want = Counter((i, f"{x:016x}", c, i == c) for (i, x), c in zip(nodes, plain_components(nodes)))
    assert found == want + Counter([(None, f"{plain_fingerprint('one'):016x}", None, True)])
    assert simhash.near_duplicates(df.where("false")).count() == 0


def plain_alignment(rows):
    model, pieces = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model.encode_special_tokens = True
    name = {v: k for k, v in model.get_vocab().items()}
    letters = align._letters()
    first = lambda i: bytes(letters[c] for c in name[i])
    second = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], Counter()
    for number, text in rows:
        spans = [[], []]
        if text:
            whole = (" " + text).encode()
            for side, ids, of in ((0, model.encode(" " + text, add_special_tokens=False).ids, first), (1, pieces.encode(text), second)):
                at = 0
                for i in ids:
                    spans[side].append((at, at + len(of(i)), i))
                    at += len(of(i))
                if b"".join(map(of, ids)) != whole:
                    spans = [[], []]
                    break
        a, b = spans
        links = [(i, j) for s, e, i in a for u, v, j in b if s < v and u < e]
        ends, low, groups = sorted({e for _, e, _ in a} & {e for _, e, _ in b}), 0, []
        for high in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= high) for side in (a, b)))
            low = high
        count.update(links)
        docs.append((number, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    return [(number, a, b, g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest) for number, a, b, g, links, digest in docs]


ODD = ["", None, "a" * 300, "The the  THE\n\n\t x", "naïve café ☕ 你好 мир \U0001f600", " 's't're  '", "<|endoftext|> x <s> </s> <unk>", "\x85 a\x1cᤐb", "ab" * 30, "  lead and trail  ", "x\r\n\r\ny", "x▁y", " ", "   ", "▁", "ﬁ Ａ ①", "\x00 a\x00", "  nb sp　w", "﻿q"]


def test_alignment_equals_a_plain_one(spark, monkeypatch):
    draw = random.Random(6)
    noise = ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(0x3000), draw.randrange(0xD800), draw.randrange(0x10000, 0x40000), 32, 10, 115])) for _ in range(draw.randrange(1, 25))) for _ in range(300)]
    rows = list(enumerate(ODD + noise + ODD)) + [(3, "again"), (None, "again")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_a int, block string").repartition(3)
    want = sorted(plain_alignment(rows), key=str)
    assert sorted((tuple(r) for r in align.align(df, "doc_id", "text", JSON, PIECES, PATTERN).collect()), key=str) == want
    assert sum(r[1] == 0 for r in want) == 8  # empty, null, and two with U+2581, twice
    empty = df.where("coalesce(text, '') = ''")  # batches without a pair
    assert {tuple(r)[1:] for r in align.align(empty, "doc_id", "text", JSON, PIECES, PATTERN).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    assert align.align(df.where("false"), "doc_id", "text", JSON, PIECES, PATTERN).count() == 0


def test_a_batch_equals_its_documents():
    draw = random.Random(7)
    texts = [" ".join(draw.choice(["the", "quick", "Überraschung", "naïve", "☕", "x1"]) for _ in range(draw.randrange(0, 40))) for _ in range(50)]
    whole = align.aligned(texts, JSON, PIECES, PATTERN)
    alone = [align.aligned([t], JSON, PIECES, PATTERN) for t in texts]
    for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
        assert list(whole[name]) == [x[name][0] for x in alone]
    assert (whole["n_links"] == whole["n_a"] + whole["n_b"] - whole["n_groups"]).all()
    total = Counter()
    for x in alone:
        total.update(dict(zip(x["pairs"].tolist(), x["times"].tolist())))
    assert dict(zip(whole["pairs"].tolist(), whole["times"].tolist())) == total


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """Of rows (doc_id, source, lang, n_chars, text): what the query returns."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
        return out

    order = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(((r, digest(*map(field, r))) for r in rows if r[1] == s), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in order}
    trees = {s: levels([h for _, h in held[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (r, leaf) in enumerate(held[s]):
            text = r[4].translate(LOWER) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
            x, beside = digest(*map(field, (*r[:4], text))), []
            for tree, at in ((trees[s], i), (top, k)):
                for nodes in tree[:-1]:
                    run, slot = nodes[at // 16 * 16 :][:16], at % 16
                    beside += run[:slot] + run[slot + 1 :]
                    x, at = digest(*run[:slot], x, *run[slot + 1 :]), at // 16
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], digest(*beside), x, x == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, source", [(0, lambda i: "a"), (1, lambda i: None), (17, lambda i: "a"), (300, lambda i: ["a", None, "", "é", "Z", f"s{i}"][min(i % 7, 5)]), (40, lambda i: f"s{i}")])
def test_manifest(spark, n, source):
    rows = [(None if i % 50 == 13 else i // (1 + (i % 9 == 0)), source(i), None if i % 3 else "en", None if i == 8 else i, None if i % 11 == 0 else "" if i % 11 == 1 else f"Té xt {i % 40}") for i in range(n)]
    rows += rows[: n // 5]
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, hash string, pos int")
    found = merkle.verify(df, fields, "source", F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r) for r in found.collect()), key=str) == (plain_manifest(rows) if rows else [])
