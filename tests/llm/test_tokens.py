"""Byte-level BPE, packing and quality rules."""

import base64
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from skyledger.llm import bpe, packing, quality

RANKS, JSON, PATTERN, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, "a" * 70_000, "The the  THE\n\n\t x", "naïve café ☕ 你好 мир \U0001f600", " 's't're  '", "<|endoftext|> x", "\x85 a\x1cᤐb\U0001910b's", "ab" * 300, "  lead and trail  ", "x\r\n\r\ny"]


def noise(seed, n):
    draw = random.Random(seed)
    return ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(0x3000), draw.randrange(0xD800), draw.randrange(0x10000, 0x40000), 32, 10, 39, 115])) for _ in range(draw.randrange(1, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(reference):
    texts = [t or "" for t in ODD] + noise(1, 4000)
    for text, ids in zip(texts, bpe.encode_texts(texts, RANKS, PATTERN)):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert bpe.load(RANKS).decode(ids) == text.encode()


def test_replay_equals_word_by_word():
    coder, draw = bpe.load(RANKS), random.Random(4)
    words = [bytes(draw.choice(b"aeinsth \xc3\xa9") for _ in range(draw.randrange(1, 50))) for _ in range(3000)] + [b"a" * i for i in range(1, 200)]
    assert coder.corpus(words) == [[coder.ranks[w]] if w in coder.ranks else coder.alone(w) for w in words]
    assert coder.corpus([]) == []


def test_merges_that_become_possible_late():
    # "xab" ranks below "ab" but can't form from "xa": after "ab" forms, it comes before any other "ab".
    ranks = {bytes([b]): b for b in range(256)} | {b"xab": 256, b"ab": 257, b"abab": 258}
    coder = bpe.MergeReplay(ranks)
    for word in (b"xabab", b"xabxab", b"ababxab", b"aabab"):
        assert coder.corpus([b"q" + word])[0] == coder.alone(b"q" + word)


def test_one_long_word_alone_is_quick(reference):
    """A word as long as this took minutes when every merge copied the word."""
    coder, draw = bpe.load(RANKS), random.Random(8)
    word = "".join(draw.choice("etaoinshrdlu") for _ in range(200_000))
    start = time.monotonic()
    assert coder.alone(word.encode()) == reference.encode_ordinary(word)
    assert time.monotonic() - start < 30
    assert bpe.MergeReplay({b"a": 0, b"aa": 1}).alone(b"aaab") == [1, 0, -1]  # a byte that the vocabulary lacks


def test_columns_by_the_rules_of_the_session(spark, reference):
    df = spark.createDataFrame([(7, "some words")], "last long, Text string")
    coded = bpe.encode(df, "TEXT", RANKS, PATTERN, ids="Ids")
    assert np.frombuffer(coded.collect()[0].Ids, "<u4").tolist() == reference.encode_ordinary("some words")
    assert bytes(bpe.decode(coded, "IDS", RANKS).collect()[0].decoded) == b"some words"


def test_encode_keeps_rows_and_columns(spark, reference):
    rows = [(i, t, "old", 1.5) for i, t in enumerate([*ODD, ODD[3]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded double")
    found = bpe.encode(df, "text", RANKS, PATTERN, decoded="decoded").orderBy("doc_id").collect()
    assert [bytes(r.decoded).decode() for r in found] == [t or "" for _, t, _, _ in rows]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == [reference.encode_ordinary(t or "") for _, t, _, _ in rows]
    assert [bytes(r.decoded) for r in bpe.decode(bpe.encode(df, "text", RANKS, PATTERN), "ids", RANKS).orderBy("doc_id").collect()] == [bytes(r.decoded) for r in found]
    assert bpe.encode(df.limit(0), "text", RANKS, PATTERN).count() == 0


def check_packing(rows, documents, capacity=2048):
    model = Tokenizer.from_file(JSON)
    model.encode_special_tokens = True
    pieces = sorted(((r.doc_id is None, r.doc_id, r.start), r) for r in rows) if all(r.doc_id is not None for r in rows) else [((0, 0, 0), r) for r in rows]
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    by_doc = {}
    for _, r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    for number, text in documents:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[number], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    return padding


@pytest.mark.parametrize("pattern", [None, PATTERN])
def test_packing_is_whole_and_tight(spark, pattern):
    documents = list(enumerate([*ODD, *noise(2, 60), *[" ".join(noise(3 + i, 150)) for i in range(40)]]))
    df = spark.createDataFrame([(t, i, "x", 3) for i, t in documents], "text string, doc_id long, ids string, length int").repartition(3)
    rows = packing.pack(df, "doc_id", "text", JSON, pattern=pattern).collect()
    assert check_packing(rows, documents) <= 0.002 * sum(r.length for r in rows)
    full = Counter((r.sequence_id, r.class_k) for r in rows if r.class_k)
    assert all(n == k for (_, k), n in full.items())  # a fixed count of pieces in each bin of a class


def test_packing_odd_tables(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), "doc_id", "text", JSON).count() == 0
    rows = packing.pack(spark.createDataFrame([(None, None), (1, "a"), (1, "a"), (None, "b c")], schema), "doc_id", "text", JSON, pattern=PATTERN).collect()
    assert sum(r.length for r in rows) == 1 + 2 + 2 + 3
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], schema), "doc_id", "text", JSON, capacity=1000)


def test_cuts_use_class_sizes():
    sizes = {2048 // k for k in range(1, 2049)}
    for n in [*range(1, 2200), 9999]:
        found = list(packing.pieces(n, 2048))
        assert sum(found) == n and set(found) <= sizes and len(found) <= 5 + n // 2048


def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words)


def test_rules_match_a_plain_version(spark):
    draw = random.Random(9)
    texts = [*ODD, *noise(6, 50), "a b c d e f g h " * 9, "a b\na b\n\n a b\nc", " ".join(str(i % 11) for i in range(100)), " ".join(str(i % 211) for i in range(500)), " x y z"]
    texts += [" ".join(draw.choice("abcdefg") for _ in range(60)) for _ in range(60)] + [" ".join(str(draw.randrange(300)) for _ in range(400)) + " " + "u v w x y z 1 2 3 4 " * draw.randrange(4) for _ in range(20)]
    df = spark.createDataFrame([(i, t, None if i % 3 else "en", "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, kept string")
    found = quality.rules(df, "TEXT", "lang", PIECES, MULTI).orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found] == [plain_rules(t) for t in texts]
    assert all(not r.kept for r in found if r.base_failed)
    assert quality.rules(df.limit(0), "text", None, PIECES, MULTI).count() == 0


def test_fertility_measures():
    import base64

    import tiktoken

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(MULTI, "rb") as ranks:
        multi = tiktoken.Encoding("m", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks)}, special_tokens={})
    text = "Tokenisers split rare words into many pieces. ☃ \U000140ab \U000140ac"
    ids, chars = [i for w in text.split() for i in model.encode(w)], sum(map(len, text.split()))
    second = sum(len(multi.encode_ordinary(" " + w)) for w in text.split())
    made = quality.measure([text], PIECES, MULTI)
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert made["n_tokens"] == [len(ids)] and made["chars_per_token"] == [pytest.approx(chars / len(ids))]
    assert made["chars_per_token_multi"] == [pytest.approx(chars / second)] and made["fertility_ratio"] == [pytest.approx(second / len(ids))]
    assert made["byte_share"] == [pytest.approx(sum(model.is_byte(i) for i in ids) / len(ids))] and made["byte_share"][0] > 0
    assert made["relative_entropy"] == [pytest.approx(-(share * np.log2(share)).sum() / np.log2(len(ids)))]


def plain_verdicts(rows):
    """Verdicts of measured rows, a group at a time: outer bands, then those of the finest group with enough rows."""
    fine = [r for r in rows if not r.base_failed]
    least = max(50, -(-len(fine) // 1000))
    levels = [lambda r: (r.lang, r.script, r.length_class), lambda r: (r.lang, r.script), lambda r: (r.script, r.length_class), lambda r: r.script]
    bands = []
    for level in levels:
        groups = {}
        for r in fine:
            groups.setdefault(level(r), []).append(r)
        bands.append({})
        for key, held in groups.items():
            if len(held) >= least:
                for m in quality.FITTED:
                    values = sorted(r[m] for r in held)
                    low, middle, high = (values[max(0, -int(-len(values) * p // 1) - 1)] for p in (0.25, 0.5, 0.75))
                    spread = 4 * max(high - low, 0.02 * abs(middle))
                    bands[-1][key, m] = middle - spread, middle + spread
    out = []
    for r in rows:
        low, high, most = quality.SCRIPTS[r.script]
        kept = not r.base_failed and low <= r.chars_per_token <= high and low <= r.chars_per_token_multi <= high and r.byte_share <= most
        for m in quality.FITTED:
            found = [b[level(r), m] for level, b in zip(levels, bands) if (level(r), m) in b]
            kept = kept and (not found or found[0][0] <= r[m] <= found[0][1])
        out.append(kept)
    return out


def junk_kinds(good, draw, many=20):
    """Texts that pass the base rules but are no prose, a list for each kind, from documents (text, lang)."""
    shuffled = [(" ".join("".join(draw.sample(w, len(w))) for w in t.split()), lang) for t, lang in good[:many]]
    letters = [(" ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(2, 10))) for _ in range(150)), draw.choice(["en", "de", "fr", "es", None])) for _ in range(many)]
    noise = [(" ".join("".join(chr(draw.choice([0xA000, 0x1400, 0x14000]) + draw.randrange(400)) for _ in range(5)) for _ in range(80)), draw.choice(["en", None])) for _ in range(many)]
    template = [("\n".join(f"Item {draw.randrange(10**6)} has price {draw.randrange(10**4)} and stock {draw.randrange(10**3)}" for _ in range(60)), draw.choice(["en", "de"])) for _ in range(many)]
    wrong = [(t, {"en": "fr", "de": "es", "fr": "en", "es": "de"}[lang]) for t, lang in good if lang != "en"][:many]
    return {"shuffled letters": shuffled, "random letters": letters, "byte noise": noise, "one template": template, "wrong language": wrong}


def test_bands_catch_junk_and_keep_prose(spark):
    """Verdicts equal a plain version's; junk that passes the base rules mostly goes, good documents stay."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    rows = [tuple(r) for r in docs.collect()]
    kinds = junk_kinds([(t, lang) for i, t, lang in rows if i in good and len(t.split()) >= 40], random.Random(5))
    planted = [(-1000 * (k + 1) - j, t, lang) for k, held in enumerate(kinds.values()) for j, (t, lang) in enumerate(held)]
    found = quality.rules(spark.createDataFrame(rows + planted, docs.schema).repartition(5), "text", "lang", PIECES, MULTI, drop=("text",)).collect()
    assert [r.kept for r in found] == plain_verdicts(found)
    by = {r.doc_id: r for r in found}
    kept = [by[i].kept for i in good if not by[i].base_failed]
    assert len(kept) > 300 and sum(kept) >= 0.98 * len(kept)
    caught = {}
    for k, (kind, held) in enumerate(kinds.items()):
        passed = [by[-1000 * (k + 1) - j] for j in range(len(held)) if not by[-1000 * (k + 1) - j].base_failed]
        assert len(passed) >= 0.8 * len(held), kind
        caught[kind] = sum(not r.kept for r in passed) / len(passed)
    print(caught, sum(kept) / len(kept))
    assert min(caught[k] for k in caught if k != "wrong language") >= 0.9 and caught["wrong language"] >= 0.5, caught


def test_small_tables_have_the_outer_bands(spark):
    prose = "The committee met on Tuesday to consider whether the new library should open before the winter and who might pay for all of its books. "
    secret = " ".join("".join(chr(0x14000 + (i * 7 + j) % 500) for j in range(4)) for i in range(40))
    df = spark.createDataFrame([(1, prose, "en"), (2, secret, "en"), (3, secret, None), (4, None, None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality.rules(df, "text", "lang", PIECES, MULTI).collect()}
    assert [found[i].kept for i in (1, 2, 3, 4)] == [True, False, False, False] and not found[2].base_failed and found[1].chars_per_token_low is None
    assert quality.script("мир и труд") == "Cyrillic" and quality.script("") == "none" and quality.script("你好") == "CJK"


def test_crc_of_the_ids(spark):
    from skyledger.llm.queries import op1_harmonic_packing

    found = op1_harmonic_packing(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(found.columns)
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    model = Tokenizer.from_file(JSON)
    for r in found.limit(300).collect():
        ids = np.array([*model.encode(docs[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
