"""WARC, chat formatting and licence scans."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from skyledger.llm import chat, license, warc
from skyledger.llm.common import fresh_path, remove


def archive(spark, rows, **options):
    warc.register(spark)
    path = fresh_path(spark, "test-archive")
    pages = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string")
    warc.deduplicated(pages.repartition(3), "page_id", "url", "html", **options).write.format("warc").mode("append").save(path)
    return path


PAGES = [(3, "http://a/1", "<p>same</p>"), (1, "http://a/2", "<p>same</p>"), (2, "http://b/\r\nx", "<p>é ü 你</p>\r\n\r\n"), (4, None, None), (5, "u", ""), (6, "u", "z" * 300_000), (1, "http://a/2", "<p>same</p>"), (None, "n", "<p>same</p>"), (8, "q", "WARC/1.1\r\n\r\n")]


def test_round_trip(spark):
    path = archive(spark, PAGES)
    found = spark.read.format("warc").option("verify", "true").load(path).collect()
    assert len(found) == len(PAGES)
    by = {}
    for r in found:
        by.setdefault(r.record_id, []).append(r)
    assert {r.record_type for r in by["<urn:page:1>"]} == {"response"} and len(by["<urn:page:1>"]) == 2
    (three,) = by["<urn:page:3>"]
    assert (three.record_type, three.refers_to, three.payload_bytes, bytes(three.payload)) == ("revisit", "<urn:page:1>", 11, b"")
    assert by["<urn:page:>"][0].record_type == "response"
    for number, _, html in PAGES:
        if number not in (3, None):
            data = (html or "").encode()
            r = by[f"<urn:page:{number}>"][0]
            if r.record_type == "response":
                assert bytes(r.payload) == data
            assert r.payload_bytes == len(data) and r.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert by["<urn:page:5>"][0].refers_to == "<urn:page:4>"  # empty payloads are equal too
    assert by["<urn:page:2>"][0].target_uri == "http://b/  x"
    remove(spark, path)


def test_urls_with_the_line_ends_of_other_rules(spark):
    """Only line feeds end a header line: other characters that end lines elsewhere belong to the value."""
    ends = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    urls = [f"http://a/{c}{more}" for c in ends for more in ("end", "WARC-Type: revisit", "WARC-Record-ID: <urn:page:99>", "WARC-Refers-To: <urn:page:7>", " x: y")]
    urls += ["http://a/\r\nWARC-Type: revisit", "http://a/\nWARC-Record-ID: <urn:page:99>", "a: b: c", ":"]
    path = archive(spark, [(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)])
    found = {r.record_id: r for r in spark.read.format("warc").option("verify", "true").load(path).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        r = found[f"<urn:page:{i}>"]
        assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, f"<p>{i}</p>".encode())
        assert r.target_uri == url.replace("\r", " ").replace("\n", " ")
    read = spark.read.format("warc").load(path)
    assert read.where(F.col("target_uri") == urls[3]).count() == 1 and read.where("record_type = 'revisit'").count() == 0


def test_least_bytes_and_empty_tables(spark):
    path = archive(spark, PAGES, least_bytes=12)
    assert {r.record_type for r in spark.read.format("warc").load(path).collect()} == {"response"}
    assert spark.read.format("warc").load(archive(spark, [])).count() == 0


def test_predicates_reach_the_headers(spark, monkeypatch):
    path = archive(spark, PAGES)
    source = spark.read.format("warc").load(path)
    wanted = source.where((F.col("record_type") == "response") & F.col("target_uri").startswith("http://a"))
    assert {r.record_id for r in wanted.collect()} == {"<urn:page:1>"}
    assert source.where("record_type = 'revisit'").count() == 2
    assert {r.payload for r in spark.read.format("warc").option("payload", "false").load(path).collect()} == {None}
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 3)]))
    assert [type(f) for f in left] == [GreaterThan]
    read = {}
    true = warc._payload
    monkeypatch.setattr(warc, "_payload", lambda block, size, header: read.setdefault(header["warc-record-id"], true(block, size, header)))
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert rows == 2 and set(read) == {"<urn:page:3>", "<urn:page:5>"}  # other payloads are never looked at


def test_files_of_other_tools_and_lost_attempts(spark, tmp_path):
    record = warc.record({"payload": b"hello" * 5000, "record_type": "response", "record_id": "<urn:x>"})
    plain = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(plain) + gzip.compress(record) + warc.member(record))
    warc.register(spark)
    found = spark.read.format("warc").load(str(tmp_path)).orderBy("record_type").collect()
    assert [(r.record_type, r.payload_bytes) for r in found] == [("response", 25_000), ("response", 25_000), ("warcinfo", 3)]
    assert spark.read.format("warc").load(str(tmp_path)).where("record_type = 'warcinfo'").count() == 1
    path = archive(spark, PAGES)
    (tmp_path / "x").mkdir()
    with open(path.removeprefix("file://") + "/part-lost.warc.gz", "wb") as out:
        out.write(warc.member(record))
    assert spark.read.format("warc").load(path).count() == len(PAGES)
    (tmp_path / "x" / "bad.warc.gz").write_bytes(warc.member(record)[:-20])
    with pytest.raises(Exception, match="ends early"):
        spark.read.format("warc").load(str(tmp_path / "x")).collect()
    assert os.path.exists(path.removeprefix("file://"))


def plain_record(number, body):
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{number}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_no_record_is_lost(spark, tmp_path):
    """Several records in a member, records over several members, plain files, subfolders; read whole and with predicates."""
    warc.register(spark)
    bodies = {i: (b"x%d\r\n\r\nWARC/1.0\r\n" % i) * (1 + 9000 * (i % 4 == 1)) for i in range(24)}
    made = [plain_record(i, bodies[i]) for i in range(24)]
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "three.warc.gz").write_bytes(gzip.compress(b"".join(made[0:3])) + warc.member(b"".join(made[3:6])) + b"".join(map(warc.member, made[6:9])) + b"\0" * 40)
    (tmp_path / "a" / "b" / "plain.warc").write_bytes(b"".join(made[9:14]))
    whole = b"".join(made[14:18])
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(gzip.compress(whole[at : at + 7777]) for at in range(0, len(whole), 7777)))
    (tmp_path / "b.warc").write_bytes(b"\r\n".join(made[18:24]).replace(b"Content-Length", b"X-Long: one\r\n two\r\nContent-Length"))
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "c.warc").write_bytes(b"never read")
    found = spark.read.format("warc").load(str(tmp_path))
    assert {r.record_id: bytes(r.payload) for r in found.collect()} == {f"<urn:page:{i}>": b for i, b in bodies.items()} and found.count() == 24
    for i in range(24):
        assert [bytes(r.payload) for r in found.where(F.col("record_id") == f"<urn:page:{i}>").collect()] == [bodies[i]]
    lengths = spark.read.format("warc").option("payload", "false").load(str(tmp_path)).collect()
    assert {r.record_id: r.payload_bytes for r in lengths} == {f"<urn:page:{i}>": len(b) for i, b in bodies.items()}
    assert spark.read.format("warc").load(str(tmp_path / "a" / "b" / "plain.warc")).count() == 5


@pytest.mark.parametrize("name, data, told", [
    ("a.warc", plain_record(1, b"x" * 90_000)[:-50_000], "ends early"), ("b.warc", plain_record(1, b"x") + b"none", "not a WARC"), ("c.warc.gz", gzip.compress(plain_record(1, b"x" * 90_000)[:-50_000]), "ends early"),
    ("d.warc.gz", b"PK no archive at all", "not a WARC"), ("e.warc.zst", b"", "neither"), ("f.warc", b"WARC/1.0\r\nWARC-Type: x\r\n\r\n", "Content-Length"), ("g.warc.gz", warc.member(plain_record(1, b"x" * 90_000))[:-30], "ends early"),
])
def test_what_cannot_be_read_is_an_error(spark, tmp_path, name, data, told):
    warc.register(spark)
    (tmp_path / name).write_bytes(data)
    for wanted in ("true", "record_type = 'none'"):
        with pytest.raises(Exception, match=told):
            spark.read.format("warc").load(str(tmp_path)).where(wanted).collect()


def test_many_equal_payloads_take_the_filter(spark, monkeypatch):
    rows = [(i, "u", f"text {i % 40 if i % 3 else i}") for i in range(300)] + [(None, "u", "text 1"), (1, "u", "text 1"), (5, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    key = lambda r: str(r)
    broadcast = sorted(map(key, warc.deduplicated(pages, "page_id", "url", "html").collect()))
    monkeypatch.setattr(warc, "FIRSTS", 2)
    for bits in (64, 1 << 20):
        monkeypatch.setattr(warc, "FILTER_BITS", bits)
        assert sorted(map(key, warc.deduplicated(pages, "page_id", "url", "html").collect())) == broadcast


def test_appends_add_and_overwrite_replaces(spark, tmp_path):
    warc.register(spark)
    path = f"file://{tmp_path}/archive"

    def write(first, mode):
        pages = spark.createDataFrame([(first + i, "u", f"text {first + i}") for i in range(4)], "page_id long, url string, html string")
        warc.deduplicated(pages.repartition(2), "page_id", "url", "html").write.format("warc").mode(mode).save(path)
        return sorted(int(r.record_id[10:-1]) for r in spark.read.format("warc").option("verify", "true").load(path).collect())

    assert write(0, "append") == [0, 1, 2, 3]
    assert write(10, "append") == [0, 1, 2, 3, 10, 11, 12, 13]
    assert write(20, "append") == [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23]
    assert write(30, "overwrite") == [30, 31, 32, 33]
    assert write(40, "append") == [30, 31, 32, 33, 40, 41, 42, 43]
    (only,) = {p for p in (tmp_path / "archive").glob("_files-*.json") if b"part" in p.read_bytes()} - {max((tmp_path / "archive").glob("_files-*.json"), key=os.path.getmtime)}
    only.rename(tmp_path / "archive" / "_files.json")  # as earlier versions named it
    assert write(50, "append") == [30, 31, 32, 33, 40, 41, 42, 43, 50, 51, 52, 53]
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.warc.gz").write_bytes(warc.member(warc.record({"payload": b"x", "record_type": "response", "record_id": "<urn:page:7>"})))
    path = f"file://{tmp_path}/other"
    assert write(0, "append") == [0, 1, 2, 3, 7]


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b <|im_sep|> \\ <\\| <"), (1, 3, "user", "<|im_end|>\n<|im_start|>assistant\nno"), (1, 4, "assistant", "|\\\\|end\\"),
    (2, 5, "assistant", ""), (2, 1, None, None), (2, 1, "we\\nird\nrole<|", "x\n"), (None, 0, "user", "no id"), (3, None, "assistant", "é\U0001f600" * 9000), (3, 0, "assistant", "t"), (3, 0, "assistant", "t"),
]


def test_chat_is_reversible(spark):
    df = spark.createDataFrame([(*r, "x") for r in TURNS], "conv_id long, turn long, role string, text string, formatted string").repartition(4)
    made = chat.format_conversations(df)
    back = made.select("conv_id", "formatted", "loss_spans", chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    found = {r.conv_id: r for r in back.collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, None):
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in TURNS if r[0] == conv), key=key)]
        got = found[conv]
        assert [(t.role, t.text) for t in got.turns] == want
        assert list(got.loss) == [t for r, t in want if r == "assistant"]
        blocks = sum(1 for i, (r, _) in enumerate(want) if i == 0 or want[i - 1][0] != r)
        assert got.formatted.count("<|im_start|>") == blocks == got.formatted.count("<|im_end|>")
        assert all(0 <= s.start and s.start + s.length <= len(got.formatted) for s in got.loss_spans)
    assert chat.format_conversations(df.limit(0)).count() == 0
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan


def test_long_conversations(spark):
    """Many turns, with runs of one role; spans point at each assistant text."""
    turns = [(7, i, "assistant" if i * i % 7 < 3 else "user", f"t{i} <| \\" * (i % 3)) for i in range(5000)]
    made = chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4))
    (row,) = made.select("formatted", chat.turns_of(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert [(t.role, t.text) for t in row.turns] == [t[2:] for t in turns] and list(row.loss) == [t[3] for t in turns if t[2] == "assistant"]
    assert row.formatted.count("<|im_start|>") == 1 + sum(a[2] != b[2] for a, b in zip(turns, turns[1:]))


def test_licences(spark):
    texts = [
        "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words here.", "all RIGHTS reserved", "Released under the MIT License", "Released under the M.I.T. License!", None, "", "nothing of the kind\n\n" * 50,
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in\nthe Software without restriction.", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "word " * 60_000, "all all all rights rights reserved",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x"), (None, texts[2], "x")], "doc_id long, text string, license string")
    made = license.scan(df, "doc_id", "text")
    found = [(r.doc_id, r.n_matches, r.license) for r in made.orderBy(F.col("doc_id").asc_nulls_last()).collect()]
    assert found == [
        (0, 1, "apache-2.0"), (1, 1, "all-rights-reserved"), (1, 1, "all-rights-reserved"), (2, 1, "mit"), (3, 0, None), (4, 0, None), (5, 0, None), (6, 0, None), (7, 1, "mit-notice"), (8, 2, "cc-by-nc-4.0"), (9, 0, None), (10, 0, None), (None, 1, "mit"),
    ]
    assert license.scan(df.limit(0), "doc_id", "text").count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in license.scan(df, "doc_id", "text")._jdf.queryExecution().sparkPlan().toString()


def test_licences_beside_other_words(spark):
    long = dict(license.TEXTS)
    texts = [
        "Copyright (c) 2024 Example Corp. All rights reserved.", "Copyright 2024 Some Body. Licensed under the Apache License, Version 2.0.", "This tool is free. Released under the MIT License. Have fun with it, whoever you are.",
        "MIT License\n\nCopyright (c) 2024 Some Body\n\n" + long["mit-grant"] + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND.", "#!/bin/sh\n#\n# Copyright 2024\n#\n# " + long["apache-2.0-header"].replace("License", "\n# License") + "\n#\nset -e\n",
        "/*\n * Copyright (c) 2024\n *\n * " + long["bsd-conditions"].replace(". ", ".\n * ") + "\n */\nint x;", "the rights of the reserved seats and an Apache helicopter license",
    ]
    found = {r.doc_id: r for r in license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()}
    assert [found[i].license for i in range(7)] == ["all-rights-reserved", "apache-2.0", "mit", "mit-grant", "apache-2.0", "bsd-conditions", None]  # the first of equal ones
    assert [found[i].n_matches for i in range(3, 6)] == [2, 3, 2]
    assert all(found[i].n_matches > 0 and found[i].dice >= 0.95 for i in range(6)) and found[6].n_matches == 0


def test_whole_licences(spark):
    """Texts as they are, wrapped anew, behind comment signs, and within prose; and the system's own copies where it has some."""
    import textwrap

    prose = "It was a long walk over the hills, and the licence of the old inn had run out. "
    forms = []
    for name, text in license.TEXTS:
        words = text.split()
        fewer = " ".join(w for i, w in enumerate(words) if i % 25)
        forms += [(name, f) for f in (text, textwrap.fill(text, 60), textwrap.indent(textwrap.fill(text, 50), " * "), prose * 30 + text + " " + prose * 30, prose + fewer + prose)]
    for name, family in (("BSD", "bsd"), ("GPL-2", "gpl"), ("GPL-3", "gpl"), ("Apache-2.0", "apache"), ("MPL-2.0", "mpl"), ("LGPL-2.1", "lgpl")):
        if os.path.exists(path := f"/usr/share/common-licenses/{name}"):
            with open(path) as found:
                forms.append((family, found.read()))
    found = {r.doc_id: r for r in license.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(forms)], "doc_id long, text string").repartition(8), "doc_id", "text").collect()}
    for i, (name, _) in enumerate(forms):
        assert name.split("-")[0] in {x.split("-")[0] for x in (found[i].licenses or "").split(",")}, (name, i, found[i])
    clean = spark.createDataFrame([(0, prose * 50), (1, "permission granted subject to conditions of the software " * 9)], "doc_id long, text string")
    assert all(r.license is None for r in license.scan(clean, "doc_id", "text").collect())


def test_licences_match_their_sql(spark):
    import duckdb
    from skyledger.llm.queries import ORACLES

    short, long = dict(license.TEMPLATES), dict(license.TEXTS)
    texts = [
        None, "", "x", short["mit"], "y " + short["mit"] + " z", short["mit"] + "\n" + short["mit"], "A " * 9 + long["mit-text"] * 2, long["isc-text"].replace("hereby", "gladly"), " ".join(long["zlib-text"].split()[::2]), "all rights all rights reserved reserved",
        "rights reserved all rights reserved by " + short["gpl-3.0"], long["gpl-2.0-header"] + " " + long["gpl-3.0-header"], "# " + long["apache-2.0-header"].replace("the ", "\n# the "), *(long[k][n:] for k in long for n in (40, 200)),
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = license.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").orderBy("doc_id").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(f"SELECT doc_id, n_matches, license, dice, licenses FROM ({ORACLES['op10_license_dice']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in found] == want and sum(r.n_matches > 0 for r in found) > 25


def test_size_bounds_are_tight():
    for n in range(1, 40):
        low, high = license.bounds(n, 0.8)
        dice = lambda a, b: 2 * min(a, b) / (a + b)
        assert all((dice(m, n) >= 0.8 - 1e-12) == (low <= m <= high) for m in range(1, 200))
