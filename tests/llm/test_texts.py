"""URL filters, licence scans, chat formatting: edge cases; WARC: round trips."""

import gzip
import hashlib
import os
import random

import pytest

from railpulse.llm import chat, licences, urls, warc
from railpulse.llm.common import table
from railpulse.llm.queries import op9_warc
from pyspark.sql import functions as F
from tests.conftest import SF


def test_url_rules(spark):
    given = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "example.org/es/": ("", "", None, "allow"),
        "http://EXAMPLE.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "https://a.b.example.org/en/12?x#y": ("a.b.example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "https://x.com/de/": ("x.com", "/de/", "com/de/", "block"), "https://x.com": ("x.com", "", None, "allow"),
        "https://x.com?/de/": ("x.com", "", None, "allow"), "a\nb://ÄX.com/fr/\n": ("Äx.com", "/fr/\n", "com/fr/", "allow"),
        "http://" + "l." * 3000 + "org/" + "p" * 9000: ("l." * 3000 + "org", "/" + "p" * 9000, "org/", "allow")}
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*given, *given])], "page_id long, url string, html string")
    got = urls.judge(pages, urls.rules_table(spark)).collect()
    assert len(got) == 2 * len(given)
    assert all((r.host, r.path, r.rule, r.verdict) == given[r.url] for r in got)
    assert urls.judge(pages.limit(0), urls.rules_table(spark)).collect() == []
    none = urls.judge(pages, urls.rules_table(spark).limit(0), default="block")
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "block")}


def test_columns_with_the_names_of_results_are_replaced(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/", "r", 2, "h", "p", "#", "kept")],
                                  "page_id long, url string, rule string, Verdict int, host string, path string, `#url` string, `a.b` string")
    got = urls.judge(pages, urls.rules_table(spark))
    assert got.columns == ["page_id", "url", "a.b", "rule", "verdict", "host", "path"]
    assert tuple(got.first()) == (1, "http://x.com/de/", "kept", "com/de/", "block", "x.com", "/de/")


def test_longest_host_before_longest_path(spark):
    rules = spark.createDataFrame([("allow", "org", "/aaaaaaaaaa"), ("block", "b.org", "/"), ("allow", "b.org", "/"), ("block", None, "/"), ("block", "c.org", None)],
                                  "verdict string, host string, path string")
    page = spark.createDataFrame([("http://b.org/aaaaaaaaaaaa",)], "url string")
    row = urls.judge(page, rules).first()
    assert (row.rule, row.verdict) == ("b.org/", "block")


def test_licence_edges(spark):
    rows = [(1, None), (2, ""), (3, "Licensed under\nTHE mit License!"), (4, "x\n\nLicensed under\nthe MIT License.\n \nrest of it"), (4, "MIT"), (5, "word " * 60_000 + "\nReleased under the MIT License."),
            (6, "Licensed under the Apache License, Version 2.0"), (6, "Licensed under the Apache License, Version 2.0")]
    docs = spark.createDataFrame([(i, t, "m") for i, t in rows], "doc_id long, text string, licence string")
    got = sorted(tuple(r) for r in licences.scan(docs).collect())
    assert got == [(3, "text", 0, "MIT", 1.0), (4, "paragraph", 1, "MIT", 1.0), (5, "line", 1, "MIT", 1.0), (6, "line", 0, "Apache-2.0", 1.0), (6, "line", 0, "Apache-2.0", 1.0)]
    assert licences.scan(docs.limit(0)).collect() == []


def test_notices_among_other_words(spark):
    mit = licences.TEMPLATES["MIT"][2]
    words = mit.split()
    wrapped = "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    header = "\n#\n".join(f"# {x}" for x in ["A module that reads trains.", "Copyright 2024 Foo", *wrapped.split("\n"), "The end of the header, and of all else there is."])
    given = {
        1: ("Copyright 2024 Foo. Released under the MIT License.", [("passage", 3, "MIT", 1.0)]),
        2: ("All of it is old. Licensed under CC BY 4.0. Parts are\nreleased under the MIT License, others not.", [("passage", 5, "CC-BY-4.0", 1.0), ("passage", 13, "MIT", 1.0)]),
        3: ("Some words first that are long enough to be more than a third of it all, since else the paragraph is found by itself. "
            "They go on for a while, as readers of such files know too well, and then there is still more of the same.\n" + wrapped + "\nand more", [("passage", 47, "MIT", 1.0)]),
        4: ("This work is licensed under the GNU General Public License, version 2.", [("line", 0, "GPL-2.0", 1.0)]),
        5: ("Released under the MIT License.\nSee also: licensed under the Apache License, Version 2.0, in parts.", [("line", 0, "MIT", 1.0), ("passage", 7, "Apache-2.0", 1.0)]),
        6: ("released or licensed, under the sun, the MIT folk, a License", [])}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in given.items()] + [(7, header), (8, "Copyright 2024 Foo. Released under the MIT License.")] * 2, "doc_id long, text string")
    got = [tuple(r) for r in licences.scan(docs).collect()]
    for i, (_, rows) in given.items():
        assert sorted(r[1:] for r in got if r[0] == i) == sorted(rows), i
    assert {r[3] for r in got if r[0] == 7} == {"MIT"}
    assert [r[1:] for r in got if r[0] == 8] == [("passage", 3, "MIT", 1.0)] * 2


def test_licence_texts(spark):
    bsd = licences.TEXTS["BSD-3-Clause"][0]
    given = {1: ("Copyright (c) 2024, Foo\n\n" + bsd.replace(". 2. ", ".\n\n2. ").replace(" 3. ", "\n\n3. ").replace(" THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS"), ("text", "BSD-3-Clause")),
             2: ("Copyright (c) 2024, Foo\n\n" + licences.TEXTS["BSD-2-Clause"][0], ("text", "BSD-2-Clause")),
             3: ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.", ("paragraph", "GPL-2.0")),
             4: ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n1. Definitions.", ("passage", "Apache-2.0")),
             5: ("/* " + licences.TEXTS["GPL-2.0"][2] + " */", ("line", "GPL-2.0")), 6: (licences.TEXTS["ISC"][0], ("text", "ISC"))}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in given.items()], "doc_id long, text string")
    got = [tuple(r) for r in licences.scan(docs).collect()]
    for i, (_, row) in given.items():
        assert row in {(r[1], r[3]) for r in got if r[0] == i}, (i, got)
        assert {r[3] for r in got if r[0] == i} == {row[1]}, (i, got)


def test_control_strings_come_back(spark):
    rng = random.Random(4)
    bits = ["<", "[", "\\", "\\\\", "s>", "/s>", "INST]", "/INST]", "image>", "x", "\n", "", "é", "<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "$1", "😀"]
    make = lambda: "".join(rng.choices(bits, k=rng.randrange(0, 12)))
    rows = [(i % 40, i, rng.choice(["user", "assistant", make()]), make()) for i in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    got = {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.unescape(F.col("formatted")).alias("u")).collect()}
    for conv, r in got.items():
        mine = [(a, b) for c, _, a, b in sorted(rows, key=lambda x: x[1]) if c == conv]
        assert [tuple(t) for t in r.back] == mine
        assert r.formatted.count("</s>") == len(mine)
        spans = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        assert len(spans) == sum(a == "assistant" for a, _ in mine)
    report = {r.conv_id: r for r in chat.report(made).collect()}
    for conv, r in report.items():
        mine = [(a, b) for c, _, a, b in sorted(rows, key=lambda x: x[1]) if c == conv]
        lost = "".join(b for a, b in mine if a == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(mine), len(lost), hashlib.sha256(lost.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()


def test_parts_become_placeholders(spark):
    parts = [("text", "see <ima", None, None), ("text", "ge> here ", None, None), ("image", None, "a.png", 4), ("audio", None, "b.wav", None), (None, "then", None, None), ("document", None, "c.pdf", 2)]
    rows = spark.createDataFrame([(None, None, "user", parts), (None, None, None, None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    row = chat.format_conversations(rows).first()
    assert row.formatted == "<s>[INST]</s><s>user[INST]see <\\image> here <image><audio>then<document></s>"
    assert [tuple(a) for a in row.attachments] == [("image", "a.png", 1024), ("audio", "b.wav", 25), ("document", "c.pdf", 1024)]
    assert row.attachment_tokens == 2073 and row.loss_spans == []
    assert chat.report(chat.format_conversations(rows.limit(0))).collect() == []


def test_odd_conversations(spark):
    """Null and very long texts, tied turns, repeated rows, null ids, and columns named like results."""
    long = "word </s> " * 60_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", long), (2, 5, "user", "b"), (2, 5, "user", "a"), (2, None, "assistant", "first"), (2, 5, "user", "a"),
            (None, 1, "assistant", "x"), (None, 1, "assistant", "x"), (3, 1, None, ""), (4, 1, "assistant", None)]
    df = spark.createDataFrame([(*row, "f", 1, "h", "t") for row in rows],
                               "conv_id long, turn long, role string, text string, formatted string, loss_spans int, head string, turns string")
    made = chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))))
    assert made.columns == ["conv_id", "formatted", "loss_spans", "attachments", "attachment_tokens"]
    back = {r.conv_id: [tuple(t) for t in r.back] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("back")).collect()}
    assert back == {1: [("user", ""), ("assistant", long)], 2: [("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")],
                    None: [("assistant", "x")] * 2, 3: [("", "")], 4: [("assistant", "")]}
    report = {r.conv_id: r for r in chat.report(made).collect()}
    assert report[1].loss_chars == len(long) and report[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert report[None].loss_chars == 2 and report[4].loss_chars == report[3].loss_chars == 0


def slow_records(rows):
    out, best = [], {}
    for page, html in rows:
        digest = warc.base32_sha1((html or "").encode())
        best.setdefault(digest, []).append(page)
    top = {d: max(p for p in pages) for d, pages in best.items()}
    for page, html in rows:
        data = (html or "").encode()
        digest = warc.base32_sha1(data)
        out.append((page, len(data), digest, "response" if page == top[digest] else "revisit", None if page == top[digest] else top[digest]))
    return sorted(out)


def test_pages_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]
    assert sorted(map(tuple, op9_warc(spark, SF).collect())) == slow_records(rows)


def test_archives(spark, scratch):
    rng = random.Random(1)
    rows = [(i * 3, rng.choice([None, "", "same\r\n\r\nWARC/1.1\r\n", f"<p>{i}é</p>" * rng.randrange(1, 400)])) for i in range(400)]
    pages = spark.createDataFrame([(i, "http://x/ y\r\n" if i % 2 else None, h, "r") for i, h in rows], "page_id long, url string, html string, record_type string")
    contents = []
    for n in (3, 5):
        folder = scratch.place("warc").replace("file:", "")
        listed = warc.write_archives(pages.repartition(n), folder, scratch, roll_bytes=20_000, shard_bytes=60_000)
        got = warc.read_archives(spark, folder).collect()
        assert sorted(tuple(r)[0:1] + (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == slow_records(rows)
        assert all(bytes(r.payload) == (dict(rows)[r.page_id] or "").encode() for r in got if r.record_type == "response")
        names = sorted(f for f in os.listdir(folder) if f.startswith("part"))
        assert names == sorted(r.file for r in listed.collect()) and len(names) > 5
        contents.append([open(f"{folder}/{f}", "rb").read() for f in names])
        for data in contents[-1]:
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert contents[0] == contents[1]


def test_archives_of_odd_rows(spark, scratch):
    pages = spark.createDataFrame([(5, None, "a"), (5, None, "a"), (5, "u", "b"), (None, None, "a"), (None, None, None), (9, None, "x" * 3_000_000)], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.report(pages, scratch).collect()), key=str)
    assert got == [(5, "response", None, 1), (5, "response", None, 1), (5, "revisit", 5, 1), (9, "response", None, 3_000_000), (None, "response", None, 0), (None, "revisit", 5, 1)]
    assert warc.report(pages.limit(0), scratch).collect() == []
    small = warc.report(pages, scratch, least_revisit=2)
    assert {r.record_type for r in small.collect()} == {"response"}


def test_archives_keep_wide_ids(spark, scratch):
    # As doubles, neighbours here are the same number.
    top = 1 << 62
    rows = [(top + i, f"page {i // 3}") for i in range(30)]
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    assert sorted(tuple(r) for r in warc.report(pages, scratch).collect()) == slow_records(rows)
    nulls = pages.unionAll(spark.createDataFrame([(None, None, "page 0"), (None, None, "no id")], pages.schema))
    got = [tuple(r) for r in warc.report(nulls, scratch).collect()]
    assert sorted(r for r in got if r[0] is not None) == slow_records(rows)
    assert sorted((r[3], r[4] or 0) for r in got if r[0] is None) == [("response", 0), ("revisit", top + 2)]


def test_archives_of_the_whole_id_range(spark, scratch):
    rows = [(i, f"page {n % 4}") for n, i in enumerate([-(1 << 63), -(1 << 62) - 1, -1, 0, 1, (1 << 62) + 1, (1 << 63) - 2, (1 << 63) - 1])]
    pages = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    assert sorted(tuple(r) for r in warc.report(pages, scratch).collect()) == slow_records(rows)


@pytest.mark.parametrize("least", [0, 5_000])
def test_hot_payloads_are_spread_over_shards(spark, scratch, least):
    size = 1_000
    rows = [(None, None, "h" * size)] * 200 + [(7, f"u{i}", "g" * size) for i in range(150)]
    rows += [(1_000_000 + i % 5, None, "c" * size) for i in range(100)] + [(2_000_000, None, f"{i:0{size}}") for i in range(60)]
    rows += [(10**9 * i, None, "alone") for i in range(1, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    folder = scratch.place("warc").replace("file:", "")
    files = warc.write_archives(pages, folder, scratch, shard_bytes=20_000, least_revisit=least)
    held = {r.shard: r.n for r in files.groupBy("shard").agg(F.sum("records").alias("n")).collect()}
    # 13 of these rows fill a shard; parts by hash or turn may hold some more, but none what a group holds.
    assert sum(held.values()) == len(rows) and max(held.values()) <= 40
    got = warc.read_archives(spark, folder).collect()
    assert sorted((r.page_id or 0, r.payload_bytes) for r in got) == sorted((p or 0, len(h)) for p, _, h in rows)
    responses = sorted((r.page_id or 0, r.payload_digest) for r in got if r.record_type == "response")
    top = {}
    for page, _, html in rows:
        top[html] = max(top.get(html, 0), page or 0)
    want = [(page, warc.base32_sha1(html.encode())) for html, page in top.items()] if not least else [(p or 0, warc.base32_sha1(h.encode())) for p, _, h in rows]
    assert responses == sorted(want)
    assert all((r.refers_to or 0) == top[next(h for h in top if warc.base32_sha1(h.encode()) == r.payload_digest)] for r in got if r.record_type == "revisit")


def test_each_task_writes_one_shard(spark, scratch):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.repeat(F.sha1(F.col("id").cast("string")), 25).alias("html"))
    folder = scratch.place("warc").replace("file:", "")
    files = warc.write_archives(pages, folder, scratch, shard_bytes=20_000)
    records = [r.n for r in files.groupBy("shard").agg(F.sum("records").alias("n")).collect()]
    assert sum(records) == 400 and len(records) >= 30 and max(records) <= 13
