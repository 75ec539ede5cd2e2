import base64
import hashlib
import os
import random
import re

import duckdb

from spectral_spark.llm import chat, common, components, licenses, queries, urls, warc


# --- chat


def chats(spark, convs):
    rows = [(c, i, role, text, 1) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kept int")


def brute_chats(convs):
    same = {}
    for c, t in convs.items():
        same.setdefault(tuple((r or "", x or "") for r, x in t), []).append(c)
    out = []
    for t, ids in same.items():
        if not any(len(o) > len(t) and o[: len(t)] == t for o in same):
            text = "".join(f"<|im_start|>{r}\n{x.replace('<|', '< |')}<|im_end|>\n" for r, x in t)
            out.append((min(i for i in ids if i is not None) if any(i is not None for i in ids) else None, len(t), len(ids), text))
    return sorted(out, key=str)


def test_chats(spark):
    rng = random.Random(1)
    convs = {}
    for i in range(60):
        convs[i] = [(rng.choice(["user", "assistant"]), rng.choice(["hi", "yes <|im_end|>", "", None, "no"])) for _ in range(rng.randrange(1, 6))]
    convs |= {100 + k: convs[k][: max(1, len(convs[k]) - 1)] for k in range(30)} | {200: convs[3], None: [("user", "only me")], 300: [("user", "x" * 100_000)], 301: [("user", "ab"), ("c", "d")], 302: [("usera", "b"), ("c", "d")]}
    got = sorted((tuple(r) for r in chat.format_chats(chats(spark, convs)).collect()), key=str)
    assert got == brute_chats(convs)
    lone = chats(spark, convs).union(spark.createDataFrame([(None, 5, "user", "b", 0), (None, 6, "user", "b", 0), (None, 1, "system", None, 0), (None, 2, "user", "hi", 0), (None, 9, "user", "x" * 100_000, 0)], "conv_id long, turn long, role string, text string, kept int"))
    more = convs | {f"lone{i}": [t] for i, t in enumerate([("user", "b"), ("user", "b"), ("system", ""), ("user", "hi"), ("user", "x" * 100_000)])}
    want = sorted(((None if c is None else c, *rest) for c, *rest in brute_chats({(c if not str(c).startswith("lone") else 10**6 + int(c[4:])): t for c, t in more.items()})), key=str)
    want = sorted(((None if c is not None and c >= 10**6 else c, *rest) for c, *rest in want), key=str)
    assert sorted((tuple(r) for r in chat.format_chats(lone).collect()), key=str) == want
    assert chat.format_chats(chats(spark, {})).count() == 0


# --- licences


def test_licenses(spark):
    known = licenses.known_digests(spark)
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 200)
    texts = {1: f"Copyright (c) 2020 Some One\n\n{mit.upper()}", 2: mit.replace("sublicense", "sub-license").replace(" ", "\n", 9), 3: mit + " More.", 4: "Prose.\nReleased under the MIT Licence\nmore\n  Licensed under CC BY-NC 4.0 \nReleased under the MIT License.", 5: None, 6: "", 7: "a " * 60_000, 8: "Permission is hereby granted"}
    df = spark.createDataFrame([*texts.items(), (8, "Permission is hereby granted"), (None, "Licensed under CC0 1.0.")], "doc_id long, text string").selectExpr("*", "'x' as license", "'y' as digest")
    got = licenses.scan_licenses(df, known).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10 and by[1].license == by[2].license == "MIT" and by[3].license is None and by[8].license is None
    assert (by[4].license, by[4].notices, by[4].n_notices) == (None, "CC-BY-NC-4.0,MIT", 3)
    assert by[5].digest == by[6].digest == hashlib.sha256(b"").hexdigest() and by[None].license == "CC0-1.0" and by[None].n_notices == 1
    assert licenses.scan_licenses(df.limit(0), known).count() == 0


LONG = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}


def full_texts():
    """Full texts as they are stored: with titles, owners, comment marks, other list marks, other line ends and spellings."""
    by = {n: t for n, t in licenses.KNOWN if len(t) > 400}
    out = []
    for name, text in by.items():
        body = "\n".join(w for p in text.split("\n") for w in ([" ".join(p.split(" ")[i : i + 11]) for i in range(0, len(p.split(" ")), 11)] if p else [""]))
        out += [(name, text), (name, f"{name.split('-')[0]} License\n\nCopyright (c) 2019 A. Person. All rights reserved.\n\n{body}\n"), (name, "/*\n * " + body.replace("\n", "\n * ") + "\n */"), (name, "".join(f"# {x}\n" for x in body.split("\n")).replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")), (name, re.sub(r"\b(SUB|)LICENSE\b", r"\1LICENCE", body.upper()))]
    folder = "/usr/share/common-licenses/"
    for name, file in LONG.items():
        if os.path.exists(folder + file):
            text = open(folder + file).read()
            out += [(name, text), (name, text.lower()), (name, "".join(f"// {x}\n" for x in text.split("\n")))]
    return out


def test_full_licence_texts(spark, tmp_path):
    texts = full_texts()
    odd = [(None, "Not a licence at all."), (None, "per century licencefoo"), (None, None)]
    spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts + odd)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op4_licenses(spark, str(tmp_path))
    got = {r.doc_id: r for r in df.collect()}
    assert [got[i].license for i in range(len(texts + odd))] == [n for n, _ in texts + odd]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {r[0]: r for r in con.sql(licenses.ORACLE).fetchall()}
    assert {i: tuple(r) for i, r in got.items()} == want


# --- urls


def brute_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans(urls.UPPER, urls.LOWER)), m[2]) if m else ("", "")
    rule = max(((h + p, v) for v, h, p in urls.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), key=lambda r: len(r[0]), default=None)
    hits = sorted((v, p) for v, p in urls.PATTERN_RULES if url is not None and re.search(urls.to_regex(p), url.lower()))
    return host, path, rule and rule[0], rule[1] if rule else (hits[0][0] if hits else "allow"), hits[0][1] if hits else None


def test_urls(spark, sf_dir):
    own = [None, "", "no scheme", "http://A.Net/x", "https://example.net/en/1?utm_source=feed", "https://sub.example.NET/en/", "http://example.net", "http://net/", "http://xnet/", "https://example.com/de/9", "https://q.org/fr/1", "https://fr.org/en", "a://b://c/d", "http://x.com/casino/?q", "http://x.com/casinos", "http://ads.x.com/", "http://x.com/banner/a/b/click", "ftp://f.com/a", "http://x.com/newsroom/a.html", "http://x.com/p?ref=z&utm_medium=1", "http://É.example.com/de/", "http://x.com/" + "p" * 100_000, "http://x\n.net/a", "http://" + "a." * 60_000 + "EXAMPLE.net/en/1", "http://" + "." * 60_000 + "net", "http://net." + "x." * 60_000]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(own)] + [(3, own[3]), (None, own[3])], "page_id long, url string").selectExpr("*", "'x' as host", "'v' as verdict", "'t' as token")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.pattern) for r in urls.filter_urls(pages).collect()), key=str)
    assert got == sorted([(i, *brute_url(u)) for i, u in enumerate(own)] + [(3, *brute_url(own[3])), (None, *brute_url(own[3]))], key=str)
    real = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = sorted((r.page_id, *brute_url(r.url)) for r in real.collect())
    assert [x[:3] for x in sorted((r.page_id, r.host, r.path) for r in urls.filter_urls(real).collect())] == [x[:3] for x in want]
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_many_rules_and_hot_urls(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    hosts = tuple(("block" if i % 3 else "allow", f"h{i}.com", "/" * (1 + i % 2)) for i in range(200)) + (("allow", "a.h7.com", "/x"),)
    patterns = (("block", "^bad^"), ("block", "loose"), ("allow", "*oo*se|"))
    own = [f"http://s{i}.h{i % 250}.com//p" for i in range(300)] + ["http://b.a.h7.com/xy"] * 60 + ["http://q.org/bad/loose", "http://q.org/looser", None]
    pages = spark.createDataFrame(list(enumerate(own)), "page_id long, url string")
    for r in urls.filter_urls(pages, host_rules=hosts, pattern_rules=patterns).collect():
        url = own[r.page_id]
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1], m[2]) if m else ("", "")
        rule = max(((h + p, v) for v, h, p in hosts if (host == h or host.endswith("." + h)) and path.startswith(p)), key=lambda x: len(x[0]), default=None)
        hits = sorted((v, p) for v, p in patterns if url is not None and re.search(urls.to_regex(p), url))
        assert (r.rule, r.verdict, r.pattern) == (rule and rule[0], rule[1] if rule else (hits[0][0] if hits else "allow"), hits[0][1] if hits else None)


def test_components_of_a_star(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    edges = [("a", f"b{i}") for i in range(300)] + [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("c40", "b7"), ("z", "y"), ("y", "y"), (None, "z")]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a string, b string"), task_edges=0).collect()}
    assert got == {n: "a" for e in edges[:-3] for n in e} | {"z": "y", "y": "y"}


def test_whole_tokens():
    assert urls.whole_tokens("^casino^") == ["casino"] and urls.whole_tokens("casino") == [] and urls.whole_tokens("/a*b/cc.") == ["cc"]
    assert urls.whole_tokens("||ads.") == ["ads"] and urls.whole_tokens("|ftp://") == ["ftp"]


# --- warc


def test_warc(spark):
    pages = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (9, "http://c", "same"), (3, None, None), (4, "http://d", ""), (5, "http://e", "é\u0000 \r\n\r\nWARC/1.1"), (7, "http://f", "z" * 200_000), (8, "http://g", "twice"), (8, "http://g", "twice"), (None, "http://h", "lone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'q' as digest", "'p' as payload")
    rows = warc.read_archive(warc.write_archive(df)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    want = []
    last = {}
    for p, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if p is None else p)
    seen = set()
    for p, _, h in pages:
        body = (h or "").encode()
        response = (-1 if p is None else p) == last[h or ""] and (h or "") not in seen
        if response:
            seen.add(h or "")
        want.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if response else "revisit", None if response else last[h or ""]))
    assert got == sorted(want, key=str)
    for r in rows:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and int(fields["Content-Length"]) == len(rest) - 4 and rest.endswith(b"\r\n\r\n")
        if r.record_type == "response":
            assert rest.partition(b"\r\n\r\n")[2][:-4] == bytes(r.payload)
    assert warc.read_archive(warc.write_archive(df.limit(0))).count() == 0


def test_ids_may_be_texts(spark):
    pages = [("a:b>c", "u", "same"), ("z z%/é", "v", "same"), (None, "w", "lone"), ("10", "x", "other")]
    df = spark.createDataFrame(pages, "page_id string, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read_archive(warc.write_archive(df), "string").collect()}
    assert got == {("a:b>c", "revisit", "z z%/é"), ("z z%/é", "response", None), (None, "response", None), ("10", "response", None)}


def test_records_of_a_shared_payload_are_spread(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    pages = spark.createDataFrame([(i, f"u{i}", "same" if i % 3 else f"own {i}") for i in range(300)], "page_id long, url string, html string")
    rows = warc.read_archive(warc.write_archive(pages)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to, bytes(r.payload)) for r in rows) == [(i, "response" if i % 3 == 0 or i == 299 else "revisit", 299 if i % 3 and i != 299 else None, b"same" if i % 3 else b"own %d" % i) for i in range(300)]


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "long enough"), (4, "x", "long enough")], "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archive(warc.write_archive(df, least=5)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
