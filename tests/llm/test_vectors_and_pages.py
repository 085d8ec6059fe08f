import base64
import collections
import gzip
import hashlib
from pathlib import Path

import numpy as np

from quotemill.llm import itq, warc
from quotemill.llm.graph import components


def plain_links(rows, threshold=0.93):
    ok = [(k, label, np.array(v, float)) for k, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = collections.Counter(), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, la, x) in enumerate(ok):
        for b, lb, y in ok[:n]:
            if la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return collections.Counter((i, links[k], least.get(top(k)) if k in {x[0] for x in ok} else i, i is not None and i == (least.get(top(k)) if k in {x[0] for x in ok} else i)) for k, (i, _, _) in enumerate(rows))


def vectors():
    rng, rows = np.random.default_rng(2), []
    for g in range(25):
        base = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 7))):
            rows.append((len(rows), [float(np.float32(x)) for x in base + rng.normal(size=32) * 0.12], g % 3))
    rows += [(len(rows), rows[0][1], rows[0][2]), (len(rows) + 1, rows[0][1], 9), (7, rows[0][1], rows[0][2])]
    return rows + [(800, None, 1), (801, [], 1), (802, [0.0] * 32, 1), (803, [None] + [1.0] * 31, 1), (804, [float("nan")] + [1.0] * 31, 1), (805, [1.0] * 32, None),
                   (806, [1.0, 0.0], 1), (807, [2.0, 0.1], 1), (None, rows[0][1], rows[0][2]), (808, [float("inf")] * 32, 1)]


def test_links_equal_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = collections.Counter(map(tuple, itq.near_duplicates(table).collect()))
    want = plain_links(rows)
    found, there = sum(k[1] * n for k, n in got.items()), sum(k[1] * n for k, n in want.items())
    assert 0.9 * there <= found <= there
    if found == there:
        assert got == want
    assert itq.near_duplicates(table.limit(0)).count() == 0
    odd = table.selectExpr("*", "'own' AS node", "1 AS weight", "2 AS size", "3 AS v")
    assert collections.Counter(map(tuple, itq.near_duplicates(odd).collect())) == got


def test_hot_buckets_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in base + rng.normal(size=16) * 0.02], 1) for i in range(150)]
    got = itq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["n_links"] for r in got) >= 0.9 * 150 * 149 and max(r["n_links"] for r in got) <= 149


def test_recall_of_planted_pairs_near_the_limit(spark):
    rng, rows = np.random.default_rng(11), []
    for k in range(900):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (y @ x) * x
        cosine = rng.uniform(0.931, 0.95)
        z = cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y)
        rows += [(2 * k, [float(v) for v in x], k % 3), (2 * k + 1, [float(v) for v in z], k % 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    groups = [np.array([r[2] for r in rows]) == k for k in range(3)]
    there = sum(int((unit[i] @ unit[i].T >= 0.93).sum()) - int(i.sum()) for i in groups)
    found = sum(r["n_links"] for r in itq.near_duplicates(table).collect())
    assert there >= 1800 and 0.9 * there <= found <= there


def test_more_vectors_get_longer_substrings():
    sizes = [itq.tables_for(n) for n in (10, 10_000, 10_000_000, 10**9)]
    assert sizes == sorted(sizes) and sizes[0][0] == 8 and sizes[-1][0] == 27


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(61)} | {(k, 100) for k in range(100, 140)} | {(200, 200), (201, 200)}


PAGES = [
    (1, "http://a.example/x/", "<html><head><title>A &amp; B</title></head><body><p>One<br>two &eacute;</p><script>no()</script><a href='/y'>go</a><a href=z>go</a></body></html>"),
    (2, None, None), (3, "http://b.example", ""), (4, "::bad", "<a href='http://[x'>broken</a> plain < text"), (4, "::bad", "<a href='http://[x'>broken</a> plain < text"),
]


def test_derivatives(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    source = warc.responses(pages)
    records = warc.derive(source)
    rows = records.collect()
    assert len(rows) == 2 * len(PAGES) and warc.derive(warc.responses(pages.limit(0))).count() == 0
    ids = {r["record_id"]: r for r in source.collect()}
    for r in rows:
        parent = ids[r["refers_to"]]
        raw = r["block"].encode()
        assert r["content_length"] == len(raw) and r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r["source_payload_digest"], r["source_block_digest"], r["target_uri"]) == (parent["payload_digest"], parent["block_digest"], parent["target_uri"])
        if r["record_type"] == "metadata":
            assert f"source-payload-digest: {parent['payload_digest']}" in r["block"] and "source-content-type: text/html" in r["block"]
    first = {r["record_type"]: r["block"] for r in rows if r["page_id"] == 1}
    assert first["conversion"] == "One\ntwo é\ngo go" or first["conversion"] == "One\ntwo é\ngogo"
    assert "title: A & B" in first["metadata"] and "outlink: http://a.example/y" in first["metadata"] and "outlink: http://a.example/x/z" in first["metadata"]
    path = str(tmp_path / "warc")
    warc.write(records, path)
    read = []
    for f in Path(path).glob("*.gz"):
        data = gzip.decompress(f.read_bytes())
        while data:  # by the lengths in the headers, as a reader of the format does
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            read.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:size].decode()))
            assert head.startswith(b"WARC/1.1\r\n") and rest[size: size + 4] == b"\r\n\r\n"
            data = rest[size + 4:]
    assert sorted(read) == sorted((r["record_id"], r["refers_to"], r["block"]) for r in rows)
    odd = pages.selectExpr("*", "'own' AS record_id", "1 AS payload")
    assert sorted(map(str, warc.derive(warc.responses(odd)).collect())) == sorted(map(str, rows))
