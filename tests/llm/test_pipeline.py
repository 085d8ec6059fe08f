import collections
import hashlib
import math

import corpus_pipeline
from quotemill.llm import mixing, secrets, toxicity
from tests.llm.fixtures import ODD, documents
from tests.llm.test_documents import plain_sets, tokenizer_ids

FOLDER = "/root/testdata/sf0.001"


def plain_mix(rows):
    units = collections.Counter()
    for r in rows:
        units[r["source"]] += max(1, len(r["text"] or ""))
    weight = {s: u**mixing.POWER for s, u in units.items()}
    out = collections.Counter()
    for r in rows:
        mean = weight[r["source"]] / sum(weight.values()) * sum(units.values()) / units[r["source"]]
        draws, n = max(1, math.ceil(mean / mixing.DRAW_MEAN)), 0
        for j in range(1, draws + 1):
            u = (int(hashlib.md5(f"{mixing.SEED}|{r['doc_id']}|{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            k, p = 0, math.exp(-mean / draws)
            c = p
            while c < u:
                k += 1
                p *= mean / draws / k
                c += p
            n += k
        out[r["doc_id"]] = n
    return out


def plain_groups(rows):
    sets = plain_sets([(r["doc_id"], r["text"] or "") for r in rows], 5)
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[top(k)] = min(least.get(top(k), i), i)
    return set(least.values())


def test_pipeline_equals_plain_stages(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    score = toxicity.train(docs, labels).scorer()
    rows = [r.asDict() for r in docs.collect() if score(r["text"] or "") < 0.5]
    kept = plain_groups(rows)
    rows = [r for r in rows if r["doc_id"] in kept]
    for r in rows:
        base = secrets.base_spans(r["text"])
        r["text"] = secrets.redacted(r["text"], base + secrets.novel_spans(r["text"], base))
    copies, want = plain_mix(rows), collections.Counter()
    for r in rows:
        ids = tokenizer_ids(r["text"])
        want[r["doc_id"], r["lang"], r["source"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()] += copies[r["doc_id"]]
    got = collections.Counter((r["doc_id"], r["lang"], r["source"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == +want


def test_every_stage_stands_odd_rows_and_none(spark, tmp_path):
    spark.createDataFrame([(4, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents(spark, ODD)
    for start in (docs, docs.limit(0)):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, str(tmp_path))
            assert name == "bpe_encoding" or out.columns == docs.columns
            at = spark.createDataFrame(out.collect(), out.schema)
        assert (at.count() == 0) == (start is not docs)


def test_stages_stand_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "secret_scans", "mixing", "bpe_encoding"] and corpus_pipeline.ORACLE_SQL is None
