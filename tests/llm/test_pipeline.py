"""The pipeline stage by stage against plain Python over the same rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from lakevault.llm import toxicity
from test_near_dedup import _brute as near_classes


def _draw(seed, doc_id, rate):
    pieces = max(1, math.ceil(rate / 8))
    mean, count = rate / pieces, 0
    for i in range(1, pieces + 1):
        u = int(hashlib.md5(f"{seed}|{doc_id}|{i}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-mean)
        k = 0
        while c <= u and k < 63:
            k += 1
            p *= mean / k
            c += p
        count += k
    return count


def test_stages_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.union(docs.filter("doc_id in (3, 4)")).unionByName(spark.createDataFrame([(90_000, None, None, None, None), (90_001, "", "en", "src0", 0), (3, "same id, other text", "en", None, 19)], docs.schema)).coalesce(1)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "best_fit_packing":
            break
        assert out.columns == docs.columns
        got = [tuple(r) for r in out.collect()]
        if name == "toxicity":
            want = [r for r in rows if not model.thresholds or model.at_least(np.array([model.score(r[1] or "")]))[0, 0] < 0.5]
        elif name == "exact_dedup":
            best = {}
            for r in rows:
                key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
                best[key] = min(best.get(key, r), r, key=lambda x: x[0])
            want = list(best.values())
        elif name == "near_dedup":
            named = near_classes([(r[0], r[1]) for r in rows])
            keep = Counter((c, n) for _, c, n in named)
            assert len(got) == sum(v / n for (_, n), v in keep.items())
            assert {r[0] for r in got} == {c for _, c, _ in named}
            want = [r for r in rows if r in got]
        else:
            sizes = Counter(r[3] for r in rows)
            mass = sum(n**0.7 for n in sizes.values())
            want = [r for r in rows for _ in range(_draw(17, r[0], sizes[r[3]] ** 0.7 / mass * len(rows) / sizes[r[3]]))]
        assert Counter(got) == Counter(want), name
        rows, docs = got, spark.createDataFrame(got, docs.schema)
    pieces = out.collect()
    per_doc, places = defaultdict(int), defaultdict(list)
    for p in pieces:
        per_doc[p.doc_id] += p.length
        places[p.sequence_id].append((p.offset, p.length))
    assert set(per_doc) == {r[0] for r in rows}
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * math.ceil(sum(per_doc.values()) / 2048) + 1


def test_stages_on_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
