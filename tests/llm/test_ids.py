"""Ids of 64 bits next to nulls, and clashing column names, through every operator and pipeline stage."""

import hashlib
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from lakevault.llm import bitslice, chat, exact_dedup, fast_trie, near_dedup, packing, periodic_runs, poisson_mix, run_index, secrets, substring_dedup, toxicity, warc

B = 2**60
PASSAGE = " ".join(f"word{i}" for i in range(80))
TEXTS = [(B + 1, "zeta"), (B + 3, "zeta"), (None, "delta"), (B + 5, "eta"), (-B - 7, "old"), (B + 9, PASSAGE), (B + 11, PASSAGE + " end"), (None, None), (B + 13, "zeta")]
#: every name that a module adds to rows it carries, and some it uses inside
NAMES = ["row", "block", "digest", "kept", "own_digest", "kept_id", "kept_digest", "own_hash", "kept_hash", "text_hash", "class_id", "mix_source", "mix_pieces", "mix_cdf", "mix_count",
         "__own", "__hash", "__id", "__source", "__count", "__group", "packing_group", "severity", "grade", "n", "bands", "part", "keep_id"]


def docs_of(spark, rows):
    shape = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(i, t, "en", "web", len(t or ""), *[f"x{k}" for k in range(len(NAMES))]) for i, t in rows], shape)


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, TEXTS)


def test_exact_dedup(docs):
    got = Counter((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.dedup_documents(docs).collect())
    assert got == Counter([(B + 1, B + 1, True), (B + 3, B + 1, False), (B + 13, B + 1, False), (None, None, True), (B + 5, B + 5, True), (-B - 7, -B - 7, True),
                           (B + 9, B + 9, True), (B + 11, B + 11, True), (None, None, True)])
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text, r["__own"]) for r in kept.collect()) == Counter((i, t, f"x{NAMES.index('__own')}") for i, t in TEXTS if i not in (B + 3, B + 13))


def test_a_dead_lookup_shows(docs, monkeypatch):
    """Without the index's answer members would be groups of their own."""
    real = exact_dedup.probe_shard
    monkeypatch.setattr(exact_dedup, "probe_shard", lambda sizes, bitmap, keys: real(sizes, bitmap, keys) * 0 - 1)
    import pyarrow as pa

    keys = [hashlib.sha256(t).digest() for t in (b"a", b"b")]
    built = exact_dedup._build(pa.table({"digest": keys, "winner": [B + 1, B + 3], "size": [2, 1], "shard": pa.array([0, 0], pa.int32())}))
    asked = pa.table({"digest": keys[:1], "winner": [B + 9], "size": [4]})
    assert len(exact_dedup._looked_up(built, asked)) == 3
    monkeypatch.setattr(exact_dedup, "probe_shard", real)
    assert sorted(exact_dedup._looked_up(built, asked).to_pylist(), key=lambda r: r["keep_id"]) == [
        {"digest": keys[0], "keep_id": B + 1, "group_size": 6}, {"digest": keys[1], "keep_id": B + 3, "group_size": 1}]


def test_near_dedup(docs):
    got = {(r.doc_id, r.class_id) for r in near_dedup.classes(docs).collect() if r.doc_id in (B + 9, B + 11, B + 3)}
    assert got == {(B + 9, B + 9), (B + 11, B + 9), (B + 3, B + 1)}
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([B + 1, None, B + 5, -B - 7, B + 9, None])


def test_packing(docs):
    got = packing.pack_documents(docs, with_ids=True).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in TEXTS)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    pieces = packing.document_pieces(docs).withColumns({"__group": packing.F.lit("mine"), "packing_group": packing.F.lit("too")})
    carried = packing.pack_pieces(pieces).collect()
    assert {(r["__group"], r.packing_group) for r in carried} == {("mine", "too")} and len(carried) == len(got)


def test_mix(docs):
    plain = poisson_mix.mix(docs.select("doc_id", "text", "source"), total=40.0).collect()
    got = poisson_mix.mix(docs, total=40.0)
    assert got.columns == [*docs.columns, "copy", "shuffle_key"]
    rows = got.collect()
    assert Counter((r.doc_id, r.copy) for r in rows) == Counter((r.doc_id, r.copy) for r in plain) and rows
    assert {r["__source"] for r in rows} == {f"x{NAMES.index('__source')}"}


def test_toxicity(docs):
    model = toxicity.Model({"=zeta": 9.0}, (0.0, 0.0, 1.0), (1.0, 2.0))
    got = Counter((r.doc_id, r.toxic) for r in toxicity.score(docs, model).collect())
    assert got == Counter((i, t == "zeta") for i, t in TEXTS)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t in TEXTS if t != "zeta")


def test_run_index(docs):
    got = Counter((r.doc_id, r.n_bytes - len(r.kept)) for r in run_index.repeats(docs).collect())
    assert got == Counter((i, len(PASSAGE) if i == B + 11 else 0) for i, _ in TEXTS)


def test_periodic_runs(docs):
    assert Counter(r.doc_id for r in periodic_runs.periodic_runs(docs).collect()) == Counter(i for i, _ in TEXTS)


def test_secrets(docs):
    assert Counter(r.doc_id for r in secrets.scan_table(docs).collect()) == Counter(i for i, _ in TEXTS)


def test_substring_dedup(docs):
    found = {r.doc_id for r in substring_dedup.repeated_passages(docs).collect() if r.doc_id is not None}
    assert {B + 11} <= found <= {i for i, _ in TEXTS}


def test_warc(spark):
    page = "<p>" + "y" * 2000
    rows = [(B + 1, "u", page, 1), (B + 3, "u", page, 1), (None, "u", page, 1), (B + 5, "u", "short", 1), (-B - 1, "u", "z" * 1500, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_records(spark, warc.archive_pages(pages)).collect())
    assert got == Counter([(B + 1, "revisit", B + 3), (B + 3, "response", None), (None, "revisit", B + 3), (B + 5, "response", None), (-B - 1, "response", None)])


def test_search(spark):
    rows = [(B + 2 * i, [0.1 * i, 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = bitslice.search_table(df, bitslice.F.col("vec_id") == B + 10, k=2).collect()
    assert [(r.query_id, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(B + 10, B + 8), (B + 10, B + 6)]


def test_chat_and_trie(spark):
    rows = [(B + 1, 0, "user", "a"), (B + 3, 0, "user", "a"), (None, 0, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r.conv_id for r in chat.read_back(chat.format_windows(df)).collect()} == {B + 1, B + 3, None}
    assert {(r.conv_id, r.depth) for r in fast_trie.trie(df).collect()} == {(B + 1, 0), (B + 1, 1)}


def test_pipeline_stages_carry_ids_and_columns(spark, docs, tmp_path):
    labels = [(B + 1, 1), (B + 3, 1), (B + 13, 1), (B + 5, 0)] + [(-B - 100 - i, i % 2) for i in range(40)]
    many = docs_of(spark, TEXTS + [(-B - 100 - i, ("vile rotten awful filthy " if i % 2 else "mild kind warm ") + " ".join(f"w{(i * 7 + k) % 90}" for k in range(30))) for i in range(40)])
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, many, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == many.columns, name
        ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        assert ids <= {r.doc_id for r in many.select("doc_id").distinct().collect()} and len(ids) > 1, name
