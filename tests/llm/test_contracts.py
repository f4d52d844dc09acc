"""The registered queries against brute force over whole tables, and their SQL."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from tests.parity import database, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


def rows(spark, name):
    return [r.asDict() for r in __spark_entry__.queries()[name](spark, SF).collect()]


@pytest.mark.parametrize("name", ["op1_url_filters", "op3_minhash", "op6_quality_rules", "op9_exact_dedup"])
def test_sql_agrees(spark, name):
    frame = __spark_entry__.queries()[name](spark, SF)
    assert differences(frame, database(SF), __spark_entry__.oracle_sql()[name]) == []


def test_mix_is_near_its_targets(spark, docs):
    got = rows(spark, "op5_mix")
    assert sorted(r["doc_id"] for r in got) == sorted(docs.doc_id)
    sizes = {i: len(t.encode().split()) for i, t in zip(docs.doc_id, docs.text)}
    of_source = docs.assign(size=docs.doc_id.map(sizes)).groupby("source")["size"].sum()
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(of_source.index))}
    left, share, target = dict(of_source), 1.5 * of_source.sum(), {}
    while True:  # the contract's words, literally
        total = sum(weight[s] for s in left)
        over = [s for s in left if share * weight[s] / total > 2 * of_source[s]]
        if not over:
            target |= {s: share * weight[s] / total for s in left}
            break
        for s in over:
            target[s] = 2.0 * of_source[s]
            share -= target[s]
            del left[s]
    source = dict(zip(docs.doc_id, docs.source))
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (sizes[r["doc_id"]], of_source[s])
        assert r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 * 64 for s in target)
    assert sorted(map(str, got)) == sorted(map(str, rows(spark, "op5_mix")))


def test_packing_round_trip(spark, docs):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = rows(spark, "op7_packing")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs.doc_id)
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        at = 0
        for n, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part))
            assert n == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_quality_model_on_held_out_labels(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op4_quality_model")}
    assert set(got) == set(docs.doc_id)
    for doc_id, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    held = labels[[got[i]["held_out"] for i in labels.doc_id]]
    good = [got[i]["score"] for i in held.doc_id[held.quality == 1]]
    bad = [got[i]["score"] for i in held.doc_id[held.quality == 0]]
    assert len(bad) and np.mean([g > b for g in good for b in bad]) > 0.9


def test_pipeline_stages(spark, docs):
    import corpus_pipeline
    from tillwright.llm import near_dedup

    assert [f for _, f in corpus_pipeline.STAGES][-1] is corpus_pipeline.packed
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    names = frame.columns
    good = corpus_pipeline.good_quality(spark, frame, SF)
    assert good.columns == names
    kept = {r["doc_id"] for r in rows(spark, "op6_quality_rules") if r["kept"]}
    assert {r["doc_id"] for r in good.collect()} == kept
    exact = corpus_pipeline.exact_copies_out(spark, good, SF)
    first = {}
    for r in sorted(good.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(" ".join(r["text"].replace("\n", " ").split(" ")), r["doc_id"])
    assert {r["doc_id"] for r in exact.collect()} == set(first.values())
    near = corpus_pipeline.near_copies_out(spark, exact, SF)
    assert near.columns == names
    sets = {r["doc_id"]: set(near_dedup.shingle_set(r["text"], 5, near_dedup._WordHashes()).tolist()) for r in exact.collect()}
    assert {r["doc_id"] for r in near.collect()} == set(components_of(sets).values())
    mixed = corpus_pipeline.mixed(spark, near, SF)
    assert mixed.columns == names and mixed.count() <= near.count()
    words = {r["doc_id"]: Counter(r["text"].split()) for r in near.collect()}
    for r in mixed.collect():
        assert all(n <= 2 * words[r["doc_id"]][w] for w, n in Counter(r["text"].split()).items())
        assert r["n_chars"] == len(r["text"])
    assert corpus_pipeline.run(spark, SF).count() >= mixed.count()


def components_of(sets, percent=80):
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_url_and_sha_of_hand_made_rows(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(
        [
            (1, "HTTP://WWW.Example.COM/en/x?q"), (2, "http://a.example.com/en/"), (3, "http://b.net/es"),
            (4, "http://b.net/es/1#x"), (5, None), (6, "no scheme"), (7, "x://y://z.com/"), (8, "http://com"),
            (9, "http://cheap-pills.example.org/de"), (9, "http://cheap-pills.example.org/de"), (None, "http://evilcom/"),
        ],
        "page_id long, url string",
    ).write.parquet(f"{path}/pages.parquet")
    got = [tuple(r) for r in __spark_entry__.queries()["op1_url_filters"](spark, path).collect()]
    assert Counter(got) == Counter(
        [
            (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
            (2, "a.example.com", "/en/", "example.com/en/", "block"),
            (3, "b.net", "/es", None, "allow"),
            (4, "b.net", "/es/1", "net/es/", "block"),
            (5, "", "", None, "allow"),
            (6, "", "", None, "allow"),
            (7, "y:", "//z.com/", None, "allow"),
            (8, "com", "", None, "allow"),
            (9, "cheap-pills.example.org", "/de", None, "block"),
            (9, "cheap-pills.example.org", "/de", None, "block"),
            (None, "evilcom", "/", None, "allow"),
        ]
    )
