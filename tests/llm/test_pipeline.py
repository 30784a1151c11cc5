"""The pipeline's stages against brute-force versions, each on the rows that the one before it kept."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from larder.llm import classifier, quality
from larder.llm.bpe import encoder
from tests.llm.test_operators import DOCS, check_pieces, slow_base, slow_fingerprint, slow_removal, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, repetition, symbols, near copies, a shared passage; labels for two thirds of them; null and empty texts."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8))) for _ in range(600)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, base = say(60), say(150).split()
    clean = [say(rng.randint(20, 200)) for _ in range(150)] + [f"{say(40)} {passage} {say(40)}" for _ in range(6)]
    near = [" ".join(base)] * 3 + [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (10, 70)]
    junk = [" ".join(w + "%%%" for w in say(60).split()) for _ in range(30)] + [(rng.choice(vocabulary) + " ") * 60 for _ in range(20)]
    texts = clean + near + junk + [None, "", "too short"]
    rows = [(k, t, "en", f"s{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    good = len(clean) + len(near)
    labels = [(k, int(k < good), 0) for k in range(good + len(junk)) if k % 3]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), good


def test_stages_equal_brute_force(spark, folder, tmp_path):
    d, good = folder
    labels = spark.read.parquet(f"{d}/labels.parquet")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, d)
        if name != "mixture_packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        found = spark.read.parquet(f"{tmp_path}/{k}").collect()
        if name == "quality_rules":
            ratio = quality.fit_ratio(docs, labels)
            want = []
            for r in before:
                n, *_, repeated = slow_base(r.text)
                if n >= 10 and 100 * repeated <= 20 * n and quality.mean_ratio((r.text or "").encode(), ratio) >= quality.THRESHOLD:
                    want.append(r)
            assert Counter(found) == Counter(want)
            assert {r.doc_id for r in found} <= set(range(good))
        elif name == "quality_classifier":
            weights = classifier.fit(spark.read.parquet(f"{d}/documents.parquet"), labels)
            assert Counter(found) == Counter(r for r in before if classifier.probability((r.text or "").encode(), weights) >= 0.7)
            assert len(found) >= 0.95 * len(before)
        elif name == "simhash_dedup":
            fps = [slow_fingerprint(r.text) for r in before]
            label = [r.doc_id for r in before]
            while True:
                new = [min(label[j] for j in range(len(before)) if (fps[i] ^ fps[j]).bit_count() <= 3) for i in range(len(before))]
                if new == label:
                    break
                label = new
            assert Counter(found) == Counter(r for r, c in zip(before, label, strict=True) if r.doc_id == c)
            assert len(found) < len(before)
        elif name == "substring_dedup":
            left = slow_removal([r.text for r in before], 35)
            want = {r.doc_id: b" ".join(x).decode() if len(x) < len(words(r.text)) else r.text for r, x in zip(before, left, strict=True)}
            assert {r.doc_id: r.text for r in found} == want and len(found) == len(before)
            assert all(r.n_chars == len(r.text) for r in found)
            assert sum(len(w) for w in want.values()) < sum(len(r.text) for r in before)
        else:
            check_pieces(found, {r.doc_id: [[*encoder().encode(r.text.encode()).tolist(), 1]] for r in before}, 2048)
        kept[name] = found
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    whole = corpus_pipeline.run(spark, d)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter((r.doc_id, r.doc_tokens) for r in whole.select(names).collect()).keys() == Counter((r.doc_id, r.doc_tokens) for r in kept["mixture_packing"]).keys()
    assert sum(r.length for r in whole.collect()) == sum(r.length for r in kept["mixture_packing"])


def test_classifier_stage_rejects_without_examples_of_label_0_in_its_input(spark, folder):
    d, good = folder
    docs = spark.read.parquet(f"{d}/documents.parquet").filter("n_chars > 60")
    # Clean documents and junk without a label: among these rows there is no example of label 0.
    left = docs.filter((docs.doc_id < good) | (docs.doc_id % 3 == 0))
    found = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, left, d).collect()}
    clean, junk = ({r.doc_id for r in left.collect() if (r.doc_id < good) is side} for side in (True, False))
    assert len(junk) > 10 and len(found & clean) >= 0.95 * len(clean) and len(found & junk) <= 0.1 * len(junk)


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "mixture_packing":
            docs = out


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_dedup", "substring_dedup", "mixture_packing"]

