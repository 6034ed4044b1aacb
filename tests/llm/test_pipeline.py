"""Every stage of the corpus pipeline on its own input against a plain version, on a small corpus with planted cases."""

import random
import re

import pytest

import corpus_pipeline
from rillsync.llm.subwords import vocabulary_path

WORDS = [
    f"{a}{b}{c}" for a in ("ba", "co", "di", "fu", "ge") for b in ("lo", "ma", "ne", "ri") for c in ("s", "t", "n", "")
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(9), tmp_path_factory.mktemp("corpus")
    item = " ".join(rng.choices(WORDS, k=40))
    texts = [" ".join(rng.choices(WORDS, k=60)) for _ in range(240)]
    toxic = set(range(0, 240, 4))
    for i in toxic:
        w = texts[i].split(" ")
        w[rng.randrange(60)] = w[rng.randrange(60)] = "blockhead"
        texts[i] = " ".join(w)
    texts[9], texts[13] = texts[1], texts[1] + " more"
    texts[21] = f"{texts[21]} {item} {texts[22]}"
    texts[33] += " password = hunter2hunter2"
    texts[37], texts[41] = None, ""
    spark.createDataFrame(
        [(i, t, "xx", "s", len(t or "")) for i, t in enumerate(texts)], COLUMNS
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        [(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, toxic, item


def shingled(text):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark, corpus):
    folder, texts, toxic, item = corpus
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), dict(enumerate(texts))
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns

    def step(name):
        nonlocal docs
        docs = corpus_pipeline.materialize(stages[name](spark, docs, folder), "test")
        assert docs.columns == columns
        return {r.doc_id: r.text for r in docs.collect()}

    got = step("toxicity")
    assert set(kept) - set(got) <= toxic and len(toxic & set(got)) <= 0.1 * len(toxic)
    kept, sets = got, {i: shingled(t) for i, t in got.items()}
    near = {
        (i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    }
    got = step("n-gram Jaccard join")
    assert near and got == {i: t for i, t in kept.items() if i not in {j for _, j in near}}
    kept, got = got, step("benchmark decontamination")
    assert got == {i: t for i, t in kept.items() if item not in (t or "")} and 21 in kept
    kept, got = got, step("secret scans")
    assert set(got) == set(kept) and {i for i in kept if got[i] != kept[i]} == {33} and "hunter2" not in got[33]
    from tokenizers import Tokenizer

    library, sizes = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), {}
    for r in stages["packing"](spark, docs, folder).collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in got.items()}


def test_run_is_its_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus[0]).collect()
    assert rows and 21 not in {r.doc_id for r in rows} and {33, 37, 41} <= {r.doc_id for r in rows}


def test_rows_without_an_id_are_judged(spark, corpus, tmp_path):
    folder, texts, _, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id in (2, 3, 5)")
    own = " ".join(random.Random(77).choices(WORDS, k=60))
    more = [(None, t, "xx", "s", len(t or "")) for t in (texts[2], f"{own} {item}", own, own, None, "")]
    docs = docs.union(spark.createDataFrame(more, COLUMNS))
    stages = dict(corpus_pipeline.STAGES)
    unique = corpus_pipeline.materialize(stages["n-gram Jaccard join"](spark, docs, folder), "test")
    assert unique.columns == docs.columns
    got = sorted(str(r.text) for r in unique.collect() if r.doc_id is None)
    assert got == sorted([f"{own} {item}", own, "None", ""]) and unique.where("doc_id is not null").count() == 3
    clean = corpus_pipeline.materialize(stages["benchmark decontamination"](spark, unique, folder), "test")
    assert sorted(str(r.text) for r in clean.collect() if r.doc_id is None) == sorted([own, "None", ""])
    packed = stages["packing"](spark, clean, folder)
    assert packed.where("doc_id is null").groupBy("doc_tokens").count().count() == 2  # two empty ones and `own`


def test_stages_take_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0
