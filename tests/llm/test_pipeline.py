"""The pipeline's stages, each over what the stage before kept."""

import random

import corpus_pipeline
from __spark_entry__ import queries
from hemicycle.llm import packing, tokens
from tests.llm import test_decontaminate, test_minhash, test_repeats


def test_stages_over_the_test_table(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and docs.filter("n_chars <> length(text)").count() == 0
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] > 0
    packed = {d.doc_id for p in docs.collect() for d in p.docs}
    assert packed == {r.doc_id for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, ran.collect())) == sorted(map(str, docs.collect()))


def test_every_operator_has_a_query():
    names = queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage by hand: labels tell good words from bad ones, and exact Jaccard indexes over all pairs, all
    passages of 50 words, an exhaustive scan for items and the tokenizer itself give the other stages."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda n: [word() for _ in range(n)]
    shared, items = text(70), [(k, " ".join(text(20)) + ".") for k in range(4)]
    rows = [(i, text(120)) for i in range(60)]
    rows[3], rows[9], rows[20] = ((i, w[:60] + shared + w[60:]) for i, w in (rows[3], rows[9], rows[20]))
    rows += [(100 + k, [word() if rng.random() < 0.03 else w for w in rows[k][1]]) for k in range(8)]
    rows += [(200 + k, rows[k][1]) for k in range(3)] + [(300 + k, text(40) + items[k][1].split() + text(40)) for k in range(4)]
    junk = [(400 + k, ["BUY!!!", "NOW???", f"x{k}", "$$$"] * 20) for k in range(40)]
    docs = [(i, " ".join(w), "en", "web", len(" ".join(w))) for i, w in rows + junk]
    labels = [(i, 1, 0) for i, _ in rows[:50]] + [(i, 0, i % 2) for i, _ in junk[:30]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, " ".join(w)) for i, w in rows]
    gone = {i for g in test_minhash.brute(left) for i in g[1:]}
    left = [(i, t) for i, t in left if i not in gone]
    later = test_repeats.brute_spans(left, 50, later=True)
    cut = {i: {p for j, a, b, _ in later if j == i for p in range(a, b)} for i, _ in left}
    left = [(i, " ".join(w for p, w in enumerate(t.split()) if p not in cut[i])) for i, t in left]
    leaks = {d for d, _ in test_decontaminate.scan(left, items)}
    left = [(i, t) for i, t in left if i not in leaks]
    assert gone == {*range(100, 108), *range(200, 203)} and leaks == {300, 301, 302, 303} and any(cut.values())
    encode = tokens._load(tokens.VOCABULARY, tokens.PATTERN)[1].encode_ordinary
    pieces = sorted((-(len(encode(t)) + 1), i) for i, t in left)
    bins, used, size = packing.pack([-n for n, _ in pieces])
    want = [(size[b], used[b], sorted((i, 0, -n) for (n, i), k in zip(pieces, bins) if k == b)) for b in range(len(used))]
    got = [(p.capacity, p.n_tokens, sorted(map(tuple, p.docs))) for p in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
