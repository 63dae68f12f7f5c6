"""Token counts and output against the tokenizer itself, and exact round trips."""

import json
import random

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from hemicycle.llm import packing, token_output, tokens
from hemicycle.llm import queries as llm

SCHEMA = "doc_id long, text string, n_tokens string, ids int"
PROVEN = tokens.prove_whole_tokens()
TEXTS = ["", " ", "a", "  two  spaces", "a \nb", "a\n \nb c", "tab\tand nbsp 　x", "it's we'll 123 45% !!! ###", "x" * 5000, "word " * 40000, "é ñ 漢字 🎉 ok", "\n\n lines \n\n", "end ", "<|endoftext|>"]


def reference():
    return tokens._load(tokens.VOCABULARY, tokens.PATTERN)[1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t  '.s1!")), max_size=40))
def test_any_white_space(text):
    expected = reference().encode_ordinary(text)
    assert tokens._counter(tokens.VOCABULARY, tokens.PATTERN, PROVEN)(text)[0] == len(expected)
    assert np.frombuffer(tokens._encoder(tokens.VOCABULARY, tokens.PATTERN)(text), "<u2").tolist() == expected


def test_proof():
    ranks, encoding, split = tokens._load(tokens.VOCABULARY, tokens.PATTERN)
    texts = {i: raw.decode() for raw, i in ranks.items() if i in PROVEN}
    assert len(texts) > 40000
    assert all(encoding.encode_ordinary(t) == [i] for i, t in texts.items())


@pytest.fixture(scope="module")
def rows(spark):
    some = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return [(i, t) for i, t in enumerate(TEXTS + some)] + [(None, None), (None, "null id"), (3, TEXTS[3]), (3, TEXTS[3])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def test_counts(spark, rows):
    got = tokens.token_counts(frame(spark, rows)).collect()
    encode = reference().encode_ordinary
    split = tokens._load(tokens.VOCABULARY, tokens.PATTERN)[2]
    want = sorted(((str(i), None if t is None else len(encode(t)), None if t is None else len(split.findall(t))) for i, t in rows), key=str)
    assert sorted(((str(r.doc_id), r.n_tokens, r.n_pretokens) for r in got), key=str) == want
    assert all(r.n_tokens is None or r.n_whole <= r.n_pretokens <= r.n_tokens for r in got)


def test_frames_round_trip(spark, rows):
    ids = tokens.token_ids(frame(spark, rows))
    content = token_output.shared_dictionary(ids)
    got = token_output.token_frames(frame(spark, rows), dictionary=content).collect()
    assert len(got) == len(rows)
    encode = reference().encode_ordinary
    want = sorted((str(i), json.dumps(encode(t)) if t is not None else "") for i, t in rows)
    assert sorted((str(r.doc_id), "" if r.frame is None else json.dumps(token_output.decode(r.frame, content).tolist())) for r in got) == want
    assert {r.dict_hash for r in got} == {token_output.dictionary_hash(content)}
    for shard in {r.shard for r in got}:
        at = 0
        for r in sorted((r for r in got if r.shard == shard), key=lambda r: (r.offset, r.n_bytes)):
            assert r.offset == at
            at += r.n_bytes


def test_query_output_decodes_by_itself(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    llm.op1_token_output(spark, folder).write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    known = {token_output.dictionary_hash(r.dictionary): bytes(r.dictionary) for r in got if r.dictionary is not None}
    assert sum(r.dictionary is not None for r in got) == len({r.shard for r in got})
    encode = reference().encode_ordinary
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted((r.doc_id, encode(r.text)) for r in texts if r.text is not None)
    assert sorted((r.doc_id, token_output.decode(r.frame, known[r.dict_hash]).tolist()) for r in got if r.frame is not None) == want


def test_shards_on_disk(spark, rows, tmp_path):
    folder = f"file://{tmp_path}/out"
    index = token_output.write_token_shards(frame(spark, [(i, t) for i, t in rows if i is not None and i != 3]), folder)
    encode = reference().encode_ordinary
    texts = dict(rows)
    for r in index.collect():
        assert token_output.read_document(folder, r.shard, r.offset, r.n_bytes, r.dict_hash).tolist() == encode(texts[r.doc_id])


def test_dictionary_is_trained_in_levels(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(70)
    ids = tokens.token_ids(df)
    assert 1024 < len(token_output.shared_dictionary(ids)) <= token_output.DICTIONARY_BYTES


@pytest.mark.parametrize("op", [tokens.token_counts, token_output.token_frames, packing.best_fit_packs])
def test_empty_table(spark, op):
    assert op(frame(spark, [])).collect() == []


CAPACITIES = (8, 16, 32, 64)


def price(c):
    return 3 + c + c * c / 128


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_against_plain_version(lengths):
    """Each piece goes into the fullest bin that holds it; a bin is opened at the length that is cheapest for
    each token, by filling every permitted length in turn from a plain list of what is left."""
    lengths = sorted(lengths, reverse=True)
    bins, used, size = packing.pack(lengths, CAPACITIES, price)
    room = []
    for i, n in enumerate(lengths):
        least = min((r for r in room if r >= n), default=None)
        b = bins[i]
        if least is not None:
            assert room[b] == least
        else:
            costs = []
            for c in (c for c in CAPACITIES if c >= n):
                held = n
                for x in lengths[i + 1 :]:
                    if held + x <= c:
                        held += x
                costs.append((price(min(d for d in CAPACITIES if d >= held)) / held, c))
            assert b == len(room)
            room.append(min(costs)[1])
        room[b] -= n
    assert [sum(n for n, b in zip(lengths, bins) if b == k) for k in range(len(used))] == used
    assert all(s == min(c for c in CAPACITIES if c >= u) for s, u in zip(size, used))


def cheapest(lengths):
    """The least total price of any partition into bins."""

    def go(rest, sums):
        if not rest:
            return sum(price(min(c for c in CAPACITIES if c >= s)) for s in sums)
        n, best = rest[0], float("inf")
        for k in sorted({s: k for k, s in enumerate(sums) if s + n <= CAPACITIES[-1]}.values()):
            best = min(best, go(rest[1:], sums[:k] + [sums[k] + n] + sums[k + 1 :]))
        return min(best, go(rest[1:], [*sums, n]))

    return go(sorted(lengths, reverse=True), [])


def test_best_fit_against_the_optimum():
    rng = random.Random(1)
    ratios = []
    for _ in range(60):
        lengths = sorted((rng.randrange(1, rng.choice([10, 30, 64])) for _ in range(7)), reverse=True)
        ratios.append(sum(map(price, packing.pack(lengths, CAPACITIES, price)[2])) / cheapest(lengths))
    assert min(ratios) >= 1 - 1e-9 and sum(ratios) / len(ratios) < 1.05 and max(ratios) < 1.3


def test_every_length_is_opened():
    size = packing.pack([900, 500, 400, 100, 60])[2]
    assert set(size) <= {512, 1024, 2048}
    assert packing.pack([500])[2] == [512] and packing.pack([8000, 150])[2] == [8192]


def test_packs_hold_every_token_once(spark, rows):
    packs = packing.best_fit_packs(frame(spark, rows), group_docs=50).collect()
    encode = reference().encode_ordinary
    want = sorted((str(i), len(encode(t)) + 1) for i, t in rows if t and encode(t))
    assert len({p.pack_id for p in packs}) == len(packs)
    pieces = []
    for p in packs:
        assert p.n_tokens == sum(d.end - d.start for d in p.docs) <= p.capacity
        assert p.capacity == min(c for c in packing.CAPACITIES if c >= p.n_tokens)
        pieces += [(str(d.doc_id), d.start, d.end) for d in p.docs]
    total = {}
    for i, a, b in pieces:
        total[i] = total.get(i, 0) + b - a
    expected = {}
    for i, n in want:
        expected[i] = expected.get(i, 0) + n
    assert total == expected


def test_whole_tokens_against_brute_force(spark, rows):
    encoding = reference()
    split = regex.compile(tokens.PATTERN)
    whole = lambda p: split.findall(p) == [p] and len(encoding.encode_ordinary(p)) == 1
    got = sorted((str(r.doc_id), str(r.n_whole), str(r.n_pretokens)) for r in tokens.token_counts(frame(spark, rows)).collect())
    want = []
    for i, t in rows:
        pieces = split.findall(t) if t is not None else None
        want.append((str(i), str(None if t is None else sum(map(whole, pieces))), str(None if t is None else len(pieces))))
    assert got == sorted(want)
