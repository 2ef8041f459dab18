import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import golomb
from cohortlens.llm.exact_dedup import drop_exact_copies, exact_groups


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**48 - 1), max_size=60, unique=True), st.integers(0, 47))
def test_golomb_round_trip(values, bits):
    values = np.array(sorted(values), np.uint64)
    if len(values) and int(values[-1]) >> bits > 1 << 20:
        bits = golomb.parameter(1 << 48, len(values))
    assert golomb.decode(golomb.encode(values, bits), len(values), bits).tolist() == values.tolist()


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[low(t)]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    random.seed(3)
    rows = [(i, random.choice(["Alpha beta", "ALPHA BETA", "É", "é", "gamma", f"own {i}"])) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "x" * 300_000), (103, "X" * 300_000), (None, "alpha beta"), (None, "lone")]


def test_groups_match_brute_force(make_docs):
    rows = corpus()
    got = exact_groups(make_docs(rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.group_size > 1 and r.doc_id is not None)


def test_joined_suspects_give_the_same(make_docs):
    rows = corpus()
    few = exact_groups(make_docs(rows), broadcast_suspects=0).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in few], key=repr) == brute(rows)


def test_repeated_rows_keep_one(make_docs):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "B"), (3, "c")]
    got = exact_groups(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.kept) for r in got) == [(1, False), (1, False), (1, True), (2, True), (3, True)]
    docs = make_docs(rows)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_empty_table(make_docs):
    assert exact_groups(make_docs([])).collect() == []
    assert drop_exact_copies(make_docs([])).collect() == []
