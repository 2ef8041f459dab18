import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import decontaminate as D


def least_distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=70), st.text(alphabet="abc ", max_size=90))
def test_bit_parallel_distance(pattern, text):
    assert D.myers(pattern, text) == least_distance(pattern, text)


def edited(text, n):
    s = list(text)
    for _ in range(n):
        k = random.randrange(len(s))
        s[k:k + 1] = random.choice([["q"], [], [s[k], "q"]])
    return "".join(s)


def corpus():
    random.seed(6)
    word = lambda: "".join(random.choices("aeinorst", k=random.randint(1, 9)))
    items = [(i, " ".join(word() for _ in range(random.randint(5, 30)))) for i in range(12)] + [(20, "Shrt"), (21, None), (22, "")]
    docs = []
    for i in range(150):
        text = " ".join(word() for _ in range(random.randint(0, 60)))
        if i % 2:
            item = random.choice(items[:13])[1]
            at = random.randint(0, len(text))
            text = text[:at] + edited(item, random.randint(0, int(0.12 * len(item)))).replace(" ", "\n ").upper() + text[at:]
        docs.append((i, text))
    return docs + [(200, None), (201, ""), (None, items[0][1]), (202, items[1][1]), (202, items[1][1]),
                   (203, "z " * 100_000 + items[2][1])], items


def test_matches_brute_force(spark, make_docs, monkeypatch):
    docs, items = corpus()
    want = []
    for doc_id, text in docs:
        body = D.fold((text or "").encode())[-3000:]
        for item_id, item in items:
            item = D.fold((item or "").encode())
            if item and body and (d := least_distance(item, body)) <= int(D.RATE * len(item)):
                want.append((doc_id, item_id, d, int(D.RATE * len(item))))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted(map(tuple, D.contaminated(make_docs(docs), bench).collect()), key=repr)
    assert got == sorted(want, key=repr) and len(got) > 40
    left = D.drop_contaminated(make_docs(docs), bench)
    assert left.columns == make_docs(docs).columns
    hit = {d for d, *_ in want}
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in hit)


def test_blocks_of_items(spark, make_docs, monkeypatch):
    docs, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.contaminated(make_docs(docs[:40]), bench).collect()), key=repr)
    assert len(D.item_blocks(bench, D.RATE, 400)) > 2
    blocks = D.item_blocks
    monkeypatch.setattr(D, "item_blocks", lambda b, rate: blocks(b, rate, 400))
    assert sorted(map(tuple, D.contaminated(make_docs(docs[:40]), bench).collect()), key=repr) == whole


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(make_docs([(1, "a")]), none).collect() == []
    assert D.drop_contaminated(make_docs([(1, "a")]), none).count() == 1
    assert D.contaminated(make_docs([]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
