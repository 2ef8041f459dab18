import random
import re

from cohortlens.llm.components import components
from cohortlens.llm.jaccard_join import drop_near_copies, jaccard_components


def shingles(text, size):
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < size:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, num, den):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                label[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), d), d)
    return sorted((d, len(sets[i]), best[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = random.choices(vocab, k=40)
    rows, texts = [], []
    for i in range(n):
        kind = random.random()
        if kind < 0.55 and texts:
            words = list(random.choice(texts[:12]))
            for _ in range(random.randint(0, 5)):
                k = random.randrange(len(words))
                words[k:k + 1] = random.choice([[random.choice(vocab)], [], [words[k], random.choice(vocab)]])
            words = words or ["w0"]
        elif kind < 0.75:
            words = passage + random.choices(vocab, k=random.randint(5, 60))
        else:
            words = random.choices(vocab, k=random.randint(1, 120))
        texts.append(words)
        rows.append((i, random.choice([" ", "\n"]).join(words)))
    return rows


def test_three_words_match_brute_force(make_docs):
    rows = corpus(5, 220) + [(900, None), (901, ""), (902, " \t\n"), (903, "One Two"), (904, "one two"), (905, "two one"),
                             (906, "long " * 60_000)]
    got = sorted(map(tuple, jaccard_components(make_docs(rows, 5), size=3, num=90, den=100).collect()))
    assert got == brute(rows, 3, 90, 100)


def test_five_words_and_what_stays(make_docs):
    rows = corpus(8, 160)
    docs = make_docs(rows, 4)
    want = brute(rows, 5, 80, 100)
    assert sorted(map(tuple, jaccard_components(docs).collect())) == want
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [d for d, _, c in want if d == c]


def test_null_ids_and_repeated_rows(make_docs):
    text = " ".join(f"v{i}" for i in range(30))
    rows = [(7, text), (7, text), (None, text), (None, "other words stand here alone"), (9, text + " v30")]
    got = sorted(map(tuple, jaccard_components(make_docs(rows), size=3, num=90, den=100).collect()), key=repr)
    assert got == sorted([(7, 28, 7), (7, 28, 7), (None, 28, 7), (None, 3, None), (9, 29, 7)], key=repr)


def test_empty_table(make_docs):
    assert jaccard_components(make_docs([])).collect() == []


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 300), (300, 250), (200, 300), (None, 5), (6, None)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(x, 200) for x in (200, 250, 300)}
