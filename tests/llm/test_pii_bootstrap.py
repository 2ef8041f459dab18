import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm.pii_bootstrap import Words, base_spans, candidates, luhn, personal_data, score_patterns, spans_text

FORMS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute(text):
    """The stated forms, straight through the regular expression engine."""
    out = []
    for kind, form in FORMS:
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+ ()0123456789é_%", max_size=60))
def test_base_spans_match_the_forms(text):
    assert spans_text(base_spans(text)) == brute(text)


def test_known_cases():
    text = "a@b.c@d.e x@y @z.w 1.2.3.4.5 999.1.1.1 4111 1111-1111 1111 +1 (787) 555-1710 4111111111111112 é me@host.org"
    assert spans_text(base_spans(text)) == brute(text)
    assert base_spans("7" * 200_000 + "a" * 200_000 + "@") == []


def corpus():
    random.seed(4)
    rows = []
    for i in range(120):
        rows.append((i, f"text {i} write to: u{i}@mail.org now, {random.choice(['ok', 'or'])} number {random.randint(1, 10**6)}"))
    rows += [(500, "please write to: hidden(at)mail.org soon"), (501, "see hidden(at)mail.org soon"),
             (502, None), (503, ""), (504, "x" * 200_000 + " 10.0.0.1")]
    return rows + [(500, "please write to: hidden(at)mail.org soon"), (None, "call +1 (787) 555-1710")]


def test_documents_match_brute_force_and_contexts_add(make_docs):
    rows = corpus()
    got = personal_data(make_docs(rows)).collect()
    want = sorted((repr(i), hashlib.sha256(brute(t).encode()).hexdigest()) for i, t in rows)
    assert sorted((repr(r.doc_id), r.base_sha256) for r in got) == want
    texts = dict(rows)
    for r in got:
        base = [x for x in brute(texts[r.doc_id]).split(",") if x]
        every = [x for x in r.spans.split(",") if x]
        assert set(base) <= set(every) and len(every) == len(base) + r.n_added
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k, _ in FORMS]
    added = {r.doc_id: r.spans for r in got if r.n_added}
    assert added == {500: "email:17:35"}
    assert sum(r.doc_id == 500 and r.n_added == 1 for r in got) == 2


def test_empty_table(make_docs):
    assert personal_data(make_docs([])).collect() == []


def test_many_spans_in_one_text_take_linear_time():
    import time
    took = []
    for n in (4_000, 16_000):
        text = " ".join(f"mail u{i}@h{i}.com or j{i}(at)m{i}(dot)com" for i in range(n))
        began = time.perf_counter()
        base = base_spans(text)
        near = candidates(text, base)
        words = Words(text)
        found = {tuple(words.patterns(a)) for _, a, _ in near}
        took.append(time.perf_counter() - began)
        assert len(base) == n and len([k for k, _, _ in near if k == 0]) == n
        assert ("or", "u000@h000.com or") in found
    assert took[1] < 12 * took[0]
    began = time.perf_counter()
    assert candidates("a" * 400_000 + "(at)" + "b" * 400_000, []) == [(0, 0, 800_004)]
    assert candidates("x" * 400_000 + " (at)", []) == [] and time.perf_counter() - began < 5


def test_short_names_and_long_words():
    text = "to j(at)mail(dot)com"
    assert candidates(text, []) == [(0, 3, 20)]
    long = "w" * 100
    words = Words(f"{long} mail a(at)b(dot)c {long[:-1]} x")
    one, two = words.patterns(106)
    assert one == "mail" and two.endswith(" mail") and two != Words(f"{long[:-1]} mail a").patterns(105)[1]
    assert Words("contact:(a(at)b").patterns(9) == ["contact:("] and Words("x").patterns(0) == ["^"]
    spans = sorted((k, a, b) for k, a, b in candidates("1.2.3.4, 5.6.7.8 and 9,9,9,9", [(1, 0, 7)]) if k == 1)
    assert spans == [(1, 9, 16), (1, 21, 28)]


def brute_scores(edges, rounds=3):
    """The pattern-value graph scored edge by edge."""
    import math
    belief = {(k, v): 1.0 if seed else 0.0 for _, k, v, seed in edges}
    size = {}
    for p, *_ in edges:
        size[p] = size.get(p, 0) + 1
    for _ in range(rounds):
        scores = {}
        for p, k, v, seed in edges:
            believed, seeds = scores.get((p, k), (0.0, 0))
            scores[p, k] = (believed + belief[k, v], seeds + seed)
        scores = {(p, k): (b / (size[p] + 0.5), s) for (p, k), (b, s) in scores.items()}
        for k, v in belief:
            if not any(seed for _, k2, v2, seed in edges if (k2, v2) == (k, v)):
                doubt = [math.log(1 - 0.9 * scores[p, k][0]) for p, k2, v2, _ in edges if (k2, v2) == (k, v) and scores[p, k][0] >= 0.5]
                belief[k, v] = 1 - math.exp(sum(doubt)) if doubt else 0.0
    return {key: (round(c, 9), s) for key, (c, s) in scores.items()}


def test_the_graph_is_scored_as_by_hand(spark):
    import random
    rng = random.Random(6)
    seeds = {(k, f"v{i}"): rng.random() < 0.5 for k in range(3) for i in range(25)}
    edges = sorted({(f"p{min(rng.randrange(12), rng.randrange(12))}", k, v) for _ in range(260) for k, v in [rng.choice(sorted(seeds))]})
    edges = [(*e, seeds[e[1:]]) for e in edges]
    df = spark.createDataFrame(edges, "pattern string, kind int, value string, seed boolean")
    got = {(r.pattern, r.kind): (round(r.confidence, 9), r.seeds) for r in score_patterns(df).collect()}
    assert got == brute_scores(edges)
