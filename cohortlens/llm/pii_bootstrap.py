"""Personal data by fixed forms and by bootstrapped contexts.

Base spans follow fixed forms (e-mail, IP, card with Luhn check, phone).  They
are the seeds: the one and the two whole words before a seed make lexical
patterns (of a word of more than ``LONG_WORD`` code points its digest stands in
them).  Tokens that look like an identifier of a kind (``LOOSE``) but miss its
fixed form are candidates, names of any length included.
Patterns and values form a bipartite graph of distinct (pattern, kind, value)
edges; Spark scores it in a few rounds: a pattern's confidence is the share of
its values that are believed, a value's belief grows with the patterns that
lead to it, seeds stay believed.  Candidates behind high-confidence patterns
are added; base spans always stay.

Defined cases: a null text counts as empty and has no span; repeated rows and
rows that share a ``doc_id`` are kept apart and each get a row; of two kinds
for one candidate the more confident (then the first listed) holds; an empty
table gives an empty result; further columns are ignored.  Offsets are code
points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import bounded_batches, cut, lean_task, stash
from cohortlens.operators.salted import salted_join

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: Least confidence of a pattern, and least number of distinct seeds behind it.
CONFIDENCE, SUPPORT = 0.8, 3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits: it would have begun at the run's start.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"\S+")
#: Code points of a word that a pattern shows as it is.
LONG_WORD = 64
NOT_DIGIT = re.compile(r"[^0-9]")

#: What an identifier of a kind can look like without having its fixed form.
LOOSE = (
    # A name begins where its run of characters begins, so a long run is tried once.
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:@|\(at\)|\[at\])[A-Za-z0-9-]+(?:(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]+)*")),
    ("ip", re.compile(r"[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){4,7}|[0-9]{1,3}(?:[.,][0-9]{1,3}){3}")),
    ("card", re.compile(r"[0-9](?:[.\x20/-]?[0-9]){12,18}")),
    ("phone", re.compile(r"(?:00[0-9]|\(?0?[0-9]{2,5}\)?)(?:[\x20/.-]?[0-9]){5,12}")),
)

ROW = ("uid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
       "base array<struct<kind:int,start:int,end:int>>, "
       "near array<struct<kind:int,start:int,end:int,seed:boolean,value:string,patterns:array<string>>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every match needs an @ with a domain behind it; its name is the run of name characters before it."""
    out, least = [], 0
    if "@" not in text:
        return out
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > least and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            least = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


class Words:
    """The words of a text (without white space), to find those before a place."""

    def __init__(self, text: str):
        self.text = text
        self.ends = [m.span() for m in WORD.finditer(text)]
        self.starts = [a for a, _ in self.ends]

    def _folded(self, start: int, end: int) -> str:
        word = DIGITS.sub("0", self.text[start:end].lower())
        return word if len(word) <= LONG_WORD else hashlib.blake2b(word.encode(), digest_size=16).hexdigest()

    def patterns(self, place: int) -> list[str]:
        """The one and the two words before ``place``, digits folded; of a word around it, what stands before."""
        last = bisect_left(self.starts, place) - 1
        words = [self._folded(a, min(b, place)) for a, b in self.ends[max(0, last - 1):last + 1]]
        return [" ".join(words[-k:]) for k in (1, 2) if len(words) >= k] or ["^"]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Loose forms that stand alone and meet no base span."""
    begins, ends = [], []  # the base spans, united where they meet
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    out = []
    for kind, (_, form) in enumerate(LOOSE):
        if not (DIGITS.search(text) if kind else ("@" in text or "at)" in text or "at]" in text)):
            continue
        for m in form.finditer(text):
            a, b = m.span()
            alone = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())
            if not alone:
                continue
            at = bisect_right(ends, a)  # the first base span that ends behind the candidate's begin
            if at == len(begins) or begins[at] >= b:
                out.append((kind, a, b))
    return out


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _scan(batches):
    part, at = TaskContext.get().partitionId(), 0
    near_kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                                    ("seed", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))
    base_kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        counts, sums, bases, nears = [[] for _ in KINDS], [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = base_spans(text)
            near = [(k, a, b, True) for k, a, b in base] + [(k, a, b, False) for k, a, b in candidates(text, base)]
            words = Words(text) if near else None
            for k in range(len(KINDS)):
                counts[k].append(sum(s[0] == k for s in base))
            sums.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
            bases.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            nears.append([{"kind": k, "start": a, "end": b, "seed": seed,
                           "value": hashlib.blake2b(text[a:b].lower().encode(), digest_size=12).hexdigest(),
                           "patterns": words.patterns(a)} for k, a, b, seed in near])
        uids = pa.array(range((part << 40) + at, (part << 40) + at + batch.num_rows), pa.int64())
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [uids, batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()),
             pa.array(bases, base_kind), pa.array(nears, near_kind)],
            names=["uid", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "near"])


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, confidence, seeds from distinct edges (pattern, kind, value, seed).

    Sums are combined before they are dealt out, and joins deal the edges of a
    frequent pattern or value over several tasks.
    """
    edges = cut(edges)
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"))
    belief = edges.select("kind", "value", F.col("seed").cast("double").alias("belief")).distinct()
    scored = None
    for _ in range(rounds):
        scored = (edges.join(belief, ["kind", "value"]).groupBy("pattern", "kind")
                  .agg(F.sum("belief").alias("believed"), F.sum(F.col("seed").cast("long")).alias("seeds"))
                  .join(size, "pattern")
                  .select("pattern", "kind", "seeds", (F.col("believed") / (F.col("values") + 0.5)).alias("confidence")))
        scored = cut(scored)
        strong = scored.where(F.col("confidence") >= 0.5).select("pattern", "kind", "confidence")
        raised = salted_join(edges.where("not seed"), strong, ["pattern", "kind"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - 0.9 * F.col("confidence"))))).alias("belief"))
        unseen = edges.where("not seed").select("kind", "value").distinct().join(raised, ["kind", "value"], "left").select(
            "kind", "value", F.coalesce("belief", F.lit(0.0)).alias("belief"))
        belief = edges.where("seed").select("kind", "value").distinct().withColumn("belief", F.lit(1.0)).union(unseen)
    return scored


def personal_data(docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added."""
    bounded_batches(docs.sparkSession)
    rows = stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean_task(_scan), ROW), "pii-spans")
    near = rows.select("uid", F.explode("near").alias("s")).select("uid", "s.*")
    seen = near.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
    edges = seen.groupBy("pattern", "kind", "value").agg(F.bool_or("seed").alias("seed"))
    good = score_patterns(edges).where((F.col("confidence") >= confidence) & (F.col("seeds") >= support))
    behind = near.where("not seed").select("uid", "start", "end", "kind", F.explode("patterns").alias("pattern"))
    added = (salted_join(behind, good.select("pattern", "kind", "confidence"), ["pattern", "kind"])
             .groupBy("uid", "start", "end").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("rank"))).alias("best"))
             .select("uid", F.struct((-F.col("best.rank")).alias("kind"), "start", "end").alias("span")))
    # The spans of one document: as many as it has candidates.
    extra = added.groupBy(F.col("uid").alias("x_uid")).agg(F.collect_list("span").alias("extra"))
    names = F.array(*[F.lit(k) for k in KINDS])
    every = F.array_sort(F.concat("base", F.coalesce("extra", F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)"))))
    shown = F.array_join(F.transform(every, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.join(extra, F.col("uid") == F.col("x_uid"), "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", shown.alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_added"))
