"""Base spans and learnt patterns against brute force; what contexts the patterns reach, whatever else the table holds."""

import random
import re
from collections import defaultdict

from evidtable.llm import pii

COLUMNS = "doc_id long, text string, number long, row string"


def test_unrelated_rows_switch_no_find_off(spark, monkeypatch):
    rows = [(i, f'the token = "secret{i}abcd" end', i, "r") for i in range(4)]
    rows += [(100, " ".join(f"part no x{i:03d} sku-{i:06d}" for i in range(6000)), 1, None), (None, None, None, None), (7, "", 7, "r"), (0, rows[0][1], 0, "again")]
    docs = spark.createDataFrame(rows, COLUMNS)
    told = lambda: sorted(map(str, pii.detect(docs).collect()))
    text = lambda: sorted(map(str, pii.redact(docs).collect()))
    sent, sent_text = told(), text()
    assert sum(r["n_id"] for r in pii.detect(docs).collect()) == 5
    assert sum("[ID]" in t for t in sent_text) == 5 and len(sent) == len(rows)
    monkeypatch.setattr(pii, "SHARED_PATTERNS", 0)
    assert told() == sent and text() == sent_text


def test_contexts_of_every_base_kind_find_unseen_identifiers(spark):
    base = {"email": "user{}@mail.example.com", "ip": "10.20.30.{}", "phone": "+1 (555) 010-99{:02d}"}
    rows = [f"please contact {kind} desk {form.format(i)} soon" for kind, form in base.items() for i in range(10, 16)]
    rows += [f"please contact {kind} desk hidden{kind}77x soon" for kind in base] + ["some other words hidden00plain soon"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {f"contact {kind} desk" for kind in base} <= set(pii.learn_patterns(docs))
    out = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert [out[18 + i] for i in range(3)] == [f"please contact {kind} desk [ID] soon" for kind in base]
    assert out[21] == rows[21]


FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(d) * 2 for d in digits[-2::-2]]
        return 12 <= len(digits) <= 19 and (sum(map(int, digits[-1::-2])) + sum(x // 10 + x % 10 for x in twice)) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def test_base_spans_of_every_kind():
    rng = random.Random(4)
    pieces = ["4111111111111111", "5500 0000-0000 0004", "10.0.0.1", "256.1.1.1", "+1 (555) 010-9999", "a@b.c", "1.2.3.4.5", "+", "@", ".", "-", " ", "0", "7", "99", "x", "\n", "é", "+44"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    texts += ["".join(rng.choice("a1.@+- 0(") for _ in range(40)) for _ in range(3000)]
    seen = defaultdict(int)
    for t in texts:
        want = [(m.start(), k, m.end()) for k, kind in enumerate(FIXED) for m in re.finditer(FIXED[kind], t) if holds(kind, m[0])]
        assert pii.base_spans(t) == sorted(want)
        for _, k, _ in want:
            seen[k] += 1
    assert min(seen[k] for k in range(4)) > 100


def test_numbers_of_any_length_are_read():
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}.1.1.1") == [(0, 1, 5006)]
    assert pii.base_spans(f"{zeros}256.1.1.1") == [] and pii.base_spans("9" * 5000 + ".1.1.1") == []


def learnt_by_brute_force(texts, rounds):
    seeds, pairs = set(), set()
    for t in texts:
        base = pii.base_spans(t)
        spans = {(s, e): True for s, _, e in base}
        starts = {s for s, _ in spans}
        for s, e in pii.identifiers(t):
            if s not in starts:
                spans[s, e] = pii.cued(t, s) or any(a <= s and e <= z for a, _, z in base)
        for (s, e), seed in spans.items():
            pairs |= {(p, t[s:e]) for p in pii.patterns(t, s, e)}
            if seed and pii.patterns(t, s, e):
                seeds.add(t[s:e])
    of = defaultdict(set)
    for p, i in pairs:
        of[p].add(i)
    of = {p: x for p, x in of.items() if len(x) >= pii.MIN_INSTANCES}
    score = {p: sum(i in seeds for i in x) / len(x) for p, x in of.items()}
    for _ in range(1, rounds):
        best = defaultdict(float)
        for p, x in of.items():
            for i in x:
                best[i] = max(best[i], score[p], i in seeds)
        score = {p: sum(best[i] for i in x) / len(x) for p, x in of.items()}
    return sorted(p for p, x in score.items() if x >= pii.MIN_SCORE)


def test_patterns_and_scores_are_brute_forces(spark):
    rng = random.Random(9)
    secret = lambda: "".join(rng.choice("abcdef0123456789") for _ in range(9)) + "7"
    common, known = [secret() for _ in range(12)], [secret() for _ in range(6)]
    texts = [f"token = {x} now" for x in known]  # seeds by cue
    texts += [f"the vault entry {x} is set" for x in [*known, *common[:2]]]  # learnt in the first round
    texts += [f"see the archive slip {x} there" for x in [*common[:2], *known[:3], common[3]]]  # by what the first finds
    texts += ['{"owner ref": "' + f"user{i}@mail.example.com" + '", "n": 1}' for i in range(5)] + ['{"owner ref": "' + secret() + '", "n": 1}']
    texts += [f"part number {secret()} in stock" for _ in range(30)] + [f"part number {x} in stock" for x in known[:1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for rounds in (1, 3):
        assert pii.learn_patterns(docs, rounds) == learnt_by_brute_force(texts, rounds)
    found = {r["doc_id"]: r["n_id"] for r in pii.detect(docs).collect()}
    hidden = [i for i, t in enumerate(texts) if "vault" in t or "archive" in t or ("owner" in t and "@" not in t)]
    assert all(found[i] == 1 for i in hidden)
    assert not any(found[i] for i, t in enumerate(texts) if "part number" in t and known[0] not in t)
