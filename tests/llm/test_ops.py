"""Operators against brute force: nulls, empty and repeated rows, ties, clashing columns, empty tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from evidtable.llm import chat, compression_quality, decontaminate, packing, pii, quality_rules, simhash, suffix_dedup, token_counts, warc

random.seed(11)
WORDS = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 8))) for _ in range(300)]
PASSAGE = " ".join(random.choice(WORDS) for _ in range(110))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n_words long, failed long"


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


@lru_cache
def corpus():
    texts = [prose(random.randint(1, 200)) for _ in range(30)] + [None, "", " \n\t", "a", "x" * 3000, "ab " * 900]
    texts += [prose(20) + " " + PASSAGE + " " + prose(20) for _ in range(5)] + [PASSAGE] * 3
    texts += [texts[0], texts[0], "mail me.a@b.example.com or +1 (555) 010-9999 at 10.0.0.1 card 4111111111111111 token = \"a1b2c3d4e5f6a7b8\" <|endoftext|> İx, ß",]
    return [(i, t, "en", "s", None, "clash", -1, -1) for i, t in enumerate(texts)] + [(None, texts[1], None, None, None, None, None, None), (3, texts[3], "en", "s", 1, "r", 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(decontaminate.contamination(none, bench)).count() == 0
    assert packing.pack(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0
    assert token_counts.token_counts(none).count() == 0
    assert pii.detect(none).count() == 0
    assert simhash.components(none).count() == 0
    assert quality_rules.keep(none).columns == none.columns
    assert chat.read_back(chat.format_trees(chat.linear_nodes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))).count() == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert compression_quality.score(none, compression_quality.fit(none, labels)).count() == 0


def test_quality_rules(docs):
    got = {(r["row"]["doc_id"], r["row"]["n_chars"]): r for r in quality_rules.apply_policy(quality_rules.ledger(docs)).collect()}
    for row in corpus():
        w = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {p for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
        r = got[row[0], row[4]]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(hit))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])
    for policy, mask in quality_rules.POLICIES.items():
        failed = [r["failed"] & mask for r in got.values()]
        want = {(name, sum(bool(x & bit) for x in failed), sum(x == bit for x in failed)) for name, bit in quality_rules.BIT.items() if mask & bit}
        assert len(got) == len(corpus()) and set(map(tuple, quality_rules.ablation(quality_rules.ledger(docs), policy).collect())) == want
    assert sum(bool(r["failed"] & quality_rules.BASE) for r in got.values()) > 3


def test_simhash(docs):
    rows = corpus()
    fps = [simhash.fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    want = Counter((r[0], f, least[g] if r[0] is not None else None) for r, f, g in zip(rows, fps, group, strict=True))
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.components(docs).collect()) == want


def test_simhash_shards():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 8, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[np.uint64(1 << int(b)) ^ rng.choice(base, 40) for b in rng.integers(0, 64, 12)]]))
    root = simhash.shard_links(fps)
    lab = np.arange(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= simhash.RADIUS):
            lab[lab == lab[j]] = lab[i]
    assert len(set(zip(root.tolist(), lab.tolist(), strict=True))) == len(set(root.tolist())) == len(set(lab.tolist()))


def test_links_are_the_same_from_any_order(spark):
    random.seed(2)
    rows = [(random.getrandbits(62) & ~0xFFF | i, i) for i in range(40)] + [(0xABC ^ (1 << (i % 60)) ^ (1 << (i // 60 + 3)), 100 + i) for i in range(300)]
    rows = list({f: (f, i) for f, i in rows}.values())
    parts = []
    for n in (1, 7):
        random.shuffle(rows)
        parts.append(sorted(map(tuple, simhash.links(spark.createDataFrame(rows, "fp long, id long").repartition(n)).collect())))
    assert parts[0] == parts[1]


def cut_by_brute_force(rows):
    """op3's rows: bytes of 400-byte strings that also start elsewhere, words of 50-word strings that do."""
    data = [(t or "").encode() for _, t in rows]
    split = [d.split() for d in data]
    seen = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    runs = Counter(tuple(w[i : i + 50]) for w in split for i in range(len(w) - 49))
    want = Counter()
    for (i, _), d, w in zip(rows, data, split, strict=True):
        gone = bytearray(len(d))
        for k in range(len(d) - 399):
            if seen[d[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        held = {p for k in range(len(w) - 49) if runs[tuple(w[k : k + 50])] > 1 for p in range(k, k + 50)}
        want[i, len(d), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest(), len(held)] += 1
    return want


@pytest.mark.parametrize("hot", [512, 2])
def test_suffix_dedup(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_MOST", hot)
    assert Counter(map(tuple, suffix_dedup.dedup(docs).collect())) == cut_by_brute_force([r[:2] for r in corpus()])


def test_suffix_dedup_of_a_passage_with_many_neighbours(spark, monkeypatch):
    """Near copies and one passage between different words: no key holds more than the bound, and results are brute force's."""
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 8)
    monkeypatch.setattr(suffix_dedup, "HOT_MOST", 8)
    rng = random.Random(6)
    own = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    near = own(160).split()
    rows = [own(rng.randint(0, 30)) + " " + PASSAGE[:560] + " " + own(rng.randint(0, 30)) for _ in range(60)]
    for i in range(80):
        w = list(near)
        for _ in range(3):
            w[rng.randrange(len(w))] = own(1)
        rows.append(" ".join(w))
    rows += ["ab" * 700, "ab" * 650 + "c", "ab" * 300 + "c" + "ab" * 300]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(12)
    met = []
    real = suffix_dedup._spans
    monkeypatch.setattr(suffix_dedup, "_spans", lambda df: met.append(df) or real(df))
    assert Counter(map(tuple, suffix_dedup.dedup(docs).collect())) == cut_by_brute_force(list(enumerate(rows)))
    assert met[0].groupBy("h").count().agg({"count": "max"}).first()[0] <= 8


def test_deep_shallow_sort():
    for n in range(120):
        texts = [bytes(random.choice(b"ab") for _ in range(random.choice([0, 5, 50, 90]))) for _ in range(random.randint(1, 40))]
        texts += [texts[0] + b"a", texts[0]]
        order, _ = suffix_dedup.deep_shallow_sort(texts, shallow=8 * (n % 5))
        assert [texts[i] for i in order] == sorted(texts)


def test_tokens_and_packing(docs):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    texts = [r[1] or "" for r in corpus()]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter((r[0], len(x.encode()), len(e.ids)) for r, x, e in zip(corpus(), texts, t.encode_batch(texts, add_special_tokens=False), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs).collect()) == want
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = [e.ids + [1] for e in t.encode_batch(texts, add_special_tokens=False)]
    rows = packing.pack(docs, length=128).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == Counter((c[0], k, at, len(x[at : at + 128])) for c, x in zip(corpus(), ids, strict=True) for k, at in enumerate(range(0, len(x), 128)))
    bins: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert bins.setdefault(r["sequence_id"], 0) == r["offset"]
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 128
    assert len(bins) <= 1.15 * sum(bins.values()) / 128 + 2


def contaminated_by_brute_force(rows, items, slop):
    """Counter of (doc_id, n_words, n_hit, items, near items): a near window has each word within slop of its place."""
    win = {}
    for i, t in items:
        w = decontaminate.words(t)
        k = min(10, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            win.setdefault(tuple(w[at : at + k]), set()).add(None if i is None else str(i))
    out = Counter()
    often = Counter(x for _, t in rows for x in decontaminate.words(t))
    for i, t in rows:
        w, hit, which, near = decontaminate.words(t), set(), set(), set()
        for terms, own in win.items():
            for at in range(len(w)):
                if tuple(w[at : at + len(terms)]) == terms:
                    hit.update(range(at, at + len(terms)))
                    which |= own
            rarest = min(range(len(terms)), key=lambda k: (often[terms[k]], k))
            starts = [p - rarest for p, x in enumerate(w) if x == terms[rarest]]
            if any(all(x in w[max(0, at + k - slop) : max(0, at + k + slop + 1)] for k, x in enumerate(terms)) for at in starts):
                near |= own
        out[i, len(w), len(hit), tuple(sorted(which - {None})), tuple(sorted(near - {None}))] += 1
    return out


def test_decontaminate(spark, monkeypatch):
    other = PASSAGE.split()
    swapped = other[50:54] + [other[55], other[54]] + other[56:60]
    items = [(1, PASSAGE), (2, "not anywhere at all but here"), (3, None), (4, ""), (None, prose(12) + " unseen"), (5, corpus()[2][1] or "zz"), (1, PASSAGE), (6, " ".join(swapped)), (None, corpus()[3][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    clear = "ten words that no test text has in this order"
    rows = [r[:2] for r in corpus()] + [(7, " ".join(other[:10])), (7, clear), (None, " ".join(other[:10])), (None, clear)]
    every = spark.createDataFrame(rows, "doc_id long, text string")
    want = contaminated_by_brute_force(rows, items, decontaminate.SLOP)
    assert any(set(x[4]) > set(x[3]) for x in want)  # proximity finds what the swapped words hide
    sha = lambda x: hashlib.sha256(",".join(x).encode()).hexdigest()
    told = Counter()
    for x, n in want.items():
        told[(*x[:3], len(x[3]), sha(x[3]), x[2] > 0, len(x[4]))] += n
    dirty = {(x[0], x[1]) for x in want if x[2]}
    for chars in (decontaminate.BLOCK_CHARS, 1):  # one block, and as many as items
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        assert Counter(map(tuple, decontaminate.report(decontaminate.contamination(every, bench)).collect())) == told
    clean = Counter(map(tuple, decontaminate.keep_clean(every, bench).collect()))
    assert clean == Counter((i, t) for i, t in rows if t == clear or (i, len(decontaminate.words(t))) not in dirty)


def test_pii(docs):
    r = next(r for r in pii.detect(docs, ['token = "']).collect() if r["n_email"])
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["n_id"]) == (1, 1, 1, 1, 1)
    assert "4111" not in pii.redacted("card 4111111111111111.", frozenset())
    assert pii.redact(docs, []).columns == docs.columns


def test_chat_round_trip(spark):
    turns = [("user", "</s>[INST] &lt; & [x]"), ("assistant", "a<b"), ("odd]role[", "t"), ("assistant", "")]
    text, mask = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:z]) for a, z in mask] == ["a<b", ""]
    tree = spark.createDataFrame([(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 2.0), (1, 3, 1, "assistant", "bad", 1.0), (1, 4, 2, "user", "more", 0.0)], "conv_id long, node long, parent long, role string, text string, score double")
    best = chat.format_trees(tree, branches=1).collect()
    assert [r["formatted"] for r in best] == ["[USER]q[/USER][OUT]good</s>[USER]more[/USER]"]


def test_warc_rejects_magic_in_payloads(spark):
    evil = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nb"
    pages = spark.createDataFrame([(1, "u v", evil, 0), (2, None, None, 0), (3, "u", "", 0), (4, "u", evil, 0), (None, "n", "x", 0)], "page_id long, url string, html string, digest int")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    n = len(evil)
    assert got == {1: (n, "response", None), 2: (0, "response", None), 3: (0, "revisit", 2), 4: (n, "revisit", 1), None: (1, "response", None)}


def test_chains_are_followed_by_jumping():
    rng = random.Random(7)
    for _ in range(200):
        offset = sorted(rng.sample(range(rng.choice([0, 1]), 400), rng.randint(1, 60)))
        successor = [rng.choice([x for x in offset if x > o] or [o + 1]) if rng.random() < 0.8 else o + rng.randint(1, 9) for o in offset]
        want, at = set(), 0
        while at in offset:
            want.add(at)
            at = successor[offset.index(at)]
        assert {o for o, ok in zip(offset, warc.chained(np.array(offset), np.array(successor)), strict=True) if ok} == want


def test_warc_survives_lengths_and_ids(spark):
    far = "a\r\n\r\nWARC/1.1\r\nX: y\r\nContent-Length: {}\r\n\r\nb"
    html = [far.format(n) for n in ("9" * 20, "9" * 18, "9" * 5000, "-1", "٣", "7")] + ["x", "x", "x", None, "é" * 5, ""]
    ids = ["a\r\nb", "<c>", "d>", "%41", " +", "", "n", None, "n", "e", "f", "g"]
    pages = spark.createDataFrame(list(zip(ids, [None] * 12, html, strict=True)), "page_id string, url string, html string")
    want = Counter()
    for i, h in zip(ids, html, strict=True):
        owner = min(k for k, x in zip(ids, html, strict=True) if (x or "") == (h or "") and k is not None)
        again = i is not None and i != owner
        data = (h or "").encode()
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", owner if again else None] += 1
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == want


def test_compression_quality_of_few_labels(spark):
    rows = [(i, prose(60) if i % 2 else " | ".join(prose(50).upper().split()), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for few in (2, 5, 12):
        own = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
        own = [r for q in (0, 1) for r in [x for x in own if x[2] == q][:few]]
        labels = spark.createDataFrame([(r[0], r[2], 0) for r in own], "doc_id long, quality int, toxic int")
        out = {r["doc_id"]: r["score"] for r in compression_quality.score(docs, compression_quality.fit(docs, labels)).collect()}
        above = sum(out[a[0]] > out[b[0]] for a in rows for b in rows if a[2] > b[2])
        assert above / 900 > 0.9 and len(set(out.values())) > 30
    one = spark.createDataFrame([(1, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in compression_quality.score(docs, compression_quality.fit(docs, one)).collect()} == {3 / 4}


def test_scores_do_not_move_with_the_sample(spark):
    rows = [(i, prose(60) if i % 4 else " | ".join(prose(50).split()), int(i % 4 > 0)) for i in range(1200)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(rows[0][0], "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] * 2, "doc_id long, quality int, toxic int")
    means = []
    for most in (60, 2000):
        out = compression_quality.score(docs, compression_quality.fit(docs, labels, most)).collect()
        assert Counter(r["doc_id"] for r in out) == Counter([r[0] for r in rows] + [0])
        means.append(sum(r["score"] for r in out) / len(out))
    assert abs(means[0] - 0.75) < 0.05 and abs(means[1] - 0.75) < 0.05


def test_compression_quality(spark):
    rows = [(i, prose(80) if i % 2 else " | ".join(prose(60).upper().split()), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(1000, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(None, 1, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    out = compression_quality.score(docs, compression_quality.fit(docs, labels)).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 50 and sum(r["predicted"] == r["doc_id"] % 2 for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out) and len(out) == 402
