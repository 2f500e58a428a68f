"""Near copies beyond the fingerprint's radius, against brute force."""

import random

import numpy as np
import pytest

from evidtable.llm import common, near_copies, simhash


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_clusters_are_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sets = []
        for _ in range(5):
            base = rng.integers(0, 2**63, 60, dtype=np.uint64)
            sets += [np.unique(np.concatenate([base[rng.permutation(60)[: rng.integers(45, 61)]], rng.integers(0, 2**63, rng.integers(0, 8), dtype=np.uint64)])) for _ in range(rng.integers(1, 9))]
        sets += [sets[0][:0], sets[0][:0]]
        group = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                own, other = set(sets[i].tolist()), set(sets[j].tolist())
                if not own | other or 5 * len(own & other) >= 4 * len(own | other):
                    a, b = sorted((group[i], group[j]))
                    group = [a if g == b else g for g in group]
        assert near_copies.near_roots(sets).tolist() == group


def test_near_copies_beyond_the_radius_go(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = []
    for _ in range(60):
        w = [word() for _ in range(110)]
        other = list(w)
        other[30], other[60] = word(), word()
        texts += [" ".join(w), " ".join(other)]
    far = [i for i in range(0, 120, 2) if (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[i + 1])).bit_count() > simhash.RADIUS]
    near = [jaccard(*(set(simhash.shingle_hashes(texts[k], 5).tolist()) for k in (i, i + 1))) for i in range(0, 120, 2)]
    assert len(far) > 20 and min(near) >= 0.8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_first(docs).collect()} == set(range(0, 120, 2))
    apart = {r["doc_id"]: r["component_id"] for r in simhash.components(docs).collect()}
    assert all(apart[i + 1] == i + 1 for i in far)  # op8 keeps its radius


def groups_by_brute_force(texts):
    sets = [set(simhash.shingle_hashes(t, simhash.NEAR_SHINGLE).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and (not sets[i] | sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])):
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


@pytest.mark.parametrize(("big", "pivots"), [(2000, 64), (10, 4)])
def test_first_of_each_group_stays(spark, monkeypatch, big, pivots):
    """Chains, clusters that meet, repeated and null ids, clashing columns: one row of each group, in one task or by pivots."""
    monkeypatch.setattr(near_copies, "BIG", big)
    monkeypatch.setattr(near_copies, "PIVOTS", pivots)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = []
    for _ in range(4):
        w = [word() for _ in range(120)]
        for _ in range(30):  # each is near the one before, ends are far apart
            texts.append(" ".join(w))
            w = list(w)
            w[rng.randrange(len(w))] = word()
    texts += [texts[0], texts[5].upper(), "", "", None, "one two", "one  two", "a b c d e f", "a b c d e g"]
    ids = [rng.choice([None, 7, i, 1000 - i]) for i in range(len(texts))]
    docs = spark.createDataFrame([(d, t, i, "r") for i, (d, t) in enumerate(zip(ids, texts, strict=True))], "doc_id long, text string, id int, row string")
    out = simhash.keep_first(docs)
    assert out.columns == docs.columns
    group, best = groups_by_brute_force(texts), {}
    for i, g in enumerate(group):
        best.setdefault(g, []).append((ids[i] is None, ids[i] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == sorted(min(x) for x in best.values())
    assert {group[r["id"]] for r in out.collect()} == set(group)


def test_links_of_pivots_are_fewer_than_texts(spark):
    texts = {i: (i % 2, np.arange(1000 * (i % 2) + i, 1000 * (i % 2) + i + 400, dtype=np.uint64)) for i in range(60)}  # two chains of near sets
    rows = [(1, 0, m, i, bytearray(s.astype("<u8").tobytes())) for m in (False, True) for i, (_, s) in texts.items() if m or i < 24]
    met = spark.createDataFrame(rows, "label long, chunk long, member boolean, id long, shingles binary").coalesce(1).sortWithinPartitions("label", "chunk", "member", "id")
    links = near_copies._against(met, near_copies.SIMILAR).collect()
    assert len(links) == len(texts) - 2  # all pairs with a pivot would be over a thousand
    root = {i: i for i in texts}
    for a, b in links:
        root = {i: root[a] if r == root[b] else r for i, r in root.items()}
    assert len(set(root.values())) == 2 and all(root[i] == root[i % 2] for i in texts)


@pytest.fixture
def staged(monkeypatch):
    """Counts the rows of each staged table: (tag, rows)."""
    seen, stage = [], common.stage

    def counted(df, tag):
        out = stage(df, tag)
        seen.append((tag, out.count()))
        return out

    for module in (common, near_copies, simhash):
        monkeypatch.setattr(module, "stage", counted)
    return seen


def test_labels_join_about_one_link_for_each_node(spark, staged):
    rng = random.Random(2)
    pairs = [(i, j) for i in range(60) for j in range(i)]  # every pair of a group
    pairs += [(rng.randrange(100, 140), k) for k in range(140, 400) for _ in range(20)]  # many to many, as bands link them
    pairs += [(1000 - i, 999 - i) for i in range(40)] + [(2000, k) for k in range(1500, 1600)] + [(7000, 7000)]  # a chain, a hub above all
    out = {r["node"]: r["label"] for r in common.min_labels(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {i: i for p in pairs[:-1] for i in p}
    for a, b in pairs:
        low, high = sorted((root.get(a, a), root.get(b, b)))
        root = {i: low if r == high else r for i, r in root.items()}
    assert out == root
    assert dict(staged)["edges"] <= 2.5 * len(root)  # both ways; all links would be over 14 for each node


def test_links_of_a_small_shard_span_it():
    rng = np.random.default_rng(4)
    near = np.uint64(0) | (np.uint64(1) << np.arange(20, dtype=np.uint64))  # every two differ in 2 bits
    path = np.cumsum(np.uint64(3) << (np.uint64(2) * np.arange(9, dtype=np.uint64)))  # only next but one are near
    fps = np.concatenate([near, path, rng.integers(0, 2**63, 15, dtype=np.uint64)])
    shard = np.repeat([1, 2, 3], [20, 9, 15])
    ids = rng.permutation(len(fps)) + 100
    a, b = simhash._links(np.zeros(len(fps), np.int64), shard, fps, ids)
    assert len(a) == 19 + 8
    root = {int(i): int(i) for i in ids}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        root = {i: root[x] if r == root[y] else r for i, r in root.items()}
    assert [len({root[int(i)] for i in ids[shard == k]}) for k in (1, 2, 3)] == [1, 1, 15]


def test_rounds_of_pivots_label_only_new_links(spark, staged, monkeypatch):
    """Many rounds over a cluster and texts far from it, which all become pivots: the cluster is labelled once."""
    monkeypatch.setattr(near_copies, "BIG", 30)
    monkeypatch.setattr(near_copies, "PIVOTS", 10)
    sets = [" ".join(str(k) for k in range(i, 400 + i)) for i in range(50)] + [" ".join(str(1000 * i + k) for k in range(400)) for i in range(9, 59)]
    met = spark.createDataFrame([(0, len(sets), i, t) for i, t in enumerate(sets)], "label long, n long, id long, text string")
    links = near_copies._by_pivots(met, lambda x: np.array(sorted(map(int, x.split())), np.uint64), near_copies.SIMILAR).collect()
    root = {i: i for i in range(100)}
    for a, b in links:
        root = {i: root[a] if r == root[b] else r for i, r in root.items()}
    assert len(links) == 49 and {root[i] for i in range(50)} == {0} and all(root[i] == i for i in range(50, 100))
    rounds = [n for tag, n in staged if tag == "edges"]
    assert len(rounds) >= 5 and sum(rounds) < 2 * len(sets)  # over 600 if each round labelled all links again
