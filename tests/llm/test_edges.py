"""Very long texts, odd ids, clashing columns, empty tables, and the pipeline as a whole."""

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from evidtable.llm import chat, decontaminate, packing, pii, quality_rules, simhash, suffix_dedup, token_counts

random.seed(21)
WORDS = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 8))) for _ in range(4000)]
prose = lambda n: " ".join(random.choice(WORDS) for _ in range(n))


def test_one_very_long_text(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    part, told = prose(300), prose(12)
    long = "\n".join([prose(30_000), part, told, "mail a.b@c.example.com", prose(20_000), part])
    docs = spark.createDataFrame([(1, long), (2, "short " + prose(12)), (3, None)], "doc_id long, text string")
    of = lambda rows, c="doc_id": {r[c]: r for r in rows.collect()}
    cut = of(suffix_dedup.dedup(docs))[1]
    twice = len(part.encode())
    assert twice * 2 <= cut["n_removed"] <= twice * 2 + 2 and cut["n_spans"] == 2 and cut["n_passage_words"] == 600
    bench = spark.createDataFrame([(9, told)], "item_id long, text string")
    hit = of(decontaminate.report(decontaminate.contamination(docs, bench)))
    assert (hit[1]["n_words"], hit[1]["n_hit"], hit[1]["n_items"], hit[2]["n_hit"]) == (len(decontaminate.words(long)), 12, 1, 0)
    found = of(pii.detect(docs))[1]
    assert found["n_email"] == 1 and f"email:{long.index('a.b@c')}:" in found["spans"]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert of(token_counts.token_counts(docs))[1]["n_tokens"] == len(t.encode(long, add_special_tokens=False).ids)
    pieces = [r for r in packing.pack(docs).collect() if r["doc_id"] == 1]
    assert sorted(r["start"] for r in pieces) == [4096 * i for i in range(len(pieces))] and {r["length"] for r in pieces[:-1]} <= {4096, pieces[-1]["length"]}
    assert of(simhash.components(docs))[1]["fp"] % 2**64 == simhash.fingerprint(long)
    w = long.split()
    runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    held = {p for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    ledger = {r["row"]["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    assert (ledger[1]["n_words"], ledger[1]["n_repeat_words"], ledger[3]["n_words"]) == (len(w), len(held), 0)


def test_ids_of_text_keep_their_class(spark):
    texts = [prose(40) for _ in range(6)]
    rows = [("b", texts[0], 1), ("a", texts[0], 2), ("c", texts[1], 3), ("10", texts[2], 4), ("9", texts[2], 5), (None, texts[1], 6), (None, texts[5], 7), ("c", texts[1], 8)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, fp long")
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.components(docs).collect())
    assert got == Counter([("b", "a"), ("a", "a"), ("c", "c"), ("10", "10"), ("9", "10"), (None, None), (None, None), ("c", "c")])


def test_conversations_with_gaps(spark):
    rows = [(1, 0, "user", "q", "x"), (1, 1, "assistant", None, "x"), (1, 1, "assistant", None, "x"), (1, None, None, "t", None), (None, 0, "user", "", "x"), (None, 1, "assistant", "</s>[OUT]é", "x"), (2, 5, "system", "s", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_trees(chat.linear_nodes(table))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {k: r["n_turns"] for k, r in out.items()} == {1: 4, None: 2, 2: 1}
    assert out[1]["turns_sha256"] == sha("\nt\nuser\nq\nassistant\n\nassistant\n\n") and out[1]["loss_chars"] == 0
    assert out[None]["loss_sha256"] == sha("</s>[OUT]é") and out[2]["loss_sha256"] == sha("")


def test_the_whole_pipeline(spark, tmp_path):
    good = [prose(80) for _ in range(30)]
    told = prose(20)
    near = good[3].split()
    near[40] = "changed"
    rows = [(i, t) for i, t in enumerate(good)] + [(50, good[0]), (51, " ".join(near)), (52, "too short"), (53, None), (54, prose(40) + " " + told + " " + prose(40)), (55, prose(60) + " write to a.b@c.example.com today"), (None, prose(70)), (56, prose(9000))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "row") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")
    docs.write.parquet(str(tmp_path / "full" / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for name in ("full", "none"):
        spark.createDataFrame([(1, told), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    seen, work = {}, spark.read.parquet(str(tmp_path / "full" / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        work = stage(spark, work, str(tmp_path / "full"))
        assert work.columns == docs.columns
        seen[name] = {r["doc_id"] for r in work.select("doc_id").collect()}
    every = {i for i, _ in rows}
    assert seen["quality_rules"] == every - {52, 53}
    assert seen["near_dedup"] == seen["quality_rules"] - {50, 51}
    assert seen["decontamination"] == seen["near_dedup"] - {54} == seen["pii"]
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in work.collect()}
    assert "[EMAIL]" in texts[55][0] and all(len(t) == n for t, n in texts.values())
    out = corpus_pipeline.run(spark, str(tmp_path / "full")).collect()
    assert {r["doc_id"] for r in out} == seen["pii"]
    assert sum(r["length"] for r in out) >= sum(len(re.findall(r"\S+", t)) for t, _ in texts.values()) + len(texts)
