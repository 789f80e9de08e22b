"""Tokenizer, language model, language and toxicity against plain versions and held-out accuracy."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from delayengine.llm import bpe, language, ngram_lm, scratch, toxicity, words

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codecs():
    with open(PATH, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    return bpe.Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_words_of_a_batch():
    texts = ["One two  TWO", None, "", "x", " end\x0b\n é É "]
    found = words.words_of(words.texts_of(pa.array(texts)))
    assert found.counts.tolist() == [len(plain_words(t)) for t in texts]
    flat = [w for t in texts for w in plain_words(t)]
    assert len(set(found.hashes.tolist())) == len(set(flat))
    assert found.hashes[1] == found.hashes[2]


def test_encodes_as_the_public_library(codecs):
    own, public = codecs
    rng = random.Random(5)
    kinds = ["abcdeinthes", "aaaab", "  \n\t a", "0123456789", "éàñß漢字🎉", ".,-_=+/(){}'s", "\x1c\x85   x"]
    for size in (1, 3, 8, 40, 300):
        for _ in range(300):
            text = "".join(rng.choice(rng.choice(kinds)) for _ in range(size))
            ids = own.encode(text)
            assert ids.tolist() == public.encode_ordinary(text)
            assert own.decode(ids, block=3) == text
    assert own.encode("a" * 50_000).tolist() == public.encode_ordinary("a" * 50_000)


def test_forgets_states_without_changing_results(codecs):
    ranks = codecs[0].met.ranks
    small = bpe.Transducer(ranks, max_states=20)
    for word in ("internationalization", "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz", "Überschreibungsfehler", "internationalization") * 3:
        assert [*small.encode(word.encode())] == codecs[1].encode_ordinary(word)


def test_the_pipeline_keeps_few_states(codecs):
    few = bpe.Codec(codecs[0].met.ranks, public_tokenizers.PATTERN, 20)
    text = "internationalization zzzzzzzzzzzzzzzzzzz Überschreibungsfehler unenrèreè"
    assert few.encode(text).tolist() == codecs[1].encode_ordinary(text) and len(few.met.transducer.states) <= 20
    assert bpe.FEW_STATES < codecs[0].met.transducer.max_states


def test_new_words_take_little_memory(codecs):
    rng = random.Random(3)
    fresh = ["".join(rng.choice(["in", "the", "on", "er", "at", "ou", "sh", "nt"]) for _ in range(6)) for _ in range(3000)]
    own = bpe.Transducer(codecs[0].met.ranks)
    tracemalloc.start()
    try:
        for word in fresh:
            own.encode(word.encode())
        assert tracemalloc.get_traced_memory()[0] < 2e6
    finally:
        tracemalloc.stop()
    assert all(own.encode(w.encode()) == codecs[1].encode_ordinary(w) for w in fresh if w.encode() not in own.ranks)


def test_a_vocabulary_without_a_byte():
    own = bpe.Transducer({b"a": 0, b"b": 1, b"ab": 2})
    assert own.encode(b"aabb") == [0, 2, 1] and own.encode(b"") == []
    with pytest.raises(ValueError):
        own.encode(b"abz")


def test_digests_take_one_python_step(documents):
    plan = bpe.digests(documents, PATH, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_unfinished_characters_wait():
    data = "aé漢🎉".encode()
    for cut in range(len(data) + 1):
        stream = bpe.Utf8Stream()
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.end() == "aé漢🎉"
    broken = bpe.Utf8Stream()
    assert broken.feed(b"a\xe6\xbc") == "a" and broken.end() == "�"


def test_bpe_digests(documents, odd, nothing, codecs):
    for table in (documents, odd):
        got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(table, PATH, public_tokenizers.PATTERN).collect())
        want = Counter()
        for r in table.select("doc_id", "text").collect():
            text = r.text or ""
            ids = codecs[1].encode_ordinary(text)
            want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert got == want
    assert bpe.digests(nothing, PATH, public_tokenizers.PATTERN).count() == 0


def kneser_ney(texts):
    """A plain model: a function of (word, word before)."""
    pairs = Counter()
    for text in texts:
        tokens = ["<s>", *plain_words(text), "</s>"]
        pairs.update(zip(tokens, tokens[1:], strict=False))
    def discounts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        return ngram_lm._discounts(n)
    before, follow, total = defaultdict(set), defaultdict(Counter), Counter()
    for (v, w), c in pairs.items():
        before[w].add(v)
        follow[v][min(c, 3)] += 1
        total[v] += c
    d, e = discounts(pairs.values()), discounts([len(x) for x in before.values()])
    kinds = Counter(min(len(x), 3) for x in before.values())
    spare = sum(kinds[i + 1] * e[i] for i in range(3)) / len(pairs)
    def lower(w):
        n = len(before.get(w, ()))
        return max(n - (e[min(n, 3) - 1] if n else 0), 0) / len(pairs) + spare / (len(before) + 1)
    def p(w, v):
        if v not in total:
            return lower(w)
        c = pairs.get((v, w), 0)
        free = sum(follow[v][i + 1] * d[i] for i in range(3)) / total[v]
        return max(c - (d[min(c, 3) - 1] if c else 0), 0) / total[v] + free * lower(w)
    return p, before


def test_language_model_equals_a_plain_one(documents):
    rows = documents.select("doc_id", "text").where("doc_id < 60").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows}
    training = [r.text for r in rows if not held[r.doc_id]]
    counts = Counter(w for t in training for w in [*plain_words(t), "</s>"])
    n, v = sum(counts.values()), len(counts)
    p, vocabulary = kneser_ney(training)
    for context in ("<s>", "the", "never seen"):
        assert math.isclose(sum(p(w, context) for w in vocabulary) + p("unknown", context), 1.0)
    for r in ngram_lm.score_corpus(documents.where("doc_id < 60")).collect():
        text = next(x.text for x in rows if x.doc_id == r.doc_id)
        tokens = [*plain_words(text), "</s>"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens), rel_tol=1e-9)
        want = sum(math.log10(p(w, b)) for b, w in zip(["<s>", *tokens], tokens, strict=False))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-want / len(tokens)), rel_tol=1e-9)


def test_language_model_of_odd_rows(odd, nothing):
    got = ngram_lm.score_corpus(odd).collect()
    assert len(got) == odd.count()
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (2, 3, 4))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert ngram_lm.score_corpus(nothing).count() == 0
    untrained = ngram_lm.score(odd.select("doc_id", "text"), ngram_lm.fit(odd, F.lit(False)))
    assert all(r.score == 0 and r.base_score == 0 for r in untrained.collect())


def plain_grams(text):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        w = [language._EDGE, *map(ord, word), language._EDGE]
        grams.update(w[1:-1])
        grams.update(a << 21 | b for a, b in zip(w, w[1:], strict=False))
        # an edge in the middle belongs to no n-gram
        grams.update(a << 42 | b << 21 | c for a, b, c in zip(w, w[1:], w[2:], strict=False))
    return grams


def test_grams_of_a_batch(odd):
    texts = ["Ab a", "", "é!x 12 y", "  ", "漢字 straße"]
    rows, grams, counts = language.gram_counts([t.lower() for t in texts])
    got = defaultdict(Counter)
    for r, g, c in zip(rows.tolist(), grams.tolist(), counts.tolist(), strict=True):
        got[r][g] += c
    assert [got[i] for i in range(len(texts))] == [plain_grams(t) for t in texts]


def test_language_steps_are_alone_and_small(monkeypatch):
    gone = []
    monkeypatch.setitem(scratch._held, "byte_bpe", lambda: gone.append("byte_bpe"))
    batch = pa.RecordBatch.from_pydict({"text": ["some words " * 2000, None] * 60})
    found = list(language._bounded(iter([batch])))
    assert gone == ["byte_bpe"] and pa.Table.from_batches(found).equals(pa.Table.from_batches([batch]))
    tracemalloc.start()
    try:
        for piece in found:
            language.gram_counts(language._texts(piece, "text"))
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_language_held_out(spark, documents):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predict_corpus(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.count() > 150
    assert got.where("lang = lang_pred").count() / got.count() > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(odd, nothing):
    got = {(r.doc_id, r.lang_pred) for r in language.predict_corpus(odd).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (5, "und"), (None, "und")} <= got
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id in (2, 3, 4, 5)").count() == 0 and kept.where("doc_id in (1, 6)").count() == 4
    assert language.predict_corpus(nothing).count() == 0 and language.keep_identified(nothing).collect() == []


def test_toxicity_held_out(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = toxicity.score_corpus(docs, labels)
    rows = got.where("held_out").join(labels, "doc_id").toPandas()
    ranks, bad = rows.score.rank().to_numpy(), rows.toxic.to_numpy() == 1
    auc = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.82
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (7, 0), (None, 1), (9, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.score_corpus(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_corpus(odd, none).collect()} == {0.0}
    assert toxicity.score_corpus(nothing, labels).count() == 0


def test_a_rare_class_keeps_its_rows_in_the_sample(spark, documents):
    plain, bad = [f"word{i}" for i in range(60)], [f"slur{i}" for i in range(6)]
    rng, rows = random.Random(6), []
    for i in range(8000):
        text = rng.choices(plain, k=12) + (rng.choices(bad, k=4) if i % 100 == 0 else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(i % 100 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    model = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"), F.col("doc_id") % 400 != 0, sample_rows=400, max_entries=40)
    got = {r.doc_id: r.score for r in toxicity.score(table.select("doc_id", "text"), model).collect()}
    toxic, ordinary = [got[i] for i, _, t in rows if t], [got[i] for i, _, t in rows if not t]
    assert min(toxic) > max(ordinary) and sum(x > 0.5 for x in toxic) > 0.9 * len(toxic)
    assert 0.005 < sum(got.values()) / len(got) < 0.02  # the classes' shares of all labels, not of the sample
