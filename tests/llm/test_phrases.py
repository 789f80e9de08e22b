"""Collocations against plain counting, also in many shards, with long repeated passages, and on odd rows."""

import re
from collections import Counter

import pytest
from compare import differences

from delayengine.llm import phrases as w
from delayengine.llm.oracles import COLLOCATIONS
from delayengine.llm.queries import op12_collocations, reach

SF = "/root/testdata/sf0.001"


def pieces_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[x for x in re.split(r"[\x20\x09]+", p) if x] for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain(rows, least=30, best=2000):
    """The contract word for word."""
    counts = {}
    for text, lang in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        for words in pieces_of(text):
            for k in range(1, 5):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        most = Counter()
        for p, c in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i:i + k]] = max(most[p[i:i + k]], c)
        found = []
        for p, a in candidates.items():
            if 100 * most[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def table(spark, rows):
    reach(spark)
    return spark.createDataFrame([(t, l, "x", 1) for t, l in rows], "text string, lang string, word string, n int")


def test_matches_sql(spark):
    assert differences(op12_collocations(spark, SF), COLLOCATIONS, SF) == []


@pytest.mark.parametrize("shard_bytes", [1 << 20, 1000])
def test_low_limits_match_plain_counting(spark, documents, shard_bytes, monkeypatch):
    """Many candidates of all lengths, in one shard and in hundreds, with small units and dictionaries."""
    monkeypatch.setattr(w, "SHARD_BYTES", shard_bytes)
    own = documents.where("length(text) < 3000").limit(60).select("text", "lang")
    given = [(r.text, r.lang) for r in own.collect()]
    graph = w.Graph(own, 3, shard_bytes)
    rows = w.scored(w.candidates(graph)).join(graph.words.selectExpr("id", "lang"), w.F.expr("ids[0] = id"))
    found = sorted((r.lang, r.phrase, r.a, r.l, r.r, r.score) for r in w._spelled(rows.drop("lang", "id"), graph, "ids").collect())
    assert found == sorted((x[0], x[2], x[3], x[4], x[5], x[7]) for x in plain(given, 3, 10**9)) and len(found) > 100


def test_unary_paths_and_ties(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(f"start {passage} end. {passage}", "en")] * 5 + [("a b c d e f", None)] * 6 + [("a a a a a a", "en")] * 4 + [("x y\nx y, z", "und")] * 3
    rows += [(f"{passage} other", "fr")] * 4
    frame = table(spark, rows)
    found = rows_of(w.collocations(frame, 4, 10**6))
    assert found == plain(rows, 4, 10**6)
    assert rows_of(w.collocations(frame, 4, 3)) == plain(rows, 4, 3)
    paths = {(r.lang, r.phrase): r.n for r in w.long_phrases(frame, 4).collect()}
    assert paths["fr", f"{passage} other"] == 4 and paths["und", "a b c d e f"] == 6
    assert paths["en", passage] == 10


def test_more_words_than_a_dictionary_holds(spark, monkeypatch):
    monkeypatch.setattr(w, "_CODES", 5)
    rows = [("one two three four five six seven eight nine ten", "en")] * 3
    reach(spark)
    import numpy as np

    ids = np.arange(1, 31, dtype=np.uint64)
    more = np.ones(30, bool)
    more[29] = False
    parts = list(w._windows(ids, more, 0, 30))
    assert len(parts) > 3 and sum(int(p[4].sum()) for p in parts) == 29
    grams = {tuple(int(x) for x in g) for p in parts for g in zip(*p[:4], strict=True)}
    assert grams == {tuple(i + k if i + k <= 30 else 0 for k in range(4)) for i in range(1, 30)}
    assert rows_of(w.collocations(table(spark, rows), 2)) == plain(rows, 2)


def test_one_hash_for_two_words_is_an_error():
    import numpy as np
    import pyarrow as pa

    ids, one = np.array([5], np.uint64), np.ones(1, np.int64)
    blocks = [w._word_blocks(ids, one, np.zeros(1, np.uint16), np.array([2], np.uint32), np.frombuffer(t, np.uint8), ["en"], 1) for t in (b"ab", b"ac")]
    with pytest.raises(ValueError, match="one hash"):
        w._merged_words("/nowhere", 1)((pa.scalar(0),), pa.Table.from_batches(blocks))


def test_odd_rows(spark, odd, nothing):
    given = [(r.text, r.lang) for r in odd.collect()]
    assert rows_of(w.collocations(odd, 2)) == plain(given, 2)
    assert rows_of(w.collocations(odd)) == plain(given)
    empty = w.collocations(nothing)
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    words = [("Éa ÉA éa\tÉa Éa \x1c \x85", "a\0b"), (" , .", "z"), (None, "z")] * 2
    assert rows_of(w.collocations(table(spark, words), 2)) == plain(words, 2)
