"""Packing against a plain tokenizer, an exhaustive search on small cases, and the lower bound on the given documents."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from delayengine.llm import packing as w
from delayengine.llm.queries import WORD_VOCABULARY, op13_packing
from delayengine.llm.words import texts_of

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(WORD_VOCABULARY)
ODD = [
    "", "a", "İstanbul, İ, x", "O'Neil's it's don'T", "12.5%abc3", "naïve Ünïcode ×÷ a×b", "漢字 and 🎉!!", "éte, café.", "x\xa0y z a\x1cb \x85q",
    "<|endoftext|> hi<|startoftext|>", "ſ K Å Ǆ ǅ ﬁ", "a" * 5000, "ß,ẞ;ﬀ…,!", "1²3½ ٣٤", "́a ́, ü̈ ñ̃,", "Ĳ ŉ ǰ ΐ Σς ΑΣ ΑΣ,",
    "\n\n \t", "éé, É.", "\x00\x01 \x7f",
]


def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_the_librarys():
    encode = reference()
    words = ["".join(random.Random(i).choices("abc'éÉ×ñ.,-7İ́漢 ", k=12)) for i in range(400)]
    ids, sizes = w.encoder(PATH).encode(texts_of(pa.array([*ODD, *words, None])))
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [encode(x) for x in [*ODD, *words, None]]


def fewest(items, size):
    """The optimum by trying everything."""
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, room):
        if len(room) >= best[0]:
            return
        if i == len(items):
            best[0] = len(room)
            return
        for j in {r: j for j, r in enumerate(room) if r >= items[i]}.values():
            room[j] -= items[i]
            go(i + 1, room)
            room[j] += items[i]
        go(i + 1, [*room, size - items[i]])

    go(0, [])
    return best[0]


def sequences(plan, counts):
    done = np.zeros(len(counts), int)
    for filling in plan:
        assert 0 < sum(filling.lengths) < len(counts) and filling.times > 0
        for length in filling.lengths:
            done[length] += filling.times
    assert done.tolist() == list(counts)
    return sum(f.times for f in plan)


def counted(items, size):
    return np.bincount(items, minlength=size + 1).tolist() if items else [0] * (size + 1)


def test_small_cases_are_optimal():
    source, better = random.Random(3), 0
    for n in range(300):
        size = source.choice([10, 20, 37])
        items = [source.randint(1, size) if n % 2 else source.randint(size // 5, size // 2) for _ in range(source.randint(0, 12))]
        counts = counted(items, size)
        found = sequences(w.pack(counts, size), counts)
        assert w.lower_bound(counts, size) <= found == fewest(items, size)
        better += found < sequences(w.best_fit(counts, size), counts)
    assert better > 0


def test_completions_are_undominated():
    counts = counted([7, 6, 5, 4, 3, 3, 2], 20)
    assert w.completions(counts, 9)[0] == (7, 2) and w.completions(counts, 7) == [(7,)]
    for rest in w.completions(counts, 9):
        assert sum(rest) <= 9
    assert w.completions(counted([5], 20), 4) == [()]
    assert w.completions(counted([3, 2, 2], 20), 4) == [(2, 2), (3,)]


@pytest.mark.parametrize("name, counts, bound", [
    ("ends only", [0, 10**6] + [0] * 2047, 489),
    ("thirds", [0] * 650 + [1000] * 60 + [0] * 1339, 20000),
    ("huge", [0] * 500 + [10**9] * 1000 + [0] * 549, None),
])
def test_large_counts(name, counts, bound):
    found = sequences(w.pack(counts), counts)
    assert found <= sequences(w.best_fit(counts, 2048), counts)
    if bound:
        assert found == bound


def check(rows, texts, size=w.SIZE):
    """Every document's ids, once, without gaps or overlaps; returns the number of sequences."""
    encode, pieces = reference(), {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    want = {}
    for doc, text in texts:
        want.setdefault(doc, []).append(encode(text))
    assert set(pieces) == set(want)
    for doc, given in want.items():
        expected = sorted(
            (k, k * size, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            for ids in given for k, part in enumerate(ids[i:i + size] for i in range(0, len(ids), size))
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc]) == expected
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(filled)


def test_the_given_documents(spark, documents):
    rows = op13_packing(spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    counts = counted([r.length for r in rows], w.SIZE)
    assert check(rows, texts) <= w.lower_bound(counts, w.SIZE) + 1
    assert op13_packing(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_many_tasks_and_small_sequences(spark, documents):
    own = documents.orderBy("doc_id").limit(60).repartition(7)
    rows = w.packed(own, PATH, 64).collect()
    check(rows, [(r.doc_id, r.text) for r in own.collect()], 64)


def test_odd_rows(spark, odd, nothing):
    rows = w.packed(odd, PATH).collect()
    check(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert {r.length for r in rows if r.doc_id == 3} == {1}
    assert w.packed(nothing, PATH).count() == 0


def test_units_forgotten_are_encoded_anew(monkeypatch):
    monkeypatch.setattr(w, "KEPT", 3)
    encode, own = reference(), w._Encoder(PATH)
    for text in ("one two three four five", "six one two", "seven one"):
        assert own.encode(texts_of(pa.array([text])))[0].tolist() == encode(text)


def test_workers_let_go_of_what_other_operators_held():
    from delayengine.llm import scratch

    gone = []
    scratch.holds("one", lambda: gone.append("one"))
    scratch.holds("two", lambda: gone.append("two"))
    try:
        scratch.alone("one")
        assert "two" in gone and "one" not in gone
    finally:
        del scratch._held["one"], scratch._held["two"]
