"""Near duplicates against a comparison of all pairs; line deduplication against a walk over all lines."""

import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from delayengine.llm import components, lines, near_dups
from delayengine.llm.packed import unpack
from delayengine.llm.words import texts_of, words_of


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def all_pairs(rows, least=0.8):
    """Number of links and least linked id of each (doc_id, text)."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = Counter(), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both >= least * (len(a) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[top(i)].append(doc_id)
    least_id = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, least_id[top(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [256, 2])
def test_equals_all_pairs(documents, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK_CLASSES", block)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = [(r.doc_id, r.class_id, r.n_links) for r in near_dups.linked_documents(documents).collect()]
    assert sorted(got, key=str) == all_pairs(rows)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(r.doc_id, r.class_id, r.n_links) for r in near_dups.linked_documents(odd).collect()]
    assert sorted(got, key=str) == all_pairs(rows)
    kept = near_dups.keep_one(odd)
    assert kept.columns == odd.columns
    texts = Counter(r.text for r in kept.collect())
    assert texts["one two three four five six seven"] == 1
    assert texts[None] == 2 and texts[""] == 1 and texts[" \n\t\n "] == 1
    assert near_dups.linked_documents(nothing).count() == 0
    assert near_dups.keep_one(nothing).collect() == []


def test_plan_reaches_its_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.95, 0.999)):
        bands, rows = near_dups.band_plan(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall
        assert bands * rows <= near_dups.HASHES


def test_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 50, 6000, 6000)]
    got = near_dups.shared_counts(sets[:3], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(0, i) for i in range(1000, 1500)] + [(7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 401)} | {0: 0} | {i: 0 for i in range(1000, 1500)}


def kept_lines(rows, least=0.8):
    """Texts without lines alike to an earlier one; rows in order, equal rows as one."""
    seen, out = [], {}
    for key in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if key[1] is None:
            out[key] = None
            continue
        kept = []
        for line in key[1].split("\n"):
            own = frozenset(words(line))
            if own and any(len(own & s) >= least * len(own | s) - 1e-9 for s in seen):
                continue
            if own:
                seen.append(own)
            kept.append(line)
        out[key] = "\n".join(kept)
    return out


# without a list all lines go to the second round; with a small group most words are split
@pytest.mark.parametrize(("listed", "group"), [(4, 2048), (0, 2048), (4, 3), (0, 3)])
def test_lines_equal_a_walk_over_all(documents, listed, group):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = {k[0]: v for k, v in kept_lines(rows).items()}
    got = {r.doc_id: (r.text, r.removed) for r in lines.deduplicate(documents, listed=listed, group=group).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert all((got[d][1] == 0) == (got[d][0] == t) for d, t in rows)


def test_lines_of_odd_rows(odd, nothing):
    out = lines.deduplicate(odd.drop("removed"))
    assert set(out.columns) == {*odd.columns}
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (1, "one two three four five six seven") in texts  # equal rows are one document
    assert (None, "") in texts and (None, None) in texts and (2, None) in texts and (3, "") in texts and (4, " \n\t\n ") in texts
    kept = lines.remove_lines(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id is null and text = ''").count() == 0  # it lost its only line
    assert lines.clean_lines(nothing).count() == 0 and lines.remove_lines(nothing).collect() == []


@pytest.mark.parametrize(("listed", "group"), [(4, 2048), (0, 3)])
def test_short_lines_inside_longer_ones(spark, listed, group):
    rows = [
        (1, "Are is anwh reenen."), (2, "As are is anwh reenen."), (3, "red green blue white black"), (4, "white blue\ngreen red blue white"),
        (5, "one two three"), (6, "one two three four"), (7, "w1 w2 w3 w4 w5\nw1 w2 w3 w4 w5 w6"), (8, "v1 v2 v3 v4\nv1 v2 v3 v5\nv0 v4 v3 v2 v1"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.deduplicate(table, listed=listed, group=group).collect()}
    assert got == {k[0]: v for k, v in kept_lines(rows).items()}
    assert (got[2], got[4], got[6]) == ("", "white blue", "one two three four")


def test_candidates_are_made_anew_from_their_own_lines_only(tmp_path):
    """A place names one line of each text with its doc_id; other lines and other texts are not read for words."""
    batch = pa.record_batch([pa.array([7, 8, None, 7]), pa.array(["a b\nc d\ne", "f\ng h", "i j\nk", "\nl m"])], ["doc_id", "text"])
    spots = np.sort(lines._spot(np.array([7, lines._LATE]), np.array([1, 0])))
    for s in range(3):
        lines.put(str(tmp_path), f"some-{s}-keys", spots[lines.shard_of(spots, 3) == s])
    got = [r for b in lines._sets_of(str(tmp_path), "some", 3)(iter([batch])) for r in b.to_pylist()]
    want = lines.lines_of(lines.texts_of(pa.array(["c d", "i j", "l m"])))
    assert [r["key"] for r in got] == want.key.view(np.int64).tolist()
    assert [w for r in got for w in r["words"]] == want.words.tolist()


def test_words_of_texts_that_meet_within_a_word():
    texts = ["", "ab", "", "b c", " ", "d\n", "", "e"]
    joined = words_of(texts_of(pa.array(texts)))
    alone = [words_of(texts_of(pa.array([t]))) for t in texts]
    assert joined.hashes.tolist() == [h for w in alone for h in w.hashes.tolist()]
    assert joined.counts.tolist() == [len(w.hashes) for w in alone] == [0, 1, 0, 2, 0, 1, 0, 1]
    assert joined.rows.tolist() == [1, 3, 3, 5, 7]


def test_python_steps_do_not_follow_each_other(documents, monkeypatch):
    """Two in a row need two workers a task, all of which later tasks use and fill."""
    plans, store = [], lines._store

    def noted(rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        store(rows, *rest)

    monkeypatch.setattr(lines, "_store", noted)
    lines.deduplicate(documents, listed=0).count()
    assert len(plans) == 5 and not [p for p in plans if "InArrow" in p]


def test_entries_are_ordered_and_paired_as_columns_say():
    rng = np.random.default_rng(3)
    n = 3000
    word, line = rng.integers(0, 40, n).astype(np.uint64), rng.integers(0, 5, n).astype(np.uint32)
    for doc in (rng.integers(0, 2000, n), rng.integers(0, 4, n), np.where(rng.random(n) < 0.1, lines._LATE, 7)):
        for keys in (rng.integers(0, 9, n).astype(np.uint64), lines.mixed(doc.view(np.uint64), line.astype(np.uint64))):
            order = lines._order(word, keys, doc, line)
            want = np.lexsort((keys, line, doc, word))
            assert all((c[order] == c[want]).all() for c in (word, keys, doc, line))
    assert len(lines._order(word[:0], keys[:0], doc[:0], line[:0])) == 0
    word, size = np.sort(word[:300]), rng.integers(1, 30, 300).astype(np.int32)
    got = [(min(x, y), max(x, y)) for a, b in lines._steps(word, size, 0.8) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    near = {(x, y) for x in range(300) for y in range(x + 1, 300) if word[x] == word[y] and min(size[x], size[y]) >= 0.8 * max(size[x], size[y]) - 1e-9}
    assert len(got) == len(set(got)) and set(got) == near
    assert list(lines._steps(word[:0], size[:0], 0.8)) == [] or not len(next(lines._steps(word[:0], size[:0], 0.8))[0])


def test_counting_words_takes_one_set_of_counters():
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i % 70_000}" for i in range(k, k + 100_000)) for k in range(0, 900_000, 100_000)] + [None]})
    tracemalloc.start()
    try:
        (found,) = lines._counted(iter([batch]))
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    counts = np.concatenate([unpack(b)[0] for b in found.column("block").to_pylist()])
    want = np.bincount(lines._counter(words_of(texts_of(batch.column("text"))).hashes >> np.uint64(64 - lines._BITS)), minlength=len(counts))
    assert (counts == want).all() and counts.sum() == 900_000
