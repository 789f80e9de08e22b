"""Merkle fingerprints of documents, from built-in functions alone.

Blank lines end a section, lines are paragraphs, and phrases of a few words are the leaves of a paragraph. Digests are
built from below: a leaf's is the SHA-256 of its phrase, a paragraph's that of its leaves' digests, each after the white space
before its phrase, a section's that of its paragraphs', and the root that of its sections'. The blank lines before a section
count to its first paragraph. So equal roots mean equal texts, and texts that differ differ in a paragraph.

A fingerprint is ``root:section/section`` with the root in full; a section is ``digest>paragraph|paragraph``, a paragraph
``digest=leaf,leaf``, with the first 16 digits of these digests and 8 of a leaf's. Two trees are compared from
the root down: only below unequal digests at one place does the comparison go on.

A null text is the empty text, which is one empty section, paragraph and leaf. Documents follow one another by doc_id;
null ids come first, and rows of one id are ordered by a hash of their text, so equal rows are followed by each other. A
document alone follows itself. Long texts are handled whole; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayengine.llm.ranges import cuts_of, with_neighbours

ROWS_PER_RANGE = 2000
_SECTION, _PARAGRAPH = r"\n[ \t\r]*\n", r"\n"
# a phrase ends at punctuation and after words in d or n: a boundary that an edit elsewhere doesn't move
_PHRASE = r"(?<=[.!?;:,dn])\s+"


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _parts(text: Column, pattern: str) -> Column:
    """Array of (text, before): what the pattern parts, each with the separator before it."""
    before = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.arrays_zip(F.split(text, pattern).alias("text"), before.alias("before"))


def _branch(children: Column, digits: int, mark: str, inner: str, between: Column) -> Column:
    """(digest, print) of a node by its children's; ``between`` is hashed with their digests, which are printed at ``digits``."""
    return F.struct(_digest(between).alias("digest"), F.array_join(F.transform(children, lambda c: F.concat(F.substring(c["digest"], 1, digits), F.lit(mark), c["print"])), inner).alias("print"))


def _leaves(paragraph: Column, before: Column) -> Column:
    """Array of (digest, before, print) of a paragraph's phrases; ``before`` is what stands before the first."""
    leaf = lambda p, i: F.struct(
        _digest(p["text"]).alias("digest"), F.when(i == 0, before).otherwise(p["before"]).alias("before"), F.lit("").alias("print"),
    )
    return F.transform(_parts(paragraph, _PHRASE), leaf)


def _paragraphs(section: Column) -> Column:
    """Array of (digest, print) of a section's paragraphs."""
    grown = F.transform(F.split(section["text"], _PARAGRAPH), lambda p, i: _leaves(p, F.when(i == 0, section["before"]).otherwise(F.lit(""))))
    return F.transform(grown, lambda c: _branch(c, 8, "", ",", F.array_join(F.transform(c, lambda x: F.concat(x["before"], x["digest"])), "")))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; equal texts have equal ones, and others others."""
    joined = lambda c, by: F.array_join(F.transform(c, lambda x: x["digest"]), by)
    sections = F.transform(F.transform(_parts(F.coalesce(text, F.lit("")), _SECTION), _paragraphs), lambda c: _branch(c, 16, "=", "|", joined(c, "|")))
    top = F.transform(F.array(sections), lambda c: _branch(c, 16, ">", "/", joined(c, "/")))[0]
    return F.concat_ws(":", top["digest"], top["print"])


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def _sections(print_: Column) -> Column:
    return F.split(F.substring_index(print_, ":", -1), "/")


def _digests(section: Column) -> Column:
    """Digests of a section's paragraphs, in order; none where there is no section."""
    found = F.transform(F.split(F.substring_index(section, ">", -1), r"\|"), lambda p: F.substring_index(p, "=", 1))
    return F.coalesce(found, F.array().cast("array<string>"))


def leaves(print_: Column) -> Column:
    return F.split(F.regexp_replace(F.substring_index(print_, ":", -1), "[0-9a-f]{16}[=>]", ""), "[/|,]")


def changed(old: Column, new: Column) -> Column:
    """Places, from 0, of the paragraphs that differ: none below equal roots or sections.

    Sections meet by position, and in unequal ones paragraphs do. A section has as many places as its longer form has
    paragraphs, so one that only one of the texts has, or that moved, is reported at each place that it leaves or takes.
    """
    none = F.array().cast("array<int>")

    def step(acc: Column, pair: Column) -> Column:
        a, b = _digests(pair["a"]), _digests(pair["b"])
        n = F.greatest(F.size(a), F.size(b))
        unlike = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
        same = F.substring_index(pair["a"], ">", 1).eqNullSafe(F.substring_index(pair["b"], ">", 1))
        out = F.when(same, acc["out"]).otherwise(F.concat(acc["out"], F.transform(unlike, lambda i: acc["at"] + i)))
        return F.struct((acc["at"] + n).alias("at"), out.alias("out"))

    pairs = F.arrays_zip(_sections(old).alias("a"), _sections(new).alias("b"))
    places = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(root(old) == root(new), none).otherwise(places)


def likeness(left: Column, right: Column) -> Column:
    """1 for equal roots, else the part of both texts' distinct leaves that the other has too (Dice)."""
    a, b = F.array_distinct(leaves(left)), F.array_distinct(leaves(right))
    common = 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))
    return F.when(root(left) == root(right), 1.0).otherwise(common)


def edited_corpus(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last quarter is the beginning of the next document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    cuts = cuts_of(docs.select("doc_id"), key, rows_per_range)
    placed = with_neighbours(docs.withColumn("fingerprint", fingerprint(F.col("text"))), key, cuts, around=True)
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    pairs = placed.withColumns({
        "next_text": F.lead("text").over(order), "next_fingerprint": F.lead("fingerprint").over(order),
    }).where(~F.col("guest"))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n - cut)
    pairs = pairs.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), cut)))
    pairs = pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint",
    )
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
