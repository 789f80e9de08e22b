"""Secrets in texts, with SQL functions alone: known patterns, and strings whose windows have high entropy.

Patterns. A regular expression gives, for each match and for what follows the last one, the text before it and the
match; running sums of their lengths are the spans, in code points. Only texts with a match get that far.

Entropy. Candidates are runs of 20 and more key characters with digits and letters that no span of a pattern covers; of
a run that one covers in part, the rest. A window of 20 characters slides over
each; per class (hex digits of either case, base-64 characters) a step changes the sum of c log2 c by the counts of the
character that comes and of the one that goes. Its cost is in proportion to the characters of candidates. Where the class's entropy reaches
its limit, the candidate is a span of kind ``entropy``, unless it is on the allow-list (UUIDs, plain words and
numbers, paths, runs such as the alphabet).

Null texts are empty texts, and these have no spans. Each row is handled alone, whole, so repeated rows give equal
results; only doc_id and text are read. Positions don't depend on the bytes a character takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20
LIMITS = {"hex": 3.0, "base64": 3.7}  # bits a character, of at most log2(16) and log2(20)

# The patterns asked for, and the fewest characters of the part that must be long.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

BLOCK = 256  # matches that are folded together
_MATCH = "struct<start:int,size:int,inner:int,found:string>"
_CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_ALLOWED = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[A-Za-z_=/+-]+$|^[0-9_=/+-]+$"
    r"|^[a-z]+(?:[/_-][a-z]+)*[0-9]{0,4}$|(?i)0123456789|abcdefghij|example|placeholder|xxxxxx"
)


def _appended(parts: Column, kind: str, start: Column, item) -> Column:
    """Array of ``item(at, part)`` for parts that take ``at`` further by gap and size: a fold that appends."""
    empty = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    add = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["size"]).alias("at"),
        F.when(x["size"] > 0, F.concat(acc["out"], F.array(item(acc["at"] + x["gap"], x)))).otherwise(acc["out"]).alias("out"),
    )
    return F.aggregate(parts, empty, add, lambda acc: acc["out"])


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, size, inner, found): all matches from the left, none overlapping, and the size of a group in them.

    Places are running sums, which a fold can only append one by one; so that this costs no square of the number
    of matches, blocks of them are summed first and then folded each from its own start.
    """
    # what is left of the text matches too, with an empty second group, so that nothing is scanned twice
    around = f"(?s)(.*?)(?:({pattern})|\\z)"
    gaps, found = F.regexp_extract_all(text, F.lit(around), F.lit(1)), F.regexp_extract_all(text, F.lit(around), F.lit(2))
    inner = F.regexp_extract_all(text, F.lit(around), F.lit(2 + group)) if group else found
    parts = F.arrays_zip(
        F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("size"), F.transform(inner, F.length).alias("inner"), found.alias("found")
    )
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.slice(parts, b * BLOCK + 1, BLOCK))
    return _bound(blocks, _placed)


def _placed(blocks: Column) -> Column:
    total = lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x["gap"] + x["size"])
    sums = F.transform(blocks, lambda block: F.struct(F.lit(0).alias("gap"), total(block).alias("size")))
    # every block has a character, but for one that is only the empty end
    starts = _appended(sums, "int", F.lit(0), lambda at, x: at)
    item = lambda at, x: F.struct(at.alias("start"), x["size"].alias("size"), x["inner"].alias("inner"), x["found"].alias("found"))
    zipped = F.arrays_zip(blocks.alias("block"), starts.alias("start"))
    full = F.filter(zipped, lambda z: z["start"].isNotNull())
    return F.flatten(F.transform(full, lambda z: _appended(z["block"], _MATCH, z["start"], item)))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: an expression named in a fold would be computed at each step."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, kind: str, order: int, pattern: str, least: int, group: int = 0) -> Column:
    """Array of (start, order, kind, end); empty at once where no match is long enough."""
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    long = pattern.replace("]+)", f"]{{{least},}})") if group else pattern.replace("]+", f"]{{{least - (4 if kind == 'access' else 0)},}}")
    found = F.filter(_matches(text, pattern, group), lambda m: m["inner"] >= least)
    spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), (m["start"] + m["size"]).alias("end")))
    return F.when(text.rlike(long), spans).otherwise(none)


def _weight(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)


def window_entropy(text: Column, letters: str, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of the class's characters in any window that holds only such characters; else 0.

    One step for each character: how often the one that comes and the one that goes are in the window tells how the sum of c log2 c changes.
    """
    places = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(letters), c) - 1)  # -1: of another class
    return _bound(places, lambda p: _best_window(p, window))


def _best_window(places: Column, window: int) -> Column:
    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(acc: Column, i: Column) -> Column:
        new = F.element_at(places, i)
        old = F.when(i > window, F.element_at(places, F.greatest(i - window, F.lit(1)))).otherwise(-1)
        held = F.slice(places, F.greatest(i - window, F.lit(1)), F.least(i - 1, F.lit(window)))
        count = lambda which: F.size(F.filter(held, lambda c: c == which))
        come = lambda: _bound(count(new), lambda c: _weight(c + 1) - _weight(c))
        go = lambda: _bound(count(old), lambda c: _weight(c - 1) - _weight(c))
        change = F.when(new >= 0, come()).otherwise(0.0) + F.when(old >= 0, go()).otherwise(0.0)
        total = acc["sum"] + F.when(new != old, change).otherwise(0.0)
        n = acc["n"] + (new >= 0).cast("int") - (old >= 0).cast("int")
        moved = F.struct(n.alias("n"), total.alias("sum"))
        return _bound(moved, lambda m: F.struct(
            m["n"].alias("n"), m["sum"].alias("sum"),
            F.greatest(acc["best"], F.when(m["n"] == window, F.log2(F.lit(float(window))) - m["sum"] / window).otherwise(0.0)).alias("best"),
        ))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(places), F.lit(1))), start, step, lambda acc: acc["best"])


def _classes() -> dict[str, str]:
    hexes = "0123456789abcdef"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return {"hex": hexes, "base64": "0123456789" + upper + upper.lower() + "+/_=-"}


def _suspicious(text: Column) -> Column:
    """Whether a candidate's entropy reaches the limit of a class and it isn't on the allow-list."""
    checks = [window_entropy(F.lower(text) if name == "hex" else text, letters) >= LIMITS[name] for name, letters in _classes().items()]
    return (~text.rlike(_ALLOWED)) & text.rlike("[0-9]") & text.rlike("[A-Za-z]") & (checks[0] | checks[1])


def _uncovered(run: Column, base: Column) -> Column:
    """Array of (start, size, found): the parts of a run that no span covers, as long as a window."""
    end = run["start"] + run["size"]
    kind = "array<struct<start:int,size:int>>"
    first = F.struct(run["start"].alias("at"), F.array().cast(kind).alias("out"))
    part = lambda acc, to: F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), (to - acc["at"]).alias("size"))))
    add = lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), part(acc, b["start"]).alias("out"))
    overlapping = F.filter(base, lambda b: (b["start"] < end) & (run["start"] < b["end"]))
    free = F.filter(F.aggregate(overlapping, first, add, lambda acc: part(acc, end)), lambda p: p["size"] >= WINDOW)
    # from the run, not from the text: a place in a text is found by counting from its beginning
    return F.transform(free, lambda p: F.struct(
        p["start"].alias("start"), p["size"].alias("size"), F.substring(run["found"], p["start"] - run["start"] + 1, p["size"]).alias("found")
    ))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, order, kind, end) by start, then kind; end is exclusive."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(
        _spans(whole, "assign", 0, ASSIGN, LEAST["assign"], 1), _spans(whole, "access", 1, ACCESS, LEAST["access"]),
        _spans(whole, "hex", 2, HEX, LEAST["hex"]),
    ))
    none = F.array().cast(f"array<{_MATCH}>")
    runs = F.when(whole.rlike(_CANDIDATE), _matches(whole, _CANDIDATE)).otherwise(none)
    out = docs.withColumns({"base": base, "__runs": runs})
    loose = F.flatten(F.transform("__runs", lambda m: _uncovered(m, F.col("base"))))
    extra = F.transform(
        F.filter(loose, lambda m: _suspicious(m["found"])),
        lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("order"), F.lit("entropy").alias("kind"), (m["start"] + m["size"]).alias("end")),
    )
    return out.withColumn("spans", F.array_sort(F.concat("base", extra))).drop("__runs")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_corpus(docs: DataFrame) -> DataFrame:
    """Counts of the pattern spans of each text, the digest of their list, and the list of all spans."""
    found = find_spans(docs.select(F.col("doc_id").cast("long"), "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
    )
