"""Personal data in texts: exact formats, and candidates judged by boosted trees."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.boosting import Boosted, fit
from tickloom.llm.common import let, running_totals

# Kinds in their order; a span's kind is its place here.
KINDS = ("email", "ip", "card", "phone")
# Added spans need a probability that on held cases was right this often.
PRECISION = 0.95
# Characters around a candidate that its features look at.
AROUND = 24

# The base formats. Runs are taken whole and given back never, where that cannot change what
# matches, so that each pattern reads a text once.
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
_BASE = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9]){12,}+",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
# High-recall generators. They overlap each other, and take a run of digits whole or not at all.
_AT = r"(?:@|[\[(]\s?(?:at|AT)\s?[\])])"
_DOT = r"(?:\.|[\[(]\s?(?:dot|DOT)\s?[\])])"
_LOOSE = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\s?{_AT}\s?{_LABEL}++(?:\s?{_DOT}\s?{_LABEL}++)++",
    r"(?<![0-9.])[0-9]{1,4}+(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,4}+){3}+(?!\.?[0-9])",
    r"(?<![0-9][ ./-])(?<![0-9])[0-9](?:[ ./-]?[0-9]){11,}+",
    r"(?<![0-9][ .()-])(?<![0-9+])\(?[0-9]{1,5}+\)?(?:[ .()-]{1,2}+[0-9]{1,5}+){1,6}+(?![ .()-]{0,2}[0-9])",
)
# What a text must hold for a pattern to be tried at all.
_HINT = ("@", "[0-9]", "[0-9]", r"\+[0-9]")
_LOOSE_HINT = (r"@|[aA][tT]\s?[\])]", "[0-9]", "[0-9]", "[0-9]")
_CUE = (
    r"(?i)(?:mail|contact|write)\W*$",
    r"(?i)\b(?:ip|host|server|address|addr)\W*$",
    r"(?i)\b(?:card|visa|credit|payment|cc)\W*$",
    r"(?i)\b(?:phone|tel|call|mobile|fax|cell)\W*$",
)
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_DATE = r"^(?:(?:19|20)[0-9]{2}([-. ])[01]?[0-9]\1[0-3]?[0-9]|[0-3]?[0-9]([-. ])[0-3]?[0-9]\2(?:19|20)[0-9]{2})(?![0-9])"
FEATURES = ("digits", "groups", "mark", "valid", "before", "after", "cue", "dated", "lead", "longest")


def _found(text: Column, pattern: str, hint: str) -> Column:
    """All matches as ``array<struct<start, end, match, left, right>>``, in code points.

    Spark gives the matches and the pieces between them; their lengths give the places.
    """

    def place(x: Column) -> Column:
        matches, gaps = x["matches"], x["gaps"]
        pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(
            m.alias("match"), g.alias("gap"), (F.length(g) + F.length(m)).alias("size")
        ))

        def with_totals(y: Column) -> Column:
            return F.transform(y["pairs"], lambda p, i: F.struct(
                (F.get(y["before"], i) + F.length(p["gap"])).alias("start"),
                (F.get(y["before"], i) + p["size"]).alias("end"),
                p["match"].alias("match"),
                F.right(p["gap"], F.lit(AROUND)).alias("left"),
                F.left(F.get(gaps, i + 1), F.lit(AROUND)).alias("right"),
            ))

        return let(pairs, lambda p: let(
            F.struct(p.alias("pairs"), running_totals(F.transform(p, lambda q: q["size"])).alias("before")),
            with_totals,
        ))

    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    return F.when(text.rlike(hint), let(pieces, place))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled (9 less if above 9), and the others
    sum to a multiple of ten."""

    def total(back: Column) -> Column:
        def add(so_far: Column, i: Column) -> Column:
            digit = F.substring(back, i, F.lit(1)).cast("int")
            twice = digit * 2
            return so_far + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)

    return let(F.reverse(digits), total) % 10 == 0


def _valid(kind: int, match: Column) -> Column:
    """The base rule that a match must pass beside its pattern."""
    if KINDS[kind] == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if KINDS[kind] == "card":
        return let(_digits(match), lambda d: F.when(F.length(d).between(13, 19), passes_luhn(d)).otherwise(False))
    if KINDS[kind] == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


# Stands for each character of a base span that candidates must not touch.
_BLANK = "\u2588"


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def base_spans(text: Column) -> Column:
    """``array<struct<kind, start, end>>`` of the base formats, by kind, then start."""

    def of_kind(kind: int) -> Column:
        good = F.filter(_found(text, _BASE[kind], _HINT[kind]), lambda m: _valid(kind, m["match"]))
        spans = F.transform(good, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")
        ))
        return F.coalesce(spans, _none("struct<kind:int,start:bigint,end:bigint>"))

    return F.concat(*map(of_kind, range(len(KINDS))))


def _side(char: Column) -> Column:
    """0 edge or white space, 1 letter, 2 digit, 3 bracket or quote, 4 other."""
    return (
        F.when(char.isNull() | (char == "") | char.rlike(r"^\s$"), 0).when(char.rlike(r"^\p{L}$"), 1)
        .when(char.rlike("^[0-9]$"), 2).when(char.rlike(r"""^["'()\[\]<>]$"""), 3).otherwise(4)
    )


def _features(kind: int, m: Column) -> list[Column]:
    """Format and context of a candidate as small numbers, in the order of ``FEATURES``."""
    match = m["match"]
    if KINDS[kind] == "email":
        valid = match.rlike(r"\.[A-Za-z]{2,}$")
    elif KINDS[kind] == "phone":
        valid = F.lit(True)
    else:
        valid = _valid(kind, match)
    return [
        F.least(F.length(_digits(match)), F.lit(20)).cast("int"),
        F.least(F.size(F.split(match, "[^0-9]++")), F.lit(6)).cast("int"),
        F.when(match.contains("["), 5).when(match.contains("("), 1).when(match.rlike(r"\s"), 2).when(match.contains("-"), 3)
        .when(match.contains("@"), 4).when(match.contains("/"), 7).when(match.contains("."), 6).otherwise(0),
        F.coalesce(valid, F.lit(False)).cast("int"),
        _side(F.right(m["left"], F.lit(1))),
        _side(F.left(m["right"], F.lit(1))),
        F.coalesce(m["left"].rlike(_CUE[kind]), F.lit(False)).cast("int"),
        match.rlike(_DATE).cast("int"),
        F.when(match.startswith("00"), 1).when(match.startswith("("), 2).when(match.rlike("^97[89]"), 3).otherwise(0),
        F.least(F.array_max(F.transform(F.split(match, "[^0-9]++"), F.length)), F.lit(9)).cast("int"),
    ]


def _candidates(text: Column) -> Column:
    """``array<struct<kind, start, end, features>>`` from the generators."""

    def of_kind(kind: int) -> Column:
        rows = F.transform(_found(text, _LOOSE[kind], _LOOSE_HINT[kind]), lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.array(*_features(kind, m)).alias("features"),
        ))
        return F.coalesce(rows, _none("struct<kind:int,start:bigint,end:bigint,features:array<int>>"))

    return F.concat(*map(of_kind, range(len(KINDS))))


def _blanked(text: Column) -> Column:
    """``text`` with its base spans blanked out, at the same length, so that no candidate touches them."""
    for kind in range(len(KINDS)):
        pattern, hint = _BASE[kind], _HINT[kind]

        def blank(x: Column) -> Column:
            matches = F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda m: F.when(
                _valid(kind, m), F.repeat(F.lit(_BLANK), F.length(m))
            ).otherwise(m))
            pairs = F.zip_with(F.split(x, pattern, -1), matches, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
            return F.array_join(pairs, "")

        text = let(text, lambda x: F.when(x.rlike(hint), blank(x)).otherwise(x))
    return text


def _rewritten(kind: int, match: Column) -> Column:
    """Known ways to write a span of the kind that its base format does not match."""
    if KINDS[kind] == "email":
        at = F.regexp_replace(match, "@", " [at] ")
        ways = [at, F.regexp_replace(match, "@", "(at)"), F.regexp_replace(at, r"\.(?=[A-Za-z0-9-]+$)", " [dot] ")]
    elif KINDS[kind] == "ip":
        ways = [F.regexp_replace(match, r"\.", "[.]"), F.regexp_replace(match, r"\.", "(.)")]
    elif KINDS[kind] == "card":
        ways = [F.regexp_replace(_digits(match), "([0-9]{4})(?=[0-9])", f"$1{mark}") for mark in "./"]
    else:
        bare = F.substring(match, F.lit(2), F.length(match))
        ways = [bare, F.concat(F.lit("00"), bare), F.regexp_replace(match, r"^\+[0-9]{1,3}[ .-]?(?=[0-9(])", ""),
                F.regexp_replace(bare, "[ ()-]+", ".")]
    return F.array(*ways)


def _impersonal(match: Column) -> Column:
    """Numbers in known formats that name nobody, their digits drawn from a hash of ``match``; and ``match``
    with its last digit changed, which is no card any more."""
    last = F.right(match, F.lit(1)).try_cast("int")
    changed = F.concat(F.left(match, F.length(match) - 1), ((last + 1 + F.length(match) % 4) % 10).cast("string"))
    d = F.lpad(F.pmod(F.xxhash64(match), F.lit(10**12)).cast("string"), 12, "0")

    def piece(start: int, size: int) -> Column:
        return F.substring(d, start, size)

    def below(start: int, size: int, limit: int) -> Column:
        return F.lpad((piece(start, size).cast("int") % limit + 1).cast("string"), 2, "0")

    year, month, day = F.concat(F.lit("20"), piece(1, 2)), below(3, 2, 12), below(5, 2, 28)
    return F.array(
        F.concat_ws("-", year, month, day), F.concat_ws(".", day, month, year),
        F.concat_ws(" ", F.concat_ws("-", year, month, day), piece(1, 2)),
        F.concat(F.lit("978-"), piece(1, 1), F.lit("-"), piece(2, 2), F.lit("-"), piece(4, 6), F.lit("-"), piece(10, 1)),
        F.concat_ws(".", piece(1, 2), piece(3, 3), piece(6, 3), piece(9, 3)),
        F.concat_ws("-", piece(1, 3), piece(4, 4)), F.concat_ws(".", piece(1, 2), piece(3, 2)),
        F.concat_ws(".", F.lit("7"), piece(1, 1), F.lit("9"), F.concat(F.lit("3"), piece(2, 3))),
        F.concat_ws(" ", piece(1, 3), piece(4, 3)), d, changed,
    )


def training_cases(docs: DataFrame) -> DataFrame:
    """``(held, kind, features, label)`` of candidates whose truth is known without the base formats' help.

    Every base span of every document is put back into its own context in ways that the base
    formats do not match (``_rewritten``): the candidate that covers it whole, of its kind, is right,
    those that cut it or call it another kind are wrong. Numbers that name nobody, in the same
    contexts without the kind's cue, are wrong whatever finds them. Candidates beside them do not
    count. ``held`` is a quarter of the documents, by a hash of the text.
    """
    text = F.col("text")

    def of_kind(kind: int) -> Column:
        good = F.filter(_found(text, _BASE[kind], _HINT[kind]), lambda m: _valid(kind, m["match"]))
        spans = F.transform(good, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["match"].alias("match"), m["left"].alias("left"), m["right"].alias("right")
        ))
        return F.coalesce(spans, _none("struct<kind:int,match:string,left:string,right:string>"))

    spans = F.concat(*map(of_kind, range(len(KINDS))))
    each = docs.where(text.rlike("[0-9@]")).select((F.xxhash64("text") % 4 == 0).alias("held"), F.explode(spans).alias("s"))
    s, kind = F.col("s"), F.col("s.kind")
    ways, uncued = _rewritten(len(KINDS) - 1, s["match"]), s["left"]
    for k in range(len(KINDS) - 1):
        ways = F.when(kind == k, _rewritten(k, s["match"])).otherwise(ways)
    for cue in _CUE:
        uncued = F.regexp_replace(uncued, cue, "")
    personal = F.transform(ways, lambda w: F.struct(kind.alias("kind"), s["left"].alias("left"), w.alias("match"), s["right"].alias("right")))
    others = F.transform(_impersonal(s["match"]), lambda w: F.struct(F.lit(-1).alias("kind"), uncued.alias("left"), w.alias("match"), s["right"].alias("right")))
    cases = each.select("held", F.explode(F.concat(personal, others)).alias("x"))
    x, start = F.col("x"), F.length("x.left")
    end = start + F.length("x.match")
    snippets = cases.select("held", "x", F.concat("x.left", "x.match", "x.right").alias("snippet"))
    found = snippets.select("held", "x", F.explode(_candidates(_blanked(F.col("snippet")))).alias("c"))
    c = F.col("c")
    whole = (c["kind"] == x["kind"]) & (c["start"] == start) & (c["end"] == end)
    touching = found.where((c["start"] < end) & (start < c["end"]))
    return touching.select("held", "c.kind", "c.features", whole.cast("int").alias("label"))


class PiiModel(NamedTuple):
    """Per kind, the boosted trees and the probability that a span must reach; none: no spans."""

    by_kind: tuple[tuple[Boosted, float] | None, ...]


def learn_pii(docs: DataFrame) -> PiiModel:
    """Trees that tell personal data written in other ways from other numbers (``training_cases`` of all ``docs``).

    Every case counts: they are aggregated to their feature vectors, whose number the
    ranges of the features bound (a few thousand occur), and only those counts reach the driver.
    A quarter of the documents, by a hash of the text, is held for calibration. The threshold
    of a kind is the lowest at which held candidates were right in ``PRECISION`` of the cases;
    a kind without good candidates gets none.
    """
    counts = (
        training_cases(docs).groupBy("held", "kind", "features")
        .agg(F.sum("label").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    by_kind: list[tuple[Boosted, float] | None] = []
    for kind in range(len(KINDS)):
        own = sorted((r for r in counts if r.kind == kind), key=lambda r: (r.features, r.held))
        if not sum(r.good for r in own):
            by_kind.append(None)
            continue
        x = np.array([r.features for r in own], np.int64)
        good = np.array([r.good for r in own], float)
        bad = np.array([r.n - r.good for r in own], float)
        held_rows = np.array([r.held for r in own], bool)
        model = fit(x, good, bad, held_rows)
        by_kind.append((model, _threshold(model.scores(x), good, bad, held_rows)))
    return PiiModel(tuple(by_kind))


def _threshold(scores: np.ndarray, good: np.ndarray, bad: np.ndarray, held: np.ndarray) -> float:
    use = held if good[held].sum() else np.ones(len(scores), bool)
    scores, good, bad = scores[use], good[use], bad[use]
    best = 1.1
    for at in np.unique(scores):
        above = scores >= at
        if good[above].sum() >= PRECISION * (good[above].sum() + bad[above].sum()) and at > 0.5:
            best = float(at)
            break
    return best


def _added(candidates: Column, base: Column, model: PiiModel) -> Column:
    """The candidates that reach their threshold and touch no base span; of overlapping ones, the
    first by start, then the longest, then the likeliest."""

    def score(c: Column) -> Column:
        features = [F.get(c["features"], F.lit(i)) for i in range(len(FEATURES))]
        result = F.lit(0.0)
        for kind, own in enumerate(model.by_kind):
            if own is not None:
                p = own[0].score(features)
                result = F.when(c["kind"] == kind, F.when(p >= own[1], p).otherwise(0.0)).otherwise(result)
        return result

    def free_of_base(c: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    def drop_overlaps(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        free = last.isNull() | (last["end"] <= s["start"])
        span = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        return F.when(free, F.concat(done, F.array(span))).otherwise(done)

    scored = F.transform(candidates, lambda c: F.struct(
        c["start"].alias("start"), (-c["end"]).alias("by_length"), (-score(c)).alias("by_score"),
        c["kind"].alias("kind"), c["end"].alias("end"),
    ))
    picked = F.filter(F.filter(scored, lambda c: c["by_score"] < 0), free_of_base)
    return F.aggregate(F.array_sort(picked), _none("struct<kind:int,start:bigint,end:bigint>"), drop_overlaps)


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each stretch under ``spans`` replaced by ``[KIND]``, or ``[KIND][KIND]`` where
    spans of two kinds overlap."""
    names = F.lit([f"[{k.upper()}]" for k in KINDS])

    def add(state: Column, s: Column) -> Column:
        piece = F.substring(text, state["at"].cast("int") + 1, F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["out"], piece, F.get(names, s["kind"])).alias("out"),
        )

    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        in_order, start, add,
        lambda state: F.concat(state["out"], F.substring(text, state["at"].cast("int") + 1, F.lit(1 << 30))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with ``base`` and ``spans``.

    Both are ``array<struct<kind, start, end>>``, sorted by kind (see ``KINDS``), then start; in code
    points, the end exclusive. ``base`` holds the spans of the exact formats, ``spans`` those and
    what the trees add, none of which overlaps a base span or another added one. Base spans
    of different kinds may overlap.

    Null and empty texts have no spans. Equal texts have equal spans, whatever the other
    columns hold, and rows that repeat, in whole or by id, stay as many rows. The work on a text is
    linear in its length where all it holds is in the base formats. No document, no row. Each row is worked on by itself, nothing is shuffled;
    a pattern is only tried on texts that hold one of its characters.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), text.alias("text"))
    any_hint = F.col("text").rlike(f"[0-9@]|{_LOOSE_HINT[0]}")
    none = _none("struct<kind:int,start:bigint,end:bigint>")
    with_base = rows.withColumn("base", F.when(any_hint, base_spans(F.col("text"))).otherwise(none))
    added = let(_candidates(_blanked(F.col("text"))), lambda c: _added(c, F.col("base"), model))
    with_added = with_base.withColumn("added", F.when(any_hint, added).otherwise(none))
    return with_added.select("doc", "base", F.array_sort(F.concat("base", "added")).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
