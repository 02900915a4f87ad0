import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import SMALL, documents  # noqa: F401
from tickloom.llm.boosting import fit
from tickloom.llm.common import table
from tickloom.llm.pii import find_pii, learn_pii, redacted, written

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PIECES = [
    "a@b.c", "x.y@z-1.com", "_q", "12", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "é", " ",
    "+1 (743) 555-3824", "+44 20 7946 0958", "(212) 555-1234", "555-123-4567", "-", ".", "@", "+", "(", "\n", "99 ",
    "joe [at] mail [dot] com", "10.0.0.1.5.6.7.8", "5500 0000 0000 0004 1", "ü@é.de", "0001.02.3.4", "😀",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    return [
        (k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())
    ]


def as_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_equal_brute_force_and_stay(spark, documents):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(20))) for _ in range(800)]
    texts += [None, "", "a@b.co " * 500, "1 " * 5000, "+" * 3000 + " 123 " * 500, "a" * 60_000, "12.34." * 2000]
    docs = documents(*enumerate(texts), extra=True)
    found = find_pii(docs, learn_pii(docs)).select(
        "doc.doc_id", written(F.col("base")).alias("base"), written(F.col("spans")).alias("spans")
    ).collect()
    assert len(found) == len(texts)
    for r in found:
        want = as_text(brute(texts[r.doc_id])) if r.doc_id != len(texts) - 2 else ""
        assert r.base == want
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_trees_add_spans_in_like_format_and_context(spark, documents):
    rng = random.Random(6)

    def phone():
        return f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    rows = [(i, f"words here +1 {phone()} and more {i}") for i in range(300)]
    rows += [(1000, "my number is (212) 555-0199 today"), (1001, "clean words only"), (1002, "pages 100-2000 or 12.5")]
    docs = documents(*rows)
    got = {r.doc_id: r for r in find_pii(docs, learn_pii(docs)).select(
        "doc.doc_id", written(F.col("base")).alias("base"), written(F.col("spans")).alias("spans"),
        redacted(F.col("doc.text"), F.col("spans")).alias("text"),
    ).collect()}
    assert (got[1000].base, got[1000].spans) == ("", "phone:13:27")
    assert got[1000].text == "my number is [PHONE] today"
    assert got[1001].spans == got[1002].spans == ""
    assert got[7].text == "words here [PHONE] and more 7" and got[7].spans == got[7].base


def test_redaction_of_overlaps(spark):
    df = spark.createDataFrame(
        [("abcdef", [(0, 1, 3), (3, 2, 5)]), ("é😀x", [(1, 1, 2)]), ("same", []), (None, [])],
        "t string, s array<struct<kind:int,start:bigint,end:bigint>>",
    )
    got = [r[0] for r in df.select(redacted(F.col("t"), F.col("s"))).collect()]
    assert got == ["a[EMAIL][PHONE]f", "é[IP]x", "same", None]


def test_no_documents_and_no_candidates(spark, documents):
    empty = documents((1, "a")).limit(0)
    model = learn_pii(empty)
    assert model.by_kind == (None,) * 4 and find_pii(empty, model).count() == 0


def test_real_texts_keep_their_base_spans(spark):
    docs = table(spark, SMALL, "documents")
    got = find_pii(docs, learn_pii(docs)).select("doc.text", written(F.col("base")).alias("b")).collect()
    assert all(r.b == as_text(brute(r.text)) for r in got) and any(r.b for r in got)


def test_boosting_learns_an_interaction_and_scores_alike_in_sql(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, (400, 3))
    good = ((x[:, 0] > 2) != (x[:, 1] > 1)).astype(float)
    held = rng.random(400) < 0.25
    model = fit(x, good, 1 - good, held)
    p = model.scores(x)
    assert ((p > 0.5) == (good > 0))[held].mean() > 0.95
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], "i int, a int, b int, c int")
    got = df.select("i", model.score([F.col("a"), F.col("b"), F.col("c")]).alias("p")).orderBy("i").collect()
    assert np.allclose([r.p for r in got], p)


def personal(rng):
    """A span of each kind that its base format matches, by kind."""
    digits = [rng.randrange(10) for _ in range(15)]
    check = next(c for c in range(10) if luhn("".join(map(str, digits)) + str(c)))
    card = "".join(map(str, [*digits, check]))
    return {
        "email": f"{rng.choice(['joe', 'ann.b', 'x_1'])}{rng.randrange(99)}@mail{rng.randrange(9)}.org",
        "ip": ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        "card": " ".join(card[i:i + 4] for i in range(0, 16, 4)),
        "phone": f"+{rng.choice([1, 44, 49])} ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
    }


def missed_by_base(rng, kind, span):
    """The span as people write it to be read by people only."""
    if kind == "email":
        return span.replace("@", rng.choice([" [at] ", "(at)"]))
    if kind == "ip":
        return span.replace(".", "[.]")
    if kind == "card":
        return span.replace(" ", rng.choice([".", "/"]))
    return rng.choice([span[1:], "00" + span[1:], span.split(" ", 1)[1]])


def test_spans_that_the_base_misses_are_found_whole_and_other_numbers_left(spark, documents):
    rng = random.Random(9)
    words = "the quick report says that our data came late and nobody asked why it was so".split()
    cues = {"email": "mail", "ip": "host", "card": "card", "phone": "call"}

    def around(piece, cue=""):
        said = rng.choices(words, k=6)
        return " ".join([*said[:3], *([cue] if cue and rng.random() < 0.5 else [])]) + f" {piece} ", " ".join(said[3:])

    train = [(i, "".join(around(span, cues[k]))) for i in range(250) for k, span in personal(rng).items()]
    model = learn_pii(documents(*train))
    wanted, clean = [], []
    for _ in range(100):
        for kind, span in personal(rng).items():
            odd = missed_by_base(rng, kind, span)
            before, after = around(odd, cues[kind])
            wanted.append((kind, len(before) - len(odd) - 1, odd, before + after))
        d = [rng.randrange(10) for _ in range(15)]
        card = "".join(map(str, d)) + str(next(c for c in range(10) if not luhn("".join(map(str, d)) + str(c))))
        for number in (f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 9)}-{rng.randrange(10, 28)}", card,
                       f"{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}", f"{rng.randrange(99)}.{rng.randrange(10, 99)}"):
            clean.append("".join(around(number)))
    texts = [w[3] for w in wanted] + clean
    got = {r.doc_id: (r.base, r.spans) for r in find_pii(documents(*enumerate(texts)), model).select(
        "doc.doc_id", written(F.col("base")).alias("base"), written(F.col("spans")).alias("spans")).collect()}
    for kind in cues:
        own = [(i, w) for i, w in enumerate(wanted) if w[0] == kind]
        right = sum(f"{kind}:{w[1]}:{w[1] + len(w[2])}" == got[i][1] for i, w in own)
        assert right >= 0.9 * len(own), (kind, right, [(w[2], got[i]) for i, w in own][:5])
    alarms = [(texts[i], got[i]) for i in range(len(wanted), len(texts)) if got[i][1]]
    assert len(alarms) <= 0.05 * len(wanted), alarms[:5]


def test_training_cases_are_whole_spans_cut_spans_and_other_numbers(spark, documents):
    from tickloom.llm.pii import training_cases

    docs = documents((1, "call +1 (743) 555-3824 now"), (2, None), (3, ""), (3, "nothing"), extra=True)
    cases = training_cases(docs).collect()
    assert {(r.kind, r.label) for r in cases} >= {(3, 1), (3, 0)} and all(len(r.features) == 10 for r in cases)
